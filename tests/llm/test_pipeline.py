"""The pipeline's rows against plain code of all five stages, over a small corpus that has a case for each."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import sentencepiece

from tallymark.llm import language_id, sentencepieces

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SYLLABLES = {"en": "the ing and tion er on at es th re in ou".split(), "fr": "le que eau ais ment oi re é è ç ux en".split()}


def make_documents():
    rng = np.random.default_rng(12)
    word = lambda lang: "".join(rng.choice(SYLLABLES[lang], int(rng.integers(1, 4))))
    prose = lambda lang, n: [word(lang) for _ in range(n)]
    rows = [(k, " ".join(prose("en" if k % 3 else "fr", 120)), "en" if k % 3 else "fr", f"src{k % 4}") for k in range(150)]
    bench = [(k, " ".join(prose("en", 25))) for k in range(6)] + [(6, "few words only here"), (None, " ".join(prose("en", 12))), (7, None)]
    add = lambda text, source="src0", lang="en": rows.append((len(rows), text, lang, source))
    for k in range(0, 40, 4):  # exact copies, near copies, and texts that are only half alike
        words = rows[k][1].split()
        add(rows[k][1], "src1", rows[k][2])
        add(" ".join([*words[:60], "other", *words[61:]]), "src2", rows[k][2])
        add(" ".join([*words[:60], *prose("en", 60)]), "src3", "en")
    for k, (_, text) in enumerate(bench[:6]):  # passages of the benchmark, whole and in part, and one word short of a window
        words = text.split()
        add(" ".join([*prose("en", 50), *words[k : k + 10], *prose("en", 50)]))
        add(" ".join([*prose("en", 50), *words[k : k + 9], *prose("en", 50)]))
    add(" ".join([*prose("en", 30), "Few", "words", "only,", "here", *prose("en", 30)]))
    add(" ".join([*prose("en", 30), *bench[7][1].split(), *prose("en", 30)]))
    for k in range(8):  # secrets of one owner and of several
        add(" ".join([*prose("en", 80), f'password = "own{k}secret{k}"', *prose("en", 10)]), "src1")
        add(" ".join([*prose("en", 80), 'api_key: "copied0example"', "AKIA" + "EXAMPLE0" * 2, *prose("en", 10)]), f"src{k % 3}")
    for k in range(5):  # what no language model knows
        add(" ".join("".join(rng.choice(list("жщыюэ漢字かな"), 5)) for _ in range(60)), "src0", None)
    rows += [(900, None, "en", "src0"), (901, "", "en", "src0"), (902, "12 34 56", "en", "src0"), (None, " ".join(prose("en", 60)), "en", "src2"), (903, " ".join(prose("en", 4000)), "en", "src1")]
    rows.append(rows[3])  # a repeated row
    return rows, bench


def plain_languages(rows, order=4, quantile=0.999):
    """Rows whose lowest cross-entropy is not above the limit, by interpolated Kneser-Ney models over all labelled rows that aren't held out."""
    def letters(t):
        return re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in t.lower())).removeprefix(" ")

    fitted = {r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None and zlib.crc32(str(r[0]).encode()) % 3 != 1}
    counts = {}
    for lang in sorted({r[2] for r in fitted}):
        top = collections.Counter()
        for r in fitted:
            if r[2] == lang:
                t = " " * (order - 1) + letters(r[1])
                top.update(t[k : k + order] for k in range(len(t) - order + 1))
        by = {order: top}
        for k in range(order - 1, 0, -1):
            by[k] = collections.Counter(g[1:] for g in by[k + 1])
        counts[lang] = by
    floor = 1 / (len({g for by in counts.values() for g in by[1]}) + 1)
    prepared = {}
    for lang, by in counts.items():
        for k, c in by.items():
            n1, n2 = (sum(v == i for v in c.values()) for i in (1, 2))
            total, kinds = collections.Counter(), collections.Counter()
            for g, v in c.items():
                total[g[:-1]] += v
                kinds[g[:-1]] += 1
            prepared[lang, k] = c, min(max(n1 / (n1 + 2 * n2), 0.1), 0.9) if n1 else 0.5, total, kinds
    memo = {}

    def log_p(lang, gram):
        if (lang, gram) not in memo:
            p = floor
            for k in range(1, order + 1):
                c, d, total, kinds = prepared[lang, k]
                g = gram[-k:]
                if g[:-1] in total:
                    p = max(c.get(g, 0) - d, 0) / total[g[:-1]] + d * kinds[g[:-1]] / total[g[:-1]] * p
            memo[lang, gram] = math.log(p)
        return memo[lang, gram]

    def lowest(text):
        t = letters(text or "")
        padded = " " * (order - 1) + t
        return min(-sum(log_p(lang, padded[k : k + order]) for k in range(len(t))) / len(t) for lang in counts) if t else None, len(t)

    high = float(np.quantile([h for h, n in (lowest(r[1]) for r in fitted) if n], quantile))
    none = min(math.log(prepared[lang, 1][1] * prepared[lang, 1][3][""] / prepared[lang, 1][2][""] * floor) for lang in counts)
    limit = high + 0.25 * max(0.0, -none - high)
    return [r for r in rows for h, n in [lowest(r[1])] if n and h <= limit + 4.5 / math.sqrt(n)]


def plain_near_duplicates(rows):
    sets = []
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for k, r in enumerate(rows):
        key = (r[0] is None, r[0] or 0, k)
        if not sets[k] or key < best.get(group[k], ((True, 0, 10**9), None))[0]:
            best[group[k] if sets[k] else ("own", k)] = (key, r)
    return [r for _, r in best.values()]


def plain_decontamination(rows, bench):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for _, t in bench:
        w = words(t)
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    return [r for r in rows for w in [words(r[1])] if not any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))]


def plain_redaction(rows):
    found, owners = [], collections.defaultdict(set)
    for r in rows:
        spans = [(m.start(), m.end(), m[2]) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", r[1], re.I | re.A) if len(m[2]) >= 6]
        spans += [(m.start(), m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", r[1]) if len(m[0]) >= 20]
        found.append(spans)
        for _, _, v in spans:
            owners[v].add(r[3])
    out = []
    for r, spans in zip(rows, found):
        text = r[1]
        for a, z, v in sorted(spans, reverse=True):
            text = text[:a] + "[secret]" + text[z:] if len(owners[v]) == 1 else text
        out.append((r[0], text))
    return out


def test_against_plain_code(spark, tmp_path):
    rows, bench = make_documents()
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = [rows]
    for stage in (plain_languages, plain_near_duplicates, lambda r: plain_decontamination(r, bench)):
        kept.append(stage(kept[-1]))
    assert all(len(a) > len(b) for a, b in zip(kept, kept[1:]))  # each stage drops some
    redacted = plain_redaction(kept[-1])
    assert sum("[secret]" in t for _, t in redacted) >= 8 and any("copied0example" in t for _, t in redacted)
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.default_model())
    want = []
    for i, t in redacted:
        ids = sp.encode(t, add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_stages_alone(spark, tmp_path):
    """Each stage on its own input, whose rows and columns it keeps but for what it drops or masks."""
    rows, bench = make_documents()
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = {"language_id": plain_languages, "near_duplicates": plain_near_duplicates, "decontamination": lambda r: plain_decontamination(r, bench)}
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(str(r[:2]) for r in plain[name](rows)), name
    assert language_id.train(docs.limit(0)).languages == []
