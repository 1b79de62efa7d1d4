"""Cases that broke before, and brute force for the operators that SQL can't express."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.llm import decontamination, language_id, metric_tree, near_duplicates, repeats, secrets, shared, token_files, url_reputation, warc

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("_id", "_key", "live_spans", "rejected", "score", "lang_pred", "cross_entropy", "_text", "text_key", "hits", "__id", "comp", "doc_id_")


def crowded(df):
    """The rows with extra columns that the operators use as names themselves."""
    return df.select("*", *[F.lit(f"x{k}").alias(c) for k, c in enumerate(CLASHING)])


@pytest.fixture(scope="module")
def prose(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select(*[c.split()[0] for c in SCHEMA.split(", ")])


def test_word_codes_depend_on_all_bytes():
    rng = np.random.default_rng(4)
    words = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in [*range(1, 90), 300]] * 2 + [b"a" * k for k in range(1, 90)]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    codes = shared.word_codes(data, ends - [len(w) for w in words], ends)
    assert len(set(zip(words, codes.tolist()))) == len(set(words)) == len(set(codes.tolist()))


def test_words_that_polynomial_codes_confuse(spark):
    """Thue-Morse words and their mirror have equal polynomial sums modulo 2**64, but nothing in common."""
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, one), (2, two), (3, f"{one} x y z"), (4, f"{two} x y z"), (5, one.upper())], "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.kept) for r in near_duplicates.near_duplicates(docs, 3, 85).collect()}
    assert got == {1: (1, True), 2: (2, True), 3: (3, True), 4: (4, True), 5: (1, False)}


def test_near_duplicates_in_hot_buckets(spark):
    """Families of texts around the threshold, with every bucket hot or in pieces, against all pairs."""
    rng = np.random.default_rng(8)
    common = [f"c{k}" for k in range(120)]
    rows = []
    for k in range(120):
        words = list(common)
        for at in rng.choice(120, int(rng.integers(0, 9)), replace=False):
            words[at] = f"w{rng.integers(0, 40)}"
        rows.append((k, " ".join(words)))
    sets = {i: near_duplicates.true_shingles(t.encode(), 3) for i, t in rows}
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and group[a] != group[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {k: new if g == old else g for k, g in group.items()}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert 1 < len(set(group.values())) < 120
    for hot, piece in ((near_duplicates.HOT, 5), (4, 3)):
        assert {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs, 3, 85, hot, piece).collect()} == group


def test_percent_is_checked(spark, prose):
    with pytest.raises(ValueError):
        near_duplicates.near_duplicates(prose, 3, 70)


def test_keep_one(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(None, text), (None, text), (None, f"{text} more")] + [(7, "alpha beta gamma delta epsilon zeta eta"), (7, "alpha beta gamma delta epsilon zeta eta"), (8, "alpha beta gamma delta epsilon zeta eta")]
    rows += [(9, None), (10, ""), (9, None), (11, "quite another text of a few words here")]
    docs = crowded(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA))
    got = near_duplicates.keep_one(docs, 2, 80)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted(kept, key=str) == sorted([(None, min((text, f"{text} more"), key=lambda t: next(k for x, k in kept_keys(spark, docs) if x == t))), (7, rows[3][1]), (9, None), (9, None), (10, ""), rows[-1]], key=str)


def kept_keys(spark, docs):
    return [tuple(r) for r in docs.select("text", F.xxhash64("text")).distinct().collect()]


def test_clashing_columns_and_nulls(spark, prose):
    """All stages with extra columns of any name, rows of nulls, and an empty table."""
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 3 + [(k, "", "en", "s0", 0) for k in range(-300, 0)], SCHEMA)
    docs = crowded(prose.unionByName(nulls)).coalesce(2)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    for stage in (language_id.keep_identified, near_duplicates.keep_one, lambda d: decontamination.drop_contaminated(d, bench), secrets.redact):
        out = stage(docs)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString() and 0 < out.count() <= docs.count()
        assert stage(docs.limit(0)).count() == 0


def test_language_of_empty_slices(spark, prose):
    """Whole batches without a character, and a language of one long text."""
    model = language_id.train(prose)
    assert model.predict([""] * 300)[0] == ["und"] * 300
    rows = [(3 * k + 5, "", None, "s", 0) for k in range(600)] + [(k, "zyx wvu " * 300_000, "qq", "s", 0) for k in range(4)]
    docs = prose.unionByName(spark.createDataFrame(rows, SCHEMA)).coalesce(1)
    got = language_id.identify(docs, language_id.train(docs, fit_chars=20_000, calibrate_chars=5_000), "doc_id", "lang")
    assert got.filter("lang IS NULL AND lang_pred <> 'und'").count() == 0 and got.filter("lang = 'qq' AND lang_pred = 'qq'").count() >= 4
    bad = language_id.identify(spark.createDataFrame([(1, "жщ ыы ъэ юя " * 30)], "doc_id long, text string"), model, "doc_id").first()
    assert bad.rejected


def test_kneser_ney_against_plain_code():
    """Probabilities of every gram, seen or not, by the published recursion."""
    texts = {"a": ["abra cadabra", "bad cab"], "b": ["sos mosso", "moss som"]}
    order = 3
    counted = {}
    for lang, some in texts.items():
        c = collections.Counter()
        for t in some:
            padded = " " * (order - 1) + t
            c.update(padded[k : k + order] for k in range(len(t)))
        counted[lang] = dict(c)
    model = language_id.fit(counted, order)
    alphabet = {g[-1] for c in counted.values() for g in c}

    def plain(lang, gram):
        counts = {order: counted[lang]}
        for k in range(order - 1, 0, -1):
            counts[k] = collections.Counter(g[1:] for g in counts[k + 1])
        p = 1 / (len(alphabet) + 1)
        for k in range(1, order + 1):
            g = gram[-k:]
            of = {x: n for x, n in counts[k].items() if x[:-1] == g[:-1]}
            n1, n2 = (sum(n == i for n in counts[k].values()) for i in (1, 2))
            d = min(max(n1 / (n1 + 2 * n2), 0.1), 0.9) if n1 else 0.5
            if of:
                p = max(of.get(g, 0) - d, 0) / sum(of.values()) + d * len(of) / sum(of.values()) * p
        return p

    for text in ("abra", "moss cab", "zzz"):
        h, n = model.entropies([text])
        for j, lang in enumerate(model.languages):
            padded = " " * (order - 1) + text
            want = -sum(math.log(plain(lang, padded[k : k + order])) for k in range(len(text))) / len(text)
            assert abs(h[0, j] - want) < 1e-4 and n[0] == len(text)


def plain_secrets(rows):
    """(doc_id, spans) by the patterns of the contract and the owners of every value, without the operator's code."""
    kinds = ("assign", "access", "hex", "token")
    found, owners = [], collections.defaultdict(set)
    for i, t, owner in rows:
        t, spans = t or "", []
        for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
            spans += [(m.start(), 0, m.end(), m[2])] * (len(m[2]) >= 6)
        spans += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        base = [s[:3] for s in spans]
        for m in re.finditer("[A-Za-z0-9+/_=-]{24,}", t):
            p = [m[0].count(c) / len(m[0]) for c in set(m[0])]
            if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and -sum(x * math.log2(x) for x in p) >= 3.2 and not any(s < m.end() and m.start() < e for s, _, e in base):
                spans.append((m.start(), 3, m.end(), m[0]))
        found.append((i, sorted(spans)))
        for s in spans:
            owners[s[3]].add(owner or "")
    return sorted((i, ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e, v in spans if k < 3 or len(owners[v]) == 1)) for i, spans in found)


def test_secrets_against_plain_code(spark, prose):
    rng = np.random.default_rng(2)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))
    tokens = ["".join(rng.choice(letters, 30)) for _ in range(12)]
    rows = [(r.doc_id, r.text, r.source) for r in prose.select("doc_id", "text", "source").collect()]
    for k in range(60):
        parts = [f"{rng.choice(['password', 'API_KEY', 'Secret', 'token'])}{rng.choice(['=', ': ', '\" : \"', ' '])}{rng.choice(['abc', 'hunter22', tokens[k % 12]])}", tokens[int(rng.integers(12))], "".join(rng.choice(letters, 26)), "AKIA" + "Q7" * int(rng.integers(5, 12)), "deadbeef" * int(rng.integers(2, 5)), "é漢字"]
        rows.append((10_000 + k, " ".join(rng.permutation(parts * int(rng.integers(1, 4)))), None if k % 7 == 0 else f"s{k % 3}"))
    rows += [(20_000, None, "s0"), (20_001, "", "s0"), (20_002, f"{tokens[0]} " * 400 + "password=abcdefgh " * 400, "s0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id, r.spans) for r in secrets.digest(secrets.classify(docs)).collect())
    assert got == plain_secrets(rows) and any("token:" in s for _, s in got)


def test_passages_of_words(spark):
    """Words in passages that another document has too, of any number of bytes."""
    rng = np.random.default_rng(6)
    make = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    passage, own = make(60), make(60)
    texts = [" ".join(make(80) + passage + make(10)), " ".join(passage + make(3)), "\n".join(passage[:50]), " ".join(own + make(30) + own), " ".join(passage[5:56]), None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for size in (4 << 20, 300):
        got = {r.doc_id: r.n_passage_words for r in repeats.remove_repeats(docs, 400, size).collect()}
        assert got == {0: 60, 1: 60, 2: 0, 3: 0, 4: 51, 5: 0, 6: 0}


def test_warc_appends_and_overwrites(spark):
    pages = lambda a, z: spark.createDataFrame([(k, f"http://h/{k}\r\n é", f"<p>{k}</p>" * 30, "x") for k in range(a, z)], "page_id long, url string, html string, record_type string")
    path = shared.scratch(spark, "w")
    for a, z, mode, want in ((0, 2, "append", {0, 1}), (2, 4, "append", {0, 1, 2, 3}), (9, 12, "overwrite", {9, 10, 11}), (12, 13, "append", {9, 10, 11, 12})):
        warc.write_warc(warc.to_records(pages(a, z)), path, mode)
        got = warc.read_warc(spark, path).collect()
        assert {int(r.page_id) for r in got} == want and all(r.target_uri == f"http://h/{r.page_id}\r\n é" and r.payload == b"<p>%d</p>" % int(r.page_id) * 30 for r in got)
    assert {r.page_id for r in warc.read_warc(spark, path).filter("record_type IN ('response') AND page_id IN ('9', '12')").collect()} == {"9", "12"}


def test_warc_without_ids(spark):
    long = "<p>é</p>" * 200_000
    pages = spark.createDataFrame([(None, "u0", long), (5, "u5", long), (3, "u3", long), (None, None, "b" * 200), (None, "u", "b" * 200)], "page_id long, url string, html string")
    path = shared.scratch(spark, "w")
    warc.write_warc(warc.to_records(pages), path)
    got = sorted(((r.page_id or "", r.record_type, r.refers_to, r.refers_to_uri, int(r.payload_bytes)) for r in warc.read_warc(spark, path).collect()), key=str)
    size = len(long.encode())
    assert got == sorted([("", "revisit", "3", "u3", size), ("5", "revisit", "3", "u3", size), ("3", "response", None, None, size), ("", "response", None, None, 200), ("", "response", None, None, 200)], key=str)


def test_top_k_of_alike_vectors(spark):
    """Repeated ids and rows, one vector in a third of all rows, large components, fewer candidates than asked for."""
    rng = np.random.default_rng(9)
    v = [[int(x) for x in rng.integers(-60, 61, 5)] for _ in range(300)] + [[7, 7, 7, 7, 7]] * 200 + [[10**9, -(10**9), 3, 2, 1], [10**9, 5, 5, 5, 5]]
    rows = [(k if k < 250 else 250, x) for k, x in enumerate(v)] + [(900, [1, 2]), (920, [3, 4]), (940, [5])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(4)
    queries = df.filter("vec_id % 20 = 0")
    own = {}
    for i, x in rows:
        if i % 20 == 0:
            own[i] = min(own.get(i, x), x)
    want = []
    for i, q in own.items():
        best = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in rows if j != i and len(x) == len(q))[:20]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert sorted(map(tuple, metric_tree.top_k(queries, df).collect())) == sorted(want)


def test_decontamination_without_broadcasts(spark, prose):
    """The same rows whether Spark sends small sides to all executors or shuffles both."""
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    first = sorted(map(str, decontamination.decontaminate(prose, bench).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    old, decontamination.SALT = decontamination.SALT, 3
    try:
        assert sorted(map(str, decontamination.decontaminate(prose, bench).collect())) == first
    finally:
        decontamination.SALT = old
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_proximity(spark):
    texts = ["a x x b", "b a", "a x x x x b", "a a", None, "b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near = lambda *x: sorted(map(tuple, decontamination.near(docs, *x).collect()))
    assert near("a", "b", 3) == [(0, 0), (1, 1)] and near("a", "a", 1) == [(3, 0), (3, 1)] and near("b", "zzz", 5) == []


def test_scratch_needs_a_shared_folder(spark):
    """The path lies below the session's setting."""
    assert shared.scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared.fresh(["A", "_a"], "a", "b") == ["__a", "b"]
    assert hashlib.blake2b(b"").digest_size == 64


def test_token_files_of_any_text(spark):
    """Pieces of every kind, ids of any sign, repeated ids over many files, and a vocabulary of another kind."""
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = np.random.default_rng(3)
    marks = [chr(c) for c in range(1, 256)] + ["'s", "'ll", "''d", "don't", " ", "\n", "<|endoftext|>", "漢", "İ", "é", "½", "á", " "]
    texts = ["".join(rng.choice(marks, 50)) for _ in range(300)] + ["Ça va? L'été n'est pas fini..., ouç,", "x" * 5000, None, ""]
    rows = [(int(rng.integers(-(2**62), 2**62)) if k % 3 else 7 if k % 2 else None, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string").repartition(4)
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        library, path = Tokenizer.from_file(public_tokenizers.path(name)), shared.scratch(spark, "t")
        files = token_files.write_tokens(docs, public_tokenizers.path(name), path, shard_bytes=4000)
        got = sorted(map(tuple, token_files.read_tokens(spark, path).collect()), key=lambda r: r[1])
        want = sorted(((i is not None, i or 0), zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())) for i, t in rows)
        assert len(files) > 3 and sorted(((i is not None, i or 0), c) for i, _, _, c in got) == want
        assert [(i is not None, i or 0) for i, *_ in got] == [k for k, _ in want] and [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()]
    with open(f"{path.removeprefix('file:')}/{files[-1][0]}", "rb") as f:
        shard = token_files.Shard(f)
        assert [shard.doc_id(k) for k in range(shard.n)] == shard.doc_ids and [shard.bounds(k) for k in range(shard.n)] == list(zip([0, *shard.ends.all().tolist()], shard.ends.all().tolist()))


def test_urls_of_any_kind(spark):
    """Repeated pages, ports, addresses, suffixes of two labels, long urls, extra columns, and rules of any depth."""
    urls = ["http://A.b.co.kr:80/x", "http://10.0.0.1/x", "http://[::1]:8080/x", "http://shop.com.tr", "://x.github.io?q", "ftp://a.EXAMPLE.com/de/x#f", "http://a.example.net/en/", "http://sub.org/fr/" + "y" * 100_000, "http:///only", None, "no url", "http://host:99"]
    rows = [(k, u) for k, u in enumerate(urls)] * 2
    pages = spark.createDataFrame([(k, u, "x", "y", "z") for k, u in rows], "page_id long, url string, domain string, host string, bad string")
    labels = spark.createDataFrame([(0, 1, 5), (0, 0, 5), (None, 1, 5), (99, 1, 5)], "page_id long, bad int, n int")
    got = [r.asDict() for r in url_reputation.judge(pages, labels).collect()]
    assert len(got) == len(rows) and {(r["page_id"], r["host"]) for r in got} >= {(0, "a.b.co.kr:80"), (2, "[::1]:8080"), (4, "x.github.io"), (8, ""), (9, ""), (10, "")}
    by = {r["page_id"]: r for r in got}
    assert by[5]["rule"] == "example.com/de/" and by[6]["rule"] == "example.net/en/" and by[7]["rule"] == "org/fr/" and len(by[7]["path"]) == 100_004 and by[9]["rule"] is None
    host = F.col("h")
    parts = spark.createDataFrame([("a.b.co.kr:80",), ("10.0.0.1",), ("[::1]:8080",), ("shop.com.tr",), ("x.github.io",), ("",), ("host:99",)], "h string").select("h", url_reputation.domain_of(host).alias("d"), url_reputation.suffix_of(host).alias("s"))
    assert {r.h: (r.d, r.s) for r in parts.collect()} == {"a.b.co.kr:80": ("b.co.kr", "co.kr"), "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "[::1]:8080": ("[::1]", "[::1]"), "shop.com.tr": ("shop.com.tr", "com.tr"), "x.github.io": ("github.io", "io"), "": ("", ""), "host:99": ("host", "host")}


def test_host_reputation_is_shrunk(spark):
    """One bad label doesn't block a host where most are middling; many do, and a host without labels takes its domain's rate."""
    rows = [(k, "http://bad.one.com/", int(k % 20 > 0)) for k in range(100)] + [(300, "http://few.three.com/", 1), (301, "http://new.one.com/", None)]
    rows += [(1000 + 20 * d + k, f"http://h{d}.d{d}.com/", int(k < 5 + d % 5)) for d in range(40) for k in range(20)]
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "page_id long, bad int")
    found = {r.host: r for r in url_reputation.reputation(pages, labels).collect()}
    verdict = {r.host: r.verdict for r in url_reputation.judge(pages, labels).collect()}
    assert {h for h, v in verdict.items() if v == "block"} >= {"bad.one.com"} and verdict["few.three.com"] == "allow" and verdict["h3.d3.com"] == "allow"
    assert found["h3.d3.com"].p_bad < found["few.three.com"].p_bad < found["bad.one.com"].p_bad and found["new.one.com"].p_bad > 0.5


def test_near_duplicates_of_buckets_of_any_size(spark, monkeypatch):
    """With so few bands that many linked pairs share just one, the size from which buckets are hot changes nothing."""
    monkeypatch.setattr(near_duplicates, "MISS", 0.2)
    rng, rows = np.random.default_rng(5), []
    for family in range(5):
        base = [f"w{family}x{k}" for k in range(120)]
        for k in range(12):
            text = list(base)
            for at in rng.integers(0, 120, 1 + k % 2):
                text[at] = f"v{rng.integers(10**9)}"
            rows.append((family * 100 + k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").cache()
    found = [{r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs, 3, 85, hot, 3).collect()} for hot in (near_duplicates.HOT, 1)]
    assert found[0] == found[1]
    assert len(set(found[0].values())) < len(rows)
