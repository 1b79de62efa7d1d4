"""Language identification by interpolated Kneser-Ney character models.

Texts are lower-cased, and each run of other characters than letters becomes one space. For
each language an order-4 model is fitted: absolute discounts by order from counts of counts,
and continuation counts below the highest order. Grams of all languages lie in one sorted
array of 64-bit hashes per order, beside a row of log probabilities with a column for each
language; a gram that no language has falls back by the rows of its context.

The language with the lowest cross-entropy per character wins. A confidence comes from a
temperature, and a limit of cross-entropy beyond which a text is rejected from a quantile,
both calibrated on labelled texts that weren't counted (where there are too few, on counted
ones). Shorter texts get more room, as their averages spread more.

The models are fitted to a sample: of each language whole texts of about fit_chars
characters, chosen by a hash of doc_id, and at least one document. Repeated rows of the
sample count once. Every text is scored whole. Null texts and texts without a letter are
``und``, with score 0, and rejected. With no labelled row, so too of an empty table, every
text is ``und``. Languages are the distinct non-null values of the language column; ties
of cross-entropy go to the first of them in order. Extra columns, whatever their names, stay
in keep_identified and go elsewhere.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

ORDER = 4
#: Characters a language, of counted and of calibrating texts, and documents of the latter.
FIT_CHARS, CALIBRATE_CHARS, CALIBRATE_DOCS = 1_500_000, 400_000, 20_000
_M = np.uint64(0xD6E8FEB86659FD93)
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """By code point, whether it's a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def normalise(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, each after order - 1 spaces; the text of each; which of them count."""
    low = [t.lower() for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(low)), [len(t) for t in low])
    letter = letters()[points]
    if not len(points):
        return np.full(0, 32, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    same = np.concatenate([[False], owner[1:] == owner[:-1]])
    after_letter = np.concatenate([[False], letter[:-1]]) & same
    keep = letter | after_letter  # of a run of others the first, unless it begins the text
    points, owner = np.where(letter, points, 32)[keep], owner[keep]
    pad = order - 1
    place = np.arange(len(points)) + (owner + 1) * pad
    out = np.full(len(points) + len(low) * pad, 32, np.int64)
    out[place] = points
    text = np.zeros(len(out), np.int64)
    text[place] = owner
    counts = np.zeros(len(out), bool)
    counts[place] = True
    return out, text, counts


def gram_hashes(points: np.ndarray, order: int = ORDER) -> list[np.ndarray]:
    """For k from 1 to order, hashes of the k characters that end at each place."""
    out, h, power = [], np.zeros(len(points), np.uint64), np.ones(1, np.uint64)
    values = points.astype(np.uint64) + np.uint64(1)
    for k in range(order):
        shifted = np.concatenate([np.zeros(k, np.uint64), values])[: len(values)]
        h = h + shifted * power
        power = power * _M
        out.append(shared.mix(h + np.uint64(k)))
    return out


def _hash_grams(grams: list[str]) -> np.ndarray:
    """The hashes of strings of one length, as gram_hashes gives them."""
    k = len(grams[0])
    points = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(grams), k)
    return gram_hashes(points.ravel().astype(np.int64), k)[k - 1][k - 1 :: k] if k else np.zeros(0, np.uint64)


@dataclass
class Model:
    """Sorted hash arrays by order with rows of log probabilities; calibration."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    unseen: np.ndarray
    temperature: float = 20.0
    limit: float = math.inf

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character by text and language, and the number of characters."""
        order = len(self.grams)
        points, owner, counts = normalise(texts, order)
        hashes = gram_hashes(points, order)
        place = np.flatnonzero(counts)
        total = np.zeros((len(texts), len(self.languages)))
        n = np.bincount(owner[place], minlength=len(texts))
        for at in range(0, len(place), 1 << 18):
            here = place[at : at + (1 << 18)]
            logs = np.zeros((len(here), len(self.languages)), np.float32)
            left = np.arange(len(here))
            for k in range(order, 0, -1):
                row, found = find(self.grams[k - 1][0], hashes[k - 1][here[left]])
                logs[left[found]] += self.grams[k - 1][1][row[found]]
                left = left[~found]
                if not len(left):
                    break
                if k > 1:
                    row, found = find(self.contexts[k - 1][0], hashes[k - 2][here[left] - 1])
                    logs[left[found]] += self.contexts[k - 1][1][row[found]]
            logs[left] += self.unseen
            who = owner[here]
            first = np.flatnonzero(np.diff(who, prepend=-1))
            total[who[first]] -= np.add.reduceat(logs, first, axis=0, dtype=np.float64)
        return total / np.maximum(n, 1)[:, None], n

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, confidence, lowest cross-entropy and whether it's rejected."""
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts), bool)
        h, n = self.entropies(texts)
        best = h.argmin(axis=1)
        lowest = h[np.arange(len(texts)), best]
        score = 1 / np.exp(-self.temperature * (h - lowest[:, None])).sum(axis=1)
        rejected = (n == 0) | (lowest > self.limit + 4.5 / np.sqrt(np.maximum(n, 1)))
        return [self.languages[b] if c else "und" for b, c in zip(best, n)], np.where(n > 0, score, 0.0), lowest, rejected


def find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return at, table[at] == values if len(table) else np.zeros(len(values), bool)


def fit(counted: dict[str, dict[str, int]], order: int = ORDER) -> Model:
    """From the counts of grams of the highest order, by language."""
    languages = sorted(counted)
    counts: list[dict[str, Counter]] = [{} for _ in range(order + 1)]
    counts[order] = {lang: Counter(c) for lang, c in counted.items()}
    for k in range(order - 1, 0, -1):
        counts[k] = {lang: Counter(g[1:] for g in counts[k + 1][lang]) for lang in languages}
    alphabet = {g for lang in languages for g in counts[1][lang]}
    floor = 1.0 / (len(alphabet) + 1)
    below: dict[str, list[float]] = {}  # probabilities one order below, by gram
    grams, contexts = [], []
    for k in range(1, order + 1):
        totals = [defaultdict(int) for _ in languages]
        kinds = [defaultdict(int) for _ in languages]
        discounts = []
        for j, lang in enumerate(languages):
            for g, c in counts[k][lang].items():
                totals[j][g[:-1]] += c
                kinds[j][g[:-1]] += 1
            n1, n2 = (sum(c == x for c in counts[k][lang].values()) for x in (1, 2))
            discounts.append(min(max(n1 / (n1 + 2 * n2), 0.1), 0.9) if n1 else 0.5)
        gammas = {c: [discounts[j] * kinds[j][c] / totals[j][c] if c in totals[j] else 1.0 for j in range(len(languages))] for c in sorted({c for t in totals for c in t})}
        here: dict[str, list[float]] = {}
        for g in sorted({g for lang in languages for g in counts[k][lang]}):
            c, rest = g[:-1], below[g[1:]] if k > 1 else [floor] * len(languages)
            gamma = gammas[c]
            here[g] = [(max(counts[k][lang][g] - discounts[j], 0.0) / totals[j][c] if c in totals[j] else 0.0) + gamma[j] * rest[j] for j, lang in enumerate(languages)]
        grams.append(_sorted(here))
        contexts.append(_sorted(gammas) if k > 1 else (np.zeros(0, np.uint64), np.zeros((0, len(languages)), np.float32)))
        if k == 1:
            unseen = np.log(np.array(gammas.get("", [1.0] * len(languages))) * floor).astype(np.float32)
        below = here
    return Model(languages, grams, contexts, unseen)


def _sorted(rows: dict[str, list[float]]) -> tuple[np.ndarray, np.ndarray]:
    keys = list(rows)
    hashes = _hash_grams(keys)
    order = np.argsort(hashes)
    return hashes[order], np.log(np.maximum(np.array([rows[k] for k in keys]), 1e-12)).astype(np.float32)[order]


def is_held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, fit_chars: int = FIT_CHARS, calibrate_chars: int = CALIBRATE_CHARS, order: int = ORDER) -> Model:
    """Fit to the labelled rows that aren't held out. Sums by language, and grams of the sample, come to the driver."""
    rows = shared.small_batches(shared.with_columns(docs, "doc_id", "text", "lang")).filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("doc_id")))
    u = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = rows.withColumn("u", u)
    sizes = rows.groupBy("lang").agg(F.sum(F.length("text").cast("long")).alias("n"), F.count(F.lit(1)).alias("docs"), F.min("u").alias("least")).collect()
    if not sizes:
        return Model([], [], [], np.zeros(0))
    # the share of a language's documents; a language of few long ones has the one of the least hash at any rate
    shares = {r["lang"]: max(min(1.0, fit_chars / max(r["n"], 1)), r["least"] + 2.0**-31) for r in sizes}
    more = {r["lang"]: shares[r["lang"]] + min(calibrate_chars / max(r["n"], 1), CALIBRATE_DOCS / r["docs"]) for r in sizes}
    share, also = (F.create_map(*[F.lit(x) for pair in m.items() for x in pair]) for m in (shares, more))
    rows = rows.filter(F.col("u") < F.try_element_at(also, F.col("lang"))).dropDuplicates(["doc_id", "lang", "text"])
    counted = rows.filter(F.col("u") < F.try_element_at(share, F.col("lang"))).select("lang", "text")

    def count(batches):
        for batch in batches:
            by = defaultdict(list)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by[lang].append(text)
            for lang, texts in by.items():
                points, _, counts = normalise(texts, order)
                last = np.flatnonzero(counts)
                if not len(last):
                    continue
                each = np.stack([points[last - order + 1 + k] for k in range(order)], axis=1).astype("<u4")
                kinds, n = np.unique(np.ascontiguousarray(each).view(f"V{4 * order}").ravel(), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array([k.tobytes().decode("utf-32-le", "surrogatepass") for k in kinds]), pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    by: dict[str, dict[str, int]] = {}
    for r in counted.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toLocalIterator():
        by.setdefault(r["lang"], {})[r["gram"]] = r["n"]
    if not by:
        return Model([], [], [], np.zeros(0))
    model = fit(by, order)
    rest = rows.filter(F.col("u") >= F.try_element_at(share, F.col("lang"))).select("lang", "text")
    seen = _measured(rest, model)
    calibrate(model, seen if len(seen) >= 50 else seen + _measured(counted, model))
    return model


def _measured(rows: DataFrame, model: Model) -> list[tuple[int, list[float], int]]:
    """(index of the label, cross-entropies, characters) of a bounded sample's texts."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        for batch in batches:
            h, n = model.entropies([t or "" for t in batch.column(1).to_pylist()])
            labels = [model.languages.index(x) if x in model.languages else -1 for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(list(h), pa.list_(pa.float64())), pa.array(n, pa.int64())], names=["label", "h", "n"])

    return [(r["label"], r["h"], r["n"]) for r in rows.mapInArrow(run, "label int, h array<double>, n long").collect() if r["n"] and r["label"] >= 0]


def calibrate(model: Model, seen: list[tuple[int, list[float], int]], quantile: float = 0.999) -> None:
    """The temperature with the least log loss; the limit a quarter of the way from the quantile to a uniform guess."""
    if not seen:
        return
    h = np.array([x for _, x, _ in seen])
    label = np.array([x for x, _, _ in seen])

    def loss(t):
        z = -t * (h - h.min(axis=1, keepdims=True))
        return float(np.mean(np.minimum(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(h)), label], 20.0)))

    model.temperature = min((2.0**k for k in range(0, 9)), key=loss)
    high = float(np.quantile(h.min(axis=1), quantile))
    model.limit = high + 0.25 * max(0.0, -float(model.unseen.min()) - high)


FOUND = ("lang_pred", "score", "cross_entropy", "rejected")


def identify(docs: DataFrame, model: Model, *columns: str) -> DataFrame:
    """The named columns of every row, with lang_pred, score, cross_entropy and rejected, renamed if a column has the name."""
    found = shared.fresh(list(columns), *FOUND)
    kept = shared.small_batches(docs).select(*[F.col(f"`{c}`") for c in columns], F.col("text").alias(shared.fresh(list(columns), "text")[0]))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + [f"{n} {kind}" for n, kind in zip(found, ("string", "double", "double", "boolean"))])
    names = [*columns, *found]

    def run(batches):
        model = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                lang, score, low, rejected = model.predict([t or "" for t in part.column(part.num_columns - 1).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(lang), pa.array(score), pa.array(low), pa.array(rejected)], names=names)

    return kept.mapInArrow(run, schema)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents that the models, fitted to these documents, don't reject."""
    found = identify(docs, train(docs), *docs.columns)
    return found.filter(~F.col(found.columns[-1])).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    found = identify(docs, train(docs), "doc_id")
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
