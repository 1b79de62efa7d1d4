"""Secret scans: spans of credentials, and how widely each candidate is owned.

The scan finds three base kinds with fixed patterns, and opaque tokens as further
candidates. Corpus-wide, each candidate's hash is counted by distinct repositories and
owners (first by hash and owner, so that a value copied everywhere is summed before it is
shuffled by hash alone). A value that one owner has looks live; one that many owners have
is a copied example. Tokens that look live and random are added as spans of kind token.

A repository is a document and an owner its source, unless other columns are named; a null
owner counts as one owner. Null texts are empty, and empty tables give empty ones. Repeated
rows get the same spans, and are one repository. Ties of start are in the kinds' order. Long
texts are scanned whole. Spans are in code points, end exclusive. Extra columns, whatever
their names, stay in redact and go elsewhere.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

#: Fixed values of the contract: the kinds in their order, their patterns, and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "token")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: The method's own candidates: opaque tokens with letters and digits, and their least entropy in bits a character.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{24,}")
LEAST_ENTROPY = 3.2
#: Filters that RE2 runs over a whole batch, so that few texts reach the exact patterns.
HINT_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']? *[:=]"""
HINT_TOKEN = r"[A-Za-z0-9+/_=-]{24}"


def entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values()) if n else 0.0


def find(text: str, assign: bool = True, access: bool = True, other: bool = True) -> list[tuple[int, int, int, str]]:
    """(start, kind's index, end, value) of base spans and tokens, in order. The flags only save time."""
    out = []
    if assign:
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if access:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if other:
        out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
        base, k, reach = sorted((s, e) for s, _, e, _ in out), 0, 0  # reach: the end of the base spans that begin before a token's end
        for m in TOKEN.finditer(text):
            v, s, e = m[0], m.start(), m.end()
            while k < len(base) and base[k][0] < e:
                reach, k = max(reach, base[k][1]), k + 1
            if reach <= s and any(c.isdigit() for c in v) and any(c.isalpha() for c in v) and entropy(v) >= LEAST_ENTROPY:
                out.append((s, 3, e, v))
    return sorted(out)


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, owner, repository, found (array of start, kind, end, hash)."""
    schema = "doc_id long, owner string, repo string, text_key long, found array<struct<start:int,kind:int,end:int,hash:binary>>"
    found_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("hash", pa.binary())]))

    def run(batches):
        for batch in batches:
            text = pc.fill_null(batch.column(4), "")
            hints = zip(pc.match_substring_regex(text, HINT_ASSIGN, ignore_case=True).to_pylist(), pc.match_substring(text, "AKIA").to_pylist(), pc.match_substring_regex(text, HINT_TOKEN).to_pylist())
            found = []
            for k, flags in enumerate(hints):
                spans = find(text[k].as_py(), *flags) if any(flags) else []
                found.append([{"start": s, "kind": kind, "end": e, "hash": hashlib.sha256(v.encode()).digest()[:16]} for s, kind, e, v in spans])
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(found, found_type)], names=["doc_id", "owner", "repo", "text_key", "found"])

    return shared.small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{owner}`").cast("string"), F.lit("")).alias("owner"), F.coalesce(F.col(f"`{repository}`").cast("string"), F.lit("")).alias("repo"), F.xxhash64("text").alias("text_key"), "text"
    ).mapInArrow(run, schema)


def ownership(scanned: DataFrame) -> DataFrame:
    """hash, n_owners, n_repos of every candidate value."""
    each = scanned.select("owner", "repo", F.explode(F.array_distinct(F.col("found.hash"))).alias("hash"))
    pairs = each.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return owners.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"))


def classify(docs: DataFrame, owner: str = "source", repository: str = "doc_id", most_owners: int = 1) -> DataFrame:
    """One row per document: doc_id, owner, repo, spans (array of start, kind, end, live), in order.

    live: the value has at most most_owners owners, however many of their repositories hold
    it, and so is no copied example. Tokens that aren't live are left out; base spans always stay.
    """
    scanned = shared.materialise(scan(docs, owner, repository).withColumn("row", F.monotonically_increasing_id()), "secrets")
    # written first, so that Spark can split the spans of a value that most documents hold
    owned = shared.materialise(ownership(scanned).filter(F.col("n_owners") <= most_owners).select("hash", F.lit(True).alias("live")), "live")
    each = scanned.select("row", F.explode("found").alias("f")).select("row", "f.*")
    spans = each.join(owned, "hash", "left").select("row", "start", "kind", "end", F.coalesce("live", F.lit(False)).alias("live")).filter("live or kind < 3")
    grouped = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("spans"))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean>>")
    return scanned.select("row", "doc_id", "owner", "repo", "text_key").join(grouped, "row", "left").select("doc_id", "owner", "repo", "text_key", F.coalesce("spans", empty).alias("spans"))


def _joined(spans) -> F.Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(classified: DataFrame) -> DataFrame:
    spans = F.col("spans")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return classified.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.filter(spans, lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["live"])).cast("long").alias("n_live"),
    )


def redact(docs: DataFrame, mask: str = "[secret]", **options) -> DataFrame:
    """The documents, with every base or added span that looks live replaced by the mask.

    Spans that overlap are masked as one. n_chars, if there is one, is counted anew where
    the text changed. Copied examples stay, and documents without secrets are unchanged.
    """
    found = classify(docs, **options).select("doc_id", "text_key", F.filter("spans", lambda s: s["live"]).alias("live_spans")).filter(F.size("live_spans") > 0)
    found = found.groupBy("doc_id", "text_key").agg(F.first("live_spans").alias("live_spans"))  # repeated rows have the same spans
    joined, names = shared.by_row(docs, shared.materialise(found, "redactions"), "left")
    spans = F.col(names["live_spans"])

    def merge(acc, s):
        last = F.element_at(acc, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] >= s["start"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))).otherwise(F.concat(acc, F.array(s)))

    plain = F.transform(F.array_sort(spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    runs = F.aggregate(plain, F.array().cast("array<struct<start:int,end:int>>"), merge)
    built = F.aggregate(
        runs,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(F.concat(acc["out"], F.substr("text", acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)).alias("out"), s["end"].alias("at")),
        lambda acc: F.concat(acc["out"], F.substr("text", acc["at"] + 1, F.length("text"))),
    )
    text = F.when(spans.isNotNull(), built).otherwise(F.col("text"))
    columns = [text.alias(c) if c == "text" else F.when(spans.isNotNull(), F.length(text)).otherwise(F.col(c)).cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(classify(shared.table(spark, sf_dir, "documents")))
