"""MinHash near-duplicates with odd sketches, verified on full sets.

A document's set is its distinct word shingles (of the whole sequence, where it has fewer
words). Documents with equal sets form a class, so copies are never expanded. Classes that
share a band of MinHash values are compared:

1. each with the least class of the bucket only, so a bucket costs as many pairs as it has
   members. Odd sketches (parity bitmaps of the MinHash samples, whose XOR has as many ones
   as the samples differ) leave out pairs far below the threshold, and so does an odd sketch of
   the whole set, whose XOR never has more ones than the sets differ in; sets decide the rest.
2. Components of these links. A bucket within one component needs no more. In others,
   classes of different components are compared if the triangle inequality of the Jaccard
   distance, through the bucket's least class, allows a link: by bins of the distance to it
   (classes whose distance wasn't measured meet all bins). Larger bins are cut into pieces of
   PIECE classes, compared piece by piece in tasks of their own. Of all these pairs only those
   that share two bands count. So those of buckets with over HOT members are looked for by
   both bands at once; that and the pieces change the work, and never which pairs are found.

Bands have 8 values; there are as many that a pair at the threshold shares fewer than two with
a chance of 1e-7 (61 for 0.85, 105 for 0.8). Sketches leave out linked pairs with less than 1e-7.

Shingles are compared by 64-bit codes (see shared.word_codes), and links that these show are
confirmed on the words themselves; so are the classes of sets of up to FEW shingles, while
larger equal sets have equal codes of all their shingles.

Null doc_ids take part; null and empty texts link with nothing. Repeated rows of a doc_id
are alike. An empty table gives none; extra columns go, but for keep_one. Components are found by
large-star and small-star steps over written tables, until nothing changes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

#: MinHash values of a band, bits of the sketches of samples and of whole sets, and the chance that linked sets share fewer than two bands.
ROWS, SKETCH_BITS, WHOLE_BITS, MISS = 8, 1280, 512, 1e-7
#: Members of a bucket, and of a bin's piece, up to which they are compared in one go; pairs that share one copy of a set; shingles of a set whose words make its class.
HOT, PIECE, COPIES, FEW = 8192, 2048, 64, 16
_P, _Q = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit codes of each text's shingles."""
    data, offsets = shared.text_bytes(column)
    n = len(offsets) - 1
    data = _LOWER[data]
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], word[:-1]]) if len(word) else word
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.concatenate([word[1:], [False]]) if len(word) else word
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    codes = shared.word_codes(data, starts, ends)
    first = np.searchsorted(starts, offsets)  # of each text's words
    many = np.diff(first)
    long = max(0, len(codes) - width + 1)
    each = np.zeros(long, np.uint64)
    for k in range(width):
        each = shared.mix(each * _P + codes[k : k + long] + _Q)
    out = []
    for i in range(n):
        a, m = first[i], many[i]
        if m >= width:
            out.append(shared.distinct(each[a : a + m - width + 1]))
        elif m:
            one = np.array([m], np.uint64)
            for k in range(a, a + m):
                one = shared.mix(one * _P + codes[k : k + 1] + _Q)
            out.append(one)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def true_shingles(raw: bytes, width: int) -> set[bytes]:
    """The shingles themselves. The white space between words is what bytes.split() cuts at."""
    words = raw.lower().split()
    return {b" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def digest(codes: np.ndarray, text: bytes, width: int) -> bytes | None:
    """The class of a set."""
    if not len(codes):
        return None
    whole = b"\n".join(sorted(true_shingles(text, width))) if len(codes) <= FEW else codes.tobytes()
    return hashlib.blake2b(whole, digest_size=16).digest()


def band_count(percent: int) -> int:
    """Bands of which sets at the threshold share fewer than two with a chance of MISS."""
    one, n = (percent / 100) ** ROWS, 2
    while (1 - one) ** n + n * one * (1 - one) ** (n - 1) > MISS:
        n += 1
    return n


def permutations(bands: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(977)
    odd = rng.integers(0, 2**31, bands * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd[:, None], rng.integers(0, 2**32, bands * ROWS, dtype=np.uint32)[:, None]


def parity(places: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap, as 64-bit words, of the places that occur an odd number of times."""
    return np.packbits((np.bincount(places.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def signature(codes: np.ndarray, odd: np.ndarray, add: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Band keys, and the odd sketches of the MinHash samples and of all codes, of a set that isn't empty."""
    low = np.full(len(odd), np.uint32(2**32 - 1))
    short = (codes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 512):
        part = short[None, at : at + 512] * odd
        part += add
        np.minimum(low, part.min(axis=1), out=low)
    wide = low.astype(np.uint64)
    keys = np.zeros(len(odd) // ROWS, np.uint64)
    for k in range(ROWS):
        keys = shared.mix(keys * _P + wide[k::ROWS] + _Q)
    places = shared.mix(wide + np.arange(len(odd), dtype=np.uint64) * _Q) % np.uint64(SKETCH_BITS)
    return keys.view(np.int64), parity(places, SKETCH_BITS), parity(shared.mix(codes) % np.uint64(WHOLE_BITS), WHOLE_BITS)


def most_ones(similarity: float, hashes: int, sigmas: float = 6.0) -> int:
    """XOR ones that sketches of sets at a similarity exceed with negligible probability."""
    differ = hashes * (1 - similarity) + sigmas * np.sqrt(hashes * similarity * (1 - similarity))
    odd = (1 - (1 - 2 / SKETCH_BITS) ** (2 * min(differ, hashes))) / 2
    return int(np.ceil(SKETCH_BITS * odd + 4 * np.sqrt(SKETCH_BITS * odd * (1 - odd))))


def _keyed(docs: DataFrame) -> DataFrame:
    return shared.small_batches(shared.with_columns(docs, "doc_id", "text")).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def signatures(docs: DataFrame, width: int, bands: int) -> DataFrame:
    """doc_id, text_key, n_shingles, node (the set's digest; null if empty), bands, sketch, whole."""

    odd, add = permutations(bands)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = shingle_sets(part.column(2), width)
                texts = [(t.as_py() or "").encode() if len(s) <= FEW else b"" for t, s in zip(part.column(2), sets)]
                signed = [signature(s, odd, add) if len(s) else (None, None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([digest(s, t, width) for s, t in zip(sets, texts)], pa.binary()),
                        *(pa.array([x[k] for x in signed], pa.list_(pa.int64())) for k in range(3)),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "node", "bands", "sketch", "whole"],
                )

    return _keyed(docs).mapInArrow(run, "doc_id long, text_key long, n_shingles long, node binary, bands array<long>, sketch array<long>, whole array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node, codes (binary) and text of the wanted documents (doc_id, text_key, node), from their texts."""
    rows = _keyed(docs).join(wanted.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "node"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))).select("node", "text")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in shingle_sets(part.column(1), width)], pa.binary()), part.column(1)], names=["node", "codes", "text"])

    return rows.dropDuplicates(["node"]).mapInArrow(run, "node binary, codes binary, text string")


def _ones(a, b, bits: int):
    return sum((F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in range(bits // 64)), F.lit(0))


def with_both(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """a, b and the column of both. A node's copy serves COPIES pairs at most, so that a node of many pairs is in many tasks."""
    pairs = pairs.select("a", "b")
    copies = shared.materialise(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / COPIES).cast("int").alias("copies")), "copies")
    dealt = pairs.join(copies, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int").alias("copy"))
    left = sets.select(F.col("node").alias("a"), F.col(column).alias("x")).join(copies, "a").select("a", "x", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    right = sets.select(F.col("node").alias("b"), F.col(column).alias("y"))
    return dealt.join(left, ["a", "copy"]).join(right, "b").select("a", "b", "x", "y")


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with shared and total, the sizes of their sets' intersection and union, by codes."""

    def run(batches):
        for batch in batches:
            shared_n, total = [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                shared_n.append(both)
                total.append(len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared_n, pa.int64()), pa.array(total, pa.int64())], names=["a", "b", "shared", "total"])

    return with_both(pairs, sets, "codes").mapInArrow(run, "a binary, b binary, shared long, total long")


def confirm(pairs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """Those pairs (a, b) whose true shingles are as alike as asked."""

    def run(batches):
        for batch in batches:
            kept = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = true_shingles(x.as_py().encode(), width), true_shingles(y.as_py().encode(), width)
                both = len(x & y)
                kept.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return with_both(pairs, sets, "text").mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """node and comp (the least node of its component) of all nodes with links (a, b)."""

    def state(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    edges = shared.materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    last = state(edges)
    while last[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written first, as a join with an aggregate of its own input can't be split where a node has most links
        least = shared.materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # a node's own least goes along, or it would lose its only smaller neighbour
        large = shared.materialise(large.unionByName(least.filter("m < a").select("a", F.col("m").alias("b"))).distinct(), "large")
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(floor, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct()
        grown = shared.materialise(small, "links")
        now = state(grown)
        shared.discard(least)
        shared.discard(large)
        shared.discard(edges)
        edges = grown
        if now == last:
            break
        last = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(roots)


def grouped(docs: DataFrame, width: int, percent: int, hot: int = HOT, piece: int = PIECE) -> DataFrame:
    """doc_id, text_key, n_shingles, node and comp (class and component; null without words), component_id of every row."""
    if not 80 <= percent <= 100:
        raise ValueError("percent must lie between 80 and 100, which the bands are set for")
    far, bands = 1 - percent / 100, band_count(percent)
    hashes = bands * ROWS
    signed = shared.materialise(signatures(docs, width, bands), "signatures")
    classes = signed.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_key")).alias("rep"), F.first("bands").alias("bands"), F.first(F.struct("n_shingles", "sketch", "whole")).alias("sketch"))
    classes = shared.materialise(classes, "classes")
    banded = classes.select("node", F.posexplode("bands").alias("band", "key"))
    leaders = shared.materialise(banded.groupBy("band", "key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "leaders")
    members = shared.materialise(banded.join(leaders.drop("n"), ["band", "key"]), "members")
    wanted = members.select("node").distinct().join(classes, "node").select("rep.doc_id", "rep.text_key", "node")
    sets = shared.materialise(full_sets(docs, wanted, width), "sets")
    sketches = classes.select("node", "sketch")

    def alike(a, b, least):
        """False only of pairs below a similarity in percent: a bit of the whole sets' sketches differs only where an element does."""
        differ = _ones(a["whole"], b["whole"], WHOLE_BITS) * (100 + least) <= (a["n_shingles"] + b["n_shingles"]) * (100 - least)
        return differ & (_ones(a["sketch"], b["sketch"], SKETCH_BITS) <= most_ones(least / 100, hashes))

    linked = F.col("shared") * 100 >= F.col("total") * percent
    # pairs that a sketch puts beyond twice the distance of a link are far from the leader without a closer look
    stars = members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    close = stars.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a").join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b").filter(alike(F.col("sa"), F.col("sb"), 2 * percent - 100))
    close = shared.materialise(close.select("a", "b"), "close")
    measured = shared.materialise(verify(close, sets), "measured")
    links = shared.materialise(confirm(measured.filter(linked), sets, width, percent), "confirmed")
    comps = components(links)

    comp = F.coalesce("comp", "node")
    open_ = members.join(comps, "node", "left").withColumn("comp", comp)
    mixed = open_.groupBy("band", "key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("size")).filter("x <> y").select("band", "key", "size")
    mixed = shared.materialise(mixed, "mixed")
    distance = measured.select(F.col("a").alias("leader"), F.col("b").alias("node"), (1 - F.col("shared") / F.col("total")).alias("d"))
    # bins as wide as a link's distance: linked classes lie in the same or in neighbouring ones; beyond the second all are one, and those not measured are the last
    bin_ = F.coalesce(F.least(F.lit(2), F.floor(F.col("d") / F.lit(far + 1e-9))), F.lit(3)).cast("int")
    small = open_.join(mixed.filter(F.col("size") <= hot), ["band", "key"]).join(distance, ["leader", "node"], "left").filter("node <> leader")
    places = small.select(F.xxhash64("band", "key").alias("place"), "node", "comp", bin_.alias("bin"), "size")
    if not (large := mixed.filter(F.col("size") > hot)).isEmpty():
        # pairs whose second band is that of a smaller bucket are met there
        in_hot = open_.join(large, ["band", "key"]).select("node", "comp", "band", "key")
        other = in_hot.select("node", F.col("band").alias("band2"), F.col("key").alias("key2"))
        twice = in_hot.join(other, "node").filter("band < band2").select(F.xxhash64("band", "key", "band2", "key2").alias("place"), "node", "comp")
        twice = shared.materialise(twice, "hot")
        again = twice.groupBy("place").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("size")).filter("x <> y").select("place", "size")
        places = places.unionByName(twice.join(shared.materialise(again, "hot-sizes"), "place").select("place", "node", "comp", F.lit(3).alias("bin"), "size"))
    pieces = F.ceil(F.col("size") / piece).cast("int")
    placed = places.join(sketches, "node").select("place", "node", "comp", "bin", "sketch", pieces.alias("pieces"))
    near = F.when(F.col("bin") < 2, F.array(F.col("bin"), F.col("bin") + 1, F.lit(3))).when(F.col("bin") == 2, F.array(F.lit(2), F.lit(3))).otherwise(F.array(F.lit(3)))
    probes = placed.withColumn("bin", F.explode(near))
    probes = probes.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    other = placed.select("place", "bin", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int").alias("piece"), F.col("node").alias("b"), F.col("comp").alias("comp_b"), F.col("sketch").alias("sketch_b"))
    # the sketches are compared within the join, which so gives only pairs that may be linked
    met = (F.col("comp") != F.col("comp_b")) & alike(F.col("sketch"), F.col("sketch_b"), percent)
    cross = probes.join(other, ["place", "bin", "piece"]).filter(met).select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    # the same for buckets of any size: two bands are shared
    both = cross.join(classes.select(F.col("node").alias("a"), F.col("bands").alias("x")), "a").join(classes.select(F.col("node").alias("b"), F.col("bands").alias("y")), "b")
    cross = shared.materialise(both.filter(F.size(F.filter(F.zip_with("x", "y", lambda x, y: x == y), lambda same: same)) >= 2).select("a", "b"), "cross")
    if not cross.isEmpty():
        met = shared.materialise(verify(cross, sets).filter(linked), "met")
        more = shared.materialise(confirm(met, sets, width, percent), "more")
        if not more.isEmpty():
            comps = components(links.unionByName(more))

    ids = classes.select("node", "least").join(comps, "node", "left").withColumn("comp", comp)
    smallest = ids.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = ids.join(smallest, "comp").select("node", "comp", "component_id")
    rows = signed.select("doc_id", "text_key", "n_shingles", "node").join(named, "node", "left")
    return rows.withColumn("component_id", F.coalesce("component_id", "doc_id"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, hot: int = HOT, piece: int = PIECE) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept of every row.

    Documents are linked if 100 * intersection >= percent * union, with percent 80 or more.
    component_id is the smallest doc_id that is reachable; kept is whether it's the row's own
    (true also where no document of the component has an id).
    """
    component = F.col("component_id")
    rows = grouped(docs, width, percent, hot, piece)
    return rows.select("doc_id", "text_key", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group: that with the smallest doc_id (nulls last), and of several such texts or rows one.

    Documents without words are linked with nothing and all stay.
    """
    rows = shared.materialise(grouped(docs, width, percent).select("doc_id", "text_key", "comp"), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    chosen = rows.filter("comp IS NOT NULL").groupBy("comp").agg(F.min(order).alias("o")).select("comp", "o.doc_id", "o.text_key")
    # whether the chosen row is repeated; that is rare, and only then its texts are shuffled
    mine = rows.alias("r").join(chosen.alias("c"), (F.col("r.comp") == F.col("c.comp")) & F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("r.text_key") == F.col("c.text_key"))).select("r.doc_id", "r.text_key")
    counted = shared.materialise(mine.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")), "chosen")
    wordless = rows.filter("comp IS NULL").select("doc_id", "text_key").distinct()
    once, _ = shared.by_row(docs, counted.filter("n = 1").drop("n").unionByName(wordless), "left_semi")
    if (several := counted.filter("n > 1").drop("n")).isEmpty():
        return once
    repeated, _ = shared.by_row(docs, several, "left_semi")
    return once.unionByName(repeated.dropDuplicates(["doc_id", "text"]))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(shared.table(spark, sf_dir, "documents"), width=3, percent=85).drop("text_key")
