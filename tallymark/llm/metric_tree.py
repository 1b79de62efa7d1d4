"""Exact top-k by inner product: best-first search in paged M-trees.

With an added coordinate sqrt(R^2 - |x|^2), R the largest norm, and 0 for queries, the
inner product is |q|^2 + R^2 minus the squared distance, over 2: the nearest vectors have
the highest products. Vectors go to cells by the nearest of some pivots, and a cell's vectors
to as many shards as bound a shard's share, however many vectors are alike. Each shard holds
an M-tree: pages of routing objects with covering radii, of leaves' entries, and the
distances of both to their parents. A block of queries opens pages by their least possible
distance, each query its own best page first, and a page only for those queries that the
triangle inequality doesn't rule out from stored distances, before it computes any.

Blocks of the stated queries go to the shards of their own cell first. Then each query goes
only to cells whose covering radius leaves room for a vector that beats its k-th score so
far, and brings that score along. A tree is sent once for SERVED blocks. Where vectors in
many dimensions lie far apart, no bound rules much out, and every block meets every shard.

Scores are exact integers. Vectors that are null, empty, or hold null or non-finite values,
and null ids, take no part. Vectors of different lengths are never compared. Repeated ids
are one query, by the least of their vectors; all rows of the query's id count as its own,
and each row of another id as a candidate. Ties go to smaller ids. Empty tables give no rows;
extra columns go.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import shared

#: Pivots of vectors of one length (a bounded sample), vectors of a shard, entries of a page, queries of a block, and blocks that a copy of a tree serves.
PIVOTS, SHARD, PAGE, BLOCK, SERVED = 32, 8192, 512, 512, 32
EXACT = 2**52
#: A score below all others.
NONE = -(2**62)


def integer_vectors(rows: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and v, the floors of scale times each component, of the rows that take part."""
    e = F.col("embedding")
    sound = F.col("vec_id").isNotNull() & (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = F.transform(e, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return shared.with_columns(rows, "vec_id", "embedding").filter(F.coalesce(sound, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).astype(np.int64).reshape(len(column), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of integers: floating-point units where these are exact."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def small(v: np.ndarray) -> np.ndarray:
    """In the least type that holds its values."""
    return v.astype(np.result_type(np.min_scalar_type(int(v.min(initial=0))), np.min_scalar_type(int(v.max(initial=0))))) if v.size else v


class Tree:
    """An M-tree of two levels of routing objects over leaf pages."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, norm2: float):
        order = np.argsort(ids, kind="stable")
        self.ids, self.v, self.norm2 = ids[order], v[order], norm2
        self.flat = self.v.astype(np.float64)
        self.exact = int(np.abs(self.v).max(initial=0)) ** 2 * max(1, v.shape[1]) < EXACT
        self.n2 = (self.flat * self.flat).sum(axis=1)
        self.lift = np.sqrt(np.maximum(norm2 - self.n2, 0))
        leaves = self._group(np.arange(len(ids)), PAGE)
        self.leaves = [self._page(m, self._leader(m)) for m in leaves]
        heads = np.array([p[0] for p in self.leaves])
        radii = np.array([p[2].max(initial=0) for p in self.leaves])
        inner = self._group(np.arange(len(heads)), max(2, int(len(heads) ** 0.5)), heads)
        self.inner = []
        for m in inner:
            lead = heads[m[0]]
            d = self.distance(heads[m], lead)
            self.inner.append((lead, m, d, radii[m], float((d + radii[m]).max())))

    def __getstate__(self) -> dict:
        return {k: small(x) if k == "v" else x for k, x in self.__dict__.items() if k != "flat"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.v = self.v.astype(np.int64)
        self.flat = self.v.astype(np.float64)

    def _leader(self, members: np.ndarray) -> int:
        """The member nearest to the mean."""
        mean = self.flat[members].mean(axis=0)
        return int(members[((self.flat[members] - mean) ** 2).sum(axis=1).argmin()])

    def distance(self, a: np.ndarray, b: int) -> np.ndarray:
        d2 = self.n2[a] + self.n2[b] - 2 * self.flat[a] @ self.flat[b] + (self.lift[a] - self.lift[b]) ** 2
        return np.sqrt(np.maximum(d2, 0))

    def _group(self, members: np.ndarray, size: int, at: np.ndarray | None = None) -> list[np.ndarray]:
        """Members in groups of at most size, by the nearest of evenly spaced seeds."""
        at = members if at is None else at
        if len(members) <= size:
            return [members] if len(members) else []
        seeds = at[members][:: max(1, -(-len(members) // (-(-len(members) // size))))]
        near = np.stack([self.distance(at[members], int(s)) for s in seeds]).argmin(axis=0)
        out = []
        for k in range(len(seeds)):
            m = members[near == k]
            out += [m[i : i + size] for i in range(0, len(m), size)]
        return out

    def _page(self, members: np.ndarray, lead: int) -> tuple[int, np.ndarray, np.ndarray]:
        d = self.distance(members, lead)
        order = np.argsort(d, kind="stable")
        return lead, members[order], d[order]

    def search(self, own: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores (a row for each query, NONE where there is none) of the k best that score at least floor."""
        qf = q.astype(np.float64)
        base = (qf * qf).sum(axis=1) + self.norm2
        room = 1e-6 * (1 + np.sqrt(base))
        exact = self.exact and int(np.abs(q).max(initial=0)) * int(np.abs(self.v).max(initial=0)) * max(1, q.shape[1]) < EXACT
        best, best_ids = np.full((len(q), k), NONE), np.full((len(q), k), np.iinfo(np.int64).max)
        bound = np.empty(len(q))  # on the distance, with room for rounding

        def reach(who, rows):
            return np.sqrt(np.maximum(base[who, None] - 2 * qf[who] @ self.flat[rows].T, 0))

        def tighten(who):
            least = np.maximum(best[who, -1], floor[who])
            bound[who] = np.where(least > NONE, np.sqrt(np.maximum(base[who] - 2 * least + 1e-7 * (1 + base[who]), 0)) + room[who], np.inf)

        def visit(leaf, who):
            head, members, parent = self.leaves[leaf]
            far = reach(who, [head])[:, 0]
            near = far - parent[-1] <= bound[who]
            who, far = who[near], far[near]
            if not len(who):
                return
            # the entries lie in order of their distance to the routing object
            a, z = np.searchsorted(parent, [(far - bound[who]).min(), (far + bound[who]).max()])
            members = members[max(0, a - 1) : z + 1]
            score = (qf[who] @ self.flat[members].T).astype(np.int64) if exact else q[who] @ self.v[members].T
            score[self.ids[members][None] == own[who, None]] = NONE
            row, col = np.nonzero((score >= np.maximum(best[who, -1], floor[who])[:, None]) & (score > NONE))
            if not len(row):
                return
            some, row_of = np.unique(row, return_inverse=True)
            at = who[some]
            rows = np.concatenate([np.repeat(np.arange(len(some)), k), row_of])
            scores, ids = np.concatenate([best[at].ravel(), score[row, col]]), np.concatenate([best_ids[at].ravel(), self.ids[members[col]]])
            order = np.lexsort((ids, -scores, rows))
            first = np.searchsorted(rows[order], np.arange(len(some)))
            order = order[(first[:, None] + np.arange(k)).ravel()]
            best[at], best_ids[at] = scores[order].reshape(-1, k), ids[order].reshape(-1, k)
            tighten(at)

        every = np.arange(len(q))
        tighten(every)
        d_inner = reach(every, [x[0] for x in self.inner])
        low = np.zeros((len(q), len(self.leaves)))  # least distances by what is stored of a leaf
        for d, (_, children, parent, radii, cover) in zip(d_inner.T, self.inner):
            low[:, children] = np.maximum(np.maximum(np.abs(d[:, None] - parent) - radii, (d - cover)[:, None]), 0)
        own_leaf = low.argmin(axis=1)
        for leaf in np.unique(own_leaf).tolist():
            visit(leaf, np.flatnonzero(own_leaf == leaf))
        low[every, own_leaf] = np.inf
        for leaf in np.argsort(low.min(axis=0), kind="stable").tolist():
            who = np.flatnonzero(low[:, leaf] <= bound)
            who = who[low[who, leaf] < np.inf]
            if len(who):
                visit(leaf, who)
        return best_ids, best


def assign(vectors: DataFrame, pivots: dict[int, np.ndarray], largest: dict[int, float], asked: bool) -> DataFrame:
    """vec_id, v, dim, cell (the nearest pivot) and d (how far it is), of queries or of candidates."""

    def run(batches):
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column(1)])
            for dim in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == dim))
                v, p = matrix(part.column(1)).astype(np.float64), pivots[dim].astype(np.float64)
                n2 = (v * v).sum(axis=1)
                lift = np.zeros(len(v)) if asked else np.sqrt(np.maximum(largest[dim] - n2, 0))
                p2 = (p * p).sum(axis=1)
                d2 = n2[:, None] + p2 - 2 * v @ p.T + (lift[:, None] - np.sqrt(np.maximum(largest[dim] - p2, 0))) ** 2
                cell = d2.argmin(axis=1)
                d = np.sqrt(np.maximum(d2[np.arange(len(v)), cell], 0))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([dim] * part.num_rows, pa.int32()), pa.array(cell, pa.int32()), pa.array(d)], names=["vec_id", "v", "dim", "cell", "d"])

    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<long>, dim int, cell int, d double")


SHARD_KEY = ["dim", "cell", "part"]


def serve(requests: DataFrame, trees: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: the k best of each shard for each query of the requests (dim, cell, part, block, data)."""
    copies = shared.materialise(requests.groupBy(*SHARD_KEY).agg(F.ceil(F.count(F.lit(1)) / SERVED).cast("int").alias("copies")), "copies")
    total = copies.agg(F.sum("copies")).first()[0] or 1
    dealt = requests.join(copies, SHARD_KEY).select(*SHARD_KEY, F.pmod(F.xxhash64("block"), F.col("copies")).cast("int").alias("copy"), F.lit(1).alias("kind"), "data")
    sent = trees.join(copies, SHARD_KEY).select(*SHARD_KEY, F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind"), F.col("tree").alias("data"))
    key = [*SHARD_KEY, "copy"]

    def run(batches):
        tree = None
        for batch in batches:
            for kind, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if kind == 0:
                    tree = pickle.loads(data.as_py())
                    continue
                ids, v, floor = pickle.loads(data.as_py())
                found, score = tree.search(ids, v.astype(np.int64), floor, k)
                row, col = np.nonzero(score > NONE)
                yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(found[row, col]), pa.array(score[row, col])], names=["query_id", "vec_id", "score"])

    both = sent.unionByName(dealt).repartition(int(total), *key).sortWithinPartitions(*key, "kind")
    return both.select("kind", "data").mapInArrow(run, "query_id long, vec_id long, score long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score of the k highest inner products of each query.

    Both have vec_id and v (integers). The driver gets, for each length of vectors, the
    largest norm and PIVOTS pivots, and the sizes and radii of their cells.
    """
    spark = candidates.sparkSession
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    largest = {r["dim"]: float(r["m"]) for r in candidates.groupBy(F.size("v").alias("dim")).agg(F.max(norm).alias("m")).collect()}
    schema = "query_id long, rank int, vec_id long, score long"
    if not largest:
        return spark.createDataFrame([], schema)
    pivots: dict[int, np.ndarray] = {}
    for dim in largest:  # as many as there are lengths of vectors
        chosen = candidates.filter(F.size("v") == dim).orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(PIVOTS).collect()
        pivots[dim] = np.array([r["v"] for r in chosen], np.int64).reshape(-1, dim)
    celled = shared.materialise(assign(candidates, pivots, largest, False), "cells")
    cells = celled.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("parts"), F.max("d").alias("radius")).collect()
    parts = {(r["dim"], r["cell"]): r["parts"] for r in cells}
    radii = {dim: np.array([next((r["radius"] for r in cells if (r["dim"], r["cell"]) == (dim, c)), -np.inf) for c in range(len(p))]) for dim, p in pivots.items()}
    sizes = F.broadcast(spark.createDataFrame([(d, c, n) for (d, c), n in parts.items()], "dim int, cell int, parts int"))  # PIVOTS rows a length

    def build(group: pa.Table) -> pa.Table:
        v = matrix(group.column("v"))
        tree = Tree(np.asarray(group.column("vec_id")), v, largest[v.shape[1]])
        return pa.table([*(group.column(c).slice(0, 1) for c in SHARD_KEY), pa.array([pickle.dumps(tree, 5)], pa.binary())], names=[*SHARD_KEY, "tree"])

    # dealt by rows, not by ids, as one id may have most of them
    part = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.col("parts")).cast("int")
    sharded = celled.select("dim", "cell", "vec_id", "v").join(sizes, ["dim", "cell"]).select("dim", "cell", part.alias("part"), "vec_id", "v")
    trees = shared.materialise(sharded.groupBy(*SHARD_KEY).applyInArrow(build, "dim int, cell int, part int, tree binary"), "trees")

    asked = queries.filter(F.size("v").isin(*largest)).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = shared.materialise(assign(asked, pivots, largest, True).drop("d"), "asked")
    counts = asked.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    asked = shared.materialise(asked.join(counts, ["dim", "cell"]).select("dim", "cell", "vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).alias("block")), "asked")

    def pack(group: pa.Table) -> pa.Table:
        data = pickle.dumps((np.asarray(group.column("vec_id")), small(matrix(group.column("v"))), np.asarray(group.column("floor"))), 5)
        return pa.table([*(group.column(c).slice(0, 1) for c in ("dim", "cell", "block")), pa.array([data], pa.binary())], names=["dim", "cell", "block", "data"])

    def blocks(rows: DataFrame) -> DataFrame:
        return rows.groupBy("dim", "cell", "block").applyInArrow(pack, "dim int, cell int, block long, data binary")

    home = blocks(asked.withColumn("floor", F.lit(NONE))).join(sizes, ["dim", "cell"])
    home = shared.materialise(home.select("dim", "cell", "block", "data", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")), "requests")
    first = shared.materialise(best_of(serve(home, trees, k), k), "first")
    floors = first.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(NONE)).alias("floor"))

    def route(batches):
        """A row for each shard of each cell, the block's own left out, that may still better some of the block's queries."""
        for batch in batches:
            for dim, cell, block, data in zip(*(batch.column(k).to_pylist() for k in range(4))):
                ids, v, floor = pickle.loads(data)
                q, p = v.astype(np.float64), pivots[dim].astype(np.float64)
                base = (q * q).sum(axis=1) + largest[dim]
                far = np.sqrt(np.maximum(base[:, None] - 2 * q @ p.T, 0))
                bound = np.where(floor > NONE, np.sqrt(np.maximum(base - 2 * floor + 1e-7 * (1 + base), 0)) + 1e-6 * (1 + np.sqrt(base)), np.inf)
                wanted = far - radii[dim] <= bound[:, None]
                out = []
                for c in np.flatnonzero(wanted.any(axis=0)).tolist():
                    if c != cell and (dim, c) in parts:
                        who = wanted[:, c]
                        some = pickle.dumps((ids[who], v[who], floor[who]), 5)
                        out += [(dim, c, part, block * PIVOTS + cell, some) for part in range(parts[dim, c])]
                for at in range(0, len(out), 64):
                    cols = zip(*out[at : at + 64])
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()))], names=[*SHARD_KEY, "block", "data"])

    again = blocks(asked.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(NONE))))
    rest = shared.materialise(again.select("dim", "cell", "block", "data").mapInArrow(route, "dim int, cell int, part int, block long, data binary"), "requests")
    return best_of(first.drop("rank").unionByName(serve(rest, trees, k)), k)


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = integer_vectors(shared.table(spark, sf_dir, "embeddings"))
    return top_k(rows.filter(F.col("vec_id") % 20 == 0), rows)


OP4_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT * FROM e WHERE vec_id % 20 = 0),
s AS (SELECT q.vec_id AS query_id, e.vec_id, list_inner_product(q.v, e.v)::BIGINT AS score FROM q JOIN e ON q.vec_id <> e.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
