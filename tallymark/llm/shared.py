"""Shared helpers: scratch space all executors see, and vectorised text kernels."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below spark.checkpoint.dir, which goes when the session's file system closes.

    Without that setting a local session, as in tests, gets a temporary folder; a cluster must have it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tallymark-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by materialise() once nothing reads it any more."""
    spark, path = df.sparkSession, df.scratch_path
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def with_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; extra ones, clashing or not, go before anything else."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column has, in any case."""
    taken, out = {c.lower() for c in columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def by_row(docs: DataFrame, found: DataFrame, how: str) -> tuple[DataFrame, dict[str, str]]:
    """docs joined with found (doc_id, text_key and others) by doc_id, nulls alike, and text.

    Also the names that found's columns have got, as docs may have any.
    """
    names = dict(zip(found.columns, fresh(docs.columns, *found.columns)))
    right = found.select(*[F.col(c).alias(n) for c, n in names.items()])
    return docs.join(right, F.col("doc_id").eqNullSafe(F.col(names["doc_id"])) & (F.xxhash64("text") == F.col(names["text_key"])), how), names


#: Rows of a batch that goes to Python at once; whole texts may be long.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """The same, in a session whose batches for Python are small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= BATCH_ROWS:
        df.sparkSession.conf.set(key, BATCH_ROWS)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, nulls as empty, and offsets (n + 1)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values; of many, much faster than a table of hashes."""
    out = np.sort(values)
    return out[np.concatenate([[True], out[1:] != out[:-1]])] if len(out) else out


_BASE = 0x9E3779B97F4A7C15
_rng = np.random.default_rng(20240229)
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def _table(which: str, n: int) -> np.ndarray:
    """Powers of the base, or of its inverse modulo 2**64."""
    if which not in _powers or len(_powers[which]) < n:
        step = _BASE if which == "up" else pow(_BASE, -1, 2**64)
        out = np.full(max(n, 1 << 16), step, np.uint64)
        out[0] = 1
        _powers[which] = np.cumprod(out)
    return _powers[which]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Polynomial sums modulo 2**64 of all prefixes of an array of 64-bit codes."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _table("up", len(values))[: len(values)], out=out[1:])
    return out


def byte_sums(data: np.ndarray) -> np.ndarray:
    return prefix_sums(BYTE_CODES[data])


def window_codes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit codes of substrings [start, end) that depend on their bytes only. Some different ones have equal codes."""
    return mix((sums[ends] - sums[starts]) * _table("down", len(sums))[starts])


#: By the number of bytes that count, the mask of a little-endian 64-bit integer; bytes of a word that are taken block by block.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
_BLOCKS = 64


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit codes of short substrings, mixed anew after each 8 bytes; those of long ones are cut from BLAKE2b.

    No sums of powers: those collide for some strings whatever the base.
    """
    sizes = (ends - starts).astype(np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    out = mix(sizes.astype(np.uint64) + np.uint64(_BASE))
    here = np.flatnonzero(sizes <= _BLOCKS)
    at = 0
    while len(here):
        part = eight[starts[here] + at] & _MASKS[np.minimum(sizes[here] - at, 8)]
        out[here] = mix(out[here] ^ mix(part + np.uint64(at + 1)))
        at += 8
        here = here[sizes[here] > at]
    for k in np.flatnonzero(sizes > _BLOCKS).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
