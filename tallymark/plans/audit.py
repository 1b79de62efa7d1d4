"""Hashes, git state, environment and the manifest of a run."""

from __future__ import annotations

import hashlib
import importlib.metadata
import platform
import subprocess
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

REQUIRED = ("pyspark", "pandas", "numpy", "pyarrow", "pyyaml")


def file_sha256(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while piece := f.read(1 << 20):
            digest.update(piece)
    return digest.hexdigest()


def code_sha256(root: str) -> str:
    """Of all Python files below a folder, by name and content."""
    digest = hashlib.sha256()
    for p in sorted(Path(root).rglob("*.py")):
        digest.update(str(p.relative_to(root)).encode() + b"\0" + p.read_bytes() + b"\0")
    return digest.hexdigest()


def data_digest(spark: SparkSession, path: str) -> dict[str, str]:
    """By file, of the lines of outputs in any store that Spark reads; their order doesn't count.

    Lines are summed where they lie, so a file may have any size; the driver gets a row a file.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.xxhash64("value").alias("a"), F.xxhash64("value", F.lit(7)).alias("b"))
    sums = lines.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("a").cast("decimal(20,0)")).alias("sum"), F.bit_xor("b").alias("xor"))
    return {r["file"]: r["h"] for r in sums.select("file", F.sha2(F.concat_ws(":", "n", "sum", "xor"), 256).alias("h")).collect()}


def git_state(root: str = ".") -> dict:
    def run(*args):
        try:
            return subprocess.run(["git", "-C", root, *args], capture_output=True, text=True, timeout=20).stdout.strip()
        except OSError:
            return ""

    return {"commit": run("rev-parse", "HEAD"), "branch": run("rev-parse", "--abbrev-ref", "HEAD"), "dirty": bool(run("status", "--porcelain"))}


def environment() -> tuple[bool, dict[str, str]]:
    found = {"python": platform.python_version(), "platform": platform.platform()}
    for name in REQUIRED:
        try:
            found[name] = importlib.metadata.version(name)
        except importlib.metadata.PackageNotFoundError:
            found[name] = "missing"
    return "missing" not in found.values(), found


def manifest(spark: SparkSession, mode: str, outputs: dict[str, str], metrics: dict | None = None) -> dict:
    return {
        "created": datetime.now(timezone.utc).isoformat(), "mode": mode, "git": git_state(), "environment": environment()[1],
        "outputs": {name: data_digest(spark, path) for name, path in outputs.items()}, "metrics": metrics or {},
    }
