"""Scans and sinks of tab-separated sources, and the entity view over the driver's tables."""

from __future__ import annotations

import json
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

SOURCE_COLUMNS = ("entity_id", "business_name", "business_address", "country")
TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def first_line(spark: SparkSession, path: str) -> str:
    """The header of a file, or of a folder's files."""
    return next((r.value for r in spark.read.text(path).limit(1).collect()), "")


def read_tsv(spark: SparkSession, path: str, expected=SOURCE_COLUMNS, label: str = "table") -> DataFrame:
    """All columns as strings, missing ones as empty text; extra columns stay."""
    if not exists(spark, path):
        raise FileNotFoundError(f"{label}: {path}")
    df = spark.read.csv(path, sep="\t", header=True, inferSchema=False, quote='"', escape='"').na.fill("")
    if missing := set(expected) - set(df.columns):
        raise ValueError(f"{label}: missing columns {sorted(missing)}")
    return df


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, TRUTH_COLUMNS, "ground truth")


def numbered(df: DataFrame) -> DataFrame:
    """The rows of a scan with line, which grows along the file."""
    return df.withColumn("line", F.monotonically_increasing_id())


def head(df: DataFrame, n: int, key: str = "entity_id") -> DataFrame:
    """The first n rows in the order of a key, as a scan of many files has no order of its own."""
    return df.orderBy(key).limit(n)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in spark.checkpoint.dir, which all executors see; in a local session without one, a temporary folder."""
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


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the scratch folder and read back, so that several plans read it.

    Its joins are by sorting: Spark takes the size of the files for that of the rows, and
    would broadcast, through the driver, tables that are many times as large in memory.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).hint("merge")


def inspect_schema(df: DataFrame, expected=SOURCE_COLUMNS) -> dict:
    have, want = set(df.columns), set(expected)
    return {"columns": df.columns, "missing": sorted(want - have), "unexpected": sorted(have - want), "valid": want <= have}


def dataset_sizes(spark: SparkSession, path: str) -> dict:
    """Bytes, data rows and header columns."""
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    df = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    return {"bytes": size, "rows": df.count(), "columns": df.columns}


@dataclass(frozen=True)
class Sources:
    s1: DataFrame
    s2: DataFrame
    s3: DataFrame
    truth: DataFrame | None = None

    def summary(self) -> dict:
        return {n: d.count() for n in ("s1", "s2", "s3", "truth") if (d := getattr(self, n)) is not None}


def load(spark: SparkSession, paths: dict[str, str]) -> Sources:
    """Of a mapping with source1, source2, source3 and, for training, ground_truth."""
    truth = read_truth(spark, paths["ground_truth"]) if "ground_truth" in paths else None
    return Sources(*(read_tsv(spark, paths[f"source{k}"], label=f"source{k}") for k in (1, 2, 3)), numbered(truth) if truth is not None else None)


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, sep="\t", header=True, emptyValue="", quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_json(spark: SparkSession, record: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads("".join(r.value for r in spark.read.text(path).collect()))


# Entity view: parts as business records in three sources; the same text in Spark and, with varchar, in DuckDB.
ENTITY_SQL = """
SELECT concat('S', cast(1 + p.p_partkey % 3 as string), '-', lpad(cast(p.p_partkey as string), 8, '0')) AS entity_id,
       concat('S', cast(1 + p.p_partkey % 3 as string)) AS src,
       concat(p.p_name, ' ', replace(p.p_brand, '#', ' '), CASE p.p_partkey % 5 WHEN 0 THEN ' Ltd.' WHEN 1 THEN ' Pvt Ltd' WHEN 2 THEN ' & Co' WHEN 3 THEN ', Inc.' ELSE '' END) AS business_name,
       CASE WHEN p.p_partkey % 30 = 7 THEN '' ELSE concat(cast(p.p_size as string), ' ', p.p_type, ' St., Unit ', cast(p.p_partkey % 17 as string), ', ', cast(10000 + p.p_size * 131 as string)) END AS business_address,
       concat(' ', n.n_name, ' ') AS country, concat(lower(p.p_name), '|', p.p_brand) AS truth_key
FROM {part} p JOIN {nation} n ON n.n_nationkey = p.p_partkey % 25
"""


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("part", "nation")}
    return spark.sql(ENTITY_SQL, **frames)


def prepared(df: DataFrame, fold: bool = True, suffixes=T.LEGAL_SUFFIXES, abbreviations=T.ABBREVIATIONS) -> DataFrame:
    """The six derived columns of every record; the originals stay."""
    name, address = T.normalize_name(F.col("business_name"), suffixes, fold), T.normalize_address(F.col("business_address"), abbreviations, fold)
    df = df.withColumns({"name": name, "address": address, "country_norm": T.normalize_country(F.col("country"), fold=fold), "postal": T.postal_code(F.col("business_address"))})
    return df.withColumns({"house": T.house_number(F.col("address")), "numbers": T.numeric_tokens(F.col("address"))})


def truth_of(entities: DataFrame) -> DataFrame:
    """source1_entity_id and matched_entity_ids (comma list) of the entity view."""
    s1 = entities.filter("src = 'S1'").select("truth_key", F.col("entity_id").alias("source1_entity_id"))
    pool = entities.filter("src <> 'S1'").groupBy("truth_key").agg(F.array_join(F.array_sort(F.collect_set("entity_id")), ",").alias("matched_entity_ids"))
    return s1.join(pool, "truth_key", "left").select("source1_entity_id", F.coalesce("matched_entity_ids", F.lit("")).alias("matched_entity_ids"))
