"""Accepted pairs to id lists for every master row, and checks of written outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import join_ids, split_ids


def accept(scored: DataFrame, threshold: float, min_name: float = 0.0, min_address: float = 0.0, require_country: bool = False) -> DataFrame:
    """Pairs at or above the threshold that pass the guards; a guard without its column is off."""
    out = scored.filter(F.col("probability") >= threshold)
    if min_name > 0 and "name_fuzzy_ratio" in out.columns:
        out = out.filter(F.col("name_fuzzy_ratio") >= min_name)
    if min_address > 0 and "address_fuzzy_ratio" in out.columns:
        out = out.filter(F.col("address_fuzzy_ratio") >= min_address)
    if require_country and "country_exact" in out.columns:
        out = out.filter(F.col("country_exact") == 1)
    return out


def grouped(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    """s1, ids of every master row, empty where it has no pair."""
    ids = pairs.groupBy("s1").agg(F.array_sort(F.collect_set("cand")).alias("ids"))
    return s1.select(F.col("entity_id").alias("s1")).distinct().join(ids, "s1", "left").select("s1", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))


def matching_table(s1: DataFrame, accepted: DataFrame, candidates: DataFrame) -> DataFrame:
    """source1_entity_id and matched_entity_ids; matches that are no candidates go."""
    sound = accepted.select("s1", "cand").join(candidates.select("s1", "cand"), ["s1", "cand"], "left_semi")
    return grouped(s1, sound).select(F.col("s1").alias("source1_entity_id"), join_ids(F.col("ids")).alias("matched_entity_ids"))


def candidate_table(s1: DataFrame, candidates: DataFrame) -> DataFrame:
    return grouped(s1, candidates).select(F.col("s1").alias("source1_entity_id"), join_ids(F.col("ids")).alias("candidate_entity_ids"))


def violations(matching: DataFrame, candidate: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """check, s1, detail of everything that is wrong with the two tables; sound outputs give none."""
    universe = s1.select(F.col("entity_id").alias("s1")).distinct()
    known = pool.select(F.col("entity_id").alias("id")).distinct()
    out, ids = [], {}
    for name, df, column in (("matching", matching, "matched_entity_ids"), ("candidate", candidate, "candidate_entity_ids")):
        rows = df.select(F.col("source1_entity_id").alias("s1"), split_ids(F.col(column)).alias("ids"))
        none = F.lit("")
        out.append(universe.join(rows, "s1", "left_anti").select(F.lit(f"{name}: missing s1").alias("check"), "s1", none.alias("detail")))
        out.append(rows.join(universe, "s1", "left_anti").select(F.lit(f"{name}: extra s1"), "s1", none))
        out.append(rows.groupBy("s1").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit(f"{name}: duplicate s1"), "s1", none))
        out.append(rows.filter(F.size("ids") != F.size(F.array_distinct("ids"))).select(F.lit(f"{name}: duplicate id"), "s1", F.array_join("ids", ",")))
        out.append(rows.filter(F.array_contains("ids", F.col("s1"))).select(F.lit(f"{name}: self"), "s1", F.col("s1")))
        ids[name] = rows.select("s1", F.explode("ids").alias("id")).distinct()
        out.append(ids[name].join(known, "id", "left_anti").select(F.lit(f"{name}: unknown id"), "s1", F.col("id")))
    out.append(ids["matching"].join(ids["candidate"], ["s1", "id"], "left_anti").select(F.lit("matched id is no candidate"), "s1", F.col("id")))
    every = out[0]
    for df in out[1:]:
        every = every.union(df)
    return every


#: The columns of the two outputs.
MATCHING, CANDIDATE = ("source1_entity_id", "matched_entity_ids"), ("source1_entity_id", "candidate_entity_ids")


def header_errors(header: str, expected: tuple[str, str], label: str) -> list[str]:
    """What is wrong with the first line of an output."""
    columns = header.rstrip("\r\n").split("\t")
    if len(columns) < 2:
        return [f"{label}: not separated by tabs"]
    return [] if tuple(columns) == expected else [f"{label}: columns {columns}, not {list(expected)}"]


def coverage(df: DataFrame, s1: DataFrame, label: str) -> DataFrame:
    """One row: rows of an output and of the master table, and ids that only one of them has."""
    got, want = df.select(F.col("source1_entity_id").alias("s1")), s1.select(F.col("entity_id").alias("s1")).distinct()
    both = got.groupBy("s1").agg(F.count(F.lit(1)).alias("got")).join(want.withColumn("want", F.lit(1)), "s1", "full_outer")
    return both.agg(F.coalesce(F.sum("got"), F.lit(0)).alias("rows"), F.count("want").alias("expected"), F.count_if(F.col("got").isNull()).alias("missing"), F.count_if(F.col("want").isNull()).alias("extra")).select(F.lit(label).alias("output"), "*")


def summary(matching: DataFrame) -> DataFrame:
    """One row: links and rows without any of the matching output."""
    ids = F.array_distinct(split_ids(F.col("matched_entity_ids")))
    return matching.select(F.size(ids).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("links"), F.count_if(F.col("n") == 0).alias("singletons"))


def resolve_threshold(explicit=None, persisted=None, selected=None, default: float = 0.5) -> tuple[float, str]:
    for value, source in ((explicit, "explicit"), (persisted, "persisted"), (selected, "selected")):
        if value is not None:
            return float(value), source
    return float(default), "default"
