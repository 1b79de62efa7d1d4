"""Truth, labels, splits and samples. Every choice is by a hash or an order with ties broken by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import split_ids


def parse_truth(raw: DataFrame, order: str | None = None) -> DataFrame:
    """s1 and ids (distinct, sorted): empty and 'nan' lists are empty.

    Of repeated s1 rows the last by the order column counts; without one, that with the largest list text.
    """
    text = F.trim(F.coalesce("matched_entity_ids", F.lit("")))
    ids = F.when(F.lower(text) == "nan", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(split_ids(text))))
    listed = F.coalesce("matched_entity_ids", F.lit(""))
    last = F.max_by(listed, F.col(order)) if order else F.max(listed)
    return raw.groupBy(F.col("source1_entity_id").alias("s1")).agg(last.alias("matched_entity_ids")).select("s1", ids.alias("ids"))


def links_of(truth: DataFrame) -> DataFrame:
    return truth.select("s1", F.explode("ids").alias("cand"))


def label(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """The pairs with label: 1 if truth (s1, ids) lists cand, else 0.

    Lists are joined whole, as a row for each link can be many times as many rows as the pairs.
    """
    listed = pairs.join(truth.select("s1", F.col("ids").alias("_listed")), "s1", "left")
    return listed.withColumn("label", F.coalesce(F.array_contains("_listed", F.col("cand")).cast("int"), F.lit(0))).drop("_listed")


def is_hard_negative():
    """Of a feature row with n_rules, the number of rules that made the pair."""
    return (F.col("name_fuzzy_ratio") >= 65) | (F.col("name_token_sort_ratio") >= 65) | (F.col("name_jaccard") >= 0.4) | (F.col("n_rules") > 1)


def prefilter(labelled: DataFrame, max_negatives: int = 20) -> DataFrame:
    """All positives, and of each s1 the negatives with the most rules (ties by id). Label-aware: for training rows only."""
    order = Window.partitionBy("s1", "label").orderBy(F.size("rules").desc(), "cand")
    return labelled.withColumn("rn", F.row_number().over(order)).filter((F.col("label") == 1) | (F.col("rn") <= max_negatives)).drop("rn")


def hashed(key: str, seed: int):
    """A place of a key in an order that is as good as random: a digest in hexadecimal, as other engines give it too."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def downsample(labelled: DataFrame, per_positive: int = 20, seed: int = 42) -> DataFrame:
    """Per s1 at most per_positive negatives a positive (one positive at least), hard ones first, then by hash."""
    n_pos = F.sum("label").over(Window.partitionBy("s1"))
    order = Window.partitionBy("s1", "label").orderBy(F.col("hard").desc(), hashed("cand", seed), "cand")
    most = F.greatest(F.lit(per_positive) * F.col("n_pos"), F.lit(1))
    return labelled.withColumn("n_pos", n_pos).withColumn("rn", F.row_number().over(order)).filter((F.col("label") == 1) | (F.col("rn") <= most)).drop("rn", "n_pos")


def split_entities(universe: DataFrame, validation: float = 0.2, seed: int = 42, train_cap: int | None = None, validation_cap: int | None = None) -> DataFrame:
    """s1 and part ('train' or 'validation'): the int(validation * n) rows of the smallest hashes validate.

    No order of all rows is needed: the driver counts rows by the first digits of the hash,
    and orders those of one such stretch. A cap takes a part's rows of the smallest hashes.
    """
    rows = universe.select("s1").distinct().withColumn("h", hashed("s1", seed))
    stretch = F.substring("h", 1, 3)
    counts = sorted((r["p"], r["n"]) for r in rows.groupBy(stretch.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())  # at most 4096
    wanted, cut = int(validation * sum(n for _, n in counts)), ("", "")
    for p, n in counts:
        if 0 < wanted <= n:
            last = rows.filter(stretch == p).orderBy("h", "s1").limit(wanted).agg(F.max(F.struct("h", "s1")).alias("x")).first()["x"]
            cut = (last["h"], last["s1"])
        wanted -= n
    held = (F.col("h") < cut[0]) | ((F.col("h") == cut[0]) & (F.col("s1") <= cut[1]))
    out = rows.withColumn("part", F.when(held, "validation").otherwise("train"))
    for part, cap in (("train", train_cap), ("validation", validation_cap)):
        if cap is not None:
            mine = out.filter(F.col("part") == part).orderBy("h", "s1").limit(cap)
            out = out.filter(F.col("part") != part).unionByName(mine)
    return out.drop("h")


def composition(rows: DataFrame) -> DataFrame:
    """part, label, hard, n: what a labelled set consists of."""
    return rows.groupBy("part", "label", "hard").agg(F.count(F.lit(1)).alias("n"))


def sample_exact(df: DataFrame, n: int, key: str = "entity_id", seed: int = 42) -> DataFrame:
    """n rows, the same for any partitioning."""
    return df.orderBy(hashed(key, seed), key).limit(n)


def development_pool(pool: DataFrame, links: DataFrame, others: int = 250_000) -> DataFrame:
    """All truly matched rows, and a sample of others."""
    true = links.select(F.col("cand").alias("entity_id")).distinct()
    return pool.join(true, "entity_id", "left_semi").unionByName(sample_exact(pool.join(true, "entity_id", "left_anti"), others))
