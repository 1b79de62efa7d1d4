"""Blocking keys, pruning, candidates with a cap per master row, and their recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.similarity import jaccard
from .labels import label

DEFAULT_RULES = ("name_token", "name_prefix", "postal_code", "country_name_token", "country_name_prefix", "country_postal", "name_token_postal", "name_prefix_postal")


def _when(condition: Column, keys: Column) -> Column:
    return F.when(condition, keys).otherwise(F.array().cast("array<string>"))


def _each(tokens: Column, make) -> Column:
    return F.transform(tokens, make)


def key_columns(prefix: int = 4, gram: int = 3) -> dict[str, Column]:
    """For each rule the array of a record's keys. Repeated tokens give repeated keys."""
    n, c, pc = F.col("name"), F.col("country_norm"), F.col("postal")
    tokens = F.filter(T.tokenize(n), lambda t: F.length(t) >= 2)
    words = F.filter(T.tokenize(F.col("address")), lambda t: (F.length(t) >= 2) & ~t.isin(*T.STOPWORDS))
    start, long = F.substring(n, 1, prefix), F.length(n) >= prefix
    cat = lambda *x: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in x])
    three = lambda a: F.slice(F.filter(a, lambda t: F.length(t) >= 3), 1, 3)
    return {
        "country": _when(c != "", F.array(cat("country:", c))),
        "name_token": _each(tokens, lambda t: cat("ntok:", t)),
        "name_prefix": _when(long, F.array(cat("npfx:", start))),
        "address_token": _each(words, lambda t: cat("atok:", t)),
        "postal_code": _when(pc != "", F.array(cat("post:", pc))),
        "char_ngram": _each(T.char_ngrams(n, gram), lambda g: cat("cng:", g)),
        "country_name_token": _when(c != "", _each(tokens, lambda t: cat("c_ntok:", c, "::", t))),
        "country_name_prefix": _when((c != "") & long, F.array(cat("c_npfx:", c, "::", start))),
        "country_postal": _when((c != "") & (pc != ""), F.array(cat("c_post:", c, "::", pc))),
        "country_address_token": _when(c != "", _each(words, lambda t: cat("c_atok:", c, "::", t))),
        "name_token_postal": _when(pc != "", _each(tokens, lambda t: cat("ntok_post:", t, "::", pc))),
        "name_prefix_postal": _when(long & (pc != ""), F.array(cat("npfx_post:", start, "::", pc))),
        "name_token_address_token": F.flatten(_each(three(T.tokenize(n)), lambda t: _each(three(words), lambda a: cat("ntok_atok:", t, "::", a)))),
    }


def block_keys(records: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    """entity_id, rule, key: one explode for all rules; a record's repeated keys stay."""
    made = key_columns()

    def named(rule):
        return F.transform(made[rule], lambda k: F.struct(F.lit(rule).alias("rule"), k.alias("key")))

    return records.select("entity_id", F.explode(F.concat(*map(named, rules))).alias("k")).select("entity_id", "k.rule", "k.key")


def prune(keys: DataFrame, max_block_size: int = 500) -> DataFrame:
    """Distinct pool keys without blocks of more ids than that; 0 or less keeps all."""
    keys = keys.distinct()
    if max_block_size <= 0:
        return keys
    kept = keys.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") <= max_block_size)
    return keys.join(kept.select("rule", "key"), ["rule", "key"], "left_semi")


def pairs(s1: DataFrame, pool: DataFrame, rules=DEFAULT_RULES, max_block_size: int = 500, min_shared: int = 2) -> DataFrame:
    """s1, cand, hits, rules: every pair that shares an unpruned key. Self-pairs go.

    Rules go through the shuffle as bits, and hits of all rules but the grams' as one sum.
    """
    names = sorted(rules)
    bit = F.array_position(F.array(*[F.lit(r) for r in names]), F.col("rule")).cast("int") - 1
    left = block_keys(s1, rules).withColumnRenamed("entity_id", "s1")
    right = prune(block_keys(pool, rules), max_block_size).select("rule", "key", F.col("entity_id").alias("cand"))
    met = left.join(right, ["rule", "key"]).filter("s1 <> cand").select("s1", "cand", F.call_function("shiftleft", F.lit(1), bit).alias("bit"), (F.col("rule") == "char_ngram").cast("int").alias("gram"))
    met = met.groupBy("s1", "cand").agg(F.bit_or("bit").alias("bits"), F.sum(1 - F.col("gram")).alias("others"), F.sum("gram").alias("grams"))
    grams = F.col("grams") >= min_shared
    of = [(F.col("bits").bitwiseAND(1 << k) != 0) & (grams if r == "char_ngram" else F.lit(True)) for k, r in enumerate(names)]
    listed = F.filter(F.array(*[F.when(c, F.lit(r)) for c, r in zip(of, names)]), lambda r: r.isNotNull())
    return met.filter((F.col("others") > 0) | grams).select("s1", "cand", (F.col("others") + grams.cast("int")).alias("hits"), listed.alias("rules"))


def ranked(pairs_: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """The pairs with score and rn, their rank within s1 by score and candidate id.

    Master rows are joined last, so that their shuffle is also the one that ranks need.
    """
    tokens = F.array_distinct(T.tokenize(F.col("name")))
    a = s1.select(F.col("entity_id").alias("s1"), F.filter(tokens, lambda t: F.length(t) >= 2).alias("ta"), F.col("postal").alias("pa"), F.col("country_norm").alias("ca"))
    b = pool.select(F.col("entity_id").alias("cand"), F.col("src").alias("source"), tokens.alias("tb"), F.col("postal").alias("pb"), F.col("country_norm").alias("cb"))
    same = lambda x, y: F.when((F.col(x) != "") & (F.col(x) == F.col(y)), 1.0).otherwise(0.0)
    score = 4.0 * jaccard(F.col("ta"), F.col("tb")) + 2.0 * same("pa", "pb") + 1.0 * same("ca", "cb") + 0.5 * F.col("hits")
    full = pairs_.join(b, "cand").join(a, "s1").select("s1", "cand", "source", "hits", "rules", score.alias("score"))
    return full.withColumn("rn", F.row_number().over(Window.partitionBy("s1").orderBy(F.col("score").desc(), "cand")))


def candidates(s1: DataFrame, pool: DataFrame, rules=DEFAULT_RULES, max_block_size: int = 500, k: int = 50) -> DataFrame:
    return ranked(pairs(s1, pool, rules, max_block_size), s1, pool).filter(F.col("rn") <= k)


def candidate_stats(found: DataFrame, n_s1: int, n_pool: int) -> DataFrame:
    """One row: possible and found pairs, reduction ratio, mean and largest count of the rows that have any."""
    per = found.groupBy("s1").agg(F.count(F.lit(1)).alias("n"))
    out = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"), F.avg("n").alias("avg_per_s1"), F.max("n").alias("max_per_s1"))
    possible = F.lit(n_s1 * n_pool)
    return out.select(possible.alias("possible"), "pairs", (1 - F.col("pairs") / possible).alias("reduction_ratio"), "avg_per_s1", "max_per_s1")


def candidate_recall(found: DataFrame, links: DataFrame) -> DataFrame:
    """One row over true links (s1, cand): recall null without links, entities covered wholly and in part."""
    hit = links.join(found.select("s1", "cand", F.lit(1).alias("hit")), ["s1", "cand"], "left")
    per = hit.groupBy("s1").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("k"))
    total, got = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))
    return per.agg(
        total.alias("links"), got.alias("covered"), F.when(total > 0, got / total).alias("recall"), F.count(F.lit(1)).alias("entities"),
        F.count_if(F.col("k") == F.col("n")).alias("all_covered"), F.count_if(F.col("k") > 0).alias("any_covered"),
    ).withColumn("status", F.when(F.col("recall").isNull(), "NOT_AVAILABLE").otherwise("OK"))


def cap_sweep(ranked_: DataFrame, truth: DataFrame, ks=(25, 50, 75, 100, 150)) -> DataFrame:
    """k, pairs, true links found and lost to the cap: ranks are computed once, each pair counts for its caps."""
    caps = F.array(*[F.lit(k) for k in ks])
    true, kept = F.col("label") == 1, F.col("rn") <= F.col("k")
    return label(ranked_, truth).select(F.explode(caps).alias("k"), "rn", "label").groupBy("k").agg(
        F.count_if(kept).alias("pairs"), F.count_if(kept & true).alias("found"), F.count_if(~kept & true).alias("lost"),
    )


def recall_report(found: DataFrame, truth: DataFrame, before_cap: DataFrame) -> DataFrame:
    """One row of counts and shares: the links and entities of truth (s1, ids) that found covers, and what the cap lost.

    before_cap: all pairs with rn, or without a cap the same as found. Shares are null without links.
    """
    links = truth.select("s1", F.explode("ids").alias("cand"))
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    facts = [
        candidate_recall(found, links), count(truth.select("s1").distinct().join(found.select("s1"), "s1", "left_anti"), "entities_zero_candidates"),
        count(before_cap, "candidates_before_cap"), count(found, "candidates_after_cap"),
        count(before_cap.join(links, ["s1", "cand"], "left_semi").join(found.select("s1", "cand"), ["s1", "cand"], "left_anti"), "true_matches_lost_to_cap"),
    ]
    rows = facts[0]
    for df in facts[1:]:  # each is one row
        rows = rows.unionByName(df, allowMissingColumns=True)
    out = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    share = lambda c: F.when(F.col("recall").isNotNull(), 100.0 * F.col(c) / F.col("entities"))
    # fixed values: the names of the report's fields and of its two states
    return out.select(
        F.col("recall").alias("candidate_recall"), F.when(F.col("recall").isNull(), "NOT_AVAILABLE").otherwise("MEASURED").alias("candidate_recall_status"), F.col("links").alias("total_true_links"),
        F.col("covered").alias("true_links_covered"), (F.col("links") - F.col("covered")).alias("true_links_missed"), F.col("entities").alias("s1_entities_with_truth"),
        F.col("all_covered").alias("entities_all_covered_count"), share("all_covered").alias("entities_all_covered_pct"), F.col("any_covered").alias("entities_any_covered_count"), share("any_covered").alias("entities_any_covered_pct"),
        "entities_zero_candidates", "candidates_before_cap", "candidates_after_cap", "true_matches_lost_to_cap",
        F.when(F.col("recall").isNull(), "No true link was there to be covered.").otherwise(F.concat(F.lit("Candidate recall: "), F.format_string("%.4f", "recall"))).alias("message"),
    )


def experiment_slice(s1: DataFrame, pool: DataFrame, truth: DataFrame, entities: int = 100, others: int = 25_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Master rows, pool and truth of a small experiment: the first entities with links by id, the rows they link to, and of each source the first others."""
    some = truth.filter(F.size("ids") > 0).orderBy("s1").limit(entities)
    wanted = some.select(F.explode("ids").alias("entity_id")).distinct()
    near = pool.join(wanted, "entity_id", "left_semi")
    first = pool.filter("src = 'S2'").orderBy("entity_id").limit(others).unionByName(pool.filter("src = 'S3'").orderBy("entity_id").limit(others))
    return s1.join(some.select(F.col("s1").alias("entity_id")), "entity_id", "left_semi"), near.unionByName(first).dropDuplicates(["entity_id"]), some
