"""Data profiles: missing values, countries, names, addresses, truth and true pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T

# The legal suffixes and address abbreviations that profiles count.
SUFFIXES = ("ltd", "limited", "pvt", "private", "inc", "llc", "corp", "corporation", "co", "company", "plc")
ABBREVIATIONS = ("st", "rd", "ave", "blvd", "dr", "ln", "hwy", "apt", "ste", "fl")
COLUMNS = ("entity_id", "business_name", "business_address", "country")


def half_even(c: Column, places: int = 2) -> Column:
    return F.bround(c, places)


def quantiles(value: str, prefix: str = "", places: int = 2) -> list[Column]:
    """mean, sample std, min, quartiles, p90 and max, rounded half to even; zeros if there are no values."""
    v = F.col(value).cast("double")
    stats = {"mean": F.avg(v), "std": F.coalesce(F.stddev_samp(v), F.lit(0.0)), "min": F.min(v), "p25": F.percentile(v, 0.25), "median": F.percentile(v, 0.5), "p75": F.percentile(v, 0.75), "p90": F.percentile(v, 0.9), "max": F.max(v)}
    return [half_even(F.coalesce(c, F.lit(0.0)), places).alias(f"{prefix}{k}") for k, c in stats.items()]


def missing_values(df: DataFrame) -> DataFrame:
    """src, column, empty, blank, null_words, total."""
    long = df.select("src", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit("")).alias("v")) for c in COLUMNS])).alias("x")).select("src", "x.*")
    return long.groupBy("src", "column").agg(
        F.count_if(F.col("v") == "").alias("empty"), F.count_if((F.col("v") != "") & (T.strip(F.col("v")) == "")).alias("blank"),
        F.count_if(F.lower("v").isin("nan", "null", "none")).alias("null_words"), F.count(F.lit(1)).alias("total"),
    )


def countries(df: DataFrame) -> DataFrame:
    """src, country, n, percent of the source's rows."""
    counts = df.groupBy("src", F.lower(F.trim("country")).alias("country")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", half_even(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("src")), 4))


def null_counts(df: DataFrame) -> DataFrame:
    """column, nulls of every column."""
    row = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").isNull().cast("int").alias("null")) for c in df.columns])
    return df.select(F.explode(row).alias("x")).groupBy("x.column").agg(F.sum("x.null").alias("nulls"))


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """src, the column, n and rank of each source's most frequent values; ties by value."""
    counts = df.groupBy("src", column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy("src").orderBy(F.col("n").desc(), column))).filter(F.col("rank") <= n)


def source_summary(df: DataFrame) -> DataFrame:
    """One row a source: rows, and mean lengths of normalised names and addresses."""
    return df.groupBy("src").agg(F.count(F.lit(1)).alias("rows"), F.avg(F.length("name")).alias("avg_name_length"), F.avg(F.length("address")).alias("avg_address_length"))


def length_histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """src, bin, n: lengths in equal bins between each source's least and greatest; one length alone is in the middle bin."""
    rows = df.select("src", F.length(column).alias("v"))
    ends = rows.groupBy("src").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    place = F.when(F.col("high") == F.col("low"), bins // 2).otherwise(F.least(F.floor((F.col("v") - F.col("low")) * bins / (F.col("high") - F.col("low"))), F.lit(bins - 1)))
    return rows.join(ends, "src").groupBy("src", place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def match_histogram(truth: DataFrame) -> DataFrame:
    """matches, n: how many entities have so many links."""
    return truth.groupBy(F.size("ids").alias("matches")).agg(F.count(F.lit(1)).alias("n"))


def _duplicates(unique: Column, total: Column) -> Column:
    return half_even(F.when(total > 0, 100.0 * (1 - unique / total)).otherwise(0.0), 2)


def names(df: DataFrame, fold: bool = False) -> DataFrame:
    """One row a source: unique names as they are, in lower case and normalised, lengths, punctuation and suffixes."""
    v = F.coalesce("business_name", F.lit(""))
    rows = df.select("src", v.alias("v"), F.lower(v).alias("low"), T.normalize_name(v, fold=fold).alias("norm"), F.length(v).alias("chars"), F.size(T.tokenize(T.collapse(v))).alias("tokens"))
    total = F.count(F.lit(1))
    share = lambda c: half_even(100.0 * F.count_if(c) / total, 2)
    word = lambda s: F.col("low").rlike(rf"\b{s}\b")
    return rows.groupBy("src").agg(
        total.alias("analyzed"), F.count_distinct("v").alias("unique_raw"), F.count_distinct("low").alias("unique_lower"), F.count_distinct("norm").alias("unique_normalized"),
        _duplicates(F.count_distinct("v"), total).alias("duplicate_raw_percent"), _duplicates(F.count_distinct("norm"), total).alias("duplicate_normalized_percent"),
        F.count_if(T.strip(F.col("v")) == "").alias("empty"), *quantiles("chars", "chars_"), *quantiles("tokens", "tokens_"), share(F.col("v").rlike(rf"[^{T.WORD}\s]")).alias("punctuation_percent"),
        *[F.count_if(word(s)).alias(f"suffix_{s}") for s in SUFFIXES], *[share(word(s)).alias(f"suffix_{s}_percent") for s in SUFFIXES],
    )


def addresses(df: DataFrame, fold: bool = False) -> DataFrame:
    """One row a source: empties, and over the rest lengths, numeric tokens, postal codes, abbreviations and unique texts."""
    v = F.coalesce("business_address", F.lit(""))
    some = T.strip(v) != ""
    of = lambda c: F.when(some, c)
    norm = T.normalize_address(v, fold=fold)
    rows = df.select("src", of(v).alias("v"), F.lower(of(v)).alias("low"), F.when(norm != "", norm).alias("norm"), of(F.length(v)).alias("chars"), of(F.size(T.tokenize(T.collapse(v)))).alias("tokens"), of(F.size(T.numeric_tokens(v))).alias("numbers"), of(T.postal_code(v)).alias("postal"))
    total, n = F.count(F.lit(1)), F.count("v")
    share = lambda c: half_even(F.when(n > 0, 100.0 * F.count_if(c) / n).otherwise(0.0), 2)
    word = lambda s: F.col("low").rlike(rf"\b{s}\b")
    return rows.groupBy("src").agg(
        total.alias("analyzed"), (total - n).alias("empty"), half_even(100.0 * (total - n) / total, 2).alias("empty_percent"),
        *quantiles("chars", "chars_"), *quantiles("tokens", "tokens_"), *quantiles("numbers", "numbers_"), share(F.col("numbers") > 0).alias("numeric_percent"), share(F.col("postal") != "").alias("postal_percent"),
        F.count_distinct("v").alias("unique_raw"), F.count_distinct("norm").alias("unique_normalized"),
        *[F.count_if(word(s)).alias(f"abbr_{s}") for s in ABBREVIATIONS], *[share(word(s)).alias(f"abbr_{s}_percent") for s in ABBREVIATIONS],
    )


def truth_profile(truth: DataFrame) -> DataFrame:
    """One row: links by source, which sources entities have, and the distribution of links."""
    of = lambda s: F.size(F.filter("ids", lambda i: F.lower(i).contains(s)))
    rows = truth.select(F.size("ids").alias("n"), of("s2").alias("n2"), of("s3").alias("n3"))
    return rows.agg(
        F.count(F.lit(1)).alias("entities"), F.sum("n").alias("links"), F.sum("n2").alias("links_s2"), F.sum("n3").alias("links_s3"),
        F.count_if((F.col("n2") > 0) & (F.col("n3") == 0)).alias("only_s2"), F.count_if((F.col("n3") > 0) & (F.col("n2") == 0)).alias("only_s3"), F.count_if((F.col("n2") > 0) & (F.col("n3") > 0)).alias("both"),
        F.count_if(F.col("n") == 0).alias("none"), F.count_if(F.col("n") == 1).alias("one"), F.count_if(F.col("n") > 1).alias("many"), *quantiles("n", "links_", 4),
    )


def true_pairs(links: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Links with both records; those with an unknown id go."""
    side = lambda d, k, p: d.select(F.col("entity_id").alias(k), *[F.col(c).alias(f"{p}_{c}") for c in ("name", "address", "country_norm")])
    return links.join(side(s1, "s1", "a"), "s1").join(side(pool, "cand", "b"), "cand")


def true_pair_similarity(links: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """One row over all true pairs: shares of equal names, addresses and countries, and quantiles of their similarities."""
    pair = lambda c: (F.col(f"a_{c}"), F.col(f"b_{c}"))
    equal = {f"{c}_exact": S.both_equal(*pair(k)) for c, k in (("name", "name"), ("address", "address"), ("country", "country_norm"))}
    name = S.ratios(*pair("name"), "fuzzy_ratio", "token_sort_ratio")
    ratios = {"name_fuzzy": name["fuzzy_ratio"], "name_token_sort": name["token_sort_ratio"], "address_fuzzy": S.fuzzy_ratio(*pair("address")), "address_jaccard": S.jaccard(*S.token_sets(*pair("address")))}
    rows = true_pairs(links, s1, pool).select(*[c.alias(n) for n, c in (equal | ratios).items()])
    share = lambda c: half_even(F.coalesce(100.0 * F.avg(c), F.lit(0.0)), 2).alias(f"{c}_percent")
    return rows.agg(F.count(F.lit(1)).alias("pairs"), *[share(c) for c in equal], *[q for c in ratios for q in quantiles(c, f"{c}_")])
