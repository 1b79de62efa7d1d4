"""The 27 features of candidate pairs, and relational TF-IDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T

# The features in their order.
FEATURES = (
    "name_exact", "name_fuzzy_ratio", "name_partial_ratio", "name_token_sort_ratio", "name_token_set_ratio", "name_jaccard", "name_char_sim", "name_tfidf_word", "name_tfidf_char",
    "name_length_diff", "name_token_count_diff", "name_common_tokens", "address_exact", "address_fuzzy_ratio", "address_token_sort_ratio", "address_jaccard", "address_char_sim",
    "address_tfidf_word", "address_tfidf_char", "address_length_diff", "address_common_tokens", "address_numeric_overlap", "postal_code_match", "house_number_match", "country_exact",
    "source_is_s2", "source_is_s3",
)


#: What turns features on: a flag's own name, or one that stands for others.
FLAGS = {"name_tfidf_cosine": ("name_tfidf_word", "name_tfidf_char"), "address_tfidf_cosine": ("address_tfidf_word", "address_tfidf_char"), "source_indicator": ("source_is_s2", "source_is_s3"), "address_fuzzy": ("address_fuzzy_ratio",), "address_token_sim": ("address_token_sort_ratio",)}
COSINES = tuple(f for f in FEATURES if "_tfidf_" in f)


def enabled(off=()) -> tuple[str, ...]:
    """The features without those of the flags that are off, in their order."""
    if unknown := set(off) - set(FLAGS) - set(FEATURES):
        raise ValueError(f"unknown feature flags: {sorted(unknown)}")
    gone = {f for flag in off for f in FLAGS.get(flag, (flag,))}
    return tuple(f for f in FEATURES if f not in gone)


def attach(pairs: DataFrame, s1: DataFrame, pool: DataFrame, more=()) -> DataFrame:
    """Pairs (s1, cand) with both records' columns, prefixed a_ and b_; text of an unknown id is empty. more: further columns."""
    def side(df, key, p):
        return df.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{p}_{c}") for c in ("name", "address", "postal", "house", "country_norm", "numbers", *more)], *([F.col("src").alias("b_src")] if p == "b" else []))

    out = pairs.select("s1", "cand").join(side(pool, "cand", "b"), "cand", "left").join(side(s1, "s1", "a"), "s1", "left")
    empty = F.array().cast("array<string>")
    kept = {"s1", "cand", *(f"{p}_{c}" for p in "ab" for c in more)}
    return out.select(*[F.col(c) if c in kept else F.coalesce(F.col(c), empty if c.endswith("numbers") else F.lit("")).alias(c) for c in out.columns])


def native_features() -> dict[str, Column]:
    out = {}
    for p, field in (("name", "name"), ("address", "address")):
        a, b = F.col(f"a_{field}"), F.col(f"b_{field}")
        x, y = S.token_sets(a, b)
        out |= {f"{p}_exact": S.both_equal(a, b), f"{p}_jaccard": S.jaccard(x, y), f"{p}_char_sim": S.jaccard(S.characters(a), S.characters(b)), f"{p}_length_diff": S.length_diff(a, b), f"{p}_common_tokens": F.size(F.array_intersect(x, y))}
        if p == "name":
            out["name_token_count_diff"] = F.abs(F.size(x) - F.size(y))
    same = lambda f: S.both_equal(F.col(f"a_{f}"), F.col(f"b_{f}"))
    return out | {
        "address_numeric_overlap": S.numeric_overlap(F.col("a_numbers"), F.col("b_numbers")), "postal_code_match": same("postal"), "house_number_match": same("house"), "country_exact": same("country_norm"),
        "source_is_s2": (F.col("b_src") == "S2").cast("int"), "source_is_s3": (F.col("b_src") == "S3").cast("int"),
    }


def fuzzy_features() -> dict[str, Column]:
    name = S.ratios(F.col("a_name"), F.col("b_name"), *S.RATIOS)
    address = S.ratios(F.col("a_address"), F.col("b_address"), "fuzzy_ratio", "token_sort_ratio")
    return {f"name_{r}": name[r] for r in S.RATIOS} | {f"address_{r}": address[r] for r in ("fuzzy_ratio", "token_sort_ratio")}


def terms(field: Column, analyzer: str) -> Column:
    """Word 1- and 2-grams of tokens of two or more characters, or character 2- to 4-grams within padded words."""
    low = F.lower(field)
    if analyzer == "word":
        words = F.regexp_extract_all(low, F.lit(rf"([{T.WORD}]{{2,}})"), 1)
        size = F.size(words)
        two = F.when(size >= 2, F.transform(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))).otherwise(F.array().cast("array<string>"))
        return F.concat(words, two)
    words = F.filter(F.split(low, r"\s+"), lambda w: w != "")

    def grams(word):
        # places and sizes of all grams at once; those that would reach beyond the word go
        size = F.length(word) + 2
        every = F.flatten(F.transform(F.sequence(F.lit(1), size - 1), lambda i: F.transform(F.array(F.lit(2), F.lit(3), F.lit(4)), lambda n: F.when(i + n - 1 <= size, F.substr(F.concat(F.lit(" "), word, F.lit(" ")), i, n)))))
        return F.filter(every, lambda g: g.isNotNull())

    return F.flatten(F.transform(words, grams))


def term_counts(docs: DataFrame, field: str, analyzer: str) -> DataFrame:
    """id, term, tf."""
    return docs.select("id", F.explode(terms(F.col(field), analyzer)).alias("term")).groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))


def fit_tfidf(docs: DataFrame, field: str, analyzer: str, max_features: int = 10_000) -> DataFrame:
    """term, idf of the terms with the most occurrences (ties by term): idf = ln((1 + n) / (1 + df)) + 1."""
    n = docs.agg(F.count(F.lit(1)).alias("n"))
    seen = term_counts(docs, field, analyzer).groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
    top = seen.orderBy(F.col("total").desc(), "term").limit(max_features)
    return top.join(F.broadcast(n)).select("term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def weights(docs: DataFrame, field: str, analyzer: str, vocabulary: DataFrame) -> DataFrame:
    """id, term, w: sublinear tf times idf, of unit length by id."""
    raw = term_counts(docs, field, analyzer).join(F.broadcast(vocabulary), "term").select("id", "term", ((1 + F.log(F.col("tf").cast("double"))) * F.col("idf")).alias("x"))
    return raw.select("id", "term", (F.col("x") / F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("id")))).alias("w"))


def weight_maps(docs: DataFrame, vocabularies: dict[str, DataFrame]) -> DataFrame:
    """id, and for each vocabulary (by the name of its feature) a map of terms to weights; null without a term."""
    out = docs.select("id").distinct()
    for name, vocabulary in vocabularies.items():
        maps = weights(docs, *name.split("_tfidf_"), vocabulary).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("term", "w"))).alias(name))
        out = out.join(maps, "id", "left")
    return out


def dot(a: Column, b: Column) -> Column:
    """The cosine of two maps of unit length; 0 where one is null or no term is shared."""
    products = F.map_values(F.map_zip_with(a, b, lambda _, x, y: F.coalesce(x * y, F.lit(0.0))))
    total = F.aggregate(F.array_sort(products), F.lit(0.0), lambda acc, x: acc + x)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(total, F.lit(0.0))))


def _weighted(records: DataFrame, vocabularies: dict[str, DataFrame]) -> DataFrame:
    maps = weight_maps(records.select(F.col("entity_id").alias("id"), "name", "address"), vocabularies)
    return records.join(maps.withColumnRenamed("id", "entity_id"), "entity_id", "left")


def cosine(pairs: DataFrame, s1: DataFrame, pool: DataFrame, field: str, analyzer: str, vocabulary: DataFrame) -> DataFrame:
    """s1, cand, cosine of every pair, 0 where no term is shared."""
    name = f"{field}_tfidf_{analyzer}"
    both = attach(pairs, _weighted(s1, {name: vocabulary}), _weighted(pool, {name: vocabulary}), (name,))
    return both.select("s1", "cand", dot(F.col(f"a_{name}"), F.col(f"b_{name}")).alias("cosine"))


def feature_matrix(pairs: DataFrame, s1: DataFrame, pool: DataFrame, vocabularies: dict[str, DataFrame], columns=FEATURES) -> DataFrame:
    """s1, cand and the features in their order, after one join with either side.

    vocabularies: by feature name of the cosines; a feature without one is 0.
    """
    wanted = {v: d for v, d in vocabularies.items() if v in columns}
    both = attach(pairs, _weighted(s1, wanted), _weighted(pool, wanted), tuple(wanted))
    made = native_features() | fuzzy_features() | {v: dot(F.col(f"a_{v}"), F.col(f"b_{v}")) for v in wanted}
    return both.select("s1", "cand", *[made.get(f, F.lit(0.0)).cast("double").alias(f) for f in columns])
