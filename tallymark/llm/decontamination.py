"""Benchmark decontamination: exact windows and proximity by a distributed positional inverted index.

The index holds postings (term, document, position) of the terms that searches start from. A
window of a test item (10 words, or the whole item if it has fewer) takes its two rarest
terms, by counts over the whole corpus, and intersects their postings from the rarest on:
each term's positions, less its offset in the window, are the places where the window may
start. Places that all lists share are compared with the document's words, so that hits are
exact. Proximity joins two terms' postings by document and stretch of positions. Nothing but
native operations.

Terms of many postings are dealt out: a term's postings get a salt for each SALT of them. All
joins are on thin rows, and Spark itself sends a side to all executors only if its measured
size is below spark.sql.autoBroadcastJoinThreshold.

Null texts and texts without words have none, and are hit by nothing. Rows that share doc_id
and text get the same result; null doc_ids are a value like any other. Items that share an
item_id count as one, and so do those without one: they hit like any other and are counted,
but the list of ids has no entry for them. A window that several items have is searched once.
Empty tables give no rows, or no hits. Extra columns, whatever their names, stay in
drop_contaminated and go elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

#: Words of a window, lists that are intersected before words are compared, and postings of a term to a salt.
WINDOW, LISTS, SALT = 10, 2, 1_000_000
DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text):
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), DELIMITERS), lambda w: w != "")


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, phrase (words), wid (their digest) of every window of every item."""
    rows = shared.with_columns(benchmark, "item_id", "text").select("item_id", words(F.col("text")).alias("item")).filter(F.size("item") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("item") - window + 1, F.lit(1)))
    each = rows.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("item", s, window))).alias("phrase"))
    return each.withColumn("wid", F.unhex(F.md5(F.array_join("phrase", " ")))).distinct()


def frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n of those of the terms that occur."""
    seen = shared.with_columns(docs, "text").select(F.explode(words(F.col("text"))).alias("term"))
    return seen.join(terms.select("term"), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def salts(n):
    return F.ceil(n / SALT).cast("int")


def index(docs: DataFrame, counted: DataFrame) -> DataFrame:
    """Postings of the given terms (term, n), and at least one row for each document.

    Columns doc_id, text_key, n_words, pos (from 0; null of a document without words), term and
    salt (null of another term, where pos is 0).
    """
    rows = shared.with_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("w"))
    # the array itself must not go along, or a long document would be shuffled once a word
    each = rows.select("doc_id", "text_key", F.size("w").alias("n_words"), F.posexplode_outer("w").alias("pos", "term"))
    known = counted.select("term", salts(F.col("n")).alias("salts"))
    found = each.join(known, "term", "left").filter("salts IS NOT NULL OR pos IS NULL OR pos = 0")
    salt = F.pmod(F.xxhash64("doc_id", "text_key"), F.col("salts")).cast("int")
    return found.select("doc_id", "text_key", "n_words", "pos", F.when(F.col("salts").isNotNull(), F.col("term")).alias("term"), salt.alias("salt"))


def searches(phrases: DataFrame, counted: DataFrame) -> DataFrame:
    """wid, size, n and lists (term, offset) of each phrase's rarest terms in order; none of phrases with a term that never occurs."""
    each = phrases.select("wid", F.size("phrase").alias("size"), F.posexplode("phrase").alias("offset", "term"))
    ranked = each.join(counted, "term").groupBy("wid", "size").agg(F.array_sort(F.collect_list(F.struct("n", "term", "offset"))).alias("all")).filter(F.size("all") == F.col("size"))
    lists = F.transform(F.slice("all", 1, LISTS), lambda t: F.struct(t["term"].alias("term"), t["offset"].alias("offset")))
    return ranked.select("wid", "size", F.col("all")[0]["n"].alias("n"), lists.alias("lists"))


def intersect(postings: DataFrame, asked: DataFrame) -> DataFrame:
    """doc_id, text_key, wid, start: where all of a search's lists agree."""
    first = asked.select("wid", "size", "lists", F.col("lists")[0]["term"].alias("term"), F.col("lists")[0]["offset"].alias("offset"), F.explode(F.sequence(F.lit(0), salts(F.col("n")) - 1)).alias("salt"))
    found = postings.join(first, ["term", "salt"]).withColumn("start", F.col("pos") - F.col("offset")).filter("start >= 0 AND start + size <= n_words")
    found = found.select("doc_id", "text_key", "wid", "start", "lists")
    at = postings.filter("term IS NOT NULL").select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), F.col("pos").alias("p"), F.col("term").alias("t"))
    for i in range(1, LISTS):
        here = F.get("lists", F.lit(i))  # shorter phrases ask for their first term again
        term, offset = F.coalesce(here["term"], F.col("lists")[0]["term"]), F.coalesce(here["offset"], F.col("lists")[0]["offset"])
        found = found.withColumns({"ti": term, "pi": F.col("start") + offset})
        found = found.join(at, (F.col("ti") == F.col("t")) & (F.col("text_key") == F.col("k")) & (F.col("pi") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("d")), "left_semi")
    return found.select("doc_id", "text_key", "wid", "start")


def matches(docs: DataFrame, postings: DataFrame, phrases: DataFrame, asked: DataFrame) -> DataFrame:
    """doc_id, text_key, hits (array of start, wid, phrase) of the documents that have any, exactly."""
    found = intersect(postings, asked).join(phrases.select("wid", "phrase"), "wid")
    found = shared.materialise(found.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "wid", "phrase")).alias("hits")), "found")
    keys = shared.materialise(found.select("doc_id", "text_key"), "keys")  # few and thin, so that texts need no shuffle for them
    rows = shared.with_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    joined, names = shared.by_row(shared.by_row(rows, keys, "left_semi")[0], found, "inner")
    joined = joined.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("w"), F.col(names["hits"]).alias("hits"))
    exact = F.filter("hits", lambda h: F.slice("w", h["start"] + 1, F.size(h["phrase"])) == h["phrase"])
    return joined.select("doc_id", "text_key", exact.alias("hits")).filter(F.size("hits") > 0).dropDuplicates(["doc_id", "text_key"])


def _covered(intervals):
    """The number of places that an array of (first, last) covers."""
    step = lambda acc, x: F.struct(
        F.greatest(acc["last"], x["last"]).alias("last"), (acc["n"] + F.greatest(F.lit(0), x["last"] - F.greatest(acc["last"], x["first"] - 1))).alias("n")
    )
    return F.aggregate(F.array_sort(intervals), F.struct(F.lit(-1).alias("last"), F.lit(0).alias("n")), step, lambda acc: acc["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, items (sorted strings), n_items of every document row."""
    items = shared.materialise(windows(benchmark, window), "items")
    phrases = shared.materialise(items.select("wid", "phrase").distinct(), "phrases")
    terms = shared.materialise(phrases.select(F.explode("phrase").alias("term")).distinct(), "terms")
    counted = shared.materialise(frequencies(docs, terms), "frequencies")
    asked = shared.materialise(searches(phrases, counted), "searches")
    wanted = shared.materialise(counted.join(asked.select(F.explode("lists.term").alias("term")).distinct(), "term", "left_semi"), "wanted")
    postings = shared.materialise(index(docs, wanted), "postings")
    found = shared.materialise(matches(docs, postings, phrases, asked), "matches")
    spans = F.transform("hits", lambda h: F.named_struct(F.lit("first"), h["start"], F.lit("last"), h["start"] + F.size(h["phrase"]) - 1))
    each = found.select("doc_id", "text_key", _covered(spans).cast("long").alias("n_hit"), F.explode(F.array_distinct("hits.wid")).alias("wid"))
    named = each.join(items.select("wid", "item_id"), "wid").groupBy("doc_id", "text_key").agg(F.max("n_hit").alias("n_hit"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"), F.max(F.col("item_id").isNull().cast("long")).alias("unnamed"))
    named = shared.materialise(named.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "n_hit", "items", (F.size("items") + F.col("unnamed")).alias("n_items")), "named")
    every = postings.filter("pos IS NULL OR pos = 0").select("doc_id", "text_key", F.greatest("n_words", F.lit(0)).cast("long").alias("n_words"))
    joined = every.join(named, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    return joined.select("doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"))


def near(docs: DataFrame, first: str, second: str, within: int) -> DataFrame:
    """Proximity: doc_id, pos of term first with term second at most within words away, on either side."""
    terms = docs.sparkSession.createDataFrame([(t,) for t in {first, second}], "term string")
    postings = shared.materialise(index(docs, frequencies(docs, terms)), "postings")
    stretch = F.floor(F.col("pos") / within).cast("long")
    left = postings.filter(F.col("term") == first).select("doc_id", "text_key", "pos", F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("stretch"))
    right = postings.filter(F.col("term") == second).select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), F.col("pos").alias("p"), stretch.alias("s"))
    met = left.doc_id.eqNullSafe(right.d) & (left.text_key == right.k) & (left.stretch == right.s) & (F.abs(left.pos - right.p).between(1, within))
    return left.join(right, met, "left_semi").select("doc_id", "text_key", "pos").distinct().select("doc_id", "pos")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no window of the benchmark hits, with their columns."""
    bad = shared.materialise(decontaminate(docs, benchmark).filter("n_hit > 0").select("doc_id", "text_key"), "bad")
    return shared.by_row(docs, bad, "left_anti")[0]


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def _words_sql(text: str) -> str:
    return rf"list_filter(string_split_regex(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{DELIMITERS}'), lambda w: w <> '')"


OP8_SQL = rf"""
WITH d AS (SELECT doc_id, {_words_sql('text')} AS w FROM documents),
b AS (SELECT item_id, {_words_sql('text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[s:s + 9], ' ') AS win FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS win FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(s) WHERE len(w) >= size),
hit AS (SELECT doc_id, s, size, item_id FROM dw JOIN bw USING (size, win)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + size)) AS t(p) GROUP BY 1),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN item USING (doc_id)
"""
