"""Queries of the linkage engine, each over its whole tables, and the equivalent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from ..operators import blocking, features, labels, metrics, model, outputs, profile
from ..sources import tables
from . import sql

QUERIES, SQL = {}, {}
THRESHOLD = 0.7


def query(name: str, oracle: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if oracle:
            SQL[name] = oracle
        return f

    return keep


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity view, prepared; its text is ASCII."""
    return tables.prepared(tables.entities(spark, sf_dir), fold=False)


def sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    every = records(spark, sf_dir)
    return every.filter("src = 'S1'"), every.filter("src <> 'S1'")


def stored_sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Both sides of records that are normalised once, for plans that read them several times."""
    every = tables.stored(records(spark, sf_dir), "records")
    return every.filter("src = 'S1'"), every.filter("src <> 'S1'")


def links(spark, sf_dir) -> DataFrame:
    return labels.links_of(truth(spark, sf_dir))


def truth(spark, sf_dir) -> DataFrame:
    return labels.parse_truth(tables.truth_of(tables.entities(spark, sf_dir)))


def found(spark, sf_dir) -> DataFrame:
    return blocking.candidates(*stored_sides(spark, sf_dir))


def scored(spark, sf_dir) -> DataFrame:
    s1, pool = stored_sides(spark, sf_dir)
    return scored_pairs(blocking.candidates(s1, pool), s1, pool)


def scored_pairs(candidates: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    pairs = features.attach(candidates, s1, pool)
    return model.linear_score(pairs.select("s1", "cand", *[c.alias(n) for n, c in features.native_features().items()]))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("normalize_text", f"WITH {sql.NORM} SELECT entity_id, name, address, country_norm FROM norm")
def _(spark, d):
    return records(spark, d).select("entity_id", "name", "address", "country_norm")


@query("extract_fields", f"WITH {sql.NORM} SELECT entity_id, postal, house, array_to_string(numbers, ',') AS numbers FROM norm")
def _(spark, d):
    return records(spark, d).select("entity_id", "postal", "house", F.array_join("numbers", ",").alias("numbers"))


@query("tokens_and_ngrams", f"WITH {sql.NORM} SELECT entity_id, len(tk) AS n_tokens, array_to_string(list_sort({sql.GRAMS}), '|') AS grams FROM norm")
def _(spark, d):
    return records(spark, d).select("entity_id", F.size(T.tokenize(F.col("name"))).cast("long").alias("n_tokens"), F.array_join(F.array_sort(T.char_ngrams(F.col("name"))), "|").alias("grams"))


@query("text_flags", rf"WITH {sql.ENT} SELECT entity_id, length(business_name) AS chars, regexp_matches(business_name, '[^\w\s]') AS punctuation, regexp_matches(lower(business_name), '\bltd\b') AS ltd, business_address = '' AS no_address FROM ent")
def _(spark, d):
    name = F.col("business_name")
    return tables.entities(spark, d).select("entity_id", F.length(name).cast("long").alias("chars"), name.rlike(r"[^\w\s]").alias("punctuation"), F.lower(name).rlike(r"\bltd\b").alias("ltd"), (F.col("business_address") == "").alias("no_address"))


def _block(rule):
    @query(f"block_{rule}", f"WITH {sql.keys((rule,))} SELECT entity_id, rule, key FROM keys")
    def _(spark, d):
        return blocking.block_keys(records(spark, d), (rule,))


for _rule in sql.KEYS:
    _block(_rule)


@query("block_prune", f"WITH {sql.pairs()} SELECT rule, key, entity_id FROM pool_keys")
def _(spark, d):
    return blocking.prune(blocking.block_keys(sides(spark, d)[1]))


@query("block_index", f"WITH {sql.keys()} SELECT rule, key, count(DISTINCT entity_id) AS ids FROM keys WHERE src <> 'S1' GROUP BY ALL")
def _(spark, d):
    return blocking.block_keys(sides(spark, d)[1]).distinct().groupBy("rule", "key").agg(F.count(F.lit(1)).alias("ids"))


@query("candidates_union", f"WITH {sql.pairs()} SELECT s1, cand, hits, rules FROM pairs")
def _(spark, d):
    return blocking.pairs(*sides(spark, d)).withColumn("rules", F.array_join("rules", ","))


@query("candidates_topk", f"WITH {sql.ranked()} SELECT s1, cand, source, hits, rules, round(score, 9) AS score, rn::INTEGER AS rn FROM cands")
def _(spark, d):
    return _rounded(found(spark, d).withColumn("rules", F.array_join("rules", ",")))


@query("candidate_stats", f"""WITH {sql.ranked()}, per AS (SELECT count(*) AS n FROM cands GROUP BY s1), c AS (SELECT count(*) FILTER (src = 'S1') * count(*) FILTER (src <> 'S1') AS possible FROM ent)
SELECT any_value(possible) AS possible, sum(n)::BIGINT AS pairs, round(1 - sum(n) / any_value(possible), 9) AS reduction_ratio, round(avg(n), 9) AS avg_per_s1, max(n) AS max_per_s1 FROM per, c""")
def _(spark, d):
    s1, pool = sides(spark, d)
    return _rounded(blocking.candidate_stats(found(spark, d), s1.count(), pool.count()))


@query("candidate_recall", f"""WITH {sql.ranked()}, {sql.LINKS}, per AS (SELECT l.s1, count(*) AS n, count(c.cand) AS k FROM links l LEFT JOIN cands c USING (s1, cand) GROUP BY 1)
SELECT sum(n)::BIGINT AS links, sum(k)::BIGINT AS covered, round(sum(k) / sum(n), 9) AS recall, count(*) AS entities, count(*) FILTER (k = n) AS all_covered, count(*) FILTER (k > 0) AS any_covered, 'OK' AS status FROM per""")
def _(spark, d):
    return _rounded(blocking.candidate_recall(found(spark, d), links(spark, d)))


@query("candidates_char_ngram", f"WITH {sql.pairs(('char_ngram',))} SELECT s1, cand, hits, rules FROM pairs")
def _(spark, d):
    return blocking.pairs(*sides(spark, d), rules=("char_ngram",)).withColumn("rules", F.array_join("rules", ","))


@query("recall_report", f"""WITH {sql.ranked()}, {sql.LINKS}, per AS (SELECT l.s1, count(*) AS n, count(c.cand) AS k FROM links l LEFT JOIN cands c USING (s1, cand) GROUP BY 1),
t AS (SELECT coalesce(sum(n), 0)::BIGINT AS n, coalesce(sum(k), 0)::BIGINT AS k, count(*) AS e, count(*) FILTER (k = n) AS every, count(*) FILTER (k > 0) AS part FROM per)
SELECT round(k / n, 9) AS candidate_recall, CASE WHEN n > 0 THEN 'MEASURED' ELSE 'NOT_AVAILABLE' END AS candidate_recall_status, n AS total_true_links, k AS true_links_covered, n - k AS true_links_missed, e AS s1_entities_with_truth,
every AS entities_all_covered_count, round(100.0::DOUBLE * every / e, 9) AS entities_all_covered_pct, part AS entities_any_covered_count, round(100.0::DOUBLE * part / e, 9) AS entities_any_covered_pct,
(SELECT count(*) FROM ent WHERE src = 'S1' AND entity_id NOT IN (SELECT s1 FROM cands)) AS entities_zero_candidates, (SELECT count(*) FROM ranked) AS candidates_before_cap, (SELECT count(*) FROM cands) AS candidates_after_cap,
(SELECT count(*) FROM ranked JOIN links USING (s1, cand) WHERE rn > 50) AS true_matches_lost_to_cap, 'Candidate recall: ' || printf('%.4f', k / n) AS message FROM t""")
def _(spark, d):
    s1, pool = stored_sides(spark, d)
    every = tables.stored(blocking.ranked(blocking.pairs(s1, pool), s1, pool), "ranked")
    return _rounded(blocking.recall_report(every.filter("rn <= 50"), truth(spark, d), every))


@query("experiment_slice", f"""WITH {sql.ENT}, {sql.LINKS}, few AS (SELECT DISTINCT s1 FROM links ORDER BY s1 LIMIT 100), other AS (SELECT entity_id, src FROM ent WHERE src <> 'S1' QUALIFY row_number() OVER (PARTITION BY src ORDER BY entity_id) <= 200)
SELECT s1 AS entity_id, 'S1' AS src FROM few UNION SELECT entity_id, src FROM other UNION SELECT cand, substr(cand, 1, 2) FROM links WHERE s1 IN (SELECT s1 FROM few)""")
def _(spark, d):
    s1, pool, _ = blocking.experiment_slice(*sides(spark, d), truth(spark, d), others=200)
    return s1.select("entity_id", "src").unionByName(pool.select("entity_id", "src"))


@query("cap_sweep", f"""WITH {sql.ranked()}, {sql.LINKS}, ks AS (SELECT unnest([25, 50, 75, 100, 150])::INTEGER AS k)
SELECT k, count(*) FILTER (rn <= k) AS pairs, count(l.cand) FILTER (rn <= k) AS found, count(l.cand) FILTER (rn > k) AS lost FROM ranked r LEFT JOIN links l USING (s1, cand), ks GROUP BY k""")
def _(spark, d):
    s1, pool = stored_sides(spark, d)
    return blocking.cap_sweep(blocking.ranked(blocking.pairs(s1, pool), s1, pool), truth(spark, d))


_NATIVE = ["name_exact", "name_jaccard", "name_char_sim", "name_length_diff", "name_common_tokens", "name_token_count_diff", "address_exact", "address_jaccard", "address_char_sim", "address_length_diff", "address_common_tokens", "address_numeric_overlap", "postal_code_match", "house_number_match", "country_exact", "source_is_s2", "source_is_s3"]


@query("features_native", f"WITH {sql.SCORED} SELECT s1, cand, {', '.join(f'round({c}::DOUBLE, 9) AS {c}' for c in _NATIVE)} FROM feats")
def _(spark, d):
    return _rounded(scored(spark, d).select("s1", "cand", *[F.col(c).cast("double").alias(c) for c in _NATIVE]))


_RATIOS = ["name_fuzzy_ratio", "name_partial_ratio", "name_token_sort_ratio", "name_token_set_ratio", "address_fuzzy_ratio", "address_token_sort_ratio"]
_nine = lambda columns: ", ".join(f"round({c}::DOUBLE, 9) AS {c}" for c in columns)


@query("features_fuzzy", f"WITH {sql.ranked()}, {sql.fuzzy_features()} SELECT s1, cand, {_nine(_RATIOS)} FROM fuzz")
def _(spark, d):
    s1, pool = stored_sides(spark, d)
    return _rounded(features.attach(blocking.candidates(s1, pool), s1, pool).select("s1", "cand", *[c.alias(n) for n, c in features.fuzzy_features().items()]))


def vocabularies(spark, d, names=features.COSINES) -> dict[str, DataFrame]:
    return {v: _vocabulary(spark, d, *v.split("_tfidf_")) for v in names}


def _vocabulary(spark, d, field, analyzer):
    return features.fit_tfidf(records(spark, d).select(F.col("entity_id").alias("id"), field), field, analyzer)


_COSINES = [v.split("_tfidf_") for v in features.COSINES]
_ALL = f"""WITH {sql.SCORED}, {sql.fuzzy_features()}, {', '.join(f"{sql.tfidf(*v)}, {sql.cosine(*v)}" for v in _COSINES)}
SELECT s1, cand, {', '.join(f"round({f}::DOUBLE, 6) AS {f}" if f not in features.COSINES else f"round({f}.cosine, 6) AS {f}" for f in features.FEATURES)}
FROM feats JOIN fuzz USING (s1, cand) {' '.join(f"JOIN {v} USING (s1, cand)" for v in features.COSINES)}"""


@query("features_all", _ALL)
def _(spark, d):
    s1, pool = stored_sides(spark, d)
    out = features.feature_matrix(blocking.candidates(s1, pool), s1, pool, vocabularies(spark, d))
    return out.select("s1", "cand", *[F.round(f, 6).alias(f) for f in features.FEATURES])


def _tfidf(field, analyzer):
    @query(f"tfidf_{field}_{analyzer}", f"WITH {sql.ranked()}, {sql.tfidf(field, analyzer)}, {sql.cosine(field, analyzer)} SELECT s1, cand, round(cosine, 6) AS cosine FROM {field}_tfidf_{analyzer}")
    def _(spark, d):
        s1, pool = stored_sides(spark, d)
        out = features.cosine(blocking.candidates(s1, pool), s1, pool, field, analyzer, _vocabulary(spark, d, field, analyzer))
        return out.withColumn("cosine", F.round("cosine", 6))

    @query(f"vocabulary_{field}_{analyzer}", f"WITH {sql.NORM}, {sql.PARTS}, fit AS (SELECT entity_id FROM norm WHERE src <> 'S1' OR entity_id IN (SELECT s1 FROM parts WHERE part = 'train')), {sql.tfidf(field, analyzer, 'fit')} SELECT term, round(idf, 9) AS idf FROM {field}_{analyzer}_vocab")
    def _(spark, d):
        """Fitted to the training rows and the pool only."""
        s1, pool = sides(spark, d)
        train = labels.split_entities(truth(spark, d)).filter("part = 'train'").select(F.col("s1").alias("entity_id"))
        corpus = s1.join(train, "entity_id", "left_semi").unionByName(pool)
        return _rounded(features.fit_tfidf(corpus.select(F.col("entity_id").alias("id"), field), field, analyzer))


for _field in ("name", "address"):
    for _analyzer in ("word", "char"):
        _tfidf(_field, _analyzer)


@query("truth_parse", f"WITH {sql.ENT}, {sql.LINKS} SELECT e.entity_id AS s1, coalesce(string_agg(cand, ',' ORDER BY cand), '') AS ids FROM ent e LEFT JOIN links l ON l.s1 = e.entity_id WHERE src = 'S1' GROUP BY 1")
def _(spark, d):
    return truth(spark, d).withColumn("ids", F.array_join("ids", ","))


@query("truth_profile", f"""WITH {sql.ENT}, {sql.LINKS}, r AS (SELECT e.entity_id, count(cand) AS n, count(*) FILTER (cand LIKE 'S2%') AS n2, count(*) FILTER (cand LIKE 'S3%') AS n3 FROM ent e LEFT JOIN links l ON l.s1 = e.entity_id WHERE src = 'S1' GROUP BY 1)
SELECT count(*) AS entities, sum(n)::BIGINT AS links, sum(n2)::BIGINT AS links_s2, sum(n3)::BIGINT AS links_s3, count(*) FILTER (n2 > 0 AND n3 = 0) AS only_s2, count(*) FILTER (n3 > 0 AND n2 = 0) AS only_s3,
count(*) FILTER (n2 > 0 AND n3 > 0) AS both, count(*) FILTER (n = 0) AS none, count(*) FILTER (n = 1) AS one, count(*) FILTER (n > 1) AS many, round(avg(n), 3) AS mean, round(stddev_samp(n), 3) AS std, min(n)::DOUBLE AS least, quantile_cont(n, 0.5)::DOUBLE AS median, max(n)::DOUBLE AS most FROM r""")
def _(spark, d):
    out = profile.truth_profile(truth(spark, d))
    kept = ["entities", "links", "links_s2", "links_s3", "only_s2", "only_s3", "both", "none", "one", "many"]
    return out.select(*kept, F.round("links_mean", 3).alias("mean"), F.round("links_std", 3).alias("std"), F.col("links_min").alias("least"), F.col("links_median").alias("median"), F.col("links_max").alias("most"))


def _labelled(spark, d):
    return labels.label(found(spark, d), truth(spark, d))


_LAB = f"{sql.ranked()}, {sql.LINKS}, lab AS (SELECT c.*, (l.cand IS NOT NULL)::INTEGER AS label FROM cands c LEFT JOIN links l USING (s1, cand))"


@query("label_pairs", f"WITH {_LAB} SELECT s1, cand, label FROM lab")
def _(spark, d):
    return _labelled(spark, d).select("s1", "cand", "label")


@query("prefilter_negatives", f"WITH {_LAB} SELECT s1, cand, label FROM lab QUALIFY label = 1 OR row_number() OVER (PARTITION BY s1, label ORDER BY len(string_split(rules, ',')) DESC, cand) <= 20")
def _(spark, d):
    return labels.prefilter(_labelled(spark, d)).select("s1", "cand", "label")


@query("downsample_negatives", f"WITH {_LAB}, hard AS (SELECT *, len(string_split(rules, ',')) > 1 AS hard, sum(label) OVER (PARTITION BY s1) AS n_pos FROM lab) SELECT s1, cand, label FROM hard QUALIFY label = 1 OR row_number() OVER (PARTITION BY s1, label ORDER BY hard DESC, {sql.place('cand')}, cand) <= greatest(2 * n_pos, 1)")
def _(spark, d):
    return labels.downsample(_labelled(spark, d).withColumn("hard", F.size("rules") > 1), 2).select("s1", "cand", "label")


@query("split_entities", f"WITH {sql.ENT}, {sql.PARTS} SELECT s1, part FROM parts")
def _(spark, d):
    return labels.split_entities(truth(spark, d))


@query("sample_exact", f"WITH {sql.ENT} SELECT entity_id FROM ent ORDER BY {sql.place('entity_id')}, entity_id LIMIT 100")
def _(spark, d):
    return labels.sample_exact(tables.entities(spark, d), 100).select("entity_id")


@query("development_pool", f"WITH {sql.ENT}, {sql.LINKS}, other AS (SELECT entity_id FROM ent WHERE src <> 'S1' AND entity_id NOT IN (SELECT cand FROM links) ORDER BY {sql.place('entity_id')}, entity_id LIMIT 300) SELECT entity_id FROM ent WHERE src <> 'S1' AND entity_id IN (SELECT cand FROM links) UNION ALL SELECT entity_id FROM other")
def _(spark, d):
    return labels.development_pool(sides(spark, d)[1], links(spark, d), 300).select("entity_id")


def _featured(spark, d):
    """The labelled pairs with native features, ratios and the number of rules."""
    s1, pool = stored_sides(spark, d)
    found_ = tables.stored(blocking.candidates(s1, pool), "candidates")
    made = features.attach(found_, s1, pool).select("s1", "cand", *[c.alias(n) for n, c in (features.native_features() | features.fuzzy_features()).items()])
    return labels.label(made.join(found_.select("s1", "cand", F.size("rules").alias("n_rules")), ["s1", "cand"]), truth(spark, d))


_HARD = f"{sql.SCORED}, {sql.fuzzy_features()}, hn AS (SELECT s1, cand, (l.cand IS NOT NULL)::INTEGER AS label, name_fuzzy_ratio >= 65 OR name_token_sort_ratio >= 65 OR name_jaccard >= 0.4 OR len(string_split(rules, ',')) > 1 AS hard FROM cands JOIN feats USING (s1, cand) JOIN fuzz USING (s1, cand) LEFT JOIN links l USING (s1, cand))"


@query("hard_negatives", f"WITH {_HARD} SELECT s1, cand FROM hn WHERE label = 0 AND hard")
def _(spark, d):
    return _featured(spark, d).filter("label = 0").filter(labels.is_hard_negative()).select("s1", "cand")


@query("dataset_composition", f"WITH {_HARD}, {sql.PARTS} SELECT part, label, hard, count(*) AS n FROM hn JOIN parts USING (s1) GROUP BY ALL")
def _(spark, d):
    rows = _featured(spark, d).withColumn("hard", labels.is_hard_negative())
    return labels.composition(rows.join(labels.split_entities(truth(spark, d)), "s1"))


@query("class_counts", f"WITH {_LAB} SELECT sum(label)::BIGINT AS positives, sum(1 - label)::BIGINT AS negatives, round(sum(1 - label) / sum(label), 9) AS weight FROM lab")
def _(spark, d):
    return _rounded(model.class_counts(_labelled(spark, d)))


@query("zero_filled", f"WITH {sql.SCORED} SELECT s1, cand, round(name_jaccard::DOUBLE, 9) AS name_jaccard, 0.0::DOUBLE AS name_tfidf_word, 0.0::DOUBLE AS address_fuzzy_ratio FROM feats")
def _(spark, d):
    return _rounded(model.zero_filled(scored(spark, d).select("s1", "cand", "name_jaccard"), ("name_jaccard", "name_tfidf_word", "address_fuzzy_ratio")))


@query("linear_score", f"WITH {sql.SCORED} SELECT s1, cand, probability FROM linear")
def _(spark, d):
    return scored(spark, d).select("s1", "cand", "probability")


def _accepted(spark, d):
    return outputs.accept(scored(spark, d), THRESHOLD)


def _predicted(spark, d):
    return outputs.grouped(sides(spark, d)[0], _accepted(spark, d))


@query("entity_scores", f"WITH {sql.SCORED}, {sql.entity(str(THRESHOLD))} SELECT s1, n_true, n_pred, tp, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f05, 9) AS f05 FROM es")
def _(spark, d):
    out = metrics.entity_scores(truth(spark, d), _predicted(spark, d)).drop("fp", "fn")
    return _rounded(out.withColumns({c: F.col(c).cast("long") for c in ("n_true", "n_pred", "tp")}))


_MACRO9 = "SELECT {t}n, round(macro_f05, 9) AS macro_f05, round(macro_precision, 9) AS macro_precision, round(macro_recall, 9) AS macro_recall, round(singleton_accuracy, 9) AS singleton_accuracy, round(pair_precision, 9) AS pair_precision, round(pair_recall, 9) AS pair_recall, predicted_links, predicted_singletons FROM m"


@query("macro_scores", f"WITH {sql.SCORED}, {sql.entity(str(THRESHOLD))}, m AS (SELECT {sql.MACRO} FROM es) {_MACRO9.format(t='')}")
def _(spark, d):
    return _rounded(metrics.macro_scores(truth(spark, d), _predicted(spark, d)))


_SWEEP = f"""{sql.SCORED}, ts AS (SELECT unnest([{', '.join(map(str, metrics.THRESHOLDS))}])::DOUBLE AS t), tn AS (SELECT e.entity_id AS s1, count(l.cand) AS n_true FROM ent e LEFT JOIN links l ON l.s1 = e.entity_id WHERE src = 'S1' GROUP BY 1),
acc AS (SELECT t, s1, count(*) AS n_pred, count(l.cand) AS tp FROM linear JOIN ts ON probability >= t LEFT JOIN links l USING (s1, cand) GROUP BY ALL),
ev AS (SELECT t, s1, n_true, coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp FROM tn CROSS JOIN ts LEFT JOIN acc USING (t, s1)),
es AS (SELECT *, {sql.scores('n_true', 'n_pred', 'tp')} FROM ev), m AS (SELECT t, {sql.MACRO} FROM es GROUP BY t)"""


@query("threshold_sweep", f"WITH {_SWEEP} {_MACRO9.format(t='t, ')}")
def _(spark, d):
    return _rounded(metrics.sweep(scored(spark, d), truth(spark, d)))


@query("best_threshold", f"WITH {_SWEEP} SELECT t, round(macro_f05, 9) AS macro_f05 FROM m ORDER BY m.macro_f05 DESC, t LIMIT 1")
def _(spark, d):
    return _rounded(metrics.best_threshold(metrics.sweep(scored(spark, d), truth(spark, d))))


@query("postprocess_guards", f"WITH {sql.SCORED} SELECT s1, cand, probability FROM linear WHERE probability >= {THRESHOLD} AND country_exact = 1")
def _(spark, d):
    return outputs.accept(scored(spark, d), THRESHOLD, require_country=True).select("s1", "cand", "probability")


@query("postprocess_similarity_guards", f"WITH {sql.SCORED}, {sql.fuzzy_features()} SELECT s1, cand, probability FROM linear JOIN fuzz USING (s1, cand) WHERE probability >= 0.3 AND name_fuzzy_ratio >= 60 AND address_fuzzy_ratio >= 50")
def _(spark, d):
    rows = _featured(spark, d)
    return outputs.accept(model.linear_score(rows), 0.3, min_name=60, min_address=50).select("s1", "cand", "probability")


def _listed(which: str, column: str) -> str:
    return f"WITH {sql.SCORED} SELECT e.entity_id AS source1_entity_id, coalesce(string_agg(cand, ',' ORDER BY cand), '') AS {column} FROM ent e LEFT JOIN ({which}) x ON x.s1 = e.entity_id WHERE src = 'S1' GROUP BY 1"


def _matching(spark, d) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The matching output, candidates and both sides; candidates are made once."""
    s1, pool = stored_sides(spark, d)
    c = tables.stored(blocking.candidates(s1, pool), "candidates")
    return outputs.matching_table(s1, outputs.accept(scored_pairs(c, s1, pool), THRESHOLD), c), c, s1, pool


@query("matching_output", _listed(f"SELECT s1, cand FROM linear WHERE probability >= {THRESHOLD}", "matched_entity_ids"))
def _(spark, d):
    return _matching(spark, d)[0]


@query("candidate_output", _listed("SELECT s1, cand FROM cands", "candidate_entity_ids"))
def _(spark, d):
    return outputs.candidate_table(sides(spark, d)[0], found(spark, d))


@query("validate_outputs", f"""WITH {sql.SCORED} SELECT 'matching: unknown id' AS "check", s1, cand AS detail FROM linear WHERE probability >= {THRESHOLD} AND cand LIKE 'S2%'
UNION ALL SELECT 'candidate: unknown id', s1, cand FROM cands WHERE cand LIKE 'S2%'""")
def _(spark, d):
    """The real outputs against a pool that lacks source 2: its ids alone are unknown."""
    m, c, s1, pool = _matching(spark, d)
    return outputs.violations(tables.stored(m, "matching"), outputs.candidate_table(s1, c), s1, pool.filter("src = 'S3'"))


@query("missing_profile", f"""WITH {sql.ENT}, l AS (UNPIVOT (SELECT src, entity_id, business_name, business_address, country FROM ent) ON entity_id, business_name, business_address, country INTO NAME "column" VALUE v)
SELECT src, "column", count(*) FILTER (v = '') AS empty, count(*) FILTER (v <> '' AND trim(v) = '') AS blank, count(*) FILTER (lower(v) IN ('nan', 'null', 'none')) AS null_words, count(*) AS total FROM l GROUP BY ALL""")
def _(spark, d):
    return profile.missing_values(tables.entities(spark, d))


@query("country_profile", f"WITH {sql.ENT}, c AS (SELECT src, lower(trim(country)) AS country, count(*) AS n FROM ent GROUP BY ALL) SELECT src, country, n, round_even(100.0::DOUBLE * n / sum(n) OVER (PARTITION BY src), 4) AS percent FROM c")
def _(spark, d):
    return profile.countries(tables.entities(spark, d))


@query("name_profile", f"WITH {sql.ENT} SELECT src, count(DISTINCT business_name) AS unique_raw, count(DISTINCT lower(business_name)) AS unique_lower, min(length(business_name))::DOUBLE AS chars_min, quantile_cont(length(business_name), 0.5)::DOUBLE AS chars_median, max(length(business_name))::DOUBLE AS chars_max FROM ent GROUP BY 1")
def _(spark, d):
    return profile.names(tables.entities(spark, d)).select("src", "unique_raw", "unique_lower", "chars_min", "chars_median", "chars_max")


@query("address_profile", f"WITH {sql.ENT} SELECT src, count(*) FILTER (business_address = '') AS empty, min(length(business_address)) FILTER (business_address <> '')::DOUBLE AS chars_min, quantile_cont(length(business_address), 0.5) FILTER (business_address <> '')::DOUBLE AS chars_median, max(length(business_address))::DOUBLE AS chars_max FROM ent GROUP BY 1")
def _(spark, d):
    return profile.addresses(tables.entities(spark, d)).select("src", "empty", "chars_min", "chars_median", "chars_max")


@query("true_pair_profile", f"WITH {sql.NORM}, {sql.LINKS} SELECT count(*) AS pairs, sum((a.name = b.name AND a.name <> '')::INTEGER)::BIGINT AS same_name, sum((a.country_norm = b.country_norm)::INTEGER)::BIGINT AS same_country FROM links JOIN norm a ON a.entity_id = s1 JOIN norm b ON b.entity_id = cand")
def _(spark, d):
    both = profile.true_pairs(links(spark, d), *sides(spark, d))
    return both.agg(F.count(F.lit(1)).alias("pairs"), F.sum(S.both_equal(F.col("a_name"), F.col("b_name"))).alias("same_name"), F.sum((F.col("a_country_norm") == F.col("b_country_norm")).cast("int")).alias("same_country"))


_WORD = lambda s, column: rf"regexp_matches(lower({column}), '\b{s}\b')"
_SHARE = lambda c: f"round_even(100.0::DOUBLE * count(*) FILTER ({c}) / count(*), 2)"
_NAMES = rf"""WITH {sql.NORM}, n AS (SELECT *, len(list_filter(string_split(regexp_replace(business_name, '\s+', ' ', 'g'), ' '), lambda t: t <> '')) AS tokens FROM norm)
SELECT src, count(*) AS analyzed, count(DISTINCT business_name) AS unique_raw, count(DISTINCT lower(business_name)) AS unique_lower, count(DISTINCT name) AS unique_normalized,
round_even(100.0::DOUBLE * (1 - count(DISTINCT business_name) / count(*)), 2) AS duplicate_raw_percent, round_even(100.0::DOUBLE * (1 - count(DISTINCT name) / count(*)), 2) AS duplicate_normalized_percent,
count(*) FILTER (trim(business_name) = '') AS empty, {sql.quantiles('length(business_name)', 'chars_')}, {sql.quantiles('tokens', 'tokens_')}, {_SHARE(r"regexp_matches(business_name, '[^\w\s]')")} AS punctuation_percent,
{', '.join(f"count(*) FILTER ({_WORD(x, 'business_name')}) AS suffix_{x}, {_SHARE(_WORD(x, 'business_name'))} AS suffix_{x}_percent" for x in profile.SUFFIXES)} FROM n GROUP BY src"""


@query("name_profile_all", _NAMES)
def _(spark, d):
    return profile.names(tables.entities(spark, d))


_SOME = lambda c: f"round_even(CASE WHEN count(v) > 0 THEN 100.0::DOUBLE * count(*) FILTER ({c}) / count(v) ELSE 0.0 END, 2)"
_ADDRESSES = rf"""WITH {sql.NORM}, a AS (SELECT src, postal, nullif(address, '') AS norm, CASE WHEN trim(business_address) <> '' THEN business_address END AS v FROM norm),
b AS (SELECT *, length(v) AS chars, len(list_filter(string_split(regexp_replace(v, '\s+', ' ', 'g'), ' '), lambda t: t <> '')) AS tokens, len(regexp_extract_all(v, '\b\d+\b')) AS numbers FROM a)
SELECT src, count(*) AS analyzed, count(*) - count(v) AS empty, round_even(100.0::DOUBLE * (count(*) - count(v)) / count(*), 2) AS empty_percent, {sql.quantiles('chars', 'chars_')}, {sql.quantiles('tokens', 'tokens_')}, {sql.quantiles('numbers', 'numbers_')},
{_SOME('numbers > 0')} AS numeric_percent, {_SOME("v IS NOT NULL AND postal <> ''")} AS postal_percent, count(DISTINCT v) AS unique_raw, count(DISTINCT norm) AS unique_normalized,
{', '.join(f"count(*) FILTER ({_WORD(x, 'v')}) AS abbr_{x}, {_SOME(_WORD(x, 'v'))} AS abbr_{x}_percent" for x in profile.ABBREVIATIONS)} FROM b GROUP BY src"""


@query("address_profile_all", _ADDRESSES)
def _(spark, d):
    return profile.addresses(tables.entities(spark, d))


_TRUE = f"""WITH {sql.NORM}, {sql.LINKS}, {sql.fuzzy_features('links')}, t AS (SELECT (a.name = b.name AND a.name <> '')::INTEGER AS ne, (a.address = b.address AND a.address <> '')::INTEGER AS ae, (a.country_norm = b.country_norm AND a.country_norm <> '')::INTEGER AS ce,
name_fuzzy_ratio AS nf, name_token_sort_ratio AS ns, address_fuzzy_ratio AS af, {sql.JACCARD.format(a='list_distinct(a.atk)', b='list_distinct(b.atk)')} AS aj FROM fuzz JOIN norm a ON a.entity_id = s1 JOIN norm b ON b.entity_id = cand)
SELECT count(*) AS pairs, {', '.join(f"round_even(coalesce(100.0::DOUBLE * avg({c}), 0.0), 2) AS {n}_exact_percent" for c, n in (('ne', 'name'), ('ae', 'address'), ('ce', 'country')))},
{', '.join(sql.quantiles(c, f'{n}_') for c, n in (('nf', 'name_fuzzy'), ('ns', 'name_token_sort'), ('af', 'address_fuzzy'), ('aj', 'address_jaccard')))} FROM t"""


@query("true_pair_similarity", _TRUE)
def _(spark, d):
    return profile.true_pair_similarity(links(spark, d), *sides(spark, d))


@query("null_counts", f"WITH {sql.ENT}, e AS (SELECT entity_id, nullif(business_address, '') AS business_address, country FROM ent) SELECT 'entity_id' AS \"column\", count(*) FILTER (entity_id IS NULL) AS nulls FROM e UNION ALL SELECT 'business_address', count(*) FILTER (business_address IS NULL) FROM e UNION ALL SELECT 'country', count(*) FILTER (country IS NULL) FROM e")
def _(spark, d):
    return profile.null_counts(tables.entities(spark, d).select("entity_id", F.nullif("business_address", F.lit("")).alias("business_address"), "country"))


@query("top_countries", f"WITH {sql.NORM}, c AS (SELECT src, country_norm, count(*) AS n FROM norm GROUP BY ALL) SELECT src, country_norm, n, row_number() OVER (PARTITION BY src ORDER BY n DESC, country_norm)::INTEGER AS rank FROM c QUALIFY rank <= 10")
def _(spark, d):
    return profile.top_values(records(spark, d), "country_norm", 10)


@query("source_summary", f'WITH {sql.NORM} SELECT src, count(*) AS "rows", round(avg(length(name)), 9) AS avg_name_length, round(avg(length(address)), 9) AS avg_address_length FROM norm GROUP BY 1')
def _(spark, d):
    return _rounded(profile.source_summary(records(spark, d)))


@query("sampled_summary", f'WITH {sql.NORM}, s AS (SELECT * FROM norm QUALIFY row_number() OVER (PARTITION BY src ORDER BY {sql.place("entity_id")}, entity_id) <= 50) SELECT src, count(*) AS "rows", round(avg(length(name)), 9) AS avg_name_length, round(avg(length(address)), 9) AS avg_address_length FROM s GROUP BY 1')
def _(spark, d):
    """The summary of a sample of each source, which is the feature."""
    every = records(spark, d)
    parts = [labels.sample_exact(every.filter(F.col("src") == s), 50) for s in ("S1", "S2", "S3")]
    return _rounded(profile.source_summary(parts[0].unionByName(parts[1]).unionByName(parts[2])))


def _histogram_sql(column: str) -> str:
    return f"WITH {sql.NORM}, e AS (SELECT src, length({column}) AS v, min(length({column})) OVER (PARTITION BY src) AS low, max(length({column})) OVER (PARTITION BY src) AS high FROM norm) SELECT src, (CASE WHEN high = low THEN 20 ELSE least((v - low) * 40 // (high - low), 39) END)::INTEGER AS bin, count(*) AS n FROM e GROUP BY ALL"


@query("name_length_histogram", _histogram_sql("name"))
def _(spark, d):
    return profile.length_histogram(records(spark, d), "name")


@query("address_length_histogram", _histogram_sql("address"))
def _(spark, d):
    return profile.length_histogram(records(spark, d), "address")


@query("match_histogram", f"WITH {sql.ENT}, {sql.LINKS}, c AS (SELECT entity_id, count(cand) AS n FROM ent LEFT JOIN links ON s1 = entity_id WHERE src = 'S1' GROUP BY 1) SELECT n::INTEGER AS matches, count(*) AS n FROM c GROUP BY c.n")
def _(spark, d):
    return profile.match_histogram(truth(spark, d))


@query("half_even", "SELECT p_partkey, round_even(p_partkey / 8.0::DOUBLE, 2) AS two, round_even(p_partkey / 2.0::DOUBLE, 0) AS none FROM part")
def _(spark, d):
    x = F.col("p_partkey").cast("double")
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", profile.half_even(x / 8, 2).alias("two"), profile.half_even(x / 2, 0).alias("none"))


@query("error_fp", f"WITH {sql.SCORED} SELECT s1, cand, probability FROM linear ANTI JOIN links USING (s1, cand) WHERE probability >= {THRESHOLD}")
def _(spark, d):
    return metrics.false_positives(scored(spark, d), truth(spark, d), THRESHOLD).select("s1", "cand", "probability")


@query("error_fn", f"WITH {sql.SCORED} SELECT s1, cand, probability FROM linear SEMI JOIN links USING (s1, cand) WHERE probability < {THRESHOLD}")
def _(spark, d):
    return metrics.false_negatives(scored(spark, d), truth(spark, d), THRESHOLD).select("s1", "cand", "probability")


@query("blocking_misses", f"WITH {sql.ranked()}, {sql.LINKS} SELECT s1, cand FROM links ANTI JOIN cands USING (s1, cand)")
def _(spark, d):
    return metrics.blocking_misses(truth(spark, d), found(spark, d))


@query("probability_histogram", f"WITH {sql.SCORED}, z AS (SELECT least(floor(probability / 0.05::DOUBLE), 19)::INTEGER AS bin, (l.cand IS NOT NULL)::INTEGER AS label FROM linear LEFT JOIN links l USING (s1, cand)) SELECT bin, label, count(*) AS n FROM z GROUP BY ALL")
def _(spark, d):
    return metrics.histogram(labels.label(scored(spark, d), truth(spark, d)), "probability", 0.0, 1.0, 20, "label")


@query("semi_subset", f"WITH {sql.ENT}, {sql.LINKS} SELECT entity_id FROM ent WHERE src <> 'S1' AND entity_id IN (SELECT cand FROM links)")
def _(spark, d):
    return sides(spark, d)[1].join(links(spark, d).select(F.col("cand").alias("entity_id")), "entity_id", "left_semi").select("entity_id")


@query("anti_complement", f"WITH {sql.ENT}, {sql.LINKS} SELECT entity_id FROM ent WHERE src <> 'S1' AND entity_id NOT IN (SELECT cand FROM links)")
def _(spark, d):
    return sides(spark, d)[1].join(links(spark, d).select(F.col("cand").alias("entity_id")), "entity_id", "left_anti").select("entity_id")


@query("pool_union", f"WITH {sql.ENT} SELECT entity_id, src FROM ent WHERE src IN ('S2', 'S3')")
def _(spark, d):
    every = tables.entities(spark, d).select("entity_id", "src")
    return every.filter("src = 'S2'").unionByName(every.filter("src = 'S3'"))


@query("duplicate_ids", f"WITH {sql.ENT} SELECT truth_key, count(*) AS n FROM ent GROUP BY 1 HAVING count(*) > 1")
def _(spark, d):
    return tables.entities(spark, d).groupBy("truth_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def _written(spark, d) -> dict[str, str]:
    """Paths of the four sources as tab-separated files."""
    every, root = tables.entities(spark, d), tables.scratch(spark, "sources")
    for k in (1, 2, 3):
        tables.write_tsv(every.filter(F.col("src") == f"S{k}").select(*tables.SOURCE_COLUMNS), f"{root}/source{k}")
    tables.write_tsv(tables.truth_of(every), f"{root}/ground_truth")
    return {name: f"{root}/{name}" for name in ("source1", "source2", "source3", "ground_truth")}


@query("source_scan", f"WITH {sql.ENT} SELECT {', '.join(tables.SOURCE_COLUMNS)} FROM ent WHERE src = 'S1'")
def _(spark, d):
    return tables.read_tsv(spark, _written(spark, d)["source1"])


@query("truth_scan", f"WITH {sql.ENT}, {sql.LINKS} SELECT entity_id AS source1_entity_id, coalesce(string_agg(cand, ',' ORDER BY cand), '') AS matched_entity_ids FROM ent LEFT JOIN links ON s1 = entity_id WHERE src = 'S1' GROUP BY 1")
def _(spark, d):
    return tables.read_truth(spark, _written(spark, d)["ground_truth"])


_COUNTS = f"WITH {sql.ENT} SELECT lower(src) AS source, count(*) AS \"rows\" FROM ent GROUP BY 1"


@query("train_bundle", f"{_COUNTS} UNION ALL SELECT 'truth', count(*) FROM ent WHERE src = 'S1'")
def _(spark, d):
    return spark.createDataFrame(list(tables.load(spark, _written(spark, d)).summary().items()), "source string, rows long")


@query("test_bundle", _COUNTS)
def _(spark, d):
    paths = {k: v for k, v in _written(spark, d).items() if k != "ground_truth"}
    return spark.createDataFrame(list(tables.load(spark, paths).summary().items()), "source string, rows long")


@query("dataset_sizes", f"WITH {sql.ENT} SELECT 'source' || substr(src, 2) AS source, count(*) AS \"rows\", 'entity_id,business_name,business_address,country' AS columns, true AS has_bytes FROM ent GROUP BY ALL")
def _(spark, d):
    sizes = {k: tables.dataset_sizes(spark, v) for k, v in _written(spark, d).items() if k != "ground_truth"}
    return spark.createDataFrame([(k, v["rows"], ",".join(v["columns"]), v["bytes"] > v["rows"]) for k, v in sizes.items()], "source string, rows long, columns string, has_bytes boolean")


@query("schema_check", "SELECT 'whole' AS \"table\", '' AS missing, 'src,truth_key' AS unexpected, true AS valid UNION ALL SELECT 'part', 'business_address,country', '', false")
def _(spark, d):
    every = tables.entities(spark, d)
    found_ = {"whole": tables.inspect_schema(every), "part": tables.inspect_schema(every.select("entity_id", "business_name"))}
    return spark.createDataFrame([(k, ",".join(v["missing"]), ",".join(v["unexpected"]), v["valid"]) for k, v in found_.items()], "table string, missing string, unexpected string, valid boolean")


@query("head_scan", f"WITH {sql.ENT} SELECT entity_id, business_name FROM ent ORDER BY entity_id LIMIT 80")
def _(spark, d):
    return tables.head(tables.entities(spark, d), 80).select("entity_id", "business_name")


@query("truth_last_wins", f"WITH {sql.ENT}, {sql.LINKS} SELECT entity_id AS s1, CASE WHEN entity_id LIKE '%1' THEN 'S9-1,S9-2' ELSE coalesce(string_agg(cand, ',' ORDER BY cand), '') END AS ids FROM ent LEFT JOIN links ON s1 = entity_id WHERE src = 'S1' GROUP BY 1")
def _(spark, d):
    """Repeated master rows: of some, a later line has another list."""
    first = tables.truth_of(tables.entities(spark, d)).withColumn("line", F.lit(1))
    later = first.filter("source1_entity_id LIKE '%1'").select("source1_entity_id", F.lit("S9-2, S9-1").alias("matched_entity_ids"), F.lit(2).alias("line"))
    return labels.parse_truth(first.unionByName(later), "line").withColumn("ids", F.array_join("ids", ","))


@query("evaluate_at_threshold", f"WITH {sql.SCORED}, {sql.entity('0.5')}, m AS (SELECT {sql.MACRO} FROM es) {_MACRO9.format(t='0.5::DOUBLE AS threshold, ')}")
def _(spark, d):
    return _rounded(metrics.evaluate(scored(spark, d), truth(spark, d), 0.5))


@query("coverage_report", f"WITH {sql.ENT} SELECT 'matching' AS output, count(*) AS \"rows\", count(*) AS expected, 0::BIGINT AS missing, 0::BIGINT AS extra FROM ent WHERE src = 'S1' UNION ALL SELECT 'part', count(*) FILTER (entity_id LIKE '%1'), count(*), count(*) FILTER (entity_id NOT LIKE '%1'), 0 FROM ent WHERE src = 'S1'")
def _(spark, d):
    whole, _, s1, _ = _matching(spark, d)
    return outputs.coverage(whole, s1, "matching").unionByName(outputs.coverage(whole.filter("source1_entity_id LIKE '%1'"), s1, "part"))


@query("matching_summary", f"WITH {sql.SCORED}, n AS (SELECT entity_id, count(cand) AS n FROM ent LEFT JOIN (SELECT s1, cand FROM linear WHERE probability >= {THRESHOLD}) ON s1 = entity_id WHERE src = 'S1' GROUP BY 1) SELECT sum(n)::BIGINT AS links, count(*) FILTER (n = 0) AS singletons FROM n")
def _(spark, d):
    return outputs.summary(_matching(spark, d)[0])


@query("stream_matches", f"WITH {sql.ranked()} SELECT s1, cand, rn::INTEGER AS rn FROM cands")
def _(spark, d):
    """Master rows as a stream of three files, each matched as a batch of its own and appended."""
    from ..streaming import scoring

    s1, pool = sides(spark, d)
    source, out, marks = (tables.scratch(spark, n) for n in ("stream", "matches", "marks"))
    s1.repartition(3, "entity_id").write.parquet(source)
    rows = spark.readStream.schema(s1.schema).option("maxFilesPerTrigger", 1).parquet(source)
    scoring.match_stream(rows, lambda batch: blocking.candidates(batch, pool).select("s1", "cand", "rn"), out, marks).awaitTermination()
    return spark.read.parquet(out).select("s1", "cand", "rn")


@query("gbt_scores")
def _(spark, d):
    """Gradient-boosted trees on native features, fitted to the training part and scored on the rest."""
    rows = tables.stored(labels.label(scored(spark, d).drop("probability"), truth(spark, d)).join(labels.split_entities(truth(spark, d)), "s1"), "pairs")
    fitted = model.train(rows.filter("part = 'train'"), "gbt", _NATIVE, 10)
    return model.predict(rows.filter("part = 'validation'"), fitted).select("s1", "cand", "label", "probability")


@query("model_scores")
def _(spark, d):
    """A logistic model on native features, fitted to the training part and scored on the rest."""
    parts = labels.split_entities(truth(spark, d))
    rows = labels.label(scored(spark, d).drop("probability"), truth(spark, d)).join(parts, "s1")
    fitted = model.train(rows.filter("part = 'train'"), "logistic", _NATIVE, 20)
    return model.predict(rows.filter("part = 'validation'"), fitted).select("s1", "cand", "label", "probability")


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(SQL)
