"""Unit expectations of the linkage operators, and parity with DuckDB on the smallest tables."""

import math

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymark.functions import similarity as S
from tallymark.functions import text as T
from tallymark.operators import blocking, labels, metrics, outputs
from tallymark.plans import catalog
from tallymark.sources import tables

SF = "/root/testdata/sf0.001"


def one(spark, column, *values):
    return spark.createDataFrame([values], [f"c{k}" for k in range(len(values))]).select(column.alias("x")).first().x


@pytest.mark.parametrize("text,want", [("ACME Corp", "acme"), ("Ben & Jerry", "ben and jerry"), ("x co ltd", "x co"), ("Café Résumé", "cafe resume"), ("", ""), ("Foo, Inc.", "foo")])
def test_names(spark, text, want):
    assert one(spark, T.normalize_name(F.col("c0")), text) == want


def test_addresses(spark):
    assert one(spark, T.normalize_address(F.col("c0")), "123 Main St.") == "123 main street"
    assert one(spark, T.postal_code(F.col("c0")), "Springfield 62704") == "62704"
    assert one(spark, T.postal_code(F.col("c0")), "Bangalore 560001") == "560001"
    assert one(spark, T.postal_code(F.col("c0")), "none") == ""
    assert one(spark, T.house_number(F.col("c0")), "42b baker") == "42b"
    assert one(spark, T.numeric_tokens(F.col("c0")), "unit 3 204 5th 500") == ["3", "204", "500"]
    assert one(spark, T.char_ngrams(F.col("c0")), "abcd") == ["abc", "bcd"]
    assert one(spark, T.char_ngrams(F.col("c0")), "ab") == ["ab"]


def plain_partial(a, b):
    """Every window of the shorter text's size, of two texts as long both ways."""
    best = 0.0
    for short, long in {(a, b), (b, a)} if len(a) == len(b) else {tuple(sorted((a, b), key=len))}:
        best = max([best, *(S.indel_ratio(short, long[max(0, k) : k + len(short)]) for k in range(1 - len(short), len(long)))])
    return best


@settings(max_examples=80, deadline=None)
@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert S.lcs(a, b) == table[-1][-1]
    assert abs(S.best_window_ratio(a, b) - plain_partial(a, b)) < 1e-9 and abs(S.best_window_ratio(a, b) - S.best_window_ratio(b, a)) < 1e-9
    assert S.best_window_ratio(a, f"x{a}y") == (100.0 if a else 0.0) and S.indel_ratio(a, a) == (100.0 if a else 0.0)
    assert abs(S.token_set_ratio(a, b) - S.token_set_ratio(b, a)) < 1e-9


def test_lcs_native(spark):
    rows = [("acme tools", "acne tool"), ("", "x"), ("abcbdab", "bdcaba")]
    got = spark.createDataFrame(rows, "a string, b string").select(S.lcs_native(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [S.lcs(*r) for r in rows]


def test_prune(spark):
    keys = spark.createDataFrame([("r", "common", f"e{k}") for k in range(5)] + [("r", "rare", "e1"), ("r", "rare", "e2")], "rule string, key string, entity_id string")
    assert {r.key for r in blocking.prune(keys, 3).collect()} == {"rare"}
    assert blocking.prune(keys, 0).count() == 7


def test_truth(spark):
    raw = spark.createDataFrame([("a", " S2-1, S3-2,"), ("b", "nan"), ("c", ""), ("d", None)], "source1_entity_id string, matched_entity_ids string")
    assert {r.s1: r.ids for r in labels.parse_truth(raw).collect()} == {"a": ["S2-1", "S3-2"], "b": [], "c": [], "d": []}


def test_scores(spark):
    t = spark.createDataFrame([("a", ["x", "y"]), ("b", []), ("c", []), ("d", ["z"])], "s1 string, ids array<string>")
    p = spark.createDataFrame([("a", ["x"]), ("b", []), ("c", ["q"])], "s1 string, ids array<string>")
    got = {r.s1: (r.precision, r.recall, round(r.f05, 4)) for r in metrics.entity_scores(t, p).collect()}
    assert got == {"a": (1.0, 0.5, 0.8333), "b": (1.0, 1.0, 1.0), "c": (0.0, 1.0, 0.0), "d": (0.0, 0.0, 0.0)}
    assert metrics.macro_scores(t, p).first().singleton_accuracy == 0.5


def test_recall_without_links(spark):
    none = spark.createDataFrame([], "s1 string, cand string")
    row = blocking.candidate_recall(none, none).first()
    assert row.recall is None and row.status == "NOT_AVAILABLE"


def test_threshold():
    assert outputs.resolve_threshold(0.99, 0.8, 0.77) == (0.99, "explicit")
    assert outputs.resolve_threshold(None, None, 0.77) == (0.77, "selected")
    assert outputs.resolve_threshold() == (0.5, "default")


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("S1-1", ""), ("S1-2", "S2-1,S3-4")], "source1_entity_id string, matched_entity_ids string")
    tables.write_tsv(df, str(tmp_path / "m"))
    assert sorted(map(tuple, tables.read_truth(spark, str(tmp_path / "m")).collect())) == [("S1-1", ""), ("S1-2", "S2-1,S3-4")]
    with pytest.raises(FileNotFoundError):
        tables.read_tsv(spark, str(tmp_path / "none"))


def test_true_pair_similarity(spark, tmp_path):
    from tallymark.operators import profile
    from tallymark.plans import config, workflow

    master = [("S1-1", "Acme Tools", "12 Main Street", "US"), ("S1-2", "Blue Fox", "7 Hill Road", "FR"), ("S1-3", "Lone", "", "DE")]
    second = [("S2-1", "Acme Tools", "12 Main Street", "US"), ("S2-2", "Tools Acme", "12 Main Road", "US")]
    third = [("S3-1", "Blue Box", "", "DE")]
    truth = [("S1-1", "S2-1,S2-2"), ("S1-2", "S3-1,S3-404"), ("S1-3", "")]  # one id is unknown
    for name, part in (("source1", master), ("source2", second), ("source3", third)):
        tables.write_tsv(spark.createDataFrame(part, "entity_id string, business_name string, business_address string, country string"), f"{tmp_path}/{name}")
    tables.write_tsv(spark.createDataFrame(truth, "source1_entity_id string, matched_entity_ids string"), f"{tmp_path}/ground_truth")
    cfg = config.Config(out=f"{tmp_path}/out", train={n: f"{tmp_path}/{n}" for n in ("source1", "source2", "source3", "ground_truth")})
    workflow.run_eda(spark, cfg)
    got = spark.read.json(f"{tmp_path}/out/eda/true_pairs").first().asDict()
    pairs = [("acme tools", "acme tools", "12 main street", "12 main street"), ("acme tools", "tools acme", "12 main street", "12 main road"), ("blue fox", "blue box", "7 hill road", "")]
    jaccard = lambda a, b: len(set(a.split()) & set(b.split())) / len(set(a.split()) | set(b.split()))
    want = {
        "name_fuzzy": [S.indel_ratio(a, b) for a, b, _, _ in pairs], "name_token_sort": [S.token_sort_ratio(a, b) for a, b, _, _ in pairs],
        "address_fuzzy": [S.indel_ratio(a, b) for _, _, a, b in pairs], "address_jaccard": [jaccard(a, b) for _, _, a, b in pairs],
    }
    assert (got["pairs"], got["name_exact_percent"], got["address_exact_percent"], got["country_exact_percent"]) == (3, 33.33, 33.33, 66.67)
    for name, values in want.items():
        low, middle, high = sorted(values)
        stats = {"mean": sum(values) / 3, "min": low, "p25": (low + middle) / 2, "median": middle, "p75": (middle + high) / 2, "p90": middle + 0.8 * (high - middle), "max": high}
        assert all(abs(got[f"{name}_{k}"] - v) <= 0.0051 for k, v in stats.items()), (name, got)
        assert abs(got[f"{name}_std"] - math.sqrt(sum((v - stats["mean"]) ** 2 for v in values) / 2)) <= 0.0051
    assert "true_pairs" in spark.read.text(f"{tmp_path}/out/eda/report.md").agg(F.concat_ws(" ", F.collect_list("value"))).first()[0]
    none = catalog.links(spark, SF).limit(0)
    assert profile.true_pair_similarity(none, *catalog.sides(spark, SF)).first().pairs == 0


def test_whole_profiles(spark):
    for name, columns in (("name_profile", ("tokens_p90", "chars_p25", "punctuation_percent", "suffix_ltd_percent")), ("address_profile", ("tokens_p75", "numbers_mean", "postal_percent", "abbr_st_percent"))):
        few, every = (catalog.queries()[n](spark, SF).toPandas() for n in (name, f"{name}_all"))
        assert set(columns) <= set(every.columns) and rows(few) == rows(every[few.columns])


def rows(df):
    cell = lambda v: round(float(v), 6) if isinstance(v, float) or getattr(getattr(v, "dtype", None), "kind", "") == "f" else v
    df = df[sorted(df.columns)]
    return sorted((tuple("" if v is None or (isinstance(v, float) and math.isnan(v)) else str(cell(v)) for v in r) for r in df.itertuples(index=False)))


def test_ratios_in_one_pass(spark):
    pairs = [("acme tools", "acne tool"), ("", "x"), ("a b", "b a"), ("same", "same"), (None, "x"), (" ", " "), ("acme tools", "acne tool")]
    df = spark.createDataFrame(pairs, "a string, b string").coalesce(1)
    got = [tuple(r[0]) for r in df.select(S.ratios(F.col("a"), F.col("b"), *S.RATIOS)).collect()]
    assert got == [tuple(f(a or "", b or "") for f in S.RATIOS.values()) for a, b in pairs]


def test_feature_flags():
    from tallymark.operators import features

    assert features.enabled() == features.FEATURES and len(features.enabled()) == 27
    left = features.enabled(("name_tfidf_cosine", "source_indicator", "postal_code_match"))
    assert len(left) == 22 and not {"name_tfidf_word", "source_is_s3", "postal_code_match"} & set(left)
    with pytest.raises(ValueError):
        features.enabled(("nothing",))


def test_split_is_exact(spark):
    from tallymark.operators import labels

    universe = spark.createDataFrame([(f"S1-{k}",) for k in range(1013)], "s1 string")
    for share in (0.0, 0.2, 0.5, 1.0):
        assert labels.split_entities(universe, share).filter("part = 'validation'").count() == int(share * 1013)
    capped = labels.split_entities(universe, 0.2, train_cap=10, validation_cap=5).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in capped} == {"train": 10, "validation": 5}


def test_cosine(spark):
    """Above 0 with a shared term, exactly 0 without, and with an unknown id."""
    from tallymark.operators import features

    rows = spark.createDataFrame([("S1-1", "acme tools", "S1"), ("S2-1", "acme works", "S2"), ("S2-2", "blue fox", "S2")], "entity_id string, name string, src string")
    rows = rows.selectExpr("*", "'' AS address", "'' AS postal", "'' AS house", "'' AS country_norm", "cast(array() AS array<string>) AS numbers")
    vocabulary = features.fit_tfidf(rows.select(F.col("entity_id").alias("id"), "name"), "name", "word")
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-1", "S2-404")], "s1 string, cand string")
    got = {r.cand: r.cosine for r in features.cosine(pairs, rows.filter("src = 'S1'"), rows.filter("src = 'S2'"), "name", "word", vocabulary).collect()}
    assert 0 < got["S2-1"] < 1 and got["S2-2"] == 0.0 and got["S2-404"] == 0.0


def test_cap_keeps_the_best(spark):
    """A true match with a late id is kept over noise that shares one key."""
    rows = [("S1-1", "alpha beta", "10001", "US", "S1")] + [(f"S2-{k:05d}", f"alpha noise{k}", "", "", "S2") for k in range(20)] + [("S2-99999", "alpha beta", "10001", "US", "S2")]
    df = spark.createDataFrame([(i, n, "", p, c, s) for i, n, p, c, s in rows], "entity_id string, name string, address string, postal string, country_norm string, src string")
    found = blocking.candidates(df.filter("src = 'S1'"), df.filter("src = 'S2'"), k=5)
    assert found.count() == 5 and found.filter("rn = 1").first().cand == "S2-99999"


@pytest.mark.parametrize("name", ["normalize_text", "extract_fields", "block_char_ngram", "candidates_topk", "features_native", "threshold_sweep", "matching_output", "missing_profile", "features_all", "recall_report", "name_profile_all", "address_profile_all", "true_pair_similarity", "source_scan", "stream_matches", "dataset_composition"])
def test_parity(spark, name):
    c = duckdb.connect()
    for t in ("part", "nation"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert rows(catalog.queries()[name](spark, SF).toPandas()) == rows(c.execute(catalog.oracle_sql()[name]).df())
