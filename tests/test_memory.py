"""No plan of the linkage engine broadcasts a stored table, whose files are far smaller than its rows."""

import re

import pytest

from tallymark.operators import labels, metrics, model
from tallymark.plans import catalog
from tallymark.sources import tables

QUERIES = [
    "candidate_recall",
    "candidate_stats",
    "best_threshold",
    "blocking_misses",
    "candidate_output",
    "candidates_topk",
    "cap_sweep",
    "coverage_report",
    "dataset_composition",
    "entity_scores",
    "error_fn",
    "error_fp",
    "evaluate_at_threshold",
    "features_all",
    "features_fuzzy",
    "features_native",
    "gbt_scores",
    "hard_negatives",
    "label_pairs",
    "linear_score",
    "macro_scores",
    "matching_output",
    "matching_summary",
    "postprocess_guards",
]


def broadcasts(df) -> list[str]:
    """What lies below each broadcast of a plan, as text."""
    lines, out = df._jdf.queryExecution().executedPlan().toString().split("\n"), []
    depth = lambda line: len(re.match(r"[\s:+*-]*", line).group())
    for k, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = next((n for n in range(k + 1, len(lines)) if depth(lines[n]) <= depth(line)), len(lines))
            out.append("\n".join(lines[k:below]))
    return out


@pytest.mark.parametrize("name", QUERIES)
def test_stored_tables_are_not_broadcast(spark, monkeypatch, name):
    plans, stored, key = [], tables.stored, "spark.sql.maxMetadataStringLength"
    monkeypatch.setattr(tables, "stored", lambda df, to: plans.append(df) or stored(df, to))
    monkeypatch.setattr(model, "train", lambda *a: None)
    monkeypatch.setattr(model, "predict", lambda rows, _: rows.selectExpr("*", "0.0 AS probability"))
    spark.conf.set(key, 5000)
    try:
        plans.append(catalog.queries()[name](spark, "/root/testdata/sf0.001"))
        below = [b for df in plans for b in broadcasts(df)]
    finally:
        spark.conf.unset(key)
    assert len(plans) > 1
    assert [b for b in below if re.search(r"/(records|candidates|scored|pairs)-[0-9a-f]{32}", b)] == []


@pytest.mark.parametrize("name", ["best_threshold", "cap_sweep", "dataset_composition", "error_fn", "error_fp", "hard_negatives", "label_pairs"])
def test_links_are_not_rows(spark, name):
    """Lists of true matches are joined whole: at 60 times sf0.1 they hold 215,689,600 links, of 5,915,000 candidates."""
    plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(ids" not in plan and "array_contains" in plan


def test_lists_of_true_matches(spark):
    """Master rows without a list, without a pair, with an empty list."""
    truth = spark.createDataFrame([("a", ["x", "y"]), ("b", ["z"]), ("c", [])], "s1 string, ids array<string>")
    pairs = spark.createDataFrame([("a", "x", 0.9), ("a", "z", 0.8), ("c", "x", 0.1), ("d", "x", 0.9), ("a", "y", 0.1)], "s1 string, cand string, probability double")
    ids = lambda df: sorted((r.s1, r.cand) for r in df.collect())
    assert ids(labels.label(pairs, truth).filter("label = 1")) == [("a", "x"), ("a", "y")] and labels.label(pairs, truth).count() == 5
    assert ids(metrics.false_positives(pairs, truth, 0.7)) == [("a", "z"), ("d", "x")] and ids(metrics.false_negatives(pairs, truth, 0.7)) == [("a", "y")]
    assert ids(metrics.blocking_misses(truth, pairs)) == [("b", "z")]
