"""The stages over source files that the test writes, and what the checks find in spoilt outputs."""

import json

import pytest

from tallymark.operators import outputs
from tallymark.plans import config, validator, workflow
from tallymark.sources import tables

SCHEMA = "entity_id string, business_name string, business_address string, country string"
WORDS = ("Amber", "Birch", "Cedar", "Delta", "Ember", "Falcon", "Garnet", "Harbor", "Indigo", "Juniper", "Kestrel", "Lantern")


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    name = lambda k: f"{WORDS[k % 12]} {WORDS[(k // 12 + 5 * k) % 12]} {('Tools', 'Foods', 'Media')[k % 3]}"
    rows = {1: [], 2: [], 3: []}
    truth = []
    for k in range(90):
        where = f"{k + 1} {WORDS[(k * 7) % 12]} St., {10000 + 37 * k}"
        rows[1].append((f"S1-{k:03d}", f"{name(k)} Ltd.", where, "Été"))
        ids = []
        if k % 10 != 9:
            rows[2].append((f"S2-{k:03d}", f"{name(k).upper()}, Inc.", where.replace("St.", "Street"), " été "))
            ids.append(f"S2-{k:03d}")
        if k % 3 == 0:
            rows[3].append((f"S3-{k:03d}", name(k).replace("a", "e"), where, "Ete"))
            ids.append(f"S3-{k:03d}")
        truth.append((f"S1-{k:03d}", ",".join(ids)))
    for k in range(60):
        rows[2 + k % 2].append((f"S{2 + k % 2}-9{k:02d}", f"{name(3 * k + 1)} {WORDS[k % 12]}", f"{k} Other Road, {20000 + k}", "Peru"))
    for k, part in rows.items():
        tables.write_tsv(spark.createDataFrame(part, SCHEMA).coalesce(1), f"{root}/source{k}")
    tables.write_tsv(spark.createDataFrame(truth, "source1_entity_id string, matched_entity_ids string").coalesce(1), f"{root}/ground_truth")
    return root


def settings(sources, out, **more):
    paths = {n: f"{sources}/{n}" for n in ("source1", "source2", "source3")}
    return config.Config(out=str(out), train=paths | {"ground_truth": f"{sources}/ground_truth"}, test=paths, model=config.Model(iterations=5, least=1), **more)


@pytest.fixture(scope="module")
def run(spark, sources, tmp_path_factory):
    cfg = settings(sources, tmp_path_factory.mktemp("out"))
    for stage in workflow.ALL:
        assert workflow.STAGES[stage](spark, cfg) is not False, stage
    return cfg


def test_all_stages(spark, run):
    recall = tables.read_json(spark, f"{run.out}/metrics/candidate_recall")
    assert recall["candidate_recall_status"] == "MEASURED" and recall["candidate_recall"] > 0.9 and len(recall) == 15
    best = workflow.run_evaluate(spark, run)
    assert best["macro_f05"] > 0.8 and best["n"] == 18 and best["threshold_source"] == "persisted"
    swept = spark.read.json(f"{run.out}/threshold_sweep")
    assert swept.count() == 14 and abs(swept.agg({"macro_f05": "max"}).first()[0] - best["macro_f05"]) < 1e-9
    m = tables.read_tsv(spark, f"{run.out}/matching_results.tsv", outputs.MATCHING)
    got = {r.source1_entity_id: set(r.matched_entity_ids.split(",")) - {""} for r in m.collect()}
    assert len(got) == 90 and got["S1-000"] >= {"S2-000"} and sum(f"S2-{k[3:]}" in v for k, v in got.items()) > 70
    for path in ("eda/report.md", "eda/eda.log", "eda/sources/source1", "eda/bins/name_lengths", "reports/summary.md", "reports/final.md", "metrics/composition", "metrics/importances", "manifest"):
        assert tables.exists(spark, f"{run.out}/{path}"), path
    assert tables.read_json(spark, f"{run.out}/eda/sources/source2")["full_rows"] == 81 + 30


def test_streams_and_batches_agree(spark, run):
    """Candidates of a part of the master rows are those of all rows."""
    from tallymark.operators import blocking

    s1, pool, _ = workflow._load(spark, run, "test")
    some = s1.filter("entity_id LIKE '%1'")
    few = blocking.candidates(some, pool).select("s1", "cand", "rn").collect()
    every = {tuple(r) for r in spark.read.parquet(f"{run.out}/candidates").select("s1", "cand", "rn").collect()}
    assert few and {tuple(r) for r in few} <= every


def test_cache_is_used_until_settings_change(spark, run):
    from dataclasses import replace

    s1, pool, _ = workflow._load(spark, run, "test")
    path = f"{run.out}/ranked/test-{run.candidate_key('test')}"
    assert tables.exists(spark, path)
    spoilt = spark.read.parquet(path).limit(1).collect()
    spark.createDataFrame(spoilt, spark.read.parquet(path).schema).write.mode("overwrite").parquet(path)
    assert workflow._ranked(spark, s1, pool, run, "test").count() == 1
    assert workflow._ranked(spark, s1, pool, replace(run, cache=config.Cache(invalidate=True)), "test").count() > 100
    assert replace(run, blocking=config.Blocking(max_block_size=7)).candidate_key("test") != run.candidate_key("test")


def test_verify_tells_what_is_wrong(spark, sources, run, tmp_path):
    assert workflow.verify(spark, run) == []
    s1, pool = (tables.read_tsv(spark, f"{sources}/source{k}") for k in (1, 2))
    m, c = (tables.read_tsv(spark, f"{run.out}/{n}", ("source1_entity_id",)) for n in workflow.OUTPUTS)
    paths = run.paths("test")
    spoil = {
        "missing": (m.filter("source1_entity_id <> 'S1-000'"), c), "extra": (m.unionByName(m.limit(1).selectExpr("'S1-x' AS source1_entity_id", "'' AS matched_entity_ids")), c),
        "no candidate": (m.selectExpr("source1_entity_id", "if(source1_entity_id = 'S1-009', 'S2-959', matched_entity_ids) AS matched_entity_ids"), c),
        "duplicate id": (m, c.selectExpr("source1_entity_id", "if(source1_entity_id = 'S1-003', 'S2-003,S2-003', candidate_entity_ids) AS candidate_entity_ids")),
        "unknown id": (m, c.selectExpr("source1_entity_id", "if(source1_entity_id = 'S1-009', 'S2-nothing', candidate_entity_ids) AS candidate_entity_ids")),
        "columns": (m.withColumnRenamed("matched_entity_ids", "ids"), c), "tabs": (m.select("source1_entity_id"), c),
    }
    for what, (a, b) in spoil.items():
        tables.write_tsv(a, f"{tmp_path}/m")
        tables.write_tsv(b, f"{tmp_path}/c")
        found = validator.errors_of(spark, f"{tmp_path}/m", f"{tmp_path}/c", paths)
        assert found and any(what in line for line in found), (what, found)
    assert validator.errors_of(spark, f"{tmp_path}/none", f"{tmp_path}/c", paths)[0].endswith("is missing")
    assert s1.count() == 90 and pool.count() > 90


def test_smoke_test(spark, sources, tmp_path):
    assert workflow.run_smoke_test(spark, settings(sources, tmp_path), entities=60, others=100)


def test_cap_experiment(spark, sources, tmp_path):
    cfg = settings(sources, tmp_path)
    workflow.run_cap_experiment(spark, cfg, 20, 50)
    rows = {r.k: r for r in spark.read.json(f"{tmp_path}/cap_experiment").collect()}
    assert sorted(rows) == [25, 50, 75, 100, 150] and rows[25].found <= rows[150].found and tables.read_json(spark, f"{tmp_path}/cap_experiment_run")["entities"] == 20


def test_evaluation_without_predictions(spark, sources, tmp_path):
    assert workflow.run_evaluate(spark, settings(sources, tmp_path)) is None


def test_features_that_are_off(spark, sources, tmp_path):
    cfg = settings(sources, tmp_path, features=config.Features(off=("name_tfidf_cosine", "address_tfidf_cosine", "name_fuzzy_ratio")))
    for stage in ("train", "tune", "predict"):
        workflow.STAGES[stage](spark, cfg)
    assert len(tables.read_json(spark, f"{tmp_path}/classifier/meta")["features"]) == 22 and workflow.run_validate(spark, cfg)


def test_settings(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text(json.dumps({"mode": "final", "blocking": {"rules": ["postal_code"], "max_candidates": 7}, "features": {"off": ["source_indicator"]}, "model": {"kind": "forest"}, "cache": {"enabled": False}, "preprocessing": {"legal_suffixes": ["ltd"]}}))
    cfg = config.load_config(str(path), data_root="/d")
    assert cfg.training.train_cap is None and cfg.blocking.rules == ("postal_code",) and len(cfg.features.columns) == 25 and cfg.model.kind == "forest" and not cfg.cache.enabled
    assert cfg.preprocessing.legal_suffixes == ("ltd",) and cfg.paths("test")["source1"] == "/d/data/test/test_source1.tsv"
    assert config.load_config("nowhere", mode="odd").mode == "dev" and config.load_config(str(path), mode="dev").training.train_cap == 50_000
    path.write_text(json.dumps({"features": {"off": ["nothing"]}}))
    with pytest.raises(ValueError):
        config.load_config(str(path))
