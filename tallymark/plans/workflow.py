"""Stages of a linkage run: env-check, eda, train, tune, predict, evaluate, validate, verify, smoke-test, cap-experiment, all."""

from __future__ import annotations

import argparse
import logging
import sys
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking, features, labels, metrics, model, outputs, profile
from ..sources import tables
from . import audit, reports, validator
from .config import Config, load_config

log = logging.getLogger("tallymark")
OUTPUTS = ("matching_results.tsv", "candidate_pairs.tsv")


def _session() -> SparkSession:
    return SparkSession.builder.appName("tallymark").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def _load(spark, cfg: Config, part: str) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Prepared master rows and pool, and parsed truth, of which the last of repeated rows counts."""
    src, p = tables.load(spark, cfg.paths(part)), cfg.preprocessing
    named = lambda df, s: tables.prepared(df.withColumn("src", F.lit(s)), True, p.legal_suffixes, p.abbreviations)
    pool = named(src.s2, "S2").unionByName(named(src.s3, "S3"), allowMissingColumns=True)
    return named(src.s1, "S1"), pool, labels.parse_truth(src.truth, "line") if src.truth is not None else None


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _ranked(spark, s1, pool, cfg: Config, part: str) -> DataFrame:
    """All ranked pairs, written; those of an earlier run with the same sources and settings, if the cache is on."""
    path = f"{cfg.out}/ranked/{part}-{cfg.candidate_key(part)}"
    if cfg.cache.enabled and not cfg.cache.invalidate and tables.exists(spark, f"{path}/_SUCCESS"):
        return spark.read.parquet(path)
    return _kept(blocking.ranked(blocking.pairs(s1, pool, cfg.blocking.rules, cfg.blocking.max_block_size), s1, pool), path)


def _candidates(ranked: DataFrame, cfg: Config) -> DataFrame:
    return ranked.filter(F.col("rn") <= cfg.blocking.max_candidates)


def _json(df: DataFrame, path: str) -> list[dict]:
    """Written as JSON; the rows, which are few."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return [r.asDict() for r in df.sparkSession.read.schema(df.schema).json(path).limit(100).collect()]


def run_train(spark: SparkSession, cfg: Config) -> None:
    """Split, fit vocabularies to training rows and the pool, fit the model, keep scored validation pairs."""
    s1, pool, truth = _load(spark, cfg, "train")
    t, m, columns = cfg.training, cfg.model, cfg.features.columns
    parts = _kept(labels.split_entities(truth, t.validation_split, train_cap=t.train_cap, validation_cap=t.validation_cap), f"{cfg.out}/parts")
    part = lambda p: parts.filter(F.col("part") == p).select(F.col("s1").alias("entity_id"))
    s1_train = s1.join(part("train"), "entity_id", "left_semi")
    corpus = s1_train.select(F.col("entity_id").alias("id"), "name", "address").unionByName(pool.select(F.col("entity_id").alias("id"), "name", "address"))
    for v in (c for c in features.COSINES if c in columns):
        features.fit_tfidf(corpus, *v.split("_tfidf_"), cfg.features.max_terms).write.mode("overwrite").parquet(f"{cfg.out}/tfidf/{v}")
    ranked = _ranked(spark, s1, pool, cfg, "train").join(parts, "s1")
    found = labels.label(_candidates(ranked, cfg).drop("rn"), truth)
    held_truth = _kept(truth.join(parts.filter("part = 'validation'"), "s1", "left_semi"), f"{cfg.out}/validation_truth")
    before = ranked.filter("part = 'validation'")
    _json(blocking.recall_report(_candidates(before, cfg), held_truth, before), f"{cfg.out}/metrics/candidate_recall")
    pruned, held = labels.prefilter(found.filter("part = 'train'"), t.max_negatives), found.filter("part = 'validation'")
    kept = _kept(pruned.unionByName(labels.prefilter(held, t.max_negatives) if t.prefilter_validation else held).select("s1", "cand", "label", "part", F.size("rules").alias("n_rules")), f"{cfg.out}/pairs")
    matrix = _kept(features.feature_matrix(kept, s1, pool, _vocabularies(spark, cfg), columns).join(kept, ["s1", "cand"]), f"{cfg.out}/matrix")
    # a feature that is off can't make a negative hard
    train = matrix.filter("part = 'train'")
    rows = labels.downsample(train.withColumn("hard", _hard(train)), t.max_negatives)
    _json(labels.composition(rows.unionByName(matrix.filter("part = 'validation'").withColumn("hard", F.lit(False)))), f"{cfg.out}/metrics/composition")
    fitted = model.train(rows, m.kind, columns, m.iterations, step=m.step, depth=m.depth, least=m.least, share=m.share)
    counts = model.class_counts(rows).first().asDict()
    model.save(fitted, f"{cfg.out}/classifier", {"features": list(columns), "model": m.kind, "mode": cfg.mode} | counts)
    if m.kind != "logistic":
        tables.write_json(spark, dict(model.importances(fitted)), f"{cfg.out}/metrics/importances")
    scored = model.predict(matrix.filter("part = 'validation'"), fitted)
    scored.select("s1", "cand", "label", "probability").write.mode("overwrite").parquet(f"{cfg.out}/validation")


def _hard(rows: DataFrame):
    missing = [c for c in ("name_fuzzy_ratio", "name_token_sort_ratio", "name_jaccard") if c not in rows.columns]
    return F.col("n_rules") > 1 if missing else labels.is_hard_negative()


def _vocabularies(spark, cfg: Config) -> dict[str, DataFrame]:
    """The fitted vocabularies; without them a run stops rather than fits to test rows."""
    return {v: spark.read.parquet(f"{cfg.out}/tfidf/{v}") for v in features.COSINES if v in cfg.features.columns}


def run_tune(spark: SparkSession, cfg: Config) -> None:
    swept = metrics.sweep(spark.read.parquet(f"{cfg.out}/validation"), spark.read.parquet(f"{cfg.out}/validation_truth"), cfg.post.thresholds)
    _json(swept.orderBy("t"), f"{cfg.out}/threshold_sweep")
    best = metrics.best_threshold(spark.read.json(f"{cfg.out}/threshold_sweep")).first().asDict()
    tables.write_json(spark, best, f"{cfg.out}/selected_threshold")


def _json_or_none(spark, path: str) -> dict | None:
    return tables.read_json(spark, path) if tables.exists(spark, path) else None


def _threshold(spark, cfg: Config) -> tuple[float, str]:
    kept = _json_or_none(spark, f"{cfg.out}/selected_threshold")
    return outputs.resolve_threshold(None, kept and kept["t"], cfg.post.threshold, cfg.post.default)


def run_predict(spark: SparkSession, cfg: Config) -> None:
    s1, pool, _ = _load(spark, cfg, "test")
    found = _kept(_candidates(_ranked(spark, s1, pool, cfg, "test"), cfg), f"{cfg.out}/candidates")
    fitted = model.load(f"{cfg.out}/classifier")
    columns = model.feature_names(fitted, cfg.features.columns)
    scored = model.predict(features.feature_matrix(found, s1, pool, _vocabularies(spark, cfg), columns), fitted)
    p = cfg.post
    good = outputs.accept(scored, _threshold(spark, cfg)[0], p.min_name, p.min_address, p.require_country)
    tables.write_tsv(outputs.matching_table(s1, good, found).orderBy("source1_entity_id"), f"{cfg.out}/{OUTPUTS[0]}")
    tables.write_tsv(outputs.candidate_table(s1, found).orderBy("source1_entity_id"), f"{cfg.out}/{OUTPUTS[1]}")


def run_evaluate(spark: SparkSession, cfg: Config) -> dict | None:
    """The scores of the validation pairs at the resolved threshold; none without scored pairs."""
    if not tables.exists(spark, f"{cfg.out}/validation"):
        log.warning("no validation pairs below %s", cfg.out)
        return None
    t, source = _threshold(spark, cfg)
    out = metrics.evaluate(spark.read.parquet(f"{cfg.out}/validation"), spark.read.parquet(f"{cfg.out}/validation_truth"), t).first().asDict() | {"threshold_source": source}
    tables.write_json(spark, out, f"{cfg.out}/metrics/eval_t{t:.2f}")
    tables.write_json(spark, out, f"{cfg.out}/metrics/eval")
    return out


def _errors(spark, cfg: Config) -> list[str]:
    return validator.errors_of(spark, *(f"{cfg.out}/{n}" for n in OUTPUTS), cfg.paths("test"))


def run_validate(spark: SparkSession, cfg: Config) -> bool:
    """Errors of the outputs are logged; the manifest and the report are written whether there are any or not."""
    bad = _errors(spark, cfg)
    for line in bad:
        log.error("%s", line)
    there = {n: f"{cfg.out}/{n}" for n in OUTPUTS if tables.exists(spark, f"{cfg.out}/{n}")}
    manifest = audit.manifest(spark, cfg.mode, there, {"valid": not bad})
    tables.write_json(spark, manifest, f"{cfg.out}/manifest")
    facts = {"candidate recall": _json_or_none(spark, f"{cfg.out}/metrics/candidate_recall"), "validation": _json_or_none(spark, f"{cfg.out}/metrics/eval"), "threshold": _json_or_none(spark, f"{cfg.out}/selected_threshold")}
    if OUTPUTS[0] in there:
        facts["links"] = outputs.summary(tables.read_tsv(spark, there[OUTPUTS[0]], outputs.MATCHING)).first().asDict()
    reports.write_lines(spark, reports.final_report(manifest, facts), f"{cfg.out}/reports/final.md")
    return not bad


def verify(spark: SparkSession, cfg: Config) -> list[str]:
    """What is missing or wrong with sources, model, outputs and manifest; none if the run is whole."""
    out = [f"source is missing: {p}" for part in ("train", "test") for p in cfg.paths(part).values() if not tables.exists(spark, p)]
    out += [f"artefact is missing: {n}" for n in ("classifier/model", "classifier/meta", "selected_threshold", "manifest") if not tables.exists(spark, f"{cfg.out}/{n}")]
    if out:
        return out
    meta = tables.read_json(spark, f"{cfg.out}/classifier/meta")
    if set(meta["features"]) != set(cfg.features.columns):
        out.append(f"the model has {len(meta['features'])} features, the settings {len(cfg.features.columns)}")
    out += _errors(spark, cfg)
    kept = tables.read_json(spark, f"{cfg.out}/manifest")["outputs"]
    for n in OUTPUTS:
        if tables.exists(spark, f"{cfg.out}/{n}") and kept.get(n) != audit.data_digest(spark, f"{cfg.out}/{n}"):
            out.append(f"{n} isn't what the manifest describes")
    return out


def run_verify(spark: SparkSession, cfg: Config) -> bool:
    bad = verify(spark, cfg)
    for line in bad:
        log.error("%s", line)
    return not bad


def run_eda(spark: SparkSession, cfg: Config) -> None:
    """Profiles as JSON, bins of figures, two reports and a log."""
    began, said = time.time(), []
    s1, pool, truth = _load(spark, cfg, "train")
    every = s1.unionByName(pool, allowMissingColumns=True)
    profiles = {
        "missing": profile.missing_values(every), "countries": profile.countries(every), "names": profile.names(every, fold=True), "addresses": profile.addresses(every, fold=True), "truth": profile.truth_profile(truth),
        "true_pairs": profile.true_pair_similarity(labels.links_of(truth), s1, pool),
    }
    bins = {
        "top_countries": profile.top_values(every, "country_norm", 8), "name_lengths": profile.length_histogram(every, "name"), "address_lengths": profile.length_histogram(every, "address"), "matches": profile.match_histogram(truth),
    }
    rows = {}
    for name, df in (profiles | {f"bins/{k}": v for k, v in bins.items()}).items():
        rows[name] = _json(df, f"{cfg.out}/eda/{name}")
        said.append(f"{time.time() - began:8.1f} s  {name}: {len(rows[name])} rows or more")
    sample = [labels.sample_exact(every.filter(F.col("src") == s), 50_000) for s in ("S1", "S2", "S3")]
    summary = _json(profile.source_summary(sample[0].unionByName(sample[1]).unionByName(sample[2])), f"{cfg.out}/eda/summary")
    sizes = tables.load(spark, cfg.paths("train")).summary()
    for k, r in (("source" + r["src"][1:], r) for r in summary):
        top = [x for x in rows["bins/top_countries"] if x["src"] == r["src"]]
        tables.write_json(spark, r | {"full_rows": sizes["s" + k[-1]], "top_countries": {x["country_norm"]: x["n"] for x in top}}, f"{cfg.out}/eda/sources/{k}")
    reports.write_lines(spark, reports.profile_report({k: rows[k] for k in profiles}), f"{cfg.out}/eda/report.md")
    reports.write_lines(spark, reports.summary_report(sizes, summary, rows["truth"][0]), f"{cfg.out}/reports/summary.md")
    reports.write_lines(spark, [*said, f"{time.time() - began:8.1f} s  done"], f"{cfg.out}/eda/eda.log")


def run_cap_experiment(spark: SparkSession, cfg: Config, entities: int = 100, others: int = 25_000) -> None:
    """Recall and volume by cap over a small slice, ranked once, with the time that it took."""
    s1, pool, truth = _load(spark, cfg, "train")
    s1, pool, truth = blocking.experiment_slice(s1, pool, truth, entities, others)
    began = time.time()
    full = _kept(blocking.ranked(blocking.pairs(s1, pool, cfg.blocking.rules, cfg.blocking.max_block_size), s1, pool), f"{cfg.out}/cap_slice")
    seconds = time.time() - began
    rows = _json(blocking.cap_sweep(full, truth).orderBy("k"), f"{cfg.out}/cap_experiment")
    tables.write_json(spark, {"seconds": seconds, "entities": s1.count(), "pool": pool.count()}, f"{cfg.out}/cap_experiment_run")
    reports.write_lines(spark, reports.cap_report(rows, seconds), f"{cfg.out}/reports/cap_experiment.md")


def run_env_check(spark: SparkSession, cfg: Config) -> bool:
    ok, found = audit.environment()
    log.info("%s", found)
    return ok


def run_smoke_test(spark: SparkSession, cfg: Config, entities: int = 80, others: int = 2000) -> bool:
    """All stages over the first master rows and a small pool, in a scratch folder; true if the outputs verify."""
    root, src = tables.scratch(spark, "smoke"), tables.load(spark, cfg.paths("train"))
    s1 = tables.head(src.s1, entities).select(*tables.SOURCE_COLUMNS)
    truth = src.truth.join(s1.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    wanted = labels.links_of(labels.parse_truth(truth, "line")).select(F.col("cand").alias("entity_id")).distinct()
    paths = {}
    for name, df in (("source1", s1), ("source2", src.s2), ("source3", src.s3)):
        if name != "source1":  # truth's own rows and the first others
            df = df.select(*tables.SOURCE_COLUMNS)
            df = df.join(wanted, "entity_id", "left_semi").unionByName(tables.head(df, others)).dropDuplicates(["entity_id"])
        paths[name] = f"{root}/{name}"
        tables.write_tsv(df, paths[name])
    tables.write_tsv(truth.drop("line"), f"{root}/ground_truth")
    small = replace(cfg, out=f"{root}/out", train=paths | {"ground_truth": f"{root}/ground_truth"}, test=paths, model=replace(cfg.model, iterations=min(5, cfg.model.iterations), least=1))
    for stage in ("train", "tune", "predict", "evaluate", "validate", "verify"):
        if STAGES[stage](spark, small) in (False, None) and stage in ("evaluate", "validate", "verify"):
            log.error("smoke test: %s", stage)
            return False
    return True


STAGES = {
    "env-check": run_env_check, "eda": run_eda, "train": run_train, "tune": run_tune, "predict": run_predict, "evaluate": run_evaluate,
    "validate": run_validate, "verify": run_verify, "cap-experiment": run_cap_experiment, "smoke-test": run_smoke_test,
}
ALL = ("eda", "train", "tune", "predict", "evaluate", "validate", "verify")


def main(argv: list[str] | None = None) -> int:
    args = argparse.ArgumentParser(prog="tallymark")
    args.add_argument("--stage", choices=[*STAGES, "all"], default="all")
    args.add_argument("--mode")
    args.add_argument("--config")
    args.add_argument("--data-root")
    got = args.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark, cfg = _session(), load_config(got.config, got.data_root, got.mode)
    for stage in ALL if got.stage == "all" else (got.stage,):
        log.info("stage %s", stage)
        if STAGES[stage](spark, cfg) is False:
            return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
