"""Markdown reports from the JSON and tables that stages have written."""

from __future__ import annotations

from pyspark.sql import SparkSession


def write_lines(spark: SparkSession, lines: list[str], path: str) -> None:
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def number(value) -> str:
    return "-" if value is None else f"{value:,}" if isinstance(value, int) else f"{value:.4f}" if isinstance(value, float) else str(value)


def listed(record: dict) -> list[str]:
    return [f"- {k}: {number(v)}" for k, v in record.items()]


def table(rows: list[dict]) -> list[str]:
    if not rows:
        return ["no rows"]
    head = list(rows[0])
    return ["| " + " | ".join(head) + " |", "|" + "-|" * len(head), *("| " + " | ".join(number(r[c]) for c in head) + " |" for r in rows)]


def profile_report(parts: dict[str, list[dict]]) -> list[str]:
    lines = ["# Data profile", ""]
    for name, rows in parts.items():
        lines += [f"## {name}", ""]
        lines += (listed(rows[0]) if len(rows) == 1 else table(rows)) + [""]
    return lines


def summary_report(sizes: dict[str, int], summaries: list[dict], truth: dict) -> list[str]:
    return ["# Summary of the sources", "", *listed(sizes), "", "## A sample of each", "", *table(summaries), "", "## Truth", "", *listed(truth)]


def cap_report(rows: list[dict], seconds: float) -> list[str]:
    return ["# Caps on candidates", "", f"Ranked once, in {seconds:.1f} s; each cap is a cut of the same ranks.", "", *table(rows)]


def final_report(manifest: dict, facts: dict[str, dict | None]) -> list[str]:
    lines = ["# Run", "", f"- created: {manifest['created']}", f"- mode: {manifest['mode']}", f"- commit: {short(manifest['git']['commit'])}"]
    lines += [f"- valid: {'yes' if manifest['metrics']['valid'] else 'no'}", ""]
    for name, record in facts.items():
        lines += [f"## {name}", "", *(listed(record) if record else ["not there"]), ""]
    return lines + ["## Outputs", "", *(f"- {name}: {len(files)} files, {short(' '.join(sorted(files.values())))}" for name, files in manifest["outputs"].items())]


def short(digest: str) -> str:
    return digest[:12] or "none"
