"""Check two output tables against their sources: python -m tallymark.plans.validator --matching M --candidates C --source1 S --source2 S --source3 S.

Prints what is wrong, the first ten of each kind, and exits with 1 if anything is.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import outputs
from ..sources import tables


def errors_of(spark: SparkSession, matching: str, candidates: str, sources: dict[str, str], most: int = 10) -> list[str]:
    """What is wrong with outputs at two paths, in words; none if they are sound."""
    out = []
    for path, expected, label in ((matching, outputs.MATCHING, "matching"), (candidates, outputs.CANDIDATE, "candidate")):
        if not tables.exists(spark, path):
            out.append(f"{label}: {path} is missing")
        else:
            out += outputs.header_errors(tables.first_line(spark, path), expected, label)
    if out:
        return out
    s1 = tables.read_tsv(spark, sources["source1"])
    pool = tables.read_tsv(spark, sources["source2"]).select("entity_id").unionByName(tables.read_tsv(spark, sources["source3"]).select("entity_id"))
    m, c = tables.read_tsv(spark, matching, outputs.MATCHING), tables.read_tsv(spark, candidates, outputs.CANDIDATE)
    for df, label in ((m, "matching"), (c, "candidate")):
        r = outputs.coverage(df, s1, label).first()
        if (r["rows"], r["missing"], r["extra"]) != (r["expected"], 0, 0):
            out.append(f"{label}: {r['rows']} rows, {r['expected']} expected; {r['missing']} ids missing, {r['extra']} unknown")
    bad = tables.stored(outputs.violations(m, c, s1, pool), "violations")
    for r in bad.groupBy("check").agg(F.count(F.lit(1)).alias("n"), F.slice(F.array_sort(F.collect_set(F.concat_ws(" ", "s1", "detail"))), 1, most).alias("some")).orderBy("check").collect():
        out.append(f"{r['check']}: {r['n']}, as {'; '.join(r['some'])}")
    return out


def main(argv: list[str] | None = None) -> int:
    args = argparse.ArgumentParser(prog="tallymark-validate")
    for name in ("matching", "candidates", "source1", "source2", "source3"):
        args.add_argument(f"--{name}", required=True)
    got = vars(args.parse_args(argv))
    spark = SparkSession.builder.appName("tallymark-validate").getOrCreate()
    found = errors_of(spark, got["matching"], got["candidates"], {k: got[k] for k in ("source1", "source2", "source3")})
    for line in found:
        print(line)
    print("sound" if not found else f"{len(found)} kinds of errors")
    return int(bool(found))


if __name__ == "__main__":
    sys.exit(main())
