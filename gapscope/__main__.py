"""Command line for the batch jobs, e.g. under spark-submit.

    spark-submit --py-files gapscope.zip gapscope/__main__.py clean-facts --landing .../facts_raw --out .../facts
    python -m gapscope report --facts .../facts --rates .../rates --out .../report

The session comes from the environment (``SparkSession.builder.getOrCreate``),
so cluster settings, the checkpoint folder and the master are the
submitter's.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from gapscope.plans import jobs
from gapscope.sources.schemas import FACTS_CLEAN


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gapscope")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("clean-facts", "clean-rates"):
        s = sub.add_parser(name)
        s.add_argument("--landing", required=True)
        s.add_argument("--out", required=True)
        if name == "clean-facts":
            s.add_argument("--first-year", type=int, default=None)
        s.add_argument("--counts", default=None, help="folder for the row counts of the steps")
        s.add_argument("--rejects", default=None, help="folder for lines whose fields do not fit the header")
        s.add_argument("--fail-on-rejects", action="store_true")
    s = sub.add_parser("clean-ratio")
    s.add_argument("--documents", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("snapshot")
    s.add_argument("--facts", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--as-of", default=None)
    s.add_argument("--lookback-days", type=int, default=7)
    s = sub.add_parser("merge-late")
    s.add_argument("--snapshot", required=True)
    s.add_argument("--batch", required=True, help="clean-facts table holding the late rows")
    s = sub.add_parser("report")
    s.add_argument("--facts", required=True)
    s.add_argument("--rates", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--fail-on-quality", action="store_true")
    s = sub.add_parser("flag")
    s.add_argument("--filings", required=True)
    s.add_argument("--log", required=True)
    s.add_argument("--flagged-by", default="rule")
    s = sub.add_parser("init-flags")
    s.add_argument("--path", required=True)
    return p


def main(argv: list[str] | None = None) -> object:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"gapscope-{a.job}").getOrCreate()
    if a.job == "clean-facts":
        return jobs.clean_facts_job(spark, a.landing, a.out, a.first_year, a.counts, a.rejects, a.fail_on_rejects)
    if a.job == "clean-rates":
        return jobs.clean_rates_job(spark, a.landing, a.out, a.counts, a.rejects, a.fail_on_rejects)
    if a.job == "clean-ratio":
        return jobs.clean_ratio_job(spark, a.documents, a.out)
    if a.job == "snapshot":
        return jobs.snapshot_job(spark, a.facts, a.out, a.as_of, a.lookback_days)
    if a.job == "merge-late":
        batch = spark.read.schema(FACTS_CLEAN).parquet(a.batch)
        return jobs.merge_late_job(spark, a.snapshot, batch)
    if a.job == "report":
        return jobs.report_job(spark, a.facts, a.rates, a.out, a.fail_on_quality)
    if a.job == "flag":
        return jobs.flag_job(spark, a.filings, a.log, a.flagged_by)
    return jobs.init_flags_job(spark, a.path)


def cli() -> int:
    """Console entry: run the job, print its result (if any) as JSON, exit 0."""
    result = main(sys.argv[1:])
    if result is not None:
        print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(cli())
