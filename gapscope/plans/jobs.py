"""Batch jobs: landed files or tables in, tables out.

One function per dataset the source pipeline builds; each is a read, one
operator composition, and a write. Paths are on shared storage chosen by
the caller. Landings are read where they lie; nothing passes through the
driver.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapscope import labels as L
from gapscope.operators.audit import append_flags, flag_filings, init_audit_log
from gapscope.operators.clean import StepCounts, clean_facts, clean_rates
from gapscope.operators.incremental import incremental_snapshot, merge_into_snapshot
from gapscope.operators.json_stat import clean_ratio, decode_json_stat
from gapscope.operators.quality import default_rules, quality_rules, since_period
from gapscope.plans.report import run_report
from gapscope.session import scratch_path, scratch_root
from gapscope.sources.csv import read_ingest_stamp, read_labelled_csv
from gapscope.sources.json_stat import read_json_stat_documents
from gapscope.sources.schemas import EFFECTIVE_VS_STATUTORY, FACTS_CLEAN, RATES_CLEAN
from gapscope.sources.tables import clustered, path_exists, read_table, write_table


#: Partitions that one merge may rewrite.
MOST_PARTITIONS = 10_000


def landed_rows(spark: SparkSession, landing: str, columns: Mapping[str, str], rejects: str | None) -> DataFrame:
    """The landing's rows; with ``rejects``, a folder, those lines whose fields do not fit the header go there.

    The files are scanned once: whole rows and rejected lines are stored side
    by side, as two partitions of one scratch table, and read from there.
    """
    if rejects is None:
        return read_labelled_csv(spark, landing, select=columns)
    raw = read_labelled_csv(spark, landing, select=columns, rejects="_line")
    marked = raw.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_line").isNotNull().alias("_rejected"))
    stage = scratch_path(spark, "landing")
    marked.write.partitionBy("_rejected").parquet(stage)
    staged = spark.read.schema(marked.schema).parquet(stage)
    write_table(staged.where("_rejected").select(F.col("_file").alias("file"), F.col("_line").alias("line")), rejects)
    return staged.where("not _rejected").select(*columns.values())


def require_no_rejects(spark: SparkSession, rejects: str) -> None:
    """Raise with the number of rejected lines, if there are any."""
    n = spark.read.parquet(rejects).count()
    if n:
        raise ValueError(f"{n} lines of the landing do not fit its header; they are in {rejects}")


def clean_facts_job(
    spark: SparkSession, landing: str, out: str, first_year: int | None = None, counts: str | None = None,
    rejects: str | None = None, fail_on_rejects: bool = False,
) -> None:
    """Labelled fact CSV (+ optional ``_ingest_metadata.json``) -> clean facts, partitioned by year.

    Without a side file the load is stamped with the job's start time.
    ``first_year`` keeps rows from that year on. ``counts`` is a folder for
    the row counts of the cleaning steps, taken as the facts are written.
    ``rejects`` is a folder for malformed lines, which else are padded or cut;
    ``fail_on_rejects`` raises, after everything is written, if there are any.
    """
    if fail_on_rejects and rejects is None:
        raise ValueError("fail_on_rejects needs a folder for the rejects")
    stamp = read_ingest_stamp(spark, landing) if path_exists(spark, f"{landing.rstrip('/')}/_ingest_metadata.json") else None
    counted = StepCounts() if counts else None
    facts = clean_facts(landed_rows(spark, landing, L.FACT_COLUMNS, rejects), ingested_at=stamp, counts=counted)
    write_table(facts if first_year is None else since_period(facts, "year", first_year), out, partition_by=["year"])
    if counts:
        write_table(counted.row(spark), counts)
    if fail_on_rejects:
        require_no_rejects(spark, rejects)


def clean_rates_job(
    spark: SparkSession, landing: str, out: str, counts: str | None = None, rejects: str | None = None, fail_on_rejects: bool = False,
) -> None:
    """Labelled rate CSV -> clean rates; the other parameters as for facts."""
    if fail_on_rejects and rejects is None:
        raise ValueError("fail_on_rejects needs a folder for the rejects")
    counted = StepCounts() if counts else None
    write_table(clean_rates(landed_rows(spark, landing, L.RATE_COLUMNS, rejects), counts=counted), out)
    if counts:
        write_table(counted.row(spark), counts)
    if fail_on_rejects:
        require_no_rejects(spark, rejects)


def clean_ratio_job(spark: SparkSession, documents: str, out: str) -> None:
    """JSON-stat documents -> ``(jurisdiction, jurisdiction_name, year, tax_to_gdp_ratio)``."""
    write_table(clean_ratio(decode_json_stat(read_json_stat_documents(spark, documents))), out)
    if spark.read.parquet(out).isEmpty():
        raise ValueError(f"no ratio row came out of the documents in {documents}")


def snapshot_job(
    spark: SparkSession,
    facts: str,
    out: str,
    as_of: _dt.date | str | None = None,
    lookback_days: int = L.LOOKBACK_DAYS,
) -> None:
    """Clean facts -> latest row per key over on-time and late loads."""
    snap = incremental_snapshot(read_table(spark, facts, FACTS_CLEAN), L.FACT_KEYS, "_ingested_at", as_of, lookback_days)
    write_table(snap, out, partition_by=["year"])


def merge_late_job(
    spark: SparkSession,
    snapshot: str,
    batch: DataFrame,
    keys: Sequence[str] = L.FACT_KEYS,
    ts: str = "_ingested_at",
    partition_col: str = "year",
) -> list:
    """Merge a batch of (late) rows into a year-partitioned snapshot, latest wins.

    Only the partitions the batch touches are read (partition pruning on
    the batch's distinct years, a handful of values) and rewritten
    (dynamic partition overwrite); the rest of the snapshot is not
    shuffled or rewritten. The merged rows are checkpointed before the
    write, so overwriting partitions of the table being read is safe and a
    lost executor does not re-read half-overwritten files. Returns the
    partition values rewritten.
    """
    touched = [r[0] for r in batch.filter(F.col(ts).isNotNull()).select(partition_col).distinct().limit(MOST_PARTITIONS + 1).collect()]
    if len(touched) > MOST_PARTITIONS:
        raise ValueError(f"the batch touches over {MOST_PARTITIONS} partitions of {partition_col}: merge it in parts")
    if not touched:
        return []
    known = [v for v in touched if v is not None]
    # the null partition is rewritten too if the batch has such rows, so it has to be read
    of_batch = F.col(partition_col).isin(known) if known else F.lit(False)
    if None in touched:
        of_batch = of_batch | F.col(partition_col).isNull()
    current = read_table(spark, snapshot, FACTS_CLEAN).filter(of_batch)
    scratch_root(spark)
    merged = merge_into_snapshot(current, batch.select(*current.columns), keys, ts).checkpoint(eager=True)
    (
        clustered(merged, [partition_col]).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(snapshot)
    )
    return sorted(touched, key=lambda v: (v is not None, v))


def report_job(spark: SparkSession, facts: str, rates: str, out_dir: str, fail_on_quality: bool = False) -> dict[str, str]:
    """Clean facts + clean rates -> the five report tables and the counts of the quality rules.

    ``fail_on_quality`` raises, after everything is written, if a filing
    breaks a rule.
    """
    paths = run_report(spark, read_table(spark, facts, FACTS_CLEAN), read_table(spark, rates, RATES_CLEAN), out_dir)
    filings = spark.read.parquet(paths["effective_vs_statutory"])
    if "revenue" not in filings.columns:  # the rule on it is reported as unknown for every filing
        filings = filings.withColumn("revenue", F.lit(None).cast("double"))
    paths["quality_rules"] = f"{out_dir.rstrip('/')}/quality_rules"
    write_table(quality_rules(filings, default_rules()), paths["quality_rules"])
    broken = spark.read.parquet(paths["quality_rules"]).where("n_fail > 0")
    if fail_on_quality and not broken.isEmpty():
        raise ValueError(f"filings break quality rules: {[tuple(r) for r in broken.select('rule', 'n_fail').collect()]}")
    return paths


def flag_job(spark: SparkSession, filings: str, log: str, flagged_by: str = "rule", reason: str = L.GAP_FLAG_REASON) -> None:
    """Flag the filings of a stored merged table whose gap is over the threshold; a re-run adds nothing."""
    merged = read_table(spark, filings, EFFECTIVE_VS_STATUTORY)
    append_flags(spark, flag_filings(merged, reason=reason, flagged_by=flagged_by), log)


def init_flags_job(spark: SparkSession, path: str) -> bool:
    """Create the audit-flag log if it does not exist yet."""
    return init_audit_log(spark, path)
