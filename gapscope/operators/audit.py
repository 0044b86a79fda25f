"""Audit signals, the append-only audit-flag log, and the filing links.

Per-year thresholds are computed with ``groupBy(year)`` + ``percentile_approx``
(mergeable sketches, partial aggregation before the shuffle), instead of a
window over ``partitionBy(year)`` that would hold a whole year in one task.
Filings look them up in a map with one entry per year.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapscope import labels as L
from gapscope.functions import sha256_key
from gapscope.sources.schemas import AUDIT_FLAGS, cast_to_schema
from gapscope.sources.tables import path_exists

# output column -> (input column, percentile)
AUDIT_THRESHOLDS = {
    "median_employees_year": ("employees", 0.5),
    "q3_profit_per_employee_year": ("profit_per_employee", 0.75),
}
DEFAULT_ACCURACY = 10000


def year_percentiles(
    df: DataFrame,
    by: str = "year",
    thresholds: Mapping[str, tuple[str, float]] = AUDIT_THRESHOLDS,
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """One row per ``by`` value with each requested percentile (an actual element)."""
    return df.groupBy(by).agg(
        *[F.percentile_approx(c, p, accuracy).alias(name) for name, (c, p) in thresholds.items()]
    )


def qualify_audit(merged: DataFrame, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Every filing with its year's thresholds and ``audit_signal``.

    Signal: employees above the year median AND profit per employee at or
    above the year's upper quartile (three-valued: null stays null). The
    thresholds are one value, a map by year, so the filings are not
    shuffled; it has as many entries as there are years.
    """
    th = year_percentiles(merged, accuracy=accuracy)
    names = [c for c in th.columns if c != "year"]
    year = F.coalesce(F.col("year").cast("string"), F.lit(""))
    by_year = th.agg(F.map_from_entries(F.collect_list(F.struct(year, F.struct(*names)))).alias("m")).scalar()
    found = merged.withColumn("_th", F.try_element_at(by_year, year))
    return found.select(*merged.columns, *[F.col(f"_th.{n}").alias(n) for n in names]).withColumn(
        "audit_signal",
        (F.col("employees") > F.col("median_employees_year"))
        & (F.col("profit_per_employee") >= F.col("q3_profit_per_employee_year")),
    )


def audit_candidates(merged: DataFrame, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Filings whose signal is true (null signals are dropped)."""
    return qualify_audit(merged, accuracy).filter(F.col("audit_signal"))


# --- audit-flag log ---------------------------------------------------------


def init_audit_log(spark: SparkSession, path: str) -> bool:
    """Create the empty log with its declared schema only if absent.

    Returns True when it was created. An existing log is never overwritten.
    """
    if path_exists(spark, path):
        return False
    spark.createDataFrame([], AUDIT_FLAGS).write.mode("errorifexists").parquet(path)
    return True


def _checked(flags: DataFrame) -> DataFrame:
    """Declared non-null fields are enforced while the append job runs."""
    out = cast_to_schema(flags, AUDIT_FLAGS)
    for name in ("flag_id", "filing_id"):
        out = out.withColumn(
            name,
            F.when(F.col(name).isNull(), F.raise_error(F.lit(f"audit_flags.{name} must not be null"))).otherwise(
                F.col(name)
            ),
        )
    return out


def append_flags(spark: SparkSession, flags: DataFrame, path: str, skip_existing: bool = True) -> None:
    """Append rows to the log (created on first use); never rewrites history.

    ``flag_id`` is the log's primary key: with ``skip_existing`` (default)
    the earliest row of each key is taken from the batch, and keys already
    logged are left out, so re-running a flagging job (e.g. after a failure)
    does not duplicate flags. The check is an
    anti-join against the log's keys; appending while reading the same
    table is safe because an append only adds files at commit.
    """
    created = init_audit_log(spark, path)
    rows = _checked(flags)
    if skip_existing:
        rest = [c for c in AUDIT_FLAGS.fieldNames() if c not in ("flag_id", "flagged_at")]
        first = F.min(F.struct("flagged_at", *rest)).alias("row")
        rows = rows.groupBy("flag_id").agg(first).select(*[F.col("flag_id") if c == "flag_id" else F.col(f"row.{c}") for c in AUDIT_FLAGS.fieldNames()])
    if skip_existing and not created:
        rows = rows.join(read_audit_log(spark, path).select("flag_id"), "flag_id", "left_anti").select(*AUDIT_FLAGS.fieldNames())
    rows.write.mode("append").parquet(path)


def read_audit_log(spark: SparkSession, path: str) -> DataFrame:
    return cast_to_schema(spark.read.schema(AUDIT_FLAGS).parquet(path), AUDIT_FLAGS)


def flag_filings(
    filings: DataFrame,
    condition: Column | None = None,
    reason: str = L.GAP_FLAG_REASON,
    flagged_by: str = "rule",
    flagged_at: Column | _dt.datetime | None = None,
    status: str = L.FLAG_STATUS_OPEN,
) -> DataFrame:
    """Flag rows for the filings that meet ``condition`` (default: gap > 5pp).

    ``flag_id`` is a hash of (filing id, reason), so re-flagging the same
    filing for the same reason gives the same key.
    """
    if condition is None:
        condition = F.col("gap_statutory_minus_effective") > L.GAP_FLAG_THRESHOLD
    if flagged_at is None:
        at = F.current_timestamp()
    elif isinstance(flagged_at, Column):
        at = flagged_at
    else:
        at = F.lit(flagged_at).cast("timestamp")
    return filings.filter(condition).select(
        sha256_key("id", F.lit(reason)).alias("flag_id"),
        F.col("id").alias("filing_id"),
        F.lit(reason).alias("reason"),
        F.lit(flagged_by).alias("flagged_by"),
        at.alias("flagged_at"),
        F.lit(status).alias("status"),
    )


# --- links between the stored tables -----------------------------------------


def link_filing_jurisdiction(filings: DataFrame, dim: DataFrame) -> DataFrame:
    """Filing -> jurisdiction (many-to-one)."""
    return filings.select("id", "jurisdiction", "year").join(dim, "jurisdiction", "inner")


def link_filing_flags(filings: DataFrame, flags: DataFrame) -> DataFrame:
    """Filing -> its flags (one-to-many); filings without flags keep null flag columns."""
    f = flags.select("flag_id", "filing_id", "status", "reason")
    return filings.select("id", "jurisdiction", "year").join(f, F.col("id") == F.col("filing_id"), "left").drop("filing_id")


def link_rate_jurisdiction(rates_with_id: DataFrame, dim: DataFrame) -> DataFrame:
    """Rate -> jurisdiction; rates of jurisdictions absent from the dimension drop."""
    return rates_with_id.join(dim, "jurisdiction", "inner").select("id", "jurisdiction", "year", "statutory_rate")


def lookup(df: DataFrame, **equals) -> DataFrame:
    """Filter a stored table on property values (``id=..``, ``jurisdiction=..``)."""
    cond = F.lit(True)
    for k, v in equals.items():
        cond = cond & (F.col(k) == F.lit(v))
    return df.filter(cond)
