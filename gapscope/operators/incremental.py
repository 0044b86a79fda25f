"""Late-arriving rows: split by a lookback cutoff and merge into a snapshot."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapscope import labels as L
from gapscope.functions import lookback_cutoff
from gapscope.operators.clean import dedup_latest

AsOf = str | _dt.date | Column | None


def _sides(ts: str, as_of: AsOf, lookback_days: int) -> tuple[Column, Column]:
    """(on time, late): plain comparisons with the start of the cutoff day, which a scan can push down."""
    start = lookback_cutoff(as_of, lookback_days).cast("timestamp")
    return F.col(ts) < start, F.col(ts) >= start


def _arrival(ts: str, as_of: AsOf, lookback_days: int) -> Column:
    on_time, late = _sides(ts, as_of, lookback_days)
    # a null load time is on neither side
    return F.when(late, F.lit("late")).when(on_time, F.lit("on_time"))


def classify_arrival(df: DataFrame, ts: str = "_ingested_at", as_of: AsOf = None,
                     lookback_days: int = L.LOOKBACK_DAYS, column: str = "arrival") -> DataFrame:
    """Add ``arrival``: 'late' (on or after the cutoff day), 'on_time', or null."""
    return df.withColumn(column, _arrival(ts, as_of, lookback_days))


def late_arrival_split(df: DataFrame, ts: str = "_ingested_at", as_of: AsOf = None,
                       lookback_days: int = L.LOOKBACK_DAYS) -> tuple[DataFrame, DataFrame]:
    """``(on_time, late)`` as two filtered frames; with a literal ``as_of`` both filters reach the scan."""
    on_time, late = _sides(ts, as_of, lookback_days)
    return df.filter(on_time), df.filter(late)


def late_arrival_counts(df: DataFrame, ts: str = "_ingested_at", as_of: AsOf = None,
                        lookback_days: int = L.LOOKBACK_DAYS) -> DataFrame:
    """Rows per side in one pass; rows without a load time show as 'no_timestamp'."""
    a = F.coalesce(_arrival(ts, as_of, lookback_days), F.lit("no_timestamp"))
    return df.groupBy(a.alias("arrival")).agg(F.count(F.lit(1)).alias("n_rows"))


def incremental_snapshot(
    df: DataFrame,
    keys: Sequence[str] = L.FACT_KEYS,
    ts: str = "_ingested_at",
    as_of: AsOf = None,
    lookback_days: int = L.LOOKBACK_DAYS,
    tiebreak: Sequence[Column] | None = None,
    arrival: str | None = None,
) -> DataFrame:
    """On-time rows union late rows, then the latest row per key.

    The two sides are complementary, so their union is every row whose load
    time is known: one filtered scan, whatever the cutoff. ``arrival`` names
    a column that tells each kept row's side.
    """
    latest = dedup_latest(df.filter(F.col(ts).isNotNull()), keys, ts, tiebreak)
    return classify_arrival(latest, ts, as_of, lookback_days, arrival) if arrival else latest


def merge_into_snapshot(
    snapshot: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] = L.FACT_KEYS,
    ts: str = "_ingested_at",
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """Union a batch of (possibly late) rows into the current snapshot by name; latest wins.

    As in ``incremental_snapshot``, batch rows without a load time take no
    part; rows that are in the snapshot already stay.
    """
    arrived = batch.filter(F.col(ts).isNotNull())
    return dedup_latest(snapshot.unionByName(arrived, allowMissingColumns=True), keys, ts, tiebreak)
