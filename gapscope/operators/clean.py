"""Cleaning of long-form observations: check, rename, cast, stamp, drop, dedup.

Every function is ``DataFrame -> DataFrame`` (use with ``df.transform``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from gapscope import labels as L
from gapscope.functions import safe_cast
from gapscope.sources.csv import require_columns


def select_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped source columns, renamed; error names missing/available.

    A frame that carries the clean names and none of the source labels
    passes through unchanged apart from the selection.
    """
    cols = df.columns
    if all(new in cols for new in mapping.values()) and not any(lab in cols for lab in mapping):
        return df.select(*mapping.values())
    require_columns(cols, mapping.keys())
    return df.select(*[F.col(f"`{lab}`").alias(new) for lab, new in mapping.items()])


def cast_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Typed columns; malformed text becomes null instead of failing the job."""
    return df.withColumns({c: safe_cast(c, t) for c, t in types.items()})


def stamp_ingest_time(df: DataFrame, at: Column | DataFrame | None = None, column: str = "_ingested_at") -> DataFrame:
    """Add the load timestamp.

    ``at`` may be a Column (e.g. a literal for repeatable runs), a one-row
    frame read from the landing's side file (applied as a scalar subquery,
    no join), or None for ``current_timestamp()``.
    """
    if at is None:
        value = F.current_timestamp()
    elif isinstance(at, DataFrame):
        value = at.select(F.col(at.columns[0]).cast("timestamp")).scalar()
    else:
        value = at
    return df.withColumn(column, value)


def drop_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``subset`` (other columns may stay null)."""
    return df.na.drop(how="any", subset=list(subset))


def _total_order(df: DataFrame, keys: Sequence[str], first: Sequence[Column]) -> list[Column]:
    """``first`` then every remaining column ascending: a repeatable order."""
    used = set(keys)
    rest = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in used]
    return list(first) + rest


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "_ingested_at",
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per key: the latest by ``ts`` (nulls last), ties broken repeatably.

    Null key values group together. ``row_number() == 1`` lets Catalyst add a
    partial ``WindowGroupLimit`` before the shuffle, so a hot key ships at
    most one row per map task.
    """
    order = [F.col(ts).desc_nulls_last()] + (list(tiebreak) if tiebreak is not None else [])
    if tiebreak is None:
        order = _total_order(df.drop(ts), keys, order)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_any(df: DataFrame, keys: Sequence[str], tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """One row per key, any row; by default the smallest by the remaining columns."""
    order = list(tiebreak) if tiebreak is not None else _total_order(df, keys, [])
    if not order:
        return df.dropDuplicates(list(keys))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _complete(not_null: Sequence[str]) -> Column:
    complete = F.lit(True)
    for c in not_null:
        complete = complete & F.col(c).isNotNull()
    return complete


def _typed_counts(types: Sequence[str], not_null: Sequence[str]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("raw_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in types],
        F.count_if(_complete(not_null)).alias("after_dropna"),
    ]


class StepCounts:
    """The counts of ``clean_step_counts``, observed while the cleaned rows are written: no pass of their own.

    Pass one to ``clean_facts`` or ``clean_rates``, write the result once,
    then ask for ``row``. A stage that Spark has to run again for a lost
    executor is counted as often as it ran, so a job whose counts must be
    exact whatever happens takes ``clean_step_counts`` of the stored landing.
    """

    def __init__(self) -> None:
        self._typed, self._kept = Observation(), Observation()
        self._watching = True

    @classmethod
    def off(cls) -> StepCounts:
        counts = cls()
        counts._watching = False
        return counts

    def typed(self, df: DataFrame, types: Sequence[str], not_null: Sequence[str]) -> DataFrame:
        return df.observe(self._typed, *_typed_counts(types, not_null)) if self._watching else df

    def kept(self, df: DataFrame) -> DataFrame:
        return df.observe(self._kept, F.count(F.lit(1)).alias("after_dedup")) if self._watching else df

    def row(self, spark: SparkSession) -> DataFrame:
        """One row: the counts, once the cleaned rows are written."""
        counted = {**self._typed.get, **self._kept.get}
        return spark.createDataFrame([tuple(counted.values())], ", ".join(f"{name} bigint" for name in counted))


def clean_facts(
    raw: DataFrame,
    columns: Mapping[str, str] = L.FACT_COLUMNS,
    keys: Sequence[str] = L.FACT_KEYS,
    not_null: Sequence[str] = L.FACT_NOT_NULL,
    types: Mapping[str, str] | None = None,
    ingested_at: Column | DataFrame | None = None,
    counts: StepCounts | None = None,
) -> DataFrame:
    """Raw labelled facts -> typed, stamped, complete, one row per key (latest load).

    ``counts`` takes the row counts of the steps along, as the result is written.
    """
    types = types or {"year": "int", "obs_value": "double"}
    counts = counts or StepCounts.off()
    return (
        raw.transform(select_rename, columns)
        .transform(cast_types, types)
        .transform(counts.typed, list(types), not_null)
        .transform(stamp_ingest_time, ingested_at)
        .transform(drop_incomplete, not_null)
        .transform(dedup_latest, keys, "_ingested_at")
        .transform(counts.kept)
    )


def clean_rates(
    raw: DataFrame,
    columns: Mapping[str, str] = L.RATE_COLUMNS,
    keys: Sequence[str] = L.RATE_KEYS,
    not_null: Sequence[str] = L.RATE_NOT_NULL,
    counts: StepCounts | None = None,
) -> DataFrame:
    """Raw labelled rates -> typed, complete, one row per key (repeatable pick)."""
    types = {"year": "int", "tax_rate": "double"}
    counts = counts or StepCounts.off()
    return (
        raw.transform(select_rename, columns)
        .transform(cast_types, types)
        .transform(counts.typed, list(types), not_null)
        .transform(drop_incomplete, not_null)
        .transform(dedup_any, keys)
        .transform(counts.kept)
    )


def clean_step_counts(
    raw: DataFrame,
    columns: Mapping[str, str] = L.FACT_COLUMNS,
    keys: Sequence[str] = L.FACT_KEYS,
    not_null: Sequence[str] = L.FACT_NOT_NULL,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Row counts through the cleaning steps, in one pass over the input.

    ``null_<column>`` counts rows whose typed value is null (missing or
    malformed text). ``after_dedup`` counts distinct key tuples among
    complete rows, exactly the number of rows the dedup keeps (null key
    parts included).
    """
    types = types or {"year": "int", "obs_value": "double"}
    typed = raw.transform(select_rename, columns).transform(cast_types, types)
    return typed.agg(
        *_typed_counts(list(types), not_null),
        F.count_distinct(F.when(_complete(not_null), F.struct(*keys))).alias("after_dedup"),
    )
