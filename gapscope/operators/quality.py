"""Data-quality rules, column profiles, listings and simple filters.

All reports are single aggregations (partial aggregation on every task)
reshaped to rows with ``stack``; none collects data to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapscope import labels as L
from gapscope.functions import any_keyword

def default_rules() -> dict[str, Column]:
    """Rule name -> predicate over a pivoted filing row."""
    return {
        "profit_before_tax_non_negative": F.col("profit_before_tax") >= 0,
        "tax_paid_le_profit": F.col("tax_paid") <= F.col("profit_before_tax"),
        "revenue_ge_profit": F.col("revenue") >= F.col("profit_before_tax"),
    }


def _lit_sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quality_rules(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Per rule: rows passing, failing, and unknown (a null operand)."""
    rules = dict(default_rules() if rules is None else rules)
    aggs = []
    for i, (_, pred) in enumerate(rules.items()):
        aggs += [
            F.count_if(pred).alias(f"p{i}"),
            F.count_if(~pred).alias(f"f{i}"),
            F.count_if(pred.isNull()).alias(f"u{i}"),
        ]
    parts = ", ".join(f"{_lit_sql(name)}, p{i}, f{i}, u{i}" for i, name in enumerate(rules))
    return df.agg(*aggs).selectExpr(f"stack({len(rules)}, {parts}) as (rule, n_pass, n_fail, n_unknown)")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, exact_distinct: bool = True) -> DataFrame:
    """One row per column: position, name hints, rows, nulls, distinct, min, max.

    ``year_like``/``value_like`` are the lower-cased name searches
    ('period'/'time', 'obs'/'value'). Min and max are typed, shown as text.
    Counts, nulls and bounds are one aggregation. Exact distinct counts
    unpivot the table to (position, value) and count in two steps, so what
    is shuffled is one narrow pair per distinct value of a task;
    ``exact_distinct=False`` uses HyperLogLog sketches in the one pass (about
    2% error).
    """
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`")
        aggs += [F.count_if(col.isNull()).alias(f"z{i}"), F.min(col).cast("string").alias(f"lo{i}"), F.max(col).cast("string").alias(f"hi{i}")]
        if not exact_distinct:
            aggs.append(F.approx_count_distinct(col).alias(f"d{i}"))
    parts = ", ".join(f"{_lit_sql(c)}, {i}, n, z{i}, {'-1L' if exact_distinct else f'd{i}'}, lo{i}, hi{i}" for i, c in enumerate(columns))
    prof = df.agg(*aggs).selectExpr(
        f"stack({len(columns)}, {parts}) as (column_name, position, n_rows, n_null, n_distinct, min_value, max_value)"
    )
    if exact_distinct:
        pairs = F.inline(F.array(*[F.struct(F.lit(i).alias("position"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(columns)]))
        seen = df.select(pairs).where("value is not null").distinct().groupBy("position").agg(F.count("*").alias("d"))
        prof = prof.join(seen, "position", "left").withColumn("n_distinct", F.coalesce("d", F.lit(0).cast("long"))).drop("d")
    name = F.lower(F.col("column_name"))
    return prof.select("column_name", "position", "n_rows", "n_null", "n_distinct", "min_value", "max_value").withColumns(
        {
            "position": F.col("position").cast("int"),
            "year_like": name.contains("period") | name.contains("time"),
            "value_like": name.contains("obs") | name.contains("value"),
        }
    )


def sample_values(df: DataFrame, columns: Sequence[str] | None = None, n: int = 10) -> DataFrame:
    """First ``n`` rows' values per column, as text, nulls included (a quick look, like a file head).

    Reads at most ``n`` rows (``limit`` stops the scan early), so the arrays
    are bounded by ``n``. Which rows come first is up to the scan order.
    """
    columns = list(columns or df.columns)
    # wrapped in a struct, as collect_list leaves bare nulls out
    text = [F.when(F.col(f"`{c}`").isNotNull(), F.col(f"`{c}`").cast("string")) for c in columns]
    values = [F.collect_list(F.struct(v.alias("v"))) for v in text]
    head = df.limit(n).agg(*[F.transform(v, lambda x: x["v"]).alias(f"s{i}") for i, v in enumerate(values)])
    parts = ", ".join(f"{_lit_sql(c)}, s{i}" for i, c in enumerate(columns))
    return head.selectExpr(f"stack({len(columns)}, {parts}) as (column_name, sample_values)")


def _tagged(sources: Mapping[str, DataFrame], cols: Sequence[str]) -> DataFrame:
    out = None
    for name, df in sources.items():
        part = df.select(F.lit(name).alias("source"), *cols)
        out = part if out is None else out.unionByName(part)
    return out


def measure_listing(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct non-null measures per source table."""
    return _tagged(sources, ["measure"]).filter(F.col("measure").isNotNull()).distinct()


def year_range(sources: Mapping[str, DataFrame]) -> DataFrame:
    """First and last year per source table."""
    return _tagged(sources, ["year"]).groupBy("source").agg(
        F.min("year").alias("min_year"), F.max("year").alias("max_year")
    )


def distinct_sample(sources: Mapping[str, DataFrame], column: str = "jurisdiction", n: int = 10) -> DataFrame:
    """First ``n`` distinct values (sorted) per source; the limit is the feature.

    Each source is a distinct aggregate followed by a top-n, so no task
    ever holds more than the distinct values it aggregated.
    """
    out = None
    for name, df in sources.items():
        part = df.select(F.col(column).alias("value")).filter(F.col("value").isNotNull()).distinct().orderBy("value").limit(n)
        part = part.select(F.lit(name).alias("source"), "value")
        out = part if out is None else out.unionByName(part)
    return out


def filter_keywords(df: DataFrame, column: str, keywords: Sequence[str]) -> DataFrame:
    """Rows whose ``column`` contains any keyword (case-sensitive)."""
    return df.filter(any_keyword(column, keywords))


def since_period(df: DataFrame, column: str = "year", first_year: int = L.FIRST_PERIOD) -> DataFrame:
    """Rows from ``first_year`` on. On a date/timestamp column the bound is a
    literal date, so the predicate reaches the parquet scan (``PushedFilters``)."""
    dtype = dict(df.dtypes)[column]
    if dtype.startswith("timestamp") or dtype == "date":
        bound = F.lit(f"{first_year:04d}-01-01").cast(dtype)
        return df.filter(F.col(column) >= bound)
    return df.filter(F.col(column) >= first_year)
