"""Declared table schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FACTS_CLEAN = T.StructType(
    [
        T.StructField("jurisdiction", T.StringType()),
        T.StructField("counterpart_jurisdiction", T.StringType()),
        T.StructField("measure", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("obs_value", T.DoubleType()),
        T.StructField("_ingested_at", T.TimestampType()),
    ]
)

RATES_CLEAN = T.StructType(
    [
        T.StructField("jurisdiction", T.StringType()),
        T.StructField("measure", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("tax_rate", T.DoubleType()),
    ]
)

AUDIT_FLAGS = T.StructType(
    [
        T.StructField("flag_id", T.StringType(), False),
        T.StructField("filing_id", T.StringType(), False),
        T.StructField("reason", T.StringType(), True),
        T.StructField("flagged_by", T.StringType(), True),
        T.StructField("flagged_at", T.TimestampType(), True),
        T.StructField("status", T.StringType(), True),
    ]
)

EFFECTIVE_VS_STATUTORY = T.StructType(
    [
        T.StructField("jurisdiction", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("profit_before_tax", T.DoubleType()),
        T.StructField("tax_paid", T.DoubleType()),
        T.StructField("employees", T.DoubleType()),
        T.StructField("mne_group_count", T.DoubleType()),
        T.StructField("effective_tax_rate", T.DoubleType()),
        T.StructField("profit_per_employee", T.DoubleType()),
        T.StructField("statutory_rate", T.DoubleType()),
        T.StructField("effective_tax_rate_pct", T.DoubleType()),
        T.StructField("gap_statutory_minus_effective", T.DoubleType()),
        T.StructField("id", T.StringType()),
    ]
)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
