"""Table reads and writes (parquet snapshots, CSV export) and the input guard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapscope.session import scratch_path
from gapscope.sources.schemas import cast_to_schema


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem (works for any scheme)."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def require_path(spark: SparkSession, path: str) -> None:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Input not found: {path}. Land or build it first.")


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a parquet snapshot; ``schema`` re-applies declared types/nullability."""
    require_path(spark, path)
    df = spark.read.parquet(path)
    return cast_to_schema(df, schema) if schema is not None else df


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Snapshot write (overwrite by default).

    Rows are brought together by partition first, so a partition gets a few
    files instead of one per task; AQE splits a hot partition.
    """
    clustered(df, partition_by).write.mode(mode).partitionBy(*(partition_by or [])).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared scratch folder and read from there: computed once, and never again for a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """``df`` rebalanced on the partition columns."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export with a header, written by the executors (no driver collect)."""
    df.write.mode(mode).option("header", True).csv(path)


def read_csv_export(spark: SparkSession, path: str, schema) -> DataFrame:
    require_path(spark, path)
    return spark.read.schema(schema).option("header", True).csv(path)
