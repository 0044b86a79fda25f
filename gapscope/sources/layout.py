"""Table layouts that later reads gain from: kept order, buckets on a link key, filters for look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapscope.sources.tables import require_path


def write_ordered(df: DataFrame, path: str, *order: Column | str, mode: str = "overwrite") -> None:
    """``df`` in ``order`` over all its files: ranges of rows by task, sorted within, files named in order.

    The order is total only as far as ``order`` is; end it with a key to
    make the files repeatable.
    """
    df.sort(*order).write.mode(mode).parquet(path)


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The table with each row's place in the written order, from 1, without sorting it again.

    A row's place is its index in its file and the rows of the files named
    before; only the counts of files are put in order.
    """
    require_path(spark, path)
    df = spark.read.parquet(path)
    rows = df.withColumn("_file", F.col("_metadata.file_name")).withColumn("_nth", F.col("_metadata.row_index"))
    files = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    # a part file's name begins with its number, padded to five digits at least
    named = Window.orderBy(F.regexp_extract("_file", r"^part-(\d+)", 1).cast("long"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("_file", F.coalesce(F.sum("_n").over(named), F.lit(0)).alias("_before"))
    return rows.join(before, "_file").select(*df.columns, (F.col("_before") + F.col("_nth") + 1).alias(position))


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, mode: str = "overwrite") -> None:
    """``df`` as a catalog table at ``path``, hashed into ``buckets`` by ``keys`` and sorted by them within.

    Tables bucketed alike on a link's keys are joined without a shuffle of
    either. Rows are dealt by key first, so a bucket is one file. A key with a
    large share of all rows makes a large bucket, as it would make a large
    partition of the shuffle that this saves.
    """
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode(mode).format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def write_lookup_table(df: DataFrame, path: str, by: Sequence[str], distinct_a_file: int = 1_000_000, row_group_bytes: int = 16 << 20, mode: str = "overwrite") -> None:
    """``df`` with a Parquet bloom filter on each column of ``by``, sorted by the first within files.

    A look-up by one value then reads, of each file, only the row groups
    whose minimum, maximum and filter admit it. ``distinct_a_file`` sizes
    the filters (about 1.2 bytes a value).
    """
    writer = df.sortWithinPartitions(*by).write.mode(mode).option("parquet.block.size", row_group_bytes)
    for column in by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct_a_file))
    writer.parquet(path)
