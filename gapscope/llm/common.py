"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapscope.session import scratch_path

#: Words of the contracts: runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and Catalyst knows the table's size when it picks a join strategy.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once per row.

    An expression used inside a higher-order function's lambda is evaluated
    again for each element; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def with_columns(batch, columns: dict):
    """The Arrow batch with ``columns`` after its own; columns of those names are replaced."""
    import pyarrow as pa

    kept = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in kept] + list(columns.values()), names=kept + list(columns))


def bit_filter(hashes: DataFrame, column: str, bits: int):
    """Bits (numpy, words of 64) of the 64-bit hashes in ``column``: a set's filter of ``2 ** bits`` bits, whatever the set's size.

    It may say yes to other hashes, more so the fuller it is, but never no to one of these.
    """
    import numpy as np

    place = F.shiftrightunsigned(column, 64 - bits)
    words = hashes.select(F.shiftright(place, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int")).alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2 ** (bits - 6)
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def in_filter(held, hashes):
    """Flags of the 64-bit hashes (numpy, unsigned) that a ``bit_filter`` may hold."""
    import numpy as np

    place = hashes >> np.uint64(64 - (len(held) * 64).bit_length() + 1)
    return (held[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0


def labelled_sample(labels: DataFrame, key: str, label: str, rows: int) -> DataFrame:
    """(key, label) of at most ``rows`` rows labelled 0 or 1, chosen by the key's hash: the same on every run.

    A key with contradicting labels counts as 1. The result is small by its
    bound, whatever the table's size.
    """
    one = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("_label"))
    return one.orderBy(F.xxhash64(key), key).limit(rows)


def labelled_documents(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """(key, label, text) of one document for each key of ``labelled_sample``: at most ``rows`` rows, however often an id recurs.

    Of several documents with one id the one with the least text hash counts.
    """
    sample = labelled_sample(labels, key, label, rows)
    picked = docs.select(key, text).join(F.broadcast(sample), key)
    return picked.groupBy(F.col(key).cast("string").alias("key"), F.col("_label").alias("label")).agg(
        F.min_by(text, F.struct(F.xxhash64(text), F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")))).alias("text"))
