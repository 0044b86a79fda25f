"""JSON-stat documents: one file = one document, read by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapscope.sources.tables import require_path, stored


def read_json_stat_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc, text)`` per file; ``doc`` is the file path, a stable document key.

    A document is parsed inside one task, so throughput comes from many
    documents (a landing of many files, or many landings).
    """
    require_path(spark, path)
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("doc"), F.col("value").alias("text"))
    )


def read_json_stat_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``(doc, block, row, piece)``: the text between a document's commas, each file read by as many tasks as it has byte ranges.

    ``block`` is the first byte of the range, ``row`` ascends by one within
    it. Stored once, so that later steps see the same ranges whatever
    executors the cluster has by then.
    """
    require_path(spark, path)
    pieces = spark.read.option("lineSep", ",").option("recursiveFileLookup", True).text(path)
    pieces = pieces.select(
        F.col("_metadata.file_path").alias("doc"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("piece"),
    )
    return stored(pieces, "json_stat_pieces")
