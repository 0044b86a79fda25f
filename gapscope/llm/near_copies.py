"""Near-duplicate removal on top of the n-gram Jaccard join."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapscope.llm.common import WORD_PATTERN, with_columns
from gapscope.llm.jaccard_join import class_components, jaccard_classes, shingle_sets, signature
from gapscope.llm.words import Texts


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of linked ones stays: the one with the smallest id; same columns.

    Repeated rows (same id and text) count once. Rows that share the kept id
    with another text stay: they cannot be told apart by id. Of a group in
    which no row has an id, the row with the smallest (signature, text hash)
    stays; rows without an id and without a word are in no group and stay.
    The texts are shuffled once, by id or, without one, by text.
    """
    documents, labels = jaccard_classes(docs, key, text)
    of_class = class_components(documents, labels)
    found = documents.join(of_class.select("sig", "component"), "sig", "left").where("coalesce(component, key) = key")
    kept = found.select(F.col("key").alias("_kept")).distinct()
    with_id = docs.join(kept, F.col(key) == F.col("_kept"), "left_semi").dropDuplicates([key, text])
    without = docs.where(F.col(key).isNull())
    if without.isEmpty():
        return with_id
    has_word = F.coalesce(F.col(text), F.lit("")).rlike(WORD_PATTERN)
    alone = of_class.where("component is null").select(F.col("sig").alias("_sig"), F.col("label").alias("_label"))
    least = Window.partitionBy("_label").orderBy("_sig", F.xxhash64(text), text)
    one = (signed(without.where(has_word).dropDuplicates([text]), text).join(alone, "_sig")
           .withColumn("_place", F.row_number().over(least)).where("_place = 1").select(*docs.columns))
    return with_id.unionByName(without.where(~has_word)).unionByName(one)


def signed(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``_sig``, the signature of the text's class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            found = [signature(s) if len(s) else None for texts in Texts.chunks(column) for s in shingle_sets(texts)]
            yield with_columns(batch, {"_sig": pa.array(found, pa.int64())})

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_sig", T.LongType())]))
