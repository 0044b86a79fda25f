"""A corpus pipeline of five stages, each one of the operators in ``gapscope.llm``.

Every stage works on all that the stage before it kept; the result is
written as Parquet in the session's shared scratch folder and read again, so
a lost executor never costs more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gapscope.llm import mixing, near_copies, piece_stream, quality_rules, secrets
from gapscope.llm.common import read, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    model = quality_rules.fit(docs, read(spark, sf_dir, "labels"))
    return quality_rules.apply_rules(docs, model).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays."""
    return near_copies.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; the secrets found in it are masked."""
    return secrets.without_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources reach their target words: documents are left out or repeated."""
    return mixing.mixed_corpus(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, and whether they decode to its text."""
    return piece_stream.encoded_corpus(docs)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", tokenize),
]

#: The first stage's classifier cannot be expressed in SQL; tests/llm/test_pipeline.py holds every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
