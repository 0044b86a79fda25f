"""Quality classifier: held-out accuracy, votes against brute force, no leak of held-out labels, edge cases."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from gapscope.llm import quality_votes as V
from gapscope.llm.words import Texts

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_fold(spark):
    rows = V.op1_quality_votes(spark, SF).collect()
    assert {r.doc_id: r.held_out for r in rows} == {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([p == t for p, t in judged]) >= 0.95


def test_held_out_labels_are_never_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet").limit(400) for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(V.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = V.fit(docs, labels), V.fit(docs, flipped)
    assert (a.vectors == b.vectors).all() and (a.labels == b.labels).all()


def test_scores_equal_brute_force_votes():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["an", "the", "of", "ing", "##", "tion"], 30)) for _ in range(60)] + ["", None]
    raw = V.shares(Texts.of(texts))
    model = V.latent_space(raw[:40], rng.integers(0, 2, 40).astype(float))
    got = model.scores(raw)
    for i, z in enumerate(model.latent(raw)):
        cos = sorted(((float(z @ v), -j) for j, v in enumerate(model.vectors)), reverse=True)[: V.NEIGHBOURS]
        w = np.array([max(c, 0) ** V.SHARPNESS for c, _ in cos])
        want = model.labels.mean() if w.sum() == 0 else (w * [model.labels[-j] for _, j in cos]).sum() / w.sum()
        assert abs(got[i] - want) < 1e-3


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = V.fit(spark.read.parquet(f"{SF}/documents.parquet").limit(300), labels)
    docs = odd_docs.withColumn("score", F.lit("clash"))
    rows = V.score_quality(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert V.score_quality(no_docs, model).count() == 0
    assert V.fit(no_docs, labels) is None
    assert {r.score for r in V.score_quality(odd_docs, None).collect()} == {0.5}
