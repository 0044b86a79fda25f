"""Quality rules: counts against plain Python, held-out accuracy, edge cases."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapscope.llm import quality_rules as Q
from gapscope.llm.common import labelled_documents

SF = "/root/testdata/sf0.001"
SF_MORE = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i: i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


def counts(rows):
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows}


def test_counts_match_brute_force_on_the_driver_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = Q.op7_quality_rules(spark, SF).collect()
    assert counts(rows) == {k: brute(t) for k, t in texts.items()}
    assert all(r.kept == (not r.base_failed and r.probability >= Q.KEEP_AT) for r in rows)


def test_counts_on_made_up_texts(spark):
    texts = ["a b c d e a b c d e a b c d e", "a b c d e f a b c d e", "x\nx\n \nx \nx\n\n", "é\x0b\x0cü # | <b>\r\n# | <b>", "w " * 5000, "y" * 9000 + " " + "y" * 9000, "\x00 \x85 a b"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    assert counts(Q.apply_rules(docs, None).collect()) == {i: brute(t) for i, t in enumerate(texts)}


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_MORE}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = Q.fit(docs, labels.where(~fold))
    rows = Q.apply_rules(docs.join(labels.where(fold), "doc_id"), model).collect()
    good = np.array([r.quality == 1 for r in rows])
    kept = np.array([r.kept for r in rows])
    long_enough = np.array([r.n_words >= 10 for r in rows])
    assert (kept == good)[long_enough].mean() >= 0.95
    p = np.array([r.probability for r in rows])
    assert abs(p[~np.array([r.base_failed for r in rows])].mean() - good[~np.array([r.base_failed for r in rows])].mean()) < 0.1  # calibrated


def test_fit_is_repeatable_and_bounded(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    a, b = Q.fit(docs, labels), Q.fit(docs.repartition(3), labels.repartition(5))
    assert (a is None and b is None) or (a.weights == b.weights).all()
    assert Q.fit(docs, labels.where("quality = 1")) is None


def test_odd_rows_and_empty_table(odd_docs, no_docs):
    docs = odd_docs.withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit(-1))
    rows = Q.apply_rules(docs, None).collect()
    assert counts(r for r in rows if r.doc_id is not None) == {r.doc_id: brute(r.text) for r in odd_docs.collect() if r.doc_id is not None}
    assert len(rows) == docs.count() and all(isinstance(r.kept, bool) for r in rows)
    assert Q.apply_rules(no_docs, None).count() == 0


def test_features_stay_distributed(spark, monkeypatch):
    docs, labels = spark.read.parquet(f"{SF_MORE}/documents.parquet"), spark.read.parquet(f"{SF_MORE}/labels.parquet")
    want = Q.fit(docs, labels, rows=300)
    kind = type(docs)
    collected, to_arrow = [], kind.toArrow
    monkeypatch.setattr(kind, "toArrow", lambda df: (collected.append(df.columns), to_arrow(df))[1])
    monkeypatch.setattr(Q, "SAMPLE_PARTS", 3)
    got = Q.fit(docs, labels, rows=300)
    assert collected and not [c for c in collected if "buckets" in c]
    assert np.abs(got.weights - want.weights).max() < 1e-3 and abs(got.bias - want.bias) < 1e-4
    assert abs(got.slope - want.slope) < 1e-3 and abs(got.shift - want.shift) < 1e-3


def labelled(spark):
    good, bad = "the quiet river runs past old stone mills toward a wide green valley {}", "win cash now click here buy cheap pills best price offer {}"
    rows = [(i, (good if i % 2 else bad).format("x" * i), i % 2) for i in range(24)]
    return spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")


def test_probabilities_of_a_plain_regression(spark):
    """The whole method again, with dictionaries in plain Python."""
    import math
    from gapscope.llm.words import Texts, Words

    docs, labels = labelled(spark)
    model = Q.fit(docs, labels)
    fitted = {r.doc_id: r.used for r in docs.select("doc_id", (F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(4)) != 3).alias("used")).collect()}
    y = {r.doc_id: r.quality for r in labels.collect()}
    features = {}
    for r in docs.collect():
        texts = Texts.of([r.text])
        share = {}
        for bucket, _, counts in Q.gram_families(texts, Words(texts), Q.BITS):
            for b in bucket.tolist():
                share[b] = share.get(b, 0) + 1 / int(counts[0])
        features[r.doc_id] = share
    used = [d for d in y if fitted[d]]
    ones = sum(y[d] for d in used)
    weight, past, bias = {}, {}, math.log(ones / (len(used) - ones))
    margin = lambda d: bias + sum(weight.get(b, 0.0) * v for b, v in features[d].items())
    for _ in range(Q.STEPS):
        error = {d: (1 / (1 + math.exp(-margin(d))) - y[d]) / len(used) for d in used}
        slope = {}
        for d in used:
            for b, v in features[d].items():
                slope[b] = slope.get(b, 0.0) + v * error[d]
        for b, g in slope.items():
            past[b] = past.get(b, 0.0) + g * g
            weight[b] = weight.get(b, 0.0) - Q.RATE * g / (math.sqrt(past[b]) + 1e-12)
        bias -= 0.5 * sum(error.values())
    kept_back = [d for d in y if not fitted[d]]
    slope, shift = Q.platt(np.array([margin(d) for d in kept_back]), np.array([float(y[d]) for d in kept_back]))
    got = {r.doc_id: r.probability for r in Q.apply_rules(docs, model).collect()}
    for d in y:
        assert got[d] == pytest.approx(1 / (1 + math.exp(-(slope * margin(d) + shift))), abs=2e-3)


def test_an_id_of_many_documents_counts_once(spark):
    docs, labels = labelled(spark)
    many = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("some other text number "), F.col("id").cast("string")).alias("text"))
    sample = labelled_documents(docs.unionByName(many), labels, "doc_id", "text", "quality", 3000)
    assert sample.count() == 24
    assert Q.fit(docs.unionByName(many), labels) is not None
