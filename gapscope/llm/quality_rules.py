"""Quality rules: fixed counts, and a calibrated logistic regression on hashed n-grams.

The counts (words, symbols, repeated lines, words in repeated five-word
windows) give ``base_failed``. Texts that pass are judged by a logistic
regression over hashed word 1-2-grams and byte 3-4-grams: each family of
n-grams contributes the mean of its weights over the text, so a text is
scored in one pass over its bytes, whole, without a feature matrix. The
score is calibrated on rows kept out of the fit (Platt's method) and held
against a fixed threshold.

The fit uses at most ``SAMPLE_ROWS`` labelled ids, chosen by hash, and one
document of each. Their (bucket, share) pairs stay in the scratch folder, in
``SAMPLE_PARTS`` parts; a step brings a gradient of ``2 ** BITS`` sums from
each part's tasks, so the driver holds no document's features, whatever their size. One row in four, by the id's hash, calibrates.
Everything else is per row: no shuffle, no state.

Defined results: null and empty texts have no words, so they fail the base
rules; a line counts as repeated only if it holds a word; without labelled
rows of both classes every probability is 1, so only the base rules decide;
repeated rows are scored alike; columns that clash with the added names are
replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapscope.llm.common import labelled_documents, read, stored, with_columns
from gapscope.llm.grams import gram_families, sums
from gapscope.llm.words import Texts, Words, in_text, lines_with_words, per_text, repeated, segment_hashes, sequence_hashes

BITS = 16
SAMPLE_ROWS = 3000
#: Parts in which the sample's features are kept.
SAMPLE_PARTS = 12
STEPS, RATE = 40, 1.0
#: Bytes of text judged at a time, to lower the peak of an executor.
TEXT_BYTES = 1 << 20
#: A text is kept from this probability of label 1.
KEEP_AT = 0.5
LEAST_WORDS, WINDOW, MOST_REPEATED_PERCENT = 10, 5, 20
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))

ADDED = T.StructType([
    *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    T.StructField("base_failed", T.BooleanType()), T.StructField("probability", T.DoubleType()), T.StructField("kept", T.BooleanType()),
])


@dataclass
class Model:
    """Weights per bucket, bias, and the calibration ``sigmoid(slope * margin + shift)``."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, texts: Texts, words: Words) -> np.ndarray:
        total = np.full(len(texts), self.bias)
        for bucket, starts, counts in gram_families(texts, words, BITS):
            total += sums(self.weights[bucket], starts, counts) / np.maximum(counts, 1)
        return total

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * margins + self.shift)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


# --- fit ------------------------------------------------------------------------


def gram_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, label, text, used) to (key, label, used, buckets, shares): a text's n-grams as shares of their family."""
    for batch in batches:
        at = 0
        for texts in Texts.chunks(batch.column(2), TEXT_BYTES):
            buckets, shares = [], []
            families = list(gram_families(texts, Words(texts), BITS))
            for i in range(len(texts)):
                found = [(np.unique(b[s[i]: s[i] + c[i]], return_counts=True), c[i]) for b, s, c in families if c[i]]
                buckets.append(np.concatenate([u for (u, _), _ in found]) if found else np.empty(0, np.int32))
                shares.append(np.concatenate([n / c for (_, n), c in found]).astype(np.float32) if found else np.empty(0, np.float32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).slice(at, len(texts)) for k in (0, 1, 3)), pa.array(buckets, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))], names=["key", "label", "used", "buckets", "shares"])
            at += len(texts)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit and calibrate on a bounded labelled sample; None if it lacks one of the classes."""
    picked = labelled_documents(docs, labels, key, text, label, rows).withColumn("used", F.pmod(F.xxhash64("key"), F.lit(4)) != 3)
    pairs = stored(picked.repartition(SAMPLE_PARTS, "key").sortWithinPartitions("key").mapInArrow(gram_shares, "key string, label int, used boolean, buckets array<int>, shares array<float>"), "quality-sample")
    of_part = {row["used"]: (row["n"], row["ones"]) for row in pairs.groupBy("used").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).collect()}
    n_all, ones_all = (sum(v) for v in zip((0, 0), *of_part.values()))
    if not 0 < ones_all < n_all:
        return None
    if not all(0 < ones < n for n, ones in (of_part.get(used, (0, 0)) for used in (True, False))):
        pairs, of_part = pairs.withColumn("used", F.lit(True)), {True: (n_all, ones_all)}  # too few rows to keep some back
    n, ones = of_part[True]
    sample = Sample(pairs, n)
    weights, bias = descend(sample, float(np.log(ones / (n - ones))))
    margins, y, used = sample.margins(weights.astype(np.float32), bias)
    slope, shift = (1.0, 0.0) if used.all() else platt(margins[~used], y[~used])
    return Model(weights.astype(np.float32), float(bias), slope, shift)


class Sample:
    """The sample's features in the scratch folder: tasks hand sums to the driver. ``n_used`` rows are fitted."""

    def __init__(self, pairs: DataFrame, n_used: int):
        self.pairs, self.n_used = pairs, n_used

    def each(self, made, schema: str) -> pa.Table:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    offsets = np.asarray(b.column(3).offsets)
                    yield made(b.column(0), b.column(1).to_numpy().astype(float), b.column(2).to_numpy(zero_copy_only=False), offsets - offsets[0],
                               np.asarray(b.column(3).flatten()), np.asarray(b.column(4).flatten()))

        return self.pairs.mapInArrow(run, schema).toArrow().sort_by([("key", "ascending")])

    def margins(self, weights: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(margin, label, fitted?) of each row."""
        def made(keys, y, used, rows_at, bucket, share) -> pa.RecordBatch:
            margin = row_sums(share * weights[bucket], rows_at) + bias
            return pa.RecordBatch.from_arrays([keys, pa.array(margin), pa.array(y), pa.array(used)], names=["key", "margin", "y", "used"])

        out = self.each(made, "key string, margin double, y double, used boolean")
        return tuple(out.column(n).to_numpy() for n in ("margin", "y", "used"))

    def gradient(self, weights: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
        """Mean of the fitted rows' errors per bucket, by share, and of the errors."""
        n_used = self.n_used

        def made(keys, y, used, rows_at, bucket, share) -> pa.RecordBatch:
            error = np.where(used, sigmoid(row_sums(share * weights[bucket], rows_at) + bias) - y, 0.0) / n_used
            slope = np.bincount(bucket, share * np.repeat(error.astype(np.float32), np.diff(rows_at)), minlength=1 << BITS)
            return pa.RecordBatch.from_arrays([keys.slice(0, 1), pa.array([slope.tobytes()], pa.binary()), pa.array([float(error.sum())])], names=["key", "slope", "error"])

        out = self.each(made, "key string, slope binary, error double")
        return sum(np.frombuffer(x) for x in out.column("slope").to_pylist()), sum(out.column("error").to_pylist())


def row_sums(values: np.ndarray, rows_at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[rows_at[1:]] - total[rows_at[:-1]]


def descend(sample: Sample, bias: float) -> tuple[np.ndarray, float]:
    """Full-batch gradient descent with a step per weight that shrinks with its past gradients."""
    size = 1 << BITS
    weights, past = np.zeros(size), np.zeros(size)
    for _ in range(STEPS):
        slope, error = sample.gradient(weights.astype(np.float32), bias)
        past += slope * slope
        weights -= RATE * slope / (np.sqrt(past) + 1e-12)
        bias -= 0.5 * error
    return weights, bias


def platt(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic calibration, with smoothed targets (Newton's method)."""
    ones, zeros = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margins, np.ones_like(margins)], 1)
    at = np.array([1.0, 0.0])
    for _ in range(100):
        p = sigmoid(x @ at)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        at = at - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(at[0], 1e-6)), float(at[1])


# --- score ----------------------------------------------------------------------


def base_counts(texts: Texts, words: Words) -> dict[str, np.ndarray]:
    window_at = words.windows(WINDOW)
    twice = window_at[repeated(in_text(sequence_hashes(words.hashes(), window_at, WINDOW), words.doc[window_at]))]
    size = len(words.starts) + 1
    covered = np.cumsum(np.bincount(twice, minlength=size) - np.bincount(twice + WINDOW, minlength=size))[:-1] > 0
    return {
        "n_words": words.counts, "word_chars": words.code_points(), "n_symbols": per_text(_SYMBOL[texts.data], texts.offsets),
        "n_dup_lines": repeated_lines(texts), "n_repeat_words": per_text(covered, words.bounds),
    }


def repeated_lines(texts: Texts) -> np.ndarray:
    """Lines of each text that equal an earlier line of it and hold a word."""
    starts, ends, doc = lines_with_words(texts)
    if not len(starts):
        return np.zeros(len(texts), np.int64)
    _, first = np.unique(in_text(segment_hashes(texts.data, starts, ends), doc), return_index=True)
    return np.bincount(doc, minlength=len(texts)) - np.bincount(doc[first], minlength=len(texts))


def judged(column: pa.Array, model: Model | None) -> dict[str, pa.Array]:
    parts: dict[str, list[np.ndarray]] = {f.name: [] for f in ADDED.fields}
    for texts in Texts.chunks(column, TEXT_BYTES):
        words = Words(texts)
        counts = base_counts(texts, words)
        counts["base_failed"] = (counts["n_words"] < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED_PERCENT * counts["n_words"])
        counts["probability"] = model.probability(model.margins(texts, words)) if model else np.ones(len(texts))
        counts["kept"] = ~counts["base_failed"] & (counts["probability"] >= KEEP_AT)
        for name, values in counts.items():
            parts[name].append(values)
    kinds = {T.LongType(): pa.int64(), T.BooleanType(): pa.bool_(), T.DoubleType(): pa.float64()}
    return {f.name: pa.array(np.concatenate(parts[f.name]) if parts[f.name] else np.empty(0), kinds[f.dataType]) for f in ADDED.fields}


def apply_rules(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``probability`` and ``kept``."""
    names = [c for c in docs.columns if c not in ADDED.names]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield with_columns(batch, judged(batch.column(batch.schema.get_field_index(text)), shared.value))
            pa.default_memory_pool().release_unused()

    base = docs.select(*names)
    return base.mapInArrow(score, T.StructType([*base.schema.fields, *ADDED.fields]))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return apply_rules(docs, model).select("doc_id", *ADDED.names)


QUERIES = {"op7_quality_rules": op7_quality_rules}
