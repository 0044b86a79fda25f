"""Quality classifier: weighted votes of the nearest labelled documents in a latent space.

Every whole text becomes hashed shares of its words, of its byte 3-grams and
of whether a word repeats the one before. A truncated SVD of a bounded
labelled sample gives the latent space. The sample's latent vectors and
labels are broadcast: at most ``SAMPLE_ROWS x RANK`` numbers, whatever the
corpus. Each document is then compared with all of them, exactly, in blocks
of one matrix product, and the labels of its nearest neighbours are averaged
with weights that rise steeply with the cosine.

Only ``text`` is an input of a score. Rows whose ``crc32(key as text) mod 4``
is 2 are held out: their labels are never read.

Defined results: null and empty texts, and texts without any shared feature,
get the sample's share of label 1; without labelled rows every score is 0.5;
a null key is not held out; repeated rows score alike; neighbours at equal
cosine count by order of the sample's keys; columns that clash with the added
names are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapscope.llm.common import labelled_documents, read, with_columns
from gapscope.llm.grams import byte_grams
from gapscope.llm.words import Texts, Words

SAMPLE_ROWS = 3000
RANK, NEIGHBOURS, SHARPNESS = 32, 10, 8
PREDICT_AT = 0.7
#: Bits of the hashed words, byte 3-grams and repetition flags; weight of each part.
PART_BITS, PART_WEIGHTS = (11, 12, 1), (0.5, 1.0, 1.0)
PART_STARTS = tuple(np.cumsum([0] + [1 << b for b in PART_BITS]).tolist())
SIZE = PART_STARTS[-1]
#: Documents compared at a time.
BLOCK = 512


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def shares(texts: Texts) -> np.ndarray:
    """Square roots of the shares of each hashed feature within its part: texts x SIZE."""
    words, n = Words(texts), len(texts)
    hashes = words.hashes()
    grams, valid = byte_grams(texts, 3, PART_BITS[1])
    gram_at = np.concatenate([[0], np.cumsum(valid)])[texts.offsets]
    again = np.zeros(len(hashes), np.int64)
    again[1:] = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    parts = (
        ((hashes >> np.uint64(64 - PART_BITS[0])).astype(np.int64), words.counts),
        (grams[valid].astype(np.int64), np.diff(gram_at)),
        (again, words.counts),
    )
    out = np.empty((n, SIZE), np.float32)
    for k, (bucket, counts) in enumerate(parts):
        row = np.repeat(np.arange(n, dtype=np.int64) << PART_BITS[k], counts)
        seen = np.bincount(row + bucket, minlength=n << PART_BITS[k]).reshape(n, -1)
        out[:, PART_STARTS[k]: PART_STARTS[k + 1]] = np.sqrt(seen / np.maximum(counts, 1)[:, None])
    return out


@dataclass
class Model:
    """Projection to the latent space (feature weights folded in), the sample's unit vectors and labels."""

    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, features: np.ndarray) -> np.ndarray:
        v = features @ self.projection
        length = np.linalg.norm(v, axis=1, keepdims=True)
        return np.divide(v, length, out=np.zeros_like(v), where=length > 1e-9)

    def scores(self, features: np.ndarray) -> np.ndarray:
        cosines = self.latent(features) @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        near = np.sort(np.argpartition(-cosines, k - 1, axis=1)[:, :k], axis=1)
        weight = np.maximum(np.take_along_axis(cosines, near, 1), 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(1)
        vote = (weight * self.labels[near]).sum(1) / np.where(total > 0, total, 1)
        return np.clip(np.where(total > 0, vote, self.labels.mean()), 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS) -> Model | None:
    """Latent space of at most ``rows`` labelled documents (one of each id) outside the held-out fold; None without any.

    The sample's features reach the driver: at most ``rows x SIZE`` floats.
    """
    picked = labelled_documents(docs, labels.where(~held_out(F.col(key))), key, text, label, rows)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shares(t) for t in Texts.chunks(batch.column(2))]
            flat = [row.tobytes() for block in made for row in block]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(flat, pa.binary())], names=["key", "label", "features"])

    found = picked.mapInArrow(features, "key string, label int, features binary").toArrow().sort_by([("key", "ascending")])
    if not found.num_rows:
        return None
    raw = np.frombuffer(b"".join(found.column("features").to_pylist()), np.float32).reshape(found.num_rows, SIZE)
    return latent_space(raw, found.column("label").to_numpy().astype(np.float64))


def latent_space(raw: np.ndarray, labels: np.ndarray) -> Model:
    """Randomised truncated SVD (fixed seed) of the weighted, normalised rows."""
    n = len(raw)
    weight = np.repeat(np.array(PART_WEIGHTS), [1 << b for b in PART_BITS])
    rarity = np.log((1 + n) / (1 + (raw > 0).sum(0))) + 0.3
    rarity[PART_STARTS[2]:] = 1.0
    weight = (weight * rarity).astype(np.float32)
    rows = raw * weight
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    rank = min(RANK, n, SIZE)
    basis = rows @ np.random.default_rng(0).standard_normal((SIZE, min(rank + 10, n))).astype(np.float32)
    for _ in range(3):
        basis = rows @ (rows.T @ np.linalg.qr(basis)[0])
    basis = np.linalg.qr(basis)[0]
    right = np.linalg.svd(basis.T @ rows, full_matrices=False)[2][:rank].T
    model = Model((weight[:, None] * right).astype(np.float32), np.empty((0, rank), np.float32), labels)
    model.vectors = model.latent(raw)
    return model


def score_quality(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``held_out, score, predicted``."""
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    names = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.empty(0)]
            for texts in Texts.chunks(batch.column(batch.schema.get_field_index(text)), 4 << 20):
                for at in range(0, len(texts), BLOCK):
                    offsets = texts.offsets[at: at + BLOCK + 1]
                    block = Texts(texts.data[offsets[0]: offsets[-1]], offsets - offsets[0])
                    parts.append(shared.value.scores(shares(block)) if shared.value else np.full(len(block), 0.5))
            score = np.concatenate(parts)
            yield with_columns(batch, {"score": pa.array(score, pa.float64()), "predicted": pa.array((score >= PREDICT_AT).astype(np.int32), pa.int32())})

    base = docs.select(*names, held_out(F.col(key)).alias("held_out"))
    return base.mapInArrow(vote, T.StructType([*base.schema.fields, *added]))


def op1_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, fit(docs, read(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted")


QUERIES = {"op1_quality_votes": op1_quality_votes}
