"""Mixing: targets against plain Python, nearness, inclusion, repeatability, edge cases."""

import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gapscope.llm import mixing as M

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Fill sources in rounds until none is above its limit (exact fractions)."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(names)}
    budget, full = Fraction(3, 2) * sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in full]
        share = {s: (budget - sum(full.values())) * weight[s] / sum(weight[t] for t in left) for s in left}
        above = [s for s in left if share[s] > 2 * sizes[s]]
        if not above:
            return {**share, **full}
        full |= {s: Fraction(2 * sizes[s]) for s in above}


def test_targets_and_words_on_the_driver_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    words = {d.doc_id: len(WORD.findall(d.text or "")) for d in docs}
    sizes = {}
    for d in docs:
        sizes[d.source] = sizes.get(d.source, 0) + words[d.doc_id]
    want = targets(sizes)
    rows = {r.doc_id: r for r in M.op10_mixing(spark, SF).collect()}
    taken, most = {}, {}
    for d in docs:
        r = rows[d.doc_id]
        assert r.size == words[d.doc_id] and r.source_size == sizes[d.source]
        assert r.target == pytest.approx(float(want[d.source])) and 0 <= r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
        taken[d.source] = taken.get(d.source, 0) + r.taken
        most[d.source] = max(most.get(d.source, 0), r.size)
    assert all(abs(taken[s] - want[s]) <= most[s] for s in sizes)


@pytest.mark.parametrize("sizes", [{"a": [5] * 40, "b": [3] * 10, "c": [1]}, {"a": [1], "b": [1000] * 3}, {None: [7, 7], "x": [0, 0], "y": [9] * 50}])
def test_targets_in_closed_form(spark, sizes):
    rows = [(s, n) for s, v in sizes.items() for n in v]
    got = {r.source: r.target for r in M.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    want = targets({s: sum(v) for s, v in sizes.items()})
    assert got == pytest.approx({s: float(t) for s, t in want.items()})


def test_reruns_and_partitioning_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = M.mix(docs).select("doc_id", "taken").collect()
    b = M.mix(docs.repartition(13)).select("doc_id", "taken").collect()
    assert sorted(a) == sorted(b)


def test_every_document_has_a_fair_chance(spark):
    r = random.Random(1)
    rows = [(i, "s", " ".join("w" for _ in range(r.choice((1, 5, 30))))) for i in range(400)] + [(1000 + i, "t", "w " * 40) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    seen, p = {}, {}
    for seed in range(6):
        for x in M.mix(docs, seed=str(seed)).collect():
            seen[x.size] = seen.get(x.size, []) + [x.copies]
            p[x.size] = x.target / x.source_size
    assert all(abs(sum(c) / len(c) - p[n]) < 0.12 for n, c in seen.items())


def test_corpus_repeats_documents(spark):
    docs = spark.createDataFrame([(i, "a" if i else "b", "w " * 10) for i in range(30)], "doc_id long, source string, text string")
    copies = {r.doc_id: r.copies for r in M.mix(docs).collect()}
    out = M.mixed_corpus(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == {k: c for k, c in copies.items() if c}


def test_odd_rows_and_empty_table(odd_docs, no_docs):
    docs = odd_docs.withColumn("size", F.lit("clash")).withColumn("target", F.lit(None).cast("string"))
    rows = M.mix(docs).collect()
    assert len(rows) == docs.count()
    assert {(r.doc_id, r.text): r["size"] for r in rows} == {(r.doc_id, r.text): len(WORD.findall(r.text or "")) for r in docs.collect()}
    assert M.mix(no_docs).count() == 0 and M.mixed_corpus(no_docs).count() == 0
