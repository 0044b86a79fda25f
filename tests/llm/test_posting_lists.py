"""Posting lists: recall and exact scores against brute force, ties, hot lists, rows that take no part."""

import numpy as np
from pyspark.sql import functions as F

from gapscope.llm import posting_lists as A

SF = "/root/testdata/sf0.01"


def brute(ids, m, queries, k=5):
    out = {}
    length = np.sqrt((m * m).sum(1))
    for i in queries:
        score = (m * m[i]).sum(1) / (length * length[i])
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def rows_of(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_and_scores_on_the_driver_table(spark):
    t = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    ids, m = t.vec_id.to_numpy(), np.stack(t.embedding).astype(np.float64)
    want = brute(ids, m, np.flatnonzero(ids % 50 == 0))
    got = rows_of(A.op9_posting_lists(spark, SF))
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9
    score = {q: dict(want[q]) for q in want}
    assert all(abs(s - score[q].get(i, s)) < 1e-12 for q in got for i, s in got[q])


def test_recall_with_many_lists(spark, monkeypatch):
    monkeypatch.setattr(A, "LIST_SIZE", 32)
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((20, 24))
    m = (centers[rng.integers(0, 20, 3000)] + rng.standard_normal((3000, 24)) * 0.7).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<float>")
    want = brute(np.arange(3000), m.astype(np.float64), range(0, 3000, 50))
    got = rows_of(A.nearest(df, F.col("vec_id") % 50 == 0))
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9


def test_equal_vectors_tie_to_smaller_ids_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(A, "VECTOR_BLOCK", 64)
    monkeypatch.setattr(A, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(1)
    rows = [(i, [0.3, -0.7, 0.2]) for i in range(700)] + [(1000 + i, rng.standard_normal(3).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    got = rows_of(A.nearest(df, F.col("vec_id") % 50 == 0))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5]
    assert [i for i, _ in got[50]] == [0, 1, 2, 3, 4]
    assert all(got[q] == got[50][:0] + [(i, got[50][0][1]) for i, _ in got[q]] for q in (50, 100, 650))


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [1.0, None], 1), (None, [1.0, 1.0], 1),
            (7, [], 1), (8, [1.0, 2.0, 3.0], 1), (1, [0.9, 0.1], 2), (50, [-1.0, 0.0], 1), (100, None, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, list int")
    got = rows_of(A.nearest(df, F.col("vec_id") % 50 == 0))
    assert got.keys() == {0, 50}
    assert [i for i, _ in got[0]] == [1, 50] and [i for i, _ in got[50]] == [1, 0]
    assert A.nearest(df.where("false"), F.lit(True)).count() == 0
    assert A.nearest(df.where("vec_id = 0"), F.lit(True)).count() == 0


def test_lists_are_balanced_and_the_graph_reaches_all(spark):
    m = A.units(np.random.default_rng(5).standard_normal((4000, 16)))
    c = A.centroid_graph(A.halves(m, 64))
    assert c.points.shape == (64, 16)
    own = np.bincount((m @ c.points.T).argmax(1), minlength=64)
    assert own.max() < 6 * own.mean()
    assert len(c.nearest(m[0], 64)[0]) == 64


def test_equal_vectors_are_read_where_they_are_stored():
    for seed in range(60):
        rng = np.random.default_rng(seed)
        m = A.units(np.vstack([np.tile(rng.standard_normal(32), (700, 1)), rng.standard_normal((1400, 32))]).astype(np.float32).astype(np.float64))
        c = A.centroid_graph(A.halves(m, 2100 // 64))
        gaps = np.linalg.norm(c.points[:, None] - c.points[None], axis=2) + np.eye(len(c.points))
        assert gaps.min() > 1e-6
        assert set(c.replicas(m[:1])[0]) & set(c.probes(m[0]).tolist())


def test_queries_short_of_rows_read_more_lists(spark, monkeypatch):
    monkeypatch.setattr(A, "LIST_SIZE", 2)
    monkeypatch.setattr(A, "MORE_LISTS", 2)
    m = np.random.default_rng(2).standard_normal((120, 3))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    got = rows_of(A.nearest(df, F.col("vec_id") % 2 == 0))
    assert got.keys() == set(range(0, 120, 2)) and all(len(x) == 5 for x in got.values())
    few = rows_of(A.nearest(df.where("vec_id < 4"), F.col("vec_id") % 2 == 0))
    assert got.keys() > few.keys() == {0, 2} and all(len(x) == 3 for x in few.values())
