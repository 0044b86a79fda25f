"""N-gram Jaccard join: prefix tree and whole operator against brute force, groups of copies, edge cases."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapscope.llm import jaccard_join as J
from gapscope.llm.jaccard_trie import PrefixTree, least_overlap

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i: i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    """(key, n, component) of each row, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    near = list(range(len(rows)))

    def root(i):
        while near[i] != i:
            i = near[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * len(a | sets[j]):
                near[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return sorted(((k, len(sets[i]), least.get(root(i))) for i, (k, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def near_copies(rng, base, count, edits):
    out = []
    for _ in range(count):
        w = base.split()
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = rng.choice(["zu", "yo", "xe"]) + str(rng.randrange(1000))
        out.append(" ".join(w))
    return out


def test_prefix_tree_equals_all_pairs():
    rng = np.random.default_rng(2)
    for _ in range(30):
        base = rng.integers(0, 60, 40).astype(np.uint64)
        sets = [np.unique(np.where(rng.random(40) < 0.12, rng.integers(0, 200, 40), base).astype(np.uint64))[: rng.integers(1, 40)] for _ in range(25)] + [np.unique(base)] * 2
        probe = np.unique(base)
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, probe)) >= 75 * len(np.union1d(s, probe))]
        assert sorted(PrefixTree(sets).linked(probe)) == want


def test_sketches_never_rule_out_a_link():
    import pyarrow as pa

    rng = np.random.default_rng(8)
    pairs = []
    for _ in range(300):
        base = np.unique(rng.integers(0, 1 << 58, rng.integers(1, 400)).astype(np.uint64))
        other = np.unique(np.where(rng.random(len(base)) < rng.choice([0.0, 0.1, 0.14, 0.3]), rng.integers(0, 1 << 58, len(base)).astype(np.uint64), base))
        pairs.append((base, other))
    pairs.append((np.arange(0, 128 * 300, 128, dtype=np.uint64),) * 2)
    assert J.sketch(pairs[-1][0]) is None
    batch = pa.RecordBatch.from_arrays([pa.array(range(301), pa.int64())] * 2 + [pa.array([J.sketch(p[k]) for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b", "x", "y"])
    kept = {r for out in J.possible([batch]) for r in out.column(0).to_pylist()}
    linked = {i for i, (x, y) in enumerate(pairs) if 100 * len(np.intersect1d(x, y)) >= 75 * len(np.union1d(x, y))}
    assert linked <= kept and len(kept) < 301


def test_least_overlap_is_exact():
    for n in range(1, 40):
        for m in range(1, 40):
            o = least_overlap(n, m, 75, 100)
            assert 100 * o >= 75 * (n + m - o) and 100 * (o - 1) < 75 * (n + m - o + 1)


def test_against_brute_force(spark):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice("an the of ing tion er re at Is").lower() + rng.choice("abcdefgh") for _ in range(n))
    passage = say(60)
    texts = [t for _ in range(12) for t in near_copies(rng, say(rng.randint(6, 150)), 9, 6)]
    texts += [f"{say(rng.randint(20, 200))} {passage} {say(5)}" for _ in range(40)]
    texts += near_copies(rng, say(120), 60, 4) + [say(80)] * 30 + ["One two", "one TWO", "one", "five words are here now", "", None, " \n"]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(3, "another text under the same id here"), (None, "no id at all in this row"), (None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert got(J.jaccard_components(docs)) == brute(rows)


def test_chain_of_links_is_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[5 * i: 5 * i + 100])) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows)
    assert len({c for _, _, c in want}) == 1 and got(J.jaccard_components(docs)) == want


def test_frequent_shingles_only_change_the_order(spark, monkeypatch):
    monkeypatch.setattr(J, "FEW", 3)
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"{passage} " + " ".join(rng.choice("abcdefghij") + str(rng.randrange(30)) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    signed = docs.select(F.col("doc_id").alias("key"), "text").mapInArrow(J.classes, "key long, n long, sig long, shingle long, seen long")
    assert len(J.frequent_shingles(signed)[0]) >= 36
    assert got(J.jaccard_components(docs)) == brute(rows)
    monkeypatch.setattr(J, "MOST_FREQUENT", 40)
    assert len(J.frequent_shingles(signed)[0]) <= 40
    assert got(J.jaccard_components(docs)) == brute(rows)
    monkeypatch.setattr(J, "MOST_FREQUENT", 0)
    assert len(J.frequent_shingles(signed)[0]) == 0
    assert got(J.jaccard_components(docs)) == brute(rows)


def test_odd_rows_and_empty_table(odd_docs, no_docs):
    docs = odd_docs.withColumn("key", F.lit("clash")).withColumn("component_id", F.lit(1))
    assert got(J.jaccard_components(docs)) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert J.jaccard_components(no_docs).count() == 0


def test_rows_without_an_id_are_reduced_to_one_of_each_group(spark):
    from gapscope.llm.near_copies import one_of_each

    say = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(None, say(1)), (None, say(1)), (None, say(1) + " more"), (5, say(2)), (6, say(2)), (None, say(2)), (None, say(3)), (None, ""), (None, ""), (None, None), (7, say(4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in one_of_each(docs).collect()]
    assert len([t for k, t in got if k is None and t in (say(1), say(1) + " more")]) == 1
    assert sorted(k for k, _ in got if k is not None) == [5, 7]
    assert got.count((None, say(2))) == 0 and got.count((None, say(3))) == 1 and got.count((None, "")) == 2 and got.count((None, None)) == 1


@pytest.mark.parametrize("shared_id", [None, 7])
def test_many_rows_of_one_id_or_none(spark, shared_id):
    """2,000 classes of pairs that link, all under one id or none: sets are fetched by content, not by id."""
    rows = []
    for k in range(1000):
        words = [f"w{k}x{j}" for j in range(40)]
        rows += [(shared_id, " ".join(words)), (shared_id, " ".join([*words[:-1], "other"]))]
    docs = spark.createDataFrame([*rows, (3, rows[0][1])], "doc_id long, text string").repartition(4)
    documents, labels = J.jaccard_classes(docs)
    assert labels.groupBy("label").count().where("count = 2").count() == 1000
    found = J.jaccard_components(docs).collect()
    assert len(found) == 2001 and all(r.n_shingles == 36 for r in found)
    assert {r.component_id for r in found} == {3, shared_id}


def test_only_texts_that_may_link_travel(spark, monkeypatch):
    """Classes that share a frequent passage but cannot link hand on no text; pairs that may link do, whatever bytes they hold."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(12)]
    far = [(i, " ".join([*passage, *(f"w{rng.randrange(10**9)}" for _ in range(30))])) for i in range(12)]
    near = [f"n{i}\u00e9" for i in range(60)]
    rows = [*far, (90, " ".join(near)), (91, " ".join([*near[:-1], "other"])), (92, " ".join(near).replace("n", "N"))]
    asked = []
    travelling = J.class_texts
    monkeypatch.setattr(J, "class_texts", lambda docs, wanted: (asked.append({r.sig for r in wanted.collect()}), travelling(docs, wanted))[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signs = {r.key: r.sig for r in J.jaccard_classes(docs)[0].collect()}
    assert set().union(*asked) == {signs[90], signs[91]} and signs[92] == signs[90]
    assert got(J.jaccard_components(docs)) == brute(rows)
    packed = {r.sig: r.packed for r in travelling(docs, docs.sparkSession.createDataFrame([(signs[91],)], "sig long")).collect()}
    sets = list(J.unpacked_sets([packed[signs[91]]] * 3, J.frequent_shingles(spark.createDataFrame([], "shingle long, seen long"))))
    assert len(sets) == 3 and all(len(s) == 56 and (s == sets[0]).all() for s in sets)
