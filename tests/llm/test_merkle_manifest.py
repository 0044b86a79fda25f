"""Merkle manifest: trees and proofs against plain hashlib code, odd rows, groups of many sizes."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from gapscope.llm import merkle_manifest as M

H = lambda *parts: sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in M.COLUMNS])


def tree(digests):
    """Levels from the leaves to the root."""
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[i: i + 2]) for i in range(0, len(below), 2)])
    return levels


def siblings(levels, rank):
    out = []
    for level in levels[:-1]:
        out += [level[rank ^ 1]] if rank ^ 1 < len(level) else []
        rank //= 2
    return out


def brute(rows):
    """(doc_id, leaf, subroot, root, proof) of each row, as a sorted list."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {}
    for g in names:
        held = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        made[g] = held, tree([leaf(r) for r in held])
    top = tree([made[g][1][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        held, levels = made[g]
        out += [(r["doc_id"], leaf(r), levels[-1][0], top[-1][0], H(*siblings(levels, i), *siblings(top, k))) for i, r in enumerate(held)]
    return sorted(out, key=str)


def run(docs, tampered=None):
    cols = [F.col(c) for c in M.COLUMNS]
    leaves = docs.select("doc_id", M.tree_key(F.col("lang")).alias("tree"), M.leaf_digest(*cols).alias("leaf"))
    placed, records, roots, _ = M.manifest(leaves, ["doc_id"])
    return M.proofs(placed, records, roots).select("doc_id", "leaf", "subroot", "root", M.proof_digest(F.col("path")).alias("proof"), M.folded(F.col("leaf"), F.col("path")).alias("own"), "found")


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 2, None: 1}, {"a": 63, "b": 64, "c": 65, None: 3, "é": 1}, {"a": 4097}])
def test_trees_of_many_sizes(spark, sizes):
    made = random.Random(1)
    rows = [(made.randrange(10**6), f"s{made.randrange(3)}", g, made.choice([None, 5]), f"text {made.random()}") for g, n in sizes.items() for _ in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    got = run(docs).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == brute([r.asDict() for r in docs.collect()])
    assert all(r.own == r.root and r.found == r.leaf for r in got)


def test_odd_rows(odd_docs, no_docs):
    docs = odd_docs.withColumn("rank", F.lit(7)).withColumn("digest", F.lit("clash"))
    got = run(docs).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == brute([r.asDict() for r in docs.collect()])
    assert run(no_docs).count() == 0


def test_equal_rows_in_one_group(spark):
    row = (1, "s", "en", 3, "abc")
    docs = spark.createDataFrame([row] * 300 + [(2, "s", "en", 3, "abc")], "doc_id long, source string, lang string, n_chars long, text string")
    assert sorted([tuple(r)[:5] for r in run(docs).collect()], key=str) == brute([r.asDict() for r in docs.collect()])


def test_requests_for_some_leaves_and_for_none_that_exist(spark):
    nodes = spark.range(200).select(F.lit("t").alias("tree"), F.col("id").alias("rank"), F.lit(200).cast("long").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    records, roots = M.build(nodes)
    asked = spark.createDataFrame([("t", 0), ("t", 199), ("t", 64), ("t", 200), ("other", 0)], "tree string, rank long")
    none = F.array().cast("array<struct<left:boolean,digest:string>>")
    got = {r["rank"]: r for r in M.descend(records.dropDuplicates(["digest"]), roots.withColumn("above", none), asked).collect()}
    levels = tree([H(str(i)) for i in range(200)])
    assert set(got) == {0, 64, 199} and all(r.found == H(str(k)) for k, r in got.items())
    assert all([s.digest for s in r.path if s.digest] == siblings(levels, k) for k, r in got.items())


def test_tampered_rows_do_not_verify(spark):
    from zlib import crc32

    rows = M.op12_merkle_manifest(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.verified == (crc32(str(r.doc_id).encode()) % 7 != 0) for r in rows)
