"""Merkle manifest of a dataset: digest-to-children records, and proofs by descent from the root.

Every row is a leaf digest; per group the leaves, in key order, are paired up
level by level to one subroot, and the subroots, in group order, to one root.
A record maps the digest of a node to its descendants ``DEPTH`` levels below
(its children in base ``2 ** DEPTH``) and to the pairwise nodes between. The
store is content addressed: equal subtrees share a record.

A proof is found by descent. Requests (tree, rank) start at the root's
digest; each step looks a digest up in the store, follows one digit of the
rank and collects the nodes not selected on the way, as one path segment.
Segments are found from the root down, so they are put in reverse in the end.
Requests that share the digits so far descend as one row; only the last step
has a row per request.

Scale: ranks come from a range-partitioned sort with counts per partition,
so a group of any size, or a third of all rows being equal, is never one task.
A build step is one shuffle of a level's digests and leaves ``1 / 2 ** DEPTH``
of them, so 64 ** 5 leaves take five. Tables that several steps read go to
the shared scratch folder. No digest reaches the driver but one row per step
(how many levels are left).

Defined results: a null key sorts before others, rows of one key by leaf
digest; equal rows are leaves of their own; a null in a column counts as
``-``; a null group is a group before all others; a lone leaf is its subroot, a lone subroot
the root; a leaf without siblings has the digest of no input as proof digest;
an empty table has no rows; columns of any name may be hashed or ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapscope.llm.common import read, stored

#: Columns of a leaf, in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a record; its digits have this many bits.
DEPTH = 6
_SIDE = "struct<left:boolean,digest:string>"


def digest(*parts: Column) -> Column:
    """H: hex sha256 of the parts in a row."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*columns: Column) -> Column:
    """H of the columns, each ``-`` if null, else byte length, colon, value."""
    return digest(*[F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns])


# --- ranks ----------------------------------------------------------------------


def ranked(leaves: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``leaves`` with ``rank``, a row's place (from 0) in its tree, and ``n``, the tree's size.

    ``tree`` holds no null; order columns sort nulls first. ``leaves`` are
    stored, so the row numbers that spread equal rows over partitions are the
    same in every attempt.
    """
    columns = [F.col(c).asc_nulls_first() for c in [tree, *order]]
    dealt = stored(
        leaves.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*columns, F.col("_at"))
        .withColumn("_part", F.spark_partition_id()), "merkle-ranges")
    runs = dealt.groupBy(tree, "_part").agg(F.count("*").alias("_count"))  # at most partitions + trees
    of_tree = Window.partitionBy(tree)
    before = of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col(tree).alias("_tree"), F.col("_part").alias("_p"), F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start"), F.sum("_count").over(of_tree).alias("n"))
    in_run = Window.partitionBy(tree, "_part").orderBy(*columns[1:], F.col("_at"))
    placed = dealt.withColumn("_k", F.row_number().over(in_run) - 1)
    same = (F.col(tree) == F.col("_tree")) & (F.col("_part") == F.col("_p"))
    return placed.join(runs, same).withColumn("rank", F.col("_start") + F.col("_k")).drop("_at", "_part", "_k", "_tree", "_p", "_start")


# --- build ----------------------------------------------------------------------


def parents(level: Column) -> Column:
    """Digests of every two consecutive nodes; a last single one becomes the digest of itself."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(level), F.lit(2)), lambda i: F.array_join(F.slice(level, i, 2), ""))
    return F.transform(pairs, lambda p: F.sha2(p, 256))


def build(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, roots) over ``nodes`` (tree, rank, n, digest).

    records: (digest, levels); ``levels[0]`` are the node's descendants at the
    record's foot, the later ones the pairwise nodes above them, without the
    node itself. roots: (tree, n, digest, steps), ``steps`` the records on a path.
    """
    records = roots = None
    now, step = nodes.select("tree", "rank", "n", "digest", F.col("n").alias("left")), 0
    while True:
        # a tree of one node is finished
        done = now.where("left = 1").select("tree", "n", "digest", F.lit(step).alias("steps"))
        roots = done if roots is None else roots.unionByName(done)
        rest = now.where("left > 1")
        if rest.isEmpty():
            break
        block = F.shiftright("rank", DEPTH)
        foot = rest.groupBy("tree", "n", "left", block.alias("rank")).agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("held"))  # at most 2 ** DEPTH
        made = foot.withColumn("l0", F.transform("held", lambda h: h["digest"])).drop("held")
        levels = ["l0"]
        for k in range(1, DEPTH + 1):
            # a tree with fewer levels left ends with its one node
            below = F.col(levels[-1])
            whole = F.col("left") <= 1 << (k - 1)
            made = made.withColumn(f"l{k}", F.when(whole, below).otherwise(parents(below)))
            levels.append(f"l{k}")
        height = F.least(F.lit(DEPTH), F.ceil(F.log2("left")).cast("int"))
        made = stored(made.select(
            "tree", "rank", "n", F.element_at(levels[-1], 1).alias("digest"), F.slice(F.array(*levels[:-1]), 1, height).alias("levels"),
            F.ceil(F.col("left") / (1 << DEPTH)).cast("long").alias("left")), "merkle-level")
        found = made.select("digest", "levels")
        records = found if records is None else records.unionByName(found)
        now, step = made.select("tree", "rank", "n", "digest", "left"), step + 1
    if records is None:
        records = now.select("digest", F.array(F.array("digest")).alias("levels")).where("false")
    return records, roots


# --- descent --------------------------------------------------------------------


def segment(levels: Column, digit: Column) -> Column:
    """Nodes not selected on the way up from the foot's ``digit``: (left of the path?, digest, null if the path's node is alone)."""
    def beside(level: Column, k: Column) -> Column:
        at = F.call_function("shiftright", digit, k)
        left = at % 2 == 1
        return F.struct(left.alias("left"), F.get(level, F.when(left, at - 1).otherwise(at + 1)).alias("digest"))

    return F.transform(levels, beside)


def descend(records: DataFrame, roots: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, rank, any more) with ``found`` (the leaf's digest) and ``path``: the nodes beside the way, from the leaf up.

    ``roots`` are (tree, digest, steps, above), ``above`` the path from there on.
    A request without a leaf of that rank has no row.
    """
    most = roots.agg(F.max("steps")).first()[0] or 0
    front = roots.select("tree", F.lit(0).cast("long").alias("prefix"), "digest", "steps", F.col("above").alias("path"))
    for below in range(most, 0, -1):
        # trees with fewer steps wait for their turn
        wait, go = front.where(F.col("steps") < below), front.where(F.col("steps") == below)
        looked = go.join(records, "digest").drop("digest")
        if below == 1:
            asked = requests.withColumn("_digit", F.col("rank").bitwiseAND((1 << DEPTH) - 1).cast("int")).withColumn("_prefix", F.shiftright("rank", DEPTH))
        else:
            prefix = F.shiftright("rank", DEPTH * (below - 1))
            asked = requests.select("tree", prefix.alias("_next")).distinct().withColumn("_digit", F.col("_next").bitwiseAND((1 << DEPTH) - 1).cast("int")).withColumn("_prefix", F.shiftright("_next", DEPTH))
        looked = looked.withColumnRenamed("tree", "_tree")
        taken = asked.join(looked, (F.col("tree") == F.col("_tree")) & (F.col("_prefix") == F.col("prefix"))).drop("_tree", "_prefix")
        child = F.get(F.get("levels", F.lit(0)), F.col("_digit"))
        taken = taken.withColumn("digest", child).withColumn("path", F.concat(segment(F.col("levels"), F.col("_digit")), "path")).where("digest is not null").drop("levels", "_digit", "prefix")
        if below == 1:
            alone = requests.join(wait.select(F.col("tree").alias("_tree"), "digest", "path"), (F.col("tree") == F.col("_tree")) & (F.col("rank") == 0)).drop("_tree")
            return taken.drop("steps").unionByName(alone).withColumnRenamed("digest", "found")
        following = taken.select("tree", F.col("_next").alias("prefix"), "digest", F.col("steps") - 1, "path").toDF("tree", "prefix", "digest", "steps", "path")
        front = stored(wait.unionByName(following), "merkle-front")
    only = front.select(F.col("tree").alias("_tree"), F.col("digest").alias("found"), "path")
    return requests.join(only, (F.col("tree") == F.col("_tree")) & (F.col("rank") == 0)).drop("_tree")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the nodes beside its way give."""
    def up(own: Column, side: Column) -> Column:
        other = F.coalesce(side["digest"], F.lit(""))
        return F.sha2(F.when(side["left"], F.concat(other, own)).otherwise(F.concat(own, other)), 256)

    return F.aggregate(path, leaf, up)


def proof_digest(path: Column) -> Column:
    """H of the siblings on a path."""
    return F.sha2(F.array_join(F.transform(path, lambda s: s["digest"]), ""), 256)


# --- manifest -------------------------------------------------------------------


def tree_key(group: Column) -> Column:
    """Group names as keys without nulls: the null group first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def manifest(leaves: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Ranked leaves, records, group roots and the root over ``leaves`` (tree, leaf, order columns, any more).

    Group roots are (tree, n, digest, steps, above, root), ``above`` the path from the subroot to the root.
    """
    placed = stored(ranked(stored(leaves, "merkle-leaves"), "tree", [*order, "leaf"]), "merkle-ranked")
    records, roots = build(placed.select("tree", "rank", "n", F.col("leaf").alias("digest")))
    roots = stored(roots, "merkle-subroots")
    tops = stored(ranked(roots.select(F.lit("").alias("top"), F.col("tree").alias("group"), "digest"), "top", ["group"]), "merkle-tops")
    top_records, top = build(tops.select(F.col("top").alias("tree"), "rank", "n", "digest"))
    top = stored(top, "merkle-root")
    none = F.array().cast(f"array<{_SIDE}>")
    store = stored(records.unionByName(top_records).dropDuplicates(["digest"]), "merkle-records")
    paths = descend(store, top.withColumn("above", none), tops.select(F.col("top").alias("tree"), "rank", "group"))
    paths = paths.join(top.select("tree", F.col("digest").alias("root")), "tree")
    named = paths.select(F.col("group").alias("tree"), F.col("path").alias("above"), "root")
    return placed, store, stored(roots.join(named, "tree"), "merkle-roots"), top


def proofs(placed: DataFrame, records: DataFrame, roots: DataFrame) -> DataFrame:
    """``placed`` (tree, rank, any more) with ``found``, ``path``, ``subroot`` and ``root``."""
    under = descend(records, roots.select("tree", "digest", "steps", "above"), placed)
    return under.join(roots.select("tree", F.col("digest").alias("subroot"), "root"), "tree")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    changed = {**{c: F.col(c) for c in COLUMNS}, "n_chars": tampered}
    leaves = docs.select("doc_id", tree_key(F.col("lang")).alias("tree"), leaf_digest(*[F.col(c) for c in COLUMNS]).alias("leaf"), leaf_digest(*changed.values()).alias("now"))
    placed, records, roots, _ = manifest(leaves, ["doc_id"])
    shown = proofs(placed, records, roots).select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded(F.col("now"), F.col("path")).alias("folded_root"))
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}

ORACLE = {"op12_merkle_manifest": r"""
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t FROM range(256) r(i)),
rows AS (
  SELECT doc_id, lang, source, n_chars, text,
         list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(unicode(s) AS BIGINT))),
                     lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])) AS crc
  FROM documents, crc_table),
parts AS (
  SELECT doc_id, lang, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         n_chars, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS changed, coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM rows),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(strlen(CAST(changed AS VARCHAR)) || ':' || changed, '-') || tail) AS now FROM parts),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes(lang, level, idx, digest, n) AS (
  SELECT lang, 0, rank, leaf, n FROM placed
  UNION ALL
  SELECT lang, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 2, n),
tops AS (
  SELECT lang, digest AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM nodes WHERE n = 1),
above(level, idx, digest, n) AS (
  SELECT 0, rank, subroot, n FROM tops
  UNION ALL
  SELECT level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (n + 1) // 2 FROM above WHERE n > 1 GROUP BY level, idx // 2, n),
way AS (
  SELECT p.doc_id, p.lang, p.rank, x.level, (p.rank >> x.level) % 2 = 1 AS is_left, s.digest
  FROM placed p JOIN nodes x ON x.lang IS NOT DISTINCT FROM p.lang AND x.idx = p.rank >> x.level AND x.n > 1
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM x.lang AND s.level = x.level AND s.idx = xor(x.idx, 1)
  UNION ALL
  SELECT p.doc_id, p.lang, p.rank, t.height + x.level, (t.rank >> x.level) % 2 = 1, s.digest
  FROM placed p JOIN tops t ON t.lang IS NOT DISTINCT FROM p.lang JOIN above x ON x.idx = t.rank >> x.level AND x.n > 1
  LEFT JOIN above s ON s.level = x.level AND s.idx = xor(x.idx, 1)),
paths AS (
  SELECT lang, rank, list({'left': is_left, 'digest': digest} ORDER BY level) AS path FROM way GROUP BY lang, rank),
fold(doc_id, lang, rank, leaf, own, path, level) AS (
  SELECT p.doc_id, p.lang, p.rank, p.leaf, p.now, coalesce(w.path, []), 1 FROM placed p LEFT JOIN paths w ON w.lang IS NOT DISTINCT FROM p.lang AND w.rank = p.rank
  UNION ALL
  SELECT doc_id, lang, rank, leaf, sha256(CASE WHEN path[level].left THEN coalesce(path[level].digest, '') || own ELSE own || coalesce(path[level].digest, '') END), path, level + 1
  FROM fold WHERE level <= len(path))
SELECT f.doc_id, f.leaf, t.subroot, a.digest AS root, sha256(coalesce(array_to_string(list_transform(f.path, lambda s: coalesce(s.digest, '')), ''), '')) AS proof_sha256,
       f.own AS folded_root, f.own = a.digest AS verified
FROM fold f JOIN tops t ON t.lang IS NOT DISTINCT FROM f.lang CROSS JOIN (SELECT digest FROM above WHERE n = 1) a WHERE f.level > len(f.path)
"""}
