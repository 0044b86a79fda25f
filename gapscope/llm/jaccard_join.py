"""N-gram Jaccard join: which documents reach each other by links of similarity 0.75 or more.

Documents with equal shingle sets are one class from the start, so copies are
never paired. Shingles are ordered globally by how often they were counted,
rare ones first (by hash), those that most documents share last. Of two linked sets, each holds one of
the other's first ``n - ceil(0.75 n) + 1`` shingles in that order, so only
this prefix is dealt out by shingle.

Classes that meet under a shingle are checked in two rounds, both exact, by
walking a prefix tree of the candidates with the probe's set
(``gapscope.llm.jaccard_trie``). Round one checks all pairs under a shingle
of few classes; under others each class against two of them: linear work,
which joins groups of near copies. Round two checks the pairs that still lie
in different components; a shingle whose classes are all in one component is
left out, since more links inside a component change nothing. In both
rounds, counts by hash cell (128 bytes a set) first rule out pairs that
cannot share enough; only of classes in pairs left after that does one text travel, compressed,
from which its set is made again. So no link between different components is lost,
and no group of near copies is expanded into its pairs.

Scale: shingles are counted over all documents. The most frequent ones, at
most ``MOST_FREQUENT``, are broadcast. The order only steers the cost; any
order gives the same links. A set takes 8 bytes a shingle that do not compress, more
than twice its text, so texts are shuffled in their place. Tables that several steps read are written
to the shared scratch folder.

Defined results: null texts and texts without words have no shingles and are
linked with nothing; rows with one id and different texts are separate
documents whose component has the smallest id; a null id stands behind every
other; repeated rows are copies; an empty table gives an empty table. Columns
of the input are not used beyond the key and the text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapscope.llm.common import bit_filter, in_filter, read, stored
from gapscope.llm.jaccard_trie import PrefixTree
from gapscope.llm.words import Texts, Words, sequence_hashes

SHINGLE = 5
PART, WHOLE = 75, 100
#: Entries of the broadcast list of frequent shingles, at most (9 bytes each).
MOST_FREQUENT = 1_000_000
#: A shingle of so many classes or fewer has all its pairs checked in round one.
FEW = 8
#: Hash cells of a set's sketch, one byte each.
CELLS = 128
#: Documents whose sets a task holds at a time.
ROWS = 4096
#: Bytes of text whose sets a task makes at a time, or one text.
TEXT_BYTES = 2 << 20
#: Bits of the filter of signatures whose sets are needed.
FILTER_BITS = 26
#: Candidates of one probe that share a task's prefix tree.
BLOCK = 256
#: Order keys hold the level of a shingle's count from this bit on, and its hash below.
LEVEL_AT = 58


# --- sets -----------------------------------------------------------------------


def shingle_sets(texts: Texts) -> list[np.ndarray]:
    """The distinct shingles of each text as ascending 63-bit hashes."""
    words = Words(texts)
    hashes = words.hashes(lower=True)
    at = words.windows(SHINGLE)
    keys = sequence_hashes(hashes, at, SHINGLE) >> np.uint64(1)
    bounds = np.searchsorted(at, words.bounds)
    sets = [np.unique(keys[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    for i in np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE)):
        sets[i] = sequence_hashes(hashes, words.bounds[i: i + 1], int(words.counts[i])) >> np.uint64(1)
    return sets


def signature(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def ordered(shingles: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Order keys, ascending: the level of a shingle's count in the top six bits, 0 if it is not frequent, then its hash."""
    hashes, levels = frequent
    keys = shingles >> np.uint64(63 - LEVEL_AT)
    if not len(hashes) or not len(shingles):
        return keys
    at = np.minimum(np.searchsorted(hashes, shingles), len(hashes) - 1)
    level = np.where(hashes[at] == shingles, levels[at], 0).astype(np.uint64)
    return np.sort(keys | (level << np.uint64(LEVEL_AT)))


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of ``ROWS`` rows, which bound the sets held at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)
        pa.default_memory_pool().release_unused()


def sketched_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text) to a row (key, n, sig, sketch) per document, and rows (shingle, seen) for those that several classes of a batch hold."""
    for batch in sliced(batches):
        sets = [s for texts in Texts.chunks(batch.column(1)) for s in shingle_sets(texts)]
        signs = [signature(s) if len(s) else None for s in sets]
        different = {g: s for g, s in zip(signs, sets) if g is not None}
        shingles, seen = np.unique(np.concatenate([np.empty(0, np.uint64), *different.values()]), return_counts=True)
        shingles, seen = shingles[seen > 1], seen[seen > 1]
        n, extra = len(sets), len(shingles)
        yield pa.RecordBatch.from_arrays([
            pa.concat_arrays([batch.column(0), pa.nulls(extra, batch.column(0).type)]),
            pa.array([len(s) for s in sets] + [None] * extra, pa.int64()),
            pa.array(signs + [None] * extra, pa.int64()),
            pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(shingles.view(np.int64), pa.int64())]),
            pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(seen.astype(np.int64), pa.int64())]),
            pa.array([sketch(s) if len(s) else None for s in sets] + [None] * extra, pa.binary()),
        ], names=["key", "n", "sig", "shingle", "seen", "sketch"])


def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``sketched_classes`` without the sketches."""
    for batch in sketched_classes(batches):
        yield batch.select(["key", "n", "sig", "shingle", "seen"])


def frequent_shingles(signed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ascending hashes of the most frequent shingles, and the levels of their counts.

    As many are taken, from the highest level down, as ``MOST_FREQUENT``
    entries hold. A level is half a power of two. Counts are those seen
    within the batches, so a shingle has to recur within one to count; the
    order needs no more than that.
    """
    level = F.least(F.lit(63), 1 + F.floor(2 * F.log2(F.col("seen")))).cast("int").alias("level")
    seen = stored(signed.where("shingle is not null").groupBy("shingle").agg(F.sum("seen").alias("seen")).select("shingle", level), "jaccard-seen")
    held, least = 0, None
    for row in seen.groupBy("level").count().orderBy(F.desc("level")).collect():  # 63 rows at most
        held += row["count"]
        if held > MOST_FREQUENT:
            break
        least = row["level"]
    if least is None:
        return np.empty(0, np.uint64), np.empty(0, np.uint8)
    rows = seen.where(F.col("level") >= least).toArrow()
    hashes = rows.column("shingle").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], rows.column("level").to_numpy().astype(np.uint8)[order]


def postings(docs: DataFrame, frequent) -> DataFrame:
    """(shingle, sig, n, at, rare) of each class's prefix.

    ``at`` is the shingle's place in the set, from 1; ``rare`` counts the
    set's shingles that are not frequent.
    """
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            done: set[int] = set()
            out: list[tuple] = []
            for texts in Texts.chunks(batch.column(1)):
                for s in shingle_sets(texts):
                    if not len(s) or (sig := signature(s)) in done:
                        continue
                    done.add(sig)
                    n = len(s)
                    keys = ordered(s, frequent.value)
                    out.append((keys[: n - -(-PART * n // WHOLE) + 1], sig, n, int(np.searchsorted(keys, np.uint64(1 << LEVEL_AT)))))
            sizes = [len(row[0]) for row in out]
            each = lambda k, kind: np.repeat(np.array([row[k] for row in out], kind), sizes)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.empty(0, np.uint64), *(row[0] for row in out)]).view(np.int64), pa.int64()),
                pa.array(each(1, np.int64), pa.int64()), pa.array(each(2, np.int32), pa.int32()),
                pa.array(np.concatenate([np.empty(0, np.int32), *(np.arange(1, k + 1, dtype=np.int32) for k in sizes)]), pa.int32()),
                pa.array(each(3, np.int32), pa.int32()),
            ], names=["shingle", "sig", "n", "at", "rare"])

    return docs.mapInArrow(deal, "shingle long, sig long, n int, at int, rare int")


def met(posted: DataFrame) -> DataFrame:
    """Postings of the shingles that several classes hold: how many, and two hubs of each.

    The original of a group of near copies has none of their rare shingles.
    So the first hub is the class with the fewest rare shingles, the other
    the one with the greatest signature.
    """
    of_shingle = Window.partitionBy("shingle")
    own = F.struct("sig", "n", "at")
    several = posted.withColumn("last", F.max(own).over(of_shingle)).withColumn("least", F.min("sig").over(of_shingle)).where("least < last.sig")
    return (
        several.withColumn("hub", F.min_by(own, F.struct("rare", "sig")).over(of_shingle)).drop("least", "rare")
        .dropDuplicates(["shingle", "sig"]).withColumn("classes", F.count("*").over(of_shingle))
    )


# --- links ----------------------------------------------------------------------


def may_link(a: str, b: str) -> str:
    """SQL: if this is the first shingle two sets share, is there room for enough overlap behind it?"""
    return f"{WHOLE + PART} * (1 + least({a}.n - {a}.at, {b}.n - {b}.at)) >= {PART} * ({a}.n + {b}.n)"


def first_pairs(shared: DataFrame) -> DataFrame:
    """All pairs under a shingle of few classes; under others, each class with the two hubs."""
    few = shared.where(F.col("classes") <= FEW).groupBy("shingle").agg(F.sort_array(F.collect_list(F.struct("sig", "n", "at"))).alias("held"))  # at most FEW
    every = F.flatten(F.transform("held", lambda x, i: F.transform(F.slice("held", i + 2, F.lit(FEW)), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    within = few.select(F.explode(every).alias("pair")).select("pair.x", "pair.y")
    own = F.struct("sig", "n", "at")
    to_hubs = shared.where(F.col("classes") > FEW).select(F.explode(F.array("hub", "last")).alias("h"), own.alias("o")).where("h.sig != o.sig")
    to_hubs = to_hubs.select(F.when(F.expr("h.sig < o.sig"), F.col("h")).otherwise(F.col("o")).alias("x"), F.when(F.expr("h.sig < o.sig"), F.col("o")).otherwise(F.col("h")).alias("y"))
    return within.unionByName(to_hubs).where(may_link("x", "y")).select(F.col("x.sig").alias("a"), F.col("y.sig").alias("b")).distinct()


def crossing_pairs(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs under a shingle of many classes that lie in different components and were not checked under that shingle."""
    of_shingle = Window.partitionBy("shingle")
    named = (
        shared.where(F.col("classes") > FEW).join(labels, "sig", "left").withColumn("label", F.coalesce("label", "sig"))
        .withColumn("least", F.min("label").over(of_shingle)).withColumn("most", F.max("label").over(of_shingle))
        .where("least < most").select("shingle", "sig", "n", "at", F.array("hub.sig", "last.sig").alias("hubs"), "label")
    )
    left = stored(named, "jaccard-crossing")
    a, b = left.alias("a"), left.alias("b")
    apart = F.expr(f"a.shingle = b.shingle and a.sig < b.sig and a.label != b.label and not array_contains(a.hubs, a.sig) and not array_contains(a.hubs, b.sig) and {may_link('a', 'b')}")
    return a.join(b, apart).select(F.col("a.sig").alias("a"), F.col("b.sig").alias("b")).distinct()


def class_texts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(sig, packed): a text of each class in ``asked`` (sig), compressed, and of a few more.

    Other texts stay where they are: a filter of fixed size with the
    signatures asked for is broadcast, and a task hands on one text of each
    class. Ids play no part, so rows without one, or with the same, cost no
    more than others.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(bit_filter(asked, "sig", FILTER_BITS))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in sliced(batches):
            signs, packed = [], []
            for texts in Texts.chunks(batch.column(0)):
                sets = shingle_sets(texts)
                own = np.array([signature(s) for s in sets], np.int64)
                for k, may in enumerate(in_filter(wanted.value, own.view(np.uint64)).tolist()):
                    if may and len(sets[k]) and own[k] not in done:
                        done.add(int(own[k]))
                        signs.append(int(own[k]))
                        packed.append(zlib.compress(texts.data[texts.offsets[k]: texts.offsets[k + 1]].tobytes(), 1))
            yield pa.RecordBatch.from_arrays([pa.array(signs, pa.int64()), pa.array(packed, pa.binary())], names=["sig", "packed"])

    return docs.select("text").mapInArrow(build, "sig long, packed binary").dropDuplicates(["sig"])


def unpacked_sets(packed: list[bytes], frequent) -> Iterator[np.ndarray]:
    """The ordered sets of compressed texts, some texts at a time."""
    run: list[bytes] = []
    held = 0
    for p in [*packed, None]:
        if run and (p is None or held > TEXT_BYTES):
            texts = Texts(np.frombuffer(b"".join(run), np.uint8), np.cumsum([0, *map(len, run)], dtype=np.int64))
            yield from (ordered(s, frequent) for s in shingle_sets(texts))
            run, held = [], 0
        if p is not None:
            run.append(zlib.decompress(p))
            held += len(run[-1])


def among(rows: DataFrame, held) -> DataFrame:
    """The rows whose ``sig`` the broadcast filter may hold."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(held.value, batch.column(0).to_numpy().view(np.uint64))))

    return rows.mapInArrow(keep, rows.schema)


def sketch(keys: np.ndarray) -> bytes | None:
    """How many of a set's shingles fall to each of ``CELLS`` hash cells; None where a count exceeds a byte."""
    counts = np.bincount((keys & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else None


def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, sketch of a, sketch of b): pairs whose sketches leave room for a link.

    Two sets share no more shingles of a cell than the smaller count there, so
    the sum of the smaller counts bounds the intersection from above.
    """
    for batch in batches:
        whole = np.array([x.is_valid and y.is_valid for x, y in zip(batch.column(2), batch.column(3))], bool)
        keep = ~whole
        if whole.any():
            x, y = (np.frombuffer(b"".join(v for v in batch.column(k).filter(pa.array(whole)).to_pylist()), np.uint8).reshape(-1, CELLS).astype(np.int64) for k in (2, 3))
            keep[whole] = (WHOLE + PART) * np.minimum(x, y).sum(1) >= PART * (x.sum(1) + y.sum(1))
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def check_pairs(pairs: DataFrame, docs: DataFrame, sketches: DataFrame, frequent) -> DataFrame:
    """The pairs (a, b) that link.

    The sketches rule most pairs out, before any set is made.
    Candidates of one probe share a prefix tree, ``BLOCK`` or so at a time.
    """
    both_sketches = pairs.join(sketches.toDF("a", "sketch_a"), "a").join(sketches.toDF("b", "sketch_b"), "b").select("a", "b", "sketch_a", "sketch_b")
    fit = stored(both_sketches.mapInArrow(possible, "a long, b long"), "jaccard-pairs")
    # the class with more candidates is the probe
    both = fit.select(F.explode(F.array("a", "b")).alias("probe")).groupBy("probe").count()
    counted = fit.join(both.toDF("a", "ca"), "a").join(both.toDF("b", "cb"), "b")
    swap = F.col("cb") > F.col("ca")
    rows = counted.select(
        F.when(swap, F.col("b")).otherwise(F.col("a")).alias("probe"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("sig"),
        F.ceil(F.greatest("ca", "cb") / BLOCK).alias("blocks"))
    rows = stored(rows.withColumn("block", F.expr("pmod(hash(sig), blocks)")), "jaccard-candidates")
    probes = rows.select("probe", "block").distinct().select("probe", "block", F.col("probe").alias("sig"))
    asked = rows.select("probe", "block", "sig").unionByName(probes)
    dealt = asked.join(class_texts(docs, both.select(F.col("probe").alias("sig"))), "sig").repartition(F.col("probe"), F.col("block")).sortWithinPartitions("probe", "block")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, here = [], None
        for batch in batches:
            probe, block, sig, packed = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("probe", "block", "sig", "packed"))
            links: list[tuple[int, int]] = []
            for k in range(batch.num_rows):
                if (probe[k], block[k]) != here:
                    links += walked(here, group, frequent.value)
                    group, here = [], (probe[k], block[k])
                group.append((sig[k], packed[k]))
            yield pairs_batch(links)
        yield pairs_batch(walked(here, group, frequent.value))

    return dealt.mapInArrow(walk, "a long, b long")


def walked(here, group, frequent) -> list[tuple[int, int]]:
    if not group:
        return []
    sets = list(unpacked_sets([p for _, p in group], frequent))
    own = [s for (g, _), s in zip(group, sets) if g == here[0]][0]
    others = [(g, s) for (g, _), s in zip(group, sets) if g != here[0]]
    return [(here[0], others[i][0]) for i in PrefixTree([k for _, k in others]).linked(own, PART, WHOLE)]


def pairs_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(sig, label) of every linked class; the label is the least class of its component.

    Every round takes the least label around each class, then the label of
    that label, so a chain shortens by half each time. Rounds go through the
    shared folder. ``labels`` are components known before.
    """
    both_ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = links.select(F.explode(both_ways).alias("edge")).select("edge.a", "edge.b")  # the links are found once
    if labels is not None:
        known = labels.where("sig != label").select(F.col("sig").alias("a"), F.col("label").alias("b"))
        edges = edges.unionByName(known).unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(edges.distinct(), "jaccard-links")
    now = stored(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "sig"), "jaccard-labels")
    while True:
        around = edges.join(now.toDF("b", "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        least = now.join(around.withColumnRenamed("a", "sig"), "sig", "left").select("sig", F.col("label").alias("was"), F.least("label", "near").alias("mid"))
        hop = now.toDF("mid", "far")
        following = stored(least.join(hop, "mid", "left").select("sig", "was", F.least("mid", "far").alias("label")), "jaccard-labels")
        now = following.select("sig", "label")
        if following.where("was != label").isEmpty():
            return now


def jaccard_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(key, n, sig) per document, and (sig, label) of the classes that link to another one."""
    spark = docs.sparkSession
    keyed = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = keyed.schema["key"].dataType.simpleString()
    signed = stored(keyed.mapInArrow(sketched_classes, f"key {kind}, n long, sig long, shingle long, seen long, sketch binary"), "jaccard-signs")
    documents = signed.where("n is not null").select("key", "n", "sig")
    frequent = spark.sparkContext.broadcast(frequent_shingles(signed))
    shared = stored(met(postings(keyed, frequent)), "jaccard-met")
    pairs = stored(first_pairs(shared), "jaccard-first")
    asked = spark.sparkContext.broadcast(bit_filter(shared.select("sig"), "sig", FILTER_BITS))
    sketches = stored(among(signed.where("sig is not null").select("sig", "sketch"), asked).dropDuplicates(["sig"]), "jaccard-sketches")
    labels = components(check_pairs(pairs, keyed, sketches, frequent))
    rest = check_pairs(crossing_pairs(shared, labels), keyed, sketches, frequent)
    return documents, components(rest, labels)


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) per row of ``docs``; the id is the smallest key of the component."""
    documents, labels = jaccard_classes(docs, key, text)
    of_class = class_components(documents, labels).select("sig", "component")
    return documents.join(of_class, "sig", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component_id"))


def class_components(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(sig, label, component) of each class; ``component`` is the smallest key, null if no document of it has one."""
    smallest = documents.where("sig is not null").groupBy("sig").agg(F.min("key").alias("own")).join(labels, "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    of_label = smallest.groupBy("label").agg(F.min("own").alias("component"))
    return smallest.join(of_label, "label").select("sig", "label", "component")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


QUERIES = {"op5_jaccard_join": op5_jaccard_join}

ORACLE = {"op5_jaccard_join": r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM listed),
sized AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sized p ON p.doc_id = x JOIN sized q ON q.doc_id = y WHERE 100 * o >= 75 * (p.n + q.n - o)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, edges.y FROM reach JOIN edges ON edges.x = reach.r)
SELECT d.doc_id, CAST(coalesce(any_value(sized.n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM documents d JOIN reach USING (doc_id) LEFT JOIN sized USING (doc_id) GROUP BY d.doc_id
"""}
