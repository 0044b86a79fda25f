"""Benchmark decontamination by a generalised suffix automaton of the test items.

Items and documents are normalised to words (ASCII letters in lower case,
digits, anything beyond ASCII). The items' words form automata; a document's
words stream through them, and the length of the longest suffix that is part
of an item is tracked. Where it reaches ``WINDOW`` words, or a whole shorter
item, these words are hit. Hit spans of ``CUT_FROM`` words or more are removed from a text, and a
text with more than ``MOST_COVERED`` percent of its words hit goes whole.

A stretch of words in which no two neighbours are neighbours in an item can
hold no match, so it is passed over before the automaton is asked (numpy on
whole Arrow batches). Texts are read in pieces of ``PIECE_BYTES`` that overlap by a
window, so a very long one needs no more memory than others.

Scale: documents are not shuffled. Items are cut into sections of at most ``SECTION`` words
(overlapping by a window, so each window lies in one) and equal sections are
one. The sections are dealt to blocks of at most ``2 * BLOCK_WORDS`` words; each block's
automaton is built in a task and broadcast, so what is broadcast has a bound
whatever the size of the benchmark. Documents pass ``IN_A_PASS`` blocks at a time, then go
through the scratch folder; a benchmark of few blocks, as usual, takes one pass. Which
items a hit section belongs to is a join with the sections' items.

Defined results: null and empty texts have no words; an item without words
has no window; rows of one item id are one item; an item without an id has
its words hit, but is not listed or counted; rows of one document id are
judged on their own; a document without hits lists no items, so
``items_sha256`` is that of the empty string; an empty table gives an empty
table, and without items nothing is hit; the cleaned table has the columns it
came with, but for any named ``_n_words``, ``_spans`` or ``_sections``. Words are compared by 64-bit hashes, sections by 128-bit ones.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapscope.llm.common import read, stored, with_columns
from gapscope.llm.suffix_automaton import SuffixAutomaton
from gapscope.llm.words import LOWER, Texts, Words, segment_hashes

#: Words of a window; shorter items match whole.
WINDOW = 10
#: Words of a section of an item, and of a block of sections (a block has at most twice as many).
SECTION, BLOCK_WORDS = 4096, 50_000
#: Blocks that documents pass before they go through the scratch folder.
IN_A_PASS = 4
#: Bytes of text handled at a time.
PIECE_BYTES = 2 << 20
#: Hit spans of so many words are removed; above this percentage of hit words a text goes whole.
CUT_FROM, MOST_COVERED = 1, 50

#: Word bytes of the contract: all but x00-x2F, x3A-x60 and x7B-x7F, after lower-casing A-Z.
IN_WORD = np.zeros(256, bool)
IN_WORD[0x30:0x3A] = IN_WORD[0x41:0x5B] = IN_WORD[0x61:0x7B] = IN_WORD[0x80:] = True

#: What blocks add to a document.
MARKS = "_n_words long, _spans array<struct<start:long,end:long>>, _sections array<string>"


# --- items ----------------------------------------------------------------------


def sections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, text) to (item, section, n, words): the words of each section, joined by spaces."""
    for batch in batches:
        item, words = [], []
        for k in range(batch.num_rows):
            for part, _ in (p for texts in Texts.chunks(batch.column(1).slice(k, 1)) for p in pieces(texts)):
                found = Words(part, IN_WORD)
                data = LOWER[part.data].tobytes()
                own = [data[a:b] for a, b in zip(found.starts.tolist(), found.ends.tolist())]
                for at in range(0, max(len(own) - WINDOW + 1, min(len(own), 1)), SECTION - WINDOW + 1):
                    item.append(k)
                    words.append(b" ".join(own[at: at + SECTION]))
        names = [hashlib.md5(w).hexdigest() for w in words]
        yield pa.RecordBatch.from_arrays([
            batch.column(0).take(pa.array(item, pa.int64())), pa.array(names, pa.string()),
            pa.array([w.count(b" ") + 1 for w in words], pa.int64()), pa.array(words, pa.binary())], names=["item", "section", "n", "words"])


class Block:
    """Automaton of some sections: what a match of so many words in a state stands for."""

    def __init__(self, names: list[str], texts: list[bytes]):
        split = [t.split(b" ") for t in texts]
        vocabulary = sorted({w for words in split for w in words})
        number = {w: k for k, w in enumerate(vocabulary)}
        numbered = [[number[w] for w in words] for words in split]
        self.automaton = SuffixAutomaton(len(vocabulary))
        for words in numbered:
            self.automaton.add(words)
        self.automaton.finish()
        self.names = names
        self.shortest = min(min(len(w), WINDOW) for w in numbered)
        #: of (state, length): the sections that hold this window or are this short item
        self.owners: dict[int, set[int]] = {}
        #: of a state: bits of the lengths at which a suffix is a short item
        self.short = [0] * len(self.automaton.link)
        for k, words in enumerate(numbered):
            for state, length in self.automaton.follow(words):
                if length >= WINDOW:
                    self.owners.setdefault(self.automaton.suffix_state(state, WINDOW), set()).add(k)
            if len(words) < WINDOW:
                whole = self.automaton.suffix_state(state, len(words))
                self.short[whole] |= 1 << len(words)
                self.owners.setdefault(-whole * WINDOW - len(words), set()).add(k)
        for state in sorted(range(1, len(self.short)), key=self.automaton.longest.__getitem__):
            self.short[state] |= self.short[self.automaton.link[state]]
        hashes = segment_hashes_of(vocabulary)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order.astype(np.int64)
        pairs = {a * len(vocabulary) + b for words in numbered for a, b in zip(words, words[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)
        self._known: dict[tuple[int, int], tuple[int, frozenset[int]]] = {}

    def of(self, state: int, length: int) -> tuple[int, frozenset[int]]:
        """How many words a match covers (0: too short) and the sections it is of."""
        found = self._known.get((state, length))
        if found is None:
            covered, own = 0, set()
            for k in range(1, WINDOW):
                if k <= length and self.short[state] >> k & 1:
                    covered = k
                    own |= self.owners[-self.automaton.suffix_state(state, k) * WINDOW - k]
            if length >= WINDOW:
                covered = WINDOW
                own |= self.owners[self.automaton.suffix_state(state, WINDOW)]
            found = self._known[state, length] = (covered, frozenset(own))
        return found


def segment_hashes_of(words: list[bytes]) -> np.ndarray:
    """Hashes as of the same words in a text."""
    data = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    return segment_hashes(data, starts, ends)


def blocks(items: DataFrame, item: str, text: str) -> tuple[list[Broadcast], DataFrame]:
    """Broadcast blocks of the items' sections, and (section, item)."""
    spark = items.sparkSession
    kind = items.schema[item].dataType.simpleString()
    cut = stored(items.select(item, F.coalesce(text, F.lit(""))).mapInArrow(sections, f"item {kind}, section string, n long, words binary"), "benchmark-sections")
    distinct = stored(cut.groupBy("section").agg(F.first("n").alias("n"), F.first("words").alias("words")), "benchmark-distinct")
    total = distinct.agg(F.sum("n")).first()[0] or 0
    count = -(-total // BLOCK_WORDS)
    while count:
        dealt = distinct.withColumn("block", F.pmod(F.xxhash64("section"), F.lit(count)))
        if dealt.groupBy("block").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] <= 2 * BLOCK_WORDS:
            break
        count *= 2

    def build(table: pa.Table) -> pa.Table:
        block = Block(table.column("section").to_pylist(), table.column("words").to_pylist())
        return pa.table({"block": [table.column("block")[0].as_py()], "made": pa.array([pickle.dumps(block)], pa.binary())})

    held = []
    if count:
        made = stored(dealt.groupBy("block").applyInArrow(build, "block long, made binary"), "benchmark-blocks")  # a group has at most 2 * BLOCK_WORDS words
        for row in made.toLocalIterator():
            held.append(spark.sparkContext.broadcast(pickle.loads(row["made"])))
    return held, cut.where(F.col("item").isNotNull()).select("section", "item").distinct()


# --- documents ------------------------------------------------------------------


def pieces(texts: Texts) -> Iterator[tuple[Texts, int]]:
    """(texts, words at the end that the next piece begins with): whole texts, or pieces of a long one."""
    if len(texts) > 1 or len(texts.data) <= PIECE_BYTES:
        yield texts, 0
        return
    at, size = 0, PIECE_BYTES
    while True:
        part = texts.data[at: at + size]
        if at + size >= len(texts.data):
            yield Texts(part, np.array([0, len(part)])), 0
            return
        starts = Words(Texts(part, np.array([0, len(part)])), IN_WORD).starts
        if len(starts) <= WINDOW:  # words longer than a piece, or none
            size *= 2
            continue
        # the last word may go on: it begins the next piece, behind as many words as a window needs
        yield Texts(part[: starts[-1]], np.array([0, starts[-1]])), WINDOW - 1
        at, size = at + int(starts[-WINDOW]), PIECE_BYTES


def hits(texts: Texts, words: Words, block: Block) -> list[tuple[int, int, int, frozenset[int]]]:
    """(text, first word, end, sections) of the matches, by places among all ``words``."""
    if len(words.starts) < block.shortest:
        return []
    hashes = words.hashes(lower=True)
    at = np.minimum(np.searchsorted(block.hashes, hashes), len(block.hashes) - 1)
    known = block.hashes[at] == hashes
    number = np.where(known, block.numbers[at], -1)
    pair = number[:-1] * block.automaton.words + number[1:]
    place = np.minimum(np.searchsorted(block.pairs, pair), max(len(block.pairs) - 1, 0))
    joined = known[:-1] & known[1:] & (words.doc[:-1] == words.doc[1:])
    joined &= (block.pairs[place] == pair) if len(block.pairs) else False
    # stretches of known words, each joined to the next
    begin = np.flatnonzero(known & ~np.concatenate([[False], joined]))
    end = np.flatnonzero(known & ~np.concatenate([joined, [False]])) + 1
    long = end - begin >= block.shortest
    out = []
    for a, b in zip(begin[long].tolist(), end[long].tolist()):
        doc = int(words.doc[a])
        for k, (state, length) in enumerate(block.automaton.follow(number[a:b].tolist()), a + 1):
            if length >= block.shortest:
                covered, own = block.of(state, length if length < WINDOW else WINDOW)
                if covered:
                    out.append((doc, k - covered, k, own))
    return out


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, with those that meet or overlap made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def marked(docs: DataFrame, block: Broadcast | None, text: str) -> DataFrame:
    """``docs`` with what a block adds to the marks: number of words, hit spans (in words), sections met."""
    fields = T.StructType.fromDDL(MARKS).fields
    names = [f.name for f in fields]
    base = T.StructType([f for f in docs.schema.fields if f.name not in names])
    arrow = [pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans, met = [], [], []
            for texts in Texts.chunks(batch.column(batch.schema.get_field_index(text)), PIECE_BYTES):
                row, n = len(counts), len(texts)
                counts += [0] * n
                spans += [[] for _ in range(n)]
                met += [set() for _ in range(n)]
                for part, again in pieces(texts):
                    words = Words(part, IN_WORD)
                    for doc, a, b, own in hits(part, words, block.value) if block else ():
                        shift = counts[row + doc] - int(words.bounds[doc])
                        spans[row + doc].append((a + shift, b + shift))
                        met[row + doc].update(block.value.names[k] for k in own)
                    for doc in range(n):
                        counts[row + doc] += int(words.counts[doc]) - again
            if "_spans" in batch.schema.names:  # marks of earlier blocks
                for row, (old, seen) in enumerate(zip(batch.column("_spans").to_pylist(), batch.column("_sections").to_pylist())):
                    spans[row] += [(s["start"], s["end"]) for s in old]
                    met[row].update(seen)
            spans = [[{"start": a, "end": b} for a, b in united(s)] for s in spans]
            made = [counts, spans, [sorted(m) for m in met]]
            yield with_columns(batch, {n: pa.array(v, k) for n, v, k in zip(names, made, arrow)})

    return docs.mapInArrow(run, T.StructType([*base.fields, *fields]))


def matched(docs: DataFrame, held: list[Broadcast], text: str = "text") -> DataFrame:
    """``docs`` with ``_n_words``, ``_spans`` and ``_sections`` over all blocks."""
    docs = docs.drop(*[f.name for f in T.StructType.fromDDL(MARKS).fields])
    for k, block in enumerate(held or [None]):
        if k and k % IN_A_PASS == 0:
            docs = stored(docs, "benchmark-pass")
        docs = marked(docs, block, text)
    return docs


def cut_text(text: str, spans: list[tuple[int, int]], n_words: int, cut_from: int = CUT_FROM, most_covered: int = MOST_COVERED) -> str | None:
    """The text without its long spans (in words); None if too much of it is hit."""
    if 100 * sum(b - a for a, b in spans) > most_covered * n_words:
        return None
    data = np.frombuffer(text.encode(), np.uint8)
    words = Words(Texts(data, np.array([0, len(data)])), IN_WORD)
    kept, at = [], 0
    for a, b in spans:
        if b - a >= cut_from:
            kept.append(data[at: words.starts[a]].tobytes())
            at = int(words.ends[b - 1])
    return b"".join([*kept, data[at:].tobytes()]).decode()


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", cut_from: int = CUT_FROM, most_covered: int = MOST_COVERED) -> DataFrame:
    """``docs`` without the documents that mostly consist of benchmark words, and with hit spans cut from the others."""
    held, _ = blocks(items, item, item_text)
    spanned = matched(docs, held, text)
    names = spanned.columns[:-3]  # the marks come last
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[(s["start"], s["end"]) for s in row] for row in batch.column("_spans").to_pylist()]
            old = batch.column(text).to_pylist()
            new = [cut_text(t, s, n, cut_from, most_covered) if s else t for t, s, n in zip(old, spans, batch.column("_n_words").to_pylist())]
            stay = pa.array([o is None or n is not None for o, n in zip(old, new)], pa.bool_())
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            columns[at] = pa.array(new, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(stay)

    return spanned.mapInArrow(run, spanned.select(*names).schema)


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) per row of ``docs``."""
    held, members = blocks(items, item, item_text)
    n_hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_hit")
    found = matched(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), held)
    found = stored(found.select(F.monotonically_increasing_id().alias("row"), "key", F.col("_n_words").alias("n_words"), n_hit, F.col("_sections").alias("sections")), "benchmark-found")
    met = found.where("n_hit > 0").select("row", F.explode("sections").alias("section")).join(members, "section")
    listed = met.groupBy("row").agg(F.collect_set(F.col("item").cast("string")).alias("items"))
    listed = listed.select("row", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"))
    return found.join(listed, "row", "left").select(
        F.col("key").alias(key), "n_words", "n_hit", F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {"op13_decontamination": op13_decontamination}

ORACLE = {"op13_decontamination": r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM items, LATERAL (SELECT unnest(range(1, greatest(len(w) - 8, 2))) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
cut AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS s FROM docs, sizes, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)),
met AS (SELECT DISTINCT doc_id, c.size, i, item_id FROM cut c JOIN windows v ON v.size = c.size AND v.s = c.s),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, size, i FROM met)) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(l.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(l.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h USING (doc_id) LEFT JOIN listed l USING (doc_id)
"""}
