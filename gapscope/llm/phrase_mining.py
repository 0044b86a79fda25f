"""Phrase collocation mining over a prefix-free parse of the corpus.

Texts are split at punctuation and line ends into pieces of words. A piece is
parsed into chunks: a chunk ends where the hash of a window of ``OVERLAP``
words is a trigger, and the next one begins with that same window, so
neighbours overlap by it and equal passages give equal chunks wherever they
stand. Each distinct chunk of a language is kept once, with how often it
occurs. All counting is done on this dictionary, an occurrence weighted with
its chunk's frequency; a phrase that begins in the overlap belongs to the
later chunk alone, so it counts once.

Phrases grow word by word. One of ``n`` words can only be frequent if the
``n - 1`` words it begins with, and those it ends with, are; a bit filter of the
frequent shorter phrases (``FILTER_BITS``, whatever the corpus) keeps most
rare ones from being counted at all. The filter errs only towards counting,
and counts are by the phrase itself, so they are exact. Phrases found rare in
the end are below ``LEAST`` and take no part.

Scale: one shuffle of distinct chunks, one of counted phrases per length,
both combined in the tasks first, so a line or word that makes up a third of
the corpus is one row per task. Long texts are parsed in pieces of
``PIECE_BYTES``. Joins of phrases with their parts are between counted phrases only; parts
shared by many are left to the skew join. Tables read again go to the scratch folder.

Defined results: null texts are empty; a null language is ``und``; texts
without words add nothing; repeated rows count again; languages without
frequent phrases have no row; an empty table gives an empty table; other
columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapscope.llm.common import read, stored
from gapscope.llm.words import LOWER, Texts, mix64, segment_hashes, short_hashes

#: Words of the longest phrase, and the least count of a candidate.
LONGEST, LEAST = 4, 30
#: A longer candidate with this share (percent) of a phrase's count replaces it.
INSIDE_PERCENT = 80
SCALE, TOP = 2_000_000, 2000
#: Words of a trigger window; one window in so many is a trigger; a chunk begins at most so many words apart.
OVERLAP, TRIGGER_ONE_IN, MOST_OWN = LONGEST - 1, 16, 256
FILTER_BITS = 26
#: Bytes of text handled at a time.
PIECE_BYTES = 4 << 20

_BREAKS = np.zeros(256, bool)
_BREAKS[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
#: Odd factors of the words of a window or phrase.
_SEEDS = mix64(np.arange(1, LONGEST + 1, dtype=np.uint64)) | np.uint64(1)


# --- parse ----------------------------------------------------------------------


class Parsed:
    """Words of consecutive lower-cased texts, joined by one space, and which piece each is in."""

    def __init__(self, texts: Texts):
        data = LOWER[texts.data]
        breaks = _BREAKS[data]
        inside = ~(breaks | _BLANK[data])
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        inner = texts.offsets[(texts.offsets > 0) & (texts.offsets < len(data))]
        first[inner] |= inside[inner]
        last[inner - 1] |= inside[inner - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.row = np.searchsorted(texts.offsets, starts, "right") - 1
        self.piece = np.cumsum(breaks)[starts] + self.row
        self.raw_starts = starts
        # words moved together, with a space behind each
        sizes = ends - starts
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        self.ends = self.starts + sizes
        self.data = np.full(int(self.ends[-1]) + 1 if len(starts) else 0, 0x20, np.uint8)
        places = np.ones(len(self.data), bool)
        places[self.ends] = False
        self.data[places] = data[inside]

    def cuts(self) -> np.ndarray:
        """Flags of the words that begin a chunk."""
        n = len(self.starts)
        begins = np.ones(n, bool)
        if n <= OVERLAP:
            begins[1:] = self.piece[1:] != self.piece[:-1]
            return begins
        begins[1:] = self.piece[1:] != self.piece[:-1]
        hashes = short_hashes(self.data, self.starts, self.ends)
        window = sum(hashes[k: n - OVERLAP + 1 + k] * _SEEDS[k] for k in range(OVERLAP))
        begins[: n - OVERLAP + 1] |= (self.piece[: n - OVERLAP + 1] == self.piece[OVERLAP - 1:]) & (window >> np.uint64(40) < np.uint64((1 << 24) // TRIGGER_ONE_IN))
        # words that neither end a piece nor hold a trigger for long
        gap = np.diff(np.append(np.flatnonzero(begins), n))
        for a, size in zip(np.flatnonzero(begins)[gap > MOST_OWN].tolist(), gap[gap > MOST_OWN].tolist()):
            begins[a: a + size: MOST_OWN] = True
        return begins


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """``data[start:end]`` of each pair as strings; they may overlap."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    place = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[place]))])


def spaced(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """``data`` between consecutive edges as strings, not copied."""
    return pa.Array.from_buffers(pa.large_string(), len(edges) - 1, [None, pa.py_buffer(np.ascontiguousarray(edges, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def combined(lang: pa.Array, row: np.ndarray, text: pa.Array, number: np.ndarray, times: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """Sums of ``times`` per different (language of the row, text, number)."""
    langs, texts = lang.dictionary_encode(), text.dictionary_encode()
    key = (number * len(langs.dictionary) + langs.indices.to_numpy()[row]) * max(len(texts.dictionary), 1) + texts.indices.to_numpy()
    found = pa.table({"key": key, "times": times}).group_by("key", use_threads=False).aggregate([("times", "sum")]).combine_chunks()
    key, code = np.divmod(found.column("key").to_numpy(), max(len(texts.dictionary), 1))
    number, at = np.divmod(key, max(len(langs.dictionary), 1))
    texts = texts.dictionary.take(pa.array(code)).cast(pa.string())
    return pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(at)), texts, pa.array(number), found.column("times_sum").combine_chunks()], names=names)


def bounded(texts: Texts) -> Iterator[tuple[Texts, bool]]:
    """(texts, goes on?): whole texts, or pieces of a long one; the next piece begins in the last word but ``OVERLAP``."""
    if len(texts) > 1 or len(texts.data) <= PIECE_BYTES:
        yield texts, False
        return
    at, size = 0, PIECE_BYTES
    while at + size < len(texts.data):
        part = Texts(texts.data[at: at + size], np.array([0, size]))
        starts = Parsed(part).raw_starts
        if len(starts) <= LONGEST:
            size = size * 2 if len(starts) else size
            at += 0 if len(starts) else size
            continue
        yield Texts(part.data[: starts[-1]], np.array([0, starts[-1]])), True
        at, size = at + int(starts[-1 - OVERLAP]), PIECE_BYTES
    yield Texts(texts.data[at:], np.array([0, len(texts.data) - at])), False


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, chunk, own, times): distinct chunks of some rows, their number of own words and of occurrences."""
    for batch in batches:
        at = 0
        for texts in Texts.chunks(batch.column(1), PIECE_BYTES):
            lang = batch.column(0).slice(at, len(texts))
            at += len(texts)
            for part, goes_on in bounded(texts):
                parsed = Parsed(part)
                begins = parsed.cuts()
                n = len(begins)
                owned = n - OVERLAP if goes_on else n  # the next part begins with the rest
                begin = np.flatnonzero(begins[:owned])
                if not len(begin):
                    continue
                end = np.append(begin[1:], owned)
                # up to OVERLAP words of the same piece follow
                reach = np.minimum(end + OVERLAP, n)
                piece_end = np.searchsorted(parsed.piece, parsed.piece[begin], "right")
                reach = np.minimum(reach, piece_end)
                # without such words a chunk is all that stands before the next one
                alone = reach == end
                stop = parsed.starts[owned] if owned < n else len(parsed.data)
                text = pc.ascii_rtrim(spaced(parsed.data, np.append(parsed.starts[begin], stop)).filter(pa.array(alone)), " ")
                with_more = strings(parsed.data, parsed.starts[begin[~alone]], parsed.ends[reach[~alone] - 1])
                order = np.concatenate([np.flatnonzero(alone), np.flatnonzero(~alone)])
                text = pa.chunked_array([text, with_more]).combine_chunks()
                yield combined(lang, parsed.row[begin[order]], text, (end - begin)[order], np.ones(len(order), np.int64), ["lang", "chunk", "own", "times"])


def dictionary(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, chunk, own, times): the parse's distinct chunks with their frequencies."""
    named = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.col(text).alias("text"))
    found = named.mapInArrow(chunks, "lang string, chunk string, own long, times long")
    return found.groupBy("lang", "chunk", "own").agg(F.sum("times").alias("times"))


# --- counts ---------------------------------------------------------------------


def phrase_keys(langs: pa.Array, rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Places in the filter of the phrases of ``n`` words that begin at each word but the last ``n - 1``."""
    coded = langs.dictionary_encode()
    names = Texts.of([x.as_py() for x in coded.dictionary])
    filled = np.diff(names.offsets) > 0
    seeds = np.zeros(len(names), np.uint64)
    if filled.any():
        seeds[filled] = segment_hashes(names.data, names.offsets[:-1][filled], names.offsets[1:][filled])
    many = max(len(hashes) - n + 1, 0)
    value = sum(hashes[k: k + many] * _SEEDS[k] for k in range(n)) ^ seeds[coded.indices.to_numpy()][rows[:many]]
    return ((value ^ (value >> np.uint64(31))) * _SEEDS[0]) >> np.uint64(64 - FILTER_BITS)


def filter_of(frequent: DataFrame) -> np.ndarray:
    """Bits of the phrases of ``frequent`` (lang, phrase): at most ``2 ** FILTER_BITS`` of them, by words of 64."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = Rows(batch.column(1))
            key = phrase_keys(batch.column(0), parsed.row, parsed.hashes, int(parsed.counts[0]))[parsed.bounds[:-1]] if batch.num_rows else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((key >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (key & np.uint64(63))).view(np.int64))], names=["word", "bit"])

    rows = frequent.mapInArrow(places, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


class Rows:
    """Words of rows that hold words joined by single spaces."""

    def __init__(self, column: pa.Array):
        texts = next(Texts.chunks(column, 1 << 62), Texts(np.empty(0, np.uint8), np.zeros(1, np.int64)))
        data, offsets = texts.data, texts.offsets
        space = data == 0x20
        first = np.zeros(len(data), bool)
        first[1:] = space[:-1]
        first[offsets[:-1]] = True
        # a row's last word ends where the next row begins, a space does not belong to the word behind it
        self.starts = np.flatnonzero(first)
        self.ends = np.append(self.starts[1:], len(data))
        self.ends = self.ends - space[self.ends - 1]
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)
        self.row = np.repeat(np.arange(len(texts)), self.counts)
        self.data = data
        self.hashes = short_hashes(data, self.starts, self.ends)


def phrases(parse: DataFrame, n: int, shorter: Broadcast | None) -> DataFrame:
    """(lang, phrase, a): the phrases of ``n`` words with ``LEAST`` occurrences or more."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            rows = Rows(batch.column(1))
            own = batch.column(2).to_numpy()
            # an own word begins a phrase if so many words are left in its row
            left = np.minimum(own, np.maximum(rows.counts - n + 1, 0))
            begins = np.arange(len(rows.starts)) < np.repeat(rows.bounds[:-1] + left, rows.counts)
            if shorter:
                key = phrase_keys(batch.column(0), rows.row, rows.hashes, n - 1)
                known = (shorter.value[key >> np.uint64(6)] >> (key & np.uint64(63))) & np.uint64(1) > 0
                begins[: len(known) - 1] &= known[:-1] & known[1:]
            at = np.flatnonzero(begins)
            text = strings(rows.data, rows.starts[at], rows.ends[at + n - 1]) if n > 1 else pc.ascii_rtrim(spaced(rows.data, np.append(rows.starts, len(rows.data))).filter(pa.array(begins)), " ")
            row = rows.row[at]
            found = combined(batch.column(0), row, text, np.zeros(len(at), np.int64), batch.column(3).to_numpy()[row], ["lang", "phrase", "", "times"])
            yield found.select(["lang", "phrase", "times"])

    found = parse.mapInArrow(count, "lang string, phrase string, times long")
    return found.groupBy("lang", "phrase").agg(F.sum("times").alias("a")).where(F.col("a") >= LEAST)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together up to ``PIECE_BYTES``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= PIECE_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def frequent_phrases(parse: DataFrame) -> DataFrame:
    """(lang, size, phrase, a) of all frequent phrases of up to ``LONGEST`` words."""
    sc = parse.sparkSession.sparkContext
    found, shorter = None, None
    for n in range(1, LONGEST + 1):
        now = stored(phrases(parse, n, shorter), f"phrases-{n}")
        shorter = sc.broadcast(filter_of(now)) if n < LONGEST else None
        now = now.select("lang", F.lit(n).alias("size"), "phrase", "a")
        found = now if found is None else found.unionByName(now)
    return found


# --- collocations ---------------------------------------------------------------


def part(words, first: int, size: int):
    return F.array_join(F.slice(words, first, size), " ")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    parse = stored(dictionary(docs, lang, text), "phrase-chunks")
    totals = parse.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n"))
    counted = frequent_phrases(parse)
    candidates = counted.where("size > 1").withColumn("words", F.split("phrase", " "))
    # every cut of every candidate, with the counts of its parts
    cuts = candidates.select(
        "lang", "phrase", "a", F.posexplode(F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
            part(F.col("words"), 1, k).alias("first"), part(F.col("words"), k + 1, F.col("size") - k).alias("rest")))).alias("k", "cut"))
    of = counted.select(F.col("lang").alias("pl"), F.col("phrase").alias("part"), F.col("a").alias("count"))
    left = cuts.join(of, (F.col("lang") == F.col("pl")) & (F.col("cut.first") == F.col("part"))).withColumn("l", F.col("count")).drop("pl", "part", "count")
    both = left.join(of, (F.col("lang") == F.col("pl")) & (F.col("cut.rest") == F.col("part"))).withColumn("r", F.col("count"))
    score = F.expr(f"cast(cast({SCALE} as decimal(38, 0)) * a div (cast(l as decimal(38, 0)) + r) as bigint)")
    scored = both.withColumn("score", score).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("least"))
    # phrases that a longer candidate stands for
    longer = candidates.where("size > 2").select("lang", "a", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("size") - k + 1), lambda i: part(F.col("words"), i, k))))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    stay = scored.join(longer, ["lang", "phrase"], "left").where(f"most is null or cast(100 as decimal(38, 0)) * most < {INSIDE_PERCENT} * cast(a as decimal(38, 0))")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = stay.select("lang", "phrase", "a", "least.l", "least.r", "least.score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


QUERIES = {"op11_phrase_mining": op11_phrase_mining}

ORACLE = {"op11_phrase_mining": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
listed AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM listed GROUP BY lang),
grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM listed, (SELECT unnest([1, 2, 3, 4]) AS size), LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)),
counted AS (SELECT lang, size, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 30),
candidates AS (SELECT * FROM counted WHERE size > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(l.a AS HUGEINT) + r.a) AS BIGINT) AS score
  FROM candidates c, LATERAL (SELECT unnest(range(1, c.size)) AS k)
  JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:k], ' ')
  JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT c.lang, array_to_string(c.w[i:i + t.size - 1], ' ') AS phrase, max(c.a) AS most
  FROM candidates c, LATERAL (SELECT unnest(range(2, c.size)) AS size) t, LATERAL (SELECT unnest(range(1, c.size - t.size + 2)) AS i) GROUP BY ALL),
stay AS (
  SELECT s.* FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase WHERE i.most IS NULL OR 100 * CAST(i.most AS HUGEINT) < 80 * CAST(s.a AS HUGEINT)),
best AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM stay)
SELECT b.lang, b.rank, b.phrase, b.a, b.l, b.r, CAST(t.n AS BIGINT) AS n, b.score FROM best b JOIN totals t ON t.lang = b.lang WHERE b.rank <= 2000
"""}
