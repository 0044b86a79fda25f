"""SentencePiece encoding and decoding by a streaming Viterbi search.

The best segmentation is the path of pieces with the greatest sum of scores
(the model's own); a character without a piece costs more than any piece and
is spelled as bytes. The search reads a text once, from left to right. Only
positions within one piece length of the reading point can still be
extended, so the window holds ``longest piece + 1`` positions. Whenever the
back pointers of all of them meet at one boundary, everything before it is
final: its ids are emitted and forgotten. A place that no piece reaches
across is such a boundary by itself, so segments between them are searched
once and remembered (a bounded table per task).

Encoding and decoding are per row: no shuffle, no state across rows.

Defined results: a null text has null ids, and null ids decode to null; an
empty text has no ids; of equal paths the one whose last piece starts
earliest is taken. Decoding gives the text back, except that U+2581, the
model's sign for a space, comes back as a space. Repeated rows are encoded
alike; a column that clashes with the added one is replaced; an empty table
gives an empty table.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gapscope.llm.common import read, with_columns
from gapscope.llm.pieces import SPACE, Vocabulary, decoded

#: Segments remembered per task, and the longest of them.
REMEMBERED, LONGEST_REMEMBERED = 120_000, 48
#: Characters of texts whose segments are looked up together, and segments searched side by side.
CHARS, TOGETHER = 2_000_000, 20_000
#: Documents encoded or decoded before they are handed on.
ROWS = 512
#: Ids decoded together.
IDS_AT_ONCE = 500_000
#: Characters read between two looks for a common boundary.
LOOK = 32
#: The score of a position that no path reaches.
NEVER = float("-inf")


class Encoder:
    """Streaming Viterbi over a vocabulary; ``window`` is the most positions that were ever open at once."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}
        self.window = 0
        # by character: the nodes below, the id and score of the piece that ends there (id -1: none), the node's number
        self.trie: dict = {}
        nodes, edges = [(-1, 0.0)], {}
        kinds = {c: k for k, c in enumerate(sorted({c for piece in vocabulary.pieces for c in piece}), 1)}
        for piece, (own, worth) in vocabulary.pieces.items():
            below, at = self.trie, 0
            for c in piece:
                node = below.get(c)
                if node is None:
                    node = below[c] = [{}, -1, 0.0, len(nodes)]
                    edges[at * (len(kinds) + 1) + kinds[c]] = len(nodes)
                    nodes.append((-1, 0.0))
                below, at = node[0], node[3]
            node[1:3] = own, worth
            nodes[at] = own, worth
        # the same as arrays: kind of each code point (0: in no piece), edges by node and kind, and what ends at a node
        self.kind_of = np.zeros(0x110000, np.int32)
        self.kind_of[[ord(c) for c in kinds]] = list(kinds.values())
        self.kinds = len(kinds) + 1
        self.edge_keys = np.array(sorted(edges), np.int64)
        self.edge_to = np.array([edges[k] for k in self.edge_keys.tolist()], np.int64)
        self.first = np.zeros(self.kinds, np.int64)
        self.first[self.edge_keys[self.edge_keys < self.kinds]] = self.edge_to[self.edge_keys < self.kinds]
        self.own = np.array([own for own, _ in nodes], np.int32)
        self.worth = np.array([worth for _, worth in nodes], np.float64)

    def encode(self, text: str) -> bytes:
        """The ids as int32 bytes."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as int32 bytes; texts are taken together up to ``CHARS`` characters."""
        out: list[bytes] = []
        while len(out) < len(texts):
            cut, size = [], 0
            for text in texts[len(out):]:
                cut.append(self.vocabulary.segments(text))
                size += len(text)
                if size >= CHARS:
                    break
            known = self.known
            new = [s for s in {s for segments in cut for s in segments} if s not in known]
            short = sorted((s for s in new if len(s) <= self.vocabulary.longest), key=len)
            for at in range(0, len(short), TOGETHER):
                self.within(short[at: at + TOGETHER])
            for s in new:
                if len(s) > self.vocabulary.longest:
                    known[s] = array("i", [i for part in self.stream(s.replace(" ", SPACE)) for i in part]).tobytes()
            out += [b"".join([known[s] for s in segments]) for segments in cut]
            if len(known) > REMEMBERED:
                self.known = {}
            else:
                for s in new:
                    if len(s) > LONGEST_REMEMBERED:
                        del known[s]
        return out

    def within(self, segments: list[str]) -> None:
        """Remembers the ids of segments, none longer than the longest piece.

        The window holds such a segment whole, and its end is the boundary
        where all paths meet, so many are searched side by side: the same
        steps in the same order as ``stream``.
        """
        sizes = np.array([len(s) for s in segments])
        longest, n = int(sizes.max()), len(segments)
        text = "".join([s.replace(" ", SPACE).ljust(longest, "\0") for s in segments])
        kinds = self.kind_of[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, longest)]
        score = np.full((longest + 1, n), NEVER)
        score[0] = 0.0
        begins, piece = np.zeros((longest + 1, n), np.int32), np.full((longest + 1, n), -1, np.int32)
        for i in range(longest):
            rows = np.flatnonzero(sizes > i)
            here = score[i, rows]
            node, spelled = self.first[kinds[rows, i]], np.ones(len(rows), bool)
            on = np.flatnonzero(node)
            for j in range(i + 1, longest + 1):
                at = node[on]
                ends = self.own[at] >= 0
                if j == i + 1:
                    spelled[on[ends]] = False
                who, total = rows[on[ends]], here[on[ends]] + self.worth[at[ends]]
                better = total > score[j, who]
                who = who[better]
                score[j, who], begins[j, who], piece[j, who] = total[better], i, self.own[at[ends][better]]
                on = on[sizes[rows[on]] > j]
                if not len(on):
                    break
                key = node[on] * self.kinds + kinds[rows[on], j]
                edge = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
                hit = self.edge_keys[edge] == key
                on = on[hit]
                node[on] = self.edge_to[edge[hit]]
            total = here[spelled] + self.vocabulary.unknown_score
            who = rows[spelled]
            better = total > score[i + 1, who]
            who = who[better]
            score[i + 1, who], begins[i + 1, who], piece[i + 1, who] = total[better], i, -1
        self.window = max(self.window, longest)
        # back from the ends, all paths at once; a path with a character spelled as bytes is read by itself
        ids, place, odd = np.empty((longest, n), np.int32), sizes.copy(), np.zeros(n, bool)
        counts = np.zeros(n, np.int64)
        while len(rows := np.flatnonzero(place)):
            found = piece[place[rows], rows]
            odd[rows[found < 0]] = True
            counts[rows] += 1
            ids[longest - counts[rows], rows] = found
            place[rows] = begins[place[rows], rows]
        data = np.ascontiguousarray(ids.T)
        for k, s in enumerate(segments):
            if odd[k]:
                parts = self.path(s.replace(" ", SPACE), begins[:, k].tolist(), piece[:, k].tolist(), 0, len(s))
                self.known[s] = array("i", parts).tobytes()
        starts = ((np.arange(n) + 1) * longest - counts) * 4
        whole = data.tobytes()
        plain = np.flatnonzero(~odd)
        for k, a, b in zip(plain.tolist(), starts[plain].tolist(), ((plain + 1) * longest * 4).tolist()):
            self.known[segments[k]] = whole[a:b]

    def stream(self, chars: str) -> Iterator[list[int]]:
        """Ids of the best path, part by part, as soon as no later character can change them."""
        trie, unknown, longest = self.trie, self.vocabulary.unknown_score, self.vocabulary.longest
        start, size = 0, len(chars)
        # by position, from ``start`` on: the best score, where its last piece starts, that piece's id or -1
        score, begins, piece = [0.0], [0], [-1]
        for block in range(0, size, LOOK):
            to = min(block + LOOK, size)
            more = min(to + longest, size) - start + 1 - len(score)
            score += [NEVER] * more
            begins += [0] * more
            piece += [-1] * more
            for i in range(block, to):
                here = score[i - start]
                below, j, single = trie, i, False
                while j < size and (node := below.get(chars[j])) is not None:
                    j += 1
                    below, found, worth, _ = node
                    if found >= 0:
                        single = single or j == i + 1
                        total = here + worth
                        if total > score[j - start]:
                            score[j - start] = total
                            begins[j - start] = i
                            piece[j - start] = found
                if not single:
                    total = here + unknown
                    if total > score[i + 1 - start]:
                        score[i + 1 - start] = total
                        begins[i + 1 - start] = i
                        piece[i + 1 - start] = -1
            if to < size:
                still_open = [p for p in range(to, start + len(score)) if score[p - start] > NEVER]
                self.window = max(self.window, len(still_open))
                meeting = self.meeting(still_open, begins, start)
                if meeting > start:
                    yield self.path(chars, begins, piece, start, meeting)
                    base = score[meeting - start] if meeting >= to else 0.0
                    score, begins, piece = ([s - base for s in score[meeting - start:]], begins[meeting - start:], piece[meeting - start:])
                    start = meeting
        yield self.path(chars, begins, piece, start, size)

    @staticmethod
    def meeting(positions: list[int], begins: list[int], start: int) -> int:
        """The last boundary that the paths of all open positions share."""
        shared = Encoder.boundaries(positions[0], begins, start)
        for p in positions[1:]:
            own = set(Encoder.boundaries(p, begins, start))
            shared = [b for b in shared if b in own]
        return max(shared)

    @staticmethod
    def boundaries(position: int, begins: list[int], start: int) -> list[int]:
        out = [position]
        while position > start:
            position = begins[position - start]
            out.append(position)
        return out

    def path(self, chars: str, begins: list[int], piece: list[int], start: int, end: int) -> list[int]:
        """Ids from ``start`` to ``end``; ``begins`` and ``piece`` count from ``start``."""
        parts, first = [], start
        while end > first:
            begin, found = begins[end - first], piece[end - first]
            if found >= 0:
                parts.append(found)
            else:
                parts += reversed(self.vocabulary.fallback(chars[begin]))
            end = begin
        parts.reverse()
        return parts


def list_array(flat: np.ndarray, counts: list[int], valid: np.ndarray | None = None) -> pa.Array:
    """list<int> of consecutive runs; rows that are not ``valid`` are null."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.array(counts, np.int64))]).astype(np.int32), pa.int32())
    mask = None if valid is None else pa.array(~valid)
    return pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()), mask=mask)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of ``ROWS`` rows, handed on one by one."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)
        pa.default_memory_pool().release_unused()


def encoded(encoder: Encoder, texts: pa.Array) -> pa.Array:
    """The ids of each text; null for a null."""
    coded = encoder.encode_all([t or "" for t in texts.to_pylist()])
    return list_array(np.frombuffer(b"".join(coded), np.int32), [len(c) // 4 for c in coded], np.asarray(texts.is_valid(), bool))


def spelled(vocabulary: Vocabulary, ids: pa.Array) -> pa.Array:
    """The text of each list of ids; null for a null."""
    offsets = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(ids).fill_null(0).to_numpy())]).astype(np.int64)
    flat, at, parts = np.asarray(ids.flatten()), 0, []
    while at < len(ids):  # some rows at a time, as the decoder's work arrays are wider than its texts
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + IDS_AT_ONCE, "right")) - 1)
        parts.append(decoded(vocabulary, flat[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at]))
        at = to
    texts = pa.concat_arrays(parts) if parts else pa.array([], pa.string())
    return pa.compute.if_else(ids.is_null(), pa.scalar(None, pa.string()), texts)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids``: array<int>."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in sliced(batches):
            yield with_columns(batch, {ids: encoded(encoder, batch.column(batch.schema.get_field_index(text)))})

    base = docs.select(*[c for c in docs.columns if c != ids])
    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(coded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``coded`` with ``text``: the string that the ids spell."""
    shared = coded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield with_columns(batch, {text: spelled(shared.value, batch.column(batch.schema.get_field_index(ids)))})

    base = coded.select(*[c for c in coded.columns if c != text])
    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(text, T.StringType())]))


def encoded_corpus(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding gives the text back (spaces for U+2581).

    Both ways in one pass, so the decoded text never leaves the task.
    """
    vocabulary = Vocabulary.load(path)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in sliced(batches):
            texts = batch.column(1)
            ids = encoded(encoder, texts)
            back = pa.array([t == (None if own is None else own.replace(SPACE, " ")) for t, own in zip(spelled(shared.value, ids).to_pylist(), texts.to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.compute.list_value_length(ids).fill_null(0).cast(pa.int64()), ids, back], names=["doc_id", "n_tokens", "ids", "round_trip"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>, round_trip boolean")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_corpus(read(spark, sf_dir, "documents"))


QUERIES = {"op4_sentencepiece": op4_sentencepiece}
