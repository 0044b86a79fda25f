"""Token counts: one dynamic program over a trie of the distinct pre-tokens.

Texts are cut where no piece reaches across (as in ``piece_stream``), so a
text's count is the sum of its pre-tokens' counts. The distinct pre-tokens
go into a trie. A node holds the forward score of the best segmentation of
its prefix and the number of ids on it, computed once, when the node is
made, from at most one piece length of its ancestors; all pre-tokens that
share the prefix share the work. The count at a pre-token's last node is its
token count. Nothing is segmented or listed.

Counting is per row: no shuffle. The trie lives as long as its task and is
begun anew beyond ``MOST_NODES`` nodes, which bounds memory and changes no
count.

Defined results: null and empty texts have 0 tokens; a character without a
piece counts its UTF-8 bytes; of equal paths the one whose last piece starts
earliest counts, as in encoding; repeated rows count alike; columns that
clash with the added ones are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gapscope.llm.common import read, with_columns
from gapscope.llm.pieces import SPACE, Vocabulary

MOST_NODES = 800_000
CODE_POINTS = 0x110000
#: Pre-tokens up to this length are remembered whole; longer ones are walked node by node and not kept.
LONGEST_KEPT = 64


class PrefixCounts:
    """Trie of pre-tokens with forward scores and counts; node 0 is the empty prefix."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.reversed: dict = {}  # pieces from their last character to their first
        for piece, (_, score) in vocabulary.pieces.items():
            node = self.reversed
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = score
        self.clear()

    def clear(self) -> None:
        self.children: dict[int, int] = {}  # node and code point, packed -> child
        self.parent, self.char = [-1], [""]
        self.score, self.tokens = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def count(self, pre_token: str) -> int:
        """Tokens of a pre-token, from its terminal node."""
        found = self.terminal.get(pre_token)
        if found is None:
            found = self.insert(pre_token) if len(pre_token) <= LONGEST_KEPT else self.walk(pre_token)
            if len(pre_token) <= LONGEST_KEPT:
                if len(self.score) > MOST_NODES:
                    self.clear()
                self.terminal[pre_token] = found
        return found

    def insert(self, pre_token: str) -> int:
        node, children = 0, self.children
        for c in pre_token.replace(" ", SPACE):
            child = children.get(node * CODE_POINTS + ord(c))
            node = self.extend(node, c) if child is None else child
        return self.tokens[node]

    def extend(self, node: int, c: str) -> int:
        """The child of ``node`` by ``c``: the best last piece, over the ancestors it can start at."""
        best, tokens = self.score[node] + self.vocabulary.unknown_score, self.tokens[node] + len(c.encode("utf-8", "surrogatepass"))
        at, match, first = node, self.reversed.get(c), True
        while match is not None:
            piece = match.get("")
            if piece is not None and (first or self.score[at] + piece >= best):
                best, tokens = self.score[at] + piece, self.tokens[at] + 1
            first = False
            if at == 0:
                break
            match = match.get(self.char[at])
            at = self.parent[at]
        new = len(self.score)
        self.children[node * CODE_POINTS + ord(c)] = new
        self.parent.append(node)
        self.char.append(c)
        self.score.append(best)
        self.tokens.append(tokens)
        return new

    def walk(self, pre_token: str) -> int:
        """The same program along one long path; only the last piece length of it is held."""
        longest = self.vocabulary.longest
        chars = pre_token.replace(" ", SPACE)
        score, tokens = [0.0], [0]  # of the last ``longest`` prefixes
        for i, c in enumerate(chars):
            best, count = score[-1] + self.vocabulary.unknown_score, tokens[-1] + len(c.encode("utf-8", "surrogatepass"))
            match = self.reversed.get(c)
            for back in range(1, len(score) + 1):
                if match is None:
                    break
                piece = match.get("")
                if piece is not None and (back == 1 or score[-back] + piece >= best):
                    best, count = score[-back] + piece, tokens[-back] + 1
                match = match.get(chars[i - back]) if i >= back else None
            score.append(best)
            tokens.append(count)
            if len(score) > longest:
                del score[0], tokens[0]
        return tokens[-1]


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ``n_pre_tokens`` and ``n_tokens``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = PrefixCounts(shared.value)
        for batch in batches:
            pre_tokens, tokens = [], []
            for value in batch.column(batch.schema.get_field_index(text)):
                seen = Counter(shared.value.segments(value.as_py() or ""))
                pre_tokens.append(sum(seen.values()))
                tokens.append(sum(prefixes.count(t) * n for t, n in seen.items()))
            yield with_columns(batch, {"n_pre_tokens": pa.array(np.array(pre_tokens, np.int64)), "n_tokens": pa.array(np.array(tokens, np.int64))})

    base = docs.select(*[c for c in docs.columns if c not in ("n_pre_tokens", "n_tokens")])
    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("n_pre_tokens", T.LongType()), T.StructField("n_tokens", T.LongType())]))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, Vocabulary.load()).select("doc_id", "n_pre_tokens", "n_tokens")


QUERIES = {"op6_token_counts": op6_token_counts}
