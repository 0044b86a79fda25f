"""SentencePiece encoding, decoding and token counts: brute-force best paths, exact round trips, edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapscope.llm import piece_stream as P
from gapscope.llm import token_counts as C
from gapscope.llm.pieces import SPACE, Vocabulary, decoded

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load()


def small(pieces):
    """A vocabulary of the given pieces and scores, with byte pieces behind them."""
    names = list(pieces)
    spelled = [p.replace(SPACE, " ").encode() for p in names] + [bytes([b]) for b in range(256)]
    return Vocabulary.of({p: (i, s) for i, (p, s) in enumerate(pieces.items())}, list(range(len(names), len(names) + 256)), spelled)


def brute(v, text):
    """Ids of the best path over the whole text at once; of equal ones the one whose last piece starts earliest."""
    if not text:
        return []
    s = SPACE + text.replace(" ", SPACE)
    best = [(0.0, [])] + [None] * len(s)
    for j in range(1, len(s) + 1):
        for i in range(max(0, j - v.longest), j):
            found = v.pieces.get(s[i:j])
            if found is None and j - i == 1:
                found = (None, v.unknown_score)
            if found is not None and (best[j] is None or best[i][0] + found[1] > best[j][0]):
                ids = v.fallback(s[i]) if found[0] is None else [found[0]]
                best[j] = (best[i][0] + found[1], best[i][1] + ids)
    return best[-1][1]


TEXTS = ["The and attion to thanedble the, anea.\nÉeau über 日本語 ☃  x", " lead and trail ", "a", "   ", "x" * 300, "abc\x00\x85\r\n\ttab", "1234 5.67%%%\n\n\nend", "\U0001F600 é"]


def ids_of(v, text):
    return np.frombuffer(P.Encoder(v).encode(text), np.int32).tolist()


def test_ids_equal_brute_force(vocabulary):
    for t in TEXTS:
        assert ids_of(vocabulary, t) == brute(vocabulary, t), t


def test_ids_equal_brute_force_on_made_up_vocabularies():
    rng = random.Random(4)
    for _ in range(40):
        v = small({"".join(rng.choice("ab" + SPACE) for _ in range(rng.randint(1, 5))): -float(rng.randint(1, 9)) for _ in range(rng.randint(2, 20))})
        for _ in range(10):
            t = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 150)))
            assert ids_of(v, t) == brute(v, t)


def test_window_is_bounded_and_ids_come_early(vocabulary):
    encoder = P.Encoder(vocabulary)
    parts = list(encoder.stream("thereofand" * 2000))
    assert encoder.window <= vocabulary.longest + 1
    assert len(parts) > 100 and max(map(len, parts)) < 200


def test_decoding_gives_texts_back(vocabulary):
    coded = [ids_of(vocabulary, t) for t in TEXTS]
    flat = np.array([i for c in coded for i in c], np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded])])
    assert decoded(vocabulary, flat, offsets).to_pylist() == TEXTS


def test_segments_are_never_crossed_by_a_piece(vocabulary):
    for t in TEXTS:
        cut = vocabulary.segments(t)
        assert "".join(cut) == " " + t
        joins = {(a[-1].replace(" ", SPACE), b[0].replace(" ", SPACE)) for a, b in zip(cut, cut[1:])}
        assert not [p for p in vocabulary.pieces for x, y in joins if x + y in p]


def test_query_round_trips_and_counts_agree(spark):
    rows = P.op4_sentencepiece(spark, SF).collect()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    counts = {r.doc_id: r.n_tokens for r in C.op6_token_counts(spark, SF).collect()}
    assert counts == {r.doc_id: r.n_tokens for r in rows}


def test_counts_equal_ids_on_odd_texts_and_after_clearing(vocabulary, monkeypatch):
    monkeypatch.setattr(C, "MOST_NODES", 20)
    prefixes = C.PrefixCounts(vocabulary)
    for t in TEXTS * 2:
        assert sum(prefixes.count(s) for s in vocabulary.segments(t)) == len(brute(vocabulary, t))


def test_odd_rows_and_empty_table(odd_docs, no_docs, vocabulary, monkeypatch):
    monkeypatch.setattr(P, "IDS_AT_ONCE", 7)
    docs = odd_docs.withColumn("ids", F.lit("clash")).withColumn("n_tokens", F.lit("clash"))
    both = P.decode(P.encode(docs, vocabulary), vocabulary).collect()
    assert [r.decoded for r in both] == [r.text for r in odd_docs.collect()]
    assert all((r.ids is None) == (r.text is None) for r in both)
    counted = {(r.doc_id, r.text): r.n_tokens for r in C.count_tokens(docs, vocabulary).collect()}
    assert counted == {(r.doc_id, r.text): len(r.ids or []) for r in both}
    assert P.encode(no_docs, vocabulary).count() == 0 and C.count_tokens(no_docs, vocabulary).count() == 0
