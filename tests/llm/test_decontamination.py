"""Decontamination: automaton and query against brute force, sections and blocks, spans cut from texts, odd rows."""

import random
import re
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from gapscope.llm import decontamination as D
from gapscope.llm.suffix_automaton import SuffixAutomaton

WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
ITEMS = "item_id long, text string"
DOCS = "doc_id long, text string"


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = WORD.findall(lower(t))
        n = min(len(w), 10)
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k: k + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, met = WORD.findall(lower(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                own = windows.get(tuple(w[k: k + n]))
                if own:
                    hit |= set(range(k, k + n))
                    met |= own - {None}
        out.append((d, len(w), len(hit), len(met), sha256(",".join(sorted(map(str, met))).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items):
    found = D.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    return sorted([tuple(r) for r in found.collect()], key=str)


def test_automaton_tracks_longest_factors():
    made = random.Random(2)
    for _ in range(60):
        words = made.randrange(1, 4)
        sequences = [[made.randrange(words) for _ in range(made.randrange(1, 15))] for _ in range(made.randrange(1, 5))]
        automaton = SuffixAutomaton(words)
        for s in sequences:
            automaton.add(s)
        factors = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a, len(s) + 1)}
        text = [made.randrange(words) for _ in range(40)]
        states = {}
        for k, (state, length) in enumerate(automaton.follow(text), 1):
            assert length == max(n for n in range(k + 1) if tuple(text[k - n: k]) in factors)
            for n in range(1, length + 1):  # one state for a factor, wherever it is met
                own = automaton.suffix_state(state, n)
                assert states.setdefault(tuple(text[k - n: k]), own) == own


def made_up(seed):
    made = random.Random(seed)
    word = lambda: f"w{made.randrange(12)}"
    items = [(made.choice([None, 1, 2, 3, 40]), " ".join(word() for _ in range(made.randrange(0, 30)))) for _ in range(25)] + [(9, "W1, w2!"), (10, None), (11, "--")]
    docs = []
    for d in range(60):
        parts = [made.choice([lambda: made.choice(items)[1] or "", lambda: " ".join(word() for _ in range(made.randrange(12)))])() for _ in range(5)]
        docs.append((d // 2, made.choice([" ", "\n- "]).join(parts).upper() if d % 3 else " ".join(parts)))
    return [*docs, (None, None), (None, "")], items


@pytest.mark.parametrize("seed", [0, 1])
def test_made_up_documents(spark, seed):
    docs, items = made_up(seed)
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, []) == brute(docs, [])


def test_small_sections_blocks_and_pieces(spark, monkeypatch):
    docs, items = made_up(3)
    docs = [*docs, (77, " ".join(t or "" for _, t in docs)), (78, "q" * 900 + " " + items[0][1] * 3)]
    monkeypatch.setattr(D, "SECTION", 13)
    monkeypatch.setattr(D, "BLOCK_WORDS", 40)
    monkeypatch.setattr(D, "IN_A_PASS", 2)
    held, _ = D.blocks(spark.createDataFrame(items, ITEMS), "item_id", "text")
    assert len(held) > 4
    assert run(spark, docs, items) == brute(docs, items)


def test_long_texts_are_read_in_overlapping_pieces(monkeypatch):
    from gapscope.llm.words import Texts, Words

    monkeypatch.setattr(D, "PIECE_BYTES", 200)
    text = " ".join(["x" * 333, *(f"word{i}" for i in range(400))])
    whole, at, got = WORD.findall(text), 0, []
    for part, again in D.pieces(Texts.of([text])):
        words = Words(part, D.IN_WORD)
        own = [bytes(part.data[a:b]).decode() for a, b in zip(words.starts, words.ends)]
        assert own == whole[at: at + len(own)]
        got += own[: len(own) - again]
        at += len(own) - again
    assert got == whole


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, "one"), (2, "a a a a a a a a a a a"), (3, "Émile \U0001F600 naïve")]
    frame = spark.createDataFrame(items, ITEMS)
    docs = odd_docs.withColumn("_spans", F.lit("clash")).withColumn("section", F.lit(1))
    got = sorted([tuple(r) for r in D.contamination(docs, frame).collect()], key=str)
    assert got == brute([(r.doc_id, r.text) for r in odd_docs.collect()], items)
    assert D.contamination(no_docs, frame).count() == 0


def test_cleaned_texts(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, f"Intro words that are clean, all of them and more here. {passage.title()}! The end of it is clean too."), (2, passage), (3, "clean"), (4, None)]
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, lang string")
    got = {r.doc_id: r.text for r in D.decontaminated(frame, spark.createDataFrame([(1, passage)], ITEMS)).collect()}
    assert got == {1: "Intro words that are clean, all of them and more here. ! The end of it is clean too.", 3: "clean", 4: None}
