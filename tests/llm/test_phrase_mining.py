"""Phrase mining: the parse counts each occurrence once, results against plain Python, long texts, odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapscope.llm import phrase_mining as P
from gapscope.llm.words import segment_hashes, short_hashes

DOCS = "lang string, text string"


def pieces(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for p in re.split("[.,;:!?\x0a-\x0d]", text) if (w := re.findall("[^ \t]+", p))]


def grams(docs):
    seen = {}
    for lang, text in docs:
        for w in pieces(text):
            for n in range(1, 5):
                seen.setdefault("und" if lang is None else lang, Counter()).update(" ".join(w[i: i + n]) for i in range(len(w) - n + 1))
    return seen


def brute(docs, top=P.TOP):
    out = []
    for lang, f in grams(docs).items():
        n = sum(c for p, c in f.items() if " " not in p)
        candidates = {p: a for p, a in f.items() if " " in p and a >= P.LEAST}
        rows = []
        for p, a in candidates.items():
            w = p.split(" ")
            score, _, l, r = min((2_000_000 * a // (f[" ".join(w[:k])] + f[" ".join(w[k:])]), k, f[" ".join(w[:k])], f[" ".join(w[k:])]) for k in range(1, len(w)))
            inside = any(100 * b >= 80 * a for q, b in candidates.items() if len(q.split(" ")) > len(w) and f" {p} " in f" {q} ")
            if not inside:
                rows.append((-score, -a, p.encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def run(spark, docs, top=P.TOP):
    return sorted(tuple(r) for r in P.collocations(spark.createDataFrame(docs, DOCS), top=top).collect())


def made_up(seed, n=400):
    made = random.Random(seed)
    lines = [" ".join(f"w{made.randrange(30)}" for _ in range(made.randrange(1, 40))) for _ in range(20)]
    word = lambda: made.choice(["the", "Of", "é x", f"w{made.randrange(30)}", f"rare{made.randrange(9999)}"])
    text = lambda: made.choice([". ", "\n", ", ", " ", "\t "]).join(made.choice([made.choice(lines), " ".join(word() for _ in range(made.randrange(8)))]) for _ in range(6))
    return [(made.choice(["en", "en", "de", None, ""]), text()) for _ in range(n)] + [("en", None), ("xx", " . "), (None, "")]


@pytest.mark.parametrize("seed", [0, 1])
def test_made_up_documents(spark, seed):
    docs = made_up(seed)
    assert run(spark, docs) == brute(docs)
    assert run(spark, docs, top=5) == brute(docs, top=5)


def test_every_occurrence_is_counted_once(spark):
    docs = made_up(5, 60) + [("en", "a b " * 700), ("en", " ".join(f"x{i % 97}" for i in range(3000)))] * 2
    parse = P.dictionary(spark.createDataFrame(docs, DOCS)).collect()
    assert sum(r.times for r in parse) > len(parse)  # chunks repeat
    got = {}
    for r in parse:
        w = r.chunk.split(" ")
        assert 0 < r.own <= len(w) <= r.own + P.OVERLAP and r.own <= P.MOST_OWN
        for i in range(r.own):
            for n in range(1, min(4, len(w) - i) + 1):
                got.setdefault(r.lang, Counter())[" ".join(w[i: i + n])] += r.times
    assert got == grams(docs)


def test_long_texts_in_pieces(spark, monkeypatch):
    made = random.Random(3)
    text = " ".join(made.choice(["one", "two", "three.", "four", "y" * 300]) for _ in range(3000))
    docs = [("en", text), ("en", " " * 2000 + text), ("en", "z" * 3000)]
    whole = run(spark, docs)
    assert whole == brute(docs)

    got = Counter()
    monkeypatch.setattr(P, "PIECE_BYTES", 700)
    import pyarrow as pa

    for b in P.chunks([pa.RecordBatch.from_arrays([pa.array([d[0] for d in docs]), pa.array([d[1] for d in docs])], names=["lang", "text"])]):
        for r in b.to_pylist():
            w = r["chunk"].split(" ")
            for i in range(r["own"]):
                for n in range(1, min(4, len(w) - i) + 1):
                    got[" ".join(w[i: i + n])] += r["times"]
    assert got == grams(docs)["en"]


def test_hashes_of_short_words():
    made = random.Random(4)
    words = list({bytes(made.randrange(1, 256) for _ in range(made.choice([1, 2, 7, 8, 9, 16, 17, 64, 65, 200]))) for _ in range(4000)})
    data = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    hashes = short_hashes(data, starts, ends)
    assert len(np.unique(hashes)) == len(words) == len(np.unique(segment_hashes(data, starts, ends)))
    for k in range(0, len(words), 97):  # the same wherever the word stands
        alone = np.frombuffer(b"__" + words[k] + b"tail", np.uint8)
        assert short_hashes(alone, np.array([2]), np.array([2 + len(words[k])]))[0] == hashes[k]


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("phrase", F.lit("clash")).withColumn("n", F.lit(1))
    assert sorted(tuple(r) for r in P.collocations(docs).collect()) == brute([(r.lang, r.text) for r in odd_docs.collect()])
    assert P.collocations(no_docs).count() == 0
