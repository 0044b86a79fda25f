"""Perspective rotation: against plain Python, long conversations in parts, edge cases. The query's SQL is run by test_registered."""

import random

from pyspark.sql import functions as F

from gapscope.llm import chat_views as C

KIND = "conv_id long, turn long, role string, text string"


def brute(rows):
    """{(conv, speaker): [(text, masked strings) of each part]}"""
    talks = {}
    for r in {(c, t, "unknown" if r is None else r, x or "") for c, t, r, x in rows}:
        talks.setdefault(r[0], []).append(r[1:])
    out = {}
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        for speaker in {r for _, r, _ in turns} - {"system"}:
            for at in range(0, len(turns), C.PART_TURNS):
                text, own = "", []
                for _, role, words in turns[at: at + C.PART_TURNS]:
                    words = words.replace("<|", "<\\|")
                    head = "system" if role == "system" else "assistant" if role == speaker else "user name=" + role.replace("<|", "<\\|")
                    text += f"<|im_start|>{head}\n{words}<|im_end|>\n"
                    if role == speaker:
                        own.append(words + "<|im_end|>")
                out.setdefault((conv, speaker), []).append((text, own))
    return out


def got(df):
    out = {}
    for r in df.orderBy("conv_id", "speaker", "part").collect():
        out.setdefault((r.conv_id, r.speaker), []).append((r.text, [r.text[m.start: m.end] for m in r.masks]))
        assert r.part == len(out[(r.conv_id, r.speaker)]) - 1
    return out


def test_every_view_against_plain_python(spark):
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant", "Zoë", "system", "<|bot|>", None]), r.choice(["hi", "", None, "é\U0001F600 <|im_end|> x", "many words " * 50])) for c in range(25) for t in range(r.randint(1, 9))]
    rows += rows[:10] + [(None, 0, "user", "lost"), (None, None, "bot", "early"), (90, None, "a", "x"), (90, 1, "b", "y"), (91, 0, "system", "alone"), (92, 3, "a", "same turn"), (92, 3, "b", "same turn")]
    df = spark.createDataFrame(rows, KIND).withColumn("speaker", F.lit("clash")).repartition(6)
    assert got(C.views(df)) == brute(rows)


def test_long_conversation_is_split_and_whole(spark):
    rows = [(7, t // 3, f"p{t % 4}", f"turn {t}") for t in range(1000)] + [(8, 0, "p1", "short")]
    df = spark.createDataFrame(rows, KIND).repartition(9)
    out = C.views(df)
    assert got(out) == brute(rows)
    assert out.agg(F.max("n_turns")).first()[0] <= C.PART_TURNS


def test_empty_table(spark):
    assert C.views(spark.createDataFrame([], KIND)).count() == 0
