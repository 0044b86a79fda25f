"""The pipeline: every stage on its own input against plain Python; it and the registered SQL from end to end."""

import collections
import importlib.util
import ast
import os

import pytest

SF = "/root/testdata/sf0.001"
needs_pipeline = pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="corpus_pipeline.py is not there")


@needs_pipeline
def test_stages_one_by_one(spark):
    import corpus_pipeline as P
    from .test_jaccard_join import brute as components
    from .test_mixing import WORD, targets
    from .test_quality_rules import brute as counts
    from .test_secrets import brute as spans

    from gapscope.llm.common import stored

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(P.STAGES)
    before = {r.doc_id: r for r in docs.collect()}

    good = stored(steps["quality_rules"](spark, docs, SF), "t")
    assert good.columns == docs.columns
    kept = {r.doc_id: r for r in good.collect()}
    assert all(before[k] == r and not counts(r.text)[-1] for k, r in kept.items())
    assert len(kept) > 0.7 * sum(not counts(r.text)[-1] for r in before.values())

    single = stored(steps["jaccard_join"](spark, good, SF), "t")
    ids = {r.doc_id for r in single.collect()}
    assert single.columns == docs.columns and single.count() == len(ids)
    assert ids == {c for _, _, c in components([(k, r.text) for k, r in kept.items()])}

    masked = stored(steps["secrets"](spark, single, SF), "t")
    texts = {r.doc_id: r for r in masked.collect()}
    assert masked.columns == docs.columns and texts.keys() == ids
    for k, r in texts.items():
        assert r.n_chars == len(r.text) and not [s for s in spans(r.text) if s[0] != "assign"]
        assert r.text == before[k].text or "[SECRET]" in r.text

    mixed = stored(steps["mixing"](spark, masked, SF), "t")
    assert mixed.columns == docs.columns
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    sizes, taken, most = collections.Counter(), collections.Counter(), collections.Counter()
    for k, r in texts.items():
        n = len(WORD.findall(r.text))
        sizes[r.source] += n
        taken[r.source] += n * copies[k]
        most[r.source] = max(most[r.source], n)
    want = targets(sizes)
    assert max(copies.values()) <= 2 and all(abs(taken[s] - want[s]) <= most[s] for s in sizes)

    coded = steps["sentencepiece"](spark, mixed, SF).collect()
    assert collections.Counter(r.doc_id for r in coded) == copies and all(r.round_trip for r in coded)


@needs_pipeline
def test_run_and_empty_tables(spark, tmp_path):
    import corpus_pipeline as P

    rows = P.run(spark, SF).collect()
    assert rows and all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").where("false").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_registered_queries_and_sql(spark):
    import duckdb
    from gapscope.llm.registry import ORACLE, QUERIES

    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, SF)
        want = con.execute(sql)
        at = [[d[0] for d in want.description].index(c) for c in df.columns]
        assert sorted(map(tuple, df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str), name


def imported(path: str) -> set[str]:
    """Names of the modules that a file imports, and of what it takes from them."""
    with open(path) as source:
        tree = ast.parse(source.read())
    names = set()
    for node in ast.walk(tree):
        if isinstance(node, ast.Import):
            names |= {a.name for a in node.names}
        elif isinstance(node, ast.ImportFrom):
            names |= {f"{node.module or ''}.{a.name}" for a in node.names}
    return names


def test_nothing_else_imports_the_subpackage():
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    own = {os.path.join(top, p) for p in ("gapscope/llm", "tests/llm", "__spark_entry__.py", "corpus_pipeline.py")}
    seen = 0
    for folder, _, files in os.walk(top):
        for path in (os.path.join(folder, f) for f in files if f.endswith(".py")):
            if not any(path == o or path.startswith(o + os.sep) for o in own):
                seen += 1
                assert not [n for n in imported(path) if "llm" in n.split(".") or "corpus_pipeline" in n.split(".")], path
    assert seen > 30
