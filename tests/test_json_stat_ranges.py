"""One document read by many tasks gives what the whole parse gives."""

import json
import os
import random
from contextlib import contextmanager

import pytest

from conftest import rows
from gapscope import operators as op
from gapscope.operators.json_stat_ranges import marking_pieces
from gapscope.sources import read_json_stat_documents, read_json_stat_ranges


@contextmanager
def ranges_of(spark, n_bytes):
    """Byte ranges of this size, so that small documents are split too."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, str(n_bytes))
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def land(path, *documents):
    os.makedirs(path)
    for i, d in enumerate(documents):
        with open(os.path.join(path, f"doc{i}.json"), "w", encoding="utf-8") as f:
            f.write(d if isinstance(d, str) else json.dumps(d))
    return path


def cube(n_a, n_b, value, *, value_first=False, **rest):
    labels = {f"c{i}": 'tricky, "value": [1, {2}] \\ "quoted" é ' + str(i) for i in range(n_b)}
    dimension = {"a": {"category": {"index": [f"r{i}" for i in range(n_a)]}}, "b": {"category": {"index": {f"c{i}": i for i in range(n_b)}, "label": labels}}}
    head = {"id": ["a", "b"], "size": [n_a, n_b], "dimension": dimension}
    return {"value": value, **head, **rest} if value_first else {**head, "value": value, **rest}


def both(spark, path, n_bytes, **options):
    want = rows(op.decode_json_stat(read_json_stat_documents(spark, path), ["a", "b"], **options))
    with ranges_of(spark, n_bytes):
        pieces = read_json_stat_ranges(spark, path)
        return pieces, rows(op.decode_json_stat_ranges(pieces, ["a", "b"], **options)), want


def test_equal_to_the_whole_parse(spark, scratch):
    rng = random.Random(5)
    dense = [rng.choice([None, i, i / 8, -i]) for i in range(600)]
    sparse = {str(i): rng.choice([None, i, 1e-3 * i]) for i in rng.sample(range(600), 250)}
    path = land(
        scratch("ranges"), cube(20, 30, dense), cube(20, 30, sparse), cube(20, 30, dense, value_first=True), cube(20, 30, sparse, value_first=True),
        cube(20, 30, dense, status={"3": "p, ]"}, extension={"value": [1, 2, 3], "x": "value"}), json.dumps(cube(2, 2, [1, 2, 3, 4]), indent=2),
        cube(2, 2, [5]), cube(2, 2, {}), cube(2, 2, []), cube(2, 2, {"3": 8}),
    )
    pieces, got, want = both(spark, path, 700, keep_doc=True)
    assert got == want and len(want) > 1500
    assert pieces.select("doc", "block").distinct().count() > 30


def test_a_nested_value_key_is_not_the_cube(spark, scratch):
    d = {"extension": {"value": [9, 9]}, "note": '"value": [7', **cube(1, 3, [1, None, 3])}
    _, got, want = both(spark, land(scratch("ranges"), d), 60)
    assert got == want and [r[-1] for r in got] == [1.0, 3.0]


def test_broken_documents_fail_by_name_or_are_left_out(spark, scratch):
    good = cube(1, 2, [1, 2])
    path = land(scratch("ranges"), good, '{"id": ["a"], "size": [1]}', json.dumps(cube(1, 2, [1, 2]))[:-9], cube(1, 2, {"7": 1, "0": 4}), cube(1, 2, ["x", 6]), "", "no json, at all")
    with ranges_of(spark, 80):
        pieces = read_json_stat_ranges(spark, path)
        with pytest.raises(Exception, match="JSON-stat document .*doc"):
            op.decode_json_stat_ranges(pieces, ["a", "b"]).collect()
        kept = rows(op.decode_json_stat_ranges(pieces, ["a", "b"], keep_doc=True, on_error="reject"), "doc", "obs_value")
    assert [(os.path.basename(d), v) for d, v in kept] == [("doc0.json", 1.0), ("doc0.json", 2.0), ("doc3.json", 4.0), ("doc4.json", 6.0)]


def test_values_of_one_document_are_never_one_group(spark, scratch):
    path = land(scratch("ranges"), cube(100, 100, list(range(10_000))))
    with ranges_of(spark, 4096):
        out = op.decode_json_stat_ranges(read_json_stat_ranges(spark, path), ["a", "b"])
        assert sorted(r["obs_value"] for r in out.collect()) == [float(i) for i in range(10_000)]
        plan = out._jdf.queryExecution().toString()
    # no exchange of the values by the document alone
    assert "raw" not in "".join(line for line in plan.splitlines() if "hashpartitioning(doc" in line and "block" not in line and "part" not in line)


def test_only_pieces_that_open_or_close_something_are_exchanged(spark, scratch):
    labels = {f"c{i}": f"Label {i}" for i in range(200)} | {"c7": 'one, "two", three'}
    dimension = {"a": {"category": {"index": {f"c{i}": i for i in range(200)}, "label": labels}}}
    path = land(scratch("marks"), {"id": ["a"], "size": [200], "dimension": dimension, "value": {str(i): i for i in range(200)}})
    pieces = read_json_stat_ranges(spark, path)
    assert pieces.count() > 600
    marked = [r["piece"].strip() for r in marking_pieces(pieces).collect()]
    assert len(marked) < 12 and 'three"' in marked and not any(m.startswith('"c9"') for m in marked)
    assert rows(op.decode_json_stat_ranges(pieces, ["a"]), "a", "obs_value") == sorted((f"c{i}", float(i)) for i in range(200))
