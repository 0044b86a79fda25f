import json

import pytest

from conftest import rows
from gapscope import operators as op
from gapscope.operators.json_stat import parsed_documents, raw_cells
from gapscope.plans import bindings as B

DIMS = {"a": {"category": {"index": {"y": 1, "x": 0}, "label": {"x": "Ex", "y": "Why"}}},
        "b": {"category": {"index": ["p", "q"], "label": {"p": "Pe"}}}}


def docs(spark, *documents):
    return spark.createDataFrame([(f"doc{i}", json.dumps(d)) for i, d in enumerate(documents)], "doc string, text string")


def test_sparse_map_index_out_of_order_and_missing_label(spark):
    d = {"id": ["a", "b"], "size": [2, 2], "dimension": DIMS, "value": {"0": 1, "3": 4.5, "1": None}}
    out = op.decode_json_stat(docs(spark, d))
    assert out.columns == ["a", "a_label", "b", "b_label", "obs_value"]
    assert rows(out) == [("x", "Ex", "p", "Pe", 1.0), ("x", "Ex", "q", "q", None), ("y", "Why", "q", "q", 4.5)]


def test_dense_array_skips_nulls(spark):
    d = {"id": ["a", "b"], "size": [2, 2], "dimension": DIMS, "value": [1, None, 3, 4]}
    assert rows(op.decode_json_stat(docs(spark, d)), "a", "b", "obs_value") == [
        ("x", "p", 1.0), ("y", "p", 3.0), ("y", "q", 4.0)]


def test_no_index_falls_back_to_label_keys_and_one_member_dimension(spark):
    d = {"id": ["t", "a"], "size": [1, 2], "dimension": {"t": {"category": {"label": {"2020": "Year 2020"}}}, "a": DIMS["a"]},
         "value": [5, 6]}
    got = rows(op.decode_json_stat(docs(spark, d)), "t", "t_label", "a", "obs_value")
    assert got == [("2020", "Year 2020", "x", 5.0), ("2020", "Year 2020", "y", 6.0)]


def test_many_documents_with_differing_dimensions(spark):
    d1 = {"id": ["a"], "size": [2], "dimension": {"a": DIMS["a"]}, "value": [1, 2]}
    d2 = {"id": ["b"], "size": [2], "dimension": {"b": DIMS["b"]}, "value": {"1": 9}}
    out = op.decode_json_stat(docs(spark, d1, d2), keep_doc=True)
    assert rows(out, "doc", "a", "b", "obs_value") == [("doc0", "x", None, 1.0), ("doc0", "y", None, 2.0), ("doc1", None, "q", 9.0)]


def test_clean_ratio_filters_and_renames(spark):
    d = {"id": ["na_item", "unit", "geo", "time"], "size": [2, 1, 1, 1],
         "dimension": {"na_item": {"category": {"index": ["TR", "X"], "label": {"TR": "Total receipts from taxes and social contributions", "X": "Other"}}},
                       "unit": {"category": {"index": ["PC"], "label": {"PC": "Percentage of gross domestic product (GDP)"}}},
                       "geo": {"category": {"index": ["PL"], "label": {"PL": "Poland"}}},
                       "time": {"category": {"index": ["2021"]}}},
         "value": [36.5, 1.0]}
    out = op.clean_ratio(op.decode_json_stat(docs(spark, d)))
    assert out.columns == ["jurisdiction", "jurisdiction_name", "year", "tax_to_gdp_ratio"]
    assert rows(out) == [("PL", "Poland", 2021, 36.5)]


def test_documents_without_any_value_fail_the_job(spark, scratch):
    import os

    from gapscope.plans import jobs

    folder = scratch("empty_ratio")
    os.makedirs(folder)
    with open(f"{folder}/empty.json", "w") as f:
        json.dump({"id": ["geo"], "size": [2], "dimension": {"geo": DIMS["a"]}, "value": []}, f)
    with pytest.raises(ValueError, match="no ratio row"):
        jobs.clean_ratio_job(spark, folder, scratch("ratio"))


GOOD = {"id": ["a", "b"], "size": [2, 2], "dimension": DIMS, "value": [1, None, 3, 4]}


@pytest.mark.parametrize("text,problem", [
    (json.dumps(GOOD)[:-12], "not a whole"),
    ("", "not a whole"),
    (json.dumps({**GOOD, "value": [1, "n/a", 3, 4]}), "no number"),
    (json.dumps({**GOOD, "value": {"0": 1, "2": "n/a"}}), "no number"),
    (json.dumps({**GOOD, "value": {"9": 1}}), "outside the cube"),
    (json.dumps({**GOOD, "size": [2]}), "sizes"),
    (json.dumps({**GOOD, "id": ["a", "z"]}), "dimension is missing"),
])
def test_broken_documents_and_cells_fail_by_name_or_are_listed(spark, text, problem):
    frame = spark.createDataFrame([("good", json.dumps(GOOD)), ("broken", text)], "doc string, text string")
    with pytest.raises(Exception, match=f"broken: .*{problem}"):
        op.decode_json_stat(frame, ["a", "b"]).collect()
    kept = op.decode_json_stat(frame, ["a", "b"], keep_doc=True, on_error="reject")
    assert len(rows(kept.where("doc = 'good'"))) == 3
    listed = op.json_stat_rejects(frame).collect()
    assert [(r.doc, r.n) for r in listed] == [("broken", 1)] and problem in listed[0].problem


def test_wide_dimension_with_many_cells(spark):
    codes = [f"c{i:05d}" for i in range(4000)]
    d = {"id": ["a", "b"], "size": [10, 4000],
         "dimension": {"a": {"category": {"index": [f"r{i}" for i in range(10)]}}, "b": {"category": {"index": codes, "label": {c: f"label {c}" for c in codes}}}},
         "value": list(range(40_000))}
    out = op.decode_json_stat(docs(spark, d))
    assert out.count() == 40_000
    assert rows(out.where("obs_value in (0, 39999, 4001)"), "a", "b", "b_label", "obs_value") == [
        ("r0", "c00000", "label c00000", 0.0), ("r1", "c00001", "label c00001", 4001.0), ("r9", "c03999", "label c03999", 39999.0)]


def test_encode_decode_identity_on_driver_tables(spark):
    sf = "/root/testdata/sf0.001"
    cells = B.order_cube_cells(spark, sf)
    path = B.land_json_stat(spark, sf)
    from gapscope.sources import read_json_stat_documents

    decoded = op.decode_json_stat(read_json_stat_documents(spark, path), B.JSON_STAT_DIMENSIONS)
    from pyspark.sql import functions as F

    expected = cells.select(
        "na_item", "na_item_label", "unit", "unit_label", "geo", F.coalesce("geo_label", "geo").alias("geo_label"),
        F.col("year").cast("string").alias("time"), F.col("year").cast("string").alias("time_label"),
        F.col("n").alias("obs_value"))
    assert rows(decoded) == rows(expected)


def test_single_named_document_file(spark, scratch):
    import os

    from gapscope.sources import read_json_stat_documents

    folder = scratch("raw_ratio")
    os.makedirs(folder)
    path = f"{folder}/tax_gdp_raw.json"
    with open(path, "w") as f:
        json.dump({"id": ["a"], "size": [2], "dimension": {"a": DIMS["a"]}, "value": [1.5, None]}, f)
    docs = read_json_stat_documents(spark, path)
    assert docs.count() == 1 and docs.first()["doc"].endswith("tax_gdp_raw.json")
    assert rows(op.decode_json_stat(docs), "a", "obs_value") == [("x", 1.5)]


def wide(n=10, m=4000):
    return {"id": ["a", "b"], "size": [n, m],
            "dimension": {"a": {"category": {"index": [f"r{i}" for i in range(n)]}}, "b": {"category": {"index": [f"c{i}" for i in range(m)]}}},
            "value": list(range(n * m))}


def test_cells_are_exchanged_once_and_a_large_document_is_spread(spark, monkeypatch):
    from pyspark.sql import functions as F

    from gapscope.operators import json_stat as J

    monkeypatch.setattr(J, "CELLS_A_PART", 500)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(old, ("-1", "false")):
        spark.conf.set(k, v)
    try:
        out = op.decode_json_stat(docs(spark, wide(), GOOD), ["a", "b"], keep_doc=True)
        node = out._jdf.queryExecution().executedPlan()
        while node.children().size() == 1:
            node = node.children().head()
        cells = node.children().head().treeString()
        assert cells.count("Exchange hashpartitioning") == 1 and cells.count("FileScan parquet") == 1
        placed = out.withColumn("task", F.spark_partition_id()).where("doc = 'doc0'")
        assert placed.select("task").distinct().count() == 8  # all shuffle partitions
        assert placed.where("b = concat('c', cast(obs_value % 4000 as int)) and a = concat('r', cast(floor(obs_value / 4000) as int))").count() == 40_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_parts_have_a_limit(spark, monkeypatch):
    from gapscope.operators import json_stat as J

    monkeypatch.setattr(J, "CELLS_A_PART", 7)
    monkeypatch.setattr(J, "MOST_PARTS", 3)
    assert rows(op.decode_json_stat(docs(spark, wide(4, 50)))) == rows(op.decode_json_stat(docs(spark, wide(4, 50)), ["a", "b"]))
    got = op.decode_json_stat(docs(spark, wide(4, 50))).where("b = concat('c', cast(obs_value % 50 as int))")
    assert got.count() == 200


def test_a_document_is_not_read_again_for_each_of_its_cells(spark):
    parsed = parsed_documents(docs(spark, {"id": ["a"], "size": [2], "dimension": {"a": DIMS["a"]}, "value": [1, 2]}))
    plan = raw_cells(parsed, ["a"])._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate ")]
    assert "trim" not in above and "aggregate(" not in above and "slice(" not in above
