import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from gapscope import labels as L
from gapscope import operators as op

FACT_SCHEMA = "jurisdiction string, counterpart_jurisdiction string, measure string, year int, obs_value double, _ingested_at timestamp"
T1 = dt.datetime(2024, 1, 1, 10, 0)
T2 = dt.datetime(2024, 1, 2, 10, 0)


def raw_frame(spark, data):
    cols = ["Reference area", "Counterpart area", "Measure", "TIME_PERIOD", "OBS_VALUE", "EXTRA"]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols))


def test_select_rename_missing_column_names_both_lists(spark):
    df = spark.createDataFrame([("A", "2020")], "`Reference area` string, TIME_PERIOD string")
    with pytest.raises(ValueError) as e:
        op.select_rename(df, L.FACT_COLUMNS)
    msg = str(e.value)
    assert "Counterpart area" in msg and "OBS_VALUE" in msg and "it has" in msg and "TIME_PERIOD" in msg


def test_cast_bad_text_becomes_null(spark):
    raw = raw_frame(spark, [("A", "B", "m", "2020-Q1", "n/a", "x"), ("A", "B", "m", "2021", "", "x"),
                            ("A", "B", "m", "2022", "1.5", "x")])
    out = raw.transform(op.select_rename, L.FACT_COLUMNS).transform(op.cast_types, {"year": "int", "obs_value": "double"})
    assert rows(out, "year", "obs_value") == [(None, None), (2021, None), (2022, 1.5)]


def test_drop_incomplete_keeps_null_measure_and_counterpart(spark):
    df = spark.createDataFrame(
        [("A", None, None, 2020, 1.0, T1), (None, "B", "m", 2020, 1.0, T1), ("A", "B", "m", None, 1.0, T1),
         ("A", "B", "m", 2020, None, T1)], FACT_SCHEMA)
    out = op.drop_incomplete(df, L.FACT_NOT_NULL)
    assert rows(out, "jurisdiction", "counterpart_jurisdiction", "measure") == [("A", None, None)]


def test_dedup_latest_keeps_latest_and_groups_null_keys(spark):
    df = spark.createDataFrame(
        [("A", None, "m", 2020, 1.0, T1), ("A", None, "m", 2020, 2.0, T2),
         ("A", "B", None, 2020, 5.0, T1), ("A", "B", None, 2020, 6.0, T1),
         ("C", "D", "m", 2020, 9.0, None), ("C", "D", "m", 2020, 8.0, T1)], FACT_SCHEMA)
    out = op.dedup_latest(df, L.FACT_KEYS)
    got = rows(out, "jurisdiction", "counterpart_jurisdiction", "obs_value")
    # latest wins; same-time tie -> smallest remaining value; null time loses
    assert got == [("A", None, 2.0), ("A", "B", 5.0), ("C", "D", 8.0)]


def test_dedup_is_idempotent_and_repeatable(spark):
    data = [(f"J{i % 3}", f"C{i % 2}", "m", 2020 + i % 2, float(i), T1 if i % 4 else T2) for i in range(40)]
    df = spark.createDataFrame(data, FACT_SCHEMA).repartition(5)
    once = op.dedup_latest(df, L.FACT_KEYS)
    twice = op.dedup_latest(once, L.FACT_KEYS)
    assert rows(once) == rows(twice)
    assert once.count() == once.select(*L.FACT_KEYS).distinct().count()
    again = op.dedup_latest(spark.createDataFrame(list(reversed(data)), FACT_SCHEMA).repartition(3), L.FACT_KEYS)
    assert rows(once) == rows(again)


def test_dedup_any_picks_smallest_by_tiebreak(spark):
    df = spark.createDataFrame([("A", "m", 2020, 3.0), ("A", "m", 2020, 1.0), ("B", "m", 2020, 2.0)],
                               "jurisdiction string, measure string, year int, tax_rate double")
    assert rows(op.dedup_any(df, L.RATE_KEYS), "jurisdiction", "tax_rate") == [("A", 1.0), ("B", 2.0)]


def test_clean_facts_end_to_end(spark):
    raw = raw_frame(spark, [
        ("A", "B", L.PROFIT_MEASURE, "2020", "10", "x"),
        ("A", "B", L.PROFIT_MEASURE, "2020", "10", "y"),      # repeat -> folded
        ("A", "B", L.PROFIT_MEASURE, "2020-Q1", "10", "x"),   # bad period -> dropped
        ("A", "B", L.TAX_PAID_MEASURE, "2020", "n/a", "x"),    # bad value -> dropped
        ("A", None, L.TAX_PAID_MEASURE, "2020", "3", "x"),     # null counterpart kept
    ])
    out = op.clean_facts(raw, ingested_at=F.lit(T1).cast("timestamp"))
    assert out.columns == ["jurisdiction", "counterpart_jurisdiction", "measure", "year", "obs_value", "_ingested_at"]
    assert rows(out, "counterpart_jurisdiction", "measure", "year", "obs_value") == [
        (None, L.TAX_PAID_MEASURE, 2020, 3.0), ("B", L.PROFIT_MEASURE, 2020, 10.0)]
    counts = op.clean_step_counts(raw).first().asDict()
    assert counts == {"raw_rows": 5, "null_year": 1, "null_obs_value": 1, "after_dropna": 3, "after_dedup": 2}


def test_clean_rates(spark):
    df = spark.createDataFrame([("A", L.STATUTORY_MEASURE, "2020", "25"), ("A", L.STATUTORY_MEASURE, "2020", "25"),
                                ("B", L.STATUTORY_MEASURE, "x", "25")],
                               "`Reference area` string, Measure string, TIME_PERIOD string, OBS_VALUE string")
    assert rows(op.clean_rates(df)) == [("A", L.STATUTORY_MEASURE, 2020, 25.0)]


def test_stamp_from_one_row_frame(spark):
    df = spark.createDataFrame([("A",), ("B",)], "x string")
    stamp = spark.createDataFrame([(T2,)], "ingested_at timestamp")
    assert {r["_ingested_at"] for r in op.stamp_ingest_time(df, stamp).collect()} == {T2}
