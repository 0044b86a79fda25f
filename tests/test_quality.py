
from pyspark.sql import functions as F

from conftest import rows
from gapscope import operators as op


def test_quality_rules_three_valued(spark):
    df = spark.createDataFrame([(10.0, 2.0, 20.0), (-1.0, 0.0, 5.0), (None, 1.0, None), (5.0, 9.0, 1.0)],
                               "profit_before_tax double, tax_paid double, revenue double")
    got = {r["rule"]: (r["n_pass"], r["n_fail"], r["n_unknown"]) for r in op.quality_rules(df).collect()}
    assert got == {"profit_before_tax_non_negative": (2, 1, 1), "tax_paid_le_profit": (1, 2, 1),
                   "revenue_ge_profit": (2, 1, 1)}


def test_column_profile(spark):
    df = spark.createDataFrame([("a", "2020", "1"), ("b", None, "2"), ("a", "2021", None)],
                               "`Reference area` string, TIME_PERIOD string, OBS_VALUE string")
    prof = {r["column_name"]: r.asDict() for r in op.column_profile(df).collect()}
    assert prof["Reference area"]["n_distinct"] == 2 and prof["Reference area"]["year_like"] is False
    assert prof["TIME_PERIOD"]["n_null"] == 1 and prof["TIME_PERIOD"]["year_like"] is True
    assert prof["OBS_VALUE"]["value_like"] is True and prof["OBS_VALUE"]["max_value"] == "2"
    assert [prof[c]["position"] for c in df.columns] == [0, 1, 2]
    approx = {r["column_name"]: r["n_distinct"] for r in op.column_profile(df, exact_distinct=False).collect()}
    assert approx == {c: prof[c]["n_distinct"] for c in df.columns}
    assert "Expand" not in op.column_profile(df, exact_distinct=False)._jdf.queryExecution().executedPlan().toString()


def test_listings(spark):
    a = spark.createDataFrame([("J2", "m1", 2019), ("J1", None, 2021)], "jurisdiction string, measure string, year int")
    b = spark.createDataFrame([("J3", "r", 2000)], "jurisdiction string, measure string, year int")
    src = {"a": a, "b": b}
    assert rows(op.measure_listing(src)) == [("a", "m1"), ("b", "r")]
    assert rows(op.year_range(src)) == [("a", 2019, 2021), ("b", 2000, 2000)]
    assert rows(op.distinct_sample(src, n=1)) == [("a", "J1"), ("b", "J3")]


def test_filters_push_down(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    out = op.since_period(orders, "o_orderdate", 2000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert out.filter(F.year("o_orderdate") < 2000).count() == 0
    part = spark.createDataFrame([("green ring",), ("Widget",), ("widget box",)], "p_name string")
    assert rows(op.filter_keywords(part, "p_name", ["ring", "widget"])) == [("green ring",), ("widget box",)]
    assert op.filter_keywords(part, "p_name", []).count() == 0


def test_sample_values_bounded(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 7 as string) as k")
    got = {r["column_name"]: r["sample_values"] for r in op.sample_values(df, n=5).collect()}
    assert set(got) == {"id", "k"} and all(len(v) == 5 for v in got.values())
    assert all(0 <= int(x) < 1000 for x in got["id"])


def test_sample_values_keep_nulls(spark):
    df = spark.createDataFrame([(None,), ("b",), (None,)], "v string").coalesce(1)
    assert op.sample_values(df).first()["sample_values"] == [None, "b", None]
