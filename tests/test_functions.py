import datetime as dt

from pyspark.sql import functions as F

from gapscope import functions as G
from gapscope import operators as op


def test_composite_key_skips_nulls(spark):
    df = spark.createDataFrame([("PL", 2020), (None, 2021), ("DE", None)], "j string, y int")
    assert [r[0] for r in df.select(G.composite_key("j", "y")).collect()] == ["PL_2020", "2021", "DE"]


def test_sha256_key_is_stable_hex(spark):
    df = spark.createDataFrame([("PL_2020", "r")], "id string, reason string")
    k = df.select(G.sha256_key("id", "reason")).first()[0]
    import hashlib

    assert k == hashlib.sha256(b"PL_2020|r").hexdigest()


def test_guarded_ratio_and_safe_cast(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, -2.0), (1.0, None)], "n double, d double")
    assert [r[0] for r in df.select(G.guarded_ratio("n", "d")).collect()] == [0.5, None, None, None]
    t = spark.createDataFrame([("12",), ("2020-Q1",), ("",), (None,)], "s string")
    assert [r[0] for r in t.select(G.safe_cast("s", "int")).collect()] == [12, None, None, None]


def test_lookback_cutoff_forms(spark):
    df = spark.range(1)
    got = df.select(G.lookback_cutoff("2024-01-30", 7), G.lookback_cutoff(dt.date(2024, 1, 30), 7),
                    G.lookback_cutoff(F.lit("2024-01-30"), 7)).first()
    assert set(got) == {dt.date(2024, 1, 23)}


def test_since_period_defaults_to_first_period(spark):
    df = spark.createDataFrame([(2015,), (2016,), (2020,)], "year int")
    assert [r[0] for r in op.since_period(df).collect()] == [2016, 2020]


def test_cluster_settings_scale_with_input():
    from gapscope.session import cluster_settings

    small = cluster_settings(10 << 30, executor_cores=4, executors=2)
    big = cluster_settings(100 << 40, executor_cores=8, executors=1000)
    assert int(small["spark.sql.shuffle.partitions"]) == 40  # 10 GiB / 256 MiB
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_settings(1 << 20, 8, 1000)["spark.sql.shuffle.partitions"]) == 16000  # two waves minimum
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_classify_arrival_labels(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 23),), (dt.datetime(2024, 1, 22, 23, 59),), (None,)],
                               "_ingested_at timestamp")
    got = [r["arrival"] for r in op.classify_arrival(df, as_of="2024-01-30").collect()]
    assert got == ["late", "on_time", None]
