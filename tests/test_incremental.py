import datetime as dt

from conftest import rows
from gapscope import operators as op

SCHEMA = "k string, v int, _ingested_at timestamp"


def frame(spark):
    return spark.createDataFrame([
        ("a", 1, dt.datetime(2024, 1, 1, 9)),
        ("a", 2, dt.datetime(2024, 1, 23, 0, 0)),   # exactly on the cutoff day: late
        ("b", 3, dt.datetime(2024, 1, 22, 23, 59)),  # day before: on time
        ("c", 4, None),                              # neither side
        ("b", 5, dt.datetime(2024, 1, 30, 8)),
    ], SCHEMA)


def test_split_boundaries_and_counts(spark):
    on_time, late = op.late_arrival_split(frame(spark), as_of="2024-01-30", lookback_days=7)
    assert rows(on_time, "v") == [(1,), (3,)]
    assert rows(late, "v") == [(2,), (5,)]
    counts = dict(rows(op.late_arrival_counts(frame(spark), as_of="2024-01-30")))
    assert counts == {"late": 2, "on_time": 2, "no_timestamp": 1}
    assert sum(counts.values()) == frame(spark).count()


def test_snapshot_latest_and_null_time_vanishes(spark):
    snap = op.incremental_snapshot(frame(spark), ["k"], as_of="2024-01-30")
    assert rows(snap, "k", "v") == [("a", 2), ("b", 5)]


def test_merge_into_snapshot(spark):
    base = spark.createDataFrame([("a", 1, dt.datetime(2024, 1, 1))], SCHEMA)
    batch = spark.createDataFrame([("a", 9, dt.datetime(2024, 1, 2)), ("z", 7, dt.datetime(2023, 1, 1))], SCHEMA)
    assert rows(op.merge_into_snapshot(base, batch, ["k"]), "k", "v") == [("a", 9), ("z", 7)]
    # a batch row without a load time takes no part, as in the snapshot
    lost = spark.createDataFrame([("a", 8, None), ("q", 1, None)], SCHEMA)
    assert rows(op.merge_into_snapshot(base, lost, ["k"]), "k", "v") == [("a", 1)]


def test_sides_reach_the_scan(spark, scratch):
    path = scratch("events")
    frame(spark).write.parquet(path)
    on_time, late = op.late_arrival_split(spark.read.parquet(path), as_of="2024-01-30", lookback_days=7)
    for side, bound in ((on_time, "LessThan(_ingested_at"), (late, "GreaterThanOrEqual(_ingested_at")):
        assert bound in side._jdf.queryExecution().executedPlan().toString()
    marked = op.incremental_snapshot(frame(spark), ["k"], as_of="2024-01-30", arrival="arrival")
    assert rows(marked, "k", "arrival") == [("a", "late"), ("b", "late")]
