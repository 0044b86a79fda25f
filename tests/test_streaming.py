import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from gapscope import operators as op
from gapscope.streaming import read_snapshot, start_snapshot_stream

SF = "/root/testdata/sf0.01"
KEYS = ["user_id", "event_type"]


def test_stream_snapshot_equals_batch_snapshot(spark, scratch):
    events = spark.read.parquet(f"{SF}/events.parquet")
    src, sink, ckpt = scratch("stream_src"), scratch("stream_sink"), scratch("stream_ckpt")
    # first landing: events up to Jan 20; second landing: the rest plus a
    # re-sent (late, older) copy of some early rows that must not win
    cut = F.lit(dt.datetime(2024, 1, 20))
    events.filter(F.col("ts") < cut).write.parquet(f"{src}/batch=1")
    q = start_snapshot_stream(spark, src, events.schema, sink, ckpt, KEYS, "ts", ["event_id"])
    q.awaitTermination()
    late_copy = events.filter(F.col("ts") < F.lit(dt.datetime(2024, 1, 5))).withColumn("value", F.lit(-1.0))
    events.filter(F.col("ts") >= cut).unionByName(late_copy).write.parquet(f"{src}/batch=2")
    q = start_snapshot_stream(spark, src, events.schema, sink, ckpt, KEYS, "ts", ["event_id"])
    q.awaitTermination()
    got = read_snapshot(spark, sink, KEYS, "ts", ["event_id"]).select(*events.columns)
    expected = op.dedup_latest(events, KEYS, "ts", tiebreak=[F.col("event_id").desc()])
    assert rows(got) == rows(expected)
