import pytest
from pyspark.sql import functions as F

from conftest import rows
from gapscope import operators as op
from gapscope.sources import read_ordered, write_bucketed, write_lookup_table, write_ordered


def scanned_rows(df):
    """Rows that the file scans of an executed plan put out."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    text, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        text.append(node.nodeName())
        if "Scan" in node.nodeName():
            total += node.metrics().get("numOutputRows").get().value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total, text


def test_file_order_is_the_written_order(spark, scratch):
    path = scratch("ordered")
    df = spark.range(5000).select("id", F.when(F.col("id") % 11 > 0, F.pmod(F.col("id") * 37, F.lit(101))).alias("gap"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_ordered(df, path, F.col("gap").desc_nulls_last(), "id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(path).select("_metadata.file_name").distinct().count() > 2
    got = sorted((r["position"], r["gap"], r["id"]) for r in read_ordered(spark, path).collect())
    want = sorted((tuple(r) for r in df.select("gap", "id").collect()), key=lambda t: (t[0] is None, -(t[0] or 0), t[1]))
    assert got == [(i + 1, *t) for i, t in enumerate(want)]


def test_empty_table_keeps_its_columns(spark, scratch):
    path = scratch("ordered")
    write_ordered(spark.createDataFrame([], "id int"), path, "id")
    assert read_ordered(spark, path).columns == ["id", "position"] and read_ordered(spark, path).count() == 0


def test_links_of_bucketed_tables_have_no_exchange(spark, scratch):
    filings = spark.range(3000).select(F.concat(F.lit("f"), "id").alias("id"), F.concat(F.lit("j"), F.col("id") % 40).alias("jurisdiction"), F.lit(2020).alias("year"))
    flags = filings.where("year = 2020").selectExpr("concat('x', id) flag_id", "id filing_id", "'open' status", "'gap' reason").limit(500)
    dim = filings.select("jurisdiction").distinct().where("jurisdiction != 'j7'")
    rates = filings.selectExpr("id", "jurisdiction", "year", "1.0D statutory_rate")
    made = {}
    for name, df, key in (("b_filings", filings, "id"), ("b_places", filings, "jurisdiction"), ("b_flags", flags, "filing_id"), ("b_dim", dim, "jurisdiction"), ("b_rates", rates, "jurisdiction")):
        write_bucketed(df, name, scratch(name), [key], 8)
        made[name] = spark.table(name)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for linked, plain in (
            (op.link_filing_flags(made["b_filings"], made["b_flags"]), op.link_filing_flags(filings, spark.read.parquet(made["b_flags"].inputFiles()[0].rsplit("/", 1)[0]))),
            (op.link_filing_jurisdiction(made["b_places"], made["b_dim"]), op.link_filing_jurisdiction(filings, dim)),
            (op.link_rate_jurisdiction(made["b_rates"], made["b_dim"]), op.link_rate_jurisdiction(rates, dim)),
        ):
            assert rows(linked) == rows(plain)
            assert "Exchange" not in linked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in made:
            spark.sql(f"drop table {name}")
    with pytest.raises(ValueError):
        write_bucketed(filings, "b_none", scratch("b_none"), ["id"], 0)


def test_lookups_skip_row_groups(spark, scratch):
    path = scratch("lookups")
    n = 200_000
    df = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), F.sha2(F.concat(F.lit("f"), "id"), 256).alias("flag_id"), F.col("id").alias("nth"))
    write_lookup_table(df.coalesce(1), path, ["id", "flag_id"], distinct_a_file=n, row_group_bytes=1 << 20)
    table = spark.read.parquet(path)
    one = df.where("nth = 77").first()
    for found in (op.lookup(table, id=one["id"]), op.lookup(table, flag_id=one["flag_id"])):
        seen, _ = scanned_rows(found)
        assert [r["nth"] for r in found.collect()] == [77] and seen < n / 4
    assert op.lookup(table, flag_id="none").count() == 0
