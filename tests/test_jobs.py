"""End to end: driver-table landings -> jobs -> tables, checked against the operators."""

import datetime as dt
import os

import pytest

from conftest import rows
from gapscope import operators as op
from gapscope.plans import bindings as B
from gapscope.plans import jobs
from gapscope.sources import FACTS_CLEAN, read_labelled_csv, read_table

SF = "/root/testdata/sf0.001"


def test_jobs_end_to_end(spark, scratch):
    facts_out, rates_out, ratio_out = scratch("facts"), scratch("rates"), scratch("ratio")
    jobs.clean_facts_job(spark, B.land_facts(spark, SF), facts_out)
    jobs.clean_rates_job(spark, B.land_rates(spark, SF), rates_out)
    jobs.clean_ratio_job(spark, B.land_json_stat(spark, SF), ratio_out)

    facts = read_table(spark, facts_out, FACTS_CLEAN)
    expected = B.long_facts(spark, SF)
    assert facts.count() == expected.count()
    assert {r["_ingested_at"] for r in facts.select("_ingested_at").distinct().collect()} == {dt.datetime(2026, 1, 15, 8, 30)}
    assert read_table(spark, rates_out).count() == B.rates_long(spark, SF).count()
    assert read_table(spark, ratio_out).columns == ["jurisdiction", "jurisdiction_name", "year", "tax_to_gdp_ratio"]

    snap_out = scratch("snapshot")
    jobs.snapshot_job(spark, facts_out, snap_out, as_of="2026-01-20")
    assert read_table(spark, snap_out).count() == facts.count()  # already one row per key

    paths = jobs.report_job(spark, facts_out, rates_out, scratch("report"))
    merged = read_table(spark, paths["effective_vs_statutory"])
    direct = op.effective_vs_statutory(B.long_facts(spark, SF), B.rates_long(spark, SF))
    # cleaned facts are doubles (summed as doubles), the direct path sums decimals
    got, want = rows(merged, "id", "gap_statutory_minus_effective"), rows(direct, "id", "gap_statutory_minus_effective")
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all((g[1] is None and w[1] is None) or abs(g[1] - w[1]) <= 1e-9 * max(1.0, abs(w[1])) for g, w in zip(got, want))

    log = scratch("flags")
    assert jobs.init_flags_job(spark, log) is True and jobs.init_flags_job(spark, log) is False


def test_merge_late_job_rewrites_only_touched_years(spark, scratch):
    from pyspark.sql import functions as F

    from gapscope.operators import dedup_latest
    from gapscope.sources import write_table

    t1, t2 = dt.datetime(2026, 1, 10), dt.datetime(2026, 1, 20)
    facts = B.long_facts(spark, SF).withColumn("obs_value", F.col("obs_value").cast("double")) \
        .withColumn("_ingested_at", F.lit(t1).cast("timestamp")).select(*FACTS_CLEAN.fieldNames())
    snap = scratch("snapshot")
    write_table(facts, snap, partition_by=["year"])
    years = sorted(r[0] for r in facts.select("year").distinct().collect())
    late_year = years[1]
    # late restatement: every fact of one year, value + 1, loaded later; plus one brand-new key
    batch = facts.filter(F.col("year") == late_year).withColumn("obs_value", F.col("obs_value") + 1) \
        .withColumn("_ingested_at", F.lit(t2).cast("timestamp"))
    new_key = spark.createDataFrame([("NEWLAND", "NATION_1", "Employees", late_year, 5.0, t2)], FACTS_CLEAN)
    batch = batch.unionByName(new_key)
    untouched_files = sorted(p for p in os.listdir(f"{snap}/year={years[0]}"))
    assert jobs.merge_late_job(spark, snap, batch) == [late_year]
    result = read_table(spark, snap, FACTS_CLEAN)
    expected = dedup_latest(facts.unionByName(batch), ["jurisdiction", "counterpart_jurisdiction", "measure", "year"])
    assert rows(result) == rows(expected)
    assert sorted(os.listdir(f"{snap}/year={years[0]}")) == untouched_files  # not rewritten


def test_merge_late_job_keeps_rows_without_a_year(spark, scratch):
    from gapscope.sources import write_table

    t1, t2 = dt.datetime(2026, 1, 10), dt.datetime(2026, 1, 20)
    stored = spark.createDataFrame([("A", "X", "m", None, 1.0, t1), ("B", "X", "m", None, 2.0, t1), ("A", "X", "m", 2020, 3.0, t1)], FACTS_CLEAN)
    snap = scratch("null_year")
    write_table(stored, snap, partition_by=["year"])
    batch = spark.createDataFrame([("B", "X", "m", None, 9.0, t2), ("C", "X", "m", 2021, 4.0, None)], FACTS_CLEAN)
    assert jobs.merge_late_job(spark, snap, batch) == [None]
    assert rows(read_table(spark, snap, FACTS_CLEAN), "jurisdiction", "year", "obs_value") == [("A", None, 1.0), ("A", 2020, 3.0), ("B", None, 9.0)]


def test_command_line(spark, scratch):
    from gapscope.__main__ import main

    facts, rates, out = scratch("cli_facts"), scratch("cli_rates"), scratch("cli_report")
    main(["clean-facts", "--landing", B.land_facts(spark, SF), "--out", facts])
    main(["clean-rates", "--landing", B.land_rates(spark, SF), "--out", rates])
    paths = main(["report", "--facts", facts, "--rates", rates, "--out", out])
    assert read_table(spark, paths["effective_vs_statutory"]).count() == B.merged(spark, SF).count()
    log = scratch("cli_log")
    for _ in range(2):
        main(["flag", "--filings", paths["effective_vs_statutory"], "--log", log])
    assert read_table(spark, log).count() == B.merged(spark, SF).where("gap_statutory_minus_effective > 5").count()
    of_rule = {r.rule: r for r in read_table(spark, paths["quality_rules"]).collect()}
    n = read_table(spark, paths["effective_vs_statutory"]).count()
    assert len(of_rule) == 3 and of_rule["revenue_ge_profit"].n_unknown == n  # filings without revenue
    assert main(["init-flags", "--path", scratch("cli_flags")]) is True


def test_counts_come_with_the_write_and_read_the_landing_once(spark, scratch):
    landing, out, counts = B.land_facts(spark, SF), scratch("facts"), scratch("counts")
    size = sum(os.path.getsize(f"{landing}/{f}") for f in os.listdir(landing) if f.endswith(".csv"))
    read = lambda: sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = read()
    jobs.clean_facts_job(spark, landing, out, first_year=1996, counts=counts)
    assert size < read() - before < 1.7 * size
    want = op.clean_step_counts(read_labelled_csv(spark, landing)).first().asDict()
    assert read_table(spark, counts).first().asDict() == want
    assert read_table(spark, out).count() < want["after_dedup"]


def test_rejected_lines_are_stored_and_may_fail_the_job(spark, scratch):
    landing = scratch("landing")
    os.makedirs(landing)
    head = "Reference area,Counterpart area,Measure,TIME_PERIOD,OBS_VALUE"
    with open(f"{landing}/part-0.csv", "w") as f:
        f.write(f"{head}\nPL,DE,Employees,2020,5\nPL,DE,Employees\nPL,DE,Employees,2021,6,x\n,,,,\n")
    with open(f"{landing}/part-1.csv", "w") as f:
        f.write(f"{head}\n")
    out, rejects, counts = scratch("facts"), scratch("rejects"), scratch("counts")
    with pytest.raises(ValueError, match="2 lines of the landing do not fit"):
        jobs.clean_facts_job(spark, landing, out, counts=counts, rejects=rejects, fail_on_rejects=True)
    stored = read_table(spark, rejects)
    assert rows(stored, "line") == [("PL,DE,Employees",), ("PL,DE,Employees,2021,6,x",)]
    assert all(r.file.endswith("part-0.csv") for r in stored.collect())
    assert rows(read_table(spark, out), "jurisdiction", "year", "obs_value") == [("PL", 2020, 5.0)]
    assert read_table(spark, counts).first().asDict() == {"raw_rows": 2, "null_year": 1, "null_obs_value": 1, "after_dropna": 1, "after_dedup": 1}
    clean = scratch("clean")
    jobs.clean_facts_job(spark, landing, clean)  # without a folder such lines are padded or cut
    assert read_table(spark, clean).count() == 2
    with pytest.raises(ValueError, match="needs a folder"):
        jobs.clean_rates_job(spark, landing, clean, fail_on_rejects=True)
