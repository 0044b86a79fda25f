import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from gapscope import operators as op

SCHEMA = "id string, jurisdiction string, year int, employees double, profit_per_employee double, gap_statutory_minus_effective double"


def filings(spark):
    # 2020: employees 1..5 (median 3), ppe 10..50 (q3 = 40)
    data = [(f"J{i}_2020", f"J{i}", 2020, float(i), float(10 * i), float(i)) for i in range(1, 6)]
    data += [("K_2021", "K", 2021, None, None, 7.0), ("L_2021", "L", 2021, 2.0, 5.0, None)]
    return spark.createDataFrame(data, SCHEMA)


def test_year_percentiles_are_elements(spark):
    got = rows(op.year_percentiles(filings(spark)))
    assert got == [(2020, 3.0, 40.0), (2021, 2.0, 5.0)]


def test_audit_boundaries(spark):
    q = {r["id"]: r for r in op.qualify_audit(filings(spark)).collect()}
    assert q["J3_2020"]["audit_signal"] is False  # employees == median: not above
    assert q["J4_2020"]["audit_signal"] is True  # ppe == q3 passes (>=)
    assert q["K_2021"]["audit_signal"] is None
    assert q["L_2021"]["audit_signal"] is False  # equal to its own median
    cands = op.audit_candidates(filings(spark))
    assert rows(cands, "id") == [("J4_2020",), ("J5_2020",)]
    assert {"median_employees_year", "q3_profit_per_employee_year", "audit_signal"} <= set(cands.columns)


def test_flag_log_create_if_absent_and_append(spark, scratch):
    path = scratch("flags")
    assert op.init_audit_log(spark, path) is True
    assert op.init_audit_log(spark, path) is False
    assert op.read_audit_log(spark, path).count() == 0
    at = dt.datetime(2026, 1, 1, 12, 0)
    flags = op.flag_filings(filings(spark), flagged_by="tester", flagged_at=at)
    op.append_flags(spark, flags, path)
    op.append_flags(spark, flags, path)  # a re-run: flag_id is the key, nothing new
    log = op.read_audit_log(spark, path)
    assert log.count() == 1  # only K (gap 7) is above 5pp
    op.append_flags(spark, flags, path, skip_existing=False)  # plain append keeps history
    assert op.read_audit_log(spark, path).count() == 2
    assert {r["status"] for r in log.collect()} == {"OPEN"}


def test_append_takes_each_key_of_a_batch_once(spark, scratch):
    path = scratch("flags_twice")
    early, late = (op.flag_filings(filings(spark), flagged_by=by, flagged_at=dt.datetime(2026, 1, day)) for by, day in (("a", 1), ("b", 2)))
    op.append_flags(spark, late.unionByName(early).unionByName(late), path)
    assert [(r["filing_id"], r["flagged_by"]) for r in op.read_audit_log(spark, path).collect()] == [("K_2021", "a")]


def test_flag_rows_and_ids(spark):
    flags = op.flag_filings(filings(spark), flagged_at=dt.datetime(2026, 1, 1))
    got = rows(flags, "filing_id")
    assert got == [("K_2021",)]
    again = op.flag_filings(filings(spark), flagged_at=dt.datetime(2027, 1, 1))
    assert flags.first()["flag_id"] == again.first()["flag_id"]


def test_append_rejects_null_keys(spark, scratch):
    path = scratch("flags_bad")
    bad = spark.createDataFrame([(None, "F1", "r", "me", None, "OPEN")],
                                "flag_id string, filing_id string, reason string, flagged_by string, flagged_at timestamp, status string")
    with pytest.raises(Exception) as e:
        op.append_flags(spark, bad, path)
    assert "must not be null" in str(e.value)


def test_links(spark):
    f = filings(spark)
    dim = spark.createDataFrame([("J1",), ("K",)], "jurisdiction string")
    assert rows(op.link_filing_jurisdiction(f, dim), "id") == [("J1_2020",), ("K_2021",)]
    flags = op.flag_filings(f, flagged_at=dt.datetime(2026, 1, 1))
    linked = op.link_filing_flags(f, flags)
    assert linked.count() == 7 and linked.filter(F.col("flag_id").isNotNull()).count() == 1
    rates = spark.createDataFrame([("J1_2020", "J1", 2020, 20.0), ("Z_2020", "Z", 2020, 20.0)],
                                  "id string, jurisdiction string, year int, statutory_rate double")
    assert rows(op.link_rate_jurisdiction(rates, dim), "id") == [("J1_2020",)]
    assert rows(op.lookup(f, jurisdiction="K"), "id") == [("K_2021",)]
