from conftest import rows
from gapscope import labels as L
from gapscope import operators as op

LONG = "jurisdiction string, counterpart_jurisdiction string, measure string, year int, obs_value double"
RATES = "jurisdiction string, measure string, year int, tax_rate double"
P, T, E, M = L.PROFIT_MEASURE, L.TAX_PAID_MEASURE, L.EMPLOYEES_MEASURE, L.MNE_GROUPS_MEASURE


def facts(spark):
    return spark.createDataFrame([
        ("A", "X", P, 2020, 60.0), ("A", "Y", P, 2020, 40.0), ("A", "X", T, 2020, 10.0), ("A", "X", E, 2020, 4.0),
        ("B", "X", P, 2020, 0.0), ("B", "X", T, 2020, 1.0), ("B", "X", E, 2020, 0.0),
        ("C", "X", P, 2020, -50.0), ("C", "X", T, 2020, 1.0), ("C", "X", E, 2020, 5.0),
        ("D", "X", T, 2020, 1.0), ("D", "X", "Other", 2020, 7.0),
        ("E", "X", "Other", 2020, 7.0),
    ], LONG)


def rates(spark):
    return spark.createDataFrame([
        ("A", L.STATUTORY_MEASURE, 2020, 25.0), ("B", L.STATUTORY_MEASURE, 2020, 20.0),
        ("C", L.STATUTORY_MEASURE, 2020, 30.0), ("A", "Other rate", 2020, 99.0),
    ], RATES)


def test_aggregate_and_pivot_preserve_sums(spark):
    tot = op.aggregate_totals(facts(spark))
    assert rows(tot.filter("jurisdiction = 'A' and measure = '%s'" % P), "obs_value") == [(100.0,)]
    pv = op.pivot_measures(tot)
    assert pv.columns == ["jurisdiction", "year", "profit_before_tax", "tax_paid", "employees", "mne_group_count"]
    got = {r["jurisdiction"]: r.asDict() for r in pv.collect()}
    assert set(got) == {"A", "B", "C", "D"}  # E has no wanted measure
    assert got["A"]["profit_before_tax"] == 100.0 and got["A"]["mne_group_count"] is None
    assert got["D"]["profit_before_tax"] is None and got["D"]["tax_paid"] == 1.0
    direct = op.pivot_measures(facts(spark))  # one-step form gives the same sums
    assert rows(direct) == rows(pv)


def test_effective_rate_guards(spark):
    out = {r["jurisdiction"]: r for r in op.effective_rate(op.pivot_measures(facts(spark))).collect()}
    assert out["A"]["effective_tax_rate"] == 0.1 and out["A"]["profit_per_employee"] == 25.0
    assert out["B"]["effective_tax_rate"] is None and out["B"]["profit_per_employee"] is None  # profit 0, employees 0
    assert out["C"]["effective_tax_rate"] is None and out["C"]["profit_per_employee"] == -10.0  # negative profit
    assert out["D"]["effective_tax_rate"] is None and out["D"]["profit_per_employee"] is None  # null profit


def test_statutory_and_join_drop_unmatched(spark):
    st = op.tax_rates_with_id(rates(spark))
    assert rows(st) == [("A", 2020, 25.0, "A_2020"), ("B", 2020, 20.0, "B_2020"), ("C", 2020, 30.0, "C_2020")]
    merged = op.effective_vs_statutory(facts(spark), rates(spark))
    got = {r["jurisdiction"]: r for r in merged.collect()}
    assert set(got) == {"A", "B", "C"}  # D has no rate
    assert got["A"]["effective_tax_rate_pct"] == 10.0 and got["A"]["gap_statutory_minus_effective"] == 15.0
    assert got["B"]["gap_statutory_minus_effective"] is None
    assert rows(op.jurisdictions_dim(merged)) == [("A",), ("B",), ("C",)]


def test_top_gap_nulls_last_and_ties(spark):
    schema = "jurisdiction string, year int, gap_statutory_minus_effective double"
    df = spark.createDataFrame([("B", 2020, 5.0), ("A", 2021, 5.0), ("A", 2020, 5.0), ("C", 2020, None), ("D", 2020, 9.0)], schema)
    top = op.top_gap(df, 4).collect()
    assert [(r["jurisdiction"], r["year"]) for r in top] == [("D", 2020), ("A", 2020), ("A", 2021), ("B", 2020)]
    assert op.top_gap(df, 10).collect()[-1]["jurisdiction"] == "C"


def test_exclude_aggregate_counterpart(spark):
    merged = op.effective_vs_statutory(facts(spark), rates(spark), exclude_counterparts=["Y"])
    got = {r["jurisdiction"]: r["profit_before_tax"] for r in merged.collect()}
    assert got["A"] == 60.0  # the 40 booked against counterpart Y is left out
    tot = op.aggregate_totals(facts(spark), exclude_counterparts=["Y"])
    assert rows(tot.filter("jurisdiction = 'A' and measure = '%s'" % P), "obs_value") == [(60.0,)]


def test_excluding_counterparts_keeps_null_ones(spark):
    df = spark.createDataFrame([("A", "W", P, 2020, 4.0), ("A", None, P, 2020, 5.0), ("A", "X", P, 2020, 1.0)], LONG)
    assert rows(op.aggregate_totals(df, exclude_counterparts=["W"]), "obs_value") == [(6.0,)]
    out = op.effective_vs_statutory(df, rates(spark), exclude_counterparts=["W"])
    assert rows(out.where("jurisdiction = 'A'"), "profit_before_tax") == [(6.0,)]
