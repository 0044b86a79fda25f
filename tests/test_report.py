from conftest import rows
from gapscope import operators as op
from gapscope.plans import bindings as B
from gapscope.plans.report import OUTPUTS, run_report
from gapscope.sources import EFFECTIVE_VS_STATUTORY, read_table

SF = "/root/testdata/sf0.001"


def test_report_writes_five_consistent_outputs(spark, scratch):
    facts, rates = B.long_facts(spark, SF), B.rates_long(spark, SF)
    paths = run_report(spark, facts, rates, scratch("report"))
    assert set(paths) == set(OUTPUTS)
    merged = read_table(spark, paths["effective_vs_statutory"], EFFECTIVE_VS_STATUTORY)
    direct = op.effective_vs_statutory(facts, rates)
    assert rows(merged) == rows(direct)
    assert rows(read_table(spark, paths["top10_gap"])) == rows(op.top_gap(direct).select(*merged.columns))
    assert read_table(spark, paths["audit_candidates"]).count() == op.audit_candidates(direct).count()
    assert rows(read_table(spark, paths["jurisdictions_dim"])) == rows(op.jurisdictions_dim(direct))
    assert read_table(spark, paths["tax_rates_with_id"]).count() == op.tax_rates_with_id(rates).count()
