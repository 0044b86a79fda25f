"""The multi-output job: one plan over facts and rates, five tables.

The merged table is the only expensive output (it scans and aggregates
all facts). It is written first; the top-N, audit candidates and the
dimension are then computed from the *written* table, so the facts are
scanned once, lineage is cut at a durable copy (a lost executor never
forces a recompute of the fact aggregation), and nothing is pinned in
executor memory. Outputs go to a folder on shared storage chosen by the
caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gapscope.operators.audit import audit_candidates
from gapscope.operators.rates import effective_vs_statutory, jurisdictions_dim, tax_rates_with_id, top_gap
from gapscope.sources.schemas import EFFECTIVE_VS_STATUTORY
from gapscope.sources.tables import read_table, write_table

OUTPUTS = ("effective_vs_statutory", "top10_gap", "audit_candidates", "jurisdictions_dim", "tax_rates_with_id")


def run_report(
    spark: SparkSession,
    facts: DataFrame,
    rates: DataFrame,
    out_dir: str,
    top_n: int = 10,
    partition_by_year: bool = True,
) -> dict[str, str]:
    """Write the five outputs under ``out_dir``; return name -> path."""
    paths = {name: f"{out_dir.rstrip('/')}/{name}" for name in OUTPUTS}
    # not sorted: a partitioned table keeps no order across its files
    merged = effective_vs_statutory(facts, rates, sort=False)
    write_table(merged, paths["effective_vs_statutory"], partition_by=["year"] if partition_by_year else None)
    stored = read_table(spark, paths["effective_vs_statutory"], schema=EFFECTIVE_VS_STATUTORY)
    write_table(top_gap(stored, top_n), paths["top10_gap"])
    write_table(audit_candidates(stored), paths["audit_candidates"])
    write_table(jurisdictions_dim(stored), paths["jurisdictions_dim"])
    write_table(tax_rates_with_id(rates), paths["tax_rates_with_id"])
    return paths
