"""Operators: ``DataFrame -> DataFrame`` functions, composable with ``df.transform``."""

from gapscope.operators.audit import (
    append_flags,
    audit_candidates,
    flag_filings,
    init_audit_log,
    link_filing_flags,
    link_filing_jurisdiction,
    link_rate_jurisdiction,
    lookup,
    qualify_audit,
    read_audit_log,
    year_percentiles,
)
from gapscope.operators.clean import (
    cast_types,
    clean_facts,
    clean_rates,
    clean_step_counts,
    dedup_any,
    dedup_latest,
    drop_incomplete,
    select_rename,
    stamp_ingest_time,
)
from gapscope.operators.incremental import (
    classify_arrival,
    incremental_snapshot,
    late_arrival_counts,
    late_arrival_split,
    merge_into_snapshot,
)
from gapscope.operators.json_stat import clean_ratio, decode_json_stat, json_stat_rejects
from gapscope.operators.json_stat_ranges import decode_json_stat_ranges
from gapscope.operators.percentiles import exact_percentiles
from gapscope.operators.quality import (
    column_profile,
    distinct_sample,
    filter_keywords,
    measure_listing,
    quality_rules,
    sample_values,
    since_period,
    year_range,
)
from gapscope.operators.rates import (
    aggregate_totals,
    effective_rate,
    effective_vs_statutory,
    join_statutory,
    jurisdictions_dim,
    pivot_measures,
    statutory_rates,
    tax_rates_with_id,
    top_gap,
)

__all__ = [name for name in dir() if not name.startswith("_")]
