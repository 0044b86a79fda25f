"""Registered queries: one per operator row of the inventory, on the driver tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame. Queries
that exercise a source or sink first land their input under the session's
checkpoint folder (a fresh sub-folder per call), then read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapscope import labels as L
from gapscope import operators as op
from gapscope.operators.audit import AUDIT_THRESHOLDS
from gapscope.operators.rates import gap_order
from gapscope.plans import bindings as B
from gapscope.plans.jobs import clean_facts_job, clean_rates_job, merge_late_job
from gapscope.plans.report import OUTPUTS, run_report
from gapscope.session import scratch_path
from gapscope.sources import (
    EFFECTIVE_VS_STATUTORY,
    FACTS_CLEAN,
    export_csv,
    read_csv_export,
    read_ingest_stamp,
    read_json_stat_documents,
    read_json_stat_ranges,
    read_labelled_csv,
    read_ordered,
    read_table,
    write_bucketed,
    write_lookup_table,
    write_ordered,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]

EVENT_KEYS = ["user_id", "event_type"]
#: The reporting day of the event queries: a literal, so the cutoff reaches the scan.
EVENTS_AS_OF = "2024-01-30"
QUALITY_MEASURES = {**L.PIVOT_COLUMNS, B.REVENUE_MEASURE: "revenue"}
KEYWORDS = ["ring", "widget"]
SINCE_YEAR = 2000
#: Percentiles are exact elements up to so many filings a year.
AUDIT_ACCURACY = 1_000_000
LOOKUP_JURISDICTION = "NATION_7"
LOOKUP_ID = "NATION_7_1995"
PRICE_PERCENTILES = {f"price_p{round(100 * p)}": ("l_extendedprice", p) for p in (0.1, 0.5, 0.95, 0.99)}
BUCKETS = 16


# --- join, pivot, metrics ------------------------------------------------------


def q_aggregate_totals(spark, sf):
    return B.long_facts(spark, sf).transform(op.aggregate_totals)


def q_pivot_measures(spark, sf):
    return B.long_facts(spark, sf).transform(op.aggregate_totals).transform(op.pivot_measures)


def q_effective_rate(spark, sf):
    return q_pivot_measures(spark, sf).transform(op.effective_rate)


def q_statutory_rates(spark, sf):
    return op.statutory_rates(B.rates_long(spark, sf))


def q_tax_rates_with_id(spark, sf):
    return op.tax_rates_with_id(B.rates_long(spark, sf))


def q_effective_vs_statutory(spark, sf):
    return B.merged(spark, sf)


def q_top_gap(spark, sf):
    return op.top_gap(B.merged(spark, sf, sort=False))


def q_year_percentiles(spark, sf):
    return op.year_percentiles(B.merged(spark, sf, sort=False), accuracy=AUDIT_ACCURACY)


def q_year_percentiles_exact(spark, sf):
    return op.exact_percentiles(B.merged(spark, sf, sort=False), "year", AUDIT_THRESHOLDS)


def q_price_percentiles(spark, sf):
    return op.exact_percentiles(B.table(spark, sf, "lineitem"), "l_returnflag", PRICE_PERCENTILES)


def q_audit_candidates(spark, sf):
    return op.audit_candidates(B.stored_merged(spark, sf), accuracy=AUDIT_ACCURACY)


def q_jurisdictions_dim(spark, sf):
    return op.jurisdictions_dim(B.merged(spark, sf, sort=False))


def q_quality_rules(spark, sf):
    filings = B.long_facts(spark, sf, with_revenue=True).transform(op.pivot_measures, QUALITY_MEASURES)
    return op.quality_rules(filings)


# --- landed CSV: scan, rename, cast, stamp, clean ------------------------------


def q_scan_labelled_csv(spark, sf):
    return read_labelled_csv(spark, B.land_facts(spark, sf))


def q_select_rename(spark, sf):
    return read_labelled_csv(spark, B.land_facts(spark, sf)).transform(op.select_rename, L.FACT_COLUMNS)


def q_stamp_ingest_time(spark, sf):
    path = B.land_facts(spark, sf)
    return read_labelled_csv(spark, path, select=L.FACT_COLUMNS).transform(
        op.stamp_ingest_time, read_ingest_stamp(spark, path)
    )


def q_drop_incomplete(spark, sf):
    return (
        read_labelled_csv(spark, B.land_facts(spark, sf), select=L.FACT_COLUMNS)
        .transform(op.cast_types, {"year": "int", "obs_value": "double"})
        .transform(op.drop_incomplete, L.FACT_NOT_NULL)
    )


def q_clean_facts(spark, sf):
    path = B.land_facts(spark, sf)
    return op.clean_facts(read_labelled_csv(spark, path), ingested_at=read_ingest_stamp(spark, path))


def q_clean_step_counts(spark, sf):
    return op.clean_step_counts(read_labelled_csv(spark, B.land_facts(spark, sf)))


def q_clean_rate_step_counts(spark, sf):
    return op.clean_step_counts(
        read_labelled_csv(spark, B.land_rates(spark, sf)), L.RATE_COLUMNS, L.RATE_KEYS, L.RATE_NOT_NULL,
        {"year": "int", "tax_rate": "double"},
    )


def q_clean_rates(spark, sf):
    return op.clean_rates(read_labelled_csv(spark, B.land_rates(spark, sf)))


def q_clean_facts_counts(spark, sf):
    counts = scratch_path(spark, "facts_counts")
    clean_facts_job(spark, B.land_facts(spark, sf), scratch_path(spark, "facts"), counts=counts)
    return read_table(spark, counts)


def q_clean_rates_counts(spark, sf):
    counts = scratch_path(spark, "rates_counts")
    clean_rates_job(spark, B.land_rates(spark, sf), scratch_path(spark, "rates"), counts=counts)
    return read_table(spark, counts)


def q_landing_rejects(spark, sf):
    rejects = scratch_path(spark, "rejects")
    clean_facts_job(spark, B.land_cut_facts(spark, sf), scratch_path(spark, "facts"), rejects=rejects)
    return read_table(spark, rejects).select("line")


def q_clean_without_rejects(spark, sf):
    facts = scratch_path(spark, "facts")
    clean_facts_job(spark, B.land_cut_facts(spark, sf), facts, rejects=scratch_path(spark, "rejects"))
    return read_table(spark, facts, FACTS_CLEAN).drop("_ingested_at")


def q_column_profile(spark, sf):
    return op.column_profile(read_labelled_csv(spark, B.land_facts(spark, sf)))


# --- table and CSV sinks ----------------------------------------------------------


def q_table_roundtrip(spark, sf):
    path = scratch_path(spark, "effective_vs_statutory")
    write_table(B.merged(spark, sf, sort=False), path, partition_by=["year"])
    return read_table(spark, path, schema=EFFECTIVE_VS_STATUTORY)


def q_csv_export_roundtrip(spark, sf):
    path = scratch_path(spark, "effective_vs_statutory_csv")
    export_csv(B.merged(spark, sf), path)
    return read_csv_export(spark, path, EFFECTIVE_VS_STATUTORY)


# --- events: casts, dedup, late data ---------------------------------------------


def _events(spark, sf):
    return B.table(spark, sf, "events")



def q_safe_cast(spark, sf):
    k = F.get_json_object("props", "$.k")
    return _events(spark, sf).select(
        "event_id",
        k.try_cast("int").alias("k_int"),
        k.try_cast("double").alias("k_double"),
        F.col("event_type").try_cast("int").alias("event_type_int"),
    )


def q_dedup_latest(spark, sf):
    return op.dedup_latest(_events(spark, sf), EVENT_KEYS, "ts", tiebreak=[F.col("event_id").desc()])


def q_dedup_any(spark, sf):
    return op.dedup_any(_events(spark, sf), EVENT_KEYS, tiebreak=[F.col("event_id").asc()])


def q_late_arrival_split(spark, sf):
    return op.late_arrival_counts(_events(spark, sf), "ts", as_of=EVENTS_AS_OF)


def _arriving_events(spark, sf):
    """Events of which one in seven has lost its load time."""
    return _events(spark, sf).withColumn("ts", F.when(F.col("event_id") % 7 != 3, F.col("ts")))


def q_incremental_snapshot(spark, sf):
    return op.incremental_snapshot(
        _arriving_events(spark, sf), EVENT_KEYS, "ts", as_of=EVENTS_AS_OF, tiebreak=[F.col("event_id").desc()], arrival="arrival"
    )


def q_snapshot_merge(spark, sf):
    on_time, late = op.late_arrival_split(_arriving_events(spark, sf), "ts", as_of=EVENTS_AS_OF)
    tiebreak = [F.col("event_id").desc()]
    snapshot = op.dedup_latest(on_time, EVENT_KEYS, "ts", tiebreak)
    restated = late.withColumn("value", F.col("value") + 1000)
    lost = _arriving_events(spark, sf).where("ts is null").withColumn("value", F.lit(-1.0))
    return op.merge_into_snapshot(snapshot, restated.unionByName(lost), EVENT_KEYS, "ts", tiebreak)


def q_partition_merge(spark, sf):
    # NATION_5 reports without a year: the null partition
    year = F.when(F.col("jurisdiction") != "NATION_5", F.col("year"))
    facts = B.long_facts(spark, sf).groupBy("jurisdiction", "counterpart_jurisdiction", "measure", year.alias("year")).agg(F.max("obs_value").alias("obs_value")).select(
        "jurisdiction", "counterpart_jurisdiction", "measure", "year",
        F.col("obs_value").cast("double").alias("obs_value"),
        F.to_timestamp(F.lit(B.LANDED_AT_UTC)).alias("_ingested_at"),
    )
    snapshot = scratch_path(spark, "snapshot")
    write_table(facts, snapshot, partition_by=["year"])
    stored = read_table(spark, snapshot, FACTS_CLEAN)
    # a late restatement of the latest period, loaded after the snapshot
    latest = stored.select(F.max("year")).scalar()
    lost = F.col("year").isNull() & (F.col("measure") == L.TAX_PAID_MEASURE)
    batch = stored.filter((F.col("year") == latest) | lost).withColumns(
        {"obs_value": F.col("obs_value") + 1, "_ingested_at": F.to_timestamp(F.lit(B.RESTATED_AT_UTC))}
    )
    merge_late_job(spark, snapshot, batch)
    return read_table(spark, snapshot, FACTS_CLEAN)


# --- filters ---------------------------------------------------------------------


def q_filter_keywords(spark, sf):
    return op.filter_keywords(B.table(spark, sf, "part"), "p_name", KEYWORDS).select("p_partkey", "p_name")


def q_since_period(spark, sf):
    orders = B.table(spark, sf, "orders")
    return op.since_period(orders, "o_orderdate", SINCE_YEAR).select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").cast("int").alias("year")
    )


# --- JSON-stat -------------------------------------------------------------------


def q_json_stat_decode(spark, sf):
    docs = read_json_stat_documents(spark, B.land_json_stat(spark, sf))
    return op.decode_json_stat(docs, B.JSON_STAT_DIMENSIONS)


def q_json_stat_clean(spark, sf):
    return op.clean_ratio(q_json_stat_decode(spark, sf))


def q_json_stat_ranges(spark, sf):
    pieces = read_json_stat_ranges(spark, B.land_json_stat(spark, sf))
    return op.decode_json_stat_ranges(pieces, B.JSON_STAT_DIMENSIONS)


# --- lookups, links, flags ----------------------------------------------------------


def _flags(spark, sf, filings):
    return op.flag_filings(filings, flagged_by=B.FLAGGED_BY, flagged_at=F.to_timestamp(F.lit(B.FLAGGED_AT_UTC)))


def q_lookup_filing(spark, sf):
    path = scratch_path(spark, "filings")
    write_table(B.merged(spark, sf, sort=False), path, partition_by=["jurisdiction"])
    # only the folder of that jurisdiction is read
    return op.lookup(read_table(spark, path, EFFECTIVE_VS_STATUTORY), jurisdiction=LOOKUP_JURISDICTION)


def q_lookup_by_id(spark, sf):
    path = scratch_path(spark, "filings_by_id")
    write_lookup_table(B.merged(spark, sf, sort=False), path, ["id", "jurisdiction"])
    return op.lookup(read_table(spark, path, EFFECTIVE_VS_STATUTORY), id=LOOKUP_ID)


def q_ordered_report(spark, sf):
    path = scratch_path(spark, "gap_order")
    write_ordered(B.merged(spark, sf, sort=False), path, *gap_order())
    return read_ordered(spark, path)


def _bucketed(spark, df, name, *keys):
    path = scratch_path(spark, name)
    table = path.rstrip("/").rsplit("/", 1)[1].replace("-", "_")
    write_bucketed(df, table, path, keys, BUCKETS)
    return spark.table(table)


def q_bucketed_links(spark, sf):
    """The three links of the stored tables, each side bucketed on the link's key; rows say which link they are of."""
    m = B.stored_merged(spark, sf)
    by_id, by_place = _bucketed(spark, m, "filings_by_id", "id"), _bucketed(spark, m, "filings_by_jurisdiction", "jurisdiction")
    flags = _bucketed(spark, _flags(spark, sf, m), "flags_by_filing", "filing_id")
    dim = _bucketed(spark, op.jurisdictions_dim(m), "jurisdictions", "jurisdiction")
    rates = _bucketed(spark, op.tax_rates_with_id(B.rates_long(spark, sf)), "rates_by_jurisdiction", "jurisdiction")
    links = {"filing_flags": op.link_filing_flags(by_id, flags), "filing_jurisdiction": op.link_filing_jurisdiction(by_place, dim), "rate_jurisdiction": op.link_rate_jurisdiction(rates, dim)}
    none = F.lit(None).cast("string")
    out = [
        df.select(F.lit(name).alias("link"), "id", "jurisdiction", "year", *[(F.col(c) if c in df.columns else none).alias(c) for c in ("flag_id", "reason")])
        for name, df in links.items()
    ]
    return out[0].unionByName(out[1]).unionByName(out[2])


def q_link_filing_jurisdiction(spark, sf):
    m = B.stored_merged(spark, sf)
    return op.link_filing_jurisdiction(m, op.jurisdictions_dim(m))


def q_link_filing_flags(spark, sf):
    m = B.stored_merged(spark, sf)
    return op.link_filing_flags(m, _flags(spark, sf, m))


def q_link_rate_jurisdiction(spark, sf):
    m = B.merged(spark, sf, sort=False)
    return op.link_rate_jurisdiction(op.tax_rates_with_id(B.rates_long(spark, sf)), op.jurisdictions_dim(m))


def q_flag_filings(spark, sf):
    path = scratch_path(spark, "audit_flags")
    flags = _flags(spark, sf, B.stored_merged(spark, sf))
    op.init_audit_log(spark, path)
    # every flag twice in one batch, then the batch again: the log has it once
    op.append_flags(spark, flags.unionByName(flags), path)
    op.append_flags(spark, flags, path)
    return op.read_audit_log(spark, path)


def q_report_outputs(spark, sf):
    facts = B.long_facts(spark, sf).withColumn("obs_value", F.col("obs_value").cast("double"))
    paths = run_report(spark, facts, B.rates_long(spark, sf), scratch_path(spark, "report"))
    out = None
    for name in OUTPUTS:
        table = spark.read.parquet(paths[name])
        part = table.select(F.lit(name).alias("output"), "jurisdiction", (F.col("year") if "year" in table.columns else F.lit(None)).cast("int").alias("year"))
        out = part if out is None else out.unionByName(part)
    return out


def q_sample_values(spark, sf):
    first = B.table(spark, sf, "events").orderBy("event_id").select("event_id", "event_type", F.when(F.col("event_id") % 3 != 1, F.col("value")).alias("value"))
    return op.sample_values(first, n=6).withColumn("sample_values", F.concat_ws(",", F.transform("sample_values", lambda v: F.coalesce(v, F.lit("null")))))


# --- listings and profile ------------------------------------------------------------


def _sources(spark, sf):
    return {"facts": B.long_facts(spark, sf), "rates": B.rates_long(spark, sf)}


def q_measure_listing(spark, sf):
    return op.measure_listing(_sources(spark, sf))


def q_year_range(spark, sf):
    return op.year_range(_sources(spark, sf))


def q_distinct_sample(spark, sf):
    return op.distinct_sample(_sources(spark, sf), "jurisdiction", 10)


QUERIES: dict[str, Query] = {
    "effective_vs_statutory": q_effective_vs_statutory,
    "aggregate_totals": q_aggregate_totals,
    "pivot_measures": q_pivot_measures,
    "effective_rate": q_effective_rate,
    "statutory_rates": q_statutory_rates,
    "tax_rates_with_id": q_tax_rates_with_id,
    "top_gap": q_top_gap,
    "year_percentiles": q_year_percentiles,
    "year_percentiles_exact": q_year_percentiles_exact,
    "price_percentiles": q_price_percentiles,
    "audit_candidates": q_audit_candidates,
    "jurisdictions_dim": q_jurisdictions_dim,
    "quality_rules": q_quality_rules,
    "scan_labelled_csv": q_scan_labelled_csv,
    "landing_rejects": q_landing_rejects,
    "clean_without_rejects": q_clean_without_rejects,
    "clean_facts_counts": q_clean_facts_counts,
    "clean_rates_counts": q_clean_rates_counts,
    "select_rename": q_select_rename,
    "stamp_ingest_time": q_stamp_ingest_time,
    "drop_incomplete": q_drop_incomplete,
    "clean_facts": q_clean_facts,
    "clean_step_counts": q_clean_step_counts,
    "clean_rates": q_clean_rates,
    "clean_rate_step_counts": q_clean_rate_step_counts,
    "column_profile": q_column_profile,
    "table_roundtrip": q_table_roundtrip,
    "csv_export_roundtrip": q_csv_export_roundtrip,
    "safe_cast": q_safe_cast,
    "dedup_latest": q_dedup_latest,
    "dedup_any": q_dedup_any,
    "late_arrival_split": q_late_arrival_split,
    "incremental_snapshot": q_incremental_snapshot,
    "snapshot_merge": q_snapshot_merge,
    "partition_merge": q_partition_merge,
    "filter_keywords": q_filter_keywords,
    "since_period": q_since_period,
    "json_stat_decode": q_json_stat_decode,
    "json_stat_clean": q_json_stat_clean,
    "json_stat_ranges": q_json_stat_ranges,
    "lookup_filing": q_lookup_filing,
    "lookup_by_id": q_lookup_by_id,
    "ordered_report": q_ordered_report,
    "bucketed_links": q_bucketed_links,
    "link_filing_jurisdiction": q_link_filing_jurisdiction,
    "link_filing_flags": q_link_filing_flags,
    "link_rate_jurisdiction": q_link_rate_jurisdiction,
    "flag_filings": q_flag_filings,
    "report_outputs": q_report_outputs,
    "sample_values": q_sample_values,
    "measure_listing": q_measure_listing,
    "year_range": q_year_range,
    "distinct_sample": q_distinct_sample,
}
