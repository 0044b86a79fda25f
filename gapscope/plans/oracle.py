"""DuckDB SQL computing what each registered query must return.

Written independently of the Spark code: plain joins, ``group by`` with
``filter`` clauses for the pivot, ``qualify`` for dedup, ``quantile_disc``
for percentiles. Column names match the Spark outputs.
"""

from __future__ import annotations

from gapscope import labels as L
from gapscope.plans import bindings as B


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


PROFIT, TAXP, EMP, MNE = (_q(m) for m in L.PIVOT_COLUMNS)
STAT = _q(L.STATUTORY_MEASURE)
COMB = _q(B.COMBINED_RATE_MEASURE)
REV = _q(B.REVENUE_MEASURE)
REASON = _q(L.GAP_FLAG_REASON)

_CTES = {
    "li": """li as (
  select cn.n_name as jurisdiction, sn.n_name as counterpart_jurisdiction,
         cast(year(o_orderdate) as integer) as year, l_suppkey,
         cast(l_extendedprice as decimal(12,2)) * (cast(1 as decimal(3,2)) - cast(l_discount as decimal(3,2))) as rev,
         cast(l_tax as decimal(3,2)) as tx, cast(l_quantity as decimal(6,0)) as qty
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join nation cn on c_nationkey = cn.n_nationkey
  join supplier on l_suppkey = s_suppkey
  join nation sn on s_nationkey = sn.n_nationkey)""",
    "w": """w as (
  select jurisdiction, counterpart_jurisdiction, year,
         sum(rev - qty * 1300) as p, sum(rev * tx) as t, sum(qty) as e,
         count(distinct l_suppkey) as m, sum(rev) as r
  from li group by jurisdiction, counterpart_jurisdiction, year)""",
    "lng": f"""lng as (
  select jurisdiction, counterpart_jurisdiction, {PROFIT} as measure, year, cast(p as decimal(38,6)) as obs_value from w
  union all select jurisdiction, counterpart_jurisdiction, {TAXP}, year, cast(t as decimal(38,6)) from w
  union all select jurisdiction, counterpart_jurisdiction, {EMP}, year, cast(e as decimal(38,6)) from w
  union all select jurisdiction, counterpart_jurisdiction, {MNE}, year, cast(m as decimal(38,6)) from w)""",
    "lngr": f"""lngr as (
  select * from lng
  union all select jurisdiction, counterpart_jurisdiction, {REV}, year, cast(r as decimal(38,6)) from w)""",
    "yr": """yr as (select min(year(o_orderdate)) as lo, max(year(o_orderdate)) as hi from orders)""",
    "st": f"""st as (
  select jurisdiction, cast(y as integer) as year, cast(9 + (nk * 7 + y) % 23 as double) as statutory_rate
  from (select n_name as jurisdiction, n_nationkey as nk, unnest(generate_series(lo, hi)) as y
        from nation, yr where n_nationkey <> {B.UNMATCHED_NATION}))""",
    "rates": f"""rates as (
  select jurisdiction, {STAT} as measure, year, statutory_rate as tax_rate from st
  union all select jurisdiction, {COMB}, year, statutory_rate + 2.5 from st)""",
    "stat": f"""stat as (select jurisdiction, year, tax_rate as statutory_rate from rates where measure = {STAT})""",
    "pv": f"""pv as (
  select jurisdiction, year,
    cast(sum(obs_value) filter (where measure = {PROFIT}) as double) as profit_before_tax,
    cast(sum(obs_value) filter (where measure = {TAXP}) as double) as tax_paid,
    cast(sum(obs_value) filter (where measure = {EMP}) as double) as employees,
    cast(sum(obs_value) filter (where measure = {MNE}) as double) as mne_group_count
  from lng where measure in ({PROFIT}, {TAXP}, {EMP}, {MNE}) group by jurisdiction, year)""",
    "fl": """fl as (
  select *, case when profit_before_tax > 0 then tax_paid / profit_before_tax end as effective_tax_rate,
            case when employees > 0 then profit_before_tax / employees end as profit_per_employee
  from pv)""",
    "mg": """mg as (
  select fl.jurisdiction, fl.year, profit_before_tax, tax_paid, employees, mne_group_count,
         effective_tax_rate, profit_per_employee, stat.statutory_rate,
         effective_tax_rate * 100 as effective_tax_rate_pct,
         stat.statutory_rate - effective_tax_rate * 100 as gap_statutory_minus_effective,
         concat_ws('_', fl.jurisdiction, cast(fl.year as varchar)) as id
  from fl join stat on fl.jurisdiction = stat.jurisdiction and fl.year = stat.year)""",
    "th": """th as (
  select year, quantile_disc(employees, 0.5) as median_employees_year,
         quantile_disc(profit_per_employee, 0.75) as q3_profit_per_employee_year
  from mg group by year)""",
    "flags": f"""flags as (
  select sha256(id || '|' || {REASON}) as flag_id, id as filing_id, {REASON} as reason,
         {_q(B.FLAGGED_BY)} as flagged_by, timestamp '{B.FLAGGED_AT_UTC[:10]} {B.FLAGGED_AT_UTC[11:19]}' as flagged_at, 'OPEN' as status
  from mg where gap_statutory_minus_effective > {L.GAP_FLAG_THRESHOLD})""",
    "dim": """dim as (select distinct jurisdiction from mg)""",
    "base": """base as (
  select jurisdiction as ra, counterpart_jurisdiction as ca, measure as me, upper(substr(measure, 1, 3)) as mc,
         cast(year as varchar) as tp, cast(obs_value as varchar) as ov, 'A' as os
  from lng)""",
    "rawf": f"""rawf as (
  select * from base
  union all select ra, ca, me, mc, tp || '-Q1', ov, os from base where ra = ca
  union all select ra, ca, me, mc, tp, 'n/a', os from base where ra = ca
  union all select ra, ca, me, mc, tp, null, os from base where ra = ca
  union all select * from base where me = {EMP})""",
    "typed": """typed as (
  select ra as jurisdiction, ca as counterpart_jurisdiction, me as measure,
         try_cast(tp as integer) as year, try_cast(ov as double) as obs_value
  from rawf)""",
    "cube": f"""cube as (
  select o_orderstatus as na_item,
         case when o_orderstatus = 'F' then {_q(L.TAX_CATEGORY_KEYWORDS[0])} else 'Other receipts (' || o_orderstatus || ')' end as na_item_label,
         o_orderpriority as unit,
         case when o_orderpriority like '1%' then {_q(L.UNIT_OF_MEASURE_KEYWORDS[0])} else 'Unit ' || o_orderpriority end as unit_label,
         'C' || cast(o_custkey as varchar) as geo,
         case when o_custkey % 3 <> 0 then 'Customer ' else 'C' end || cast(o_custkey as varchar) as geo_label,
         cast(year(o_orderdate) as varchar) as time, cast(year(o_orderdate) as varchar) as time_label,
         cast(count(*) as double) as obs_value
  from orders
  group by all)""",
    "lb": """lb as (select date '2024-01-23' as cutoff)""",
    "arriving": """arriving as (
  select event_id, case when event_id % 7 <> 3 then ts end as ts, user_id, event_type, value, props from events)""",
}

_DEPS = {
    "w": ["li"], "lng": ["w"], "lngr": ["lng"], "st": ["yr"], "rates": ["st"], "stat": ["rates"],
    "pv": ["lng"], "fl": ["pv"], "mg": ["fl", "stat"], "th": ["mg"], "flags": ["mg"], "dim": ["mg"],
    "base": ["lng"], "rawf": ["base"], "typed": ["rawf"],
}


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "with " + ",\n".join(_CTES[n] for n in order) + "\n"


_MG_COLS = ("jurisdiction, year, profit_before_tax, tax_paid, employees, mne_group_count, effective_tax_rate, "
            "profit_per_employee, statutory_rate, effective_tax_rate_pct, gap_statutory_minus_effective, id")

_RULES = [
    ("profit_before_tax_non_negative", "profit_before_tax >= 0"),
    ("tax_paid_le_profit", "tax_paid <= profit_before_tax"),
    ("revenue_ge_profit", "revenue >= profit_before_tax"),
]

_PROFILE_COLS = [
    ("Reference area", "ra"), ("Counterpart area", "ca"), ("Measure", "me"), ("MEASURE_3", "mc"),
    ("TIME_PERIOD", "tp"), ("OBS_VALUE", "ov"), ("OBS_STATUS", "os"),
]


def _profile_sql() -> str:
    parts = []
    for i, (name, c) in enumerate(_PROFILE_COLS):
        low = name.lower()
        year_like = "true" if ("period" in low or "time" in low) else "false"
        value_like = "true" if ("obs" in low or "value" in low) else "false"
        parts.append(
            f"select {_q(name)} as column_name, {i} as position, count(*) as n_rows, "
            f"count(*) filter (where {c} is null) as n_null, count(distinct {c}) as n_distinct, "
            f"min({c}) as min_value, max({c}) as max_value, {year_like} as year_like, {value_like} as value_like from rawf"
        )
    return _with("rawf") + "\nunion all\n".join(parts)


def _quality_sql() -> str:
    pvr = f"""pvr as (
  select jurisdiction, year,
    cast(sum(obs_value) filter (where measure = {PROFIT}) as double) as profit_before_tax,
    cast(sum(obs_value) filter (where measure = {TAXP}) as double) as tax_paid,
    cast(sum(obs_value) filter (where measure = {EMP}) as double) as employees,
    cast(sum(obs_value) filter (where measure = {MNE}) as double) as mne_group_count,
    cast(sum(obs_value) filter (where measure = {REV}) as double) as revenue
  from lngr where measure in ({PROFIT}, {TAXP}, {EMP}, {MNE}, {REV}) group by jurisdiction, year)"""
    parts = [
        f"select {_q(n)} as rule, count(*) filter (where {p}) as n_pass, count(*) filter (where not ({p})) as n_fail, "
        f"count(*) filter (where ({p}) is null) as n_unknown from pvr"
        for n, p in _RULES
    ]
    return _with("lngr") + ", " + pvr + "\n" + "\nunion all\n".join(parts)


_KEYS = "jurisdiction, counterpart_jurisdiction, measure, year"

ORACLE: dict[str, str] = {
    "effective_vs_statutory": _with("mg") + f"select {_MG_COLS} from mg",
    "aggregate_totals": _with("lng") + "select jurisdiction, year, measure, cast(sum(obs_value) as double) as obs_value "
                                      "from lng group by jurisdiction, year, measure",
    "pivot_measures": _with("pv") + "select * from pv",
    "effective_rate": _with("fl") + "select * from fl",
    "statutory_rates": _with("stat") + "select jurisdiction, year, statutory_rate from stat",
    "tax_rates_with_id": _with("stat") + "select jurisdiction, year, statutory_rate, "
                                        "concat_ws('_', jurisdiction, cast(year as varchar)) as id from stat",
    "top_gap": _with("mg") + f"select {_MG_COLS} from mg order by gap_statutory_minus_effective desc nulls last, "
                             "jurisdiction, year limit 10",
    "year_percentiles": _with("th") + "select * from th",
    "year_percentiles_exact": _with("th") + "select * from th",
    "price_percentiles": "select l_returnflag, quantile_disc(l_extendedprice, 0.1) as price_p10, quantile_disc(l_extendedprice, 0.5) as price_p50, "
                         "quantile_disc(l_extendedprice, 0.95) as price_p95, quantile_disc(l_extendedprice, 0.99) as price_p99 from lineitem group by l_returnflag",
    "audit_candidates": _with("mg", "th") + f"select mg.*, th.median_employees_year, th.q3_profit_per_employee_year, "
                        "true as audit_signal from mg join th on mg.year = th.year "
                        "where mg.employees > th.median_employees_year "
                        "and mg.profit_per_employee >= th.q3_profit_per_employee_year",
    "jurisdictions_dim": _with("dim") + "select jurisdiction from dim",
    "quality_rules": _quality_sql(),
    "scan_labelled_csv": _with("rawf") + 'select ra as "Reference area", ca as "Counterpart area", me as "Measure", '
                         'mc as "MEASURE_3", tp as "TIME_PERIOD", ov as "OBS_VALUE", os as "OBS_STATUS" from rawf',
    "select_rename": _with("rawf") + "select ra as jurisdiction, ca as counterpart_jurisdiction, me as measure, "
                     "tp as year, ov as obs_value from rawf",
    "stamp_ingest_time": _with("rawf") + "select ra as jurisdiction, ca as counterpart_jurisdiction, me as measure, "
                         f"tp as year, ov as obs_value, timestamp '{B.LANDED_AT_UTC[:10]} {B.LANDED_AT_UTC[11:19]}' "
                         "as _ingested_at from rawf",
    "drop_incomplete": _with("typed") + "select * from typed where jurisdiction is not null and year is not null "
                       "and obs_value is not null",
    "clean_facts": _with("typed") + "select *, timestamp "
                   f"'{B.LANDED_AT_UTC[:10]} {B.LANDED_AT_UTC[11:19]}' as _ingested_at from typed "
                   "where jurisdiction is not null and year is not null and obs_value is not null "
                   f"qualify row_number() over (partition by {_KEYS} order by obs_value) = 1",
    "clean_step_counts": _with("typed") + "select count(*) as raw_rows, "
                         "count(*) filter (where year is null) as null_year, "
                         "count(*) filter (where obs_value is null) as null_obs_value, "
                         "count(*) filter (where jurisdiction is not null and year is not null and obs_value is not null) as after_dropna, "
                         f"(select count(*) from (select distinct {_KEYS} from typed where jurisdiction is not null "
                         "and year is not null and obs_value is not null)) as after_dedup from typed",
    "landing_rejects": _with("rawf") + f"select case when me = {_q(L.EMPLOYEES_MEASURE)} then concat_ws(',', ra, ca, me) "
                       "else concat_ws(',', ra, ca, me, mc, tp, coalesce(ov, ''), os) || ',more' end as line from rawf "
                       f"where ra = ca and me in ({_q(L.EMPLOYEES_MEASURE)}, {_q(L.TAX_PAID_MEASURE)})",
    "clean_without_rejects": _with("typed") + f"select {_KEYS}, obs_value from typed "
                             "where jurisdiction is not null and year is not null and obs_value is not null and not (jurisdiction = counterpart_jurisdiction "
                             f"and measure in ({_q(L.EMPLOYEES_MEASURE)}, {_q(L.TAX_PAID_MEASURE)})) "
                             f"qualify row_number() over (partition by {_KEYS} order by obs_value) = 1",
    "clean_rates": _with("rates") + "select distinct jurisdiction, measure, year, tax_rate from rates",
    "clean_rate_step_counts": _with("rates") + ", landed as (select * from rates union all select * from rates) "
                              "select count(*) as raw_rows, count(*) filter (where year is null) as null_year, "
                              "count(*) filter (where tax_rate is null) as null_tax_rate, "
                              "count(*) filter (where jurisdiction is not null and year is not null and tax_rate is not null) as after_dropna, "
                              "(select count(*) from (select distinct jurisdiction, measure, year from landed "
                              "where jurisdiction is not null and year is not null and tax_rate is not null)) as after_dedup "
                              "from landed",
    "column_profile": _profile_sql(),
    "table_roundtrip": _with("mg") + f"select {_MG_COLS} from mg",
    "csv_export_roundtrip": _with("mg") + f"select {_MG_COLS} from mg",
    "safe_cast": "select event_id, try_cast(json_extract_string(props, '$.k') as integer) as k_int, "
                 "try_cast(json_extract_string(props, '$.k') as double) as k_double, "
                 "try_cast(event_type as integer) as event_type_int from events",
    "dedup_latest": "select * from events qualify row_number() over "
                    "(partition by user_id, event_type order by ts desc nulls last, event_id desc) = 1",
    "dedup_any": "select * from events qualify row_number() over "
                 "(partition by user_id, event_type order by event_id asc) = 1",
    "late_arrival_split": _with("lb") + "select coalesce(case when cast(ts as date) >= cutoff then 'late' "
                          "when cast(ts as date) < cutoff then 'on_time' end, 'no_timestamp') as arrival, "
                          "count(*) as n_rows from events, lb group by 1",
    "incremental_snapshot": _with("arriving") + "select *, case when ts >= timestamp '2024-01-23' then 'late' else 'on_time' end as arrival "
                            "from arriving where ts is not null qualify row_number() over "
                            "(partition by user_id, event_type order by ts desc, event_id desc) = 1",
    "snapshot_merge": _with("arriving") + "select event_id, ts, user_id, event_type, value + case when ts >= timestamp '2024-01-23' then 1000 else 0 end as value, props "
                      "from arriving where ts is not null qualify row_number() over "
                      "(partition by user_id, event_type order by ts desc, event_id desc) = 1",
    "partition_merge": _with("lng") + ", hi as (select max(year) as y from lng where jurisdiction <> 'NATION_5'), "
                       "stored as (select jurisdiction, counterpart_jurisdiction, measure, "
                       "case when jurisdiction <> 'NATION_5' then year end as year, cast(max(obs_value) as double) as v from lng group by 1, 2, 3, 4) "
                       "select jurisdiction, counterpart_jurisdiction, measure, year, "
                       f"v + case when year = hi.y or (year is null and measure = {TAXP}) then 1 else 0 end as obs_value, "
                       f"case when year = hi.y or (year is null and measure = {TAXP}) then timestamp '{B.RESTATED_AT_UTC[:10]} {B.RESTATED_AT_UTC[11:19]}' "
                       f"else timestamp '{B.LANDED_AT_UTC[:10]} {B.LANDED_AT_UTC[11:19]}' end as _ingested_at "
                       "from stored, hi",
    "filter_keywords": "select p_partkey, p_name from part where contains(p_name, 'ring') or contains(p_name, 'widget')",
    "since_period": "select o_orderkey, o_custkey, cast(year(o_orderdate) as integer) as year from orders "
                    "where o_orderdate >= timestamp '2000-01-01'",
    "json_stat_decode": _with("cube") + "select * from cube",
    "json_stat_ranges": _with("cube") + "select * from cube",
    "json_stat_clean": _with("cube") + "select geo as jurisdiction, geo_label as jurisdiction_name, "
                       "cast(time as integer) as year, obs_value as tax_to_gdp_ratio from cube "
                       "where na_item = 'F' and unit like '1%'",
    "lookup_filing": _with("mg") + f"select {_MG_COLS} from mg where jurisdiction = 'NATION_7'",
    "lookup_by_id": _with("mg") + f"select {_MG_COLS} from mg where id = 'NATION_7_1995'",
    "ordered_report": _with("mg") + f"select {_MG_COLS}, row_number() over (order by gap_statutory_minus_effective desc nulls last, jurisdiction, year) as position from mg",
    "bucketed_links": _with("mg", "flags", "dim", "stat") + "select 'filing_flags' as link, mg.id, mg.jurisdiction, mg.year, flags.flag_id, flags.reason "
                      "from mg left join flags on mg.id = flags.filing_id union all "
                      "select 'filing_jurisdiction', mg.id, mg.jurisdiction, mg.year, null, null from mg join dim on mg.jurisdiction = dim.jurisdiction union all "
                      "select 'rate_jurisdiction', concat_ws('_', stat.jurisdiction, cast(stat.year as varchar)), stat.jurisdiction, stat.year, null, null "
                      "from stat join dim on stat.jurisdiction = dim.jurisdiction",
    "link_filing_jurisdiction": _with("mg", "dim") + "select mg.jurisdiction, mg.id, mg.year from mg "
                                "join dim on mg.jurisdiction = dim.jurisdiction",
    "link_filing_flags": _with("mg", "flags") + "select mg.id, mg.jurisdiction, mg.year, flags.flag_id, flags.status, "
                         "flags.reason from mg left join flags on mg.id = flags.filing_id",
    "link_rate_jurisdiction": _with("stat", "mg", "dim") + "select concat_ws('_', stat.jurisdiction, cast(stat.year as varchar)) as id, "
                              "stat.jurisdiction, stat.year, stat.statutory_rate from stat "
                              "join dim on stat.jurisdiction = dim.jurisdiction",
    "flag_filings": _with("flags") + "select * from flags",
    "report_outputs": _with("mg", "th", "dim", "stat") + "select 'effective_vs_statutory' as output, jurisdiction, year from mg union all "
                      "(select 'top10_gap', jurisdiction, year from mg order by gap_statutory_minus_effective desc nulls last, jurisdiction, year limit 10) union all "
                      "select 'audit_candidates', mg.jurisdiction, mg.year from mg join th on mg.year = th.year "
                      "where employees > median_employees_year and profit_per_employee >= q3_profit_per_employee_year union all "
                      "select 'jurisdictions_dim', jurisdiction, null from dim union all select 'tax_rates_with_id', jurisdiction, year from stat",
    "sample_values": "with first as (select * from events order by event_id limit 6) "
                     "select 'event_id' as column_name, string_agg(cast(event_id as varchar), ',' order by event_id) as sample_values from first union all "
                     "select 'event_type', string_agg(event_type, ',' order by event_id) from first union all "
                     "select 'value', string_agg(case when event_id % 3 <> 1 then cast(value as varchar) else 'null' end, ',' order by event_id) from first",
    "measure_listing": _with("lng", "rates") + "select distinct 'facts' as source, measure from lng where measure is not null "
                       "union select distinct 'rates', measure from rates where measure is not null",
    "year_range": _with("lng", "rates") + "select 'facts' as source, min(year) as min_year, max(year) as max_year from lng "
                  "union all select 'rates', min(year), max(year) from rates",
    "distinct_sample": _with("lng", "rates") + "(select 'facts' as source, jurisdiction as value from "
                       "(select distinct jurisdiction from lng where jurisdiction is not null) order by 2 limit 10) "
                       "union all (select 'rates', jurisdiction from (select distinct jurisdiction from rates "
                       "where jurisdiction is not null) order by 2 limit 10)",
}
#: The jobs that count while they write return what the counting queries do.
ORACLE["clean_facts_counts"] = ORACLE["clean_step_counts"]
ORACLE["clean_rates_counts"] = ORACLE["clean_rate_step_counts"]
