"""Bindings of the tax-fact operators to the driver's TPC-H-style tables.

The driver tables hold no tax data, so the queries run on frames of the
same shape derived from them by Spark (work grows with the tables):

* long facts: one row per (customer nation, supplier nation, order year,
  measure); the "Reference area" is the customer's nation, the
  "Counterpart area" the supplier's. Sums are kept in ``decimal`` so every
  later sum is exact and ratios match other engines bit for bit.
* statutory rates: every nation but one (so the inner join drops rows)
  for every year in the order range, from scalar subqueries, no join.
* landings: the long facts written as a labelled CSV landing (with a
  side file, malformed copies and repeats), the rates landed twice, and
  one JSON-stat document per order year.

Binding-only labels (not taken from the source data) are marked below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapscope import labels as L
from gapscope.session import scratch_path, scratch_root

# binding-only labels
REVENUE_MEASURE = "Revenues"
COMBINED_RATE_MEASURE = "Combined corporate income tax rate"
UNMATCHED_NATION = 3
LANDED_AT_UTC = "2026-01-15T08:30:00Z"
FLAGGED_AT_UTC = "2026-01-15T09:00:00Z"
FLAGGED_BY = "rule:gap"
RESTATED_AT_UTC = "2026-02-01T00:00:00Z"

OBS = "decimal(38,6)"


# declared schemas of the driver tables: reads skip footer-based inference
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (jurisdiction, counterpart, year): profit, tax, employees, groups, revenue.

    Money is exact: prices, discounts and tax rates are rounded to whole
    cents (``rint(x * 100)``, the same cents as a ``decimal(12,2)`` cast for
    any amount with at most two decimals, at a quarter of the cost, since a
    double-to-decimal cast formats every value as text), then carried as
    scaled longs (revenue in 1e-4, tax in 1e-6). The per-line work and both
    first aggregation stay on primitive longs inside codegen; a long sum
    fails on overflow (ANSI), it never wraps. The sums per supplier are added
    up as ``decimal(38,0)``, so totals have no such limit.

    Plan: orders join customers (shuffled on the customer key; AQE splits a
    hot customer), then lineitem joins that on the order key (lineitem is
    shuffled once); the line stream is then pre-aggregated to
    (customer nation, supplier, year) *before* the supplier join, which
    shrinks it and turns the distinct supplier count into a plain count.
    Small sides are broadcast only when the planner's size check allows.
    """
    return fact_flows(*(table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "supplier", "nation")))


# One statement instead of ~40 DataFrame steps: the same plan, analysed once
# (planning is a visible share of a query at small scale). Orders meet
# customers first, so the 4x larger line stream is shuffled once, on the
# order key; the line stream is reduced per (customer nation, supplier,
# year) before the supplier join.
_FLOWS_SQL = """
with li as (
  select l_orderkey, l_suppkey,
         cast(rint(l_extendedprice * 100) as bigint) * (100 - cast(rint(l_discount * 100) as bigint)) as rev4,
         cast(rint(l_tax * 100) as bigint) as tax2,
         cast(rint(l_quantity) as bigint) as qty
  from {lineitem}),
order_nation as (
  select o_orderkey, cast(year(o_orderdate) as int) as year, c_nationkey
  from {orders} join {customer} on o_custkey = c_custkey),
per_supplier as (
  select c_nationkey, l_suppkey, year,
         sum(rev4 - qty * 13000000) as p4, sum(rev4 * tax2) as t6, sum(qty) as e, sum(rev4) as r4
  from li join order_nation on l_orderkey = o_orderkey
  group by c_nationkey, l_suppkey, year),
w as (
  select c_nationkey, s_nationkey, year,
         sum(cast(p4 as decimal(38,0))) as p4, sum(cast(t6 as decimal(38,0))) as t6, sum(e) as e,
         sum(cast(r4 as decimal(38,0))) as r4, count(1) as m
  from per_supplier join {supplier} on l_suppkey = s_suppkey
  group by c_nationkey, s_nationkey, year)
select cn.n_name as jurisdiction, sn.n_name as counterpart_jurisdiction, year,
       cast(p4 / 10000 as decimal(38,6)) as p,
       cast(t6 / 1000000 as decimal(38,6)) as t,
       cast(e as decimal(38,6)) as e,
       cast(m as decimal(38,6)) as m,
       cast(r4 / 10000 as decimal(38,6)) as r
from w
join {nation} cn on w.c_nationkey = cn.n_nationkey
join {nation} sn on w.s_nationkey = sn.n_nationkey
"""


def fact_flows(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, supplier: DataFrame,
               nation: DataFrame) -> DataFrame:
    """``flows`` over given frames (e.g. a skewed or filtered variant of the tables)."""
    spark = lineitem.sparkSession
    return spark.sql(_FLOWS_SQL, lineitem=lineitem, orders=orders, customer=customer, supplier=supplier, nation=nation)


def long_facts(spark: SparkSession, sf_dir: str, with_revenue: bool = False) -> DataFrame:
    """Clean-shaped long facts ``(jurisdiction, counterpart_jurisdiction, measure, year, obs_value decimal)``."""
    pairs = [(L.PROFIT_MEASURE, "p"), (L.TAX_PAID_MEASURE, "t"), (L.EMPLOYEES_MEASURE, "e"), (L.MNE_GROUPS_MEASURE, "m")]
    if with_revenue:
        pairs.append((REVENUE_MEASURE, "r"))
    w = flows(spark, sf_dir).select(
        "jurisdiction", "counterpart_jurisdiction", "year", *[F.col(c).cast(OBS).alias(lab) for lab, c in pairs]
    )
    return w.unpivot(
        ["jurisdiction", "counterpart_jurisdiction", "year"], [lab for lab, _ in pairs], "measure", "obs_value"
    ).select("jurisdiction", "counterpart_jurisdiction", "measure", "year", "obs_value")


def statutory_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(jurisdiction, year, statutory_rate)``: all nations but one, every order year.

    The year range comes from one scalar subquery over ``orders`` (partial
    min/max on every task), so no cross join is planned.
    """
    years = F.year("o_orderdate")
    span = table(spark, sf_dir, "orders").select(F.struct(F.min(years).alias("lo"), F.max(years).alias("hi"))).scalar()
    lo, hi = span.getField("lo"), span.getField("hi")
    nation = table(spark, sf_dir, "nation").filter(F.col("n_nationkey") != UNMATCHED_NATION)
    st = nation.select("n_nationkey", F.col("n_name").alias("jurisdiction"), F.explode(F.sequence(lo, hi)).alias("year"))
    return st.select(
        "jurisdiction",
        F.col("year").cast("int").alias("year"),
        (F.lit(9) + (F.col("n_nationkey") * 7 + F.col("year")) % 23).cast("double").alias("statutory_rate"),
    )


def rates_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean-shaped rates ``(jurisdiction, measure, year, tax_rate)`` with a second measure."""
    st = statutory_source(spark, sf_dir)
    stat = st.select("jurisdiction", F.lit(L.STATUTORY_MEASURE).alias("measure"), "year", F.col("statutory_rate").alias("tax_rate"))
    comb = st.select("jurisdiction", F.lit(COMBINED_RATE_MEASURE).alias("measure"), "year", (F.col("statutory_rate") + 2.5).alias("tax_rate"))
    return stat.unionByName(comb)


def merged(spark: SparkSession, sf_dir: str, sort: bool = True) -> DataFrame:
    from gapscope.operators.rates import effective_vs_statutory

    return effective_vs_statutory(long_facts(spark, sf_dir), rates_long(spark, sf_dir), sort=sort)


def stored_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged table materialized once, for plans that read it twice.

    A self-join or join-back would otherwise evaluate the fact aggregation
    twice (Spark reuses only identical exchanges, and the two branches get
    different inferred filters). ``checkpoint()`` writes it to the shared
    ``spark.checkpoint.dir`` and cuts the lineage, so a lost executor does
    not send the plan back to the line items.
    """
    scratch_root(spark)  # the configured folder; one is set only if none is
    return merged(spark, sf_dir, sort=False).checkpoint(eager=True)


# --- landings -----------------------------------------------------------------


def raw_fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts as a source would land them: labelled, all text.

    Besides one row per fact: for each domestic flow (jurisdiction equals
    counterpart) a copy with a quarterly period, one with ``n/a`` and one
    with an empty value (all must be dropped), and every Employees row
    twice (exact repeats the dedup must fold). ``MEASURE`` is a code column
    whose header differs from ``Measure`` only by case.
    """
    lng = long_facts(spark, sf_dir)
    tp = F.col("year").cast("string")
    ov = F.col("obs_value").cast("string")
    domestic = F.col("jurisdiction") == F.col("counterpart_jurisdiction")
    variant = lambda period, value, keep: F.struct(period.alias("tp"), value.alias("ov"), keep.alias("keep"))
    # one pass: every fact row expands into the copies it owns (no union,
    # so the fact aggregation below is planned once)
    variants = F.array(
        variant(tp, ov, F.lit(True)),
        variant(F.concat(tp, F.lit("-Q1")), ov, domestic),
        variant(tp, F.lit("n/a"), domestic),
        variant(tp, F.lit(None).cast("string"), domestic),
        variant(tp, ov, F.col("measure") == L.EMPLOYEES_MEASURE),
    )
    rows = lng.select("jurisdiction", "counterpart_jurisdiction", "measure",
                      F.explode(F.filter(variants, lambda v: v["keep"])).alias("v"))
    # internal names until the last projection: Spark resolves names
    # case-insensitively, so the two measure labels cannot coexist mid-plan
    return rows.select(
        F.col("jurisdiction").alias("ra"),
        F.col("counterpart_jurisdiction").alias("ca"),
        F.col("measure").alias("me"),
        F.upper(F.substring("measure", 1, 3)).alias("mc"),
        F.col("v.tp").alias("tp"),
        F.col("v.ov").alias("ov"),
        F.lit("A").alias("os"),
    )


RAW_FACT_LABELS = ["Reference area", "Counterpart area", "Measure", "MEASURE", "TIME_PERIOD", "OBS_VALUE", "OBS_STATUS"]


def land_facts(spark: SparkSession, sf_dir: str) -> str:
    """Write the raw fact landing (CSV + ``_ingest_metadata.json`` side file); return its folder."""
    path = scratch_path(spark, "facts_raw")
    raw = raw_fact_rows(spark, sf_dir)
    raw.toDF(*RAW_FACT_LABELS).write.option("header", True).csv(path)
    (
        spark.range(1)
        .select(F.lit(LANDED_AT_UTC).alias("ingested_at_utc"))
        .write.json(f"{path}/_ingest_metadata.json")
    )
    return path


#: Folders of the landing with malformed lines.
CUT_LANDING_PARTS = 16


def land_cut_facts(spark: SparkSession, sf_dir: str) -> str:
    """The fact landing as lines of which some end early (domestic employees) or have a field more (domestic tax); its folder.

    Each part is a folder with one file, whose first line is the header.
    """
    path = scratch_path(spark, "facts_cut")
    field = lambda c: F.coalesce(c, F.lit(""))
    raw = raw_fact_rows(spark, sf_dir).select("*", (F.col("ra") == F.col("ca")).alias("domestic"))
    short = F.concat_ws(",", "ra", "ca", "me")
    whole = F.concat_ws(",", *[field(c) for c in ("ra", "ca", "me", "mc", "tp", "ov", "os")])
    line = (F.when(F.col("domestic") & (F.col("me") == L.EMPLOYEES_MEASURE), short)
            .when(F.col("domestic") & (F.col("me") == L.TAX_PAID_MEASURE), F.concat(whole, F.lit(",more"))).otherwise(whole))
    lines = raw.select(F.pmod(F.hash("ra", "tp"), F.lit(CUT_LANDING_PARTS)).alias("part"), F.lit(1).alias("place"), line.alias("value"))
    heads = spark.range(CUT_LANDING_PARTS).select(F.col("id").cast("int").alias("part"), F.lit(0).alias("place"), F.lit(",".join(RAW_FACT_LABELS)).alias("value"))
    both = lines.unionByName(heads).repartition("part").sortWithinPartitions("part", "place")
    both.select("part", "value").write.partitionBy("part").text(path)
    return path


def land_rates(spark: SparkSession, sf_dir: str) -> str:
    """Write the rates landing twice into one folder (two identical pulls)."""
    path = scratch_path(spark, "rates_raw")
    raw = rates_long(spark, sf_dir).select(
        F.col("jurisdiction").alias("Reference area"),
        F.col("measure").alias("Measure"),
        F.col("year").cast("string").alias("TIME_PERIOD"),
        F.col("tax_rate").cast("string").alias("OBS_VALUE"),
    )
    raw.write.option("header", True).csv(path)
    raw.write.mode("append").option("header", True).csv(path)
    return path


# --- JSON-stat documents --------------------------------------------------------

JSON_STAT_DIMENSIONS = ["na_item", "unit", "geo", "time"]


#: Customers of one JSON-stat document.
CUSTOMERS_A_DOCUMENT = 5000


def order_cube_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order counts by (status, priority, customer, year), with category labels; ``block`` numbers runs of ``CUSTOMERS_A_DOCUMENT`` customers."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").cast("int").alias("year")
    )
    cells = orders.groupBy("year", "o_orderstatus", "o_orderpriority", "o_custkey").agg(F.count(F.lit(1)).cast("double").alias("n"))
    return cells.select(
        "year",
        F.expr(f"o_custkey div {CUSTOMERS_A_DOCUMENT}").alias("block"),
        F.col("o_orderstatus").alias("na_item"),
        F.when(F.col("o_orderstatus") == "F", F.lit(L.TAX_CATEGORY_KEYWORDS[0]))
        .otherwise(F.concat(F.lit("Other receipts ("), F.col("o_orderstatus"), F.lit(")")))
        .alias("na_item_label"),
        F.col("o_orderpriority").alias("unit"),
        F.when(F.col("o_orderpriority").startswith("1"), F.lit(L.UNIT_OF_MEASURE_KEYWORDS[0]))
        .otherwise(F.concat(F.lit("Unit "), F.col("o_orderpriority")))
        .alias("unit_label"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("geo"),
        # one customer in three has no label: decoders must fall back to the code
        F.when(F.col("o_custkey") % 3 != 0, F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"))).alias("geo_label"),
        "n",
    )


def json_stat_documents(cells: DataFrame) -> DataFrame:
    """One JSON-stat document per year and block of customers: ``(year, block, text)``.

    Even years: geo index as an out-of-order object, sparse values.
    Odd years: geo index as a list, dense values with nulls.
    ``time`` has labels but no index. The cube per document is bounded by
    the category counts (statuses x priorities x customers of a block), and the
    number of documents grows with the tables.
    """
    axes = cells.groupBy("year", "block").agg(
        F.array_sort(F.collect_set(F.struct("na_item", "na_item_label"))).alias("ni"),
        F.array_sort(F.collect_set(F.struct("unit", "unit_label"))).alias("un"),
        F.array_sort(F.collect_set(F.struct("geo", "geo_label"))).alias("ge"),
    ).select(
        "year", "block",
        F.transform("ni", lambda x: x["na_item"]).alias("ni_k"),
        F.transform("ni", lambda x: x["na_item_label"]).alias("ni_l"),
        F.transform("un", lambda x: x["unit"]).alias("un_k"),
        F.transform("un", lambda x: x["unit_label"]).alias("un_l"),
        F.transform("ge", lambda x: x["geo"]).alias("ge_k"),
        "ge",
    )
    # cells meet the small axes only; a customer's place is its rank within the document
    pos = lambda arr, v: (F.array_position(arr, v) - 1)
    place = F.dense_rank().over(Window.partitionBy("year", "block").orderBy("geo")) - 1
    small = axes.select("year", "block", "ni_k", "un_k", F.size("ge_k").alias("n_geo"))
    located = cells.withColumn("place", place).join(small, ["year", "block"]).select(
        "year", "block", "n",
        ((pos(F.col("ni_k"), F.col("na_item")) * F.size("un_k") + pos(F.col("un_k"), F.col("unit"))) * F.col("n_geo") + F.col("place")).alias("offset"),
    )
    docs = located.groupBy("year", "block").agg(F.map_from_entries(F.collect_list(F.struct("offset", "n"))).alias("vals")).join(axes, ["year", "block"])
    n_cells = F.size("ni_k") * F.size("un_k") * F.size("ge_k")
    even = (F.col("year") % 2) == 0
    seq = lambda arr: F.sequence(F.lit(0), F.size(arr) - 1)
    geo_labels = F.map_from_entries(
        F.transform(F.filter("ge", lambda x: x["geo_label"].isNotNull()), lambda x: F.struct(x["geo"], x["geo_label"]))
    )
    geo_index = F.when(even, F.to_json(F.map_from_arrays(F.reverse("ge_k"), F.reverse(seq(F.col("ge_k")))))).otherwise(
        F.to_json("ge_k")
    )
    sparse = F.to_json(F.map_from_entries(F.transform(F.map_entries("vals"), lambda e: F.struct(e["key"].cast("string"), e["value"]))))
    # the cells in order, with as many nulls between them as are missing
    entries = F.array_sort(F.map_entries("vals"))
    before = lambda e, i: F.when(i == 0, F.lit(-1)).otherwise(F.col("entries")[i - 1]["key"])
    filled = F.transform("entries", lambda e, i: F.concat(F.repeat(F.lit("null,"), (e["key"] - before(e, i) - 1).cast("int")), e["value"].cast("string")))
    rest = F.repeat(F.lit(",null"), (n_cells - 1 - F.element_at("entries", -1)["key"]).cast("int"))
    dense = F.concat(F.lit("["), F.array_join(filled, ","), rest, F.lit("]"))
    docs = docs.withColumn("entries", entries)
    y = F.col("year").cast("string")
    text = F.concat(
        F.lit('{"version":"2.0","class":"dataset","id":["na_item","unit","geo","time"],"size":'),
        F.to_json(F.array(F.size("ni_k"), F.size("un_k"), F.size("ge_k"), F.lit(1))),
        F.lit(',"dimension":{"na_item":{"category":{"index":'), F.to_json("ni_k"),
        F.lit(',"label":'), F.to_json(F.map_from_arrays("ni_k", "ni_l")),
        F.lit('}},"unit":{"category":{"index":'), F.to_json(F.map_from_arrays("un_k", seq(F.col("un_k")))),
        F.lit(',"label":'), F.to_json(F.map_from_arrays("un_k", "un_l")),
        F.lit('}},"geo":{"category":{"index":'), geo_index,
        F.lit(',"label":'), F.to_json(geo_labels),
        F.lit('}},"time":{"category":{"label":'), F.to_json(F.create_map(y, y)),
        F.lit('}}},"value":'), F.when(even, sparse).otherwise(dense),
        F.lit("}"),
    )
    return docs.select("year", "block", text.alias("text"))


def land_json_stat(spark: SparkSession, sf_dir: str) -> str:
    """Write one file per document; return the folder."""
    path = scratch_path(spark, "json_stat")
    docs = json_stat_documents(order_cube_cells(spark, sf_dir))
    docs.repartition("year", "block").write.partitionBy("year", "block").text(path)
    return path
