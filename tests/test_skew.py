"""A third of all orders on one customer: AQE splits the hot join partition, results stay exact."""

import duckdb
from pyspark.sql import functions as F

from gapscope.plans import bindings as B

SF = "/root/testdata/sf0.01"
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",  # force shuffled joins, as at scale
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}

ORACLE = f"""
with ord as (
  select o_orderkey, case when o_orderkey % 3 = 0 then (select min(c_custkey) from customer) else o_custkey end as o_custkey,
         o_orderdate from orders),
li as (
  select cn.n_name as jurisdiction, sn.n_name as counterpart_jurisdiction, cast(year(o_orderdate) as integer) as year,
         l_suppkey, cast(l_extendedprice as decimal(12,2)) * (cast(1 as decimal(3,2)) - cast(l_discount as decimal(3,2))) as rev,
         cast(l_tax as decimal(3,2)) as tx, cast(l_quantity as decimal(6,0)) as qty
  from read_parquet('{SF}/lineitem.parquet') join ord on l_orderkey = o_orderkey
  join read_parquet('{SF}/customer.parquet') on o_custkey = c_custkey
  join read_parquet('{SF}/nation.parquet') cn on c_nationkey = cn.n_nationkey
  join read_parquet('{SF}/supplier.parquet') on l_suppkey = s_suppkey
  join read_parquet('{SF}/nation.parquet') sn on s_nationkey = sn.n_nationkey)
select jurisdiction, counterpart_jurisdiction, year, cast(sum(rev - qty * 1300) as double) as p,
       cast(sum(rev * tx) as double) as t, cast(sum(qty) as double) as e, cast(count(distinct l_suppkey) as double) as m
from li group by all
"""


def test_hot_customer_is_split_and_exact(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        t = {n: B.table(spark, SF, n) for n in ("lineitem", "orders", "customer", "supplier", "nation")}
        hot = t["customer"].select(F.min("c_custkey")).scalar()
        # the test file is one row group (one map task); AQE splits a skewed
        # partition along map outputs, so spread the input over 8 splits as
        # a multi-file table would be
        orders = (
            t["orders"].repartition(8)
            .withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, hot).otherwise(F.col("o_custkey")))
        )
        df = B.fact_flows(t["lineitem"], orders, t["customer"], t["supplier"], t["nation"]).select(
            "jurisdiction", "counterpart_jurisdiction", "year",
            *[F.col(c).cast("double").alias(c) for c in ("p", "t", "e", "m")])
        got = sorted(tuple(r) for r in df.collect())
        final_plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in final_plan  # AQE split the hot customer's partition
    con = duckdb.connect()
    con.execute(f"create view customer as select * from read_parquet('{SF}/customer.parquet')")
    con.execute(f"create view orders as select * from read_parquet('{SF}/orders.parquet')")
    assert got == sorted(con.execute(ORACLE).fetchall())
