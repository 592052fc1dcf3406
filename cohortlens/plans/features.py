"""Shared per-customer feature table ``cust`` (stand-in for a participant
table): one row per customer with order and event aggregates. Defined once
with the DataFrame API and once as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .standins import table

CUST_NUMERIC = ["acctbal", "n_orders", "spend", "mean_price", "max_price", "n_urgent", "n_status",
                "n_events", "ev_total", "ev_mean", "ev_max", "ev_night", "n_titles",
                "has_orders", "has_events"]


def cust(spark: SparkSession, sf_dir: str, materialise: bool = True) -> DataFrame:
    """The feature table; ``materialise=False`` keeps the plan, for queries
    that pass over it once and need few of its columns or rows."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    e = table(spark, sf_dir, "events")
    oagg = o.groupBy(F.col("o_custkey").alias("record_id")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("spend"),
        F.avg("o_totalprice").alias("mean_price"), F.max("o_totalprice").alias("max_price"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        F.count_distinct("o_orderstatus").alias("n_status"))
    h = F.hour("ts")
    eagg = e.groupBy(F.col("user_id").alias("record_id")).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("ev_total"),
        F.avg("value").alias("ev_mean"), F.max("value").alias("ev_max"),
        F.count_if((h < 6) | (h >= 22)).alias("ev_night"),
        F.count_distinct("props").alias("n_titles"))
    base = c.select(F.col("c_custkey").alias("record_id"), F.col("c_mktsegment").alias("segment"),
                    F.col("c_nationkey").alias("nation"),
                    F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("acctbal"))
    out = base.join(oagg, "record_id", "left").join(eagg, "record_id", "left")
    out = out.select("*", F.col("n_orders").isNotNull().cast("int").alias("has_orders"),
                     F.col("n_events").isNotNull().cast("int").alias("has_events"))
    return cut_lineage(out) if materialise else out


CUST_SQL = """cust AS (
  SELECT c.c_custkey AS record_id, c.c_mktsegment AS segment, c.c_nationkey AS nation,
    CASE WHEN c.c_custkey % 7 <> 0 THEN c.c_acctbal END AS acctbal,
    o.n_orders, o.spend, o.mean_price, o.max_price, o.n_urgent, o.n_status,
    e.n_events, e.ev_total, e.ev_mean, e.ev_max, e.ev_night, e.n_titles,
    CAST(o.n_orders IS NOT NULL AS INTEGER) AS has_orders,
    CAST(e.n_events IS NOT NULL AS INTEGER) AS has_events
  FROM customer c
  LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS spend,
      avg(o_totalprice) AS mean_price, max(o_totalprice) AS max_price,
      CAST(count_if(o_orderpriority = '1-URGENT') AS BIGINT) AS n_urgent,
      count(DISTINCT o_orderstatus) AS n_status
    FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT user_id, count(*) AS n_events, sum(value) AS ev_total, avg(value) AS ev_mean,
      max(value) AS ev_max, CAST(count_if(hour(ts) < 6 OR hour(ts) >= 22) AS BIGINT) AS ev_night,
      count(DISTINCT props) AS n_titles
    FROM events GROUP BY user_id) e ON e.user_id = c.c_custkey)"""
