"""Adapters from the driver's tables to the transaction schema.

The driver data has no wallet table. Two adapters map it to ``TX_SCHEMA``
column names and types; they only rename and cast (plus the joins the orders
adapter needs), the operators downstream do all the work.

* ``tx_from_events`` - minimal schema (no fee / cashback / payment / device /
  location), real hours of day. Exercises the optional-column plan.
* ``tx_from_orders`` - full schema from lineitem x orders x part x customer x
  nation. Every lineitem row is one transaction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.sources.readers import read_table


def tx_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("ev-"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("transaction_id"),
        F.col("ts").cast("timestamp").alias("transaction_date"),
        F.col("event_type").alias("product_category"),
        F.col("value").cast("double").alias("product_amount"),
        F.get_json_object("props", "$.k").cast("double").alias("loyalty_points"),
    )


TX_FROM_EVENTS_SQL = """
SELECT CAST(user_id AS VARCHAR) AS user_id,
       'ev-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS transaction_id,
       CAST(ts AS TIMESTAMP) AS transaction_date,
       event_type AS product_category,
       CAST(value AS DOUBLE) AS product_amount,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS loyalty_points
FROM events
"""


def tx_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # lineitem is the fact side and moves twice at most: by part, then by order
    # (Catalyst/AQE picks the strategy from sizes). Customers meet the orders, of which
    # there are fewer; nation, the smallest, comes last, so that its names do not move.
    buyers = od.join(cu, od.o_custkey == cu.c_custkey)
    j = (li.join(pt, li.l_partkey == pt.p_partkey)
         .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(na, F.col("c_nationkey") == na.n_nationkey))
    tx_id = F.concat_ws(
        "-",
        F.lpad(F.col("l_orderkey").cast("string"), 10, "0"),
        F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"),
        F.date_format("l_shipdate", "yyyyMMdd"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
    )
    return j.select(
        F.col("o_custkey").cast("string").alias("user_id"),
        tx_id.alias("transaction_id"),
        F.col("l_shipdate").cast("timestamp").alias("transaction_date"),
        F.col("p_type").alias("product_category"),
        F.col("l_extendedprice").alias("product_amount"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("transaction_fee"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("cashback"),
        F.col("l_quantity").alias("loyalty_points"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("l_returnflag").alias("device_type"),
        F.col("n_name").alias("location"),
    )


TX_FROM_ORDERS_SQL = """
SELECT CAST(o.o_custkey AS VARCHAR) AS user_id,
       concat_ws('-', lpad(CAST(l.l_orderkey AS VARCHAR), 10, '0'), CAST(l.l_linenumber AS VARCHAR),
                 CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR),
                 strftime(l.l_shipdate, '%Y%m%d'),
                 CAST(CAST(round(l.l_extendedprice * 100) AS BIGINT) AS VARCHAR)) AS transaction_id,
       CAST(l.l_shipdate AS TIMESTAMP) AS transaction_date,
       p.p_type AS product_category,
       l.l_extendedprice AS product_amount,
       l.l_extendedprice * l.l_tax AS transaction_fee,
       l.l_extendedprice * l.l_discount AS cashback,
       l.l_quantity AS loyalty_points,
       o.o_orderpriority AS payment_method,
       l.l_returnflag AS device_type,
       n.n_name AS location
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
"""
