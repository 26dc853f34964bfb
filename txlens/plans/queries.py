"""Registered queries: one per operator of the inventory, each over the whole
driver tables (or tables Spark derives from them), plus DuckDB oracle twins.

Names follow the inventory ids. A query's callable takes (spark, sf_dir) and
returns a DataFrame; ``ORACLE`` holds the SQL twin where one exists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.functions import scalar as S
from txlens.functions.clean import (drop_null_rows, fill_mean, fill_median, fill_zero,
                                    group_rare_categories, preprocess_transactions)
from txlens.operators.legacy import build_transaction_features_legacy, build_user_features_legacy
from txlens.operators.tx_features import build_transaction_features, build_transaction_features_simple
from txlens.operators.user_features import build_user_features
from txlens.plans import sql as Q
from txlens.sources.adapters import tx_from_events, tx_from_orders
from txlens.sources.readers import read_table

# Fixed "now" for days_since_last_transaction in every registered query.
AS_OF = "2026-01-01 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- B: preprocessing and cleaning ------------------------------------------

@register("b14_preprocess_events", Q.preprocess_sql("events"))
def q_b14_events(spark, sf):
    return preprocess_transactions(tx_from_events(spark, sf))


@register("b14_preprocess_orders", Q.preprocess_sql("orders"))
def q_b14_orders(spark, sf):
    return preprocess_transactions(tx_from_orders(spark, sf))


_B13_SQL = """
WITH li AS (SELECT p.p_name AS product_category FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
k AS (SELECT product_category AS val, count(*) AS n FROM li GROUP BY 1),
g AS (SELECT CASE WHEN li.product_category IS NULL THEN NULL WHEN k.n < 30 THEN 'Other' ELSE li.product_category END
      AS product_category FROM li LEFT JOIN k ON li.product_category = k.val)
SELECT product_category, count(*) AS n FROM g GROUP BY 1
"""


@register("b13_rare_categories", _B13_SQL)
def q_b13(spark, sf):
    """B13 on part names of every lineitem row (min_count 30 so that rare names exist)."""
    li = read_table(spark, sf, "lineitem").select("l_partkey")
    pt = read_table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("product_category"))
    tx = li.join(pt, li.l_partkey == pt.p_partkey).select("product_category")
    g = group_rare_categories(tx, ["product_category"], min_count=30)
    return g.groupBy("product_category").agg(F.count(F.lit(1)).alias("n"))


def _events_with_nulls(spark, sf) -> DataFrame:
    """Stand-in input for the imputers: events whose value (ids ending in 0) or
    k (ids ending in 1) is null - the driver data has no nulls. Every row is kept."""
    ev = read_table(spark, sf, "events")
    r = F.pmod(F.col("event_id"), F.lit(10))
    return ev.select("event_id", "user_id",
                     F.when(r == 0, F.lit(None)).otherwise(F.col("value")).alias("value"),
                     F.when(r == 1, F.lit(None)).otherwise(
                         F.get_json_object("props", "$.k").cast("double")).alias("k"))


_NULLS = ("ev AS (SELECT event_id, user_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value, "
          "CASE WHEN event_id % 10 = 1 THEN NULL ELSE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k "
          "FROM events)")


@register("b7_zero_fill", f"WITH {_NULLS} SELECT event_id, user_id, COALESCE(value, 0.0) AS value, "
                          "COALESCE(k, 0.0) AS k FROM ev")
def q_b7(spark, sf):
    return fill_zero(_events_with_nulls(spark, sf), ["value", "k"])


@register("b8_mean_fill", f"WITH {_NULLS}, m AS (SELECT avg(value) AS mv, avg(k) AS mk FROM ev) "
                          f"SELECT event_id, user_id, {S.sql_round('COALESCE(value, mv)', 6)} AS value, "
                          f"{S.sql_round('COALESCE(k, mk)', 6)} AS k FROM ev, m")
def q_b8(spark, sf):
    df = fill_mean(_events_with_nulls(spark, sf), ["value", "k"])
    return df.select("event_id", "user_id", S.round_half_up("value", 6).alias("value"),
                     S.round_half_up("k", 6).alias("k"))


@register("b9_median_fill", f"WITH {_NULLS}, m AS (SELECT quantile_cont(value, 0.5) AS mv, "
                            "quantile_cont(k, 0.5) AS mk FROM ev) "
                            "SELECT event_id, user_id, COALESCE(value, mv) AS value, COALESCE(k, mk) AS k FROM ev, m")
def q_b9(spark, sf):
    return fill_median(_events_with_nulls(spark, sf), ["value", "k"])


@register("b6_drop_null_rows", f"WITH {_NULLS} SELECT * FROM ev WHERE event_id IS NOT NULL AND user_id IS NOT NULL "
                               "AND value IS NOT NULL AND k IS NOT NULL")
def q_b6(spark, sf):
    return drop_null_rows(_events_with_nulls(spark, sf))


_B12_SQL = f"""
WITH {Q.raw_cte('orders')}
SELECT transaction_id,
       {Q.rz('cashback', 'transaction_fee')} AS ratio_or_zero,
       {Q.r1('cashback', 'transaction_fee')} AS ratio_denominator_one,
       CASE WHEN transaction_fee > 0 THEN cashback / transaction_fee ELSE 0.0 END AS ratio_when_positive
FROM raw
"""


@register("b12_safe_ratios", _B12_SQL)
def q_b12(spark, sf):
    tx = tx_from_orders(spark, sf)
    return tx.select("transaction_id",
                     S.ratio_or_zero("cashback", "transaction_fee").alias("ratio_or_zero"),
                     S.ratio_denominator_one("cashback", "transaction_fee").alias("ratio_denominator_one"),
                     S.ratio_when_positive("cashback", "transaction_fee").alias("ratio_when_positive"))


# --- G: scalar functions ----------------------------------------------------

_G7_SQL = f"""
WITH {Q.raw_cte('events')}
SELECT transaction_id, CAST(hour(transaction_date) AS INTEGER) AS hour,
       CAST(isodow(transaction_date) - 1 AS INTEGER) AS day_of_week,
       CAST(day(transaction_date) AS INTEGER) AS day_of_month, CAST(month(transaction_date) AS INTEGER) AS month,
       CASE WHEN isodow(transaction_date) - 1 IN (5, 6) THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN hour(transaction_date) BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS is_night,
       {Q.days('transaction_date', "TIMESTAMP '" + AS_OF + "'")} AS days_to_as_of,
       {S.sql_round('ln(1 + product_amount)', 6)} AS log_amount
FROM raw
"""


@register("g7_datetime_parts", _G7_SQL)
def q_g7(spark, sf):
    from txlens.operators.user_features import full_days
    tx = tx_from_events(spark, sf)
    return tx.select("transaction_id", *S.datetime_parts(),
                     full_days(F.col("transaction_date"), F.lit(AS_OF).cast("timestamp")).alias("days_to_as_of"),
                     S.round_half_up(F.log1p("product_amount"), 6).alias("log_amount"))


_BANDS_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_discount * 10 > 0.8 AND l_discount * 10 <= 1.0 THEN 'Très forte'
            WHEN l_discount * 10 > 0.6 AND l_discount * 10 <= 0.8 THEN 'Forte'
            WHEN l_discount * 10 > 0.3 AND l_discount * 10 <= 0.6 THEN 'Moyenne'
            WHEN l_discount * 10 > 0.0 AND l_discount * 10 <= 0.3 THEN 'Faible' END AS loading_band,
       CASE WHEN l_tax * 10 > 0.5 THEN 'Bonne' WHEN l_tax * 10 > 0.3 THEN 'Moyenne' ELSE 'Faible' END AS quality,
       CASE WHEN l_discount * 10 >= 0.9 THEN 'Mervelous' WHEN l_discount * 10 >= 0.8 THEN 'Meritorious'
            WHEN l_discount * 10 >= 0.7 THEN 'Middling' WHEN l_discount * 10 >= 0.6 THEN 'Mediocre'
            WHEN l_discount * 10 >= 0.5 THEN 'Miserable' ELSE 'Inacceptable' END AS kmo_band,
       CASE WHEN l_extendedprice > 50000 * 1.5 THEN 'high' WHEN l_extendedprice > 50000 THEN 'elevated'
            ELSE 'normal' END AS severity,
       CASE WHEN l_discount - 0.05 > 0 THEN 'Augmente anomalie' ELSE 'Réduit anomalie' END AS impact,
       greatest(0.02, least(0.08, l_discount)) AS clipped,
       CASE WHEN l_returnflag IN ('A', 'R') THEN 1 ELSE 0 END AS flagged
FROM lineitem
"""


@register("g16_scalar_bands", _BANDS_SQL)
def q_g_bands(spark, sf):
    """G12, G14-G20 on stand-in columns of lineitem (discount x 10 as a loading, tax x 10 as a cos2)."""
    li = read_table(spark, sf, "lineitem")
    d10, t10 = F.col("l_discount") * 10, F.col("l_tax") * 10
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     S.loading_band(d10).alias("loading_band"),
                     S.representation_quality(t10).alias("quality"),
                     S.kmo_label_col(d10).alias("kmo_band"),
                     S.severity("l_extendedprice", F.lit(50000.0)).alias("severity"),
                     S.impact_label(F.col("l_discount") - 0.05).alias("impact"),
                     S.clip("l_discount", 0.02, 0.08).alias("clipped"),
                     F.col("l_returnflag").isin("A", "R").cast("int").alias("flagged"))


# --- D / M: feature tables ----------------------------------------------------

@register("d15_user_features_events", Q.user_features_sql("events", AS_OF))
def q_uf_events(spark, sf):
    return build_user_features(tx_from_events(spark, sf), as_of=AS_OF)


@register("d15_user_features_orders", Q.user_features_sql("orders", AS_OF))
def q_uf_orders(spark, sf):
    return build_user_features(tx_from_orders(spark, sf), as_of=AS_OF)


@register("m36_tx_features_events", Q.tx_features_sql("events"))
def q_tf_events(spark, sf):
    return build_transaction_features(tx_from_events(spark, sf))


@register("m36_tx_features_orders", Q.tx_features_sql("orders"))
def q_tf_orders(spark, sf):
    return build_transaction_features(tx_from_orders(spark, sf))


@register("m37_tx_features_simple_events", Q.tx_features_simple_sql("events"))
def q_tfs_events(spark, sf):
    return build_transaction_features_simple(tx_from_events(spark, sf))


@register("m37_tx_features_simple_orders", Q.tx_features_simple_sql("orders"))
def q_tfs_orders(spark, sf):
    return build_transaction_features_simple(tx_from_orders(spark, sf))


@register("m38_legacy_user_features", Q.legacy_user_features_sql())
def q_legacy_uf(spark, sf):
    return build_user_features_legacy(tx_from_orders(spark, sf))


@register("m39_legacy_tx_features", Q.legacy_tx_features_sql())
def q_legacy_tf(spark, sf):
    return build_transaction_features_legacy(tx_from_orders(spark, sf))
