"""Exact SQL twins for operators whose usual input is a fitted model.

The attribution consumers (F3, D38, D39, M34) take any table of attributions.
Here they get one that both engines can derive from ``events``: two linear
features per event. The other queries (D6, D8, B5, M35, and M27 with two
features) run on the driver tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from txlens.functions.clean import drop_all_null_columns
from txlens.functions.scalar import IMPACT_DOWN, IMPACT_UP, round_half_up as R, sql_round as SR
from txlens.operators import explain as X
from txlens.operators.anomaly import mahalanobis_scores
from txlens.operators.select import filter_important_features
from txlens.operators.user_features import categorical_profile
from txlens.plans import sql as Q
from txlens.plans.queries import register
from txlens.sources.adapters import tx_from_orders
from txlens.sources.readers import read_table

_BASE = 0.25


def _attributions(spark, sf):
    """Attribution rows of every event: ``value`` and ``hour`` with a linear contribution each."""
    ev = read_table(spark, sf, "events").where("value is not null and ts is not null")
    hour = F.hour("ts").cast("double")
    pairs = F.array(F.struct(F.lit("value").alias("feature"), F.col("value").alias("x"), ((F.col("value") - 50) / 128).alias("s")),
                    F.struct(F.lit("hour").alias("feature"), hour.alias("x"), ((hour - 12) / 32).alias("s")))
    return ev.select(F.col("event_id").alias("transaction_id"), F.explode(pairs).alias("p")).select(
        "transaction_id", F.col("p.feature").alias("feature"), F.col("p.x").alias("feature_value"), F.col("p.s").alias("shap_value"),
        F.abs("p.s").alias("abs_shap"), F.lit(_BASE).alias("base_value"))


_ATTR = f"""ev AS (SELECT * FROM events WHERE value IS NOT NULL AND ts IS NOT NULL),
attr AS (SELECT event_id AS transaction_id, 'value' AS feature, value AS feature_value, (value - 50) / 128 AS shap_value,
                abs((value - 50) / 128) AS abs_shap, CAST({_BASE} AS DOUBLE) AS base_value FROM ev
         UNION ALL SELECT event_id, 'hour', CAST(hour(ts) AS DOUBLE), (CAST(hour(ts) AS DOUBLE) - 12) / 32,
                abs((CAST(hour(ts) AS DOUBLE) - 12) / 32), CAST({_BASE} AS DOUBLE) FROM ev),
ranked AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY abs_shap DESC, feature) AS r FROM attr)"""


@register("f3_top_features_of_events", f"""WITH {_ATTR} SELECT transaction_id, feature, {SR('feature_value', 6)} AS feature_value,
{SR('shap_value', 6)} AS shap_value, CASE WHEN shap_value > 0 THEN '{IMPACT_UP}' ELSE '{IMPACT_DOWN}' END AS impact FROM ranked WHERE r = 1""")
def q_f3(spark, sf):
    return X.top_features(_attributions(spark, sf), "transaction_id", 1).select(
        "transaction_id", "feature", R("feature_value", 6).alias("feature_value"), R("shap_value", 6).alias("shap_value"), "impact")


@register("d38_importance_of_event_features", f"""WITH {_ATTR} SELECT feature, {SR('avg(abs_shap)', 5)} AS mean_abs_shap FROM attr GROUP BY feature""")
def q_d38(spark, sf):
    return X.global_importance(_attributions(spark, sf), 15).select("feature", R("mean_abs_shap", 5).alias("mean_abs_shap"))


@register("d39_statistics_of_event_attributions", f"""WITH {_ATTR} SELECT count(DISTINCT transaction_id) AS n_transactions,
count(DISTINCT feature) AS n_features, {SR('avg(shap_value)', 5)} AS shap_mean, {SR('stddev_pop(shap_value)', 5)} AS shap_std,
{SR('min(shap_value)', 5)} AS shap_min, {SR('max(shap_value)', 5)} AS shap_max FROM attr""")
def q_d39(spark, sf):
    out = X.attribution_stats(_attributions(spark, sf), "transaction_id")
    return out.withColumns({c: R(c, 5) for c in ("shap_mean", "shap_std", "shap_min", "shap_max")})


@register("m34_waterfall_of_events", f"""WITH {_ATTR} SELECT transaction_id, feature, CAST(r AS INTEGER) AS step,
{SR('base_value + sum(shap_value) OVER (PARTITION BY transaction_id ORDER BY r)', 5)} AS cumulative FROM ranked""")
def q_m34(spark, sf):
    return X.waterfall(_attributions(spark, sf), "transaction_id").select(
        "transaction_id", "feature", "step", R("cumulative", 5).alias("cumulative"))


_TOP = " ".join(f"""{a} AS (SELECT user_id, v AS {c}_top, n AS {c}_top_n, k AS {c}_nunique FROM (SELECT user_id, {c} AS v, count(*) AS n,
row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, {c}) AS r, count(*) OVER (PARTITION BY user_id) AS k
FROM raw WHERE {c} IS NOT NULL GROUP BY user_id, {c}) WHERE r = 1),""" for a, c in (("a", "product_category"), ("b", "payment_method")))


@register("d6_top_category_and_payment", f"""WITH {Q.raw_cte('orders')}, {_TOP.rstrip(',')} SELECT user_id, product_category_top,
product_category_top_n, product_category_nunique, payment_method_top, payment_method_top_n, payment_method_nunique
FROM (SELECT DISTINCT user_id FROM raw) LEFT JOIN a USING (user_id) LEFT JOIN b USING (user_id)""")
def q_d6(spark, sf):
    out = categorical_profile(tx_from_orders(spark, sf))
    return out.select("user_id", *[f"{c}_{s}" for c in ("product_category", "payment_method") for s in ("top", "top_n", "nunique")])


@register("b5_drop_empty_columns", "SELECT event_id, user_id, value FROM events")
def q_b5(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "user_id", "value")
    return drop_all_null_columns(ev.withColumns({"nothing": F.lit(None).cast("string"), "nan": F.lit(float("nan"))}))


@register("m35_selection_of_lineitem_columns", """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem""")
def q_m35(spark, sf):
    """Two copies of a column and a constant go; the first of the copies and the other columns stay."""
    df = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    df = df.withColumns({"twice": F.col("l_quantity") * 2, "minus": -F.col("l_extendedprice"), "same": F.lit(1.0)})
    return filter_important_features(df, 0.999, 0.01, keys=["l_orderkey"])


@register("m27_mahalanobis_of_lineitem", f"""WITH m AS (SELECT avg(l_quantity) AS mx, avg(l_discount) AS my, var_samp(l_quantity) AS a,
var_samp(l_discount) AS d, covar_samp(l_quantity, l_discount) AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, {SR('sqrt((d * (l_quantity - mx) ** 2 - 2 * b * (l_quantity - mx) * (l_discount - my) + a * (l_discount - my) ** 2) / (a * d - b * b))', 4)}
AS anomaly_score FROM lineitem, m""")
def q_m27(spark, sf):
    out = mahalanobis_scores(read_table(spark, sf, "lineitem"), ["l_quantity", "l_discount"], ["l_orderkey", "l_linenumber"])
    return out.withColumn("anomaly_score", R("anomaly_score", 4))
