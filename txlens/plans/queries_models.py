"""Saved models, single-row lookups, sparse encodings, silhouettes and the two-column PCA with its closed form.

The principal components of two standardised columns with correlation r > 0 are (1, 1) and (1, -1) over the square root
of 2, with shares (1 + r) / 2 and (1 - r) / 2. So every output of the PCA on the
amounts and fees of the orders transactions has an exact SQL twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from txlens.functions.scalar import round_half_up as R, sql_round as SR
from txlens.operators import anomaly as A
from txlens.operators import encode as E
from txlens.operators import lookup as L
from txlens.operators import profile as P
from txlens.operators import segment as S
from txlens.operators.cache import cut
from txlens.operators.decompose import SUGGESTION_THRESHOLDS, compute_pca, prepare_for_pca
from txlens.operators.user_features import build_user_features
from txlens.plans import queries_profile as PQ
from txlens.plans import sql as Q
from txlens.plans.queries import AS_OF, register
from txlens.plans.queries_ml import _cached, _scratch, _users
from txlens.plans.queries_twins import _ATTR, _attributions
from txlens.plans.training import write_csv
from txlens.sources.adapters import tx_from_events, tx_from_orders
from txlens.sources.readers import read_table

PAIR = ["product_amount", "transaction_fee"]


def _pair(spark, sf, k: int = 2):
    return _cached(spark, sf, f"pair{k}", lambda: compute_pca(cut(tx_from_orders(spark, sf).select("transaction_id", *PAIR)), ["transaction_id"], n_components=k))


_PAIR = f"""WITH {Q.raw_cte('orders')},
st AS (SELECT count(*) AS n, corr(product_amount, transaction_fee) AS r, avg(product_amount) AS m1, stddev_pop(product_amount) AS s1,
              avg(transaction_fee) AS m2, stddev_pop(transaction_fee) AS s2, count(*) / (count(*) - 1) AS f FROM raw),
z AS (SELECT transaction_id, product_amount, transaction_fee, (product_amount - m1) / s1 AS z1, (transaction_fee - m2) / s2 AS z2, st.* FROM raw, st),
pc AS (SELECT *, (z1 + z2) / sqrt(2) AS pc1, (z1 - z2) / sqrt(2) AS pc2, z1 * z1 + z2 * z2 AS zz FROM z),
comp AS (SELECT 1 AS idx, (1 + r) / 2 AS share, (1 + r) / 2 AS cum, (1 + r) * f AS eigen, n FROM st
         UNION ALL SELECT 2, (1 - r) / 2, 1.0, (1 - r) * f, n FROM st),
vars AS (SELECT unnest(['product_amount', 'transaction_fee']) AS variable)"""


@register("m14_summary_of_two_columns", f"""{_PAIR} SELECT 'PC' || idx AS component, {SR('share', 4)} AS variance_ratio, {SR('cum', 4)} AS cumulative_variance,
{SR('share * 100', 4)} AS variance_pct, {SR('cum * 100', 4)} AS cumulative_pct, {SR('eigen', 4)} AS eigenvalue, CAST(2 * n AS DOUBLE) AS inertia FROM comp""")
def q_m14(spark, sf):
    return _pair(spark, sf).summary()


@register("m12_loadings_of_two_columns", f"""{_PAIR} SELECT variable, 'PC' || idx AS component, {SR('sqrt(eigen / 2)', 4)} AS abs_loading,
{SR('f', 4)} AS cos2, 50.0::DOUBLE AS contribution FROM comp, vars, (SELECT f FROM st)""")
def q_m12(spark, sf):
    return _pair(spark, sf).variable_table().select("variable", "component", *[R(c, 4).alias(c) for c in ("abs_loading", "cos2", "contribution")])


@register("m13_total_inertia", f"{_PAIR} SELECT {SR('2.0 * n', 3)} AS total_inertia FROM st")
def q_m13(spark, sf):
    return spark.createDataFrame([(_pair(spark, sf).total_inertia(),)], "total_inertia double").select(R("total_inertia", 3).alias("total_inertia"))


@register("m11_contributions_of_two_columns", f"""{_PAIR}, t AS (SELECT sum(pc1 * pc1) AS t1, sum(pc2 * pc2) AS t2 FROM pc)
SELECT transaction_id, {SR('pc1 * pc1 / t1 * 100', 5)} AS ctr_PC1, {SR('pc2 * pc2 / t2 * 100', 5)} AS ctr_PC2 FROM pc, t""")
def q_m11(spark, sf):
    return _pair(spark, sf).individual_contributions().select("transaction_id", *[R(c, 5).alias(c) for c in ("ctr_PC1", "ctr_PC2")])


@register("m15_suggestions_of_two_columns", f"""{_PAIR}, t AS (SELECT unnest({SUGGESTION_THRESHOLDS}) AS t),
s AS (SELECT 'variance_' || CAST(round(t * 100) AS INTEGER) AS method, CASE WHEN (1 + r) / 2 >= t - 1e-12 THEN 1 ELSE 2 END AS k, r FROM t, st
      UNION ALL SELECT 'kaiser', CAST((1 + r) * f > 1 AS INTEGER) + CAST((1 - r) * f > 1 AS INTEGER), r FROM st)
SELECT method, k AS n_components, {SR('CASE k WHEN 1 THEN (1 + r) / 2 ELSE 1.0 END', 4)} AS variance_explained FROM s""")
def q_m15(spark, sf):
    return _pair(spark, sf).suggestions().withColumn("variance_explained", R("variance_explained", 4))


@register("m17_scree_of_two_columns", f"""{_PAIR} SELECT idx AS component, {SR('eigen', 4)} AS eigenvalue, {SR('share', 4)} AS variance_ratio,
{SR('cum', 4)} AS cumulative FROM comp""")
def q_m17_scree(spark, sf):
    return _pair(spark, sf).scree().withColumns({c: R(c, 4) for c in ("eigenvalue", "variance_ratio", "cumulative")})


@register("f5_contributions_of_two_columns", f"""{_PAIR} SELECT variable, 50.0::DOUBLE AS PC1, 50.0::DOUBLE AS PC2, {SR('f', 4)} AS quality_representation,
100.0::DOUBLE AS total_contribution FROM vars, st""")
def q_f5(spark, sf):
    return _pair(spark, sf).variable_contributions()


@register("f4_top_loadings_of_two_columns", f"""{_PAIR} SELECT variable, {SR('sqrt(eigen / 2)', 4)} AS loading, {SR('sqrt(eigen / 2)', 4)} AS abs_loading,
50.0::DOUBLE AS contribution FROM comp, vars WHERE idx = 1""")
def q_f4(spark, sf):
    return _pair(spark, sf).top_loadings(0, 10, 0.3).select("variable", "loading", "abs_loading", "contribution")


@register("f6_circle_of_two_columns", f"""{_PAIR} SELECT variable, {SR('sqrt((1 + r) * f / 2)', 4)} AS x, {SR('sqrt((1 - r) * f / 2)', 4)} AS y,
{SR('sqrt(f)', 4)} AS length FROM vars, st""")
def q_f6(spark, sf):
    return _pair(spark, sf).correlation_circle().select("variable", R("x", 4).alias("x"), R(F.abs("y"), 4).alias("y"), R("length", 4).alias("length"))


@register("m18_metrics_of_two_columns", f"""{_PAIR} SELECT n AS n_individuals, 2 AS n_variables, 2 AS n_components, 1.0::DOUBLE AS total_variance, 1.0::DOUBLE AS mean_cos2,
{SR('2 * f', 4)} AS sum_eigenvalues, 0.5::DOUBLE AS kmo, false AS kmo_adequate, {SR('(1.5 - (n - 1)) * ln(1 - r * r)', 2)} AS bartlett_chi2, 1 AS bartlett_df,
true AS bartlett_significant, 'excellent' AS reduction_verdict FROM st""")
def q_m18(spark, sf):
    out = _pair(spark, sf).metrics().withColumns({"total_variance": R("total_variance", 4), "mean_cos2": R("mean_cos2", 4), "kmo": R("kmo", 4),
                                                 "sum_eigenvalues": R("sum_eigenvalues", 4), "bartlett_chi2": R("bartlett_chi2", 2)})
    return out.drop("kmo_interpretation", "bartlett_p_value")


_QUALITY = "CASE WHEN cos2 > 0.5 THEN 'good' WHEN cos2 > 0.3 THEN 'average' ELSE 'poor' END"
_ONE = f"{_PAIR}, one AS (SELECT *, least(pc1 * pc1 / zz, 1.0) AS cos2 FROM pc)"


@register("m16_individual_analysis", f"""{_ONE} SELECT transaction_id, {SR('pc1', 4)} AS PC1, 100.0::DOUBLE AS share_PC1, {SR('cos2', 4)} AS cos2, {SR('cos2', 4)} AS cos2_PC1,
{SR('abs(pc1)', 4)} AS distance_to_centre, {SR('abs(pc2)', 4)} AS residual, {SR('(z1 - z2) / 2', 4)} AS residual_product_amount,
{SR('(z2 - z1) / 2', 4)} AS residual_transaction_fee, product_amount AS original_product_amount, {SR('transaction_fee', 6)} AS original_transaction_fee FROM one""")
def q_m16(spark, sf):
    """Every transaction on the first axis alone, so that a part of it stays unexplained."""
    out = _pair(spark, sf, 1).individual_analysis().drop("quality")
    exact = ("transaction_id", "original_product_amount", "original_transaction_fee")
    return out.withColumns({c: R(c, 4) for c in out.columns if c not in exact} | {"original_transaction_fee": R("original_transaction_fee", 6)})


@register("m17_quality_histogram", f"""{_ONE}, b AS (SELECT CAST(least(floor(cos2 * 20), 19) AS INTEGER) AS bin, count(*) AS count,
count(*) FILTER (cos2 < 0.5) AS poorly_represented FROM one GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, {SR('i / 20', 6)} AS lower, {SR('(i + 1) / 20', 6)} AS upper, coalesce(count, 0) AS count, coalesce(poorly_represented, 0) AS poorly_represented
FROM range(20) t(i) LEFT JOIN b ON b.bin = i""")
def q_m17_quality(spark, sf):
    return _pair(spark, sf, 1).quality_histogram().withColumns({"lower": R("lower", 6), "upper": R("upper", 6)})


@register("b19_poorly_represented_on_one_axis", f"""{_ONE} SELECT transaction_id, {SR('pc1', 4)} AS PC1, {SR('cos2', 4)} AS cos2, {SR('abs(pc1)', 4)} AS distance_to_centre
FROM one WHERE cos2 < 0.5""")
def q_b19(spark, sf):
    out = _pair(spark, sf, 1).scores().where(F.col("cos2") < 0.5).drop("quality")
    return out.withColumns({c: R(c, 4) for c in ("PC1", "cos2", "distance_to_centre")})


@register("m17_space_individuals")
def q_m17_space(spark, sf):
    from txlens.plans.queries_ml import _pca
    return _pca(spark, sf).space(1000)


@register("m18_pca_report")
def q_m18_report(spark, sf):
    from txlens.plans.queries_ml import _pca
    return _pca(spark, sf).report()


# --- saved segmentation ---------------------------------------------------------------

@register("a6_reloaded_segmentation", f"WITH {Q.raw_cte('orders')} SELECT DISTINCT user_id, true AS same_cluster FROM raw")
def q_a6(spark, sf):
    """Every user's segment from the saved and reloaded model against the training run's own."""
    users = _users(spark, sf)
    km = _cached(spark, sf, "km", lambda: S.train_kmeans(users, ["user_id"], 4))
    path = _scratch(spark)
    km.save(path)
    again = S.SegmentationModel.load(spark, f"{path}/model").assign(users, ["user_id"])
    both = again.select("user_id", F.col("cluster").alias("again")).join(km.labels.select("user_id", "cluster"), "user_id")
    return both.select("user_id", (F.col("again") == F.col("cluster")).alias("same_cluster"))


_DEBT = "CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 6000 THEN 1 ELSE 2 END"


@register("m20_euclidean_silhouette", f"""WITH c AS (SELECT c_custkey, c_acctbal / 1000 AS x, CAST(c_nationkey AS DOUBLE) AS y, {_DEBT} AS l FROM customer),
d AS (SELECT a.c_custkey, a.l, b.l AS other, sum(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS s, count(*) AS n FROM c a, c b WHERE a.c_custkey <> b.c_custkey GROUP BY 1, 2, 3),
ab AS (SELECT c_custkey, max(s / n) FILTER (l = other) AS a, min(s / n) FILTER (l <> other) AS b FROM d GROUP BY 1)
SELECT count(*) AS n_rows, {SR('avg(CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END)', 5)} AS silhouette FROM ab""")
def q_m20(spark, sf):
    """Customers in three bands of their balance; up to 2,000 rows of a band the value is exact, beyond it an estimate."""
    rows = read_table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") / 1000).alias("x"), F.col("c_nationkey").cast("double").alias("y"), F.expr(_DEBT).alias("cluster"))
    return S.euclidean_silhouette(rows, ["c_custkey"], ["x", "y"], per_cluster=2000).select("n_rows", R("silhouette", 5).alias("silhouette"))


# --- lookups ------------------------------------------------------------------------------

@register("c7_lookup_of_suspicious_events", f"""WITH {_ATTR}, best AS (SELECT *, value AS anomaly_score FROM ev ORDER BY value DESC, event_id LIMIT 5)
SELECT event_id AS transaction_id, CAST(user_id AS VARCHAR) AS user_id, event_type, value AS anomaly_score,
       (SELECT string_agg(feature || '=' || printf('%.4f', {SR('shap_value', 4)}), ',' ORDER BY r) FROM ranked WHERE transaction_id = event_id) AS attributions
FROM best""")
def q_c7(spark, sf):
    """The five highest events (a top-k report) looked up in tables laid out by key: source row, score, attributions."""
    ev = read_table(spark, sf, "events").where("value is not null and ts is not null")
    rows = ev.select(F.col("event_id").alias("transaction_id"), F.col("user_id").cast("string").alias("user_id"), "event_type")
    scores = ev.select(F.col("event_id").alias("transaction_id"), F.col("value").alias("anomaly_score"))
    paths = [L.write_by_key(t, _scratch(spark), "transaction_id") for t in (rows, scores, _attributions(spark, sf))]
    keys = [r[0] for r in scores.orderBy(F.desc("anomaly_score"), "transaction_id").limit(5).collect()]
    out = L.look_up(spark, keys, *paths)
    said = F.transform("attributions", lambda x: F.concat(x["feature"], F.lit("="), F.format_string("%.4f", R(x["shap_value"], 4))))
    return out.withColumn("attributions", F.array_join(said, ","))


# --- encodings and profiles ------------------------------------------------------------------

_SPARSE = ["product_category", "payment_method", "user_id"]


@register("g21_sparse_encoding", f"""WITH {Q.raw_cte('orders')}, long AS ({" UNION ALL ".join(f"SELECT {i} AS place, {c} AS value FROM raw" for i, c in enumerate(_SPARSE))}),
d AS (SELECT place, value, row_number() OVER (ORDER BY place, value) - 1 AS idx FROM (SELECT DISTINCT place, value FROM long WHERE value IS NOT NULL)
      QUALIFY row_number() OVER (PARTITION BY place ORDER BY value) > 1),
e AS (SELECT place, value, row_number() OVER (ORDER BY place, value) - 1 AS idx FROM d)
SELECT transaction_id, CAST((SELECT count(*) FROM e) AS INTEGER) AS size, concat_ws(',', {", ".join(f"e{i}.idx" for i in range(3))}) AS indices
FROM raw {" ".join(f"LEFT JOIN e e{i} ON e{i}.place = {i} AND e{i}.value = raw.{c}" for i, c in enumerate(_SPARSE))}""")
def q_g21(spark, sf):
    """One sparse vector per transaction over categories, payment methods and users."""
    raw = cut(tx_from_orders(spark, sf).select("transaction_id", *_SPARSE))  # read by the dictionary and by the vectors
    dictionary = cut(E.value_dictionary(raw, _SPARSE))
    out = E.sparse_one_hot(raw, ["transaction_id"], _SPARSE, dictionary)
    v = F.from_json(F.to_json(F.struct("features")), "features struct<size int, indices array<int>>")["features"]
    return out.select("transaction_id", v["size"].alias("size"), F.array_join(v["indices"], ",").alias("indices"))


@register("d23_cumulative_shares", f"""WITH {Q.raw_cte('orders')}, s AS (SELECT user_id, count(*) AS size FROM raw GROUP BY 1)
SELECT user_id, size, {SR('size * 100.0 / sum(size) OVER ()', 4)} AS size_pct,
       {SR('sum(size) OVER (ORDER BY size DESC, user_id ROWS UNBOUNDED PRECEDING) * 100.0 / sum(size) OVER ()', 4)} AS cumulative_pct FROM s""")
def q_d23_cumulative(spark, sf):
    """How many users make up which share of the transactions."""
    return P.cumulative_shares(tx_from_orders(spark, sf), "user_id")


@register("d28_dtype_counts", """SELECT CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
ELSE 'timestamp_ntz' END AS dtype, count(*) AS n_columns FROM (SELECT unnest([typeof(l_orderkey), typeof(l_partkey), typeof(l_suppkey), typeof(l_linenumber),
typeof(l_quantity), typeof(l_extendedprice), typeof(l_discount), typeof(l_tax), typeof(l_returnflag), typeof(l_linestatus), typeof(l_shipdate)]) AS data_type
FROM (SELECT * FROM lineitem LIMIT 1)) GROUP BY 1""")
def q_d28_types(spark, sf):
    return P.dtype_counts(read_table(spark, sf, "lineitem"))


@register("b4_prepare_numeric_data", """SELECT event_id, user_id, coalesce(v, (SELECT median(v) FROM e)) AS value FROM
(SELECT event_id, user_id, CASE WHEN event_id % 10 < 2 THEN NULL ELSE value END AS v FROM events) CROSS JOIN (SELECT 1)
""".replace("FROM e)", "FROM (SELECT CASE WHEN event_id % 10 < 2 THEN NULL ELSE value END AS v FROM events))"))
def q_b4(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "user_id", "event_type", F.when(F.col("event_id") % 10 >= 2, F.col("value")).alias("value"))
    return A.prepare_numeric_data(ev)


# fixed values of the driver's events
_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@register("g23_encoded_events", f"""WITH {Q.raw_cte('events')}, u AS (SELECT user_id, row_number() OVER (ORDER BY min(transaction_id)) - 1 AS code FROM raw
WHERE user_id IS NOT NULL GROUP BY 1) SELECT CAST(u.code AS BIGINT) AS user_id, transaction_id, transaction_date, product_amount, loyalty_points, """
          + ", ".join(f"coalesce(CAST(product_category = '{v}' AS INTEGER), 0) AS product_category_{v}" for v in _EVENT_TYPES[1:])
          + " FROM raw JOIN u ON raw.user_id = u.user_id")
def q_g23(spark, sf):
    """One-hot for the five event types, ordinal codes for the users."""
    return E.encode_categorical_columns(tx_from_events(spark, sf), max_categories=10)


_TOP_OF = """top AS (SELECT user_id, v FROM (SELECT user_id, product_category AS v, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, product_category) AS r
FROM raw WHERE product_category IS NOT NULL GROUP BY user_id, product_category) WHERE r = 1)"""


@register("g22_user_features_with_dummies", f"WITH {Q.raw_cte('events')}, f AS ({Q.user_features_sql('events', AS_OF)}), {_TOP_OF} SELECT f.*, "
          + ", ".join(f"CAST(coalesce(v, 'Unknown') = '{v}' AS INTEGER) AS top_category_{v}" for v in _EVENT_TYPES[1:])
          + " FROM f LEFT JOIN top USING (user_id)")
def q_g22(spark, sf):
    """User features with the dummies of the commonest category (capped to ten values, none: Unknown)."""
    return build_user_features(tx_from_events(spark, sf), as_of=AS_OF, include_one_hot=True)


# --- score consumers on the distance scores ----------------------------------------------------

@register("e6_qq_ranks", f"""WITH {PQ._scores_sql()}, {PQ._FLAG}, n AS (SELECT anomaly_score AS v, row_number() OVER (ORDER BY anomaly_score) - 1 AS r, count(*) OVER () AS n
FROM fl WHERE NOT is_anomaly) SELECT r AS rank, v AS sample_quantile, {SR('0.01 + 0.98 * r / greatest(n - 1, 1)', 6)} AS probability FROM n""")
def q_e6_ranks(spark, sf):
    out = A.qq_points(A.flag_by_contamination(PQ._scores(spark, sf), 0.02))
    return out.select("rank", "sample_quantile", R("probability", 6).alias("probability"))


_EXPORTED = ["transaction_id", "user_id", "product_amount", "anomaly_score", "threshold", "is_above_threshold", "severity"]


@register("a8_export_of_distance_scores", f"WITH {PQ._scores_sql()}, {PQ._AN} SELECT {', '.join(_EXPORTED)} FROM an WHERE is_above_threshold")
def q_a8(spark, sf):
    """Suspicious transactions written as CSV and read back."""
    flagged = PQ._analyzed(spark, sf).where("is_above_threshold").select(*_EXPORTED)
    path = write_csv(flagged, _scratch(spark))
    schema = "transaction_id string, user_id string, product_amount double, anomaly_score double, threshold double, is_above_threshold boolean, severity string"
    return spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').csv(path)


# --- prepared model inputs -------------------------------------------------------------------------

@register("m3_prepared_for_pca", """WITH c AS (SELECT event_type, row_number() OVER (ORDER BY min(event_id)) - 1 AS code FROM events GROUP BY 1)
SELECT event_id, CAST(value AS DOUBLE) AS value, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, CAST(code AS DOUBLE) AS event_type
FROM events JOIN c USING (event_type)""")
def q_m3(spark, sf):
    """A number, numbers kept as text, and a text column that gets codes; a constant column goes."""
    ev = read_table(spark, sf, "events").select("event_id", "value", F.get_json_object("props", "$.k").alias("k"), "event_type", F.lit(3).alias("same"))
    clean, _ = prepare_for_pca(ev, ["event_id"])
    return clean


_GAPS = "CASE WHEN event_id % 10 > 2 THEN value END"


@register("m5_prepared_for_models", f"""SELECT event_id, CAST(user_id AS DOUBLE) AS user_id, coalesce({_GAPS}, (SELECT median({_GAPS}) FROM events)) AS value FROM events""")
def q_m5(spark, sf):
    """Nulls and infinite values become the median; an empty column and a text column go (M4 and M5)."""
    value = F.when(F.col("event_id") % 10 > 2, F.col("value")).when(F.col("event_id") % 10 == 2, F.lit(float("inf"))).when(F.col("event_id") % 10 == 1, F.lit(float("nan")))
    ev = read_table(spark, sf, "events").select("event_id", "user_id", value.alias("value"), "event_type", F.lit(None).cast("double").alias("nothing"))
    return S.prepare_for_clustering(ev, ["event_id"])


@register("b23_profile_columns", f"""WITH {Q.raw_cte('orders')}, long AS ({PQ._long_sql('raw', PQ.NUMS, PQ._GRP)}),
s AS (SELECT {PQ._GRP}, count(*) AS size FROM raw GROUP BY 1)
SELECT {SR('avg(value)', 3)} AS mean, any_value(size) AS size, {SR('any_value(size) * 100.0 / (SELECT count(*) FROM raw)', 1)} AS size_pct
FROM long JOIN s USING ({PQ._GRP}) GROUP BY {PQ._GRP}, feature""")
def q_b23(spark, sf):
    return P.columns_matching(P.group_profiles(tx_from_orders(spark, sf), PQ._GRP, PQ.NUMS), ("mean", "size", "pct"))
