"""Registered queries for profiling (D21-D40), encoders (C8, E2) and the
score-consuming operators (M26-M30, B17, D31, D36, F1, F2).

The score-consuming operators run on the reference's own distance-to-centre
score (M28) of the orders-derived transactions, so each of them is checked
exactly against SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.scalar import round_half_up as R, sql_round as SR
from txlens.operators import anomaly as A
from txlens.operators import profile as P
from txlens.operators.encode import cap_top_n, ordinal_code_tables, top_values
from txlens.plans import sql as Q
from txlens.plans.queries import _NULLS, _events_with_nulls, register
from txlens.sources.adapters import tx_from_events, tx_from_orders

NUMS = ["product_amount", "transaction_fee", "cashback", "loyalty_points"]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _long_sql(src: str, cols: list[str], keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    return _union([f"SELECT {k}'{c}' AS feature, CAST({Q.fin(f'CAST({c} AS DOUBLE)')} AS DOUBLE) AS value FROM {src}"
                   for c in cols])


# --- D24 / D25 / D30: describe ----------------------------------------------

def _describe_sql(src: str, cols: list[str], digits: int) -> str:
    return (f"SELECT feature, count(value) AS count, {SR('avg(value)', digits)} AS mean, "
            f"{SR('stddev_samp(value)', digits)} AS std, {SR('min(value)', digits)} AS min, "
            f"{SR('quantile_cont(value, 0.25)', digits)} AS p25, {SR('quantile_cont(value, 0.5)', digits)} AS p50, "
            f"{SR('quantile_cont(value, 0.75)', digits)} AS p75, {SR('max(value)', digits)} AS max "
            f"FROM ({_long_sql(src, cols)}) GROUP BY feature")


@register("d24_describe", f"WITH {Q.raw_cte('orders')} {_describe_sql('raw', NUMS, 6)}")
def q_d24(spark, sf):
    return P.describe(tx_from_orders(spark, sf), NUMS)


_D25_SQL = (f"WITH {_NULLS}, d AS ({_describe_sql('ev', ['value', 'k'], 3)}), "
            "m AS (SELECT feature, CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing, count(*) AS _rows "
            f"FROM ({_long_sql('ev', ['value', 'k'])}) GROUP BY feature) "
            f"SELECT d.*, m.missing, {SR('m.missing * 100.0 / m._rows', 2)} AS missing_pct, 'double' AS dtype "
            "FROM d JOIN m USING (feature)")


@register("d25_feature_stats", _D25_SQL)
def q_d25(spark, sf):
    return P.feature_stats(_events_with_nulls(spark, sf), ["value", "k"])


@register("d30_variance", f"WITH {Q.raw_cte('orders')} SELECT feature, {SR('var_samp(value)', 4)} AS variance "
                          f"FROM ({_long_sql('raw', NUMS)}) GROUP BY feature")
def q_d30(spark, sf):
    v = P.variances(tx_from_orders(spark, sf), NUMS)
    return v.select("feature", R("variance", 4).alias("variance"))


ORACLE_FIX = {}


# --- D26 / D27 / D28: quality --------------------------------------------------

_D26_SQL = (f"WITH {_NULLS} SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS n_columns, "
            "'event_id,user_id,value,k' AS numeric_columns, '' AS categorical_columns, "
            "CAST(sum((event_id IS NULL)::BIGINT + (user_id IS NULL)::BIGINT + (value IS NULL)::BIGINT + (k IS NULL)::BIGINT) "
            "AS BIGINT) AS missing_values, "
            f"{SR('sum((event_id IS NULL)::BIGINT + (user_id IS NULL)::BIGINT + (value IS NULL)::BIGINT + (k IS NULL)::BIGINT) * 100.0 / (count(*) * 4)', 4)} "
            "AS missing_percentage, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ev)) AS duplicate_rows FROM ev")


@register("d26_data_quality", _D26_SQL)
def q_d26(spark, sf):
    return P.data_quality(_events_with_nulls(spark, sf))


_TX_COLS = [("user_id", "string"), ("transaction_id", "string"), ("transaction_date", "timestamp"),
            ("product_category", "string"), ("product_amount", "double"), ("transaction_fee", "double"),
            ("cashback", "double"), ("loyalty_points", "double"), ("payment_method", "string"),
            ("device_type", "string"), ("location", "string")]

_D27_SQL = f"WITH {Q.raw_cte('orders')} " + _union([
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(DISTINCT {c}) AS n_distinct, "
    f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_missing FROM raw" for c, t in _TX_COLS])


@register("d27_column_profile", _D27_SQL)
def q_d27(spark, sf):
    return P.column_profile(tx_from_orders(spark, sf))


_D28_SQL = f"WITH {_NULLS}, m AS (" + _union([
    f"SELECT '{c}' AS \"column\", sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)::BIGINT AS missing, count(*) AS _n FROM ev"
    for c in ("event_id", "user_id", "value", "k")]) + \
    f") SELECT \"column\", missing, {SR('missing * 100.0 / _n', 2)} AS missing_pct FROM m WHERE missing > 0"


@register("d28_missing_values", _D28_SQL)
def q_d28(spark, sf):
    return P.missing_table(_events_with_nulls(spark, sf))


# --- D29: correlation of the user features ------------------------------------

def _corr_sql() -> str:
    from txlens.operators.user_features import USER_FEATURE_COLUMNS
    cols = [c for c in USER_FEATURE_COLUMNS if c in _EVENTS_UF_COLS]
    parts = [f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, "
             f"{SR(Q.fin(f'covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0)'), 2)} AS corr FROM uf"
             for a in cols for b in cols]
    return f"WITH {Q.user_features_ctes('events', '2026-01-01 00:00:00')} {_union(parts)}"


_EVENTS_UF_COLS = ["nb_transactions", "total_amount", "avg_amount", "std_amount", "min_amount", "max_amount",
                   "total_loyalty_points", "avg_loyalty_points", "max_loyalty_points", "nb_categories",
                   "top_category_freq", "transaction_frequency", "days_since_last_transaction",
                   "preferred_weekday", "preferred_hour", "amount_variability"]


@register("d29_correlation", _corr_sql())
def q_d29(spark, sf):
    from txlens.operators.user_features import build_user_features
    uf = build_user_features(tx_from_events(spark, sf), as_of="2026-01-01 00:00:00")
    return P.correlation(uf, _EVENTS_UF_COLS)


# --- D33 / D34 / D35 / D21 ------------------------------------------------------

_D33_SQL = (f"WITH {Q.raw_cte('events')} SELECT count(*) AS n_transactions, CAST(6 AS BIGINT) AS n_columns, "
            "count(DISTINCT user_id) AS n_users, strftime(min(transaction_date), '%Y-%m-%d %H:%M:%S') AS first_date, "
            "strftime(max(transaction_date), '%Y-%m-%d %H:%M:%S') AS last_date FROM raw")


@register("d33_kpis", _D33_SQL)
def q_d33(spark, sf):
    k = P.kpis(tx_from_events(spark, sf))
    return k.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_date", "last_date")})


_D34_SQL = (f"WITH {Q.raw_cte('events')}, r AS (SELECT min(product_amount) AS _mn, max(product_amount) AS _mx FROM raw), "
            "b AS (SELECT CAST(CASE WHEN _mx = _mn THEN 0 ELSE least(floor((product_amount - _mn) / (_mx - _mn) * 50), 49) "
            "END AS INTEGER) AS bin, _mn, _mx FROM raw, r WHERE product_amount IS NOT NULL) "
            "SELECT bin, min(_mn) + bin * (min(_mx) - min(_mn)) / 50 AS lower, "
            "min(_mn) + (bin + 1) * (min(_mx) - min(_mn)) / 50 AS upper, count(*) AS count FROM b GROUP BY bin")


@register("d34_histogram", _D34_SQL)
def q_d34(spark, sf):
    h = P.histogram(tx_from_events(spark, sf), "product_amount", bins=50)
    return h.select("bin", R("lower", 6).alias("lower"), R("upper", 6).alias("upper"), "count")


ORACLE_FIX["d34_histogram"] = _D34_SQL.replace(
    "SELECT bin, min(_mn) + bin * (min(_mx) - min(_mn)) / 50 AS lower, "
    "min(_mn) + (bin + 1) * (min(_mx) - min(_mn)) / 50 AS upper, count(*) AS count FROM b GROUP BY bin",
    f"SELECT bin, {SR('min(_mn) + bin * (min(_mx) - min(_mn)) / 50', 6)} AS lower, "
    f"{SR('min(_mn) + (bin + 1) * (min(_mx) - min(_mn)) / 50', 6)} AS upper, count(*) AS count FROM b GROUP BY bin")


def _box_sql() -> str:
    q = ("SELECT product_category, count(product_amount) AS n, min(product_amount) AS min, "
         "quantile_cont(product_amount, 0.25) AS q1, quantile_cont(product_amount, 0.5) AS median, "
         "quantile_cont(product_amount, 0.75) AS q3, max(product_amount) AS max FROM raw GROUP BY 1")
    f = ("SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q")
    o = ("SELECT r.product_category, sum(CASE WHEN r.product_amount < f.lower_fence OR r.product_amount > f.upper_fence "
         "THEN 1 ELSE 0 END)::BIGINT AS n_outliers FROM raw r JOIN f USING (product_category) GROUP BY 1")
    cols = ["min", "q1", "median", "q3", "max", "iqr", "lower_fence", "upper_fence"]
    sel = ", ".join(f"{SR(f'f.{c}', 6)} AS {c}" for c in cols)
    return (f"WITH {Q.raw_cte('orders')}, q AS ({q}), f AS ({f}), o AS ({o}) "
            f"SELECT f.product_category, f.n, {sel}, COALESCE(o.n_outliers, 0) AS n_outliers "
            "FROM f LEFT JOIN o USING (product_category)")


@register("d35_box_summary", _box_sql())
def q_d35(spark, sf):
    return P.box_summary(tx_from_orders(spark, sf), "product_amount", by=["product_category"])


@register("d21_top_values", f"WITH {Q.raw_cte('orders')} SELECT location, count(*) AS count FROM raw "
                            "WHERE location IS NOT NULL GROUP BY 1 ORDER BY count DESC, location LIMIT 10")
def q_d21(spark, sf):
    return top_values(tx_from_orders(spark, sf), "location", 10)


_C8_SQL = (f"WITH {Q.raw_cte('orders')}, t AS (SELECT location FROM raw WHERE location IS NOT NULL GROUP BY 1 "
           "ORDER BY count(*) DESC, location LIMIT 5) "
           "SELECT CASE WHEN t.location IS NULL THEN 'Other' ELSE r.location END AS location, count(*) AS n "
           "FROM raw r LEFT JOIN t ON r.location = t.location GROUP BY 1")


@register("c8_top_n_capping", _C8_SQL)
def q_c8(spark, sf):
    capped = cap_top_n(tx_from_orders(spark, sf), "location", 5)
    return capped.groupBy("location").agg(F.count(F.lit(1)).alias("n"))


_E2_SQL = (f"WITH {Q.raw_cte('orders')}, l AS (" + _union([
    f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS val, transaction_id FROM raw WHERE {c} IS NOT NULL"
    for c in ("payment_method", "location")]) + "), f AS (SELECT col, val, min(transaction_id) AS first_key, "
    "count(*) AS n FROM l GROUP BY 1, 2) SELECT col, val, n, CAST(row_number() OVER (PARTITION BY col ORDER BY "
    "first_key, val) - 1 AS DOUBLE) AS code FROM f")


@register("e2_ordinal_codes", _E2_SQL)
def q_e2(spark, sf):
    return ordinal_code_tables(tx_from_orders(spark, sf), ["payment_method", "location"])


# --- D22 / D23 / D37 / D40 on a fixed label (the return flag as device type) --------

_GRP = "device_type"


@register("d22_group_profiles",
          f"WITH {Q.raw_cte('orders')}, l AS ({_long_sql('raw', NUMS, _GRP)}), "
          f"s AS (SELECT {_GRP}, count(*) AS size FROM raw GROUP BY 1), "
          f"p AS (SELECT {_GRP}, size, {SR('size * 100.0 / sum(size) OVER ()', 1)} AS size_pct FROM s) "
          f"SELECT l.{_GRP}, feature, {SR('avg(value)', 3)} AS mean, {SR('stddev_samp(value)', 3)} AS std, "
          f"{SR('min(value)', 3)} AS min, {SR('max(value)', 3)} AS max, count(value) AS count, "
          f"min(p.size) AS size, min(p.size_pct) AS size_pct FROM l JOIN p USING ({_GRP}) GROUP BY l.{_GRP}, feature")
def q_d22(spark, sf):
    return P.group_profiles(tx_from_orders(spark, sf), _GRP, NUMS)


@register("d23_group_sizes", f"WITH {Q.raw_cte('orders')}, s AS (SELECT {_GRP}, count(*) AS size FROM raw GROUP BY 1) "
                             f"SELECT {_GRP}, size, {SR('size * 100.0 / sum(size) OVER ()', 1)} AS size_pct FROM s")
def q_d23(spark, sf):
    return P.group_sizes(tx_from_orders(spark, sf), _GRP)


@register("d37_group_signature",
          f"WITH {Q.raw_cte('orders')}, m AS (SELECT {_GRP}, feature, {SR('avg(value)', 6)} AS mean "
          f"FROM ({_long_sql('raw', NUMS, _GRP)}) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER "
          f"(PARTITION BY {_GRP} ORDER BY mean DESC, feature) AS rank FROM m) SELECT * FROM r WHERE rank <= 3")
def q_d37(spark, sf):
    return P.group_signature(tx_from_orders(spark, sf), _GRP, NUMS, top=3).withColumn("rank", F.col("rank").cast("bigint"))


@register("d40_distinct_labels", f"WITH {Q.raw_cte('orders')} SELECT DISTINCT {_GRP} FROM raw")
def q_d40(spark, sf):
    return P.distinct_labels(tx_from_orders(spark, sf), _GRP)


# --- score consumers on the M28 distance of the orders transactions ----------------

def _scores(spark, sf) -> DataFrame:
    return A.distance_scores(tx_from_orders(spark, sf), NUMS, ["transaction_id"])


def _scores_sql() -> str:
    st = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(NUMS))
    ss = "0.0"
    for i, c in enumerate(NUMS):
        z = f"((CAST({c} AS DOUBLE) - m{i}) / (CASE WHEN s{i} = 0 OR s{i} IS NULL THEN 1.0 ELSE s{i} END))"
        ss = f"({ss} + {z} * {z})"
    return (f"{Q.raw_cte('orders')}, st AS (SELECT {st} FROM raw), "
            f"sc AS (SELECT transaction_id, {SR(f'sqrt({ss})', 6)} AS anomaly_score FROM raw, st)")


@register("m28_distance_scores", f"WITH {_scores_sql()} SELECT * FROM sc")
def q_m28(spark, sf):
    return _scores(spark, sf)


_FLAG = ("fl AS (SELECT sc.*, sc.anomaly_score > t.threshold AS is_anomaly FROM sc, "
         "(SELECT quantile_cont(anomaly_score, 0.98) AS threshold FROM sc) t)")


@register("m26_flag_contamination", f"WITH {_scores_sql()}, {_FLAG} SELECT * FROM fl")
def q_m26(spark, sf):
    return A.flag_by_contamination(_scores(spark, sf), 0.02)


_AN = ("an AS (SELECT r.transaction_id, r.user_id, r.product_category, r.product_amount, r.cashback, "
       "r.payment_method, sc.anomaly_score, " + SR("t.threshold", 6) + " AS threshold, "
       "sc.anomaly_score >= t.threshold AS is_above_threshold, "
       "CASE WHEN sc.anomaly_score > t.threshold * 1.5 THEN 'high' WHEN sc.anomaly_score > t.threshold "
       "THEN 'elevated' ELSE 'normal' END AS severity FROM raw r JOIN sc USING (transaction_id), "
       "(SELECT quantile_cont(anomaly_score, 0.95) AS threshold FROM sc) t)")

_AN_COLS = ["transaction_id", "user_id", "product_category", "product_amount", "cashback", "payment_method"]


def _analyzed(spark, sf) -> DataFrame:
    raw = A.cut(tx_from_orders(spark, sf).select(*_AN_COLS, *[c for c in NUMS if c not in _AN_COLS]))  # read by the scaler, the scores and the join
    scaler = A.Scaler.fit(raw, NUMS)
    scaler = A.Scaler(scaler.cols, A.cut(scaler.stats))  # one row, not computed again by every reader
    return A.analyze_anomalies(A.distance_scores(raw, NUMS, _AN_COLS, scaler=scaler))


@register("m29_analyze_anomalies", f"WITH {_scores_sql()}, {_AN} SELECT * FROM an")
def q_m29(spark, sf):
    return _analyzed(spark, sf)


_STATS_COLS = ["score_median", "score_q25", "score_q75", "score_q95", "score_q99"]
_STATS_SQL = (f"WITH {_scores_sql()}, {_FLAG} SELECT count(*) AS n_total, CAST(sum(is_anomaly::BIGINT) AS BIGINT) AS n_anomalies, "
              f"{SR('sum(is_anomaly::BIGINT) * 100.0 / count(*)', 4)} AS pct_anomalies, "
              f"{SR('avg(anomaly_score)', 4)} AS score_mean, {SR('stddev_pop(anomaly_score)', 4)} AS score_std, "
              f"{SR('min(anomaly_score)', 4)} AS score_min, {SR('max(anomaly_score)', 4)} AS score_max, "
              + ", ".join(f"{SR(f'quantile_cont(anomaly_score, {p})', 4)} AS {n}"
                          for p, n in zip((0.5, 0.25, 0.75, 0.95, 0.99), _STATS_COLS)) + " FROM fl")


@register("d31_anomaly_statistics", _STATS_SQL)
def q_d31(spark, sf):
    return A.anomaly_statistics(A.flag_by_contamination(_scores(spark, sf), 0.02))


@register("f2_top_anomalies", f"WITH {_scores_sql()}, {_AN} SELECT transaction_id, user_id, product_category, "
                              "product_amount, cashback, payment_method, anomaly_score, severity FROM an "
                              "WHERE is_above_threshold ORDER BY anomaly_score DESC, transaction_id LIMIT 20")
def q_f2(spark, sf):
    return A.top_anomalies(_analyzed(spark, sf), 20)


@register("d36_anomaly_patterns",
          f"WITH {_scores_sql()}, {_AN}, " + "x AS (" + _union([
              f"(SELECT '{c}' AS attribute, CAST({c} AS VARCHAR) AS value, count(*) AS count FROM an "
              f"WHERE is_above_threshold AND {c} IS NOT NULL GROUP BY {c} ORDER BY count DESC, {c} LIMIT 10)"
              for c in ("product_category", "payment_method")]) + ") SELECT * FROM x")
def q_d36(spark, sf):
    return A.anomaly_patterns(_analyzed(spark, sf))


_M30_P = (95, 97.5, 99, 99.5)
_M30_SQL = (f"WITH {_scores_sql()}, t AS (SELECT " + ", ".join(
    f"quantile_cont(anomaly_score, {p / 100.0}) AS t{i}" for i, p in enumerate(_M30_P)) + " FROM sc), "
    "s AS (SELECT " + ", ".join(f"{SR(f'sum((anomaly_score > t{i})::BIGINT) / count(*)', 4)} AS s{i}"
                                for i in range(len(_M30_P))) + " FROM sc, t) "
    "SELECT " + ", ".join(f"s{i} AS share_p{str(p).replace('.', '_')}" for i, p in enumerate(_M30_P))
    + f", {SR('least(greatest((0.0 + s0 + s1 + s2 + s3) / 4.0, 0.001), 0.1)', 6)} AS suggested_contamination FROM s")


@register("m30_suggest_contamination", _M30_SQL)
def q_m30(spark, sf):
    return A.suggest_contamination(_scores(spark, sf))


@register("m27_mahalanobis_scores")
def q_m27(spark, sf):
    return A.mahalanobis_scores(tx_from_orders(spark, sf), NUMS, ["transaction_id"])


def _report_sql() -> str:
    number = lambda x: f"rtrim(rtrim(printf('%.4f', {SR(x, 4)}), '0'), '.')"
    text = lambda x: f"CAST({x} AS VARCHAR)"
    said = [("data", "transactions", text("n")), ("data", "features", "'4'"), ("data", "first_day", "strftime(first, '%Y-%m-%d')"),
            ("data", "last_day", "strftime(last, '%Y-%m-%d')"), ("result", "contamination", "'0.02'"), ("result", "anomalies", text("flagged")),
            ("result", "anomaly_pct", number("flagged * 100.0 / n")), ("result", "mean_score", number("mean")), ("result", "largest_score", number("largest")),
            ("result", "threshold", number("threshold")), ("result", "rows_above_threshold", text("above")),
            *[("distribution", x, number(x)) for x in ("q25", "median", "q75", "q95", "q99")], ("quality", "score_separation", number("(mean - normal) / mean"))]
    top = [("transaction_id", "transaction_id"), ("score", number("anomaly_score")), ("product_amount", number("product_amount")),
           ("product_category", "coalesce(product_category, 'unknown')"), ("user_id", "coalesce(user_id, 'unknown')")]
    return (f"WITH {_scores_sql()}, {_AN}, lim AS (SELECT quantile_cont(anomaly_score, 0.98) AS lim, "
            + ", ".join(f"quantile_cont(anomaly_score, {p}) AS {n}" for p, n in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"), (0.95, "q95"), (0.99, "q99")))
            + " FROM sc), days AS (SELECT min(transaction_date) AS first, max(transaction_date) AS last FROM raw), "
            "one AS (SELECT count(*) AS n, count(*) FILTER (anomaly_score > lim) AS flagged, avg(anomaly_score) AS mean, max(anomaly_score) AS largest, "
            "max(threshold) AS threshold, count(*) FILTER (is_above_threshold) AS above, avg(anomaly_score) FILTER (anomaly_score <= lim) AS normal, "
            "any_value(q25) AS q25, any_value(median) AS median, any_value(q75) AS q75, any_value(q95) AS q95, any_value(q99) AS q99 FROM an, lim), "
            "best AS (SELECT *, row_number() OVER (ORDER BY anomaly_score DESC, transaction_id) AS item FROM an WHERE is_above_threshold "
            "ORDER BY anomaly_score DESC, transaction_id LIMIT 5) "
            + _union([f"SELECT '{a}' AS section, CAST(NULL AS INTEGER) AS item, '{b}' AS metric, {v} AS value FROM one, days" for a, b, v in said]
                     + [f"SELECT 'top', CAST(item AS INTEGER), '{m}', {v} FROM best" for m, v in top]))


@register("m42_anomaly_report", _report_sql())
def q_m42(spark, sf):
    shown = [*_AN_COLS, "transaction_date"]
    raw = A.cut(tx_from_orders(spark, sf).select(*shown, *[c for c in NUMS if c not in shown]))  # read by the scaler, the scores and the join
    analyzed = A.analyze_anomalies(raw.select(*shown), A.distance_scores(raw, NUMS, ["transaction_id"]), ordered=False)
    return A.anomaly_report(analyzed, 0.02, len(NUMS))


def _apply_fixes():
    from txlens.plans.queries import ORACLE
    ORACLE.update(ORACLE_FIX)


_apply_fixes()


@register("e6_qq_points")
def q_e6(spark, sf):
    return A.qq_points(A.flag_by_contamination(_scores(spark, sf), 0.02))


@register("b21_seeded_sample")
def q_b21(spark, sf):
    from txlens.operators.explain import sample_rows
    return sample_rows(tx_from_orders(spark, sf), "transaction_id", 200, seed=42)


@register("b23_columns_matching")
def q_b23(spark, sf):
    return P.columns_matching(P.group_profiles(tx_from_orders(spark, sf), _GRP, NUMS),
                              ("mean", "size", "pct"))


@register("f7_preview", f"WITH {Q.raw_cte('orders')} SELECT * FROM raw ORDER BY transaction_id LIMIT 10")
def q_f7(spark, sf):
    """the first 10 transactions in key order (a preview is the feature)."""
    return tx_from_orders(spark, sf).orderBy("transaction_id").limit(10)


def _scaled_sql() -> str:
    st = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(NUMS))
    cols = ", ".join(f"((CAST({c} AS DOUBLE) - m{i}) / (CASE WHEN s{i} = 0 OR s{i} IS NULL THEN 1.0 ELSE s{i} END)) "
                     f"AS {c}" for i, c in enumerate(NUMS))
    return (f"{Q.raw_cte('orders')}, st AS (SELECT {st} FROM raw), "
            f"z AS (SELECT transaction_id, {_GRP}, {cols} FROM raw, st)")


@register("m1_scale_features", f"WITH {_scaled_sql()} SELECT transaction_id, "
                               + ", ".join(f"{SR(c, 6)} AS {c}" for c in NUMS) + " FROM z")
def q_m1(spark, sf):
    scaled, _ = A.scale_features(tx_from_orders(spark, sf), NUMS, keep=["transaction_id"])
    return scaled.select("transaction_id", *[R(c, 6).alias(c) for c in NUMS])


def _db_sql() -> str:
    cent = ", ".join(f"avg({c}) AS c_{c}" for c in NUMS)
    dist = " + ".join(f"(z.{c} - ce.c_{c}) * (z.{c} - ce.c_{c})" for c in NUMS)
    cdist = " + ".join(f"(a.c_{c} - b.c_{c}) * (a.c_{c} - b.c_{c})" for c in NUMS)
    return (f"WITH {_scaled_sql()}, ce AS (SELECT {_GRP}, {cent} FROM z GROUP BY 1), "
            f"s AS (SELECT z.{_GRP}, avg(sqrt({dist})) AS s FROM z JOIN ce USING ({_GRP}) GROUP BY 1), "
            f"r AS (SELECT a.{_GRP}, max((sa.s + sb.s) / sqrt({cdist})) AS r FROM ce a JOIN ce b "
            f"ON a.{_GRP} <> b.{_GRP} JOIN s sa ON sa.{_GRP} = a.{_GRP} JOIN s sb ON sb.{_GRP} = b.{_GRP} "
            f"GROUP BY 1) SELECT {SR('avg(r)', 6)} AS davies_bouldin FROM r")


@register("m22_davies_bouldin", _db_sql())
def q_m22(spark, sf):
    """Davies-Bouldin index of the fixed label (return flag) on the scaled amounts."""
    from txlens.operators.segment import davies_bouldin
    rows = A.cut(tx_from_orders(spark, sf).select(_GRP, *NUMS))  # read by the scaler, the centroids and the spreads
    scaled, _ = A.scale_features(rows, NUMS, keep=[_GRP])
    db = davies_bouldin(scaled, NUMS, label=_GRP)
    return spark.createDataFrame([(db,)], "davies_bouldin double").select(R("davies_bouldin", 6).alias("davies_bouldin"))
