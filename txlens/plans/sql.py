"""SQL twins of the feature builders, used as DuckDB oracles.

These strings restate each operator's definition in plain SQL over the
driver's tables (views ``events``, ``lineitem``, ...). They are only used to
check the Spark operators; nothing in the library executes them.
"""

from __future__ import annotations

from txlens.functions.scalar import sql_round as R
from txlens.sources.adapters import TX_FROM_EVENTS_SQL, TX_FROM_ORDERS_SQL

SOURCES = {
    "events": dict(raw=TX_FROM_EVENTS_SQL, nums=["product_amount", "loyalty_points"],
                   cats=["product_category"]),
    "orders": dict(raw=TX_FROM_ORDERS_SQL,
                   nums=["product_amount", "transaction_fee", "cashback", "loyalty_points"],
                   cats=["product_category", "payment_method", "device_type", "location"]),
}

# Categorical values of the orders adapter (p_type, o_orderpriority,
# l_returnflag, n_name) - identical in every scale of the driver data.
ORDERS_VALUES = {
    "product_category": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"],
    "payment_method": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "device_type": ["A", "N", "R"],
    "location": sorted(f"NATION_{i}" for i in range(25)),
}


def rz(a: str, b: str) -> str:
    """ratio, 0 when the denominator is 0 / null (pandas Inf / NaN -> 0)."""
    return f"(CASE WHEN ({b}) = 0 OR ({b}) IS NULL OR ({a}) IS NULL THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END)"


def r1(a: str, b: str) -> str:
    """ratio with a zero denominator replaced by 1; null -> 0."""
    return f"COALESCE(CAST({a} AS DOUBLE) / (CASE WHEN ({b}) = 0 THEN 1.0 ELSE ({b}) END), 0.0)"


def fin(x: str) -> str:
    return f"(CASE WHEN isnan({x}) OR isinf({x}) THEN NULL ELSE {x} END)"


def days(a: str, b: str) -> str:
    return f"CAST(floor((epoch_us({b}) - epoch_us({a})) / 86400000000) AS BIGINT)"


def raw_cte(src: str) -> str:
    return f"raw AS ({SOURCES[src]['raw']})"


def pre_ctes(src: str, min_count: int = 10) -> str:
    """CTEs ending in ``pre``: the preprocessed transactions."""
    s = SOURCES[src]
    cols = ["user_id", "transaction_id", "transaction_date", *s["cats"]]
    cols += [f"COALESCE({fin(c)}, 0) AS {c}" for c in s["nums"]]
    cols += ["CAST(COALESCE(hour(transaction_date), 0) AS INTEGER) AS transaction_hour",
             "CAST(COALESCE(day(transaction_date), 0) AS INTEGER) AS transaction_day",
             "CAST(COALESCE(month(transaction_date), 0) AS INTEGER) AS transaction_month",
             "CAST(COALESCE(isodow(transaction_date) - 1, 0) AS INTEGER) AS transaction_dayofweek"]
    ctes = [raw_cte(src), f"pre0 AS (SELECT {', '.join(cols)} FROM raw)"]
    for i, c in enumerate(s["cats"]):
        ctes.append(f"k{i} AS (SELECT {c} AS val, count(*) AS n FROM pre0 WHERE {c} IS NOT NULL GROUP BY 1)")
    repl = ", ".join(f"CASE WHEN p.{c} IS NULL THEN NULL WHEN k{i}.n < {min_count} THEN 'Other' ELSE p.{c} END AS {c}"
                     for i, c in enumerate(s["cats"]))
    joins = " ".join(f"LEFT JOIN k{i} ON p.{c} = k{i}.val" for i, c in enumerate(s["cats"]))
    ctes.append(f"pre AS (SELECT p.* REPLACE ({repl}) FROM pre0 p {joins})")
    return ",\n".join(ctes)


def preprocess_sql(src: str) -> str:
    return f"WITH {pre_ctes(src)} SELECT * FROM pre"


def user_features_ctes(src: str, as_of: str) -> str:
    """CTEs ending in ``uf``: the current-generation user features."""
    s = SOURCES[src]
    has = lambda c: c in s["nums"] or c in s["cats"]
    b = ["user_id", "count(transaction_id) AS nb_transactions", "count(*) AS _rows",
         f"{R('sum(product_amount)', 2)} AS total_amount", f"{R('avg(product_amount)', 2)} AS avg_amount",
         f"{R('stddev_samp(product_amount)', 2)} AS std_amount", f"{R('min(product_amount)', 2)} AS min_amount",
         f"{R('max(product_amount)', 2)} AS max_amount",
         "min(transaction_date) AS _first", "max(transaction_date) AS _last"]
    if has("cashback"):
        b += [f"{R('sum(cashback)', 3)} AS total_cashback", f"{R('avg(cashback)', 3)} AS avg_cashback",
              f"{R('stddev_samp(cashback)', 3)} AS std_cashback", f"{R('max(cashback)', 3)} AS max_cashback"]
    if has("loyalty_points"):
        b += [f"{R('sum(loyalty_points)', 2)} AS total_loyalty_points",
              f"{R('avg(loyalty_points)', 2)} AS avg_loyalty_points",
              f"{R('max(loyalty_points)', 2)} AS max_loyalty_points"]
    if has("transaction_fee"):
        b += [f"{R('sum(transaction_fee)', 3)} AS total_fees", f"{R('avg(transaction_fee)', 3)} AS avg_fee",
              f"{R('max(transaction_fee)', 3)} AS max_fee"]
    attrs = [(c, f"CAST({c} AS VARCHAR)", f"{c} IS NOT NULL") for c in s["cats"]]
    attrs += [("weekday", "lpad(CAST(isodow(transaction_date) - 1 AS VARCHAR), 2, '0')", "transaction_date IS NOT NULL"),
              ("hour", "lpad(CAST(hour(transaction_date) AS VARCHAR), 2, '0')", "transaction_date IS NOT NULL")]
    lng = " UNION ALL ".join(f"SELECT user_id, '{a}' AS attr, {v} AS val FROM pre WHERE {w}" for a, v, w in attrs)
    prof = ", ".join(f"max(CASE WHEN attr = '{a}' THEN nun END) AS {a}_nunique, "
                     f"max(CASE WHEN attr = '{a}' AND rn = 1 THEN val END) AS {a}_top, "
                     f"max(CASE WHEN attr = '{a}' AND rn = 1 THEN n END) AS {a}_top_n" for a, _, _ in attrs)
    u = ["b.user_id", "nb_transactions", "total_amount", "avg_amount", "std_amount", "min_amount", "max_amount"]
    if has("cashback"):
        u += ["total_cashback", "avg_cashback", "std_cashback", "max_cashback",
              f"{R(rz('total_cashback', 'total_amount'), 4)} AS cashback_ratio"]
    if has("loyalty_points"):
        u += ["total_loyalty_points", "avg_loyalty_points", "max_loyalty_points"]
    if has("product_category"):
        u += ["COALESCE(product_category_nunique, 0) AS nb_categories",
              "COALESCE(CAST(product_category_top_n AS DOUBLE) / _rows, 0.0) AS top_category_freq"]
    for c, name in (("payment_method", "nb_payment_methods"), ("device_type", "nb_device_types"),
                    ("location", "nb_locations")):
        if has(c):
            u.append(f"COALESCE({c}_nunique, 0) AS {name}")
    span = days("_first", "_last")
    u += [f"{R(rz('nb_transactions', f'CASE WHEN {span} = 0 THEN 1 ELSE {span} END'), 4)} AS transaction_frequency",
          f"CAST({days('_last', f'TIMESTAMP {chr(39)}{as_of}{chr(39)}')} AS DOUBLE) AS days_since_last_transaction",
          "COALESCE(CAST(weekday_top AS INTEGER), 0) AS preferred_weekday",
          "COALESCE(CAST(hour_top AS INTEGER), 12) AS preferred_hour"]
    if has("transaction_fee"):
        u += ["total_fees", "avg_fee", "max_fee", f"{R(rz('total_fees', 'total_amount'), 4)} AS fee_ratio"]
    u.append(f"{R(rz('std_amount', 'avg_amount'), 4)} AS amount_variability")
    nullable = ["std_amount", "days_since_last_transaction"] + (["std_cashback"] if has("cashback") else [])
    med = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in nullable)
    repl = ", ".join(f"COALESCE({c}, m_{c}) AS {c}" for c in nullable)
    return ",\n".join([
        pre_ctes(src),
        f"base AS (SELECT {', '.join(b)} FROM pre GROUP BY user_id)",
        f"lng AS ({lng})",
        "cnt AS (SELECT user_id, attr, val, count(*) AS n FROM lng GROUP BY ALL)",
        "rk AS (SELECT *, row_number() OVER (PARTITION BY user_id, attr ORDER BY n DESC, val) AS rn, "
        "count(*) OVER (PARTITION BY user_id, attr) AS nun FROM cnt)",
        f"prof AS (SELECT user_id, {prof} FROM rk GROUP BY user_id)",
        f"u0 AS (SELECT {', '.join(u)} FROM base b LEFT JOIN prof p ON b.user_id = p.user_id)",
        f"med AS (SELECT {med} FROM u0)",
        f"uf AS (SELECT u0.* REPLACE ({repl}) FROM u0, med)",
    ])


def user_features_sql(src: str, as_of: str) -> str:
    return f"WITH {user_features_ctes(src, as_of)} SELECT * FROM uf"


def _dated_cte() -> str:
    return ("d AS (SELECT *, hour(transaction_date) AS hour, isodow(transaction_date) - 1 AS day_of_week, "
            "day(transaction_date) AS day_of_month, month(transaction_date) AS month, "
            "CASE WHEN isodow(transaction_date) - 1 IN (5, 6) THEN 1 ELSE 0 END AS is_weekend, "
            "CASE WHEN hour(transaction_date) BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS is_night FROM pre)")


def _code_ctes(cats: list[str]) -> list[str]:
    return [f"f_{c} AS (SELECT val, CAST(row_number() OVER (ORDER BY first_key, val) - 1 AS DOUBLE) AS code "
            f"FROM (SELECT CAST({c} AS VARCHAR) AS val, min(transaction_id) AS first_key FROM d "
            f"WHERE {c} IS NOT NULL GROUP BY 1))" for c in cats]


def tx_features_sql(src: str) -> str:
    """M36."""
    s = SOURCES[src]
    cats = s["cats"]
    us = ["user_id", f"{R('avg(product_amount)', 2)} AS user_avg_amount",
          f"{R('stddev_samp(product_amount)', 2)} AS user_std_amount"]
    if "cashback" in s["nums"]:
        us += [f"{R('avg(cashback)', 2)} AS user_avg_cashback", f"{R('stddev_samp(cashback)', 2)} AS user_std_cashback"]
    z = lambda e, n: f"COALESCE(CAST({e} AS DOUBLE), 0.0) AS {n}"
    sel = ["d.transaction_id", "d.user_id"] + [z(f"d.{c}", c) for c in s["nums"]]
    sel += [z(f"d.{c}", c) for c in ("hour", "is_night", "day_of_week", "is_weekend", "day_of_month", "month",
                                     "transaction_hour")]
    sel += [f"COALESCE(f_{c}.code, -1.0) AS {c}_encoded" for c in cats]
    sel += [z("us.user_avg_amount", "user_avg_amount"), z("us.user_std_amount", "user_std_amount"),
            f"{r1('d.product_amount', 'us.user_avg_amount')} AS amount_vs_user_avg"]
    if "cashback" in s["nums"]:
        sel += [z("us.user_avg_cashback", "user_avg_cashback"), z("us.user_std_cashback", "user_std_cashback"),
                f"{r1('d.cashback', 'us.user_avg_cashback')} AS cashback_vs_user_avg"]
    sel.append(f"COALESCE(CASE WHEN d.product_amount > -1 THEN {R('ln(1 + d.product_amount)', 6)} END, 0.0) AS log_amount")
    if "cashback" in s["nums"]:
        sel.append(f"{r1('d.cashback', 'd.product_amount')} AS amount_cashback_ratio")
    joins = " ".join(f"LEFT JOIN f_{c} ON CAST(d.{c} AS VARCHAR) = f_{c}.val" for c in cats)
    ctes = [pre_ctes(src), _dated_cte(), *_code_ctes(cats),
            f"us AS (SELECT {', '.join(us)} FROM d WHERE user_id IS NOT NULL GROUP BY user_id)"]
    return (f"WITH {','.join(ctes)} SELECT {', '.join(sel)} FROM d {joins} "
            f"LEFT JOIN us ON d.user_id = us.user_id")


def tx_features_simple_sql(src: str) -> str:
    """M37."""
    s = SOURCES[src]
    cats = [c for c in ("product_category", "payment_method", "device_type") if c in s["cats"]]
    z = lambda e, n, d=0.0: f"COALESCE(CAST({e} AS DOUBLE), {d}) AS {n}"
    sel = ["d.transaction_id", "d.user_id"] + [z(f"d.{c}", c) for c in s["nums"]]
    sel += [z("d.hour", "hour", 12.0), z("d.day_of_week", "day_of_week"), z("d.is_weekend", "is_weekend")]
    sel += [f"COALESCE(f_{c}.code, -1.0) AS {c}_code" for c in cats]
    sel.append(f"COALESCE({R('(d.product_amount - st._mean) / st._std', 6)}, 0.0) AS amount_zscore")
    sel.append("CAST((CASE WHEN _q1 > _q_min AND d.product_amount > _q1 THEN 1 ELSE 0 END) + "
               "(CASE WHEN _q2 > _q1 AND d.product_amount > _q2 THEN 1 ELSE 0 END) + "
               "(CASE WHEN _q3 > _q2 AND d.product_amount > _q3 THEN 1 ELSE 0 END) AS DOUBLE) AS amount_quartile")
    if "cashback" in s["nums"]:
        sel.append(f"{r1('d.cashback', 'd.product_amount')} AS cashback_ratio")
    st = ("st AS (SELECT avg(product_amount) AS _mean, CASE WHEN stddev_samp(product_amount) IS NULL OR "
          "stddev_samp(product_amount) = 0 THEN 1.0 ELSE stddev_samp(product_amount) END AS _std, "
          "min(product_amount) AS _q_min, quantile_cont(product_amount, 0.25) AS _q1, "
          "quantile_cont(product_amount, 0.5) AS _q2, quantile_cont(product_amount, 0.75) AS _q3 FROM d)")
    joins = " ".join(f"LEFT JOIN f_{c} ON CAST(d.{c} AS VARCHAR) = f_{c}.val" for c in cats)
    ctes = [pre_ctes(src), _dated_cte(), *_code_ctes(cats), st]
    return f"WITH {','.join(ctes)} SELECT {', '.join(sel)} FROM d CROSS JOIN st {joins}"


def legacy_user_features_sql() -> str:
    """M38 on the orders adapter."""
    v = ORDERS_VALUES
    parts = []
    ctes = [raw_cte("orders"),
            "base AS (SELECT user_id, count(transaction_id) AS nb_transactions, "
            "CAST(CAST(sum(CAST(product_amount AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) AS total_amount, "
            "CAST(CAST(sum(CAST(product_amount AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) / count(product_amount) AS avg_amount, "
            "stddev_samp(product_amount) AS std_amount, "
            "CAST(CAST(sum(CAST(transaction_fee AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) AS total_fee, "
            "CAST(CAST(sum(CAST(cashback AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) AS total_cashback, "
            "CAST(CAST(sum(CAST(loyalty_points AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) AS total_loyalty_points "
            "FROM raw GROUP BY user_id)"]
    for i, (c, amount) in enumerate((("product_category", "product_amount"), ("payment_method", None),
                                      ("device_type", None), ("location", None))):
        agg = (lambda val: f"sum(CASE WHEN {c} = '{val}' THEN {amount} END)") if amount else \
              (lambda val: f"count(CASE WHEN {c} = '{val}' THEN 1 END)")
        cols = ", ".join(f"{agg(val)} AS \"{val}\"" for val in v[c])
        ctes.append(f"p{i} AS (SELECT user_id, {cols} FROM raw WHERE {c} IS NOT NULL GROUP BY user_id)")
        tot = " + ".join(f"COALESCE(\"{val}\", 0)" for val in v[c])
        ctes.append(f"s{i} AS (SELECT user_id, " + ", ".join(
            f"COALESCE(CAST(COALESCE(\"{val}\", 0) AS DOUBLE) / NULLIF({tot}, 0), 0.0) AS \"{val}\"" for val in v[c])
            + f" FROM p{i})")
        parts += [(f"s{i}", val) for val in v[c]]
    base_cols = ["nb_transactions", "total_amount", "avg_amount", "std_amount", "total_fee", "total_cashback",
                 "total_loyalty_points"]
    exprs = [f"b.{c}" for c in base_cols] + [
        "b.total_fee / b.nb_transactions", "b.total_cashback / b.nb_transactions",
        "b.total_loyalty_points / b.nb_transactions",
        "CASE WHEN b.total_amount > 0 THEN b.total_cashback / b.total_amount ELSE 0.0 END"]
    names = base_cols + ["avg_fee", "avg_cashback", "avg_loyalty_points", "cashback_ratio"]
    sel = [f"{R(f'COALESCE(CAST({e} AS DOUBLE), 0.0)', 6)} AS {n}" for e, n in zip(exprs, names)]
    sel += [f"{R(f'COALESCE({t}.\"{val}\", 0.0)', 6)} AS \"{val}\"" for t, val in parts]
    joins = " ".join(f"LEFT JOIN s{i} ON b.user_id = s{i}.user_id" for i in range(4))
    return f"WITH {', '.join(ctes)} SELECT b.user_id, {', '.join(sel)} FROM base b {joins}"


def legacy_tx_features_sql() -> str:
    """M39 on the orders adapter."""
    v = ORDERS_VALUES
    sel = ["transaction_id", "user_id"] + [f"COALESCE(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in
                                          ("product_amount", "transaction_fee", "cashback", "loyalty_points")]
    sel += ["COALESCE(CAST(hour(transaction_date) AS DOUBLE), 0.0) AS tx_hour",
            "COALESCE(CAST(isodow(transaction_date) - 1 AS DOUBLE), 0.0) AS tx_dayofweek",
            "CAST(CASE WHEN isodow(transaction_date) - 1 IN (5, 6) THEN 1 ELSE 0 END AS DOUBLE) AS tx_is_weekend"]
    for c in ("product_category", "payment_method", "device_type", "location"):
        sel += [f"COALESCE(CAST({c} = '{val}' AS INTEGER), 0) AS \"{c}_{val}\"" for val in v[c][1:]]
    return f"WITH {raw_cte('orders')} SELECT {', '.join(sel)} FROM raw"
