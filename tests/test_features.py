"""Feature builders on the reference-style synthetic fixture (100 tx, 20 users)."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, synthetic_transactions
from txlens.operators.legacy import build_transaction_features_legacy, build_user_features_legacy
from txlens.operators.tx_features import (TX_FEATURE_COLUMNS, build_transaction_features,
                                          build_transaction_features_simple)
from txlens.operators.user_features import USER_FEATURE_COLUMNS, build_user_features
from txlens.sources.schema import TX_SCHEMA


def test_user_features_shape_and_totals(tx, tx_pdf):
    uf = build_user_features(tx, as_of=AS_OF).toPandas()
    assert len(uf) == tx_pdf["user_id"].nunique()
    assert list(uf.columns[1:]) == USER_FEATURE_COLUMNS
    assert 5 <= uf.shape[1] - 1 <= 30
    assert not uf.drop(columns="user_id").isna().any().any()
    g = tx_pdf.groupby("user_id")
    m = uf.set_index("user_id")
    for u, grp in g:
        assert m.loc[u, "nb_transactions"] == len(grp)
        assert m.loc[u, "total_amount"] == pytest.approx(round(grp["product_amount"].sum(), 2), abs=0.006)


def test_tx_features_one_row_per_transaction(tx):
    tf = build_transaction_features(tx).toPandas()
    assert len(tf) == 100 and tf["transaction_id"].is_unique
    assert list(tf.columns[2:]) == TX_FEATURE_COLUMNS
    assert 5 <= tf.shape[1] - 2 <= 50
    assert not tf.isna().any().any()


def test_simple_tx_features(tx):
    tf = build_transaction_features_simple(tx).toPandas()
    assert len(tf) == 100
    assert set(tf["amount_quartile"]) <= {0.0, 1.0, 2.0, 3.0}
    assert tf["amount_zscore"].mean() == pytest.approx(0, abs=1e-3)


def test_robust_to_extra_nulls(spark):
    pdf = synthetic_transactions(null_every=15)
    pdf.loc[pdf.index % 10 == 0, "cashback"] = np.nan
    pdf = pdf[[f.name for f in TX_SCHEMA.fields]]
    df = spark.createDataFrame(pdf.astype(object).where(pd.notna(pdf), None), TX_SCHEMA)
    uf = build_user_features(df, as_of=AS_OF).toPandas()
    tf = build_transaction_features(df).toPandas()
    assert not uf.isna().any().any() and not tf.isna().any().any()


def _tx(spark, rows):
    cols = ["transaction_id", "user_id", "transaction_date", "product_category", "product_amount",
            "transaction_fee", "cashback", "loyalty_points", "payment_method", "device_type", "location"]
    order = [f.name for f in TX_SCHEMA.fields]
    return spark.createDataFrame([tuple(dict(zip(cols, r))[c] for c in order) for r in rows], TX_SCHEMA)


def test_edge_cases(spark):
    rows = [
        # single-transaction user: null std -> median fill
        ("t01", "solo", "2024-01-05 10:00:00", "A", 10.0, 1.0, 0.0, 1.0, "P", "M", "X"),
        # tie in top category: count desc, value asc
        ("t02", "tie", "2024-01-01 09:00:00", "B", 5.0, 1.0, 1.0, 1.0, "P", "M", "X"),
        ("t03", "tie", "2024-01-02 09:00:00", "A", 5.0, 1.0, 1.0, 1.0, "P", "M", "X"),
        ("t04", "tie", "bad date", None, 0.0, 0.0, 0.0, 0.0, "P", "M", "X"),
        # zero total amount: guarded ratios
        ("t05", "zero", "2024-01-03 12:00:00", "A", 0.0, 0.0, 0.0, 0.0, "P", "M", "X"),
        ("t06", "zero", "2024-01-03 13:00:00", "A", 0.0, 0.0, 0.0, 0.0, "P", "M", "X"),
        # inf / nan amounts -> null -> 0
        ("t07", "weird", "2024-01-04 01:00:00", "A", float("inf"), 0.0, 0.0, 0.0, "P", "M", "X"),
        ("t08", "weird", "2024-01-04 02:00:00", "A", float("nan"), 0.0, 0.0, 0.0, "P", "M", "X"),
    ]
    uf = build_user_features(_tx(spark, rows), as_of=AS_OF, rare_min_count=1).toPandas().set_index("user_id")
    assert uf.loc["tie", "preferred_hour"] == 9
    assert uf.loc["tie", "top_category_freq"] == pytest.approx(1 / 3)
    # 3 transactions (the bad date counts) over a range of 1 full day (the bad date is excluded)
    assert uf.loc["tie", "transaction_frequency"] == 3.0
    assert uf.loc["zero", "cashback_ratio"] == 0 and uf.loc["zero", "fee_ratio"] == 0
    assert uf.loc["zero", "amount_variability"] == 0
    assert uf.loc["weird", "total_amount"] == 0
    stds = uf["std_amount"]
    assert not stds.isna().any()
    # single-transaction user: the null sample std is filled with the median of the others
    assert uf.loc["solo", "std_amount"] == pytest.approx(np.median(stds.drop("solo")), abs=1e-9)


def test_rare_threshold_is_strict(spark):
    from txlens.functions.clean import group_rare_categories
    vals = ["nine"] * 9 + ["ten"] * 10 + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, product_category string")
    out = group_rare_categories(df).groupBy("product_category").count().toPandas()
    got = dict(zip(out["product_category"].fillna("<null>"), out["count"]))
    assert got == {"Other": 9, "ten": 10, "<null>": 1}


def test_integer_user_id_keeps_user_features(spark, tx_pdf):
    pdf = tx_pdf.copy()
    pdf["user_id"] = pdf["user_id"].str[5:].astype(int)
    df = spark.createDataFrame(pdf.astype(object).where(pd.notna(pdf), None),
                               "transaction_id string, user_id int, transaction_date string, product_category string, "
                               "product_amount double, transaction_fee double, cashback double, loyalty_points double, "
                               "payment_method string, device_type string, location string")
    tf = build_transaction_features(df).toPandas()
    assert (tf["user_avg_amount"] > 0).all()


def test_optional_columns(spark, tx_pdf):
    for drop in ["cashback", "transaction_fee", "loyalty_points", "payment_method", "device_type", "location",
                 "transaction_date", "product_category"]:
        pdf = tx_pdf.drop(columns=[drop])
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TX_SCHEMA.fields if f.name in pdf.columns)
        pdf = pdf[[f.name for f in TX_SCHEMA.fields if f.name in pdf.columns]]
        df = spark.createDataFrame(pdf.astype(object).where(pd.notna(pdf), None), schema)
        uf = build_user_features(df, as_of=AS_OF)
        assert len(uf.columns) >= 6
        assert uf.count() == tx_pdf["user_id"].nunique()


def test_legacy_builders(tx, tx_pdf):
    uf = build_user_features_legacy(tx).toPandas().set_index("user_id")
    cats = sorted(tx_pdf["product_category"].unique())
    shares = uf[cats].sum(axis=1)
    assert np.allclose(shares[shares > 0], 1.0, atol=1e-5)
    tf = build_transaction_features_legacy(tx).toPandas()
    assert len(tf) == 100 and "product_category_Clothing" not in tf.columns  # first sorted value dropped
    assert set(tf["payment_method_Wallet"]) <= {0, 1}
