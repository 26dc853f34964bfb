"""Steps whose time or traffic grew faster than their input: attributions, descent, aggregates by user, repeated reads."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from txlens.operators import explain as X
from txlens.operators import iforest as IF
from txlens.operators import joins as J
from txlens.operators.user_features import build_user_features
from txlens.plans import queries_ml as M
from txlens.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def sf(tmp_path_factory):
    """600 rows of line items with their orders, parts, customers and nations."""
    r, at = np.random.default_rng(8), tmp_path_factory.mktemp("sf")
    n = np.arange(600)
    price = np.round(r.exponential(900, 600) + 1, 2)
    price[::97] *= 40
    tables = {
        "nation": {"n_nationkey": np.arange(3, dtype=np.int32), "n_name": ["A", "B", "C"], "n_regionkey": np.zeros(3, np.int32)},
        "customer": {"c_custkey": np.arange(20), "c_name": [f"c{i}" for i in range(20)], "c_nationkey": (np.arange(20) % 3).astype(np.int32)},
        "part": {"p_partkey": np.arange(30), "p_type": [f"type {i % 4}" for i in range(30)]},
        "orders": {"o_orderkey": np.arange(150), "o_custkey": r.integers(0, 20, 150), "o_orderpriority": [f"{i % 3}-x" for i in range(150)]},
        "lineitem": {"l_orderkey": n // 4, "l_partkey": r.integers(0, 30, 600), "l_suppkey": n % 7, "l_linenumber": (n % 4 + 1).astype(np.int32),
                     "l_quantity": r.integers(1, 50, 600).astype(float), "l_extendedprice": price, "l_discount": r.integers(0, 10, 600) / 100,
                     "l_tax": r.integers(0, 8, 600) / 100, "l_returnflag": list("ANR" * 200), "l_linestatus": list("OF" * 300),
                     "l_shipdate": (pd.Timestamp("1995-01-01") + pd.to_timedelta(n % 90, unit="D")).astype("datetime64[us]")},
    }
    for name, columns in tables.items():
        pd.DataFrame(columns).to_parquet(at / f"{name}.parquet")
    return str(at)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _forest(trees: int = 6):
    r = np.random.default_rng(5)
    data = np.round(r.normal(size=(500, 7)), 1)
    rows = [(t, *n) for t in range(trees) for n in IF.grow_tree(data[r.integers(0, 500, 256)], np.random.default_rng([1, t]), 8)]
    nodes = pd.DataFrame(rows, columns=["tree", "node", "left", "right", "feature", "threshold", "size", "depth", "leaf"])
    x = np.round(r.normal(size=(300, 7)), 1)
    x[0, 1], x[1, 2], x[2, 3] = np.nan, np.inf, -np.inf
    return IF.IsolationForestModel([f"f{i}" for i in range(7)], nodes, trees, 256, 0.1), x


@pytest.mark.parametrize("bits", [9, 3, 0])
def test_values_are_looked_up_by_pattern(monkeypatch, bits):
    model, x = _forest()
    monkeypatch.setattr(X, "_BITS", bits)
    paths = X.leaf_paths(model.arrays())
    every = X._integrated(x, {k: paths[k] for k in ("feature", "low", "high", "share", "value")})
    np.testing.assert_allclose(X.path_shap(x, paths), every, atol=1e-12)
    tested = ((paths["low"] > -np.inf) | (paths["high"] < np.inf)).sum(1)
    assert len(paths["long"]) == (tested > bits).sum() and len(paths["tables"]) == ((tested > 0) & (tested <= bits)).sum()


def test_descent_reaches_the_leaf_of_every_row(monkeypatch):
    model, x = _forest()
    a = model.arrays()
    monkeypatch.setattr(IF, "_BLOCK", 64)
    got = IF._path_lengths(x, a)
    for k in range(model.n_trees):
        for i, row in enumerate(x):
            node = 0
            while not a["leaf"][k, node]:
                node = a["left" if row[a["feature"][k, node]] <= a["threshold"][k, node] else "right"][k, node]
            assert got[i, k] == a["depth"][k, node] + IF.average_path_length(a["size"][k, node])


def test_scores_carry_the_features(spark):
    model, x = _forest()
    rows = spark.createDataFrame(pd.DataFrame(x[3:], columns=model.features).assign(k=[f"r{i}" for i in range(len(x) - 3)])).repartition(3)
    plain = {r["k"]: r["raw_score"] for r in IF.score_samples(model, rows, ["k"]).collect()}
    wide = IF.score_samples(model, rows, ["k"], features=True).toPandas().sort_values("k", key=lambda s: s.str[1:].astype(int))
    assert {k: v for k, v in zip(wide["k"], wide["raw_score"])} == plain
    np.testing.assert_array_equal(wide[model.features].to_numpy(), x[3:])


def test_flagged_rows_are_explained_without_a_join(spark, sf):
    plan = _plan(M._flagged_rows(spark, sf).where("is_anomaly"))
    assert "HashJoin" not in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan  # the threshold's row alone is attached
    rows, flags = M._flagged_attr(spark, sf), M._flags(spark, sf)
    assert rows.select("transaction_id").distinct().count() == flags.where("is_anomaly").select("transaction_id").distinct().count() > 0
    plan = _plan(M._forest_x(spark, sf)[0])
    assert "Join" not in plan and "Exchange" not in plan  # the features are staged before they are counted


@pytest.mark.parametrize("share", [0.0, 0.4])
def test_rows_are_dealt_by_key_once(spark, share):
    r = np.random.default_rng(2)
    u = np.where(r.random(4000) < share, "hot", r.integers(0, 900, 4000).astype(str))
    rows = spark.createDataFrame(pd.DataFrame({"u": u, "x": np.arange(4000.0)})).repartition(5)
    heavy = J.heavy_keys(rows, "u")
    assert heavy == (["hot"] if share else [])
    got = J.per_key(rows, "u", lambda d: d.groupBy("u").agg(F.count("x").alias("n"), F.sum("x").alias("s"), F.stddev_samp("x").alias("d")), heavy)
    if not share:
        assert _plan(got).count("Exchange") == 1  # the rows, by key
    want = pd.DataFrame({"u": u, "x": np.arange(4000.0)}).groupby("u")["x"].agg(["count", "sum", "std"])
    found = got.toPandas().set_index("u").loc[want.index]
    np.testing.assert_allclose(found[["n", "s", "d"]].to_numpy(dtype=float), want.to_numpy(), rtol=1e-9)


def test_null_keys_have_no_heavy_key(spark):
    rows = spark.createDataFrame([(None, i) for i in range(50)] + [("a", 1)], "u string, x int")
    assert J.heavy_keys(rows, "u") == []


def test_user_features_with_a_heavy_user(spark, tx):
    many = tx.withColumn("user_id", F.when(F.crc32("transaction_id") % 3 == 0, F.lit("hot")).otherwise(F.col("user_id")))
    rows = {r["user_id"]: r for r in build_user_features(many, as_of=AS_OF).collect()}
    raw = many.groupBy("user_id").agg(F.count("transaction_id").alias("n"), F.count_distinct("payment_method").alias("p")).collect()
    assert len(rows) == len(raw) and all(rows[r["user_id"]]["nb_transactions"] == r["n"] for r in raw)


def test_large_key_tables_are_hashed(spark):
    spark.conf.set("spark.txlens.broadcastMaxRows", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("x"))
        small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
        weights = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        out = J.keyed_join(big, small, ["k"], "left", weights=weights, small_rows=40)
        assert "ShuffledHashJoin" in _plan(out)
        assert out.count() == 1000 and out.where("y is not null").count() == 800 and out.where("y <> 2 * k").isEmpty()
    finally:
        spark.conf.unset("spark.txlens.broadcastMaxRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["m29_analyze_anomalies", "g21_sparse_encoding"])
def test_transactions_are_joined_once(spark, sf, name):
    assert "lineitem" not in _plan(QUERIES[name](spark, sf))
