"""Steps that moved, wrote or kept more than they need: staged tables, users' statistics, own scores, thresholds, features of rows not flagged."""

import contextlib
import io
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from test_growth import _forest, _plan, sf  # noqa: F401
from txlens.operators import anomaly as A
from txlens.operators import cache as K
from txlens.operators import iforest as IF
from txlens.operators import joins as J
from txlens.operators import quantiles as Q
from txlens.operators import tx_features as T
from txlens.plans import queries_ml as M
from txlens.plans.catalog import QUERIES


def _sorted(df) -> list[str]:
    return sorted(map(str, map(tuple, df.select(*sorted(df.columns)).collect())))


def test_tables_staged_on_the_way_are_deleted(spark):
    seen = []

    def build():
        seen.append(K.cut(spark.range(50)))
        return seen[0].selectExpr("id * 2 as x")
    out = K.cut_of(build)
    assert out.agg(F.sum("x")).first()[0] == 2450
    with pytest.raises(Exception, match="(?i)not.?exist|not.?found"):
        seen[0].collect()
    kept = K.cut(spark.range(3))
    assert kept.count() == 3  # outside of cut_of nothing is deleted


def test_rows_of_many_users_move_once(spark, tx, monkeypatch):
    users = tx.withColumn("user_id", F.when(F.crc32("transaction_id") % 3 == 0, F.lit("hot")).when(F.crc32("transaction_id") % 7 > 0, F.col("user_id")))
    rows = K.cut(users.na.fill(0.0))
    few = T.attach_user_stats(rows, rows)
    spark.conf.set("spark.txlens.broadcastMaxRows", "0")
    try:
        many = T.attach_user_stats(rows, rows)
        plan = _plan(many)
        monkeypatch.setattr(T, "measured", None)  # no table of users is staged
        assert _sorted(T.attach_user_stats(rows, rows)) == _sorted(few)
    finally:
        spark.conf.unset("spark.txlens.broadcastMaxRows")
    assert "Window" in plan and plan.count("hashpartitioning(user_id") <= 2  # the rows, and the aggregate of heavy users
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and many.where("user_id is null").count() == rows.where("user_id is null").count() > 0


@pytest.mark.parametrize("limit", [None, "0"])
def test_own_values_are_not_joined(spark, limit):
    rows = spark.createDataFrame([(f"k{i}", i, float(i)) for i in range(60)] + [("k1", 90, 9.5), ("k1", 91, 9.5), ("k2", 92, None), (None, 93, 1.0)], "k string, x int, s double")
    if limit:
        spark.conf.set("spark.txlens.broadcastMaxRows", limit)
    try:
        got = _sorted(J.join_own(rows, "k", "s"))
    finally:
        spark.conf.unset("spark.txlens.broadcastMaxRows")
    assert got == _sorted(rows.drop("s").join(rows.select("k", "s"), "k"))
    plan = _plan(J.join_own(rows.where("x < 60"), "k", "s"))
    assert "Join" not in plan and "Exchange" not in plan


def test_rows_of_other_keys_stay(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"), "id").union(spark.sql("select cast(null as string), -1L"))
    keys = rows.where("id % 100 = 0").select("k")
    got = {r["k"] for r in J.rows_of(rows, keys, "k").collect()}
    assert {r["k"] for r in keys.collect()} <= got and len(got) < 4000 and None not in got


def test_values_far_from_the_ranks_are_not_ranked(spark, monkeypatch):
    r = np.random.default_rng(3)
    v = np.concatenate([r.normal(size=4000), np.round(r.exponential(5, 4000)), [np.nan] * 3])
    df = spark.createDataFrame(pd.DataFrame({"v": v})).union(spark.sql("select cast(null as double)")).repartition(3)
    probs = [0.0, 0.25, 0.5, 0.951, 1.0]
    want = tuple(Q.quantiles_df(df, "v", probs).first())
    monkeypatch.setattr(Q, "_NARROW_FROM", 100)
    ranked, ranks = [], Q.running_ranks
    monkeypatch.setattr(Q, "running_ranks", lambda rows, *a: ranks(ranked.append(rows.count()) or rows, *a))
    assert tuple(Q.quantiles_df(df, "v", probs, stored=True).first()) == want
    assert ranked[0] < 400
    same = df.withColumn("v", F.lit(2.0))
    assert tuple(Q.quantiles_df(same, "v", probs, stored=True).first()) == (2.0,) * 5
    assert Q.quantiles_df(df.where("v > 1e9"), "v", [0.5], stored=True).first()[0] is None
    infinite = df.union(spark.sql("select double('infinity')"))
    assert tuple(Q.quantiles_df(infinite, "v", [0.5], stored=True).first()) == tuple(Q.quantiles_df(infinite, "v", [0.5]).first())


@pytest.mark.parametrize("lift", [0.0, 10.0])
def test_features_of_flagged_rows_alone_are_kept(spark, monkeypatch, lift):
    model, x = _forest()
    x = x[3:]
    rows = spark.createDataFrame(pd.DataFrame(x, columns=model.features).assign(k=[f"r{i}" for i in range(len(x))])).repartition(3)
    want = IF.flag(IF.score_samples(model, rows, ["k"], features=True), 0.1)
    monkeypatch.setattr(IF, "_WHOLE", 250)
    monkeypatch.setattr(IF.np, "quantile", lambda v, p, q=np.quantile: float(q(v, p)) + lift)  # a bound that is too high is found out
    got = IF.flag_with_features(model, rows, "k", 0.1)
    assert _sorted(got.drop(*model.features)) == _sorted(want.drop(*model.features))
    assert _sorted(got.where("is_anomaly")) == _sorted(want.where("is_anomaly")) != []
    assert (got.where("f0 is null").count() > 100) == (lift == 0)


def test_features_are_a_projection_of_what_is_staged(spark, sf, monkeypatch):  # noqa: F811
    M._CACHE.clear()
    x, feats = M._forest_x(spark, sf)
    (staged,) = {f.rpartition("/")[0] for f in x.inputFiles()}
    assert "log_amount" in feats and "log_amount" not in spark.read.parquet(staged).columns
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        x.explain("codegen")
    assert 0 < max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", said.getvalue()))) < 8000  # longer methods are not compiled by the JVM


@pytest.mark.parametrize("name", ["m33_explanations", "a8_anomaly_csv_export"])
def test_details_are_read_from_the_staged_transactions(spark, sf, monkeypatch, name):  # noqa: F811
    M._CACHE.clear()
    calls, of = [], M.tx_from_orders
    monkeypatch.setattr(M, "tx_from_orders", lambda *a: calls.append(a) or of(*a))
    assert QUERIES[name](spark, sf).count() > 0
    assert len(calls) == 1


def test_scored_rows_are_analyzed_where_they_are(spark, sf):  # noqa: F811
    plan = _plan(QUERIES["m29_analyze_anomalies"](spark, sf))
    assert "Join [transaction_id" not in plan and "hashpartitioning(transaction_id" not in plan


def test_rows_below_the_threshold_are_not_joined(spark, tx):
    scores = tx.select("transaction_id", F.col("product_amount").alias("anomaly_score")).union(tx.limit(3).select("transaction_id", F.lit(7.0)))
    every, above = A.analyze_anomalies(tx, scores), A.analyze_anomalies(tx, scores, above_only=True)
    assert above.columns == every.columns and _sorted(above) == _sorted(every.where("is_above_threshold")) != []
