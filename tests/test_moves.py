"""Rows that are read, moved, sorted or written once: joined transactions, rare values, first keys, scored rows."""

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from test_growth import _plan, sf  # noqa: F401
from txlens.functions import clean as C
from txlens.operators import anomaly as A
from txlens.operators import encode as E
from txlens.operators import joins as J
from txlens.operators import user_features as U
from txlens.plans.catalog import QUERIES
from txlens.sources.adapters import tx_from_orders


def _recorded(monkeypatch, *modules):
    """All tables that these modules stage from now on, before and after."""
    found, cut = [], J.cut

    def record(df):
        found.append((_plan(df), out := cut(df)))
        return out
    for m in modules:
        monkeypatch.setattr(m, "cut", record)
    return found


def test_line_items_move_by_part_and_order_alone(spark, sf):  # noqa: F811
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = _plan(tx_from_orders(spark, sf)).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    (at,) = [i for i, line in enumerate(lines) if "lineitem.parquet" in line]
    above, top = [], depth[at]
    for i in range(at, -1, -1):
        if depth[i] < top:
            above, top = [*above, lines[i]], depth[i]
    moved = [line for line in above if "Exchange" in line]
    assert [k for k in ("l_partkey", "l_orderkey", "o_custkey") if any(f"partitioning({k}" in line for line in moved)] == ["l_partkey", "l_orderkey"]


def test_transactions_are_joined_once_and_without_ids(spark, sf, monkeypatch):  # noqa: F811
    found = _recorded(monkeypatch, U, J)
    raw = tx_from_orders(spark, sf)
    users = U.build_user_features(raw, as_of=AS_OF)
    assert sum("lineitem" in plan for plan, _ in found) == 1
    staged = found[0][1]
    assert "lineitem" in found[0][0] and staged.select("transaction_id").distinct().count() == 1
    want = {r["user_id"]: r["n"] for r in raw.groupBy("user_id").agg(F.count("transaction_id").alias("n")).collect()}
    assert {r["user_id"]: r["nb_transactions"] for r in users.collect()} == want


def test_missing_ids_are_not_counted(spark, tx):
    some = tx.withColumn("transaction_id", F.when(F.crc32("transaction_id") % 2 == 0, F.col("transaction_id")))
    want = {r["user_id"]: r["n"] for r in some.groupBy("user_id").agg(F.count("transaction_id").alias("n")).collect()}
    assert {r["user_id"]: r["nb_transactions"] for r in U.build_user_features(some, as_of=AS_OF).collect()} == want


def test_rare_values_alone_are_looked_up(spark):
    rows = [("a", "x", i) for i in range(12)] + [("b", "x", i) for i in range(3)] + [(None, "x", 0)]
    df = spark.createDataFrame(rows, "product_category string, payment_method string, i int")
    out = C.group_rare_categories(df, min_count=10)
    assert _plan(out).count("Join") == 1  # payment_method has no rare value
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(str(("Other" if c == "b" else c, p, i)) for c, p, i in rows)
    spark.conf.set("spark.txlens.broadcastMaxRows", "0")
    try:
        assert sorted(map(str, C.group_rare_categories(df, min_count=10).collect())) == sorted(map(str, out.collect()))
    finally:
        spark.conf.unset("spark.txlens.broadcastMaxRows")


@pytest.mark.parametrize("limit", [None, "0"])
def test_first_keys_without_sorting_every_row(spark, monkeypatch, limit):
    found = _recorded(monkeypatch, J)
    keys = ["tx-", "tx-0", "tx-00000000b", "tx-00000000a", "tx-é", "tx-z￿", "tx-0\0", "tx-z", None]
    rows = [(k, f"v{i % 3}", "only" if k else None) for i, k in enumerate(keys * 3)] + [(None, "none", None)]
    df = spark.createDataFrame(rows, "k string, p string, q string").repartition(4)
    if limit:
        spark.conf.set("spark.txlens.broadcastMaxRows", limit)
    try:
        got = {(r["col"], r["val"]): (r["_first"], r["n"]) for r in E._first_keys(df, ["p", "q"], "k").collect()}
    finally:
        spark.conf.unset("spark.txlens.broadcastMaxRows")
    want = {}
    for k, *vals in rows:
        for c, v in zip("pq", vals):
            if v is not None:
                first, n = want.get((c, v), (None, 0))
                want[c, v] = (min((x for x in (first, k) if x is not None), key=str.encode, default=None), n + 1)
    assert got == want
    assert "SortAggregate" not in found[0][0]  # the pass over all rows


def test_scores_of_staged_rows_are_not_written(spark, sf, monkeypatch):  # noqa: F811
    found = _recorded(monkeypatch, A)
    assert QUERIES["m29_analyze_anomalies"](spark, sf).count() == 600
    assert ["transaction_id", "anomaly_score"] not in [out.columns for _, out in found]
