"""Results that driver data cannot show: nulls, NaN, ties, quotes, coincident centroids, flagged rows."""
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txlens.functions.clean import drop_all_null_columns
from txlens.operators import decompose, explain, segment
from txlens.operators.anomaly import inv_norm, prepare_for_anomaly_detection, qq_points
from txlens.operators.cache import cut
from txlens.operators.encode import one_hot, one_hot_long, value_lists
from txlens.operators.legacy import build_user_features_legacy, value_shares
from txlens.operators.profile import correlation
from txlens.operators.quantiles import grouped_quantiles, quantiles, row_ranks, running_ranks
from txlens.operators.sampling import smallest_hashes
from txlens.operators.select import filter_important_features
from txlens.operators.user_features import build_user_features
from txlens.plans.training import write_csv
from txlens.session import checkpoint_dir
from txlens.sources.readers import load_csv_file


def test_correlation_is_pairwise_complete(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=400)
    pdf = pd.DataFrame({"a": x + 1e6, "b": x + 0.1 * rng.normal(size=400), "c": rng.normal(size=400), "d": 5.0})
    pdf.loc[::3, "b"] = None
    pdf.loc[1::7, "b"] = 1e9
    pdf.loc[1::7, "a"] = None
    df = spark.createDataFrame(pdf.astype(object).where(pd.notna(pdf), None), "a double, b double, c double, d double").repartition(5)
    want = pdf.corr()
    got = {(r.feature_i, r.feature_j): r["corr"] for r in correlation(df, list("abcd"), digits=6).collect()}
    assert len(got) == 16 and got["a", "a"] == 1.0 and got["d", "d"] is None and got["a", "d"] is None
    for i in "abc":
        for j in "abc":
            assert abs(got[i, j] - want.loc[i, j]) < 1e-5
    assert filter_important_features(df.select("a", "b", "c").where("b < 1e8 or b is null"), 0.9, 0.0).columns == ["a", "c"]


def test_columns_without_a_finite_value_are_dropped(spark):
    df = spark.createDataFrame([(i, float("nan"), None if i % 2 else float("inf"), float(i)) for i in range(12)], "k int, nan double, inf double, x double")
    out = prepare_for_anomaly_detection(df, ["k"])
    assert out.columns == ["k", "x"] and out.where("x is null").count() == 0
    assert "nan" not in drop_all_null_columns(df).columns


def test_rows_without_user_make_no_user(spark, tx):
    odd = tx.withColumn("user_id", F.when(F.col("transaction_id") > "tx_090", None).otherwise(F.col("user_id")))
    for build in (lambda d: build_user_features(d, as_of="2024-02-01 00:00:00"), build_user_features_legacy):
        assert build(odd).where("user_id is null").count() == 0


def test_csv_round_trip(spark, tx, tmp_path):
    name = 'say ""hi"", \\ ok'
    odd = tx.withColumn("product_category", F.when(F.col("transaction_id") < "tx_050", F.lit(name)).otherwise(F.col("product_category")))
    write_csv(odd, f"{tmp_path}/one")
    assert sorted(map(str, load_csv_file(spark, f"{tmp_path}/one").collect())) == sorted(map(str, odd.collect()))
    lines = odd.withColumn("location", F.lit("two\nlines"))
    write_csv(lines, f"{tmp_path}/two")
    assert load_csv_file(spark, f"{tmp_path}/two", multi_line=True).where("location = 'two\nlines'").count() == 100
    pdf = odd.toPandas()
    (tmp_path / "three").mkdir()
    pdf.iloc[:50].to_csv(tmp_path / "three" / "a.csv", index=False)
    pdf.iloc[50:][list(reversed(pdf.columns))].to_csv(tmp_path / "three" / "b.csv", index=False)
    back = load_csv_file(spark, f"{tmp_path}/three/*.csv").select(odd.columns)
    assert sorted(map(str, back.select("transaction_id", "user_id", "product_category", "product_amount").collect())) == \
        sorted(map(str, odd.select("transaction_id", "user_id", "product_category", "product_amount").collect()))


def test_davies_bouldin_skips_coincident_centroids(spark):
    rows = [(0, 0.0, 1.0), (0, 0.0, -1.0), (1, 1.0, 0.0), (1, -1.0, 0.0), (2, 10.0, 0.0), (2, 10.0, 2.0)]
    got = segment.davies_bouldin(spark.createDataFrame(rows, "cluster int, x double, y double"), ["x", "y"])
    d = np.hypot(10, 1)
    assert got == pytest.approx(2 / d)
    with pytest.raises(ValueError, match="cluster number"):
        segment.davies_bouldin(spark.range(2000).selectExpr("id as cluster", "double(id) as x"), ["x"])


def test_suggest_k(spark):
    curve = spark.createDataFrame([(2, 100.0, 0.3), (3, 50.0, 0.6), (4, 45.0, 0.6), (5, 41.0, None)], "k int, inertia double, silhouette double")
    assert [segment.suggest_k(curve, m) for m in ("elbow", "silhouette", "combined")] == [3, 3, 3]
    short = curve.where("k in (3, 5)").withColumn("silhouette", F.lit(None).cast("double"))
    assert [segment.suggest_k(short, m) for m in ("elbow", "silhouette")] == [3, 3]
    with pytest.raises(ValueError):
        segment.suggest_k(curve, "other")


def test_adequacy_of_a_known_matrix(spark):
    r = np.array([[1, 0.6, 0.3], [0.6, 1, 0.5], [0.3, 0.5, 1]])
    partial = lambda a, b, c: (a - b * c) / np.sqrt((1 - b * b) * (1 - c * c))
    q = partial(0.6, 0.3, 0.5) ** 2 + partial(0.3, 0.6, 0.5) ** 2 + partial(0.5, 0.6, 0.3) ** 2
    s = 0.36 + 0.09 + 0.25
    assert decompose.kmo_test(r)["kmo"] == pytest.approx(s / (s + q))
    b = decompose.bartlett_test(r, 100, spark)
    assert b["df"] == 3 and b["chi_square"] == pytest.approx(-(99 - 11 / 6) * np.log(np.linalg.det(r))) and b["significant"]
    wide = np.eye(60)
    assert decompose.bartlett_test(wide * 1e-6, 1000, spark)["chi_square"] is not None
    assert decompose.optimal_components(np.array([3.0, 0.5, 0.3, 0.2]), 0.9) == 3
    assert decompose.optimal_components(np.array([1.0, 1.0, 1.0]), 0.2) == 2


def test_ties_do_not_meet_in_one_task(spark):
    v = np.concatenate([np.full(18_000, 7.0), np.arange(2000.0)])
    df = spark.createDataFrame(pd.DataFrame({"v": v})).repartition(8)
    ranks = running_ranks(df.groupBy("v").count(), ["v"], "count")
    sizes = [r["count"] for r in cut(ranks).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 2000
    assert quantiles(df, "v", [0.0, 0.05, 0.5, 0.95, 1.0]) == pytest.approx(list(np.percentile(v, [0, 5, 50, 95, 100])))
    got = sorted((r["_rank"], r["v"]) for r in row_ranks(df, "v", chunk=1000).collect())
    assert got == list(enumerate(np.sort(v)))
    by = grouped_quantiles(df.withColumn("g", F.when(F.col("v") > 1000, F.lit("x"))), ["g"], "v", [0.5]).collect()
    assert {r.g: r.q500 for r in by} == {None: 7.0, "x": float(np.median(v[v > 1000]))}


def test_sample_is_the_same_under_any_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    one = sorted(r.k for r in smallest_hashes(df.repartition(1), "k", 40).collect())
    assert one == sorted(r.k for r in smallest_hashes(df.repartition(13), "k", 40).collect()) and len(one) == 40
    assert smallest_hashes(df, "k", 9000).count() == 5000


def test_only_flagged_rows_are_explained(spark, tx):
    attr = spark.createDataFrame([(f"tx_00{i}", f, float(i), s, abs(s), 0.1) for i in range(4) for f, s in (("amount", 0.5 - i), ("hour", 0.2))],
                                 "transaction_id string, feature string, feature_value double, shap_value double, abs_shap double, base_value double")
    flags = spark.createDataFrame([(f"tx_00{i}", i in (1, 3)) for i in range(4)], "transaction_id string, is_anomaly boolean")
    got = {r.transaction_id: r.explanation for r in explain.explain_text(attr, tx, flags=flags).collect()}
    assert set(got) == {"tx_001", "tx_003"}
    assert "Raising its score: hour" in got["tx_001"] and "Lowering it: amount = 1.00 (-0.500)" in got["tx_001"]
    french = explain.explain_text(attr, tx, flags=flags, language="fr").first().explanation
    assert "Pourquoi" in french and "Raising" not in french


def test_normal_quantile(spark):
    p = [0.001, 0.01, 0.02, 0.3, 0.5, 0.77, 0.98, 0.999]
    got = [r.z for r in spark.createDataFrame([(x,) for x in p], "p double").select(inv_norm(F.col("p")).alias("z")).collect()]
    assert got == pytest.approx([statistics.NormalDist().inv_cdf(x) for x in p], abs=1e-7)
    scored = spark.createDataFrame([(float(i % 5), False) for i in range(50)] + [(9.0, True)], "anomaly_score double, is_anomaly boolean")
    points = qq_points(scored).orderBy("rank").collect()
    assert [r["rank"] for r in points] == list(range(50)) and [r.sample_quantile for r in points] == sorted(float(i % 5) for i in range(50))


def test_categorical_values_without_a_bound(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id")).alias("c"), (F.col("id") % 7).cast("string").alias("user_id"))
    assert one_hot_long(df, ["k"], ["c"]).count() == 20_000
    assert value_shares(df, [("c", None)]).count() == 20_000
    with pytest.raises(ValueError, match="long form"):
        value_lists(df, ["c"])
    assert one_hot(df, "c", values=["v1", "v2"]).agg(F.sum("c_v2")).first()[0] == 1


def test_checkpoint_folder_is_registered_once(spark):
    first = checkpoint_dir(spark)
    registered = spark.sparkContext.getCheckpointDir()
    assert cut(spark.range(3)).count() == 3 and cut(spark.range(4)).count() == 4
    assert checkpoint_dir(spark) == first and spark.sparkContext.getCheckpointDir() == registered
