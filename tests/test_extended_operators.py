"""Sparse encodings, lookups by key, silhouettes, draws of trees, PCA reports and distinct counts."""
import glob
import math

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from txlens.operators import encode, iforest, lookup, profile, segment
from txlens.operators.anomaly import analyze_anomalies, anomaly_report, prepare_numeric_data
from txlens.operators.cache import cut
from txlens.operators.decompose import compute_pca
from txlens.operators.explain import leaf_paths
from txlens.operators.joins import keyed_join


@pytest.mark.parametrize("limit", [None, "0"])
def test_sparse_vectors_of_many_values(spark, limit):
    """20,000 values in one vector that KMeans accepts; unknown values, nulls and first values leave no entry."""
    if limit:
        spark.conf.set("spark.txlens.broadcastMaxRows", limit)
    try:
        rows = spark.range(20_000).select(F.col("id").alias("k"), F.format_string("v%05d", F.col("id")).alias("a"),
                                          F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("b"))
        dictionary = cut(encode.value_dictionary(rows, ["b", "a"]))
        assert dictionary.count() == 1 + 19_999
        out = cut(encode.sparse_one_hot(rows, ["k"], ["b", "a"], dictionary))
        got = {r["k"]: r["features"] for r in out.where("k in (0, 1, 2, 19999)").collect()}
        assert {k: (v.size, list(v.indices), list(v.values)) for k, v in got.items()} == {
            0: (20_000, [], []), 1: (20_000, [1], [1.0]), 2: (20_000, [0, 2], [1.0, 1.0]), 19_999: (20_000, [19_999], [1.0])}
        new = spark.createDataFrame([(1, "v00005", None), (2, "unseen", "2"), (3, None, None)], "k long, a string, b string")
        again = {r["k"]: list(r["features"].indices) for r in encode.sparse_one_hot(new, ["k"], ["b", "a"], dictionary).collect()}
        assert again == {1: [5], 2: [0], 3: []}
        model = KMeans(k=2, maxIter=1, seed=1, initSteps=1).fit(out.limit(200))
        assert model.transform(out.limit(50)).select("prediction").distinct().count() <= 2
    finally:
        spark.conf.unset("spark.txlens.broadcastMaxRows")


def test_lookup_reads_few_row_groups(spark, tmp_path):
    n = 40_000
    rows = spark.range(n).select(F.format_string("t%06d", F.col("id")).alias("transaction_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"),
                                 (F.col("id") % 977).cast("double").alias("anomaly_score")).repartition(7)
    source, scores, attr = (str(tmp_path / x) for x in ("source", "scores", "attr"))
    lookup.write_by_key(rows.select("transaction_id", "text"), source, "transaction_id", row_group_bytes=200_000)
    lookup.write_by_key(rows.select("transaction_id", "anomaly_score"), scores, "transaction_id")
    pairs = rows.select("transaction_id", F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(1.0).alias("feature_value"), F.lit(s).alias("shap_value"),
                                                                       F.lit(abs(s)).alias("abs_shap")) for f, s in (("a", 0.1), ("b", -0.9), ("c", 0.5))])).alias("p"))
    lookup.write_by_key(pairs.select("transaction_id", "p.*"), attr, "transaction_id")
    keys = ["t000007", "t031234", "none", None]
    groups = [pq.ParquetFile(f).metadata.row_group(g) for f in glob.glob(source + "/*.parquet") for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
    may = [g for g in groups if any(g.column(0).statistics.min <= k <= g.column(0).statistics.max for k in keys if k)]
    assert len(groups) >= 8 and len(may) <= 4
    plan = lookup.read_keys(spark, source, "transaction_id", keys)._jdf.queryExecution().toString()
    assert "EqualTo(transaction_id,t000007)" in plan
    got = lookup.look_up(spark, keys, source, scores, attr, top=2).collect()
    assert [r["transaction_id"] for r in got] == sorted(["t000007", "t031234"], key=lambda k: -(int(k[1:]) % 977))
    assert all([x["feature"] for x in r["attributions"]] == ["b", "c"] for r in got)
    with pytest.raises(ValueError):
        lookup.read_keys(spark, source, "transaction_id", range(2000))


def _silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i, own in enumerate(labels):
        same = (labels == own) & (np.arange(len(labels)) != i)
        if not same.any():
            out.append(0.0)
            continue
        a, b = d[i, same].mean(), min(d[i, labels == o].mean() for o in set(labels) if o != own)
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def test_euclidean_silhouette(spark):
    r = np.random.default_rng(3)
    labels = r.choice([0, 0, 1, 2], 900)
    x = r.normal(size=(900, 2)) + np.array([[0, 0], [2, 1], [5, -3]])[labels]
    labels[-1] = 9  # a cluster of one
    x[:30] = x[0]   # equal rows
    labels[:30] = 0
    rows = spark.createDataFrame(pd.DataFrame({"id": range(900), "x": x[:, 0], "y": x[:, 1], "cluster": labels})).repartition(5)
    exact = _silhouette(x, labels)
    got = segment.euclidean_silhouette(rows, ["id"], ["x", "y"], per_cluster=1000).first()
    assert got["exact"] and got["standard_error"] == 0 and got["silhouette"] == pytest.approx(exact, abs=1e-9)
    part = segment.euclidean_silhouette(rows, ["id"], ["x", "y"], per_cluster=120).first()
    assert not part["exact"] and part["reference_rows"] == 361 and abs(part["silhouette"] - exact) < 4 * part["standard_error"] + 0.01
    assert part == segment.euclidean_silhouette(rows.repartition(3), ["id"], ["x", "y"], per_cluster=120).first()
    assert segment.euclidean_silhouette(rows.where("cluster = 1"), ["id"], ["x", "y"]).first()["silhouette"] is None


def test_draws_follow_the_binomial(spark):
    n, trees, share = 40_000, 50, 0.004
    some, upto = iforest.drawn_counts(trees, share)
    assert some == pytest.approx(1 - (1 - share) ** trees) and upto[-1] == pytest.approx(1) and upto[0] == pytest.approx(trees * share * (1 - share) ** (trees - 1) / some)
    rows = spark.range(n).withColumnRenamed("id", "k")
    drawn = iforest.draw_trees(rows, "k", trees, share, 5).toPandas()
    assert not drawn.duplicated().any()
    per_tree = drawn.groupby("tree").size()
    assert len(per_tree) == trees and abs(per_tree - n * share).max() < 5 * math.sqrt(n * share)
    times = drawn.groupby("k").size().value_counts()
    for k in (1, 2):
        p = math.comb(trees, k) * share ** k * (1 - share) ** (trees - k)
        assert abs(times[k] - n * p) < 5 * math.sqrt(n * p)
    again = iforest.draw_trees(rows.repartition(9), "k", trees, share, 5).toPandas()
    assert set(map(tuple, again.to_numpy())) == set(map(tuple, drawn.to_numpy()))
    assert iforest.draw_trees(rows.limit(20), "k", 3, 1.0, 5).count() == 60
    plan = iforest.draw_trees(rows, "k", trees, share, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and plan.index("Generate") < plan.index("Filter")  # the draw among trees lies above the hash test


def test_leaf_paths_cover_the_space():
    r = np.random.default_rng(2)
    x = r.normal(size=(64, 3))
    nodes = pd.DataFrame([(0, *row) for row in iforest.grow_tree(x, np.random.default_rng(0), 6)],
                         columns=["tree", "node", "left", "right", "feature", "threshold", "size", "depth", "leaf"])
    paths = leaf_paths(iforest.IsolationForestModel(list("abc"), nodes, 1, 64, 0.1).arrays())
    v = r.normal(size=(200, 3))
    inside = ((v[:, paths["feature"]] > paths["low"]) & (v[:, paths["feature"]] <= paths["high"])).all(2)
    assert (inside.sum(1) == 1).all() and paths["share"].prod(1).sum() == pytest.approx(1)


def test_pca_report_and_analysis(spark):
    r = np.random.default_rng(11)
    base = r.normal(size=(300, 2))
    pdf = pd.DataFrame(base @ r.normal(size=(2, 6)) + 0.3 * r.normal(size=(300, 6)), columns=list("abcdef"))
    pdf.insert(0, "id", range(300))
    pca = compute_pca(spark.createDataFrame(pdf), ["id"], n_components=3)
    z = (pdf[list("abcdef")] - pdf[list("abcdef")].mean()) / pdf[list("abcdef")].std(ddof=0)
    one = pca.individual_analysis().orderBy("id").toPandas()
    pcs, comps = one[["PC1", "PC2", "PC3"]].to_numpy(), pca.components[:3]
    assert np.allclose(pcs, z.to_numpy() @ comps.T)
    assert np.allclose(one[[f"share_PC{i}" for i in (1, 2, 3)]].sum(1), 100) and np.allclose(one[[f"cos2_PC{i}" for i in (1, 2, 3)]].sum(1), one["cos2"])
    left = one[[f"residual_{c}" for c in "abcdef"]].to_numpy()
    assert np.allclose(pcs @ comps + left, z) and np.allclose((left ** 2).sum(1), one["residual"] ** 2)
    assert np.allclose(one[[f"original_{c}" for c in "abcdef"]], pdf[list("abcdef")])
    new = spark.createDataFrame([(900, *pdf[list("abcdef")].mean().tolist())], pca.source.schema)
    centre = pca.individual_analysis(new).first()
    assert centre["cos2"] < 1e-6 or centre["distance_to_centre"] < 1e-6
    report = pca.report().orderBy("place").toPandas()
    assert report["section"].value_counts().to_dict() == {"overview": 4, "quality": 3, "component": 9, "variable": 15, "verdict": 2}
    top = report[(report["section"] == "variable") & (report["item"] == "PC1")]
    assert top["value"].abs().is_monotonic_decreasing and set(top["metric"]) < set("abcdef")
    board = pca.dashboard(4)
    assert set(board) == {"summary", "variable_contributions", "suggestions", "report", "metrics", "top_variables"}
    assert board["variable_contributions"].count() == 4 and board["top_variables"].count() == 15
    bars = pca.quality_histogram().orderBy("bin").toPandas()
    assert len(bars) == 20 and bars["count"].sum() == 300 and bars["count"].tolist() == np.histogram(one["cos2"], 20, (0, 1))[0].tolist()
    assert pca.space(50).columns == ["id", "PC1", "PC2", "PC3", "cos2", "distance_to_centre"]
    assert compute_pca(spark.createDataFrame(pdf[["id", "a", "b"]]), ["id"], n_components=2).space(5).where("PC3 is null").count() == 5
    assert pca.total_inertia() == pytest.approx(1800)


def test_distinct_counts(spark):
    rows = [(1, "x", 0.0, None), (2, "x", -0.0, "a" * 100), (2, None, float("nan"), "a" * 99 + "b"), (None, "y", float("nan"), "a" * 100)]
    df = spark.createDataFrame(rows, "i int, s string, d double, t string")
    want = {"i": (2, 1), "s": (2, 1), "d": (2, 0), "t": (2, 1)}
    for approximate in (False, True):
        counts = profile.distinct_counts(df, df.columns, approximate)
        assert {r["column"]: (r["n_distinct"], r["n_missing"]) for r in counts.collect()} == want
        assert "Expand" not in counts._jdf.queryExecution().toString()
    assert {(r["column"], r["n_distinct"], r["n_missing"]) for r in profile.column_profile(df.limit(0)).collect()} == {(c, 0, 0) for c in "isdt"}
    many = spark.range(30_000).select("id", (F.col("id") % 7).alias("few"))
    near = {r["column"]: r["n_distinct"] for r in profile.distinct_counts(many, ["id", "few"], True).collect()}
    assert near["few"] == 7 and abs(near["id"] - 30_000) < 0.06 * 30_000
    q = profile.data_quality(df.union(df.limit(1))).first()
    assert (q["n_rows"], q["duplicate_rows"], q["missing_values"]) == (5, 1, 4)
    assert profile.data_quality(df.limit(0)).first()["n_rows"] == 0
    shares = profile.cumulative_shares(many, "few").orderBy("cumulative_pct").toPandas()
    assert shares["cumulative_pct"].iloc[-1] == 100 and (shares["size"].diff().dropna() <= 0).all()
    plan = profile.group_sizes(many, "few")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


def test_null_keys_do_not_meet_in_one_task(spark):
    big = spark.range(5000).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 10).alias("k"))
    small = spark.createDataFrame([(i, f"n{i}") for i in range(10)], "k long, name string")
    out = keyed_join(big, small, ["k"], "left", weights=big.groupBy("k").agg(F.count(F.lit(1)).alias("n")))
    assert out.count() == 5000 and out.where("name is null").count() == 2500 and out.where("name = concat('n', k)").count() == 2500
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = out.where("k is null").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert spread > 1
    assert keyed_join(big, small, ["k"], "inner", weights=big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))).count() == 2500


def test_anomaly_report_content(spark, tx):
    scores = tx.select("transaction_id", F.col("product_amount").alias("anomaly_score"))
    report = anomaly_report(analyze_anomalies(tx, scores), 0.1, 7)
    got = {(r["section"], r["item"], r["metric"]): r["value"] for r in report.collect()}
    pdf = tx.toPandas()
    s = pdf["product_amount"].astype(float)
    assert got["data", None, "transactions"] == "100" and got["data", None, "features"] == "7"
    assert got["data", None, "first_day"] == str(min(pd.to_datetime(pdf["transaction_date"])).date())
    assert float(got["result", None, "threshold"]) == pytest.approx(np.percentile(s, 95), abs=1e-4)
    assert got["result", None, "anomalies"] == str((s > np.percentile(s, 90)).sum()) and got["result", None, "rows_above_threshold"] == "5"
    best = pdf.loc[s.idxmax()]
    assert got["top", 1, "transaction_id"] == best["transaction_id"] and got["top", 1, "user_id"] == best["user_id"]
    assert got["top", 1, "product_category"] == best["product_category"] and float(got["top", 1, "score"]) == pytest.approx(s.max())
    assert max(k[1] or 0 for k in got) == 5
    assert anomaly_report(analyze_anomalies(tx.limit(0), scores), 0.1, 7).count() == 0


def test_prepare_numeric_data_flags(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, None), (None, "c", 5.0), (4, "d", float("inf"))], "i int, s string, d double")
    assert prepare_numeric_data(df).columns == ["i", "d"]
    assert sorted(map(tuple, prepare_numeric_data(df).collect())) == [(1.0, 1.0), (2.0, 3.0), (2.0, 5.0), (4.0, 3.0)]
    kept = prepare_numeric_data(df, drop_non_numeric=False)
    assert kept.columns == ["i", "s", "d"] and kept.where("s is null").first()["d"] == 3.0
    assert prepare_numeric_data(df, fill_na=False).where("d is null or i is null").count() == 2


def test_every_feature_is_described(spark, tx):
    from txlens.operators.tx_features import build_transaction_features, build_transaction_features_simple
    from txlens.operators.user_features import build_user_features
    for out in (build_user_features(tx, as_of="2024-02-01 00:00:00", include_one_hot=True), build_transaction_features(tx), build_transaction_features_simple(tx)):
        plain = [f.name for f in out.schema.fields if f.name not in ("user_id", "transaction_id") and not f.metadata.get("comment")]
        assert not plain and len(out.columns) >= 15
