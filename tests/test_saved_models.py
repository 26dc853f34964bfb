"""Saved segmentation models, fitted inputs and resumable training runs."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from txlens.operators.inputs import FittedInputs
from txlens.operators.segment import KMeansResult, SegmentationModel, train_kmeans
from txlens.plans import training as T
from txlens.plans.stages import table_fingerprint


def _users(spark, n=120, seed=7):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        c = i % 3
        rows.append((i, float(r.normal(4 * c)), None if i % 11 == 0 else float(r.normal(-3 * c)), float("inf") if i == 5 else float(r.gamma(1 + c)),
                     str(int(r.integers(5)) + c) if i % 7 else None, "abc"[c] * (1 + i % 2), 1.0))
    return spark.createDataFrame(rows, "user_id long, a double, b double, g double, number string, kind string, same double").repartition(4)


@pytest.mark.parametrize("use_pca", [True, False])
def test_reloaded_segmentation_gives_the_same_labels(spark, tmp_path, use_pca):
    users = _users(spark)
    trained = train_kmeans(users, ["user_id"], 3, use_pca=use_pca)
    trained.save(str(tmp_path / "km"))
    loaded = KMeansResult.load(spark, str(tmp_path / "km"))
    want = sorted(map(tuple, trained.labels.collect()))
    assert sorted(map(tuple, loaded.model.assign(users, ["user_id"]).collect())) == want
    assert sorted(map(tuple, loaded.labels.select(*trained.labels.columns).collect())) == want
    assert (loaded.n_clusters, loaded.inertia, loaded.silhouette, loaded.davies_bouldin, loaded.explained_variance, loaded.coords) == \
        (trained.n_clusters, trained.inertia, trained.silhouette, trained.davies_bouldin, trained.explained_variance, trained.coords)


def test_new_users_get_training_values(spark, tmp_path):
    users = _users(spark)
    inputs = FittedInputs.fit(users, ["user_id"], text=True, min_variance=1e-10)
    assert inputs.names == ["a", "b", "g", "number", "kind"] and inputs.kinds["kind"] == "code" and inputs.kinds["number"] == "text"
    inputs.save(spark, str(tmp_path / "in"))
    loaded = FittedInputs.load(spark, str(tmp_path / "in"))
    pdf = users.toPandas()
    new = spark.createDataFrame([(900, None, None, None, None, "unseen", None), (901, 1.0, 2.0, float("-inf"), "x", "a", 3.0)], users.schema)
    got = {r["user_id"]: r for r in loaded.clean(new.withColumn("more", F.lit(1)), ["user_id"]).collect()}
    finite = pdf["g"].replace([np.inf], np.nan)
    for i, g in ((900, got[900]), (901, got[901])):
        assert g["g"] == pytest.approx(finite.median()) and g["number"] == pytest.approx(pdf["number"].astype(float).median())
    assert got[900]["a"] == pytest.approx(pdf["a"].median()) and got[900]["b"] == pytest.approx(pdf["b"].median()) and got[900]["kind"] == -1
    first = pdf.sort_values("user_id")["kind"].drop_duplicates().tolist()
    assert got[901]["kind"] == first.index("a")
    with pytest.raises(ValueError):
        loaded.clean(new.drop("b"), ["user_id"])


def test_model_assigns_the_nearest_centre(spark, tmp_path):
    trained = train_kmeans(_users(spark), ["user_id"], 4, n_components=2)
    trained.model.save(spark, str(tmp_path / "m"))
    model = SegmentationModel.load(spark, str(tmp_path / "m"))
    centres = np.array(model.kmeans.clusterCenters())
    for r in model.assign(_users(spark, 40, seed=9), ["user_id"]).collect():
        d = ((centres - np.array([r[c] for c in model.coords])) ** 2).sum(1)
        assert d[r["cluster"]] == pytest.approx(d.min())


def test_fingerprint_of_a_table(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "i int, s string")
    same = table_fingerprint(a)
    assert same == table_fingerprint(a.orderBy(F.desc("i")).repartition(3))
    for other in (a.distinct(), a.union(a), a.withColumnRenamed("s", "t"), a.withColumn("i", F.col("i").cast("long")), a.fillna("", ["s"])):
        assert table_fingerprint(other) != same


def test_training_run_resumes(spark, tx, tmp_path, monkeypatch):
    args = dict(out_dir=str(tmp_path / "run"), as_of="2024-02-01 00:00:00", n_trees=10, shap_sample=5, n_clusters=2)

    def lost(*_, **__):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(T, "build_transaction_features", lost)
        with pytest.raises(RuntimeError):
            T.run_training(spark, tx, **args)
    with monkeypatch.context() as m:  # the two complete stages are not computed again
        m.setattr(T, "preprocess_transactions", lost)
        m.setattr(T, "build_user_features", lost)
        second = T.run_training(spark, tx, **args)
    assert second.stages.computed == ["transaction_features", "segmentation", "forest_inputs", "isolation_forest", "scores", "shap_values",
                                      "anomalies_csv", "report"]
    third = T.run_training(spark, tx.repartition(5), **args)
    assert third.stages.computed == [] and third.kmeans.silhouette == second.kmeans.silhouette
    assert third.report.collect() == second.report.collect()
    assert {r["stage"]: r["n_rows"] for r in third.stages.manifest().collect()}["scores"] == tx.count()
    other = T.run_training(spark, tx, **{**args, "n_clusters": 3})
    assert other.stages.computed == ["segmentation", "report"] and other.kmeans.n_clusters == 3
    assert "preprocessed" in T.run_training(spark, tx.limit(60), **args).stages.computed
