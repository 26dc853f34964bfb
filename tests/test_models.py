"""ML stages on blobs (3 centres, 100 x 10) and planted outliers."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txlens.operators import explain as X
from txlens.operators import iforest as IF
from txlens.operators.decompose import compute_pca
from txlens.operators.segment import elbow_curve, suggest_k, train_kmeans
from txlens.operators.select import filter_important_features


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(42)
    centres = rng.uniform(-10, 10, size=(3, 10))
    lab = rng.integers(0, 3, 100)
    x = centres[lab] + rng.normal(size=(100, 10))
    pdf = pd.DataFrame(x, columns=[f"feature_{i}" for i in range(10)])
    pdf.insert(0, "id", np.arange(100))
    return spark.createDataFrame(pdf)


def test_pca_ratios_and_orthonormal(blobs):
    r = compute_pca(blobs, ["id"], n_components=3)
    ratio = r.ratio[:3]
    assert (ratio >= 0).all() and (ratio <= 1).all() and ratio.sum() <= 1 + 1e-9
    c = r.components[:3]
    assert np.allclose(c @ c.T, np.eye(3), atol=1e-8)
    assert r.summary().count() == 3
    sc = r.scores().toPandas()
    assert len(sc) == 100 and sc["cos2"].between(0, 1).all()


def test_pca_auto_components_reach_80pct(blobs):
    r = compute_pca(blobs, ["id"], variance_threshold=0.8)
    assert np.cumsum(r.ratio)[r.n_components - 1] >= 0.8 - 1e-9
    m = r.metrics().collect()[0]
    assert 0 <= m["kmo"] <= 1 and m["bartlett_df"] == 45


def test_elbow_inertia_decreasing(blobs):
    curve = elbow_curve(blobs, ["id"], 2, 5).orderBy("k").toPandas()
    assert (np.diff(curve["inertia"]) < 0).all()
    assert curve["silhouette"].between(-1, 1).all()
    assert suggest_k(elbow_curve(blobs, ["id"], 2, 5), "silhouette") in range(2, 6)


def test_kmeans_labels_and_width(blobs):
    r = train_kmeans(blobs, ["id"], 3, use_pca=True, n_components=2)
    assert r.labels.select("cluster").distinct().count() == 3
    assert -1 <= r.silhouette <= 1 and r.davies_bouldin >= 0
    assert len(r.coords) == 2
    r2 = train_kmeans(blobs, ["id"], 3, use_pca=False)
    assert len(r2.coords) == 10


def test_iforest_share_and_planted_outlier(spark, blobs):
    planted = blobs.union(spark.createDataFrame([(999, *([0.0] * 9), 500.0)], blobs.schema))
    feats = [f"feature_{i}" for i in range(10)]
    model = IF.fit_isolation_forest(planted, feats, "id", n_trees=50, contamination=0.1)
    sc = IF.flag(IF.score_samples(model, planted, ["id"]), 0.1).toPandas()
    assert abs(sc["is_anomaly"].mean() - 0.1) <= 0.05
    assert sc["raw_score"].between(0, 1).all()
    assert sc.sort_values("anomaly_score", ascending=False)["id"].iloc[0] == 999
    attr = X.shap_values(model, planted.where("id = 999"), "id").toPandas()
    assert attr.sort_values("abs_shap", ascending=False)["feature"].iloc[0] == "feature_9"
    # local accuracy: base + sum(shap) = negated mean path length
    mpl = sc.set_index("id").loc[999, "mean_path_length"]
    assert attr["base_value"].iloc[0] + attr["shap_value"].sum() == pytest.approx(-mpl, abs=1e-8)


def test_iforest_refuses_tiny_input(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(5)], "id int, a double")
    with pytest.raises(ValueError):
        IF.fit_isolation_forest(df, ["a"], "id")


def test_iforest_independent_of_partitioning(blobs):
    feats = [f"feature_{i}" for i in range(10)]
    a = IF.fit_isolation_forest(blobs, feats, "id", n_trees=20)
    b = IF.fit_isolation_forest(blobs.repartition(7), feats, "id", n_trees=20)
    pd.testing.assert_frame_equal(a.nodes, b.nodes)


def test_feature_selection_order(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=200)
    pdf = pd.DataFrame({"k": range(200), "a": a, "a_copy": a, "b": a * 2 + rng.normal(scale=1e-3, size=200),
                        "c": rng.normal(size=200), "const": 1.0})
    out = filter_important_features(spark.createDataFrame(pdf), keys=["k"])
    assert out.columns == ["k", "a", "c"]
