"""Offline training run (M40) and its report (M41), plus sinks.

``run_training`` = load -> user and transaction features -> KMeans(4) on the
users -> isolation forest (contamination .02) on the transactions -> TreeSHAP
on a seeded sample -> Parquet / CSV outputs -> report table. Every step is a
stage of a ``StageStore``: its result is written once, read by the steps after it, and
found again by a rerun. The models are used as reloaded from their saved form.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.functions.clean import preprocess_transactions
from txlens.operators import explain as X
from txlens.operators import iforest as IF
from txlens.operators.anomaly import analyze_anomalies, prepare_for_anomaly_detection
from txlens.operators.segment import KMeansResult, train_kmeans
from txlens.operators.tx_features import build_transaction_features
from txlens.operators.user_features import build_user_features
from txlens.plans.stages import StageStore, table_fingerprint
from txlens.session import checkpoint_dir


def write_parquet(df: DataFrame, path: str) -> str:
    """A5 / A7 sink."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """A8 sink: CSV with header, RFC 4180 quotes, timestamps with microseconds."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"') \
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return path


@dataclass
class TrainingOutputs:
    user_features: DataFrame
    tx_features: DataFrame
    kmeans: KMeansResult
    forest: IF.IsolationForestModel
    scores: DataFrame
    attributions: DataFrame
    report: DataFrame
    stages: StageStore


def forest_inputs(tx_features: DataFrame, key: str = "transaction_id") -> tuple[DataFrame, list[str]]:
    """M5 on the transaction features: numeric, finite, median-filled."""
    prepared = prepare_for_anomaly_detection(tx_features.drop("user_id"), [key])
    return prepared, [c for c in prepared.columns if c != key]


def run_training(spark: SparkSession, raw: DataFrame, out_dir: str | None = None, as_of: str | None = None,
                 n_clusters: int = 4, contamination: float = 0.02, n_trees: int = 100,
                 shap_sample: int = 200, seed: int = 42) -> TrainingOutputs:
    """All stages of the run below ``out_dir`` (default: a new scratch folder of the cluster).

    A rerun with the same input, folder and parameters starts at the first stage that is not complete.
    """
    out_dir = out_dir or f"{checkpoint_dir(spark).rstrip('/')}/txlens-training-{uuid.uuid4().hex}"
    st = StageStore(spark, out_dir, table_fingerprint(raw))
    pre = st.table("preprocessed", lambda: preprocess_transactions(raw))
    uf = st.table("user_features", lambda: build_user_features(pre, as_of=as_of, preprocessed=True), ("preprocessed",), as_of=as_of)
    tf = st.table("transaction_features", lambda: build_transaction_features(pre, preprocessed=True), ("preprocessed",))
    km = st.run("segmentation", lambda path: train_kmeans(uf, ["user_id"], n_clusters, seed=seed).save(path),
                lambda path: KMeansResult.load(spark, path), ("user_features",), n_clusters=n_clusters, seed=seed)
    x = st.table("forest_inputs", lambda: forest_inputs(tf)[0], ("transaction_features",))
    feats = [c for c in x.columns if c != "transaction_id"]
    forest = st.run("isolation_forest", lambda path: IF.fit_isolation_forest(
        x, feats, "transaction_id", n_trees=n_trees, contamination=contamination, seed=seed).save(spark, path),
        lambda path: IF.IsolationForestModel.load(spark, path), ("forest_inputs",), n_trees=n_trees, contamination=contamination, seed=seed)
    scores = st.table("scores", lambda: IF.flag(IF.score_samples(forest, x, ["transaction_id"]), contamination), ("isolation_forest",))
    attr = st.table("shap_values", lambda: X.shap_values(forest, X.sample_rows(x, "transaction_id", shap_sample, seed), "transaction_id"),
                    ("isolation_forest",), rows=shap_sample, seed=seed)

    def export(path: str) -> None:
        flagged = analyze_anomalies(raw, scores.select("transaction_id", "anomaly_score"))
        write_csv(flagged.where("is_above_threshold"), path)
    st.run("anomalies_csv", export, lambda path: path, ("scores",))
    report = st.table("report", lambda: training_report(spark, raw, uf, tf, km, scores, contamination), ("segmentation", "scores"))
    return TrainingOutputs(uf, tf, km, forest, scores, attr, report, st)


def training_report(spark: SparkSession, raw: DataFrame, uf: DataFrame, tf: DataFrame, km: KMeansResult,
                    scores: DataFrame, contamination: float) -> DataFrame:
    """Long (section, metric, value) table; every number from an aggregate."""
    data = raw.agg(F.count(F.lit(1)).alias("n"), F.min("transaction_date").alias("first"),
                   F.max("transaction_date").alias("last")).collect()[0]
    n_users = uf.count()
    sc = scores.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_anomaly").cast("long")).alias("a"),
                    F.avg("anomaly_score").alias("m")).collect()[0]
    rows = [
        ("data", "raw_transactions", str(data["n"])),
        ("data", "raw_columns", str(len(raw.columns))),
        ("data", "unique_users", str(n_users)),
        ("data", "period", f"{data['first']} - {data['last']}"),
        ("features", "user_features", str(len(uf.columns) - 1)),
        ("features", "transaction_features", str(len(tf.columns) - 2)),
        ("segmentation", "n_clusters", str(km.n_clusters)),
        ("segmentation", "silhouette_sq_euclidean", f"{km.silhouette:.3f}"),
        ("segmentation", "davies_bouldin", f"{km.davies_bouldin:.3f}"),
    ]
    for r in km.labels.groupBy("cluster").count().orderBy("cluster").collect():
        rows.append(("segmentation", f"cluster_{r['cluster']}",
                     f"{r['count']} users ({r['count'] * 100.0 / max(n_users, 1):.1f}%)"))
    rows += [
        ("anomalies", "contamination", str(contamination)),
        ("anomalies", "n_anomalies", str(sc["a"])),
        ("anomalies", "anomaly_rate_pct", f"{(sc['a'] or 0) * 100.0 / max(sc['n'], 1):.1f}"),
        ("anomalies", "mean_anomaly_score", f"{sc['m']:.3f}"),
    ]
    return spark.createDataFrame(rows, "section string, metric string, value string")
