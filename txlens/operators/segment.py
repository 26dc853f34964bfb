"""User segmentation with KMeans and its quality metrics.

Training uses ``pyspark.ml.clustering.KMeans`` on assembled vectors of the
standardised (optionally PCA-projected) features; every metric is an
aggregate over the labelled rows, so nothing per-row reaches the driver.

Silhouette: the exact Euclidean silhouette needs every pair of points in a
cluster, which does not scale; Spark's ``ClusteringEvaluator`` computes the
squared-Euclidean silhouette in O(n k) (named accordingly), and
``euclidean_silhouette`` estimates the Euclidean one against a bounded reference set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txlens.operators.cache import cut
from txlens.operators.decompose import compute_pca, projections
from txlens.operators.inputs import FittedInputs


def _vectors(df: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol="features").transform(df).select(*keys, *cols, "features")


MAX_CLUSTERS = 1000


def prepare_for_clustering(df: DataFrame, keys: list[str]) -> DataFrame:
    """M4: drop all-null / non-numeric columns, median-fill."""
    return FittedInputs.fit(df, keys).clean(df, keys)


def standardised(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    inputs = FittedInputs.fit(df, keys)
    return inputs.scaled(df, keys), inputs.names


def elbow_curve(df: DataFrame, keys: list[str], k_min: int = 2, k_max: int = 10, seed: int = 42) -> DataFrame:
    """M19 + M20: (k, inertia, silhouette) for every k, fitted once per k on the
    cached standardised vectors (the reference refits for every suggestion)."""
    sc, cols = standardised(df, keys)
    vec = _vectors(sc, cols, keys).persist()
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    rows = []
    try:
        for k in range(k_min, k_max + 1):
            model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(vec)
            sil = ev.evaluate(model.transform(vec)) if k > 1 else None
            rows.append((k, float(model.summary.trainingCost), None if sil is None else float(sil)))
    finally:
        vec.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


SILHOUETTE = "n_rows long, silhouette double, standard_error double, exact boolean, reference_rows int"
_PARTS = 10


def euclidean_silhouette(labelled: DataFrame, keys: list[str], cols: list[str], label: str = "cluster",
                         per_cluster: int = 500, seed: int = 42) -> DataFrame:
    """M20 with Euclidean distances: the mean of (b - a) / max(a, b) over all rows, estimated; one row.

    a is a row's mean distance to the rest of its cluster, b the least mean distance to another one. The exact value needs all
    pairs of rows; here every row is compared with a reference set, the ``per_cluster`` rows of each cluster
    with the smallest seeded hash of their key (a bounded table: at most ``MAX_CLUSTERS`` clusters). A row is not compared with
    itself. Rows of a cluster of one count 0. ``standard_error`` comes from ten parts of the reference set, each giving a value of its own;
    with every cluster whole in the reference set the value is ``exact`` and the error 0. Rows with a null
    label or coordinate take no part; fewer than two clusters give null.
    """
    spark = labelled.sparkSession
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [label, *cols]])
    rows = labelled.where(whole).select(F.xxhash64(*[F.col(k).cast("string") for k in keys], F.lit(seed)).alias("_h"), F.col(label).cast("string").alias("_l"),
                                        F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"))
    rows = cut(rows)
    sizes = dict(map(tuple, rows.groupBy("_l").count().limit(MAX_CLUSTERS + 1).collect()))
    if len(sizes) > MAX_CLUSTERS:
        raise ValueError(f"{label} has more than {MAX_CLUSTERS} values: not a cluster number")
    if len(sizes) < 2:
        return spark.createDataFrame([(sum(sizes.values()), None, None, True, 0)], SILHOUETTE)
    names = sorted(sizes)
    # About the wanted number of rows lies below a hash; only these are ordered.
    share = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(min(1.0, (per_cluster + 8 * per_cluster ** 0.5) / sizes[n])))])
    near = rows.where(F.col("_h").bitwiseAND((1 << 53) - 1) / float(1 << 53) <= share[F.col("_l")])
    order = Window.partitionBy("_l").orderBy(F.col("_h").bitwiseAND((1 << 53) - 1), "_h", "_x")
    found = near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_cluster).collect()
    k, exact = len(names), all(n <= per_cluster for n in sizes.values())
    ref = np.array([r["_x"] for r in found])
    group = np.array([names.index(r["_l"]) for r in found]) * _PARTS + np.array([r["_n"] % _PARTS for r in found])
    member = np.zeros((len(found), k * _PARTS))
    member[np.arange(len(found)), group] = 1.0
    place = {(r["_h"], tuple(r["_x"])): i for i, r in enumerate(found)}

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = member.sum(0).reshape(1, k, _PARTS)
        index = {n: i for i, n in enumerate(names)}
        single = np.array([sizes[n] == 1 for n in names])
        for batch in batches:
            for lo in range(0, len(batch), 256):
                b = batch.iloc[lo:lo + 256]
                x, own = np.stack(b["_x"].to_numpy()), b["_l"].map(index).to_numpy()
                d = np.sqrt(np.maximum(((x[:, None, :] - ref[None, :, :]) ** 2).sum(2), 0.0))
                sums = (d @ member).reshape(len(b), k, _PARTS)
                n = np.repeat(counts, len(b), 0)
                for i, (h, v) in enumerate(zip(b["_h"], x)):
                    at = place.get((h, tuple(v)))
                    if at is not None:
                        n[i].ravel()[group[at]] -= 1

                def mean_of(total, number):
                    with np.errstate(invalid="ignore", divide="ignore"):
                        m = np.where(number > 0, total / number, np.nan)
                        a = m[np.arange(len(m)), own]
                        m[np.arange(len(m)), own] = np.nan
                        least = np.nanmin(np.where(np.isnan(m), np.inf, m), axis=1)
                        s = np.where(np.maximum(a, least) > 0, (least - a) / np.maximum(a, least), 0.0)
                    s[single[own] | np.isnan(a) | np.isinf(least)] = 0.0
                    return float(s.sum())
                yield pd.DataFrame({"n": [len(b)], "s": [mean_of(sums.sum(2), n.sum(2))],
                                    "parts": [[mean_of(sums[:, :, g], n[:, :, g]) for g in range(_PARTS)]]})

    got = rows.mapInPandas(score, "n long, s double, parts array<double>")
    row = got.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), *[F.sum(F.col("parts")[g]).alias(f"p{g}") for g in range(_PARTS)]).first()
    parts = np.array([row[f"p{g}"] for g in range(_PARTS)]) / row["n"]
    error = 0.0 if exact else float(parts.std(ddof=1) / _PARTS ** 0.5)
    # Twelve digits: the order in which tasks add up shows below them.
    return spark.createDataFrame([(row["n"], round(row["s"] / row["n"], 12), round(error, 12), exact, len(found))], SILHOUETTE)


def suggest_k(curve: DataFrame, method: str = "elbow") -> int:
    """M23 + E5 on the curve table (one row per k).

    elbow: the inner k whose second difference of inertia is largest in size;
    silhouette: the k with the best silhouette; combined: the integer mean of
    both. Ties go to the smaller k; without a candidate the smallest k is taken.
    """
    if method not in ("elbow", "silhouette", "combined"):
        raise ValueError(f"unknown method: {method}")
    w = Window.orderBy("k")
    bend = F.abs(F.lead("inertia").over(w) - 2 * F.col("inertia") + F.lag("inertia").over(w))
    best = lambda c: F.coalesce(F.max_by(F.when(F.col(c).isNotNull(), F.col("k")),
                                         F.when(F.col(c).isNotNull(), F.struct(F.col(c), -F.col("k")))), F.min("k"))
    k = curve.withColumn("bend", bend).agg(best("bend").alias("elbow"), best("silhouette").alias("silhouette")) \
             .withColumn("combined", F.floor((F.col("elbow") + F.col("silhouette")) / 2))
    return int(k.first()[method])


def davies_bouldin(labelled: DataFrame, cols: list[str], label: str = "cluster") -> float:
    """Mean over clusters of max_j (s_i + s_j) / d(c_i, c_j).

    Centroids and mean distances are two aggregates over the rows; clusters are
    compared on the table of centroids, which must have at most ``MAX_CLUSTERS``
    rows. Clusters with the same centroid are not compared with each other.
    """
    cent = labelled.groupBy(label).agg(*[F.avg(c).alias(f"_c_{c}") for c in cols])
    found = cent.limit(MAX_CLUSTERS + 1).collect()
    if len(found) > MAX_CLUSTERS:
        raise ValueError(f"{label} has more than {MAX_CLUSTERS} values: not a cluster number")
    if len(found) < 2:
        return 0.0
    dist = F.sqrt(sum(((F.col(c) - F.col(f"_c_{c}")) ** 2 for c in cols), F.lit(0.0)))
    spread = dict(map(tuple, labelled.join(F.broadcast(cent), label).groupBy(label).agg(F.avg(dist)).collect()))
    x = np.array([[r[f"_c_{c}"] for c in cols] for r in found], dtype=float)
    s = np.array([spread[r[label]] for r in found])
    apart = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    worst = np.divide(s[:, None] + s[None, :], apart, out=np.zeros_like(apart), where=apart > 0)
    return float(worst.max(1).mean())


@dataclass
class SegmentationModel:
    """Everything that assigns users to segments: fitted inputs, components (if projected) and centres.

    Saved as Parquet tables beside the ``pyspark.ml`` KMeans model; what is loaded assigns
    any feature table exactly as the training run assigned its own.
    """
    inputs: FittedInputs
    components: np.ndarray | None    # one row per coordinate; None without projection
    kmeans: KMeansModel
    explained_variance: float | None

    @property
    def coords(self) -> list[str]:
        return self.inputs.names if self.components is None else [f"PC{i + 1}" for i in range(len(self.components))]

    @property
    def n_clusters(self) -> int:
        return len(self.kmeans.clusterCenters())

    def coordinates(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """``keys`` and the coordinates that the clusters are made of."""
        scaled = self.inputs.scaled(df, keys)
        return scaled if self.components is None else scaled.select(*keys, *projections(self.components, self.inputs.names))

    def assign(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """``keys``, coordinates and ``cluster`` (the nearest centre) of every row of a feature table.

        Gaps get the training medians, values without a code -1; missing columns raise
        ValueError, further columns are ignored.
        """
        out = self.kmeans.transform(_vectors(self.coordinates(df, keys), self.coords, keys))
        return out.select(*keys, *self.coords, "cluster")

    def save(self, spark: SparkSession, path: str) -> None:
        self.inputs.save(spark, f"{path}/inputs")
        self.kmeans.write().overwrite().save(f"{path}/kmeans")
        rows = [] if self.components is None else [(i, c, float(w)) for i, row in enumerate(self.components)
                                                   for c, w in zip(self.inputs.names, row)]
        spark.createDataFrame(rows, "component int, name string, weight double").coalesce(1).write.mode("overwrite").parquet(f"{path}/components")
        spark.createDataFrame([(self.explained_variance,)], "explained_variance double").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/params")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SegmentationModel":
        inputs = FittedInputs.load(spark, f"{path}/inputs")
        found = {(r["component"], r["name"]): r["weight"] for r in spark.read.parquet(f"{path}/components").collect()}
        k = 1 + max((i for i, _ in found), default=-1)
        components = np.array([[found[i, c] for c in inputs.names] for i in range(k)]) if k else None
        return cls(inputs, components, KMeansModel.load(f"{path}/kmeans"), spark.read.parquet(f"{path}/params").first()[0])


@dataclass
class KMeansResult:
    labels: DataFrame          # keys + coordinates + cluster
    coords: list[str]
    n_clusters: int
    inertia: float
    silhouette: float          # squared-Euclidean silhouette (ClusteringEvaluator)
    davies_bouldin: float
    explained_variance: float | None
    model: SegmentationModel | None = None

    def save(self, path: str) -> None:
        """The model (see ``SegmentationModel``), the labels and the quality metrics."""
        spark = self.labels.sparkSession
        self.model.save(spark, f"{path}/model")
        self.labels.write.mode("overwrite").parquet(f"{path}/labels")
        self.metrics(spark).withColumn("inertia", F.lit(self.inertia)).coalesce(1).write.mode("overwrite").parquet(f"{path}/metrics")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "KMeansResult":
        model, labels = SegmentationModel.load(spark, f"{path}/model"), spark.read.parquet(f"{path}/labels")
        m = spark.read.parquet(f"{path}/metrics").first()
        return cls(labels, model.coords, m["n_clusters"], m["inertia"], m["silhouette_sq_euclidean"], m["davies_bouldin"],
                   m["pca_explained_variance"], model)

    def metrics(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.n_clusters, self.inertia, self.silhouette, self.davies_bouldin,
                                       self.explained_variance)],
                                     "n_clusters int, inertia double, silhouette_sq_euclidean double, "
                                     "davies_bouldin double, pca_explained_variance double")


def train_kmeans(df: DataFrame, keys: list[str], n_clusters: int, use_pca: bool = True,
                 n_components: int = 2, seed: int = 42) -> KMeansResult:
    """Standardise -> optional PCA -> KMeans; labels and quality metrics."""
    if use_pca:
        pca = compute_pca(df, keys, n_components=n_components)
        inputs, components = pca.inputs, pca.components[:pca.n_components]
        explained = float(np.sum(pca.ratio[:pca.n_components]))
    else:
        inputs, components, explained = FittedInputs.fit(df, keys), None, None
    fitted = SegmentationModel(inputs, components, None, explained)
    coords = fitted.coords
    vec = _vectors(fitted.coordinates(df, keys), coords, keys).persist()
    try:
        fitted.kmeans = KMeans(k=n_clusters, seed=seed, featuresCol="features", predictionCol="cluster").fit(vec)
        labelled = fitted.kmeans.transform(vec)
        sil = ClusteringEvaluator(featuresCol="features", predictionCol="cluster",
                                  distanceMeasure="squaredEuclidean").evaluate(labelled)
        out = cut(labelled.select(*keys, *coords, "cluster"))
        db = davies_bouldin(out, coords)
        inertia = float(fitted.kmeans.summary.trainingCost)
    finally:
        vec.unpersist()
    return KMeansResult(out, coords, n_clusters, inertia, float(sil), db, explained, fitted)
