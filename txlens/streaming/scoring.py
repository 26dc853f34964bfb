"""Scoring new transactions with a saved isolation forest, as a stream.

The analytics themselves are batch jobs (the source pipeline has no stream,
watermark or state). What carries over to a stream is the use of a fitted
model on arriving rows: ``score_stream`` applies a forest saved by
``IsolationForestModel.save`` to a Structured Streaming source with the same
Arrow ``mapInPandas`` scorer as the batch path. It is stateless, so every
micro-batch is independent; the fitted offset (the training percentile of
s(x)) turns raw scores into ``anomaly_score`` / ``is_anomaly``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.operators.iforest import IsolationForestModel, score_samples


def score_stream(spark: SparkSession, stream: DataFrame, model: IsolationForestModel, offset: float,
                 keys: list[str]) -> DataFrame:
    """Streaming DataFrame of keys + raw_score + anomaly_score + is_anomaly."""
    scored = score_samples(model, stream, keys)
    return scored.withColumn("anomaly_score", F.col("raw_score") - F.lit(float(offset))) \
                 .withColumn("is_anomaly", F.col("anomaly_score") > 0)


def training_offset(scored_training: DataFrame, contamination: float) -> float:
    """The (1 - contamination) percentile of the training scores (one value)."""
    from txlens.operators.quantiles import quantiles
    return float(quantiles(scored_training, "raw_score", [1.0 - min(contamination, 0.5)])[0])
