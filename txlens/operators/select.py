"""Feature selection by variance and correlation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.operators.moments import pairwise_correlations
from txlens.sources.schema import numeric_columns


def filter_important_features(df: DataFrame, correlation_threshold: float = 0.95,
                              variance_threshold: float = 0.01, keys: list[str] | None = None) -> DataFrame:
    """Drop columns with sample variance < ``variance_threshold``, then every
    column whose |Pearson correlation| with an *earlier* remaining column
    exceeds ``correlation_threshold`` (even if that earlier column is itself
    dropped). Correlations are pairwise-complete, as in D29;
    the decisions are plan-time column choices."""
    keys = [k for k in (keys or []) if k in df.columns]
    cols = [c for c in numeric_columns(df) if c not in keys]
    var = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in cols]).collect()[0]
    kept = [c for c in cols if var[c] is None or var[c] >= variance_threshold]
    corr = np.abs(pairwise_correlations(df, kept))
    drop = {c for j, c in enumerate(kept) if (corr[:j, j] > correlation_threshold).any()}
    return df.select(*keys, *[c for c in kept if c not in drop])
