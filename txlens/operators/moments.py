"""Pairwise-complete correlations from one pass of moments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.scalar import finite_or_null


def pairwise_correlations(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Pearson matrix over the rows where both columns are finite; NaN where it is undefined.

    Each column is centred by its mean (one aggregate). With M the indicator of
    present values and X the values (0 where absent), the blocks of the Gramian of
    [M, X, X^2] hold every pair's count, sums, squares and products. Tasks add up
    their batches, Spark adds up the tasks; the driver gets 9 p^2 sums, p being
    the number of columns.
    """
    p = len(cols)
    if not p:
        return np.zeros((0, 0))
    x = [finite_or_null(F.col(c).cast("double")) for c in cols]
    means = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)]).first()
    centred = df.select(*[(c - F.lit(means[i] if means[i] is not None else 0.0)).alias(f"x{i}") for i, c in enumerate(x)])

    def gramian(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((3 * p, 3 * p))
        for batch in batches:
            v = batch.to_numpy(dtype=float)
            here = ~np.isnan(v)
            v = np.where(here, v, 0.0)
            rows = np.hstack([here, v, v * v])
            total += rows.T @ rows
        yield pd.DataFrame({"place": np.arange(total.size), "total": total.ravel()})

    sums = np.zeros(9 * p * p)
    for place, value in centred.mapInPandas(gramian, "place int, total double").groupBy("place").agg(F.sum("total")).collect():
        sums[place] = value
    g = sums.reshape(3, p, 3, p)
    n, sx, sxx, sxy = g[0, :, 0], g[1, :, 0], g[2, :, 0], g[1, :, 1]
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = sxy - sx * sx.T / n
        var = sxx - sx ** 2 / n
        out = np.clip(cov / np.sqrt(var * var.T), -1, 1)
        # Where a variance is lost against the squares (constant columns, or a pair whose
        # common rows lie far from the column's mean) the pair is aggregated by itself.
        lost = ~(var > 1e-8 * sxx) & (n > 1)
    out[n < 2] = np.nan
    pairs = [(i, j) for i in range(p) for j in range(i, p) if lost[i, j] or lost[j, i]]
    if pairs:
        def corr(a, b):
            both = a.isNotNull() & b.isNotNull()
            a, b = F.when(both, a), F.when(both, b)
            return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))
        for lo in range(0, len(pairs), 50):
            some = pairs[lo:lo + 50]
            row = df.agg(*[corr(x[i], x[j]).alias(f"c{k}") for k, (i, j) in enumerate(some)]).first()
            for (i, j), r in zip(some, row):
                out[i, j] = out[j, i] = np.nan if r is None else r
    return out
