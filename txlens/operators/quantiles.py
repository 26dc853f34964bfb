"""Exact linear-interpolated quantiles without a single-task merge.

Spark's ``percentile`` aggregate merges a map of every distinct value into one
final task, which does not survive a column of 10^12 rows. Here equal values are
counted first (map-side combined, so ties of any number are one row), the
distinct values are dealt by range and their counts summed up in order: each
value then covers an interval of ranks, and only the values that cover a wanted
rank are kept. Nothing is global but one row per range and the groups' sizes.
The counted values are written once to the shared folder (a job of its own),
since all readers must see the same ranges.

Interpolation is ``lo + (hi - lo) * frac`` at position ``p * (n - 1)``, the
definition of pandas / numpy ``linear`` and SQL ``quantile_cont``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlens.operators.cache import cut


def running_ranks(rows: DataFrame, order_cols: list[str], weight: str | None = None) -> DataFrame:
    """``rows`` with ``_from`` and ``_upto``: the ranks, from 0, that each row covers in the global order.

    A row covers ``weight`` ranks (default 1). Rows are dealt by range and staged
    with their range's number; sums inside the ranges are shifted by the sizes
    of the ranges before (one row each).
    """
    w = F.col(weight) if weight else F.lit(1)
    placed = cut(rows.repartitionByRange(*order_cols).withColumn("_range", F.spark_partition_id()))
    sizes = placed.groupBy("_range").agg(F.sum(w).alias("_size"))
    ahead = sizes.select("_range", (F.sum("_size").over(Window.orderBy("_range")) - F.col("_size")).alias("_ahead"))
    inside = F.sum(w).over(Window.partitionBy("_range").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0))
    out = placed.withColumn("_inside", inside).join(F.broadcast(ahead), "_range")
    upto = F.col("_ahead") + F.col("_inside")
    return out.select(*rows.columns, (upto - w).alias("_from"), upto.alias("_upto"))


def _counted(df: DataFrame, by: list[str], value: Column) -> DataFrame:
    """Distinct finite values per group with their intervals of ranks."""
    vals = df.select(*by, value.cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    return running_ranks(vals.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("_n")), [*by, "v"], "_n")


def _picked(probs: list[float], names: list[str], total: Column, start: Column) -> tuple[list[Column], list[Column]]:
    """Aggregates that pick the values at each wanted rank, and the interpolations of their results."""
    aggs, out = [], []
    for i, (p, name) in enumerate(zip(probs, names)):
        h = F.lit(float(p)) * (total - 1)
        for end, k in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            here = (F.col("_from") <= start + k) & (start + k < F.col("_upto"))
            aggs.append(F.max(F.when(here, F.col("v"))).alias(f"_{end}{i}"))
        aggs.append(F.max(h - F.floor(h)).alias(f"_frac{i}"))
        out.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_frac{i}")).alias(name))
    return aggs, out


_BINS = 4096  # of equal width, whose sizes tell where the wanted ranks lie
_NARROW_FROM = 200_000  # rows; fewer are ranked at once


def _narrowed(vals: DataFrame, probs: list[float], names: list[str]) -> DataFrame | None:
    """Quantiles of ``v`` from the values of the bins that hold a wanted rank; None where bins tell nothing.

    Bins follow the order of the values, so that the sizes of those before a bin give the rank that it begins at.
    """
    n, least, most = vals.agg(F.count("v"), F.min("v"), F.max("v")).first()
    if n < _NARROW_FROM or not 0 < (width := (most - least) / _BINS) < float("inf"):
        return None
    number = F.least(F.floor((F.col("v") - F.lit(least)) / F.lit(width)), F.lit(_BINS - 1))
    sizes = dict(map(tuple, vals.groupBy(number.alias("b")).count().collect()))  # at most _BINS rows
    wanted = [(h := float(p) * (n - 1), (math.floor(h), math.ceil(h))) for p in probs]
    ranks, kept, left, before = sorted({k for _, ends in wanted for k in ends}), [], 0, 0
    place = {}  # of a wanted rank among the values kept
    for b in sorted(sizes):
        inside = [k for k in ranks if before <= k < before + sizes[b]]
        if inside:
            kept.append(b)
            place |= {k: k - before + left for k in inside}
            left += sizes[b]
        before += sizes[b]
    counted = running_ranks(vals.where(number.isin(kept)).groupBy("v").agg(F.count(F.lit(1)).alias("_n")), ["v"], "_n")
    picked = counted.agg(*[F.max(F.when((F.col("_from") <= place[k]) & (F.col("_upto") > place[k]), F.col("v"))).alias(f"_{k}") for k in ranks])
    return picked.select(*[(F.col(f"_{lo}") + (F.col(f"_{hi}") - F.col(f"_{lo}")) * F.lit(h - lo)).alias(name)
                           for (h, (lo, hi)), name in zip(wanted, names)])


def quantiles_df(df: DataFrame, col: str | Column, probs: list[float],
                 names: list[str] | None = None, stored: bool = False) -> DataFrame:
    """Global exact quantiles of one numeric column as a one-row DataFrame.

    Nulls and NaN are ignored; with no value left every quantile is null. ``stored``: reading ``df`` again is cheap, so
    that values far from the wanted ranks are told by counts first and only the others are grouped and moved.
    """
    names = names or [f"q{i}" for i in range(len(probs))]
    if stored:
        v = (F.col(col) if isinstance(col, str) else col).cast("double")
        out = _narrowed(df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v")), probs, names)
        if out is not None:
            return out
    counted = _counted(df, [], F.col(col) if isinstance(col, str) else col)
    total = counted.agg(F.sum("_n").alias("_total"))  # one row
    aggs, out = _picked(probs, names, F.col("_total"), F.lit(0))
    return counted.crossJoin(F.broadcast(total)).agg(*aggs).select(*out)


def quantiles(df: DataFrame, col: str | Column, probs: list[float],
              method: str = "exact", accuracy: int = 100_000) -> list[float | None]:
    """Global quantiles as Python floats (one small result row to the driver).

    ``method='approx'`` uses Spark's bounded-memory ``percentile_approx``.
    """
    if method == "approx":
        c = F.col(col) if isinstance(col, str) else col
        row = df.agg(F.percentile_approx(c.cast("double"), list(probs), accuracy).alias("q")).collect()[0]
        return list(row["q"]) if row["q"] is not None else [None] * len(probs)
    if method != "exact":
        raise ValueError(f"unknown quantile method: {method}")
    row = quantiles_df(df, col, probs).collect()[0]
    return [row[i] for i in range(len(probs))]


def grouped_quantiles(df: DataFrame, by: list[str], col: str, probs: list[float],
                      names: list[str] | None = None) -> DataFrame:
    """Exact quantiles of ``col`` per group, one row per group.

    A group's values hold consecutive ranks, so its k-th value is at rank
    ``start + k``. No group is ever gathered into one task, however large it is.
    """
    names = names or [f"q{int(round(p * 1000)):03d}" for p in probs]
    counted = _counted(df, by, F.col(col))
    groups = counted.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]).agg(
        F.min("_from").alias("_start"), F.sum("_n").alias("_total"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)])
    aggs, out = _picked(probs, names, F.col("_total"), F.col("_start"))
    return counted.join(groups, same).groupBy(*by).agg(*aggs).select(*by, *out)


def row_ranks(df: DataFrame, col: str, chunk: int = 1_000_000) -> DataFrame:
    """``v, _rank`` for every finite value of ``col``: its place from 0 in ascending order.

    Equal values are one counted row until the end, where they are spread out
    in chunks, so ties do not meet in one task.
    """
    counted = _counted(df, [], F.col(col))
    chunks = counted.select("v", "_upto", F.explode(F.sequence(F.col("_from"), F.col("_upto") - 1, F.lit(chunk).cast("long"))).alias("_at"))
    last = F.least(F.col("_at") + chunk, F.col("_upto")) - 1
    return chunks.select("v", F.explode(F.sequence("_at", last)).alias("_rank"))
