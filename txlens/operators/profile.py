"""Profiling and descriptive statistics.

Each profile is one (or a few) aggregate passes; per-column results are
unpivoted into long tables so that the number of columns never turns into a
number of jobs. Quantiles use the distributed exact sort (no single-task merge).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlens.functions.scalar import finite_or_null, round_half_up as R
from txlens.operators.cache import cut
from txlens.operators.moments import pairwise_correlations
from txlens.operators.quantiles import grouped_quantiles, running_ranks
from txlens.sources.schema import categorical_columns, numeric_columns


def to_long(df: DataFrame, cols: list[str], keys: list[str] | None = None,
            name: str = "feature", value: str = "value") -> DataFrame:
    """Unpivot numeric columns to (keys..., feature, value double)."""
    keys = keys or []
    return df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias(name), finite_or_null(F.col(c).cast("double")).alias(value)) for c in cols
    ])).alias("_kv")).select(*keys, f"_kv.{name}", f"_kv.{value}")


def describe(df: DataFrame, cols: list[str] | None = None, digits: int = 6) -> DataFrame:
    """D24 ``describe``: per feature count, mean, std (sample), min, 25/50/75 %, max.

    One unpivot, one aggregate and one distributed sort for all quantiles.
    """
    cols = cols or numeric_columns(df)
    long = to_long(df, cols)
    mom = long.groupBy("feature").agg(
        F.count("value").alias("count"),
        R(F.avg("value"), digits).alias("mean"),
        R(F.stddev_samp("value"), digits).alias("std"),
        R(F.min("value"), digits).alias("min"),
        R(F.max("value"), digits).alias("max"),
    )
    qs = grouped_quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75], names=["p25", "p50", "p75"])
    qs = qs.select("feature", *[R(F.col(c), digits).alias(c) for c in ("p25", "p50", "p75")])
    return mom.join(qs, "feature", "left").select(
        "feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def feature_stats(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """D25 ``get_user_features_stats``: describe (3 digits) + missing, missing %, dtype."""
    cols = cols or numeric_columns(df)
    d = describe(df, cols, digits=3)
    miss = to_long(df, cols).groupBy("feature").agg(
        F.sum(F.col("value").isNull().cast("long")).alias("missing"),
        F.count(F.lit(1)).alias("_rows"))
    types = df.sparkSession.createDataFrame(
        [(c, df.schema[c].dataType.simpleString()) for c in cols], "feature string, dtype string")
    return (d.join(miss, "feature").join(F.broadcast(types), "feature")
            .select("feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max", "missing",
                    R(F.col("missing") * 100.0 / F.col("_rows"), 2).alias("missing_pct"), "dtype"))


def _text(df: DataFrame, c: str) -> Column:
    """A value as text, equal for equal values only; null for null."""
    v = F.col(c)
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        v = v + F.lit(0.0)  # one zero
    return v.cast("string")


def data_quality(df: DataFrame) -> DataFrame:
    """D26 ``check_data_quality``: one row of table-level quality metrics.

    Duplicates = rows - distinct rows. Rows are compared by their SHA-256, so what is dealt
    out is a digest a row, counted where it is read first, and not the row.
    """
    cols = df.columns
    num = numeric_columns(df)
    cat = categorical_columns(df)
    marked = F.concat(*[F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in (_text(df, c) for c in cols)])
    nulls = sum((F.col(c).isNull().cast("long") for c in cols), F.lit(0))
    rows = df.select(F.unhex(F.sha2(marked, 256)).alias("_row"), nulls.alias("_nulls"))
    same = rows.groupBy("_row").agg(F.count(F.lit(1)).alias("_n"), F.sum("_nulls").alias("_nulls"))
    one = same.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("_nulls"), F.lit(0)).alias("missing_values"),
                   F.count(F.lit(1)).alias("_distinct"))
    return one.select(
        "n_rows",
        F.lit(len(cols)).cast("bigint").alias("n_columns"),
        F.lit(",".join(num)).alias("numeric_columns"),
        F.lit(",".join(cat)).alias("categorical_columns"),
        "missing_values",
        R(F.try_divide(F.col("missing_values") * 100.0, F.col("n_rows") * len(cols)), 4).alias("missing_percentage"),
        (F.col("n_rows") - F.col("_distinct")).alias("duplicate_rows"),
    )


def value_counts_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """``column, value, n`` for every value of several columns, null included: one aggregate of narrow rows.

    Values are texts; those above 64 characters are known by their SHA-256.
    """
    short = lambda t: F.when(F.char_length(t) > 64, F.sha2(t, 256)).otherwise(t)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), short(_text(df, c)).alias("value")) for c in cols])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.column", "p.value").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, cols: list[str], approximate: bool = False) -> DataFrame:
    """``column, n_distinct, n_missing`` for several columns.

    Exact by default: values are counted per (column, value) first and then per column, so a value that a third of
    the rows hold is one row per task. ``approximate`` keeps one mergeable sketch per column instead (relative
    error about 1.6 % with 2^12 registers), without dealing out any value.
    """
    if approximate:
        one = df.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(_text(df, c), F.lit(12))).alias(f"d{i}") for i, c in enumerate(cols)],
                     *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
        return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(f"d{i}", F.lit(0)).alias("n_distinct"), F.col(f"m{i}").alias("n_missing"))
                                             for i, c in enumerate(cols)])))
    return value_counts_long(df, cols).groupBy("column").agg(
        F.count("value").alias("n_distinct"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_missing"))


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Per column dtype, distinct count (nulls excluded), missing count."""
    names = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype")) for c in df.columns])
    columns = df.sparkSession.range(1).select(F.inline(names))  # one row per column, also of an empty table
    return columns.join(distinct_counts(df, df.columns, approximate), "column", "left").select(
        "column", "dtype", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), F.coalesce("n_missing", F.lit(0)).alias("n_missing"))


def missing_table(df: DataFrame) -> DataFrame:
    """Columns with at least one null: count and % of rows."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(F.col(c).isNull().cast("long")).alias(f"m_{i}") for i, c in enumerate(cols)])
    long = one.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m_{i}").alias("missing")) for i, c in enumerate(cols)
    ])).alias("r")).select("r.column", "r.missing", "_n")
    return long.where(F.col("missing") > 0).select(
        "column", "missing", R(F.col("missing") * 100.0 / F.col("_n"), 2).alias("missing_pct"))


def dtype_counts(df: DataFrame) -> DataFrame:
    """D28 companion: number of columns per dtype (schema only)."""
    rows = {}
    for f in df.schema.fields:
        rows[f.dataType.simpleString()] = rows.get(f.dataType.simpleString(), 0) + 1
    return df.sparkSession.createDataFrame(sorted(rows.items()), "dtype string, n_columns bigint")


def correlation(df: DataFrame, cols: list[str] | None = None, digits: int = 2) -> DataFrame:
    """Pairwise Pearson correlation (pairwise-complete) from one pass of moments.

    Output is long: (feature_i, feature_j, corr) for every ordered pair, the
    diagonal included. Constant columns give null.
    """
    cols = cols or numeric_columns(df)
    corr = pairwise_correlations(df, cols)
    rows = [(a, b, None if np.isnan(corr[i, j]) else float(corr[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "feature_i string, feature_j string, corr double") \
             .withColumn("corr", R("corr", digits))


def variances(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Sample variance per column (long)."""
    cols = cols or numeric_columns(df)
    return to_long(df, cols).groupBy("feature").agg(F.var_samp("value").alias("variance"))


def kpis(df: DataFrame, user_col: str = "user_id", date_col: str = "transaction_date") -> DataFrame:
    """Transactions, columns, distinct users, first and last date."""
    aggs = [F.count(F.lit(1)).alias("n_transactions"), F.lit(len(df.columns)).cast("bigint").alias("n_columns")]
    if user_col in df.columns:
        aggs.append(F.count_distinct(user_col).alias("n_users"))
    if date_col in df.columns:
        aggs += [F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date")]
    return df.agg(*aggs)


def histogram(df: DataFrame, col: str, bins: int = 50, by: str | None = None) -> DataFrame:
    """Equal-width histogram over [min, max], the max folded into the last bin.

    Output: (by?, bin, lower, upper, count) for non-empty bins.
    """
    keys = [by] if by else []
    v = finite_or_null(F.col(col).cast("double"))
    vals = df.select(*keys, v.alias("v")).where(F.col("v").isNotNull())
    rng = vals.agg(F.min("v").alias("_mn"), F.max("v").alias("_mx"))
    width = (F.col("_mx") - F.col("_mn")) / F.lit(bins)
    b = F.when(F.col("_mx") == F.col("_mn"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("_mn")) / (F.col("_mx") - F.col("_mn")) * F.lit(bins)), F.lit(bins - 1)))
    return (vals.crossJoin(F.broadcast(rng)).select(*keys, b.cast("int").alias("bin"), "_mn", "_mx")
            .groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("count"), F.first("_mn").alias("_mn"),
                                       F.first("_mx").alias("_mx"))
            .select(*keys, "bin", (F.col("_mn") + F.col("bin") * (F.col("_mx") - F.col("_mn")) / F.lit(bins)).alias("lower"),
                    (F.col("_mn") + (F.col("bin") + 1) * (F.col("_mx") - F.col("_mn")) / F.lit(bins)).alias("upper"),
                    "count"))


def box_summary(df: DataFrame, col: str, by: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Per group min, quartiles, max, IQR fences (1.5 IQR) and outlier count."""
    by = by or []
    keys = by if by else ["_all"]
    src = df if by else df.withColumn("_all", F.lit(1))
    qs = grouped_quantiles(src, keys, col, [0.25, 0.5, 0.75], names=["q1", "median", "q3"])
    mm = src.groupBy(*keys).agg(F.min(col).alias("min"), F.max(col).alias("max"),
                                F.count(F.col(col)).alias("n"))
    box = qs.join(mm, keys).withColumn("iqr", F.col("q3") - F.col("q1")) \
            .withColumn("lower_fence", F.col("q1") - 1.5 * F.col("iqr")) \
            .withColumn("upper_fence", F.col("q3") + 1.5 * F.col("iqr"))
    # per-group sized table; AQE broadcasts it when small
    outl = src.join(box.select(*keys, "lower_fence", "upper_fence"), keys) \
              .groupBy(*keys).agg(F.sum(((F.col(col) < F.col("lower_fence")) |
                                         (F.col(col) > F.col("upper_fence"))).cast("long")).alias("n_outliers"))
    out = box.join(outl, keys, "left")
    cols = ["n", "min", "q1", "median", "q3", "max", "iqr", "lower_fence", "upper_fence"]
    sel = [F.col("n"), *[R(F.col(c), digits).alias(c) for c in cols[1:]],
           F.coalesce(F.col("n_outliers"), F.lit(0)).alias("n_outliers")]
    return out.select(*by, *sel)


def group_profiles(df: DataFrame, by: str, cols: list[str] | None = None) -> DataFrame:
    """D22 ``get_cluster_profiles``: per group and feature mean / std / min / max / count
    (3 digits), plus group size and share (1 digit). Long output."""
    cols = cols or [c for c in numeric_columns(df) if c != by]
    long = to_long(df, cols, keys=[by])
    stats = long.groupBy(by, "feature").agg(
        R(F.avg("value"), 3).alias("mean"), R(F.stddev_samp("value"), 3).alias("std"),
        R(F.min("value"), 3).alias("min"), R(F.max("value"), 3).alias("max"),
        F.count("value").alias("count"))
    sizes = group_sizes(df, by)
    return stats.join(sizes, by)


def group_sizes(df: DataFrame, by: str) -> DataFrame:
    """Rows per group and % of all rows (1 digit).

    The groups are counted once; their total is added up from the counts, so groups of any number stay dealt out.
    """
    sizes = cut(df.groupBy(by).agg(F.count(F.lit(1)).alias("size")))
    return sizes.select(by, "size", R(F.col("size") * 100.0 / F.lit(_total(sizes)), 1).alias("size_pct"))


def _total(sizes: DataFrame) -> int:
    return sizes.agg(F.sum("size")).first()[0] or 1


def cumulative_shares(df: DataFrame, by: str) -> DataFrame:
    """D23 in order: groups by size (largest first, ties by the group), their share and the share of all up to them (4 digits).

    Running sums are made range by range (see ``running_ranks``), never over all groups in one task.
    """
    sizes = cut(df.groupBy(by).agg(F.count(F.lit(1)).alias("size")))
    total = F.lit(_total(sizes))
    ranked = running_ranks(sizes.withColumn("_down", -F.col("size")), ["_down", by], "size")
    return ranked.select(by, "size", R(F.col("size") * 100.0 / total, 4).alias("size_pct"), R(F.col("_upto") * 100.0 / total, 4).alias("cumulative_pct"))


def group_signature(df: DataFrame, by: str, cols: list[str] | None = None, top: int = 8) -> DataFrame:
    """The ``top`` features with the highest mean within each group."""
    cols = cols or [c for c in numeric_columns(df) if c != by]
    means = to_long(df, cols, keys=[by]).groupBy(by, "feature").agg(R(F.avg("value"), 6).alias("mean"))
    w = Window.partitionBy(by).orderBy(F.desc("mean"), F.asc("feature"))
    return means.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def distinct_labels(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct labels."""
    return df.select(col).distinct().orderBy(col)


def numeric_projection(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Numeric columns only (booleans are not numeric), plus ``keep`` keys."""
    keep = [c for c in (keep or []) if c in df.columns]
    return df.select(*keep, *[c for c in numeric_columns(df) if c not in keep])


def columns_matching(df: DataFrame, patterns: tuple[str, ...] = ("mean", "size", "pct")) -> DataFrame:
    """Columns whose name contains one of the patterns."""
    return df.select(*[c for c in df.columns if any(p in c for p in patterns)])

