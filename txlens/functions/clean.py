"""Cleaning predicates and imputers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlens.functions.scalar import finite_or_null, weekday_monday0
from txlens.operators.quantiles import grouped_quantiles
from txlens.operators.joins import broadcast_rows, keyed_join, measured
from txlens.sources.schema import CATEGORICAL_COLUMNS, numeric_columns

# Label used for rare categories and the rarity threshold.
OTHER = "Other"
RARE_MIN_COUNT = 10
UNKNOWN = "Unknown"


def coerce_timestamp(df: DataFrame, col: str = "transaction_date") -> DataFrame:
    """B1: strings -> timestamp, unparsable -> null; timestamp_ntz -> timestamp."""
    if col not in df.columns:
        return df
    dt = df.schema[col].dataType
    if isinstance(dt, T.StringType):
        return df.withColumn(col, F.try_to_timestamp(F.col(col)))
    if isinstance(dt, (T.TimestampNTZType, T.DateType)):
        return df.withColumn(col, F.col(col).cast("timestamp"))
    return df


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN and +-Inf -> null for floating columns (done once at ingestion)."""
    cols = cols if cols is not None else [f.name for f in df.schema.fields
                                          if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite_or_null(c) for c in cols}) if cols else df


def fill_zero(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """B7 ``handle_missing_values('zero')``: numeric null / NaN -> 0."""
    cols = cols if cols is not None else numeric_columns(df)
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)).cast(df.schema[c].dataType),
                                         F.lit(0).cast(df.schema[c].dataType)) for c in cols}) if cols else df


def fill_mean(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Numeric null -> column mean (one-row aggregate, broadcast cross join)."""
    cols = cols if cols is not None else numeric_columns(df)
    if not cols:
        return df
    means = df.agg(*[F.avg(finite_or_null(F.col(c).cast("double"))).alias(f"_m_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(means))  # one row
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")) for c in cols}) \
              .drop(*[f"_m_{c}" for c in cols])


def column_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact medians of several columns as a one-row DataFrame ``_med_<col>``.

    The columns are unpivoted to (feature, value) so a single distributed
    sort serves every column.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), finite_or_null(F.col(c).cast("double")).alias("value"))
        for c in cols])).alias("kv")).select("kv.feature", "kv.value")
    med = grouped_quantiles(long, ["feature"], "value", [0.5], names=["median"])
    return med.groupBy().pivot("feature", cols).agg(F.first("median")) \
              .select(*[F.col(c).alias(f"_med_{c}") for c in cols])


def fill_median(df: DataFrame, cols: list[str] | None = None, check_missing: bool = False) -> DataFrame:
    """Numeric null (and +-Inf, B11) -> exact column median.

    ``check_missing`` first counts the missing values of each column (one
    aggregate) and sorts only the columns that have any.
    """
    cols = cols if cols is not None else numeric_columns(df)
    if cols and check_missing:
        row = df.agg(F.count(F.lit(1)).alias("_n"),
                     *[F.count(finite_or_null(F.col(c).cast("double"))).alias(c) for c in cols]).collect()[0]
        cols = [c for c in cols if row[c] < row["_n"]]
    if not cols:
        return df
    meds = column_medians(df, cols)
    out = df.crossJoin(F.broadcast(meds))  # one row
    return out.withColumns({c: F.coalesce(finite_or_null(F.col(c).cast("double")), F.col(f"_med_{c}"))
                            for c in cols}).drop(*[f"_med_{c}" for c in cols])


def drop_null_rows(df: DataFrame) -> DataFrame:
    """B6 ``strategy='drop'``: rows with any null (or NaN) value are removed."""
    dbl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    out = df.na.drop("any")
    if dbl:
        any_nan = F.isnan(dbl[0])
        for c in dbl[1:]:
            any_nan = any_nan | F.isnan(c)
        out = out.where(~any_nan)
    return out


def handle_missing_values(df: DataFrame, strategy: str = "zero") -> DataFrame:
    """B6-B10."""
    if strategy == "zero":
        return fill_zero(df)
    if strategy == "mean":
        return fill_mean(df)
    if strategy == "median":
        return fill_median(df)
    if strategy == "drop":
        return drop_null_rows(df)
    raise ValueError(f"unknown strategy: {strategy}")


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Columns without a single non-null (or non-NaN) value are dropped (one aggregate)."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    counts = df.agg(*[F.count(F.nanvl(F.col(c), F.lit(None)) if c in floats else F.col(c)).alias(c)
                      for c in df.columns]).collect()[0]
    return df.drop(*[c for c in df.columns if counts[c] == 0])


def group_rare_categories(df: DataFrame, cols: list[str] | None = None,
                          min_count: int = RARE_MIN_COUNT, label: str = OTHER) -> DataFrame:
    """Values seen fewer than ``min_count`` times -> ``label``; nulls kept.

    One aggregate counts every (column, value) pair of all columns at once
    (map-side combined) and is materialised. While that measured table is small, only the
    rare values are joined back (broadcast), to the columns that have any; otherwise each column's
    value counts are, with :func:`keyed_join` (hot values salted).
    """
    return _grouped(df, cols, min_count, label)[0]


def _grouped(df: DataFrame, cols: list[str] | None, min_count: int, label: str) -> tuple[DataFrame, bool]:
    """The rows of :func:`group_rare_categories`, and whether they move by their values for it."""
    cols = [c for c in (cols if cols is not None else CATEGORICAL_COLUMNS) if c in df.columns]
    if not cols:
        return df, False
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val")) for c in cols])).alias("kv")) \
        .select("kv.col", "kv.val").where(F.col("val").isNotNull())
    counts, n_values = measured(long.groupBy("col", "val").agg(F.count(F.lit(1)).alias("n")))
    out, few = df, n_values <= broadcast_rows(df.sparkSession)
    rare = {r["col"] for r in counts.where(F.col("n") < min_count).select("col").distinct().collect()} if few else set(cols)
    for c in cols:
        if c not in rare and isinstance(df.schema[c].dataType, T.StringType):
            continue
        per_value = counts.where((F.col("col") == c) & ((F.col("n") < min_count) | F.lit(not few))) \
                          .select(F.col("val").alias(c), F.col("n").alias(f"_n_{c}"))
        weights = per_value.select(c, F.col(f"_n_{c}").alias("n"))
        out = keyed_join(out, per_value, [c], "left", weights=weights, small_rows=n_values)
        out = out.withColumn(c, F.when(F.col(c).isNull(), F.col(c))
                             .when(F.col(f"_n_{c}") < min_count, F.lit(label)).otherwise(F.col(c))) \
                 .drop(f"_n_{c}")
    return out.select(*df.columns), not few


def preprocess_transactions(df: DataFrame, min_count: int = RARE_MIN_COUNT) -> DataFrame:
    """Parse dates, add date parts, zero-fill numerics, group rare categories.

    Mirrors the reference's order: date parts are added *before* the zero
    fill, so a null date gives 0 parts.
    """
    return preprocess_steps(df, min_count)[0]


def preprocess_steps(df: DataFrame, min_count: int = RARE_MIN_COUNT) -> tuple[DataFrame, bool]:
    """B14, and whether its rows move for the rare categories (else it is a projection with small lookups)."""
    out = coerce_timestamp(df)
    out = nan_to_null(out)
    if "transaction_date" in out.columns:
        ts = F.col("transaction_date")
        out = out.withColumns({
            "transaction_hour": F.hour(ts),
            "transaction_day": F.dayofmonth(ts),
            "transaction_month": F.month(ts),
            "transaction_dayofweek": weekday_monday0(ts),
        })
    return _grouped(fill_zero(out), None, min_count, OTHER)
