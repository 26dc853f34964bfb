"""Legacy-generation feature builders.

Unlike the current builders they work on the raw table: nulls are skipped by
the aggregates (not zero-filled first) and the categorical columns become
pivot shares / one-hot dummies named after their values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.clean import coerce_timestamp, nan_to_null
from txlens.functions.scalar import is_weekend, ratio_when_positive, round_half_up as R, weekday_monday0
from txlens.operators.cache import cut
from txlens.operators.encode import MAX_DISTINCT_VALUES, one_hot, value_lists
from txlens.sources.schema import has


def _share_table(df: DataFrame, specs: list[tuple[str, str | None]]) -> DataFrame:
    """D19 / D20 for every categorical column in one pass: per user, the share
    of the amount (``amount`` given) or of the rows (crosstab) per value. Null
    values count in neither part; a zero total gives 0.

    The long shares are materialised; the value lists of the wide form (at most
    ``MAX_DISTINCT_VALUES`` columns) are read from them; one pivot builds it.
    """
    shares = cut(value_shares(df, specs))
    keys = shares.select("col", "val").distinct().limit(MAX_DISTINCT_VALUES + 1).collect()
    if len(keys) > MAX_DISTINCT_VALUES:
        raise ValueError(f"more than {MAX_DISTINCT_VALUES} values for a wide table: use the long form, value_shares")
    names = [r["val"] for r in keys]
    if len(set(names)) != len(names):
        raise ValueError("the same value appears in two categorical columns; names would collide")
    # names in each column's sorted order, columns in the order of ``specs``
    order = [v for c, _ in specs for v in sorted(r["val"] for r in keys if r["col"] == c)]
    return shares.groupBy("user_id").pivot("val", order).agg(F.first("share"))


def value_shares(df: DataFrame, specs: list[tuple[str, str | None]]) -> DataFrame:
    """D19 / D20 in long form, (user_id, col, val, share): no bound on the values."""
    parts = [F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val"),
                      (F.col(a).cast("double") if a else F.lit(1.0)).alias("w")) for c, a in specs]
    long = df.select("user_id", F.explode(F.array(*parts)).alias("kv")) \
             .select("user_id", "kv.col", "kv.val", "kv.w").where(F.col("val").isNotNull())
    per_value = long.groupBy("user_id", "col", "val").agg(F.sum("w").alias("w"))
    total = per_value.groupBy("user_id", "col").agg(F.sum(F.coalesce("w", F.lit(0.0))).alias("t"))
    return per_value.join(total, ["user_id", "col"]).select(
        "user_id", "col", "val", F.coalesce(F.try_divide(F.coalesce("w", F.lit(0.0)),
                                                         F.when(F.col("t") == 0, F.lit(None)).otherwise(F.col("t"))),
                                            F.lit(0.0)).alias("share"))


def build_user_features_legacy(df_raw: DataFrame) -> DataFrame:
    """Count / sums / means / sample std (null -> 0), per-transaction averages,
    cashback ratio (only when total > 0), amount share per category, row share
    per payment method / device / location. Absent columns give 0."""
    df = nan_to_null(coerce_timestamp(df_raw)).where(F.col("user_id").isNotNull())
    cnt = F.count("transaction_id") if has(df, "transaction_id") else F.count("user_id")
    zero = F.lit(0.0)

    # sums are exact (decimal) so that the outputs do not depend on the
    # summation order of the partial aggregates
    def dsum(c):
        return F.sum(F.col(c).cast("decimal(38,10)")).cast("double")

    base = df.groupBy("user_id").agg(
        cnt.alias("nb_transactions"),
        dsum("product_amount").alias("total_amount"),
        (dsum("product_amount") / F.count("product_amount")).alias("avg_amount"),
        F.stddev_samp("product_amount").alias("std_amount"),
        (dsum("transaction_fee") if has(df, "transaction_fee") else zero).alias("total_fee"),
        (dsum("cashback") if has(df, "cashback") else zero).alias("total_cashback"),
        (dsum("loyalty_points") if has(df, "loyalty_points") else zero).alias("total_loyalty_points"),
    )
    base = base.select(
        "user_id", "nb_transactions", "total_amount", "avg_amount", "std_amount", "total_fee", "total_cashback",
        "total_loyalty_points",
        (F.col("total_fee") / F.col("nb_transactions")).alias("avg_fee"),
        (F.col("total_cashback") / F.col("nb_transactions")).alias("avg_cashback"),
        (F.col("total_loyalty_points") / F.col("nb_transactions")).alias("avg_loyalty_points"),
        ratio_when_positive("total_cashback", "total_amount").alias("cashback_ratio"))
    specs = [(c, a) for c, a in (("product_category", "product_amount"), ("payment_method", None),
                                 ("device_type", None), ("location", None)) if has(df, c)]
    out = base
    if specs:
        wide = _share_table(df, specs)
        clash = set(wide.columns[1:]) & set(base.columns)
        if clash:
            raise ValueError(f"value names collide with feature names: {sorted(clash)}")
        out = base.join(wide, "user_id", "left")
    num = [c for c in out.columns if c != "user_id"]
    # outputs rounded to 6 digits: float sums depend on the summation order
    return out.select("user_id", *[R(F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), F.lit(0.0)), 6)
                                   .alias(c) for c in num])


def build_transaction_features_legacy(df_raw: DataFrame, values: dict[str, list] | None = None) -> DataFrame:
    """The four amounts, hour / weekday / weekend, and drop-first one-hot
    (``<column>_<value>``, 0/1) of the four categorical columns; nulls -> 0."""
    df = nan_to_null(coerce_timestamp(df_raw))
    keys = [c for c in ("transaction_id", "user_id") if has(df, c)]
    cols = {}
    for c in ("product_amount", "transaction_fee", "cashback", "loyalty_points"):
        if has(df, c):
            cols[c] = F.col(c).cast("double")
    if has(df, "transaction_date"):
        ts = F.col("transaction_date")
        cols["tx_hour"] = F.hour(ts).cast("double")
        cols["tx_dayofweek"] = weekday_monday0(ts).cast("double")
        cols["tx_is_weekend"] = is_weekend(ts).cast("double")
    out = df.select(*keys, *[v.alias(k) for k, v in cols.items()],
                    *[F.col(c) for c in ("product_category", "payment_method", "device_type", "location")
                      if has(df, c)])
    cats = [c for c in ("product_category", "payment_method", "device_type", "location") if has(df, c)]
    lists = value_lists(df, cols=cats) if cats and values is None else values or {}
    for c in cats:
        out = one_hot(out, c, prefix=c, drop_first=True, values=lists[c]).drop(c)
    return out.fillna(0.0, [k for k in cols])
