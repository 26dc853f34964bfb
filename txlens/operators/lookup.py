"""Single rows out of large result tables (C7): tables laid out by key, so that a lookup reads few row groups.

``write_by_key`` deals a table by ranges of its key and sorts every range, so each Parquet row group covers a short,
separate interval of keys. ``read_keys`` then filters by the wanted keys; the readers compare them with each row group's
smallest and largest key and skip all groups that cannot hold one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_KEYS = 1000          # keys of one lookup: they become part of the plan
ROW_GROUP_BYTES = 8 << 20


def write_by_key(df: DataFrame, path: str, key: str, row_group_bytes: int = ROW_GROUP_BYTES) -> str:
    """Write ``df`` by ranges of ``key``, sorted; null keys come first. A key's rows may be many: a further range
    starts wherever rows differ in their hash, so none has to hold all rows of one key."""
    order = [F.col(key).asc_nulls_first(), F.xxhash64(*df.columns)]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite") \
        .option("parquet.block.size", row_group_bytes).parquet(path)
    return path


def read_keys(spark: SparkSession, path: str, key: str, keys: Sequence) -> DataFrame:
    """The rows of the given keys (at most ``MAX_KEYS``; null is no key)."""
    wanted = sorted({k for k in keys if k is not None})
    if len(wanted) > MAX_KEYS:
        raise ValueError(f"{len(wanted)} keys: join a table of keys instead")
    table = spark.read.parquet(path)
    # One comparison per key, which readers push down; a long list would become one interval over all of them.
    some = F.lit(False)
    for k in wanted:
        some = some | (F.col(key) == F.lit(k))
    return table.where(some)


def look_up(spark: SparkSession, keys: Sequence, source: str, scores: str, attributions: str | None = None,
            key: str = "transaction_id", col: str = "anomaly_score", top: int = 10) -> DataFrame:
    """Source rows of the given keys with score and attributions, highest score first.

    ``source``, ``scores`` and ``attributions`` are paths written by ``write_by_key``. Columns: those of the source row, the
    scores' further columns, ``attributions`` (the ``top`` strongest as an array of feature, value and
    attribution; empty without). Keys without source row or score are left out.
    """
    out = read_keys(spark, source, key, keys).join(read_keys(spark, scores, key, keys), key)
    if attributions is not None:
        found = read_keys(spark, attributions, key, keys).groupBy(key).agg(F.array_sort(F.collect_list(F.struct(
            (-F.col("abs_shap")).alias("order"), "feature", "feature_value", "shap_value"))).alias("a"))  # one entry per feature
        strongest = F.transform(F.slice("a", 1, top), lambda x: F.struct(x["feature"], x["feature_value"], x["shap_value"]))
        out = out.join(found.select(key, strongest.alias("attributions")), key, "left")
    return out.orderBy(F.desc(col), F.asc(key))
