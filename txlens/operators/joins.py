"""Keyed joins of a large fact side to a per-key table, safe under skew.

Used wherever the reference attaches per-key results back to transactions
(C1/C2 per-user statistics, B13 rare-category grouping, E2 ordinal codes).

* The per-key side is materialised once and counted (:func:`measured`); a
  table of at most ``BROADCAST_MAX_ROWS`` rows is broadcast - a size proven
  on the data, not estimated.
* Above that, the join is a shuffle join (hashing the per-key side where its measured rows
  are few per partition, so that the fact rows are not sorted) whose *hot* keys are salted: a key is hot when
  it carries more fact rows than one shuffle partition should hold
  (``total / partitions``). Fewer keys than partitions can be hot, so the
  hot-key list is a proven-small broadcast. Hot fact rows are spread over
  ``ceil(n * partitions / total)`` salts and the per-key row is replicated
  once per salt. AQE skew-join splitting stays on as a backstop.

Apart from the size measurement the plan is lazy.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlens.operators.cache import cut
from txlens.session import BROADCAST_MAX_ROWS


def hot_keys(weights: DataFrame, keys: list[str], weight_col: str = "n",
             partitions: int | None = None) -> DataFrame:
    """Keys holding more than 1/partitions of all rows, with their salt count."""
    parts = partitions or int(weights.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = weights.agg(F.sum(weight_col).alias("_tot"))
    return (weights.crossJoin(F.broadcast(total))
            .where(F.col(weight_col) * F.lit(parts) > F.col("_tot"))
            .select(*keys, F.ceil(F.col(weight_col) * F.lit(parts) / F.col("_tot"))
                    .cast("int").alias("_salts")))


# Rows of a per-key table that one task may hash.
HASH_MAX_ROWS = 500_000


def heavy_keys(df: DataFrame, key: str) -> list:
    """Keys holding more than 1/partitions of the rows (fewer than partitions), counted through hash buckets: only keys of
    full buckets are counted themselves."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64(key), F.lit(16 * parts))
    sizes = list(map(tuple, df.groupBy(bucket.alias("b")).count().collect()))
    total = sum(c for _, c in sizes)
    full = [b for b, c in sizes if c * parts > total]
    if not full:
        return []
    counts = df.where(bucket.isin(full)).groupBy(key).count().where(F.col("count") * parts > total)
    return [r[0] for r in counts.collect() if r[0] is not None]


def per_key(df: DataFrame, key: str, build: Callable[[DataFrame], DataFrame], heavy: list) -> DataFrame:
    """``build`` (aggregates per ``key``, not null) over rows that are dealt by key once.

    Where a task sees few rows of a key, partial aggregates are wider than the rows: so each row moves once, as it is. Rows of
    the ``heavy`` keys stay where they are and are aggregated before they move.
    """
    if not heavy:
        return build(df.repartition(F.col(key)))
    hot = F.col(key).isin(heavy)
    return build(df.where(~hot).repartition(F.col(key))).unionByName(build(df.where(hot)))


def broadcast_rows(spark: SparkSession, default: int = BROADCAST_MAX_ROWS) -> int:
    """Largest measured table that is broadcast (session conf ``spark.txlens.broadcastMaxRows`` overrides ``default``)."""
    limit = spark.conf.get("spark.txlens.broadcastMaxRows", None)
    return int(limit) if limit is not None else default


def measured(small: DataFrame) -> tuple[DataFrame, int]:
    """Materialise a per-key table once (reliable checkpoint) and count its rows.

    The count is the size proof used by :func:`keyed_join`; reading the
    checkpoint again costs nothing upstream.
    """
    small = cut(small)
    return small, small.count()


def keyed_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left",
               weights: DataFrame | None = None, weight_col: str = "n",
               partitions: int | None = None, small_rows: int | None = None,
               max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join ``big`` (fact rows) to ``small`` (one row per key) on ``keys``.

    ``small_rows`` is the measured size of ``small`` (see :func:`measured`):
    at most ``max_broadcast_rows`` (session conf ``spark.txlens.broadcastMaxRows``
    overrides it) -> broadcast hash join. Otherwise ``weights``
    (keys + ``weight_col``, fact rows per key) drives the hot-key salting.
    Output columns: ``big``'s, then ``small``'s non-key columns.
    """
    if how not in ("left", "inner"):
        raise ValueError("keyed_join supports left and inner joins")
    out_cols = [*big.columns, *[c for c in small.columns if c not in keys]]
    max_broadcast_rows = broadcast_rows(big.sparkSession, max_broadcast_rows)
    if small_rows is not None and small_rows <= max_broadcast_rows:
        return big.join(F.broadcast(small), keys, how).select(*out_cols)
    if weights is None:
        return big.join(small, keys, how).select(*out_cols)
    hot = F.broadcast(hot_keys(weights, keys, weight_col, partitions))  # < partitions rows
    row_hash = F.xxhash64(*[F.col(c) for c in big.columns])
    # Null keys match nothing; salts of their own keep them from meeting in one task.
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    big_s = (big.join(hot, keys, "left")
             .withColumn("_salt", F.when(no_key, -1 - F.pmod(row_hash, F.lit(100_000)).cast("int"))
                         .when(F.col("_salts").isNull(), F.lit(0))
                         .otherwise(F.pmod(row_hash, F.col("_salts")).cast("int")))
             .drop("_salts"))
    small_s = (small.join(hot, keys, "left")
               .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
               .drop("_salts"))
    parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if small_rows is not None and small_rows <= HASH_MAX_ROWS * parts:
        small_s = small_s.hint("shuffle_hash")
    joined = big_s.join(small_s, keys + ["_salt"], how).drop("_salt")
    return joined.select(*big.columns, *[c for c in small.columns if c not in keys])


# Bits of the bitmap of keys that rows_of() broadcasts, at most: 32 MB.
FILTER_BITS = 1 << 28


def rows_of(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``keys``, which then need not move to a join.

    A bitmap with a bit per hashed key is broadcast, its size bounded however many keys there are; the few
    others that it lets through are turned away by the join.
    """
    bits = min(FILTER_BITS, 1 << (16 * max(1, keys.agg(F.approx_count_distinct(key)).first()[0])).bit_length())
    slot = (F.pmod(F.xxhash64(key), F.lit(bits)) + 1).alias("_slot")
    marks = keys.where(F.col(key).isNotNull()).select(slot).groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")) \
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    at = F.bitmap_bit_position("_slot")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.where(F.col(key).isNotNull()).withColumn("_slot", slot).withColumn("_bucket", F.bitmap_bucket_number("_slot"))
    return found.join(F.broadcast(marks), "_bucket").where(F.floor(byte / F.pow(F.lit(2), at % 8)).cast("int") % 2 == 1).select(*rows.columns)


def join_own(rows: DataFrame, key: str, col: str) -> DataFrame:
    """``rows`` without ``col`` joined to their own (``key``, ``col``): a row whose key no other row has keeps its value where it is.

    Only hashes of keys are counted; rows whose hash occurs more than once meet in a join (all rows, if that
    holds for more hashes than are broadcast).
    """
    rows = rows.where(F.col(key).isNotNull())
    out_cols = [key, *[c for c in rows.columns if c not in (key, col)], col]
    hashes = rows.select(F.xxhash64(key).alias("_h"))
    again, n_again = measured(hashes.repartition("_h").groupBy("_h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_h"))

    def joined(some: DataFrame) -> DataFrame:
        return some.drop(col).join(some.select(key, col), key).select(*out_cols)
    if n_again > broadcast_rows(rows.sparkSession) or isinstance(rows.schema[key].dataType, (T.DoubleType, T.FloatType)):
        return joined(rows)
    if n_again == 0:
        return rows.select(*out_cols)
    hashed = rows.withColumn("_h", F.xxhash64(key))
    alone = hashed.join(F.broadcast(again), "_h", "left_anti").select(*out_cols)
    return alone.unionByName(joined(hashed.join(F.broadcast(again), "_h", "left_semi").drop("_h")))
