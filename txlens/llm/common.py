"""Helpers shared by the training-data operators: shared staging, measured lookups, global order."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txlens.session import checkpoint_dir

BROADCAST_BYTES = 8 << 20  # a lookup side is broadcast up to this measured size
BATCH_BYTES = 4 << 20      # of texts in one Arrow batch, where a task holds much besides


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """Inside, Arrow batches of texts sent to Python end at so many bytes (by default Spark sends up to 64 MB at once,
    which a task holds several times over). The session's own setting returns afterwards."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts lineage, computes the rows once and survives lost executors; the files
    live in the cluster's checkpoint folder and are removed with it.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(staged: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a staged table, by its counted rows, may be broadcast."""
    return staged.count() * row_bytes <= limit


def lookup(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str, row_bytes: int) -> DataFrame:
    """Join ``big`` to a staged table with one row per key.

    The table is broadcast when its measured size allows; otherwise both sides
    shuffle on the keys and adaptive execution splits hot partitions of ``big``.
    """
    return big.join(F.broadcast(small) if fits_broadcast(small, row_bytes) else small, list(keys), how)


def may_match(rows: DataFrame, keys: DataFrame, on: Sequence[str], bits: int) -> DataFrame:
    """``rows`` with ``_may``: false only where the key is surely not among ``keys``.

    A bitmap of ``bits`` bits, one bit per hashed key, is broadcast: of fixed size however many keys there are.
    It lets a few others through, which an exact join then turns away.
    """
    kept = rows.columns
    slot = (F.pmod(F.xxhash64(*on), F.lit(bits)) + 1).alias("_slot")
    marks = keys.select(slot).groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    out = rows.withColumn("_slot", slot).withColumn("_bucket", F.bitmap_bucket_number("_slot")).join(F.broadcast(marks), "_bucket", "left")
    at = F.bitmap_bit_position("_slot")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    may = F.coalesce(F.floor(byte / F.pow(F.lit(2), at % 8)).cast("int") % 2 == 1, F.lit(False))
    return out.select(*kept, may.alias("_may"))


def with_rank(df: DataFrame, order: Sequence, label: str) -> DataFrame:
    """``df`` (narrow) staged with ``_rank``: its place from 0 in the global order.

    Rows are dealt by range, sorted inside each range and numbered there; the
    sizes of the ranges (one row each) shift the numbers. Ties are broken by the
    columns of the whole row, so equal rows alone share an undefined order.
    """
    keys = [*order, *[F.col(c).asc_nulls_first() for c in df.columns]]
    placed = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn("_mono", F.monotonically_increasing_id()))
    placed = stage(placed.select("*", F.shiftright("_mono", 33).alias("_range"),
                                 F.col("_mono").bitwiseAND((1 << 33) - 1).alias("_place")).drop("_mono"), label)
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    ahead = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_ahead"))
    return (placed.join(F.broadcast(ahead), "_range")
            .withColumn("_rank", F.col("_ahead") + F.col("_place")).drop("_range", "_place", "_ahead"))
