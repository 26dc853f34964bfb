"""Reuse of intermediate tables and column comments."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)  # folders that a running cut_of() deletes


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach feature descriptions as column metadata in one projection."""
    return df.select(*[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c)
                       for c in df.columns])


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Shuffle files of the queries run inside are deleted when each ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage like a reliable checkpoint, but in one job, in columns (later
    readers take the ones they need) and without a cached copy.
    """
    from txlens.session import checkpoint_dir

    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/txlens-stage-{uuid.uuid4().hex}"
    with _shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    if (inside := _staged.get()) is not None:
        inside.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_of(build: Callable[[], DataFrame]) -> DataFrame:
    """``cut(build())``; the tables that ``build`` staged on the way are deleted once the result is written.

    Nothing that ``build`` leaves behind but its result may read them.
    """
    inside: list[str] = []
    token = _staged.set(inside)
    try:
        df = build()
    finally:
        _staged.reset(token)
    out = cut(df)
    sc = df.sparkSession.sparkContext
    for path in inside:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    return out
