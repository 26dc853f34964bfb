"""Spark session defaults and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Sizes used by the size checks before a broadcast. A side is broadcast only
# when its row count was measured and is at most this many rows.
BROADCAST_MAX_ROWS = 200_000


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "txlens") -> SparkSession:
    """Return the active session or build a local one with sane defaults.

    On a cluster the session already exists (spark-submit); this only fills in
    settings that are unset. Local runs keep the UI off and use UTC.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, registered once per context.

    A folder already registered is left as it is; else the cluster's
    ``spark.checkpoint.dir`` is registered. Where neither is set, a private
    scratch folder serves a local master; on a cluster that is an error, since
    executors would not see it.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current is None:
        if not configured and not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = configured or tempfile.mkdtemp(prefix="txlens-ckpt-")
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    return configured or current


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``txlens`` importable on the executors' Python workers (once per context).

    The package is zipped and added with ``addPyFile``, which Spark serves to
    every executor (what ``--py-files`` does at submit time). Needed only by
    the operators that run Python on executors (forest growing / scoring, SHAP).
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    dest = os.path.join(tempfile.mkdtemp(prefix="txlens-pyfiles-"), "txlens.zip")
    with zipfile.ZipFile(dest, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(dest)
    _SHIPPED.add(key)
