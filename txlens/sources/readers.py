"""Scans: CSV / Parquet readers for raw transactions and driver tables (A1-A3)."""

from __future__ import annotations

import csv
import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from txlens.sources.schema import EXPECTED_COLUMNS, TX_SCHEMA, validate_dataframe

log = logging.getLogger(__name__)


def _files(spark: SparkSession, path: str):
    """Files that a path, a folder or a pattern names, hidden ones left out."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(path)
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(pattern) or []:
        inner = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        for f in inner:
            if f.isFile() and not f.getPath().getName().startswith(("_", ".")):
                yield fs, f.getPath()


def _header(spark: SparkSession, fs, path) -> tuple[str, ...]:
    """Column names of one file: its first line, read as a CSV record."""
    jvm = spark.sparkContext._jvm
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(path), "UTF-8"))
    try:
        line = lines.readLine()
    finally:
        lines.close()
    return tuple(next(csv.reader([line.lstrip("\ufeff")]))) if line else ()


def load_csv_file(spark: SparkSession, path: str, infer: bool = False,
                  validate: str = "warn", multi_line: bool = False) -> DataFrame:
    """A1: CSV scan with header; ``path`` is a file, a folder or a pattern.

    Quotes are RFC 4180 (a doubled quote inside a quoted field). Files may order
    their columns differently: they are grouped by their header line (one short
    read per file), each group is read with its own schema and the groups are
    joined by name. ``TX_SCHEMA`` gives the types of the columns it knows, others
    are strings; ``infer=True`` infers them instead. ``multi_line`` allows line
    breaks inside quoted fields, at the price that a file is not split. Missing
    expected columns only log a warning, as in the reference loader.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"') \
        .option("multiLine", multi_line)
    if infer:
        df = reader.option("inferSchema", True).csv(path)
    else:
        groups: dict[tuple[str, ...], list[str]] = {}
        for fs, p in _files(spark, path):
            if header := _header(spark, fs, p):
                groups.setdefault(header, []).append(p.toString())
        if not groups:
            raise FileNotFoundError(f"no CSV file with a header at {path}")
        known = {f.name: f for f in TX_SCHEMA.fields}
        parts = [reader.schema(T.StructType([known.get(c, T.StructField(c, T.StringType(), True)) for c in header]))
                 .csv(files) for header, files in sorted(groups.items())]
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    validate_dataframe(df, EXPECTED_COLUMNS, mode=validate)
    return df


def load_uploaded_file(spark: SparkSession, staged_path: str, **kw) -> DataFrame:
    """A2: an uploaded file is staged to shared storage first, then scanned like A1."""
    return load_csv_file(spark, staged_path, **kw)


def load_raw_transactions(spark: SparkSession, raw_dir: str, **kw) -> DataFrame:
    """A3: every ``*.csv`` under ``raw_dir`` as one table; error when there is none."""
    if not any(True for _ in _files(spark, raw_dir.rstrip("/") + "/*.csv")):
        raise FileNotFoundError(f"no CSV file in {raw_dir}")
    return load_csv_file(spark, raw_dir.rstrip("/") + "/*.csv", **kw)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table scan (Parquet; pushdown and pruning by Catalyst)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
