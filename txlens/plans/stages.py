"""Resumable stages of a run.

Every stage writes its result below the run's folder and then one manifest row: the stage's
fingerprint, path and number of rows. A fingerprint covers the input's rows, the
stage's parameters and the fingerprints of the stages it reads, so a rerun after a lost
driver reads what is complete and starts at the first stage that is missing, and a
rerun on other data or with other parameters computes anew what depends on them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "stage string, fingerprint string, path string, n_rows long"
T = TypeVar("T")


def table_fingerprint(df: DataFrame) -> str:
    """Hash of a table's schema and rows, whatever their order and partitioning (one aggregate).

    Repeated rows count: the exclusive-or of the row hashes is kept beside their sum and number.
    """
    h = F.xxhash64(*[F.col(c).cast("string") for c in df.columns], F.lit(len(df.columns)))
    row = df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first()
    return _digest(df.schema.jsonValue(), [str(x) for x in row])


def _digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


class StageStore:
    """The stages of one run in one folder."""

    def __init__(self, spark: SparkSession, root: str, source: str):
        self.spark, self.root, self.source = spark, root.rstrip("/"), source
        self.fingerprints: dict[str, str] = {}
        self.computed: list[str] = []    # stages that this run had to compute

    def _done(self, name: str, fingerprint: str) -> bool:
        try:
            row = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/{name}").first()
        except AnalysisException:  # no manifest row: the stage never ended
            return False
        return row is not None and row["fingerprint"] == fingerprint

    def run(self, name: str, write: Callable[[str], int | None], read: Callable[[str], T], after: tuple[str, ...] = (), **params) -> T:
        """The result of a stage: read if complete, else written by ``write(path)`` (which returns its rows) and read.

        ``after`` names the stages whose results it uses.
        """
        fingerprint = _digest(name, self.source, [self.fingerprints[a] for a in after], params)
        self.fingerprints[name] = fingerprint
        path = f"{self.root}/{name}"
        if not self._done(name, fingerprint):
            n = write(path)
            self.spark.createDataFrame([(name, fingerprint, path, n)], MANIFEST).coalesce(1) \
                .write.mode("overwrite").parquet(f"{self.root}/manifest/{name}")
            self.computed.append(name)
        return read(path)

    def table(self, name: str, build: Callable[[], DataFrame], after: tuple[str, ...] = (), **params) -> DataFrame:
        """A stage whose result is a table."""
        def write(path: str) -> int:
            build().write.mode("overwrite").parquet(path)
            return self.spark.read.parquet(path).count()
        return self.run(name, write, self.spark.read.parquet, after, **params)

    def manifest(self) -> DataFrame:
        """One row per stage of this run."""
        return self.spark.read.schema(MANIFEST).parquet(*[f"{self.root}/manifest/{name}" for name in self.fingerprints])
