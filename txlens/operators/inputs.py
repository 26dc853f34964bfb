"""Fitted model inputs: what turns any feature table into the standardised columns a model was trained on.

Fitting keeps, per column, how it becomes a number, the median that fills its gaps, its mean
and its population standard deviation; a string column without any number keeps its table of
values and codes. All of it but that table has one row per column. Applying it is one
projection (and one keyed join per coded column), so new rows - a table or a stream without
coded columns - get exactly the values that the training rows got.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.functions.clean import column_medians
from txlens.functions.scalar import finite_or_null
from txlens.operators.cache import cut
from txlens.operators.encode import ordinal_code_tables
from txlens.operators.joins import keyed_join, measured
from txlens.sources.schema import is_numeric_type

NUMBER, TEXT, CODE = "number", "text", "code"
_COLUMNS = "idx int, name string, kind string, median double, mean double, std double"
_CODES = "column string, value string, n long, code double"


@dataclass
class FittedInputs:
    """Columns of a feature table prepared for a model (M3-M5) and standardised (M1)."""
    names: list[str]
    kinds: dict[str, str]
    medians: dict[str, float]        # complete for saved inputs, see ``complete``
    means: dict[str, float]
    stds: dict[str, float]
    n_rows: int
    codes: DataFrame | None = None   # column, value, n, code
    training: DataFrame | None = field(default=None, repr=False)

    @classmethod
    def fit(cls, df: DataFrame, keys: list[str], text: bool = False, min_variance: float = 0.0, least: int = 1) -> "FittedInputs":
        """Fit on ``df``. ``text`` turns string columns into numbers (those without any into ordinal codes), else they are left out.

        Columns without a finite value are dropped, and so are columns whose sample variance is below ``min_variance``.
        Raises ValueError if fewer than ``least`` columns remain.
        """
        kinds = {f.name: NUMBER if is_numeric_type(f.dataType) else TEXT for f in df.schema.fields if f.name not in keys}
        if not text:
            kinds = {c: k for c, k in kinds.items() if k == NUMBER}
        strings = [c for c, k in kinds.items() if k == TEXT]
        codes = None
        if strings:
            found = df.agg(*[F.count(_number(F.col(c), TEXT)).alias(c) for c in strings]).first()
            coded = [c for c in strings if not found[c]]
            kinds |= dict.fromkeys(coded, CODE)
            if coded:
                order = keys[0] if keys else coded[0]
                tables = ordinal_code_tables(df, coded, order)
                codes = cut(tables.select(F.col("col").alias("column"), F.col("val").alias("value"), "n", "code"))
        out = cls(list(kinds), kinds, {}, {}, {}, 0, codes, df)
        raw = out._numbers(df, list(keys))

        def moments(frame, cols):
            return frame.agg(F.count(F.lit(1)).alias("_rows"), *[a for c in cols for a in (
                F.count(c).alias(f"n_{c}"), F.var_samp(c).alias(f"v_{c}"), F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
        row = moments(raw, out.names)
        out.n_rows = row["_rows"]
        kept = [c for c in out.names if row[f"n_{c}"] > 0 and (not min_variance or (row[f"v_{c}"] or 0.0) >= min_variance)]
        if len(kept) < least:
            raise ValueError(f"not enough usable columns ({len(kept)} of {least})")
        gaps = [c for c in kept if row[f"n_{c}"] < out.n_rows]
        out.names, out.kinds = kept, {c: kinds[c] for c in kept}
        if gaps:
            med = column_medians(raw, gaps).first()
            out.medians = {c: med[f"_med_{c}"] for c in gaps}
        filled = moments(raw.select(*[F.coalesce(F.col(c), F.lit(out.medians[c])).alias(c) for c in gaps]), gaps) if gaps else {}
        for c in kept:
            of = filled if c in gaps else row
            out.means[c], out.stds[c] = of[f"m_{c}"], of[f"s_{c}"]
        return out

    def _numbers(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """``keys`` and the columns as finite doubles or null; a value without a code is -1."""
        missing = [c for c in self.names if c not in df.columns]
        if missing:
            raise ValueError(f"columns missing: {', '.join(missing)}")
        out = df.select(*keys, *self.names)
        coded = [c for c in self.names if self.kinds[c] == CODE]
        if coded:
            codes, n = measured(self.codes)
            for i, c in enumerate(coded):
                table = codes.where(F.col("column") == c)
                small = table.select(F.col("value").alias(f"_v{i}"), F.col("code").alias(f"_c{i}"))
                out = out.withColumn(f"_v{i}", F.col(c).cast("string"))
                out = keyed_join(out, small, [f"_v{i}"], "left", weights=table.select(F.col("value").alias(f"_v{i}"), "n"), small_rows=n)
        place = {c: i for i, c in enumerate(coded)}
        return out.select(*keys, *[F.coalesce(F.col(f"_c{place[c]}"), F.lit(-1.0)).alias(c) if c in place
                                   else _number(F.col(c), self.kinds[c]).alias(c) for c in self.names])

    def clean(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """``keys`` and the columns as doubles, gaps filled with the medians of the training rows."""
        rows = self._numbers(df, keys)
        return rows.select(*keys, *[F.coalesce(F.col(c), F.lit(self.medians[c])).alias(c) if self.medians.get(c) is not None else F.col(c)
                                    for c in self.names])

    def scaled(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """``keys`` and the standardised columns; a column that was constant scales by 1."""
        rows = self.clean(df, keys)
        return rows.select(*keys, *[((F.col(c) - F.lit(float(self.means[c]))) / F.lit(float(self.stds[c] or 1.0))).alias(c) for c in self.names])

    def complete(self) -> "FittedInputs":
        """Medians of the columns without gaps too, as new rows may have gaps there."""
        todo = [c for c in self.names if c not in self.medians]
        if todo and self.training is not None:
            med = column_medians(self._numbers(self.training, []), todo).first()
            self.medians |= {c: med[f"_med_{c}"] for c in todo}
        return self

    def save(self, spark: SparkSession, path: str) -> None:
        """Columns and codes as Parquet."""
        self.complete()
        rows = [(i, c, self.kinds[c], self.medians.get(c), self.means[c], self.stds[c]) for i, c in enumerate(self.names)]
        spark.createDataFrame(rows, _COLUMNS).withColumn("n_rows", F.lit(self.n_rows).cast("long")).coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/columns")
        codes = self.codes if self.codes is not None else spark.createDataFrame([], _CODES)
        codes.write.mode("overwrite").parquet(f"{path}/codes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FittedInputs":
        rows = sorted(spark.read.parquet(f"{path}/columns").collect(), key=lambda r: r["idx"])
        names = [r["name"] for r in rows]
        kinds = {r["name"]: r["kind"] for r in rows}
        get = lambda f: {r["name"]: r[f] for r in rows}
        codes = spark.read.schema(_CODES).parquet(f"{path}/codes") if CODE in kinds.values() else None
        return cls(names, kinds, get("median"), get("mean"), get("std"), rows[0]["n_rows"] if rows else 0, codes)


def _number(c, kind: str):
    return finite_or_null(c.cast("string").try_cast("double") if kind == TEXT else c.cast("double"))
