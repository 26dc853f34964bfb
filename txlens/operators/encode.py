"""Categorical encoders: ordinal first-appearance codes, one-hot, top-N capping."""

from __future__ import annotations

import os

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlens.functions.clean import OTHER
from txlens.operators.cache import cut
from txlens.operators.joins import broadcast_rows, keyed_join, measured
from txlens.operators.profile import distinct_counts
from txlens.operators.quantiles import running_ranks

# Spark's own bound on pivot / one-hot width (spark.sql.pivotMaxValues default).
MAX_DISTINCT_VALUES = 10_000


_PLACE_BYTES = 7  # of a text key, as one number


def _first_keys(df: DataFrame, cols: list[str], order_col: str) -> DataFrame:
    """``col, val, _first, n``: smallest key and rows of every (column, value).

    Spark sorts all rows for the least of texts. So text keys are first compared by a number, the bytes after
    those that all keys begin with; only the rows with the least number of their value are compared as texts.
    """
    def long(*keys, of=df):
        rows = of.select(*keys, F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val")) for c in cols]).alias("kv"))
        rows = rows.select(*[k for k in rows.columns if k != "kv"], F.explode("kv").alias("kv"))
        return rows.select("kv.col", "kv.val", *[k for k in rows.columns if k != "kv"]).where(F.col("val").isNotNull())

    key, n = F.col(order_col), F.count(F.lit(1)).alias("n")
    direct = long(key.alias("_key")).groupBy("col", "val").agg(F.min("_key").alias("_first"), n)
    ends = df.agg(F.min(key.cast("binary")), F.max(key.cast("binary"))).first() if isinstance(df.schema[order_col].dataType, T.StringType) else (None, None)
    if ends[0] is None:
        return direct
    same = len(os.path.commonprefix([bytes(end) for end in ends]))
    digits = F.rpad(F.hex(F.substring(key.cast("binary"), same + 1, _PLACE_BYTES)), 2 * _PLACE_BYTES, "0")
    place = F.conv(digits, 16, 10).cast("long").alias("_place")
    least, n_values = measured(long(place).groupBy("col", "val").agg(F.min("_place").alias("_least"), n))
    if n_values > broadcast_rows(df.sparkSession):  # about as many values as rows: nothing to gain
        return direct
    least_places = least.select(F.col("_least").alias("_place")).distinct()  # of all values: few rows are at one
    some = df.select(*cols, order_col, place).join(F.broadcast(least_places), "_place", "left_semi")
    firsts = long("_place", key.alias("_key"), of=some).join(F.broadcast(least.drop("n")), ["col", "val"]).where(F.col("_place") == F.col("_least"))
    firsts = firsts.groupBy("col", "val").agg(F.min("_key").alias("_first"))
    return least.join(firsts, ["col", "val"], "left").select("col", "val", "_first", "n")


def ordinal_code_tables(df: DataFrame, cols: list[str], order_col: str = "transaction_id") -> DataFrame:
    """E2 ``factorize`` for several columns in one pass.

    Long table (column, value, first order key, rows) -> one distributed sort
    by (column, first key, value) -> code = global rank - the column's first
    rank. Nothing is gathered per column; the result has one row per
    (column, distinct value).
    """
    ranked = running_ranks(_first_keys(df, cols, order_col), ["col", "_first", "val"])
    start = ranked.groupBy("col").agg(F.min("_from").alias("_start"))  # one row per column
    return ranked.join(F.broadcast(start), "col") \
                 .select("col", "val", "n", (F.col("_from") - F.col("_start")).cast("double").alias("code"))


def ordinal_codes(df: DataFrame, cols: list[str] | str, order_col: str = "transaction_id",
                  suffix: str = "_code", base: DataFrame | None = None) -> DataFrame:
    """Add ``<col><suffix>`` = rank of the value's first appearance (from 0); null -> -1.

    "First appearance" needs an order; ``order_col`` (the transaction id) is it.
    Codes are computed from ``base`` (default ``df``) and attached with the
    skew-safe :func:`keyed_join` (one join per column, all from one ranking).
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    base = df if base is None else base
    codes, n_codes = measured(ordinal_code_tables(base, cols, order_col))
    out = df
    for c in cols:
        tbl = codes.where(F.col("col") == c)
        small = tbl.select(F.col("val").alias(c), F.col("code").alias(f"{c}{suffix}"))
        out = keyed_join(out, small, [c], "left", weights=tbl.select(F.col("val").alias(c), "n"),
                         small_rows=n_codes)
        out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), F.lit(-1.0)))
    return out


def top_values(df: DataFrame, col: str, n: int) -> DataFrame:
    """D21 ``value_counts().head(n)``: (value, count), count desc then value asc."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)).limit(n))


def cap_top_n(df: DataFrame, col: str, n: int, other: str = OTHER) -> DataFrame:
    """Values outside the ``n`` most frequent -> ``other``.

    The top-n table has at most ``n`` rows: a bounded broadcast.
    """
    top = top_values(df, col, n).select(F.col(col).alias("_top"))
    joined = df.join(F.broadcast(top), F.col(col) == F.col("_top"), "left")
    return joined.withColumn(col, F.when(F.col("_top").isNull(), F.lit(other)).otherwise(F.col(col))) \
                 .select(*df.columns)


def distinct_values(df: DataFrame, col: str, limit: int = MAX_DISTINCT_VALUES) -> list:
    """Sorted non-null distinct values (a plan-time list), refusing unbounded widths."""
    vals = (df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col)
            .limit(limit + 1).collect())
    if len(vals) > limit:
        raise ValueError(f"{col} has more than {limit} distinct values")
    return [r[0] for r in vals]


def one_hot(df: DataFrame, col: str, prefix: str | None = None, drop_first: bool = True,
            values: list | None = None) -> DataFrame:
    """G21 ``get_dummies``: ``<prefix>_<value>`` 0/1 ints, sorted values, first dropped."""
    prefix = col if prefix is None else prefix
    values = values if values is not None else distinct_values(df, col)
    if drop_first:
        values = values[1:]
    return df.withColumns({f"{prefix}_{v}": (F.col(col) == F.lit(v)).cast("int").alias(f"{prefix}_{v}")
                           for v in values}).fillna(0, [f"{prefix}_{v}" for v in values])


def one_hot_long(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """G21 in sparse form: (keys, column, value, 1) for every non-null value; no bound on the values."""
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(*keys, F.explode(values).alias("kv")).select(*keys, "kv.column", "kv.value", F.lit(1).alias("indicator")) \
             .where(F.col("value").isNotNull())


def value_dictionary(df: DataFrame, cols: list[str], drop_first: bool = True) -> DataFrame:
    """``column, value, n, index`` - the place of every value in one vector over several columns.

    Columns follow in the order given, values in ascending order; ``drop_first`` leaves out each
    column's smallest value (as for dummy variables). A table, so the number of values has no bound.
    """
    place = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    counts = one_hot_long(df, [], cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    counts = cut(counts.withColumn("place", place[F.col("column")]))
    if drop_first:
        least = counts.groupBy("place").agg(F.min("value").alias("_least"))  # one row per column
        counts = counts.join(F.broadcast(least), "place").where(F.col("value") > F.col("_least")).drop("_least")
    return running_ranks(counts, ["place", "value"]).select("column", "value", "n", F.col("_from").cast("int").alias("index"))


def sparse_one_hot(df: DataFrame, keys: list[str], cols: list[str], dictionary: DataFrame) -> DataFrame:
    """G21 without a bound on the values: ``keys`` and ``features``, a sparse ``pyspark.ml`` vector with a 1 per known value.

    ``dictionary`` (see ``value_dictionary``; staged or saved) may stem from other rows: nulls and values it does
    not hold leave no entry. A row's vector has at most one entry per column, however long the vector is.
    """
    codes, n = measured(dictionary)
    size = (codes.agg(F.max("index")).first()[0] or 0) + 1 if n else 0
    sizes = dict(map(tuple, codes.groupBy("column").count().collect()))  # one row per column
    out = df.select(*keys, *[F.col(c).cast("string").alias(f"_v{i}") for i, c in enumerate(cols)])
    for i, c in enumerate(cols):
        table = codes.where(F.col("column") == c)
        out = keyed_join(out, table.select(F.col("value").alias(f"_v{i}"), F.col("index").alias(f"_i{i}")), [f"_v{i}"], "left",
                         weights=table.select(F.col("value").alias(f"_v{i}"), "n"), small_rows=sizes.get(c, 0))
    # The vector's own fields; reading them with its type makes the vector without Python.
    found = F.array_compact(F.array(*[f"_i{i}" for i in range(len(cols))]))
    fields = F.struct(F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), found.alias("indices"), F.transform(found, lambda _: F.lit(1.0)).alias("values")).alias("v"))
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return out.select(*keys, F.from_json(F.to_json(fields), schema)["v"].alias("features"))


def value_lists(df: DataFrame, cols: list[str], limit: int = MAX_DISTINCT_VALUES) -> dict[str, list]:
    """Sorted non-null values of several columns from one pass (plan-time lists of the wide form).

    A wide table cannot have more than ``limit`` columns; for more values use
    ``one_hot_long``.
    """
    rows = one_hot_long(df, [], cols).select("column", "value").distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} distinct values: use the long form, one_hot_long")
    return {c: sorted(r["value"] for r in rows if r["column"] == c) for c in cols}


def encode_categorical_columns(df: DataFrame, max_categories: int = 10,
                               order_col: str = "transaction_id") -> DataFrame:
    """One-hot (drop first) when a string column has <= ``max_categories``
    distinct values, ordinal codes otherwise. One aggregate counts them all, one ranking codes them."""
    cats = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != order_col]
    if not cats:
        return df
    counts = {r["column"]: r["n_distinct"] for r in distinct_counts(df, cats).collect()}  # one row per column
    few = [c for c in cats if counts.get(c, 0) <= max_categories]
    many = [c for c in cats if c not in few]
    out = df
    if few:
        values = value_lists(df, few)
        for c in few:
            out = one_hot(out, c, drop_first=True, values=values[c]).drop(c)
    if many:
        out = ordinal_codes(out, many, order_col=order_col, suffix="_code_tmp", base=df)
        out = out.withColumns({c: F.col(f"{c}_code_tmp").cast("bigint") for c in many}).drop(*[f"{c}_code_tmp" for c in many])
    return out
