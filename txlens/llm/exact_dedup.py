"""Exact deduplication by progressive refinement (length, prefix hash, full hash).

Each level hashes only rows whose group at the level before has two members or
more. Text never leaves its scan: only lengths, hashes and ids are shuffled, and
every grouping is combined on the map side, so a group of any size costs one row
per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.llm.common import fits_broadcast, may_match, stage

PREFIX_CHARS = 256
FILTER_BITS = 1 << 26  # of the bitmap of surviving keys: 8 MB


def refine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           prefix_chars: int = PREFIX_CHARS, hash_all: bool = False) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, full_hash``.

    Equal texts (null counts as empty) form a group; the largest id stays. Rows
    with the same id and text are repeated rows: they count in ``group_size``
    and one of them is kept. Null ids sort below all others. ``full_hash`` is the
    SHA-256 of the UTF-8 text, null where no full hash was needed, unless
    ``hash_all`` asks for the digest of every row (the groups still come from the
    refined rows alone). Other columns are ignored; an empty table gives none.
    """
    groups, hashed, _ = _groups(_rows(docs, id_col, text_col), prefix_chars, hash_all)
    out = _attach(hashed, groups)
    kept = F.col("_id").eqNullSafe(F.col("_keep"))
    if not groups.where("_n_top > 1").isEmpty():
        # Rows repeated with the id that stays: number them, and the first one stays.
        out = stage(out.withColumn("_copy", F.when(kept & (F.col("_n_top") > 1), F.monotonically_increasing_id())), "dedup-rows")
        first = out.where("_copy is not null").groupBy("_hash").agg(F.min("_copy").alias("_first"))
        out = out.join(first, "_hash", "left")
        kept = kept & (F.col("_copy").isNull() | (F.col("_copy") == F.col("_first")))
    return out.select(F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"),
                      F.col("_size").alias("group_size"), kept.alias("kept"), F.col("_full").alias("full_hash"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """``docs`` with one row per distinct text: its row with the largest id (see ``refine``)."""
    columns = docs.columns
    groups, _, heads = _groups(_rows(docs, id_col, text_col), prefix_chars, False)
    keys = groups.select(F.col("_hash").alias("__hash"), F.col("_keep").alias("__keep"), F.col("_n_top").alias("__n_top"))
    # Full contents are read for rows whose length and prefix survive, as for the groups.
    row = F.struct(*[docs[c] for c in columns]).alias("__row")
    rows = docs.select(row, docs[id_col].alias("__id"), F.coalesce(docs[text_col], F.lit("")).alias("_text"))
    rows = rows.select("*", F.octet_length("_text").alias("_len"), _prefix(prefix_chars).alias("_prefix"))
    rows = _marked(rows, heads, ["_len", "_prefix"], 32, {"_sha": F.sha2("_text", 256)})
    # The others get keys of their own, which match nothing and spread them.
    rows = rows.select("__row", "__id", F.when(F.col("_in"), F.col("_sha")).otherwise(F.hex(F.xxhash64("_len", "_prefix", "__id"))).alias("__hash"))
    rows = rows.join(F.broadcast(keys) if fits_broadcast(keys, 96) else keys, "__hash", "left")
    rows = rows.where("__n_top is null or __id <=> __keep")
    twice = rows.where("__n_top > 1").dropDuplicates(["__hash"])
    return rows.where("__n_top is null or __n_top = 1").unionByName(twice).select("__row.*")


def _prefix(chars: int) -> Column:
    return F.xxhash64(F.left("_text", F.lit(chars)))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))


def _groups(rows: DataFrame, prefix_chars: int, hash_all: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Groups of two or more (``_hash, _keep, _size, _n_top``), every row with its hash, and the surviving lengths and prefixes."""
    length = F.octet_length("_text").alias("_len")
    lengths = stage(rows.select(length).groupBy("_len").count().where("count > 1").select("_len"), "dedup-len")
    prefix = _prefix(prefix_chars)
    heads = _marked(rows.select("*", length), lengths, ["_len"], 16, {"_prefix": prefix}).where("_in")
    heads = stage(heads.groupBy("_len", "_prefix").count().where("count > 1").select("_len", "_prefix"), "dedup-prefix")
    full = F.sha2("_text", 256)
    hashed = _marked(rows.select("*", length, prefix.alias("_prefix")), heads, ["_len", "_prefix"], 32, {"_sha": full}, hash_all)
    hashed = stage(hashed.select("_id", F.when(F.col("_in"), F.col("_sha")).alias("_hash"),
                                 F.col("_sha").alias("_full") if hash_all
                                 else F.when(F.col("_in"), F.col("_sha")).alias("_full")), "dedup-hash")
    groups = (hashed.where("_hash is not null").groupBy("_hash", "_id").agg(F.count(F.lit(1)).alias("_n"))
              .groupBy("_hash").agg(F.max(F.struct("_id", "_n")).alias("_top"), F.sum("_n").alias("_size"))
              .where("_size > 1")
              .select("_hash", F.col("_top._id").alias("_keep"), "_size", F.col("_top._n").alias("_n_top")))
    return stage(groups, "dedup-groups"), hashed, heads


def _marked(rows: DataFrame, keys: DataFrame, on: list[str], row_bytes: int, then: dict[str, Column], always: bool = False) -> DataFrame:
    """``rows`` with ``_in`` (its key survives) and the columns ``then`` of the text, null where it does not (unless ``always``).

    With a key table small enough to broadcast, it tells which texts to read. Beyond, a bitmap of
    ``FILTER_BITS`` bits does, one bit per hashed key: of fixed size however many keys survive. It lets a few
    others through, which the exact join by shuffle, without texts, then turns away.
    """
    kept = [c for c in rows.columns if c != "_text"]
    marks = keys.withColumn("_in", F.lit(True))
    if fits_broadcast(keys, row_bytes):
        out = rows.join(F.broadcast(marks), on, "left").withColumn("_in", F.coalesce("_in", F.lit(False)))
        return out.select(*kept, "_in", *_read(then, always, "_in"))
    out = may_match(rows, keys, on, FILTER_BITS).select(*kept, *_read(then, always, "_may"))
    return out.join(marks, on, "left").withColumn("_in", F.coalesce("_in", F.lit(False)))


def _read(then: dict[str, Column], always: bool, where: str) -> list[Column]:
    return [(c if always else F.when(F.col(where), c)).alias(name) for name, c in then.items()]


def _attach(hashed: DataFrame, groups: DataFrame) -> DataFrame:
    """Every row with its group; a row of no group is its own."""
    # Rows without a hash get keys of their own, which match nothing and spread them.
    rows = hashed.withColumn("_key", F.coalesce("_hash", F.hex(F.xxhash64("_id", "_full"))))
    keyed = groups.withColumnRenamed("_hash", "_key")
    joined = rows.join(F.broadcast(keyed) if fits_broadcast(groups, 96) else keyed, "_key", "left").drop("_key")
    return joined.select("_id", "_hash", "_full", F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep")).alias("_keep"),
                         F.coalesce("_size", F.lit(1)).alias("_size"), F.coalesce("_n_top", F.lit(1)).alias("_n_top"))
