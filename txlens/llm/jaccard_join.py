"""N-gram Jaccard self-join by parity sketches.

A text's set of shingles is hashed into a bit sketch: every shingle flips one
bit, so the Hamming distance of two sketches never exceeds the symmetric
difference of the sets. A sketch is cut into blocks. Two sets that may be linked differ
by at most D shingles, so at most D blocks differ and of D + 1 + z blocks at
least z + 1 are equal (pigeonhole). Sets are joined on equal blocks within bands
of set size, which fix D. A block's bits are wide (2^64 positions, held as the
exclusive-or of the flipped positions), so equal blocks mean equal shingles; a
second, narrow sketch of about one bit per shingle filters candidates by its Hamming distance, and
exact set intersection verifies the rest.

Hot blocks lose no link. A key is hot if more than ``HOT`` sets hold it. All sets rank hot keys alike, the most
frequent first with the empty blocks before them, and every set leaves its first z: of the z + 1 blocks that two sets
share at least, the last in that order is left by neither. Keys that no set holds in its own band, where pairs with
larger sets meet, bring nothing together. Everywhere candidates are first compared with one pivot per key; pairs already in one component
need no comparison. Of the pairs that follow one side is always outside the key's
largest component, so a family of copies that an outsider joins is never paired with itself, and a pair that shares its key's
predecessor as well is left to that one. Equal sets are one set from the start, represented by their smallest id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlens.llm.common import fits_broadcast, lookup, may_match, small_batches, stage
from txlens.llm.components import components
from txlens.llm.shingles import mix, shingle_set

WORDS = 4
PERCENT = 85       # linked if 100 * intersection >= PERCENT * union
BAND_RATIO = 1.5
HOT = 32
KEY_BROADCAST = 48 << 20
FILTER_BITS = 1 << 28  # of the bitmap of repeated keys, at most: 32 MB


def band_of(n: int) -> int:
    """Number of the size band of a set of ``n`` shingles."""
    b = int(math.log(n) / math.log(BAND_RATIO))
    while band_low(b + 1) <= n:
        b += 1
    while band_low(b) > n:
        b -= 1
    return b


def band_low(b: int) -> int:
    """Smallest set size of a band."""
    return math.ceil(BAND_RATIO ** b)


def most_differing(a: int, b: int, percent: int = PERCENT) -> int:
    """Largest symmetric difference of linked sets of sizes ``a`` and ``b``."""
    return (100 - percent) * (a + b) // (100 + percent)


def blocks_of(band: int, percent: int = PERCENT) -> tuple[int, int, int]:
    """Blocks, spare equal blocks z, and bits of the narrow sketch; pairs meet in the band of the smaller set."""
    high = max(band_low(band + 1) - 1, 1)
    d = most_differing(high, 100 * high // percent, percent)
    z = 2 + d // 10
    return d + 1 + z, z, max(64, 1 << (high - 1).bit_length())


def sketch(shingles: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """For each band that a set takes part in: ``band, empty blocks, z, keys, narrow sketch``."""
    n, out = len(shingles), []
    if not n:
        return out
    place, flip = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), mix(shingles + np.uint64(0x14057B7EF767814F))
    for band in range(band_of(max(1, -(-percent * n // 100))), band_of(n) + 1):
        blocks, z, bits = blocks_of(band, percent)
        block = ((place >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
        order = np.argsort(block, kind="stable")
        at = np.flatnonzero(np.diff(block[order], prepend=np.uint64(blocks)))
        parity = np.bitwise_xor.reduceat(flip[order], at)
        number = block[order][at]
        empty = blocks - len(at)
        if empty > z:  # such a set may share empty blocks alone with a partner
            missing = np.setdiff1d(np.arange(blocks, dtype=np.uint64), number)
            number, parity = np.concatenate([number, missing]), np.concatenate([parity, np.zeros(len(missing), np.uint64)])
        keys = mix(parity ^ mix(number + np.uint64(band << 32)))
        narrow = (np.bincount((flip % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
        out.append((band, empty, z, keys.view(np.int64), np.packbits(narrow, bitorder="little").view(np.int64)))
    return out


_TEXTS = "u long, first boolean, n long, d1 long, d2 long, band int, own boolean, empty int, z int, keys array<long>, bits array<long>"
_SLICE = 256  # texts turned into Python objects at a time


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and texts of a few rows at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, _SLICE):
            part = batch.slice(lo, _SLICE)
            yield part.column("u").to_pylist(), part.column("t").to_pylist()


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int64, copy=False)))


def _texts(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """All that is needed of every text but its set, in one pass: a row per band with its sketch.

    The ``first`` row of a text also counts for its size n and a 128-bit digest of its set; a text
    without shingles has that row alone, without a sketch. The band that n lies in is its ``own``.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _slices(batches):
            rows, keys, bits = [], [], []
            for u, text in zip(ids, texts):
                s = shingle_set(text, width)
                found = sketch(s, percent) if u is not None else []
                d1 = int(np.bitwise_xor.reduce(mix(s ^ np.uint64(1))).view(np.int64)) if len(s) else 0
                d2 = int(mix(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0
                for k, (band, empty, z, key, narrow) in enumerate(found):
                    rows.append((u, k == 0, len(s), d1, d2, band, k == len(found) - 1, empty, z))
                    keys.append(key)
                    bits.append(narrow)
                if not found:
                    rows.append((u, True, len(s), d1, d2, None, None, None, None))
                    keys.append(np.zeros(0, np.int64))
                    bits.append(np.zeros(0, np.int64))
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int32())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([*columns, _lists(keys), _lists(bits)], [c.split()[0] for c in _TEXTS.split(", ")])
    return docs.mapInArrow(build, _TEXTS)


def _full_sets(docs: DataFrame, width: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _slices(batches):
            sets = [shingle_set(t, width).view(np.int64) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), _lists(sets)], ["u", "s"])
    return docs.mapInArrow(build, "u long, s array<long>")


def _hamming(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x)


def _near(met: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Those of the staged candidates ``a, b, band`` whose sizes and narrow sketches allow a link, as pairs ``a, b``."""
    firsts = stage(met.select("a", "band").distinct(), "jaccard-met-firsts")
    few = fits_broadcast(met, 32, KEY_BROADCAST)
    side = lambda c, i: sketches.select(F.col("u").alias(c), "band", F.col("n").alias(f"n{i}"), F.col("bits").alias(f"bits{i}"))
    left = side("a", 1).join(F.broadcast(firsts) if few else firsts, ["a", "band"], "left_semi")
    right = side("b", 2).join(F.broadcast(met) if few else met, ["b", "band"])
    return right.join(left, ["a", "band"]).where(_may_link(percent)).select("a", "b").distinct()


def _may_link(percent: int) -> Column:
    """Whether sets of sizes ``n1, n2`` with narrow sketches ``bits1, bits2`` can be linked."""
    at_most = F.floor((100 - percent) * (F.col("n1") + F.col("n2")) / (100 + percent))
    return (100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")) & (_hamming("bits1", "bits2") <= at_most)


def _verified(pairs: DataFrame, rows: DataFrame, width: int, percent: int, repeated: bool) -> DataFrame:
    """The staged pairs ``a, b`` whose sets are linked, by exact intersection.

    Sets are built of the texts of a pair alone. The pairs are brought to them: each set moves once
    for every pair where it is ``b``, and once where it is ``a`` of any. ``repeated``: ids repeat among the rows.
    """
    firsts = stage(pairs.select("a").distinct(), "jaccard-firsts")
    needed = stage(firsts.select(F.col("a").alias("u")).union(pairs.select("b")).distinct(), "jaccard-needed")
    chosen = rows.join(F.broadcast(needed) if fits_broadcast(needed, 64, KEY_BROADCAST) else needed, "u", "left_semi")
    sets = _full_sets(chosen, width)
    if repeated:
        sets = sets.dropDuplicates(["u"])
    with small_batches(rows.sparkSession):
        sets = stage(sets, "jaccard-full")
    few = fits_broadcast(pairs, 24, KEY_BROADCAST)
    left = sets.select(F.col("u").alias("a"), F.col("s").alias("sa")).join(F.broadcast(firsts) if few else firsts, "a", "left_semi")
    right = sets.select(F.col("u").alias("b"), F.col("s").alias("sb")).join(F.broadcast(pairs) if few else pairs, "b")
    both = right.join(left, "a")
    shared = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - shared
    return both.where(100 * shared >= percent * union).select("a", "b")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS,
                       percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``id_col, n_shingles, component_id`` (smallest id reachable by links, itself included).

    Ids are integers. Texts without words, and null texts, have empty sets and
    are linked with nothing. Repeated rows share a component. Rows that repeat an
    id with different texts count as one document: it is linked by copies of any of
    its sets, and near copies are verified against one of them.
    A row without id is linked with nothing. Other columns are ignored; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("u"), F.col(text_col).alias("t"))
    with small_batches(spark):
        texts = stage(_texts(rows, width, percent), "jaccard-texts")
    size = texts.where("first").select("u", "n", "d1", "d2")
    named = size.where("n > 0 and u is not null")
    classes = named.groupBy("n", "d1", "d2").agg(F.min("u").alias("rep"), F.max("u").alias("top"))
    classes = stage(classes, "jaccard-classes")
    copies = classes.where("rep < top").select("n", "d1", "d2", "rep")
    copies = stage(lookup(named, copies, ["n", "d1", "d2"], "inner", 48).where("u > rep").select("u", "rep").distinct(), "jaccard-copies")
    copy_ids = copies.select("u").distinct()
    singles = texts.where("band is not null").drop("first", "d1", "d2")
    if fits_broadcast(copies, 64):
        sketches = singles.join(F.broadcast(copy_ids), "u", "left_anti")
    else:
        sketches = stage(singles.join(copy_ids, "u", "left_anti"), "jaccard-sketches")
    member = sketches.select("u", "n", "band", "own", "empty", "z", F.explode("keys").alias("k"))
    # Pairs meet in the own band of the smaller set: keys that no set holds in its own band bring no pair together.
    # Both counts move as one number: that of own bands above the 32 bits of all.
    keys = member.groupBy("k").agg(F.sum(F.when(F.col("own"), (1 << 32) + 1).otherwise(F.lit(1).cast("long"))).alias("c"))
    keys = keys.where(f"c > {1 << 32}").select("k", F.col("c").bitwiseAND((1 << 32) - 1).alias("c")).where("c > 1")
    keys = stage(keys, "jaccard-keys")
    if fits_broadcast(keys, 16, KEY_BROADCAST):
        shared = member.join(F.broadcast(keys), "k")
    else:  # most keys are held by one set alone: a bitmap keeps these out of the shuffle
        bits = min(FILTER_BITS, 1 << (16 * keys.count()).bit_length())
        shared = may_match(member, keys, ["k"], bits).where("_may").drop("_may").join(keys, "k")
    shared = stage(shared, "jaccard-members")

    # Of its hot keys a set leaves as many as it has spare blocks, the most frequent first.
    rank = F.row_number().over(Window.partitionBy("u", "band").orderBy(F.desc("c"), "k"))
    hot = shared.where(F.col("c") > HOT).withColumn("rank", rank).where(F.col("rank") > F.col("z") - F.col("empty")).drop("rank")
    group = shared.where(F.col("c") <= HOT).unionByName(hot)
    degree = group.groupBy("u").agg(F.count(F.lit(1)).alias("degree"))
    group = stage(group.select("k", "u", "n", "band", "own").join(degree, "u"), "jaccard-groups")

    # First every member against its key's pivot, the member sharing most blocks. Sketches tell most candidates
    # apart, so that few sets are built and moved.
    repeated = not named.groupBy("u").count().where("count > 1").isEmpty()
    share = F.col("degree") / F.col("n")
    pivot = stage(group.groupBy("k").agg(F.max(F.struct(share.alias("w"), (-F.col("u")).alias("m"))).alias("p"))
                  .select("k", (-F.col("p.m")).alias("a")), "jaccard-pivots")
    met = lookup(group.select("k", "u", "band"), pivot, ["k"], "inner", 24).where("a <> u").select(
        "a", F.col("u").alias("b"), "band").distinct()
    pairs = stage(_near(stage(met, "jaccard-met"), sketches, percent), "jaccard-pairs")
    links = stage(_verified(pairs, rows, width, percent, repeated), "jaccard-links")
    label = stage(components(links), "jaccard-labels")

    # Then the pairs of keys that still hold several components. One side is always outside the key's largest
    # component, so its members meet the others alone, never one another.
    labelled = lookup(group, label.withColumnRenamed("node", "u"), ["u"], "left", 24)
    labelled = stage(labelled.select("k", "u", "n", "band", "own", F.coalesce("component", "u").alias("l")), "jaccard-labelled")
    parts = labelled.groupBy("k", "l").agg(F.count(F.lit(1)).alias("c")).groupBy("k").agg(F.max(F.struct("c", "l")).alias("m"), F.count(F.lit(1)).alias("parts"))
    mixed = stage(parts.where("parts > 1").select("k", F.col("m.l").alias("big")), "jaccard-mixed")
    open_ = lookup(labelled, mixed, ["k"], "inner", 24)
    ahead = Window.partitionBy("u", "band", "n").orderBy("k").rangeBetween(Window.unboundedPreceding, -1)
    open_ = open_.withColumn("before", F.max("k").over(ahead))
    open_ = stage(open_.join(sketches.select("u", "band", "bits"), ["u", "band"]), "jaccard-open")
    side = lambda df, i, *more: df.select("k", *more, *[F.col(c).alias(f"{c}{i}") for c in ("u", "n", "own", "l", "before", "bits")])
    met_before = F.coalesce(F.col("before1") == F.col("before2"), F.lit(False))
    near = (F.col("l1") != F.col("l2")) & (F.col("own1") | F.col("own2")) & ((F.col("l2") == F.col("big")) | (F.col("u1") < F.col("u2")))
    near = near & ~met_before & _may_link(percent)
    rest = side(open_.where(F.col("l") != F.col("big")), 1).join(side(open_, 2, "big"), "k").where(near)
    rest = rest.select(F.col("u1").alias("a"), F.col("u2").alias("b")).distinct()
    links = links.unionByName(stage(_verified(stage(rest, "jaccard-rest"), rows, width, percent, repeated), "jaccard-more"))
    # Copies hang on their representative.
    links = links.unionByName(copies.select(F.col("rep").alias("a"), F.col("u").alias("b")))
    final = stage(components(links), "jaccard-components")

    out = lookup(size, final.withColumnRenamed("node", "u"), ["u"], "left", 24)
    return out.select(F.col("u").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.coalesce("component", "u")).otherwise(F.col("u")).alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS,
                     percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id."""
    columns = docs.columns
    found = jaccard_components(docs, id_col, text_col, width, percent)
    drop = stage(found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("__id")).distinct(), "jaccard-drop")
    kept = docs.join(F.broadcast(drop) if fits_broadcast(drop, 16) else drop, docs[id_col] == F.col("__id"), "left_anti")
    return kept.select(*[docs[c] for c in columns])
