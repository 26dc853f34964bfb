"""Hard-negative mining with exact scores by a residue-number-system GEMM.

Vectors are quantised to integers. Inner products of a block of anchors with a block of
rows are computed modulo several small primes, each as one float32 matrix product of centred
residues; the primes are small enough that every partial sum stays below 2^24 and is
therefore exact. Chinese remaindering (mixed radix) gives the signed scores; as
many primes are used as the largest possible score needs, which is measured first.

Anchors are staged in the shared folder in blocks of bounded size. A task reads a bounded run of rows,
then streams all blocks of anchors past it, so anchors are neither broadcast nor gathered, and
no (row, anchor) pair leaves a task but the few that may still be selected. Two passes:
the first selects every anchor's best rows of its label (positives), the second the best rows of
other labels within the score window of each positive. What the tasks select is
merged per anchor.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlens.llm.common import shared_path, stage

SCALE = 256            # a component x becomes floor(SCALE * x)
RUN_CELLS = 1 << 23    # components of the rows held by a task
BLOCK_ANCHORS = 1024   # anchors scored at a time
CHUNK = 256            # components in one float32 product
MOST_SCORE = 1 << 50   # larger possible scores are refused
_EXACT = 1 << 24       # float32 holds every integer up to here
_TIE_BITS = 13
_BATCH = 1 << _TIE_BITS  # rows scored at a time
_NEVER = np.iinfo(np.int64).min


def primes_for(bound: int, width: int) -> list[int]:
    """Primes whose product exceeds ``2 * bound + 1`` and whose products of centred residues add up exactly over a chunk."""
    top = 2 * math.isqrt(_EXACT // max(1, min(width, CHUNK))) + 1
    out, product, p = [], 1, top
    while product <= 2 * bound + 1:
        while p % 2 == 0 or any(p % q == 0 for q in range(3, math.isqrt(p) + 1, 2)):
            p -= 1
        out.append(p)
        product, p = product * p, p - 1
    return out


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Centred residues of an integer matrix modulo each prime, as float32."""
    out = []
    for p in primes:
        r = x % p
        out.append((r - p * (r > p // 2)).astype(np.float32))
    return out


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact signed inner products (int64) of the rows of two matrices given by their residues."""
    value, radix = None, 1
    for left, right, p in zip(a, b, primes):
        r = np.zeros((len(left), len(right)), np.int64)
        for k in range(0, left.shape[1], CHUNK):
            r += (left[:, k:k + CHUNK] @ right[:, k:k + CHUNK].T).astype(np.int64)
        r %= p
        if value is None:
            value = r
        else:
            value += radix * (((r - value) % p) * pow(radix, -1, p) % p)
        radix *= p
    value[value > radix // 2] -= radix
    return value


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows of ``width`` integers; shorter vectors are filled with zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _best(rank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of the ``k`` largest entries of each row, but for ``_NEVER``."""
    k = min(k, rank.shape[1])
    cols = np.argpartition(rank, rank.shape[1] - k, axis=1)[:, rank.shape[1] - k:]
    rows, at = np.nonzero(np.take_along_axis(rank, cols, 1) != _NEVER)
    return rows, cols[rows, at]


def quantised(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, label, q``: vectors as integers. Rows without id, label or vector, or with a null or non-finite component, take no part."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull()).where(~bad)
    q = F.transform(v, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), q.alias("q"))


def mine(vectors: DataFrame, every: int = 50, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``every``, searched among all rows.

    ``vectors`` has ``vec_id, label, q`` (integer components; see ``quantised``). Rows are scored by the inner product
    with the anchor; higher scores come first, ties by smaller id. An anchor's positives are the first
    ``n_positives`` other rows of its label; for each, the first ``n_negatives`` rows of other labels with
    ``low * positive <= 100 * negative <= high * positive`` are returned as ``anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score``.

    Shorter vectors count as filled with zeros. Rows that repeat an id are each a row and each an anchor;
    a row is never a positive of an anchor with its id. Possible scores above ``MOST_SCORE`` raise ValueError.
    An empty table gives an empty result.
    """
    rows = stage(vectors.select("vec_id", "label", "q"), "negatives-rows")
    squares = F.aggregate("q", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    size = rows.agg(F.max(F.size("q")).alias("width"), F.max(squares).alias("norm")).first()
    width, bound = max(1, size["width"] or 0), size["norm"] or 0.0
    if not bound < MOST_SCORE:
        raise ValueError(f"vectors are too long for exact scores: a squared length of {bound}")
    # By Cauchy and Schwarz no score exceeds the largest squared length (whose sum in doubles is exact below 2^53).
    primes = primes_for(int(bound), width)

    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("anchor", F.monotonically_increasing_id())
    anchors = stage(anchors, "negatives-anchors")
    folder = _blocks(anchors.select("anchor", "vec_id", "label", "q", F.array().cast("array<long>").alias("wanted")))
    found = _search(rows, folder, primes, width, n_positives, None)
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n_positives)
    positives = stage(best.select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")

    # A list holds n_positives scores at most.
    wanted = positives.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("w"))
    folder = _blocks(anchors.join(wanted.select("anchor", F.col("w.positive_score").alias("wanted")), "anchor").select("anchor", "vec_id", "label", "q", "wanted"))
    found = _search(rows, folder, primes, width, n_negatives, (low, high))
    order = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
    out = best.join(positives, ["anchor", "place"]).join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                      "positive_score", F.col("score").alias("negative_score"))


def _blocks(anchors: DataFrame) -> str:
    """Write anchors as Parquet with row groups of a bounded size; tasks read these one at a time."""
    path = shared_path(anchors.sparkSession, "negatives-blocks")
    anchors.write.option("parquet.block.size", 8 << 20).parquet(path)
    return path


def _read_blocks(folder: str, width: int) -> Iterator[tuple]:
    """Anchors of the folder in blocks: number, id, label, components, wanted scores (one list an anchor)."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    files = sorted(f.path for f in store.get_file_info(fs.FileSelector(base)) if f.path.endswith(".parquet"))
    for path in files:
        with store.open_input_file(path) as f:
            for batch in pq.ParquetFile(f).iter_batches(BLOCK_ANCHORS):
                if batch.num_rows:
                    t = batch.to_pydict()
                    yield np.array(t["anchor"]), np.array(t["vec_id"]), np.array(t["label"]), _matrix(t["q"], width), t["wanted"]


def _search(rows: DataFrame, folder: str, primes: list[int], width: int, k: int, window: tuple[int, int] | None) -> DataFrame:
    """``anchor, place, vec_id, score``: of every run of rows, the best k for each anchor.

    Without ``window``: rows of the anchor's label but its own id (``place`` 0). With it: for each of the anchor's
    wanted scores (``place`` from 1) rows of other labels within the window.
    """
    names = ["anchor", "place", "vec_id", "score"]

    def run(vec_id: np.ndarray, label: np.ndarray, q: list) -> Iterator[pd.DataFrame]:
        order = np.argsort(vec_id, kind="stable")  # so that ties go to the smaller id
        vec_id, label = vec_id[order], label[order]
        right = residues(_matrix(q, width)[order], primes)
        for anchor, own_id, own_label, mine, wanted in _read_blocks(folder, width):
            left = residues(mine, primes)
            kept = []
            for a in range(0, len(vec_id), _BATCH):
                part = slice(a, a + _BATCH)
                s = scores(left, [r[part] for r in right], primes)
                base = (s << _TIE_BITS) + np.arange(s.shape[1])[::-1]  # score and tie in one number
                same = own_label[:, None] == label[part][None, :]
                if window is None:
                    able = same & (own_id[:, None] != vec_id[part][None, :])
                    kept.append(_pick(anchor, 0, np.where(able, base, _NEVER), s, vec_id[part], k))
                else:
                    for place in range(max(map(len, wanted), default=0)):
                        goal = np.array([w[place] if len(w) > place else 0 for w in wanted], np.int64)[:, None]
                        some = np.array([len(w) > place for w in wanted])[:, None]
                        able = some & ~same & (window[0] * goal <= 100 * s) & (100 * s <= window[1] * goal)
                        kept.append(_pick(anchor, place + 1, np.where(able, base, _NEVER), s, vec_id[part], k))
            found = pd.DataFrame(np.concatenate(kept), columns=names)
            found = found.sort_values(["anchor", "place", "score", "vec_id"], ascending=[True, True, False, True])
            yield found.groupby(["anchor", "place"], sort=False).head(k)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n * width >= RUN_CELLS:
                yield from run(*_joined(held))
                held, n = [], 0
        if n:
            yield from run(*_joined(held))

    return rows.mapInPandas(search, "anchor long, place int, vec_id long, score long")


def _joined(held: list[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray, list]:
    return (np.concatenate([b["vec_id"].to_numpy() for b in held]), np.concatenate([b["label"].to_numpy() for b in held]),
            [v for b in held for v in b["q"]])


def _pick(anchor: np.ndarray, place: int, rank: np.ndarray, s: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    rows, cols = _best(rank, k)
    return np.stack([anchor[rows], np.full(len(rows), place), vec_id[cols], s[rows, cols]], 1).astype(np.int64)
