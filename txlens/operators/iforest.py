"""Isolation forest on Spark (M24-M26) after Liu, Ting and Zhou (2008).

* Fit: a row is in the draw of each of the T trees with probability p, independently,
  p being psi / n with a margin of six standard deviations (psi = min(256, n)). One
  hash per row decides whether any tree draws it (probability 1 - (1 - p)^T) and, by its
  size, how many do (the binomial count given at least one); which trees these are is
  drawn for the few rows that are left. Each tree keeps psi of its rows, those with the smallest
  second hash. ``groupBy('tree').applyInPandas`` grows one tree per
  group, seeded by (seed, tree), rows ordered by key: the forest does not
  depend on partitioning, and one rule holds at every table size. Only about
  T * psi rows ever reach Python.
* Model: a node table (tree, node, left, right, feature, threshold, size,
  depth, leaf) of at most T * (2 psi - 1) rows - the proven bound that makes
  it safe to broadcast. Saved / loaded as Parquet.
* Score: ``mapInArrow`` descends all trees for a block of rows at once with
  numpy; s(x) = 2^(-E[h(x)] / c(psi)), h = depth + c(leaf size).
  ``anomaly_score = s - percentile(s, 1 - contamination)`` (the reference's
  negated decision function), ``is_anomaly = anomaly_score > 0``.

Splits are invariant to per-feature affine maps, so the forest is grown on
the prepared (median-filled) features without standardisation.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txlens.operators.cache import cut
from txlens.operators.quantiles import quantiles_df
from txlens.operators.sampling import key_hash
from txlens.session import ship_package

EULER_GAMMA = 0.5772156649015329
NODE_SCHEMA = ("tree int, node int, left int, right int, feature int, threshold double, "
               "size long, depth int, leaf boolean")


def average_path_length(n: np.ndarray | float) -> np.ndarray:
    """c(n): mean path length of an unsuccessful BST search; c(1) = 0, c(2) = 1."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """One isolation tree: random feature (non-constant in the node), uniform
    threshold in (min, max); rows <= threshold go left. Returns node rows
    (node, left, right, feature, threshold, size, depth, leaf)."""
    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, -1, None)]
    while stack:
        idx, depth, parent, side = stack.pop()
        node = len(nodes)
        nodes.append([node, -1, -1, -1, float("nan"), len(idx), depth, True])
        if parent >= 0:
            nodes[parent][1 if side == "L" else 2] = node
        if depth >= max_depth or len(idx) <= 1:
            continue
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        candidates = np.nonzero(hi > lo)[0]
        if len(candidates) == 0:
            continue
        f = int(candidates[rng.integers(len(candidates))])
        t = float(rng.uniform(lo[f], hi[f]))
        if not (lo[f] <= t < hi[f]):
            t = float(lo[f])
        go_left = sub[:, f] <= t
        nodes[node][3], nodes[node][4], nodes[node][7] = f, t, False
        # right pushed first so that the left subtree gets the lower ids
        stack.append((idx[~go_left], depth + 1, node, "R"))
        stack.append((idx[go_left], depth + 1, node, "L"))
    return [tuple(n) for n in nodes]


@dataclass
class IsolationForestModel:
    features: list[str]
    nodes: pd.DataFrame          # the node table (bounded: T * (2 psi - 1) rows)
    n_trees: int
    psi: int
    contamination: float

    @property
    def max_nodes(self) -> int:
        return int(self.nodes.groupby("tree")["node"].max().max()) + 1

    def arrays(self) -> dict:
        """Dense (T, max_nodes) arrays for vectorised descent."""
        t, m = self.n_trees, self.max_nodes
        a = {k: np.zeros((t, m), dtype=dt) for k, dt in
             (("left", np.int32), ("right", np.int32), ("feature", np.int32), ("threshold", np.float64),
              ("size", np.float64), ("depth", np.float64), ("leaf", bool))}
        a["leaf"][:] = True
        nd = self.nodes
        ti, ni = nd["tree"].to_numpy(), nd["node"].to_numpy()
        for k in ("left", "right", "feature", "threshold", "size", "depth", "leaf"):
            a[k][ti, ni] = nd[k].to_numpy()
        a["max_depth"] = int(nd["depth"].max())
        return a

    def save(self, spark: SparkSession, path: str) -> None:
        """Node table + parameters to Parquet."""
        df = spark.createDataFrame(self.nodes, NODE_SCHEMA)
        df.write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(",".join(self.features), self.n_trees, self.psi, self.contamination)],
                              "features string, n_trees int, psi int, contamination double") \
            .write.mode("overwrite").parquet(f"{path}/params")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "IsolationForestModel":
        p = spark.read.parquet(f"{path}/params").collect()[0]
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()
        return cls(p["features"].split(","), nodes, p["n_trees"], p["psi"], p["contamination"])


def drawn_counts(n_trees: int, share: float) -> tuple[float, list[float]]:
    """Probability that any tree draws a row, and the distribution function of the number that do, given one does."""
    if share >= 1:
        return 1.0, [0.0] * (n_trees - 1) + [1.0]
    some = -math.expm1(n_trees * math.log1p(-share))
    upto, total = [], 0.0
    for k in range(1, n_trees + 1):
        log_p = math.lgamma(n_trees + 1) - math.lgamma(k + 1) - math.lgamma(n_trees - k + 1) + k * math.log(share) + (n_trees - k) * math.log1p(-share)
        total += math.exp(log_p) / some
        upto.append(total)
    return some, upto


def draw_trees(df: DataFrame, key: str, n_trees: int, share: float, seed: int) -> DataFrame:
    """The rows of ``df`` that trees draw, once per such tree (column ``tree``): each tree draws a row with probability ``share``.

    One hash per row; only rows that some tree draws are looked at further.
    """
    some, upto = drawn_counts(n_trees, share)
    key_text = F.col(key).cast("string")
    u = F.xxhash64(key_text, F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))
    kept = df.where(u < F.lit(some)) if some < 1 else df
    count = F.size(F.filter(F.array(*[F.lit(c) for c in upto if c < 1.0] or [F.lit(2.0)]), lambda c: c <= u / F.lit(some))) + 1
    order = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                                     lambda t: F.struct(F.xxhash64(key_text, t, F.lit(seed)).alias("h"), t.alias("t"))))
    return kept.withColumn("tree", F.explode_outer(F.transform(F.slice(order, 1, count), lambda x: x["t"])))


def fit_isolation_forest(df: DataFrame, features: list[str], key: str, n_trees: int = 100,
                         max_samples: int = 256, contamination: float = 0.02, seed: int = 42,
                         min_rows: int = 10) -> IsolationForestModel:
    """Grow the forest (see module docstring for the sampling plan)."""
    n = df.count()
    if n < min_rows:
        raise ValueError(f"not enough rows for an isolation forest: {n}")
    psi = int(min(max_samples, n))
    cols = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    key_text = F.col(key).cast("string")
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    p = len(features)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values("_key")
        x = pdf[[f"f{i}" for i in range(p)]].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        rows = grow_tree(x, rng, max_depth)
        out = pd.DataFrame(rows, columns=["node", "left", "right", "feature", "threshold", "size", "depth", "leaf"])
        out.insert(0, "tree", tree)
        return out

    ship_package(df.sparkSession)
    share = min(1.0, (psi + 6 * math.sqrt(psi)) / n)
    while True:
        drawn = draw_trees(df, key, n_trees, share, seed).select(key_text.alias("_key"), *cols, "tree")
        w = Window.partitionBy("tree").orderBy(F.xxhash64("_key", "tree", F.lit(seed + 1)), "_key")
        sample = drawn.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= psi).drop("_r")
        nodes = sample.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()  # <= T (2 psi - 1) rows
        roots = nodes[nodes["node"] == 0]["size"]
        if share >= 1 or (len(roots) == n_trees and (roots >= psi).all()):
            break
        share = min(1.0, 2 * share)  # a tree came up short
    nodes = nodes.sort_values(["tree", "node"]).reset_index(drop=True)
    return IsolationForestModel(list(features), nodes, n_trees, psi, contamination)


_BLOCK = 32768  # rows sent down the trees at once
_WHOLE = 200_000  # rows whose features are all kept beside the scores


def _tests(a: dict) -> tuple[list[np.ndarray], list[tuple]]:
    """The distinct thresholds of each feature, and per tree: its inner nodes, parents first, as (node, left, right, feature,
    place of the threshold); bit by bit the leaves whose number among the tree's path lengths has that bit; these lengths. Made once for ``a``."""
    if "tests" not in a:
        inner = ~a["leaf"]
        bounds = [np.unique(a["threshold"][inner & (a["feature"] == f)]) for f in range(int(a["feature"].max()) + 1)]
        length, trees = a["depth"] + average_path_length(a["size"]), []
        for k in range(a["left"].shape[0]):
            nodes, leaves, stack = [], [], [0]
            while stack:
                node = stack.pop()
                if a["leaf"][k, node]:
                    leaves.append(node)
                    continue
                left, right, f = (int(a[c][k, node]) for c in ("left", "right", "feature"))
                nodes.append((node, left, right, f, int(np.searchsorted(bounds[f], a["threshold"][k, node]))))
                stack += [left, right]
            lengths, number = np.unique(length[k, leaves], return_inverse=True)
            bits = [[leaf for leaf, c in zip(leaves, number) if c >> j & 1] for j in range(int(len(lengths) - 1).bit_length())]
            trees.append((nodes, bits, lengths))
        a["tests"] = bounds, trees
    return a["tests"]


def _path_lengths(x: np.ndarray, a: dict) -> np.ndarray:
    """(rows, trees) path length h = depth + c(size) of the reached leaf.

    A value is replaced by the number of its feature's thresholds below it, so that a node tests whole numbers, for all rows of a
    block at once; a node's bits tell the rows that reach it. The leaves' bits, by the bits of their lengths' numbers, tell the length of every row.
    """
    bounds, trees = _tests(a)
    out = np.empty((len(x), len(trees)))
    for at in range(0, len(x), _BLOCK):
        rows = x[at:at + _BLOCK]
        n = len(rows)
        value = [np.searchsorted(b, np.ascontiguousarray(rows[:, f])).astype(np.min_scalar_type(len(b))) for f, b in enumerate(bounds)]
        passed, lengths, every = np.empty(n, bool), np.empty((len(trees), n)), np.full((n + 7) // 8, 255, np.uint8)
        for k, (nodes, bits, of) in enumerate(trees):
            reach = {0: every}
            for node, left, right, f, place in nodes:
                np.less_equal(value[f], value[f].dtype.type(place), out=passed)  # NaN is above every threshold
                here = reach.pop(node)
                reach[left] = here & np.packbits(passed)
                reach[right] = here ^ reach[left]
            number = np.zeros(n, np.min_scalar_type(max(len(of) - 1, 0)))
            for j, leaves in enumerate(bits):
                some = reach[leaves[0]].copy()
                for leaf in leaves[1:]:
                    some |= reach[leaf]
                number |= np.left_shift(np.unpackbits(some, count=n), j, dtype=number.dtype)
            of.take(number, out=lengths[k], mode="clip")
        out[at:at + _BLOCK] = lengths.T
    return out


def _blocks(batches, rows: int):
    """Arrow batches put together to tables of ``rows`` rows and more, but for the last."""
    held = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def score_samples(model: IsolationForestModel, df: DataFrame, keys: list[str], features: bool = False, floor: float | None = None) -> DataFrame:
    """Keys + ``raw_score`` s(x) in (0, 1) and ``mean_path_length``; with ``features`` also the model's
    feature columns, so that later steps need not join the scores back to them. With ``floor`` these are
    one array, ``features``, and null for rows scored below it."""
    spark = df.sparkSession
    ship_package(spark)
    bc = spark.sparkContext.broadcast(model.arrays())  # bounded by T * (2 psi - 1) nodes
    cpsi = float(average_path_length(np.array([model.psi]))[0])
    feats = model.features

    def score(batches):
        a = bc.value
        for rows in _blocks(batches, _BLOCK):
            x = rows["_x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(feats))
            h = _path_lengths(x, a).mean(axis=1)
            s = np.power(2.0, -h / cpsi) if cpsi > 0 else np.full(len(h), 0.5)
            out = rows.select(keys)
            if features and floor is None:
                for i, c in enumerate(feats):
                    out = out.append_column(c, pa.array(x[:, i], from_pandas=True))
            elif features:
                high = s >= floor
                ends = np.concatenate([[0], np.cumsum(np.where(high, len(feats), 0))]).astype(np.int32)
                out = out.append_column("features", pa.ListArray.from_arrays(ends, pa.array(x[high].ravel(), from_pandas=True), mask=pa.array(~high)))
            out = out.append_column("mean_path_length", pa.array(h)).append_column("raw_score", pa.array(s))
            yield from out.to_batches(max_chunksize=10_000)

    key_schema = ", ".join([*(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys), *((f"`{c}` double" for c in feats) if features and floor is None else ["features array<double>"] if features else [])])
    sel = df.select(*keys, F.array(*[F.col(c).cast("double") for c in feats]).alias("_x"))  # one column moves faster than many
    return sel.mapInArrow(score, f"{key_schema}, mean_path_length double, raw_score double")


def _threshold(scored: DataFrame, contamination: float) -> DataFrame:
    """One row, ``_offset``: percentile(raw_score, 1 - c) of stored scores, c capped at 0.5."""
    return cut(quantiles_df(scored, "raw_score", [1.0 - min(contamination, 0.5)], names=["_offset"], stored=True))  # not computed again by every reader


def _flagged(scored: DataFrame, thr: DataFrame) -> DataFrame:
    return scored.crossJoin(F.broadcast(thr)) \
                 .withColumn("anomaly_score", F.col("raw_score") - F.col("_offset")) \
                 .withColumn("is_anomaly", F.col("anomaly_score") > 0).drop("_offset")


def flag(scored: DataFrame, contamination: float) -> DataFrame:
    """anomaly_score = s - percentile(s, 1 - c) (c capped at 0.5); flag above 0."""
    scored = cut(scored)  # score once; the threshold and the output both read it
    return _flagged(scored, _threshold(scored, contamination))


def flag_with_features(model: IsolationForestModel, df: DataFrame, key: str, contamination: float, seed: int = 42) -> DataFrame:
    """M25 + M26 of every row; the flagged rows also have the features that were scored, most others null in place of them.

    Features are written for rows with at least the score that a seeded sample exceeds in twice the share of rows to flag. Should the
    threshold be below that, all rows are scored again and keep their features.
    """
    n, floor = df.count(), None
    if n > _WHOLE:
        some = df.where(key_hash(key, seed) < F.lit(int((1 << 63) * (_WHOLE / 10 / n))))
        found = np.array([r[0] for r in score_samples(model, some, [key]).select("raw_score").collect()])  # about _WHOLE / 10 rows
        floor = float(np.quantile(found, max(0.0, 1 - 2 * min(contamination, 0.5)))) if len(found) else None
    scored = cut(score_samples(model, df, [key], features=True, floor=floor))
    thr = _threshold(scored, contamination)
    if floor is None:
        return _flagged(scored, thr)
    if thr.first()[0] < floor:
        return flag(score_samples(model, df, [key], features=True), contamination)
    columns = [F.get("features", F.lit(i)).alias(c) for i, c in enumerate(model.features)]
    return _flagged(scored.select(key, *columns, "mean_path_length", "raw_score"), thr)
