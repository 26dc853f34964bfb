"""Feature attributions for the isolation forest and their consumers.

Path-dependent Shapley values of a forest, leaf by leaf. A leaf's path tests m distinct
features; feature j is passed by the row or not (o_j = 1 or 0, one interval test) and by a share z_j
of the training rows. The leaf's part of feature f's value is

    value * (o_f - z_f) * integral over t in (0, 1) of  prod_{j != f} (z_j (1 - t) + o_j t)

since the weights k! (m - k - 1)! / m! of the subsets are the integrals of t^k (1 - t)^(m - 1 - k).
The integrand is a polynomial of degree m - 1, so Gauss-Legendre nodes, half as many as features,
integrate it exactly. It depends on the row by the pattern of passed features alone, so a leaf's values
are integrated once for all patterns and looked up for a batch of rows. The explained output is the *negated* mean path length, so a
positive value pushes a row towards "anomalous" and the direction labels are
true. Rows are chosen with a seeded hash (B21) or taken whole (e.g. all
flagged rows); the long output (key, feature, value, shap, |shap|) is keyed,
never positional.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlens.functions.scalar import impact_label, round_half_up as R
from txlens.operators.joins import rows_of
from txlens.operators.sampling import smallest_hashes
from txlens.operators.iforest import IsolationForestModel, average_path_length
from txlens.session import ship_package


_ROWS, _LEAVES = 32, 1024  # rows and leaves worked on at once
_BLOCK, _BITS = 8192, 9     # rows looked up at once, tested features of a table (one of 9 takes 37 kB)


def leaf_paths(a: dict) -> dict:
    """The paths to all leaves of a forest's node arrays, one row per leaf, its distinct tested features side by side.

    ``feature``, ``low``, ``high`` (passed if low < x <= high) and ``share`` (of the training rows that pass) are
    leaves x features; unused places are passed by all. ``value`` is the negated path length over the number of
    trees, ``base`` its mean over the training rows. At most T (psi + 1) rows.
    """
    trees = a["left"].shape[0]
    found: list[tuple[dict, float, float]] = []
    for k in range(trees):
        stack = [(0, {}, 1.0)]
        while stack:
            node, path, reach = stack.pop()
            if a["leaf"][k, node]:
                found.append((path, -(a["depth"][k, node] + float(average_path_length(a["size"][k, node]))) / trees, reach))
                continue
            f, threshold = int(a["feature"][k, node]), float(a["threshold"][k, node])
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            for child, bounds in ((int(a["left"][k, node]), (low, min(high, threshold))), (int(a["right"][k, node]), (max(low, threshold), high))):
                part = float(a["size"][k, child] / a["size"][k, node])
                stack.append((child, {**path, f: (*bounds, share * part)}, reach * part))
    width = max(1, max(len(p) for p, _, _ in found))
    out = {"feature": np.zeros((len(found), width), np.int64), "low": np.full((len(found), width), -np.inf),
           "high": np.full((len(found), width), np.inf), "share": np.ones((len(found), width)), "value": np.array([v for _, v, _ in found])}
    for i, (path, _, _) in enumerate(found):
        for j, (f, (low, high, share)) in enumerate(path.items()):
            out["feature"][i, j], out["low"][i, j], out["high"][i, j], out["share"][i, j] = f, low, high, share
    out["base"] = float(sum(v * reach for _, v, reach in found))
    return out


def _values_by_pattern(share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """(leaves, features, patterns) Shapley values for every pattern of passed features; bit j of a pattern is feature j."""
    m = share.shape[1]
    share, passed = share[:, :, None], (np.arange(1 << m) >> np.arange(m)[:, None] & 1).astype(float)
    integral = 0.0
    for t, w in zip(*np.polynomial.legendre.leggauss((m + 1) // 2)):
        factor = share * (1 - t) / 2 + passed * (1 + t) / 2  # never 0: every share is positive
        integral = integral + w / 2 * factor.prod(1, keepdims=True) / factor
    return (passed - share) * integral * value[:, None, None]


def _leaf_tables(paths: dict) -> list[tuple]:
    """Per leaf of at most ``_BITS`` tested features: features, their bounds, table of values by pattern. Made once for ``paths``."""
    if "tables" not in paths:
        used = (paths["low"] > -np.inf) | (paths["high"] < np.inf)
        tested, found = used.sum(1), {}
        for m in range(1, _BITS + 1):
            leaves = np.flatnonzero(tested == m)
            for at in range(0, len(leaves), 256):
                some = leaves[at:at + 256]
                here = used[some]
                of = {k: paths[k][some][here].reshape(-1, m) for k in ("feature", "low", "high", "share")}
                values = _values_by_pattern(of["share"], paths["value"][some])
                found |= {i: (of["feature"][n].tolist(), of["low"][n].tolist(), of["high"][n].tolist(), values[n]) for n, i in enumerate(some)}
        paths["long"], paths["tables"] = np.flatnonzero(tested > _BITS), [found[i] for i in sorted(found)]
    return paths["tables"]


def path_shap(x: np.ndarray, paths: dict) -> np.ndarray:
    """Shapley values (rows, features) of the negated mean path length.

    A leaf's values depend on a row only by which of its tested features the row passes, so
    they are looked up by that pattern. Leaves that test more than ``_BITS`` features are integrated row by row.
    """
    n, p = x.shape
    tables = _leaf_tables(paths)
    phi = np.zeros((p, n))
    for row in range(0, n, _BLOCK):
        v, out = np.ascontiguousarray(x[row:row + _BLOCK].T), phi[:, row:row + _BLOCK]
        below: dict = {}  # rows at most a bound; leaves of a tree follow each other and share most bounds
        for feature, low, high, table in tables:
            if len(below) > 1000:
                below.clear()
            code = np.zeros(v.shape[1], np.uint16)
            for j, (f, lo, hi) in enumerate(zip(feature, low, high)):
                for bound in (lo, hi):
                    if (f, bound) not in below:
                        below[f, bound] = (v[f] <= bound).view(np.uint8)
                # low < x <= high; rows below low are below high
                code |= np.left_shift(below[f, hi] ^ below[f, lo], j, dtype=np.uint16)
            code = code.astype(np.intp)
            for f, of in zip(feature, table):
                out[f] += of.take(code)
    return phi.T + _integrated(x, {k: paths[k][paths["long"]] for k in ("feature", "low", "high", "share", "value")})


def _integrated(x: np.ndarray, paths: dict) -> np.ndarray:
    """The values of leaves with any number of tested features, integrated for every row."""
    n, p = x.shape
    leaves, width = paths["feature"].shape
    nodes, weights = np.polynomial.legendre.leggauss((width + 1) // 2)
    nodes, weights = (nodes + 1) / 2, weights / 2
    phi = np.zeros((n, p))
    for at in range(0, leaves, _LEAVES):
        part = slice(at, at + _LEAVES)
        feature, share, value = paths["feature"][part], paths["share"][part], paths["value"][part]
        to_feature = np.zeros((feature.size, p))
        to_feature[np.arange(feature.size), feature.ravel()] = 1.0
        for row in range(0, n, _ROWS):
            v = x[row:row + _ROWS][:, feature]
            passed = ((v > paths["low"][part]) & (v <= paths["high"][part])).astype(float)
            integral = np.zeros_like(passed)
            for t, w in zip(nodes, weights):
                factor = share * (1 - t) + passed * t  # never 0: every share is positive
                integral += w * factor.prod(2, keepdims=True) / factor
            parts = (passed - share) * integral * value[:, None]
            phi[row:row + _ROWS] += parts.reshape(len(v), -1) @ to_feature
    return phi


def forest_shap(x: np.ndarray, model_arrays: dict) -> tuple[np.ndarray, float]:
    """Attributions of the negated mean path length over all trees, and the base value."""
    paths = leaf_paths(model_arrays)
    return path_shap(x, paths), paths["base"]


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """N rows chosen by a seeded hash of the key (reproducible under any partitioning)."""
    return smallest_hashes(df, key, n, seed)


def shap_values(model: IsolationForestModel, rows: DataFrame, key: str) -> DataFrame:
    """Long attribution table (key, feature, feature_value, shap_value, abs_shap, base_value).

    ``rows`` must carry ``key`` and the model's feature columns (unscaled, as fitted).
    """
    spark = rows.sparkSession
    ship_package(spark)
    bc = spark.sparkContext.broadcast(leaf_paths(model.arrays()))  # bounded by the leaves
    feats = model.features
    kt = rows.schema[key].dataType.simpleString()

    def explain(batches):
        paths = bc.value
        for pdf in batches:
            if pdf.empty:
                continue
            x = pdf[feats].to_numpy(dtype=float)
            phi, base = path_shap(x, paths), paths["base"]
            n, p = phi.shape
            yield pd.DataFrame({
                key: np.repeat(pdf[key].to_numpy(), p),
                "feature": np.tile(np.array(feats, dtype=object), n),
                "feature_value": x.reshape(-1),
                "shap_value": phi.reshape(-1),
                "abs_shap": np.abs(phi).reshape(-1),
                "base_value": np.full(n * p, base),
            })

    # A sample arrives in one partition and flagged rows lie unevenly: deal them out.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sel = rows.select(key, *[F.col(c).cast("double").alias(c) for c in feats]).repartition(tasks, key)
    return sel.mapInPandas(explain, f"{key} {kt}, feature string, feature_value double, shap_value double, "
                                    "abs_shap double, base_value double")


def top_features(attr: DataFrame, key: str, n: int = 10) -> DataFrame:
    """F3 + G20: per row the n largest |shap| with a direction label."""
    w = Window.partitionBy(key).orderBy(F.desc("abs_shap"), F.asc("feature"))
    return attr.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n) \
               .withColumn("impact", impact_label("shap_value"))


def global_importance(attr: DataFrame, top: int = 15) -> DataFrame:
    """Mean |shap| per feature, top n."""
    return attr.groupBy("feature").agg(F.avg("abs_shap").alias("mean_abs_shap")) \
               .orderBy(F.desc("mean_abs_shap"), F.asc("feature")).limit(top)


def attribution_stats(attr: DataFrame, key: str) -> DataFrame:
    """Rows explained, features, mean / population std / min / max of the values."""
    return attr.agg(F.count_distinct(key).alias("n_transactions"), F.count_distinct("feature").alias("n_features"),
                    F.avg("shap_value").alias("shap_mean"), F.stddev_pop("shap_value").alias("shap_std"),
                    F.min("shap_value").alias("shap_min"), F.max("shap_value").alias("shap_max"))


def waterfall(attr: DataFrame, key: str) -> DataFrame:
    """Per row, contributions by |shap| with the running total from the base value."""
    w = Window.partitionBy(key).orderBy(F.desc("abs_shap"), F.asc("feature"))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return attr.withColumn("step", F.row_number().over(w)) \
               .withColumn("cumulative", F.col("base_value") + F.sum("shap_value").over(run))


# Wording of the explanations, one language per sentence.
PHRASES = {
    "en": {"lead": "Why transaction %s (user %s) stands out.", "up": "Raising its score: ", "down": "Lowering it: ",
           "factor": "%s = %.2f (%+.3f)", "known": "Known about it: ", "product_amount": "amount %.2f",
           "cashback": "cashback %.2f", "product_category": "category %s", "nobody": "unknown"},
    "fr": {"lead": "Pourquoi la transaction %s (utilisateur %s) ressort.", "up": "Ce qui élève son score : ",
           "down": "Ce qui l'abaisse : ", "factor": "%s = %.2f (%+.3f)", "known": "À son sujet : ",
           "product_amount": "montant %.2f", "cashback": "remise %.2f", "product_category": "catégorie %s", "nobody": "inconnu"},
}


def explain_text(attr: DataFrame, raw: DataFrame, key: str = "transaction_id", top_n: int = 5,
                 flags: DataFrame | None = None, language: str = "en") -> DataFrame:
    """M33 + G25: one text per flagged row, in one language.

    Up to 3 raising and 2 lowering factors among the row's ``top_n``
    attributions, then what the source row says of it. ``flags`` (key,
    ``is_anomaly``) picks the rows: only flagged ones are explained; without it
    every attributed row is taken as flagged. A row's factors are at most ``top_n``.
    """
    words = PHRASES[language]
    top = top_features(attr, key, top_n).select(key, F.struct("rank", F.format_string(words["factor"], "feature", "feature_value", "shap_value")
                                                             .alias("said"), F.signum("shap_value").alias("sign")).alias("f"))
    rows = top.groupBy(key).agg(F.sort_array(F.collect_list("f")).alias("f"))
    if flags is not None:  # one row per key by now
        rows = rows.join(flags.where("is_anomaly").select(key).distinct(), key, "left_semi")

    def side(sign: int, n: int, title: str):
        of = F.slice(F.filter("f", lambda x: x["sign"] == sign), 1, n)
        return F.when(F.size(of) > 0, F.concat(F.lit(title), F.array_join(F.transform(of, lambda x: x["said"]), "; "), F.lit(".")))

    columns = [c for c in ("user_id", "product_amount", "cashback", "product_category") if c in raw.columns]
    rows = rows.join(rows_of(raw.select(key, *columns), attr.select(key), key), key, "left")
    user = F.coalesce(F.col("user_id").cast("string"), F.lit(words["nobody"])) if "user_id" in columns else F.lit(words["nobody"])
    facts = F.concat_ws(", ", *[F.when(F.col(c).isNotNull(), F.format_string(words[c], c)) for c in columns if c != "user_id"])
    text = F.concat_ws(" ", F.format_string(words["lead"], F.col(key).cast("string"), user), side(1, 3, words["up"]), side(-1, 2, words["down"]),
                       F.when(facts != "", F.concat(F.lit(words["known"]), facts, F.lit("."))))
    return rows.select(key, text.alias("explanation"))


def shap_summary(attr: DataFrame, key: str, top: int = 15) -> tuple[DataFrame, DataFrame]:
    """(global importance, statistics)."""
    return global_importance(attr, top), attribution_stats(attr, key)


def rounded(attr: DataFrame, digits: int = 6) -> DataFrame:
    return attr.withColumns({c: R(c, digits) for c in ("shap_value", "abs_shap", "base_value")})
