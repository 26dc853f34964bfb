"""Mixing sources to target token weights by entropy balancing.

Each document gets a rate; the rates minimise the token-weighted relative entropy
to "every document once" under one token constraint per source. The solution is
an exponential tilt, rate = exp(lambda of its source), and the dual

    sum over documents of size * exp(lambda) - sum over sources of target * lambda

is convex. It is solved by Newton iterations: gradient and curvature are sums over
the documents, which enter through their (source, size) counts, an aggregate
combined on the map side. The constraints of different sources share no document, so the
Hessian is diagonal and every source steps in the same job, however many there are.
Rates are rounded to copies: per source over sizes from large to small, carrying
the rounding error on, so that the words taken miss the target by less than a
small document; the copies of one size go to documents in hash order.
``balance`` takes further moment constraints, which couple the sources.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlens.llm.common import fits_broadcast, stage, with_rank

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
TOLERANCE = 1e-9
BUCKET_ROWS = 20_000
MAX_MOMENTS = 20   # wanted values besides the sources: their system is solved on the driver
MAX_STEP = 2.0     # of a multiplier in one Newton step of the coupled system
_KEY = ["_none", "_source"]


def words(text: Column) -> Column:
    """Number of runs of characters other than space and \\x09-\\x0D; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.col(source_col).isNull().alias("_none"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_source"), words(F.col(text_col)).alias("_size"))


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, limit: float = MAX_COPIES) -> DataFrame:
    """``sources`` (``_none, _source, _total``) with ``_target``.

    Sources by code point, null last, take the weights in turn; the whole size is
    shared by weight, a target stops at ``limit`` times its source's size and the
    excess is shared again by weight until none is above.
    """
    ranked = with_rank(sources, [F.col("_none"), F.col("_source")], "mix-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.select(*_KEY, "_total", weight.alias("_w"), (F.col("_total") * float(limit)).alias("_cap"))
    level, full = 0.0, -1
    while True:  # one small aggregate a round; each round but the last fills a source
        over = F.col("_w") * F.lit(level) >= F.col("_cap")
        r = ranked.agg(F.sum("_total").alias("all"), F.sum(F.when(over, F.col("_cap")).otherwise(0.0)).alias("capped"),
                       F.sum(F.when(over, 0.0).otherwise(F.col("_w"))).alias("w"), F.count(F.when(over, 1)).alias("n")).first()
        if not r["all"] or not r["w"] or r["n"] == full:
            break
        full, level = r["n"], (r["all"] - r["capped"]) / r["w"]
    return ranked.select(*_KEY, "_total", F.least(F.col("_w") * F.lit(level), F.col("_cap")).alias("_target"))


def newton(counts: DataFrame, goals: DataFrame, tolerance: float = TOLERANCE, rounds: int = 60) -> DataFrame:
    """``goals`` with ``_lambda``: the dual solved for every source (null where nothing is taken).

    ``counts``: ``_none, _source, _size, _n``. Each round is a job over the
    counts that sums gradient and curvature per source; the driver sees only the largest
    relative error.
    """
    state = goals.withColumn("_lambda", F.when((F.col("_target") > 0) & (F.col("_total") > 0), F.lit(0.0)))
    for k in range(rounds):
        tokens = F.col("_n") * F.col("_size") * F.exp("_lambda")
        now = counts.join(state, _KEY).groupBy(*_KEY).agg(F.sum(tokens).alias("_tokens"))
        # d/dlambda of size * exp(lambda) is itself: gradient tokens - target, curvature tokens.
        step = (F.col("_target") - F.col("_tokens")) / F.col("_tokens")
        state = stage(state.join(now, _KEY, "left").select(
            *_KEY, "_total", "_target", (F.col("_lambda") + step).alias("_lambda"),
            F.abs((F.col("_tokens") - F.col("_target")) / F.col("_target")).alias("_error")), f"mix-newton{k}")
        worst = state.agg(F.max("_error")).first()[0]
        state = state.drop("_error")
        if worst is None or worst < tolerance:
            break
    return state


def balance(docs: DataFrame, goals: DataFrame, shares: Mapping[str, Mapping[str, float]], text_col: str = "text", source_col: str = "source",
            tolerance: float = TOLERANCE, rounds: int = 60) -> tuple[DataFrame, dict[tuple[str, str], float]]:
    """Rates under the token targets of the sources and, at once, wanted shares of all tokens by further columns.

    ``goals`` is the result of ``targets``; ``shares`` maps a column to its values' wanted shares of the
    sum of all targets, for example ``{"lang": {"en": 0.6, "de": 0.2}}`` (at most ``MAX_MOMENTS`` values in all). The rates
    exp(lambda of the source + sum of the mu of the document's values) are nearest to "every document once" in
    token-weighted relative entropy among all that meet both. Returns the staged rates ``_none, _source, _values, _size, _n,
    _rate`` per kind of document (``_values``: which wanted values it has) and the mu by (column, value).

    The moments couple the sources, so each Newton step solves the full system: its Hessian has one
    diagonal entry per source, bordered by the moments. The sources' part is eliminated by a sum over them
    (Schur complement), the driver solves the moments' part, of bounded size, and all sources step in one job.
    Wanted values that no document has, or only documents of sources without a target, are left out. Goals that contradict each other have no
    solution: the rates are those after ``rounds`` steps, and a ValueError tells so.
    """
    wanted = [(c, v, float(x)) for c, values in shares.items() for v, x in values.items()]
    if len(wanted) > MAX_MOMENTS:
        raise ValueError(f"{len(wanted)} wanted values, at most {MAX_MOMENTS}")
    has = F.array(*[F.coalesce(F.col(c).cast("string") == F.lit(v), F.lit(False)) for c, v, _ in wanted]) if wanted else F.array().cast("array<boolean>")
    rows = docs.select(F.col(source_col).isNull().alias("_none"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_source"),
                       has.alias("_values"), words(F.col(text_col)).alias("_size"))
    counts = stage(rows.groupBy(*_KEY, "_values", "_size").agg(F.count(F.lit(1)).alias("_n")), "mix-kinds")
    state = goals.select(*_KEY, "_target", F.when((F.col("_target") > 0) & (F.col("_total") > 0), F.lit(0.0)).alias("_lambda"))
    total = goals.agg(F.sum("_target")).first()[0] or 0.0
    k, goal = len(wanted), np.array([x * total for *_, x in wanted])
    mu, worst = np.zeros(k), 0.0

    def tilt(lam: Column) -> Column:
        return F.exp(lam + sum((F.when(F.col("_values")[i], F.lit(float(m))).otherwise(0.0) for i, m in enumerate(mu)), F.lit(0.0)))
    for turn in range(rounds):
        tokens = F.col("_n") * F.col("_size") * tilt(F.col("_lambda"))
        now = counts.join(state.where("_lambda is not null"), _KEY).withColumn("_t", tokens)
        both = [F.sum(F.when(F.col("_values")[i] & F.col("_values")[j], F.col("_t")).otherwise(0.0)).alias(f"_m{i}_{j}") for i in range(k) for j in range(i + 1)]
        per = stage(now.groupBy(*_KEY, "_target", "_lambda").agg(F.sum("_t").alias("_t"), *both), f"mix-moments{turn}")
        v = [F.col(f"_m{i}_{i}") for i in range(k)]  # of indicators, the square is the sum
        gap = F.col("_target") - F.col("_t")
        sums = per.agg(F.max(F.abs(gap) / F.col("_target")).alias("worst"), *[F.sum(f"_m{i}_{j}").alias(f"m{i}_{j}") for i in range(k) for j in range(i + 1)],
                       *[F.sum(v[i] * v[j] / F.col("_t")).alias(f"s{i}_{j}") for i in range(k) for j in range(i + 1)],
                       *[F.sum(v[i] * gap / F.col("_t")).alias(f"g{i}") for i in range(k)]).first()
        if sums["worst"] is None:
            break
        square = lambda c: np.array([[sums[f"{c}{max(i, j)}_{min(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
        moments = square("m")
        known = np.diag(moments) > 0 if k else np.zeros(0, bool)
        error = np.where(known, goal - np.diag(moments), 0.0) if k else goal
        worst = max(sums["worst"], float(np.max(np.abs(error) / np.maximum(goal, 1.0), initial=0.0)))
        if worst < tolerance:
            break
        # Constraints may depend on one another (shares that add up to all tokens), hence the pseudo-inverse.
        right = np.where(known, error - np.array([sums[f"g{i}"] for i in range(k)]), 0.0) if k else error
        step = np.linalg.pinv(moments - square("s"), rcond=1e-10) @ right if k else error
        step = np.clip(step, -MAX_STEP, MAX_STEP)
        own = (gap - sum((v[i] * float(step[i]) for i in range(k)), F.lit(0.0))) / F.col("_t")
        state = stage(per.select(*_KEY, "_target", (F.col("_lambda") + F.least(F.greatest(own, F.lit(-MAX_STEP)), F.lit(MAX_STEP))).alias("_lambda")), f"mix-step{turn}")
        mu = mu + step
    else:
        raise ValueError(f"the wanted shares and targets contradict each other: still {worst:.2g} away after {rounds} steps")
    rates = counts.join(state.select(*_KEY, "_lambda"), _KEY, "left")
    rates = rates.withColumn("_rate", F.coalesce(tilt(F.col("_lambda")), F.lit(0.0))).drop("_lambda")
    return stage(rates, "mix-rates"), {(c, x): float(m) for (c, x, _), m in zip(wanted, mu)}


def _round_sizes(limit: int):
    def carry(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_size", ascending=False)
        error, out = 0.0, []
        for size, n, rate in zip(pdf["_size"], pdf["_n"], pdf["_rate"]):
            if size:
                want = n * rate + error / size
                copies = int(min(max(np.floor(want + 0.5), 0), limit * n))
                error = (want - copies) * size
            else:
                copies = int(min(np.floor(n * rate + 0.5), limit * n))
            out.append(copies)
        return pdf.assign(_copies=out)[["_none", "_source", "_size", "_n", "_copies"]]
    return carry


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, limit: int = MAX_COPIES) -> DataFrame:
    """One row per input row: ``id_col, source_col, size, source_size, target, rate, copies, taken``.

    ``size`` is the number of words (null text: 0), ``copies`` 0 to ``limit``,
    ``taken`` = copies * size. A null source is a source of its own. Rows that repeat an id
    are separate rows. The same rows give the same mix. Other columns are
    ignored; an empty table gives no rows. A source's rounding task holds one row per
    distinct document size, not its documents.
    """
    rows = stage(_rows(docs, id_col, text_col, source_col), "mix-rows")
    counts = stage(rows.groupBy(*_KEY, "_size").agg(F.count(F.lit(1)).alias("_n")), "mix-counts")
    sources = counts.groupBy(*_KEY).agg(F.sum(F.col("_n") * F.col("_size")).alias("_total"))
    solved = newton(counts, targets(sources, weights, limit)).withColumn("_rate", F.coalesce(F.exp("_lambda"), F.lit(0.0)))
    solved = stage(solved.withColumn("_rate", F.least("_rate", F.lit(float(limit)))), "mix-solved")
    sizes = counts.join(solved.select(*_KEY, "_rate"), _KEY).groupBy(*_KEY).applyInPandas(
        _round_sizes(limit), "_none boolean, _source string, _size long, _n long, _copies long")
    buckets = F.ceil(F.col("_n") / BUCKET_ROWS)
    sizes = stage(sizes.withColumn("_more", F.col("_copies") % F.col("_n")).withColumn("_buckets", buckets), "mix-sizes")
    on = [*_KEY, "_size"]
    wide = rows.join(F.broadcast(sizes) if fits_broadcast(sizes, 96) else sizes, on)
    order = F.xxhash64(F.lit("copies"), "_id")
    wide = wide.withColumn("_bucket", F.pmod(order, F.col("_buckets")))
    part = wide.where("_more > 0 and _buckets > 1").groupBy(*on, "_bucket").agg(F.count(F.lit(1)).alias("_here"))
    ahead = part.withColumn("_ahead", F.sum("_here").over(Window.partitionBy(*on).orderBy("_bucket")) - F.col("_here")).drop("_here")
    ranked = wide.where("_more > 0").join(ahead, [*on, "_bucket"], "left")
    place = F.row_number().over(Window.partitionBy(*on, "_bucket").orderBy(order, "_id")) - 1 + F.coalesce("_ahead", F.lit(0))
    ranked = ranked.withColumn("_extra", F.when(place < F.col("_more"), 1).otherwise(0)).drop("_ahead")
    every = ranked.unionByName(wide.where("_more = 0").withColumn("_extra", F.lit(0)))
    copies = (F.floor(F.col("_copies") / F.col("_n")) + F.col("_extra")).cast("long")
    few = F.broadcast(solved) if fits_broadcast(solved, 96) else solved
    return every.withColumn("copies", copies).join(few, _KEY).select(
        F.col("_id").alias(id_col), F.when(~F.col("_none"), F.col("_source")).alias(source_col), F.col("_size").alias("size"),
        F.col("_total").alias("source_size"), F.col("_target").alias("target"), F.col("_rate").alias("rate"), "copies",
        (F.col("copies") * F.col("_size")).alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: Sequence[float] = WEIGHTS, limit: int = MAX_COPIES) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it (not at all for 0 copies).

    Rows that share id, source and size share the larger of their copies.
    """
    columns = docs.columns
    chosen = mix(docs, id_col, text_col, source_col, weights, limit).groupBy(
        F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), F.col("size").alias("__size")).agg(F.max("copies").alias("__copies"))
    rows = docs.select(F.struct(*[docs[c] for c in columns]).alias("__row"), docs[id_col].alias("_i"),
                       docs[source_col].cast("string").alias("_s"), words(docs[text_col]).alias("_n"))
    same = F.col("_i").eqNullSafe(F.col("__id")) & F.col("_s").eqNullSafe(F.col("__source")) & (F.col("_n") == F.col("__size"))
    return (rows.join(chosen, same).where("__copies > 0")
            .select("__row", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))).alias("__copy")).select("__row.*"))
