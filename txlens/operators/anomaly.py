"""Scaling, distance-based outlier scores, thresholds and anomaly reporting
(M1, M2, M5, M26-M30, M42, B17, D31, D36, F1, F2, G19).

Fitted statistics (means, population stds, thresholds) are lazy one-row
DataFrames cross-joined by broadcast: a proven single row, never a driver loop.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlens.functions.clean import drop_all_null_columns, fill_median
from txlens.operators.cache import cut
from txlens.functions.scalar import finite_or_null, round_half_up as R, severity
from txlens.operators.encode import top_values
from txlens.operators.joins import join_own, rows_of
from txlens.operators.quantiles import quantiles_df, row_ranks
from txlens.sources.schema import numeric_columns


# Coefficients of Acklam's rational approximation of the inverse
# normal distribution (relative error below 1.2e-9).
_CENTRE = ((-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02,
            -3.066479806614716e+01, 2.506628277459239e+00),
           (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01,
            -1.328068155288572e+01, 1.0))
_TAIL = ((-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00,
          4.374664141464968e+00, 2.938163982698783e+00),
         (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00, 1.0))
_TAIL_FROM = 0.02425


def inv_norm(p: Column) -> Column:
    """Standard-normal quantile as a column expression, 0 < p < 1."""
    def poly(coefficients, x):
        out = F.lit(coefficients[0])
        for c in coefficients[1:]:
            out = out * x + c
        return out
    q = p - 0.5
    centre = q * poly(_CENTRE[0], q * q) / poly(_CENTRE[1], q * q)
    t = F.sqrt(-2 * F.log(F.least(p, 1 - p)))
    tail = poly(_TAIL[0], t) / poly(_TAIL[1], t)
    return F.when(p < _TAIL_FROM, tail).when(p > 1 - _TAIL_FROM, -tail).otherwise(centre)


class Scaler:
    """M1 ``StandardScaler`` with population std; constant columns scale to 0.

    ``stats`` is a one-row DataFrame ``_mu_<c>``, ``_sd_<c>`` (lazy until used);
    ``transform`` reuses it, so a fitted scaler can be applied to new rows.
    """

    def __init__(self, cols: list[str], stats: DataFrame):
        self.cols = cols
        self.stats = stats

    @classmethod
    def fit(cls, df: DataFrame, cols: list[str] | None = None) -> "Scaler":
        cols = cols or numeric_columns(df)
        if not cols:
            raise ValueError("no numeric column to scale")
        aggs = []
        for c in cols:
            x = F.col(c).cast("double")
            aggs += [F.avg(x).alias(f"_mu_{c}"), F.stddev_pop(x).alias(f"_sd_{c}")]
        return cls(cols, df.agg(*aggs))

    def transform(self, df: DataFrame, keep: list[str] | None = None, suffix: str = "") -> DataFrame:
        keep = [c for c in (keep or []) if c in df.columns]
        j = df.crossJoin(F.broadcast(self.stats))
        out = []
        for c in self.cols:
            sd = F.col(f"_sd_{c}")
            z = (F.col(c).cast("double") - F.col(f"_mu_{c}")) / F.when((sd == 0) | sd.isNull(), F.lit(1.0)).otherwise(sd)
            out.append(z.alias(f"{c}{suffix}"))
        return j.select(*keep, *out)

    def save(self, path: str) -> None:
        """Persist the fitted statistics (Parquet)."""
        self.stats.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "Scaler":
        stats = spark.read.parquet(path)
        cols = [c[4:] for c in stats.columns if c.startswith("_mu_")]
        return cls(cols, stats)


def scale_features(df: DataFrame, cols: list[str] | None = None, keep: list[str] | None = None,
                   scaler: Scaler | None = None, suffix: str = "") -> tuple[DataFrame, Scaler]:
    """M1 / M2 ``scale_features``: fit (or reuse) a scaler and apply it."""
    scaler = scaler or Scaler.fit(df, cols)
    return scaler.transform(df, keep=keep, suffix=suffix), scaler


def prepare_for_anomaly_detection(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """M5 / M4: drop all-null and non-numeric columns, Inf -> null, median fill."""
    keys = [k for k in (keys or []) if k in df.columns]
    cols = [c for c in numeric_columns(df) if c not in keys]
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(finite_or_null(F.col(c).cast("double"))).alias(f"_f_{c}") for c in cols]).collect()[0]
    cols = [c for c in cols if row[f"_f_{c}"] > 0]  # columns without a finite value dropped
    if not cols:
        raise ValueError("no numeric column available")
    gaps = [c for c in cols if row[f"_f_{c}"] < row["_n"]]  # only these need a median
    num = df.select(*keys, *[(finite_or_null(F.col(c).cast("double")) if c in gaps else F.col(c).cast("double")).alias(c) for c in cols])
    return fill_median(num, gaps) if gaps else num


def prepare_numeric_data(df: DataFrame, drop_non_numeric: bool = True, fill_na: bool = True) -> DataFrame:
    """Numeric columns alone (or all, unchanged, without ``drop_non_numeric``), gaps of the numeric ones filled
    with their exact medians (or left). A column without any value stays null."""
    out = df.select(*numeric_columns(df)) if drop_non_numeric else df
    return fill_median(out, check_missing=True) if fill_na else out


def centre_distance(scaled_cols: list[str]) -> Column:
    """Euclidean norm of the scaled row (distance to the centre)."""
    return F.sqrt(sum((F.col(c) * F.col(c) for c in scaled_cols), F.lit(0.0)))


def distance_scores(df: DataFrame, cols: list[str], keys: list[str],
                    scaler: Scaler | None = None) -> DataFrame:
    """M28 on a feature table: (keys..., anomaly_score) with 6-digit rounding. ``keys`` may be any columns."""
    scaled, _ = scale_features(df, cols, keep=keys, scaler=scaler, suffix="_scaled")
    return scaled.select(*keys, R(centre_distance([f"{c}_scaled" for c in cols]), 6).alias("anomaly_score"))


def mahalanobis_scores(df: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """sqrt((x - mu)' S^-1 (x - mu)) with the sample covariance S.

    Mean vector and covariance come from one aggregate (p(p+1)/2 covariances);
    the p x p inverse is the only driver algebra (p = number of features); the
    quadratic form is a column expression evaluated on the executors.
    """
    p = len(cols)
    aggs = [F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]
    for i in range(p):
        for j in range(i, p):
            aggs.append(F.covar_samp(F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")).alias(f"c{i}_{j}"))
    row = df.agg(*aggs).collect()[0]
    mu = np.array([row[f"m{i}"] for i in range(p)], dtype=float)
    cov = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            cov[i, j] = cov[j, i] = row[f"c{i}_{j}"] or 0.0
    inv = np.linalg.pinv(cov)
    d = [F.col(c).cast("double") - F.lit(float(mu[i])) for i, c in enumerate(cols)]
    q = sum((F.lit(float(inv[i, j])) * d[i] * d[j] for i in range(p) for j in range(p) if inv[i, j] != 0.0),
            F.lit(0.0))
    return df.select(*keys, R(F.sqrt(F.greatest(q, F.lit(0.0))), 6).alias("anomaly_score"))


def score_threshold(scores: DataFrame, q: float, col: str = "anomaly_score", stored: bool = False) -> DataFrame:
    """One-row table with the linear-interpolated ``q`` percentile of the scores (``stored``: see ``quantiles_df``)."""
    return quantiles_df(scores, col, [q], names=["threshold"], stored=stored)


def flag_by_contamination(scores: DataFrame, contamination: float = 0.02,
                          col: str = "anomaly_score") -> DataFrame:
    """``is_anomaly`` = score above the (1 - c) percentile; c capped at 0.5."""
    c = min(contamination, 0.5)
    scores = cut(scores)  # the threshold and the flags read the same materialised scores
    thr = score_threshold(scores, 1.0 - c, col)
    return scores.crossJoin(F.broadcast(thr)).withColumn("is_anomaly", F.col(col) > F.col("threshold")) \
                 .drop("threshold")


def analyze_anomalies(raw: DataFrame, scores: DataFrame | None = None, score_threshold_value: float | None = None,
                      key: str = "transaction_id", col: str = "anomaly_score", ordered: bool = True, staged: bool = False,
                      above_only: bool = False) -> DataFrame:
    """Scores joined to the source rows by key; ``is_above_threshold`` at the
    given value or the 95th percentile; ``severity`` label (G19). Sorted by
    score descending (ties by key) unless not ``ordered``, for readers that need no order -
    call ``.orderBy`` again after further joins. The scores are read twice, by the threshold and by the join: they are
    written first unless they are ``staged`` already (a stored table or a projection of one). Without ``scores`` the rows of ``raw``,
    a projection of a stored table, carry their own in ``col``, and only rows that share their key are joined.
    ``above_only`` leaves out the rows below the threshold before they are joined."""
    if scores is None:
        own = raw.select(key, col)
    else:
        own = scores = scores if staged else cut(scores)
    if score_threshold_value is None:
        thr = score_threshold(own, 0.95, col, stored=scores is not None)
    else:
        thr = raw.sparkSession.range(1).select(F.lit(float(score_threshold_value)).alias("threshold"))
    labels = {"is_above_threshold": F.col(col) >= F.col("threshold"), "severity": severity(col, "threshold"), "threshold": R("threshold", 6)}

    def labelled(rows: DataFrame) -> DataFrame:
        out = rows.crossJoin(F.broadcast(thr)).select(*rows.columns, *[v.alias(c) for c, v in labels.items()])
        out = out.select(*rows.columns, "threshold", "is_above_threshold", "severity")
        return out.where("is_above_threshold") if above_only else out
    if scores is None:
        j = labelled(join_own(raw, key, col))
    elif above_only:
        j = rows_of(raw, scores := labelled(scores), key).join(scores, key, "inner")
    else:
        j = raw.join(labelled(scores), key, "inner")
    return j.orderBy(F.desc(col), F.asc(key)) if ordered else j


def anomaly_statistics(scores: DataFrame, col: str = "anomaly_score", flag: str = "is_anomaly") -> DataFrame:
    """D31 ``get_anomaly_statistics``: one row, population std, rounded to 4 digits."""
    mom = scores.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.sum(F.col(flag).cast("long")).alias("n_anomalies"),
        R(F.sum(F.col(flag).cast("long")) * 100.0 / F.count(F.lit(1)), 4).alias("pct_anomalies"),
        R(F.avg(col), 4).alias("score_mean"), R(F.stddev_pop(col), 4).alias("score_std"),
        R(F.min(col), 4).alias("score_min"), R(F.max(col), 4).alias("score_max"))
    qs = quantiles_df(scores, col, [0.5, 0.25, 0.75, 0.95, 0.99],
                      names=["score_median", "score_q25", "score_q75", "score_q95", "score_q99"])
    return mom.crossJoin(qs.select(*[R(F.col(c), 4).alias(c) for c in qs.columns]))


def top_anomalies(analyzed: DataFrame, k: int = 20, col: str = "anomaly_score",
                  key: str = "transaction_id", columns: list[str] | None = None) -> DataFrame:
    """the ``k`` highest-scoring rows above the threshold (TakeOrderedAndProject)."""
    cols = columns or [c for c in ("transaction_id", "user_id", "transaction_date", "product_category",
                                   "product_amount", "cashback", "payment_method") if c in analyzed.columns]
    cols = [c for c in cols if c != col] + [col, "severity"]
    return analyzed.where("is_above_threshold").orderBy(F.desc(col), F.asc(key)).limit(k).select(*cols)


def anomaly_patterns(analyzed: DataFrame, cols: tuple[str, ...] = ("product_category", "payment_method"),
                     n: int = 10) -> DataFrame:
    """Value mix of the rows above the threshold, top ``n`` per attribute (long)."""
    flagged = analyzed.where("is_above_threshold")
    parts = [top_values(flagged, c, n).select(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value"),
                                              "count")
             for c in cols if c in analyzed.columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def suggest_contamination(distances: DataFrame, col: str = "anomaly_score",
                          percentiles: tuple[float, ...] = (95, 97.5, 99, 99.5)) -> DataFrame:
    """Mean share of rows strictly beyond each percentile of the centre
    distance (4 digits each), clamped to [0.001, 0.1]. One row."""
    names = [f"t{i}" for i in range(len(percentiles))]
    thr = quantiles_df(distances, col, [p / 100.0 for p in percentiles], names=names)
    j = distances.crossJoin(F.broadcast(thr))
    shares = j.agg(*[R(F.sum((F.col(col) > F.col(t)).cast("long")) / F.count(F.lit(1)), 4).alias(f"s{i}")
                     for i, t in enumerate(names)])
    mean = sum((F.col(f"s{i}") for i in range(len(names))), F.lit(0.0)) / F.lit(float(len(names)))
    return shares.select(*[F.col(f"s{i}").alias(f"share_p{str(p).replace('.', '_')}") for i, p in enumerate(percentiles)],
                         R(F.least(F.greatest(mean, F.lit(0.001)), F.lit(0.1)), 6).alias("suggested_contamination"))


def anomaly_report(analyzed: DataFrame, contamination: float, n_features: int, col: str = "anomaly_score",
                   key: str = "transaction_id", date_col: str = "transaction_date", top: int = 5) -> DataFrame:
    """Report table (section, item, metric, value) of scored source rows (``analyze_anomalies``).

    ``data``: rows, features, first and last day; ``result``: rows flagged at ``contamination`` and their share, mean and
    largest score, the threshold and the rows at or above it; ``distribution``: quartiles and the 95 and
    99 percentiles; ``top``: score, amount, category and user of the ``top`` highest rows above the threshold
    (item: their rank); ``quality``: the mean score's distance to the mean of the rows not flagged, relative to the mean
    score. Values are texts, numbers with up to 4 digits. The rows are written once and read by every part.
    """
    details = [c for c in ("product_amount", "product_category", "user_id") if c in analyzed.columns]
    days = [date_col] if date_col in analyzed.columns else []
    rows = cut(analyzed.select(key, col, "threshold", "is_above_threshold", *details, *days))
    c = min(contamination, 0.5)
    limits = quantiles_df(rows, col, [1.0 - c, 0.25, 0.5, 0.75, 0.95, 0.99], names=["_limit", "q25", "median", "q75", "q95", "q99"])
    flag = F.col(col) > F.col("_limit")
    number = lambda x: F.rtrim(F.rtrim(F.format_string("%.4f", R(x, 4).cast("double")), F.lit("0")), F.lit("."))
    day = lambda x: F.coalesce(F.date_format(x, "yyyy-MM-dd"), F.lit("not given")) if days else F.lit("not given")
    one = rows.crossJoin(F.broadcast(limits)).agg(  # limits: one row
        F.count(F.lit(1)).alias("n"), F.count_if(flag).alias("flagged"), F.avg(col).alias("mean"), F.max(col).alias("largest"),
        F.max("threshold").alias("threshold"), F.count_if("is_above_threshold").alias("above"), F.avg(F.when(~flag, F.col(col))).alias("normal"),
        *[F.max(x).alias(x) for x in ("q25", "median", "q75", "q95", "q99")],
        (F.min(date_col) if days else F.lit(None).cast("date")).alias("first"), (F.max(date_col) if days else F.lit(None).cast("date")).alias("last"))
    said = [("data", "transactions", F.col("n").cast("string")), ("data", "features", F.lit(str(n_features))), ("data", "first_day", day("first")),
            ("data", "last_day", day("last")), ("result", "contamination", number(F.lit(float(contamination)))), ("result", "anomalies", F.col("flagged").cast("string")),
            ("result", "anomaly_pct", number(F.col("flagged") * 100.0 / F.col("n"))), ("result", "mean_score", number(F.col("mean"))),
            ("result", "largest_score", number(F.col("largest"))), ("result", "threshold", number(F.col("threshold"))),
            ("result", "rows_above_threshold", F.col("above").cast("string")),
            *[("distribution", x, number(F.col(x))) for x in ("q25", "median", "q75", "q95", "q99")],
            ("quality", "score_separation", number((F.col("mean") - F.col("normal")) / F.col("mean")))]
    summary = one.where("n > 0").select(F.inline(F.array(*[F.struct(F.lit(a).alias("section"), F.lit(None).cast("int").alias("item"), F.lit(b).alias("metric"),
                                                                   v.alias("value")) for a, b, v in said])))
    best = rows.where("is_above_threshold").orderBy(F.desc(col), F.asc(key)).limit(top)
    best = best.withColumn("item", F.row_number().over(Window.orderBy(F.desc(col), F.asc(key))))  # top rows at most
    show = {key: F.col(key).cast("string"), "score": number(F.col(col)), "product_amount": None, "product_category": None, "user_id": None}
    show |= {x: (number(F.col(x)) if x == "product_amount" else F.coalesce(F.col(x).cast("string"), F.lit("unknown"))) for x in details}
    top_rows = best.select(F.inline(F.array(*[F.struct(F.lit("top").alias("section"), F.col("item").alias("item"), F.lit(name).alias("metric"), v.alias("value"))
                                              for name, v in show.items() if v is not None])))
    return summary.unionByName(top_rows)


def qq_points(scored: DataFrame, col: str = "anomaly_score", flag: str = "is_anomaly") -> DataFrame:
    """QQ data of the normal rows' scores: the i-th smallest score against
    the standard-normal quantile at ``linspace(0.01, 0.99, n)[i]``.

    Every normal row gets its point; the ranks come from counted values, so ties
    of any number do not meet in one task.
    """
    vals = scored.where(~F.col(flag)).select(F.col(col).cast("double").alias("v"))
    ranked = row_ranks(vals, "v")
    n = vals.agg(F.count(F.nanvl("v", F.lit(None))).alias("_n"))  # one row
    prob = F.lit(0.01) + F.lit(0.98) * F.col("_rank") / F.greatest(F.col("_n") - 1, F.lit(1))
    return ranked.crossJoin(F.broadcast(n)).select(
        F.col("_rank").alias("rank"), F.col("v").alias("sample_quantile"), prob.alias("probability"),
        inv_norm(prob).alias("theoretical_quantile"))
