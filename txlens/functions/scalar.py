"""Scalar column functions (G1-G25, B11, B12): all native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- rounding (G10) ---------------------------------------------------------

def round_half_up(x: ColumnOrName, digits: int) -> Column:
    """Round on the decimal value, half away from zero, back to double.

    ``round(double)`` differs between engines (decimal text vs binary value);
    going through ``decimal(38,6)`` gives the same result everywhere.
    NaN / Inf (not representable as decimal) become null.
    """
    return F.round(_c(x).try_cast("decimal(38,6)"), digits).cast("double")


def sql_round(expr: str, digits: int) -> str:
    """The SQL twin of :func:`round_half_up` (used by oracle queries)."""
    # via the shortest decimal text of the double, as Spark's double -> decimal cast
    return f"CAST(ROUND(TRY_CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


# --- null / NaN / Inf (B11) -------------------------------------------------

def finite_or_null(x: ColumnOrName) -> Column:
    """+-Inf and NaN -> null (pandas treats both as missing)."""
    c = _c(x)
    return F.when(F.isnan(c) | c.isin(float("inf"), float("-inf")), F.lit(None)).otherwise(c)


# --- safe ratios (B12, three variants of section 1.4) -----------------------

def ratio_or_zero(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b with +-Inf and NaN (and null) -> 0."""
    a, b = _c(a), _c(b)
    q = F.try_divide(a.cast("double"), b.cast("double"))
    return F.coalesce(finite_or_null(q), F.lit(0.0))


def ratio_denominator_one(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / (b, with 0 replaced by 1); Inf / NaN / null -> 0."""
    a, b = _c(a), _c(b)
    den = F.when(b == 0, F.lit(1.0)).otherwise(b.cast("double"))
    return F.coalesce(finite_or_null(a.cast("double") / den), F.lit(0.0))


def ratio_when_positive(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b only where b > 0, else 0."""
    a, b = _c(a), _c(b)
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def clip(x: ColumnOrName, lo: float, hi: float) -> Column:
    """G12."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), _c(x)))


# --- date parts (G1-G8) -----------------------------------------------------

def weekday_monday0(ts: ColumnOrName) -> Column:
    """Monday = 0 ... Sunday = 6 (Spark ``weekday``)."""
    return F.weekday(_c(ts))


def is_weekend(ts: ColumnOrName) -> Column:
    """1 on Saturday / Sunday, 0 otherwise and for null dates."""
    return F.coalesce(weekday_monday0(ts).isin(5, 6).cast("int"), F.lit(0))


def is_night(ts: ColumnOrName) -> Column:
    """1 for hours 0-5, 0 otherwise and for null dates."""
    return F.coalesce(F.hour(_c(ts)).between(0, 5).cast("int"), F.lit(0))


def full_days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole 24-hour periods from start to end (not midnights crossed)."""
    return F.timestamp_diff("DAY", _c(start), _c(end))


def datetime_parts(ts: str = "transaction_date") -> list[Column]:
    """G7 ``extract_datetime_features``: hour, weekday, day, month, weekend, night."""
    return [
        F.hour(ts).alias("hour"),
        weekday_monday0(ts).alias("day_of_week"),
        F.dayofmonth(ts).alias("day_of_month"),
        F.month(ts).alias("month"),
        is_weekend(ts).alias("is_weekend"),
        is_night(ts).alias("is_night"),
    ]


# --- bands and labels (G16-G20) ---------------------------------------------

# Loading-strength band labels and edges (right-closed bins).
LOADING_BANDS = [(0.0, 0.3, "Faible"), (0.3, 0.6, "Moyenne"), (0.6, 0.8, "Forte"), (0.8, 1.0, "Très forte")]


def loading_band(x: ColumnOrName) -> Column:
    """Right-closed bins (0, .3], (.3, .6], (.6, .8], (.8, 1]; 0 and > 1 -> null."""
    c = _c(x)
    out = F.lit(None).cast("string")
    for lo, hi, label in reversed(LOADING_BANDS):
        out = F.when((c > lo) & (c <= hi), F.lit(label)).otherwise(out)
    return out


def representation_quality(cos2: ColumnOrName) -> Column:
    """G17: 'Bonne' above .5, 'Moyenne' above .3, else 'Faible'."""
    c = _c(cos2)
    return F.when(c > 0.5, "Bonne").when(c > 0.3, "Moyenne").otherwise("Faible")


# KMO interpretation labels and lower bounds.
KMO_BANDS = [(0.9, "Mervelous"), (0.8, "Meritorious"), (0.7, "Middling"), (0.6, "Mediocre"), (0.5, "Miserable")]
KMO_DEFAULT = "Inacceptable"


def kmo_label(value: float) -> str:
    """G18 for the one KMO value of a fit (a driver-side scalar)."""
    for lo, label in KMO_BANDS:
        if value >= lo:
            return label
    return KMO_DEFAULT


def kmo_label_col(x: ColumnOrName) -> Column:
    c = _c(x)
    out = F.lit(KMO_DEFAULT)
    for lo, label in reversed(KMO_BANDS):
        out = F.when(c >= lo, F.lit(label)).otherwise(out)
    return out


def severity(score: ColumnOrName, threshold: ColumnOrName) -> Column:
    """The reference colours scores above 1.5 t red and above t yellow.

    Re-aimed as a label column: 'high' above 1.5 t, 'elevated' above t, else
    'normal' (1.5 t only grades upward when t > 0, as in the reference).
    """
    s, t = _c(score), _c(threshold)
    return F.when(s > t * 1.5, "high").when(s > t, "elevated").otherwise("normal")


# Direction labels of an attribution.
IMPACT_UP = "Augmente anomalie"
IMPACT_DOWN = "Réduit anomalie"


def impact_label(shap_value: ColumnOrName) -> Column:
    """Direction of an attribution."""
    return F.when(_c(shap_value) > 0, IMPACT_UP).otherwise(IMPACT_DOWN)
