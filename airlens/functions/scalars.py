"""Column expressions (F01-F16).  Everything is a native Spark expression,
so it stays inside whole-stage codegen; no Python UDFs."""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from airlens import constants as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F01 -------------------------------------------------------------------------
def day_of(ts) -> Column:
    return F.to_date(col(ts))


# F02 -------------------------------------------------------------------------
def month_sin(d) -> Column:
    return F.sin(F.lit(2 * math.pi) * F.month(col(d)) / F.lit(12.0))


def month_cos(d) -> Column:
    return F.cos(F.lit(2 * math.pi) * F.month(col(d)) / F.lit(12.0))


# F03 -------------------------------------------------------------------------
def dow_monday0(d) -> Column:
    """Day of week with Monday = 0 (``weekday``; ``dayofweek`` is Sunday = 1)."""
    return F.weekday(col(d))


# F04 -------------------------------------------------------------------------
def _band_struct(low, high, label, bg, fg) -> Column:
    return F.struct(F.lit(label).alias("label"), F.lit(bg).alias("bg_color"),
                    F.lit(fg).alias("text_color"), F.lit(low).alias("low"),
                    F.lit(high).alias("high"))


def aqi_category(x, parity: bool = False) -> Column:
    """AQI value -> struct(label, bg_color, text_color, low, high).

    Negative values count as 0.  Default bands are contiguous (a value in
    (50, 51) is Moderate).  ``parity=True`` reproduces the integer-edge test
    ``low <= v <= high``, under which fractional values between bands fall to
    the Hazardous fallback.  NULL stays NULL.
    """
    v = F.greatest(F.lit(0.0), col(x).cast("double"))
    expr = None
    prev_high = None
    for low, high, label, bg, fg in C.AQI_BANDS:
        cond = v.between(low, high) if parity else (v <= F.lit(float(high)))
        if not parity and prev_high is not None:
            cond = (v > F.lit(float(prev_high))) & cond
        s = _band_struct(low, high, label, bg, fg)
        expr = F.when(cond, s) if expr is None else expr.when(cond, s)
        prev_high = high
    expr = expr.otherwise(_band_struct(*C.AQI_FALLBACK))
    return F.when(col(x).isNotNull(), expr)


def aqi_label(x, parity: bool = False) -> Column:
    return aqi_category(x, parity)["label"]


def category_severity(label) -> Column:
    """Ordinal of a band label (0 = Good ... 5 = Hazardous)."""
    m = F.create_map(*[a for i, b in enumerate(C.AQI_BANDS) for a in (F.lit(b[2]), F.lit(i))])
    return m[col(label)]


# F05 -------------------------------------------------------------------------
def health_advice(label) -> Column:
    m = F.create_map(*[a for k, v in C.HEALTH_ADVICE.items() for a in (F.lit(k), F.lit(v))])
    return F.coalesce(m[col(label)], F.lit(C.HEALTH_ADVICE[C.HEALTH_ADVICE_DEFAULT]))


# F06 -------------------------------------------------------------------------
def confidence(target) -> Column:
    m = F.create_map(*[a for k, v in C.PREDICTION_CONFIDENCE.items() for a in (F.lit(k), F.lit(v))])
    return F.coalesce(m[col(target)], F.lit(C.CONFIDENCE_DEFAULT))


# F07 -------------------------------------------------------------------------
def clamp_non_negative(x) -> Column:
    return F.greatest(F.lit(0.0), col(x))


# Q08 -------------------------------------------------------------------------
def round_half_even(x, digits: int) -> Column:
    """Half-even rounding of the binary value scaled by 10^d, as numpy and
    pandas ``round`` do (0.25 -> 0.2; 13.15 stored as 13.1499.. -> 13.2
    because 13.1499.. * 10 is exactly 131.5).  ``F.bround`` alone rounds
    the decimal text and differs on such values."""
    p = float(10 ** digits)
    return F.bround(col(x) * p, 0) / p


# F08 -------------------------------------------------------------------------
def forecast_error(predicted, actual, digits: int = 1) -> Column:
    return round_half_even(col(predicted) - col(actual), digits)


def accuracy_pct(predicted, actual, digits: int = 1) -> Column:
    """clip(1 - |rounded error| / actual, 0, 1) * 100, actual 0 -> 1."""
    abs_err = round_half_even(F.abs(forecast_error(predicted, actual, digits)), digits)
    base = F.when(col(actual) == 0, F.lit(1.0)).otherwise(col(actual))
    ratio = F.lit(1.0) - abs_err / base
    return round_half_even(F.least(F.lit(1.0), F.greatest(F.lit(0.0), ratio)) * 100, digits)


# F09 -------------------------------------------------------------------------
def error_tier(err) -> Column:
    a = F.abs(col(err))
    return (F.when(a > C.ERROR_TIER_SEVERE, "severe")
             .when(a > C.ERROR_TIER_WARN, "warn")
             .when(a.isNotNull(), "ok"))


# F10 -------------------------------------------------------------------------
def gauge_pct(x) -> Column:
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), col(x) / 500.0 * 100.0))


# F11 -------------------------------------------------------------------------
def residual(actual, predicted) -> Column:
    return col(actual) - col(predicted)


# F12 -------------------------------------------------------------------------
def int_truncate(x) -> Column:
    return col(x).cast("int")


def int_round_half_even(x) -> Column:
    return round_half_even(x, 0).cast("int")


# F13 -------------------------------------------------------------------------
def fmt_day_short(d) -> Column:
    """'05 Jan 2024'"""
    return F.date_format(col(d), "dd MMM yyyy")


def fmt_day_long(d) -> Column:
    """'5 January 2024' (no leading zero)."""
    return F.date_format(col(d), "d MMMM yyyy")


# F14 -------------------------------------------------------------------------
def direction_phrase(v) -> Column:
    return F.when(col(v) > 0, F.lit(C.PHRASE_UP)).otherwise(F.lit(C.PHRASE_DOWN))


def contribution_phrase(feature, v) -> Column:
    """Magnitudes are rounded half to even before they are printed."""
    return F.format_string(C.PHRASE_FORMAT, col(feature), direction_phrase(v), round_half_even(F.abs(col(v)), 1))


# F15 -------------------------------------------------------------------------
def version_name(n) -> Column:
    return F.concat(F.lit("v"), col(n).cast("string"))


def artefact_name(target, n) -> Column:
    return F.concat_ws("_", col(target), version_name(n))


# F16 -------------------------------------------------------------------------
def fill_mean_then_zero(x, mean) -> Column:
    return F.coalesce(col(x), col(mean), F.lit(0.0))
