"""Hour -> day rollups.

One ``groupBy(key, date)`` with partial (map-side) aggregation computes the
15 named aggregates.  The "mean of the last 6 rows of the day" needs row
order; it is computed from a ``row_number() <= 6`` filter, which Spark turns
into a partial ``WindowGroupLimit`` before the shuffle, so at most 6 rows per
(key, day) and input partition cross the network even for a hot key-day.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlens.operators.clean import _as_list

# (output name, input column, aggregate)
DAILY_SPEC = [
    ("aqi_mean", "aqi", "mean"),
    ("aqi_max", "aqi", "max"),
    ("aqi_min", "aqi", "min"),
    ("aqi_std", "aqi", "std"),
    ("pm2_5_mean", "pm2_5", "mean"),
    ("pm10_mean", "pm10", "mean"),
    ("temp_mean", "temperature", "mean"),
    ("temp_max", "temperature", "max"),
    ("temp_min", "temperature", "min"),
    ("humidity_mean", "humidity", "mean"),
    ("wind_mean", "wind_speed", "mean"),
    ("wind_max", "wind_speed", "max"),
    ("pressure_mean", "pressure", "mean"),
    ("precip_sum", "precipitation", "sum"),
]

FORECAST_SPEC = [
    ("temp_mean", "temperature", "mean"),
    ("humidity_mean", "humidity", "mean"),
    ("wind_mean", "wind_speed", "mean"),
    ("pressure_mean", "pressure", "mean"),
    ("precip_sum", "precipitation", "sum"),
]


def _agg(kind: str, c: str, present: bool, parity_count: bool):
    if not present:
        # Q09: an absent precipitation column gives NULL (parity: row count).
        return F.count(F.lit(1)).cast("double") if parity_count else F.lit(None).cast("double")
    x = F.col(c)
    if kind == "mean":
        return F.avg(x)
    if kind == "max":
        return F.max(x)
    if kind == "min":
        return F.min(x)
    if kind == "std":
        return F.coalesce(F.stddev_samp(x), F.lit(0.0))      # A03: n=1 -> 0
    if kind == "sum":
        return F.coalesce(F.sum(x).cast("double"), F.lit(0.0))  # A04: all-null -> 0
    raise ValueError(kind)


def last_n_mean(df: DataFrame, key, ts: str, value: str, n: int = 6,
                date_col: str = "date", out: str = "aqi_last6h") -> DataFrame:
    """Mean of the last ``n`` rows (by ``ts``) of each (key, day); all
    rows when a day has fewer.  Ties on ``ts`` are broken by the value, so
    the result is deterministic."""
    keys = _as_list(key)
    w = Window.partitionBy(*keys, date_col).orderBy(F.col(ts).desc(), F.col(value).desc())
    top = (df.select(*keys, date_col, ts, value)
             .withColumn("_rn", F.row_number().over(w))
             .where(F.col("_rn") <= n))
    return top.groupBy(*keys, date_col).agg(F.avg(value).alias(out))


def last_hours_mean(df: DataFrame, key, ts: str, value: str, hours: int = 6,
                    date_col: str = "date", out: str = "aqi_last6h") -> DataFrame:
    """A02 by time: mean over the ``hours`` hours up to the last reading of
    each (key, day), so a gap leaves readings out instead of reaching further
    back.  Two partial aggregates and a join on the day's last time; no task
    sorts a day."""
    keys = _as_list(key)
    rows = df.select(*keys, date_col, ts, value)
    end = rows.groupBy(*keys, date_col).agg(F.max(ts).alias("_end"))
    recent = rows.join(end, keys + [date_col]).where(F.col(ts) > F.col("_end") - F.make_dt_interval(F.lit(0), F.lit(hours)))
    return recent.groupBy(*keys, date_col).agg(F.avg(value).alias(out))


def daily_rollup(readings: DataFrame, key="city", ts: str = "timestamp",
                 spec=None, last_n: int | None = 6, parity_count: bool = False,
                 hours: int | None = None) -> DataFrame:
    """(key, date) grain with named aggregates; A02 joined on the same
    grain (both sides are one row per key-day), over the last ``last_n`` rows
    or, with ``hours``, over the last hours."""
    keys = _as_list(key)
    spec = DAILY_SPEC if spec is None else spec
    df = readings.withColumn("date", F.to_date(F.col(ts)))
    cols = set(df.columns)
    aggs = [_agg(k, c, c in cols, parity_count).alias(name) for name, c, k in spec]
    daily = df.groupBy(*keys, "date").agg(*aggs)
    if (last_n or hours) and "aqi" in cols:
        l6 = last_hours_mean(df, keys, ts, "aqi", hours) if hours else last_n_mean(df, keys, ts, "aqi", last_n)
        daily = daily.join(l6, keys + ["date"], "left")
        names = [s[0] for s in spec]
        pos = names.index("aqi_std") + 1 if "aqi_std" in names else len(names)
        ordered = names[:pos] + ["aqi_last6h"] + names[pos:]
        daily = daily.select(*keys, "date", *ordered)
    return daily


def forecast_daily(hourly_forecast: DataFrame, key="city", ts: str = "timestamp") -> DataFrame:
    """Forecast hours -> day (4 means + precipitation sum)."""
    return daily_rollup(hourly_forecast, key, ts, spec=FORECAST_SPEC, last_n=None)
