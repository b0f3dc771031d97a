"""Variants by time instead of by row: calendar lags (Q21) and last hours (Q23)."""
from __future__ import annotations

from pyspark.sql import functions as F

from airlens import constants as C
from airlens.operators import features as FE
from airlens.operators import rollup as RU
from airlens.plans import sqlparts as Q
from airlens.plans.base import register, round_cols, round_doubles
from airlens.sources import standins as V

_HOURS = ("SELECT r.city, r.date, avg(r.aqi) AS aqi_last6h FROM "
          "(SELECT city, CAST(\"timestamp\" AS DATE) AS date, \"timestamp\" AS ts, aqi FROM v1) r JOIN "
          "(SELECT city, CAST(\"timestamp\" AS DATE) AS date, max(\"timestamp\") AS last FROM v1 GROUP BY ALL) l "
          "ON r.city = l.city AND r.date = l.date AND r.ts > l.last - INTERVAL 6 HOUR GROUP BY ALL")


@register("a02_last_six_hours", Q.ctes(v1=Q.V1, h=_HOURS) + "SELECT city, date, round(aqi_last6h, 6) AS aqi_last6h FROM h")
def a02_last_six_hours(spark, sf_dir):
    """Irregular readings: the hours up to a day's last one, however few or
    many readings they hold."""
    r = V.event_readings(spark, sf_dir).withColumn("date", F.to_date("timestamp"))
    return round_cols(RU.last_hours_mean(r, "city", "timestamp", "aqi", 6), ["aqi_last6h"])


#: A series with every fifth day of the year missing.
_GAPS = "SELECT * FROM d0 WHERE dayofyear(date) % 5 <> 0"
_CALENDAR = ("SELECT k.city, CAST(k.date AS DATE) AS date, d.* EXCLUDE (city, date), d.city IS NOT NULL AS present FROM "
             "(SELECT city, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS date FROM g GROUP BY city) k "
             "LEFT JOIN g d ON d.city = k.city AND d.date = k.date")
_NAMES = [n for n, _ in Q.feature_exprs()] + ["fc_pressure_drop_d1"]


@register("w01_w11_calendar_days", Q.ctes(v3=Q.V3, d0=Q.daily("v3"), g=_GAPS, c=_CALENDAR, f=Q.features("c"))
          + "SELECT city, date, " + ", ".join(f"round({n}, 6) AS {n}" if n != "dow" else n for n in ["aqi_mean", *_NAMES])
          + " FROM f WHERE present")
def w01_w11_calendar_days(spark, sf_dir):
    """All lags, rolling frames, leads and targets by calendar day over a series
    with missing days; the twin joins a calendar and counts rows."""
    days = RU.daily_rollup(V.lineitem_readings(spark, sf_dir)).where("dayofyear(date) % 5 <> 0")
    out = FE.add_daily_features(days, densify=True).select("city", "date", "aqi_mean", *_NAMES)
    return round_doubles(out)


@register("c01_features_by_time", Q.ctes(v1=Q.V1, d0=Q.daily("v1"), h=_HOURS, l="SELECT max(date) AS last FROM d0",
                                         d="SELECT d0.* REPLACE (h.aqi_last6h AS aqi_last6h) FROM d0 JOIN h USING (city, date)",
                                         g="SELECT d.* FROM d, l WHERE day(date) % 9 <> 0 OR date = last", c=_CALENDAR, f=Q.features("c"))
          + f"SELECT {Q.select_rounded(['city', 'date'] + Q.DAILY_NAMES + _NAMES, set(Q.DAILY_NAMES + _NAMES) - {'dow'})} "
          + f"FROM f WHERE present AND {Q.not_null(sorted(set(C.FEATURE_COLS + C.TARGETS)))}")
def c01_features_by_time(spark, sf_dir):
    """The whole feature table with both variants, from readings that lack
    every ninth day of the month."""
    r = V.event_readings(spark, sf_dir)
    last = r.agg(F.max(F.to_date("timestamp")).alias("last")).scalar()
    day = F.to_date("timestamp")
    kept = r.where((F.dayofmonth(day) % 9 != 0) | (day == last))
    return round_doubles(FE.compute_features(kept, densify=True, hours=6).select("city", "date", *Q.DAILY_NAMES, *_NAMES))
