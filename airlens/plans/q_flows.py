"""Composite flow queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from airlens import constants as C
from airlens.operators import features as FE
from airlens.operators import rollup as RU
from airlens.plans import flows as FL
from airlens.plans import sqlparts as Q
from airlens.plans.base import DOUBLE_FEATURES, FEATURE_OUT, register, round_doubles
from airlens.plans.q_eval import ACT, PREDS
from airlens.sinks import store as ST
from airlens.sources import standins as V

def _feeds(spark, sf_dir):
    h = V.hourly_readings(spark, sf_dir)
    return h.select("city", "timestamp", *C.AQ_COLUMNS), h.select("city", "timestamp", *C.WEATHER_COLUMNS)


def _c02_sql():
    p, g = Q.gap_fill("rng", Q.MEASURES)
    feat_cols = [n for n, _ in Q.feature_exprs()] + ["fc_pressure_drop_d1"]
    keep = sorted(set(C.FEATURE_COLS + C.TARGETS))
    return (Q.ctes(v1=Q.V1, v2=Q.V2, rng=Q.range_null("v2", Q.MEASURES), rng_p=p, g=g,
                   r=f"SELECT * FROM g WHERE {Q.not_null(C.REQUIRED_COLUMNS)}", d=Q.daily("r"), f=Q.features("d"))
            + f"SELECT {Q.select_rounded(['city', 'date'] + Q.DAILY_NAMES + feat_cols, set(DOUBLE_FEATURES))} "
            + f"FROM f WHERE {Q.not_null(keep)}")


@register("c02_backfill", _c02_sql())
def c02_backfill(spark, sf_dir):
    """Ingest two feeds -> clean -> raw store -> features -> feature store,
    read back from the store."""
    aq, wx = _feeds(spark, sf_dir)
    base = ST.scratch_path(spark, "backfill")
    out = FL.backfill(spark, aq, wx, f"{base}/raw", f"{base}/features", "2024-02-01 00:00:00")
    return round_doubles(out.select(*FEATURE_OUT))


def _c03_sql():
    """History and the fresh days are cleaned apart, as the two runs do."""
    fc_cols = [f"fc_{n}_d{h}" for n, _ in Q.LEADS for h in (1, 2, 3)]
    parts = dict(v1=Q.V1, v2=Q.V2, pd='SELECT CAST(max("timestamp") AS DATE) - 6 AS as_of FROM v2')
    day = 'CAST("timestamp" AS DATE)'
    for run, rows in (("a", f"{day} < as_of - 3"), ("b", f"{day} BETWEEN as_of - 3 AND as_of - 1")):
        p, g = Q.gap_fill(f"r{run}", Q.MEASURES)
        parts |= {f"s{run}": f"SELECT v2.* FROM v2, pd WHERE {rows}", f"r{run}": Q.range_null(f"s{run}", Q.MEASURES),
                  f"r{run}_p": p, f"g{run}": g}
    raw = " UNION ALL ".join(f"SELECT * FROM g{run} WHERE {Q.not_null(C.REQUIRED_COLUMNS)}" for run in "ab")
    leads = ", ".join(f"max(CASE WHEN date = as_of - 1 + {h} THEN {s} END) AS fc_{n}_d{h}" for n, s in Q.LEADS for h in (1, 2, 3))
    last = ", row_number() OVER (PARTITION BY city ORDER BY date DESC) = 1 AS is_last"
    over = ", ".join(f"CASE WHEN is_last THEN coalesce(fc.{c}, l0.{c}) ELSE l0.{c} END AS {c}" for c in fc_cols)
    live = [c for c in FEATURE_OUT if c not in C.TARGETS and c not in ("city", "date")]
    merged = ", ".join(f"CASE WHEN l.city IS NOT NULL THEN l.{c} ELSE h.{c} END AS {c}" for c in live)
    parts |= dict(
        ha=f"SELECT * FROM ga WHERE {Q.not_null(C.REQUIRED_COLUMNS)}", da=Q.daily("ha"), fa=Q.features("da"),
        h=f"SELECT * FROM fa WHERE {Q.not_null(sorted(set(C.FEATURE_COLS + C.TARGETS)))}",
        raw=raw, back=f"SELECT raw.* FROM raw, pd WHERE {day} >= as_of - 14", d=Q.daily("back"),
        fcd=Q.daily("v2"), fc=f"SELECT city, {leads} FROM fcd, pd GROUP BY city",
        l0="SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in Q.feature_exprs(targets=False)) + last + " FROM d",
        l1=f"SELECT l0.* REPLACE ({over}) FROM l0 LEFT JOIN fc ON l0.city = fc.city",
        l2="SELECT *, pressure_mean - fc_pressure_d1 AS fc_pressure_drop_d1 FROM l1",
        l=f"SELECT * FROM l2 WHERE {Q.not_null(C.FEATURE_COLS)}",
        m=f"SELECT coalesce(l.city, h.city) AS city, coalesce(l.date, h.date) AS date, {merged}, "
          + ", ".join(f"h.{t}" for t in C.TARGETS) + " FROM h FULL OUTER JOIN l ON h.city = l.city AND h.date = l.date",
        t=Q.features("d"), k=f"SELECT city, date, {', '.join(C.TARGETS)} FROM t WHERE {Q.not_null(C.TARGETS)}",
        out="SELECT m.* REPLACE (" + ", ".join(f"CASE WHEN k.city IS NOT NULL THEN k.{t} ELSE m.{t} END AS {t}" for t in C.TARGETS)
            + ") FROM m LEFT JOIN k ON m.city = k.city AND m.date = k.date")
    return Q.ctes(**parts) + f"SELECT {Q.select_rounded(FEATURE_OUT, set(DOUBLE_FEATURES))} FROM out"


@register("c03_daily_increment", _c03_sql())
def c03_daily_increment(spark, sf_dir):
    """Backfill up to the tenth day before the last, then a daily run three
    days later with the weather of the days after it as the forecast; the
    whole feature store, live row included."""
    aq, wx = _feeds(spark, sf_dir)
    base = ST.scratch_path(spark, "daily")
    as_of = aq.agg(F.date_sub(F.max(F.to_date("timestamp")), 6)).first()[0]
    before = F.to_date("timestamp") < F.date_sub(F.lit(as_of), 3)
    FL.backfill(spark, aq.where(before), wx.where(before), f"{base}/raw", f"{base}/features", str(as_of))
    fresh = aq.join(wx, ["city", "timestamp"])
    ahead = FE.forecast_features(RU.forecast_daily(fresh), F.date_sub(F.lit(as_of), 1))
    out = FL.daily_increment(spark, fresh, f"{base}/raw", f"{base}/features", str(as_of), forecast=ahead)
    return round_doubles(out.select(*FEATURE_OUT))


@register("c04_current_reading_run", Q.ctes(v1=Q.V1)
          + 'SELECT city, arg_max(aqi, ("timestamp", aqi)) AS aqi, max("timestamp") AS "timestamp", '
            'max("timestamp") AS updated_at FROM v1 WHERE aqi IS NOT NULL GROUP BY city')
def c04_current_reading_run(spark, sf_dir):
    """Two runs: the second one meets the table that the first one wrote."""
    path, rows = ST.scratch_path(spark, "current"), V.event_readings(spark, sf_dir)
    FL.current_reading(spark, rows.where(F.col("timestamp") < F.lit("2024-01-12").cast("timestamp_ntz")), path)
    return FL.current_reading(spark, rows, path).select("city", "aqi", "timestamp", "updated_at")


_SER = ("SELECT city, 'actual_aqi' AS series, date, aqi_mean AS value FROM act UNION ALL "
        "SELECT city, 'predicted_day1', prediction_date, p1 FROM preds WHERE p1 IS NOT NULL UNION ALL "
        "SELECT city, 'pm2_5', CAST(\"timestamp\" AS DATE), avg(pm2_5) FROM v3 GROUP BY ALL UNION ALL "
        "SELECT city, 'pm10', CAST(\"timestamp\" AS DATE), avg(pm10) FROM v3 GROUP BY ALL")


@register("c08_trend_series", Q.ctes(v3=Q.V3, act=ACT, preds=PREDS, s=_SER)
          + "SELECT city, series, date, round(value, 6) AS value FROM s")
def c08_trend_series(spark, sf_dir):
    """Trend page data in long form: actual, past day-1 prediction and two
    pollutant series per city and day."""
    from airlens.operators import evaluate as EV
    act = V.daily_actuals(spark, sf_dir)
    preds = EV.persistence_predictions(act)
    r = V.lineitem_readings(spark, sf_dir).groupBy("city", F.to_date("timestamp").alias("date")).agg(
        F.avg("pm2_5").alias("pm2_5"), F.avg("pm10").alias("pm10"))
    parts = [act.select("city", F.lit("actual_aqi").alias("series"), "date", F.col("aqi_mean").alias("value")),
             preds.where(F.col("day1.aqi").isNotNull()).select("city", F.lit("predicted_day1").alias("series"),
                                                               F.col("prediction_date").alias("date"), F.col("day1.aqi").alias("value")),
             r.select("city", F.lit("pm2_5").alias("series"), "date", F.col("pm2_5").alias("value")),
             r.select("city", F.lit("pm10").alias("series"), "date", F.col("pm10").alias("value"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return round_doubles(out)
