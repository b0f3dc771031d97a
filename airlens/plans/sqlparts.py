"""DuckDB SQL twins of the stand-in views and core operators.

Used only by ``oracle_sql()``: each oracle is an independent, hand-written
SQL statement over the driver's views, composed from these CTE fragments.
"""
from __future__ import annotations

from airlens import constants as C

MEASURES = C.MEASURES

V1 = """SELECT event_type AS city, ts AS "timestamp", event_id AS seq, value / 1.09 AS aqi,
 value / 1.31 AS pm2_5, value / 0.857 AS pm10, CAST(user_id AS DOUBLE) * 10.0 / 3.07 AS co, value / 2.2 AS no2,
 value / 6.01 AS so2, value / 2.93 AS o3, value / 11.3 - 10.0 AS temperature,
 value / 5.71 AS humidity, value / 13.7 AS wind_speed,
 CAST(user_id AS DOUBLE) * 360.0 / 151.0 AS wind_direction, value / 7.03 + 950.0 AS pressure,
 CAST(1.0 AS DOUBLE) AS precipitation FROM events"""

V2 = ("SELECT city, date_trunc('hour', \"timestamp\") AS \"timestamp\", "
      + ", ".join(f"avg({m}) AS {m}" for m in MEASURES if m != "precipitation")
      + ", sum(precipitation) AS precipitation FROM v1 GROUP BY ALL")

V2D = """SELECT c.city, c."timestamp", """ + ", ".join(f"h.{m}" for m in MEASURES) + """
 FROM (SELECT city, unnest(generate_series(min("timestamp"), max("timestamp"), INTERVAL 1 HOUR)) AS "timestamp"
       FROM v2 GROUP BY city) c LEFT JOIN v2 h ON c.city = h.city AND c."timestamp" = h."timestamp\""""

V3 = """SELECT l_returnflag AS city, l_shipdate AS "timestamp", l_quantity AS aqi, l_extendedprice / 1000.0 AS pm2_5,
 l_extendedprice / 100.0 AS pm10, l_discount AS temperature, l_tax AS humidity,
 CAST(l_linenumber AS DOUBLE) AS wind_speed, CAST(l_suppkey AS DOUBLE) AS pressure,
 l_quantity / 10.0 AS precipitation FROM lineitem"""


def ctes(**parts) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in parts.items()) + "\n"


def range_null(src: str, cols) -> str:
    sel = []
    for c in cols:
        if c in C.VALID_RANGES:
            lo, hi = C.VALID_RANGES[c]
            sel.append(f"CASE WHEN {c} BETWEEN {lo} AND {hi} THEN {c} END AS {c}")
        else:
            sel.append(c)
    return f"SELECT city, \"timestamp\", {', '.join(sel)} FROM {src}"


def gap_fill(src: str, cols, limit: int = 3, key: str = "city", order: str = '"timestamp"') -> tuple[str, str]:
    """Two CTE bodies: positions, then the filled values."""
    p = f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS _rn FROM {src}"
    back = f"OVER (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    fwd = f"OVER (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    sel = [key, order]
    for c in cols:
        pv = f"last_value({c} IGNORE NULLS) {back}"
        pr = f"last_value(CASE WHEN {c} IS NOT NULL THEN _rn END IGNORE NULLS) {back}"
        nv = f"first_value({c} IGNORE NULLS) {fwd}"
        nr = f"first_value(CASE WHEN {c} IS NOT NULL THEN _rn END IGNORE NULLS) {fwd}"
        sel.append(f"CASE WHEN {c} IS NOT NULL THEN CAST({c} AS DOUBLE) WHEN ({pv}) IS NULL THEN {nv} "
                   f"WHEN ({nv}) IS NULL THEN {pv} ELSE ({pv}) + (({nv}) - ({pv})) * "
                   f"CAST(least(_rn - ({pr}), {limit}) AS DOUBLE) / CAST(({nr}) - ({pr}) AS DOUBLE) END AS {c}")
    return p, f"SELECT {', '.join(sel)} FROM {src}_p"


DAILY = [("aqi_mean", "avg(aqi)"), ("aqi_max", "max(aqi)"), ("aqi_min", "min(aqi)"),
         ("aqi_std", "coalesce(stddev_samp(aqi), 0.0)"),
         ("pm2_5_mean", "avg(pm2_5)"), ("pm10_mean", "avg(pm10)"), ("temp_mean", "avg(temperature)"),
         ("temp_max", "max(temperature)"), ("temp_min", "min(temperature)"),
         ("humidity_mean", "avg(humidity)"), ("wind_mean", "avg(wind_speed)"), ("wind_max", "max(wind_speed)"),
         ("pressure_mean", "avg(pressure)"), ("precip_sum", "coalesce(sum(precipitation), 0.0)")]
DAILY_NAMES = ["aqi_mean", "aqi_max", "aqi_min", "aqi_std", "aqi_last6h", "pm2_5_mean", "pm10_mean",
               "temp_mean", "temp_max", "temp_min", "humidity_mean", "wind_mean", "wind_max",
               "pressure_mean", "precip_sum"]


def daily(src: str) -> str:
    """A01-A04 over ``src`` (city, timestamp, measures); last-6 mean joined."""
    agg = ", ".join(f"{e} AS {n}" for n, e in DAILY)
    l6 = (f"SELECT city, date, avg(aqi) AS aqi_last6h FROM (SELECT city, CAST(\"timestamp\" AS DATE) AS date, aqi, "
          f"row_number() OVER (PARTITION BY city, CAST(\"timestamp\" AS DATE) ORDER BY \"timestamp\" DESC, aqi DESC NULLS LAST) AS rn "
          f"FROM {src}) WHERE rn <= 6 GROUP BY city, date")
    return (f"SELECT d.*, l6.aqi_last6h FROM (SELECT city, CAST(\"timestamp\" AS DATE) AS date, {agg} FROM {src} "
            f"GROUP BY ALL) d LEFT JOIN ({l6}) l6 ON d.city = l6.city AND d.date = l6.date")


def W(frame: str | None = None, key: str = "city", order: str = "date") -> str:
    base = f"PARTITION BY {key} ORDER BY {order}"
    return f"OVER ({base}{' ' + frame if frame else ''})"


def rows(a: int, b: int) -> str:
    fa = f"{-a} PRECEDING" if a < 0 else ("CURRENT ROW" if a == 0 else f"{a} FOLLOWING")
    fb = f"{-b} PRECEDING" if b < 0 else ("CURRENT ROW" if b == 0 else f"{b} FOLLOWING")
    return f"ROWS BETWEEN {fa} AND {fb}"


LEADS = [("temp", "temp_mean"), ("humidity", "humidity_mean"), ("wind", "wind_mean"),
         ("pressure", "pressure_mean"), ("precip", "precip_sum")]
DELTAS = [("pm2_5_diff", "pm2_5_mean"), ("pm10_diff", "pm10_mean"), ("temp_diff", "temp_mean"),
          ("pressure_diff", "pressure_mean"), ("wind_diff", "wind_mean"), ("humidity_diff", "humidity_mean")]


def feature_exprs(key: str = "city", targets: bool = True) -> list[tuple[str, str]]:
    w = W(key=key)
    lag = lambda c, n: f"lag({c}, {n}) {w}"
    out = [("aqi_lag1d", lag("aqi_mean", 1)), ("aqi_lag2d", lag("aqi_mean", 2)),
           ("aqi_lag3d", lag("aqi_mean", 3)), ("aqi_lag7d", lag("aqi_mean", 7)),
           ("pm2_5_lag1d", lag("pm2_5_mean", 1)), ("pm2_5_lag2d", lag("pm2_5_mean", 2)),
           ("aqi_roll_mean_3", f"CASE WHEN count(aqi_mean) {W(rows(-3, -1), key)} >= 2 THEN avg(aqi_mean) {W(rows(-3, -1), key)} END"),
           ("aqi_roll_mean_7", f"CASE WHEN count(aqi_mean) {W(rows(-7, -1), key)} >= 4 THEN avg(aqi_mean) {W(rows(-7, -1), key)} END"),
           ("aqi_trend_1d", f"{lag('aqi_mean', 1)} - {lag('aqi_mean', 2)}"),
           ("aqi_trend_3d", f"{lag('aqi_mean', 1)} - {lag('aqi_mean', 4)}"),
           ("aqi_diff", f"{lag('aqi_mean', 1)} - {lag('aqi_mean', 2)}"),
           ("aqi_pct_change", f"({lag('aqi_mean', 1)} / nullif({lag('aqi_mean', 2)}, 0) - 1) * 100")]
    out += [(n, f"{lag(s, 1)} - {lag(s, 2)}") for n, s in DELTAS]
    out += [("aqi_std_7d", f"coalesce(CASE WHEN count(aqi_mean) {W(rows(-7, -1), key)} >= 3 THEN stddev_samp(aqi_mean) {W(rows(-7, -1), key)} END, 0.0)"),
            ("month_sin", "sin(2 * pi() * month(date) / 12.0)"),
            ("month_cos", "cos(2 * pi() * month(date) / 12.0)"),
            ("dow", "CAST(isodow(date) - 1 AS INTEGER)")]
    out += [(f"fc_{n}_d{h}", f"lead({s}, {h}) {w}") for n, s in LEADS for h in (1, 2, 3)]
    if targets:
        out += [(f"aqi_day{h}", f"lead(aqi_mean, {h}) {w}") for h in (1, 2, 3)]
    return out


def features(daily_src: str, key: str = "city", targets: bool = True) -> str:
    ex = feature_exprs(key, targets)
    return (f"SELECT *, pressure_mean - fc_pressure_d1 AS fc_pressure_drop_d1 FROM "
            f"(SELECT *, {', '.join(f'{e} AS {n}' for n, e in ex)} FROM {daily_src})")


def not_null(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


ROUND6 = {"aqi_std", "aqi_roll_mean_3", "aqi_roll_mean_7", "aqi_pct_change", "aqi_std_7d",
          "month_sin", "month_cos"}


def select_rounded(cols, rounded, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" if c in rounded else c for c in cols)
