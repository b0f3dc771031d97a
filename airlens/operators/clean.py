"""Row hygiene and gap filling.

Scale notes
-----------
* De-duplication is an *aggregation* (``min_by``/``max_by`` over a struct),
  not a ``row_number`` window: Spark combines partial results map-side, so a
  key holding a third of all rows (many copies of one reading) is reduced
  before the shuffle instead of being sorted in one task.
* Gap filling runs on windows partitioned by ``(key, time bucket)``.  The
  values that cross a bucket boundary (last non-null before, first non-null
  after, row offsets) come from a per-bucket summary, which is one row per
  key and bucket.  No task ever holds more than one bucket of one key.
"""
from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens import constants as C
from airlens.session import materialise


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in ex]


# P03 / P04 -------------------------------------------------------------------
def dedupe(df: DataFrame, keys, order, keep: str = "first") -> DataFrame:
    """One row per ``keys``: the row with the smallest (``keep='first'``) or
    largest (``keep='last'``) ``order`` tuple.  The row is one struct that
    begins with ``order``, carried once; ties on ``order`` are broken by the
    other values, so the pick is deterministic.  Partial aggregation makes it
    skew-safe."""
    keys = _as_list(keys)
    order = [c for c in _as_list(order) if c not in keys]
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in dict.fromkeys(order + rest)])
    out = df.groupBy(*keys).agg((F.min if keep == "first" else F.max)(row).alias("_row"))
    return out.select(*keys, *[F.col("_row." + c).alias(c) for c in rest])


def keep_latest_version(history: DataFrame, fresh: DataFrame, keys, order=None) -> DataFrame:
    """Union history and fresh rows; on a key collision the fresh
    row wins (then, within one source, the largest ``order``)."""
    keys = _as_list(keys)
    u = (history.withColumn("_src", F.lit(0))
         .unionByName(fresh.withColumn("_src", F.lit(1)), allowMissingColumns=True))
    out = dedupe(u, keys, ["_src"] + _as_list(order), keep="last")
    return out.drop("_src")


# P05 / P06 -------------------------------------------------------------------
def null_out_of_range(df: DataFrame, ranges: dict | None = None) -> DataFrame:
    """Values outside the inclusive valid range become NULL (one projection)."""
    ranges = C.VALID_RANGES if ranges is None else ranges
    cols = []
    for c in df.columns:
        if c in ranges:
            lo, hi = ranges[c]
            cols.append(F.when(F.col(c).between(lo, hi), F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def out_of_range_counts(df: DataFrame, ranges: dict | None = None, by=None) -> DataFrame:
    """Per column (and optional group), how many values fall outside the
    valid range.  One aggregation pass, then unpivoted to long form."""
    ranges = C.VALID_RANGES if ranges is None else ranges
    present = [c for c in ranges if c in df.columns]
    by = _as_list(by)
    aggs = [F.count_if((F.col(c) < ranges[c][0]) | (F.col(c) > ranges[c][1])).alias(c)
            for c in present]
    wide = df.groupBy(*by).agg(*aggs)
    return wide.unpivot(by, present, "column", "n_out_of_range")


# P07 / P08 / P09 -------------------------------------------------------------
def drop_required_nulls(df: DataFrame, required: Sequence[str] | None = None) -> DataFrame:
    required = C.REQUIRED_COLUMNS if required is None else required
    return df.dropna(subset=[c for c in required if c in df.columns])


def drop_null_targets(df: DataFrame, targets: Sequence[str] | None = None) -> DataFrame:
    targets = C.TARGETS if targets is None else targets
    return df.dropna(subset=[c for c in targets if c in df.columns])


def drop_null_features(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    features = C.FEATURE_COLS if features is None else features
    present = [c for c in features if c in df.columns]
    return df.dropna(subset=present) if present else df


# W12-W14 ---------------------------------------------------------------------
def between_angles(pv, nv, share):
    """The angle ``share`` of the way from ``pv`` to ``nv`` (degrees), the
    shorter way round: the direction of the weighted sum of both unit vectors,
    in [0, 360); where the two cancel out, ``pv``."""
    a, b = F.radians(pv), F.radians(nv)
    x = (1 - share) * F.cos(a) + share * F.cos(b)
    y = (1 - share) * F.sin(a) + share * F.sin(b)
    angle = F.round(F.degrees(F.atan2(y, x)) * 1e9, 0) / 1e9   # no -1e-15 that would become 360
    turned = angle - 360 * F.floor(angle / 360)
    return F.when(x * x + y * y < 1e-18, pv).otherwise(turned)


def fill_gaps(df: DataFrame, key, order, cols: Sequence[str] | None = None,
              limit: int = 3, bucket: str = "month", circular: Sequence[str] = ()) -> DataFrame:
    """Linear interpolation by row position (at most ``limit`` steps into a
    gap, later steps repeat the last interpolated value), then forward fill,
    then backward fill -- per key, ordered by ``order``.

    Closed form per row at position ``rn``: ``pv/pr`` last non-null value
    and position at or before, ``nv/nr`` first non-null at or after::

        x                                     if x is not null
        nv                                    if pv is null   (leading gap)
        pv                                    if nv is null   (trailing gap)
        pv + (nv - pv) * least(rn - pr, limit) / (nr - pr)

    Columns named in ``circular`` are angles in degrees (Q13) and are
    interpolated along the circle.  ``bucket`` ('month', 'day' or 'year')
    bounds the rows one window task holds.  ``order`` must be unique within a
    key.  The rows are written once to the shared folder, with their position
    and nothing else; one aggregate of them gives, per bucket, what crosses its
    edges, and the neighbours inside a bucket are found after that is joined.
    """
    keys = _as_list(key)
    cols = numeric_columns(df, exclude=keys + [order]) if cols is None else list(cols)
    if not cols:
        return df
    order_c = F.col(order)
    part = keys + ["_bk"]
    w = Window.partitionBy(*part).orderBy(order_c)
    local = materialise(df.withColumn("_bk", F.date_trunc(bucket, order_c)).withColumn("_rb", F.row_number().over(w)), "gaps")

    # Bucket summary: size, last / first non-null value and its position.
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        pos = F.when(F.col(c).isNotNull(), F.col("_rb"))
        aggs += [F.max_by(F.col(c), pos).alias(f"_lv_{c}"), F.max(pos).alias(f"_lp_{c}"),
                 F.min_by(F.col(c), pos).alias(f"_fv_{c}"), F.min(pos).alias(f"_fp_{c}")]
    summ = local.groupBy(*part).agg(*aggs)
    before = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.col("_bk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    edge = lambda p, v: F.when(F.col(p).isNotNull(), F.struct((F.col(p) + F.col("_off")).alias("p"), F.col(v).alias("v")))
    carry = [F.col(k) for k in part] + [F.col("_off")]
    for c in cols:
        carry += [F.last(edge(f"_lp_{c}", f"_lv_{c}"), True).over(before).alias(f"_before_{c}"),
                  F.last(edge(f"_fp_{c}", f"_fv_{c}"), True).over(after).alias(f"_after_{c}")]
    # A null key is a key.
    on = reduce(Column.__and__, [F.col(f"l.{k}").eqNullSafe(F.col(f"s.{k}")) for k in part])
    j = local.alias("l").join(summ.select(*carry).alias("s"), on).select(
        "l.*", (F.col("_rb") + F.col("_off")).alias("_rn"), *[f"s.{x}_{c}" for c in cols for x in ("_before", "_after")])

    # "First non-null at or after" is evaluated as "last non-null so far" in
    # descending order: a running frame Spark updates incrementally (O(n)),
    # where a frame ending at UNBOUNDED FOLLOWING is recomputed per row (O(n^2)).
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    fwd = Window.partitionBy(*part).orderBy(order_c.desc()).rowsBetween(Window.unboundedPreceding, 0)
    # The window in the order of time comes last, so rows stay in that order.
    for name, edge_of, frame in (("_n", "_after", fwd), ("_p", "_before", back)):
        here = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("_rn").alias("p"), F.col(c).alias("v"))) for c in cols}
        j = j.select("*", *[F.coalesce(F.last(here[c], True).over(frame), F.col(f"{edge_of}_{c}")).alias(f"{name}_{c}") for c in cols])
    out = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(c))
            continue
        p, n = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        step = F.least(F.col("_rn") - p.p, F.lit(limit)).cast("double")
        if c in circular:
            interp = between_angles(p.v, n.v, step / (n.p - p.p).cast("double"))
        else:
            interp = p.v + (n.v - p.v) * step / (n.p - p.p).cast("double")
        out.append(F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
                    .when(p.isNull(), n.v).when(n.isNull(), p.v).otherwise(interp).alias(c))
    return j.select(*out)


# P20 / P10 -------------------------------------------------------------------
def fill_nulls(df: DataFrame, key="city", order="timestamp", limit: int = 3,
               bucket: str = "month", circular: Sequence[str] = ()) -> DataFrame:
    """P20: interpolate/ffill/bfill every numeric column of the frame."""
    return fill_gaps(df, key, order, None, limit=limit, bucket=bucket, circular=circular)


def clean_readings(df: DataFrame, key="city", order="timestamp", seq=None,
                   ranges: dict | None = None, limit: int = 3,
                   bucket: str = "month", circular: Sequence[str] = ()) -> DataFrame:
    """P10: de-duplicate (keep first by ``seq``) -> null out-of-range ->
    fill gaps -> drop rows still missing a required column."""
    keys = _as_list(key)
    deduped = dedupe(df, keys + [order], [seq] if seq else [], keep="first")
    ranged = null_out_of_range(deduped, ranges)
    exclude = keys + [order] + ([seq] if seq else [])
    filled = fill_gaps(ranged, keys, order, numeric_columns(ranged, exclude),
                       limit=limit, bucket=bucket, circular=circular)
    return drop_required_nulls(filled)
