"""Keyed stores on partitioned Parquet.

Upsert = rows of the *touched* partitions that the new batch does not
replace, plus the new rows, written with ``partitionOverwriteMode=dynamic``:
only partitions present in the output are rewritten, so the cost follows the
batch, not the table.  Dynamic overwrite writes its files aside and swaps
whole partitions at commit, so the plan may read the table it rewrites and a
failed write leaves the old rows.  For that reason every store has a
partition: one without partition columns of its own gets ``_bucket``, a hash
of its keys, which :func:`read_table` drops.  Keys must determine the
partition (e.g. key ``(city, date)`` with partition ``month(date)``).

Batches may have more or fewer columns than the table: its columns are
declared beside it (:mod:`airlens.sinks.schemas`), every read and rewrite
uses all of them, and a batch can only add to them.  A null is a key like any
other, in keys as in partition columns; an empty text in a partition column
is stored as null, as Spark's partition folders cannot tell them apart.

The batch is written once to the shared folder before it is looked at and
deleted at the end.  All modes are idempotent.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens.operators.clean import _as_list, dedupe
from airlens.session import materialise, scratch_path, transient  # noqa: F401 - scratch_path is part of this module's interface
from airlens.sinks import schemas

BUCKET = "_bucket"


@dataclass
class UpsertResult:
    inserted: int
    updated: int


def _stored(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table under its declared schema.  One without a declaration (written
    by other means) is read with the union of its files' columns."""
    schema = schema or schemas.declared(spark, path)
    r = spark.read.option("basePath", path)
    r = r.option("mergeSchema", "true") if schema is None else r.schema(schema)
    try:
        return r.parquet(path)
    except Exception as e:  # noqa: BLE001 - empty / missing table
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e) or "does not exist" in str(e):
            return None
        raise


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The stored rows; None where nothing has been stored yet."""
    t = _stored(spark, path, schema)
    return t if t is None else t.drop(BUCKET)


def check_unique(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once (must be empty before a write)."""
    keys = _as_list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def same(left: str, right: str, keys) -> Column:
    """Equality of all keys of two aliases; null equals null.  Spark plans it
    as an ordinary equi-join."""
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def merge_rows(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """Field merge (``$set``): on matched keys, columns present in ``new``
    win (even when NULL); columns only in ``old`` keep their value."""
    keys = _as_list(keys)
    j = old.alias("o").join(new.withColumn("_hit", F.lit(True)).alias("n"), same("o", "n", keys), "full_outer")
    sel = []
    for c in old.columns:
        sel.append((F.when(F.col("n._hit"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
                    if c in new.columns else F.col(f"o.{c}")).alias(c))
    sel += [F.col(f"n.{c}").alias(c) for c in new.columns if c not in old.columns]
    return j.select(*sel)


def _touched(old: DataFrame, new: DataFrame, parts: list[str]) -> DataFrame:
    """Rows of the partitions that the batch has rows in.  The join on plain
    equality lets Spark prune partitions; null ones are met apart."""
    values = new.select(*parts).distinct()
    none = reduce(Column.__or__, [F.col(p).isNull() for p in parts])
    rows = old.join(values.where(~none), parts, "left_semi")
    if values.where(none).isEmpty():
        return rows
    return rows.unionByName(old.where(none).alias("o").join(values.where(none).alias("v"), same("o", "v", parts), "left_semi"))


def upsert(new: DataFrame, path: str, keys, partition_by=None, mode: str = "replace",
           count: bool = False, order: str | None = None, buckets: int = 16) -> UpsertResult | None:
    """Keyed upsert into partitioned Parquet.

    ``replace`` (K01) new rows take the place of stored rows, so columns that
    the batch lacks become null there; ``merge`` (K05) their columns do;
    ``update`` as merge, but rows with unknown keys are left out; ``latest``
    the row with the largest ``order`` stays, whichever side it comes from.
    Empty batches write nothing.  A column whose type cannot be widened to hold
    both sides is an error.  With ``count=True`` the (inserted, updated)
    numbers are computed from the staged batch."""
    spark = new.sparkSession
    keys = _as_list(keys)
    parts = _as_list(partition_by) if partition_by else [BUCKET]
    if mode == "latest":
        new = dedupe(new, keys, [order], keep="last")
    if partition_by:
        new = new.withColumns({p: F.when(F.col(p) != "", F.col(p)) for p in parts
                               if isinstance(new.schema[p].dataType, T.StringType)})
    else:
        new = new.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    new = new.drop(*[f.name for f in new.schema.fields if isinstance(f.dataType, T.NullType)])
    with transient(spark):
        return _write(spark, materialise(new, "batch"), path, keys, parts, mode, count, order)


def _write(spark: SparkSession, new: DataFrame, path: str, keys: list[str], parts: list[str], mode: str, count: bool,
           order: str | None) -> UpsertResult | None:
    if not check_unique(new, keys).isEmpty():
        raise ValueError(f"batch has duplicate keys {keys}")
    if new.isEmpty():
        return UpsertResult(0, 0) if count else None
    known, old = schemas.declared(spark, path), _stored(spark, path)
    if old is None and mode == "update":
        return UpsertResult(0, 0) if count else None
    full = schemas.union(known or (old.schema if old is not None else T.StructType()), new.schema)
    if full != known:
        schemas.declare(spark, path, full)
    new = schemas.conform(new, full, fill=mode not in ("merge", "update"))
    result = None
    if old is None:
        out = new
        if count:
            result = UpsertResult(new.count(), 0)
    else:
        old = _stored(spark, path, full)
        if count:
            hit = new.alias("n").join(old.alias("o"), same("n", "o", keys), "left_semi").count()
            result = UpsertResult(0 if mode == "update" else new.count() - hit, hit)
        touched = _touched(old, new, parts)
        if mode == "merge":
            out = merge_rows(touched, new, keys)
        elif mode == "update":
            out = merge_rows(touched, new.alias("n").join(touched.alias("o"), same("n", "o", keys), "left_semi"), keys)
        elif mode == "latest":
            out = dedupe(touched.unionByName(new), keys, [order], keep="last")
        else:
            out = touched.alias("o").join(new.alias("n"), same("o", "n", keys), "left_anti").unionByName(new)
    (schemas.conform(out, full).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))
    return result


# K02 / K03 / K05 / K06 --------------------------------------------------------
def save_raw(df: DataFrame, path: str, key="city", ts: str = "timestamp", order: str | None = None) -> UpsertResult | None:
    """Hourly readings keyed (key, timestamp), partitioned by day.  Of readings
    in the batch with equal keys the one with the largest ``order`` is stored;
    without an ``order`` they are an error."""
    keys = _as_list(key) + [ts]
    d = dedupe(df, keys, [order], keep="last") if order else df
    return upsert(d.withColumn("day", F.to_date(F.col(ts))), path, keys, ["day"], "replace")


def save_features(df: DataFrame, path: str, key="city", mode: str = "merge") -> UpsertResult | None:
    """Daily features keyed (key, date), partitioned by month; merge keeps
    targets that a live batch (computed without targets) does not carry (Q02),
    update writes targets only where the day's features are stored."""
    d = df.withColumn("month", F.date_format("date", "yyyy-MM"))
    return upsert(d, path, _as_list(key) + ["date"], ["month"], mode)


def save_current(df: DataFrame, path: str, key="city") -> UpsertResult | None:
    """One row per key, field merge; rows with NULL aqi are skipped."""
    return upsert(df.where(F.col("aqi").isNotNull()), path, key, None, "merge")


def save_predictions(df: DataFrame, path: str, key="city") -> UpsertResult | None:
    """Nested prediction documents keyed (key, prediction_date)."""
    d = df.withColumn("month", F.date_format("prediction_date", "yyyy-MM"))
    return upsert(d, path, _as_list(key) + ["prediction_date"], ["month"], "merge")


# K07 / K09 -------------------------------------------------------------------
def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Struct columns -> one column per field (CSV cannot hold structs)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            cols += [F.col(f"{f.name}.{s.name}").alias(f"{f.name}{sep}{s.name}") for s in f.dataType.fields]
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def export_csv(df: DataFrame, path: str) -> bool:
    """Header CSV export; empty frames are skipped (returns False)."""
    if not df.take(1):
        return False
    flatten(df).write.mode("overwrite").option("header", True).csv(path)
    return True


def row_count(df: DataFrame) -> DataFrame:
    """K09 as a lazy one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
