"""The declared columns of a keyed store.

A store takes batches whose columns differ.  Which columns it has is kept
beside its files, in ``_columns`` (numbered JSON schemas, the highest one that
can be read holds; Spark's readers pass over names that begin with ``_``).
Reads and rewrites use this schema, so a column survives in partitions and
batches that lack it.  It is widened before the rows are written: if that
write fails, the table has a column more, and nothing is lost.
"""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDER = "_columns"
#: Types whose stored values can be read as the other type without loss.
_WIDER = {("byte", "short"), ("byte", "integer"), ("byte", "long"), ("short", "integer"), ("short", "long"),
          ("integer", "long"), ("byte", "double"), ("short", "double"), ("integer", "double"), ("float", "double")}


def _files(spark: SparkSession, path: str):
    """(file system, folder, numbered files, highest first)."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{FOLDER}")
    fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
    names = [s.getPath() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return fs, folder, sorted((n for n in names if n.getName().endswith(".json")), key=lambda n: n.getName(), reverse=True)


def declared(spark: SparkSession, path: str) -> T.StructType | None:
    """The store's schema; None where none has been declared."""
    sc = spark.sparkContext
    fs, _, names = _files(spark, path)
    for name in names:
        stream = fs.open(name)
        try:
            text = sc._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            return T.StructType.fromJson(json.loads(text))
        except json.JSONDecodeError:  # a write that was cut off: the one before it holds
            continue
        finally:
            stream.close()
    return None


def declare(spark: SparkSession, path: str, schema: T.StructType) -> None:
    fs, folder, names = _files(spark, path)
    number = int(names[0].getName()[:-5]) + 1 if names else 0
    out = fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"{number:08d}.json"), False)
    try:
        out.write(bytearray(schema.json().encode()))
    finally:
        out.close()


def wider(old: T.DataType, new: T.DataType, name: str) -> T.DataType:
    """The type that holds both; ValueError where there is none."""
    if isinstance(new, T.NullType) or old == new:
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return union(old, new, f"{name}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(wider(old.elementType, new.elementType, f"{name}[]"), True)
    pair = (old.typeName(), new.typeName())
    if pair in _WIDER:
        return new
    if pair[::-1] in _WIDER or pair[0] == pair[1] != "decimal":
        return old
    raise ValueError(f"column {name} is {old.simpleString()} in the store and {new.simpleString()} in the batch")


def union(old: T.StructType, new: T.StructType, inside: str = "") -> T.StructType:
    """Columns of both, those of ``old`` first and under its names (names that
    differ in case only are one column); columns without a type are left out."""
    at = {f.name.lower(): f for f in old.fields}
    for f in new.fields:
        key = f.name.lower()
        kept = at[key].dataType if key in at else T.NullType()
        name = at[key].name if key in at else f.name
        at[key] = T.StructField(name, wider(kept, f.dataType, inside + name), True)
    return T.StructType([f for f in at.values() if not isinstance(f.dataType, T.NullType)])


def _as(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.StructType) and isinstance(have, T.StructType) and have != want:
        at = {f.name.lower(): f for f in have.fields}
        fields = [(_as(c.getField(at[f.name.lower()].name), at[f.name.lower()].dataType, f.dataType)
                   if f.name.lower() in at else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType) and isinstance(want.elementType, T.StructType):
        return F.transform(c, lambda x: _as(x, have.elementType, want.elementType))
    return c if have == want else c.cast(want)


def conform(df: DataFrame, schema: T.StructType, fill: bool = True) -> DataFrame:
    """``df`` with the names, types and order of ``schema``; columns it lacks
    are null, or left out without ``fill``."""
    at = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        mine = at.get(f.name.lower())
        if mine is not None:
            cols.append(_as(F.col(f"`{mine.name}`"), mine.dataType, f.dataType).alias(f.name))
        elif fill:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
