"""Helpers shared by the corpus operators.

Conventions of every operator in this package:

* A null text counts as the empty text.  Rows are never merged because they
  share a ``doc_id``: a repeated ``doc_id`` is another document.
* Input columns other than those named are ignored by the queries and passed
  through untouched by the pipeline stages; internal columns carry the prefix
  ``__`` so they cannot clash.
* Empty tables give empty results with the documented schema.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words in most contracts (ASCII white space).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def doc_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with null texts as empty ones."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def text_key(text: str | Column = "text") -> Column:
    """SHA-256 of the text (null: of the empty text), lower-case hex."""
    return F.sha2(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), 256)


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text) is in ``kept`` (doc_id, text_key),
    one for each row of ``kept``, with the columns of ``docs``.

    The two sides meet in a shuffled equi-join.  Where ``kept`` names fewer
    copies of a (doc_id, text) than ``docs`` has, the surplus copies go."""
    cols = docs.columns
    left = docs.withColumn("__key", text_key()).withColumn("__id", F.col("doc_id").cast("long"))
    right = kept.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("__n"),
                                                   F.max("copies").alias("__copies"))
    right = right.select(F.col("doc_id").alias("__kid"), F.col("text_key").alias("__kkey"), "__n", "__copies")
    on = left["__key"].eqNullSafe(right["__kkey"]) & left["__id"].eqNullSafe(right["__kid"])
    same = right.filter("__n >= __copies")
    out = left.join(same, on, "left_semi").select(*[F.col(f"`{c}`") for c in cols])
    fewer = right.filter("__n < __copies")
    if fewer.isEmpty():
        return out
    from pyspark.sql import Window
    some = (left.join(fewer, on)
            .withColumn("__rank", F.row_number().over(Window.partitionBy("__key", "__id").orderBy(F.lit(1))))
            .filter("__rank <= __n"))
    return out.unionByName(some.select(*[F.col(f"`{c}`") for c in cols]))
