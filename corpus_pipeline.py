"""Corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents`` (and any other column that ``docs``
has).  Nulls, empty texts, repeated rows and empty tables are treated as the
operators' own docstrings say.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.llm import common, exact_dedup, mixing, near_dedup, packing, toxicity
from airlens.session import configure, materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; the rest go."""
    configure(spark)
    return toxicity.drop_toxic(docs, common.table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    configure(spark)
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts linked by a resemblance of 0.8 or
    more over five-word shingles."""
    configure(spark)
    return near_dedup.drop_near_copies(docs, near_dedup.MinHash(words=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, none to two times each, near the sources' targets."""
    configure(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    configure(spark)
    pieces = packing.pack(docs, packing.tokenizer_file())
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]
#: The toxicity stage is not expressible in SQL; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's rows are written as
    Parquet and read again by the next."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
