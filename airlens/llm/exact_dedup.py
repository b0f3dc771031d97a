"""Exact dedup by deterministic block naming (operator 7, DataFrame only).

Every text is cut into blocks of a fixed number of characters.  The distinct
blocks are sorted and numbered, so that equal numbers mean equal blocks.
Then adjacent pairs of numbers are numbered in the same way, and pairs of
those, until one number is left for each document.  Two documents have the
same (level, number) exactly if their texts are identical: a hash only says
where to look for a number, it never decides equality.
"""
from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.llm import common as U
from airlens.session import materialise, settled

BLOCK_CHARS = 4096


def cut_blocks(text: Column, block_chars: int) -> Column:
    """Blocks of ``block_chars`` code points; the empty text is one block."""
    return (F.when(F.length(text) <= block_chars, F.array(text))
             .otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))))


def number(distinct: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``name``: increasing in ``order`` within a partition, unique overall."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def name_blocks(docs: DataFrame, block_chars: int, digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """Rows (row_id, doc_id, text_key, n_blocks) and places (row_id, pos, name).

    Content is shuffled once, after equal blocks have been combined on the
    map side.  The numbers go back to their places by a join on the digest.
    Digests that two different blocks share are found by counting, and only
    for those the join compares the blocks themselves."""
    text = docs.select("doc_id", "text", cut_blocks(F.col("text"), block_chars).alias("blocks"))
    blocks = text.select(F.explode("blocks").alias("block")).select(digest(F.col("block")).alias("digest"), "block")
    numbered = number(blocks.groupBy("digest", "block").agg(F.count(F.lit(1)).alias("n")), ["block"])
    names = materialise(numbered.select("digest", "name"), "block-names")
    shared = names.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")
    with_id = text.withColumn("row_id", F.monotonically_increasing_id())
    if shared.isEmpty():
        rows = materialise(with_id.select("row_id", "doc_id", U.text_key().alias("text_key"),
                                          F.transform("blocks", lambda b: digest(b)).alias("digests")), "block-digests")
        places = rows.select("row_id", F.posexplode("digests").alias("pos", "digest")).join(names, "digest")
        n_blocks = F.size("digests")
    else:
        known = materialise(numbered.join(shared.withColumn("shared", F.lit(True)), "digest", "left")
                            .select("digest", "name", F.when(F.col("shared"), F.col("block")).alias("block")), "block-names")
        rows = materialise(with_id.select("row_id", "doc_id", U.text_key().alias("text_key"), "blocks"), "block-texts")
        at = (rows.select("row_id", F.posexplode("blocks").alias("pos", "block"))
              .withColumn("digest", digest(F.col("block")))
              .join(shared.withColumn("shared", F.lit(True)), "digest", "left"))
        at = at.select("row_id", "pos", "digest", F.when(F.col("shared"), F.col("block")).alias("block"))
        places = at.join(known, (at["digest"] == known["digest"]) & at["block"].eqNullSafe(known["block"]))
        n_blocks = F.size("blocks")
    rows = rows.select("row_id", "doc_id", "text_key", n_blocks.alias("n_blocks"))
    return rows, places.select("row_id", "pos", "name")


def identify(docs: DataFrame, block_chars: int = BLOCK_CHARS,
             digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(row_id, doc_id, text_key, level, name): (level, name) is the identity
    of the text.  The rounds are the doublings from one block to the longest
    text; a round keeps half the places of the one before it."""
    rows, places = name_blocks(U.doc_text(docs), block_chars, digest)
    at = materialise(places.join(rows.select("row_id", "n_blocks"), "row_id"), "names-0")
    level, done = 0, []
    while True:
        done.append(at.filter("n_blocks = 1").select("row_id", F.lit(level).alias("level"), "name"))
        open_ = at.filter("n_blocks > 1")
        if open_.isEmpty():
            break
        level += 1
        even = F.col("pos") % 2 == 0
        pairs = (open_.groupBy("row_id", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
                 .agg(F.max(F.when(even, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1).cast("long")).alias("b"),
                      F.max(F.ceil(F.col("n_blocks") / 2).cast("int")).alias("n_blocks")))
        pairs = materialise(pairs, f"pairs-{level}")
        names = materialise(number(pairs.select("a", "b").distinct(), ["a", "b"]), f"pair-names-{level}")
        at = materialise(pairs.join(names, ["a", "b"]).select("row_id", "pos", "name", "n_blocks"), f"names-{level}")
    return rows.select("row_id", "doc_id", "text_key").join(reduce(DataFrame.unionByName, done), "row_id")


def exact_groups(docs: DataFrame, block_chars: int = BLOCK_CHARS,
                 digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays; a null doc_id is the
    smallest, and of rows equal in both one stays.  Null texts are empty
    texts, and all empty texts are one group.  Group sizes are counted with
    map-side combining and written; the join back meets groups of any size,
    and as both its sides are plain shuffles, adaptive execution splits them."""
    spark = docs.sparkSession
    ident = settled(spark, "identities", lambda: identify(docs, block_chars, digest))
    groups = settled(spark, "copies", lambda: ident.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", "row_id")).alias("keep"), F.count(F.lit(1)).alias("group_size")).filter("group_size > 1"))
    alone = F.col("group_size").isNull()
    return (ident.join(groups, ["level", "name"], "left")
            .select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    (alone | (F.col("row_id") == F.col("keep.row_id"))).alias("kept"),
                    F.col("text_key").alias("text_sha256")))


def drop_exact_copies(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows that :func:`exact_groups` drops."""
    rows = settled(docs.sparkSession, "exact-groups", lambda: exact_groups(docs, block_chars))
    copies = rows.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("copies"))
    kept = (rows.filter("kept").select("doc_id", F.col("text_sha256").alias("text_key"))
            .join(copies.select(F.col("doc_id").alias("i"), F.col("text_sha256").alias("k"), "copies"),
                  F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")))
            .select("doc_id", "text_key", "copies"))
    return U.keep_rows(docs, kept)


def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(U.documents(spark, sf_dir))


OP7_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW w AS (PARTITION BY t)
"""
