"""Mixing sources to target weights by a low-discrepancy schedule (operator 9).

Slots 0, 1, 2, ... are mapped by the golden ratio to evenly spread points in
[0, 1).  The point picks the source whose share of the cumulated weights it
falls into, and the slot's rank among its source's slots picks the source's
next block, going round again after the last.  The blocks of a source are of
equal length (to a word), and a source's weight is its number of slots, the
nearest whole number to its target over that length.  Points meet such numbers
to a few slots; the slots that a source has too many go to those that lack
some, so every source takes its number exactly.  Documents lie
in a source in a fixed shuffled order, and what the mix takes of a document is
what its blocks cover of it.

Sums along a source or the schedule are taken in segments and then across
segments, so a source with a third of all rows is spread over many tasks.
"""
from __future__ import annotations

from decimal import Decimal, getcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlens.llm import common as U
from airlens.session import materialise, settled

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2
BLOCK_WORDS = 64
#: A source has so many blocks at least, if it has the words.
LEAST_BLOCKS = 32
#: Slots that are ranked together in one task, and hash prefixes of a source.
SEGMENT = 1 << 16
SHUFFLE_PREFIX = 3

getcontext().prec = 60
_GOLDEN = (Decimal(5).sqrt() - 1) / 2
_STEP = 1 << 20


def golden_point(slot: Column) -> Column:
    """Fractional part of slot * golden ratio, to 2**-32, for slots below 2**40."""
    low, high = float(_GOLDEN % 1), float((_GOLDEN * _STEP) % 1)
    x = F.floor(slot / F.lit(_STEP)) * F.lit(high) + (slot % F.lit(_STEP)) * F.lit(low)
    return x - F.floor(x)


def index_sorted(df: DataFrame, *order: Column) -> DataFrame:
    """Adds ``idx``, the position in ``order`` over all rows, without bringing
    the rows together: sorted ranges, then an offset for each range."""
    at = materialise(df.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("__at", F.monotonically_increasing_id()), "sorted")
    part, within = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = at.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return (at.withColumn("__part", part).join(starts, "__part")
            .withColumn("idx", F.col("__before") + within).drop("__at", "__part", "__before"))


def running_start(df: DataFrame, keys: list[str], segment: str, order: list, value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows before this one within
    ``keys``, in the order of ``segment`` and then ``order``."""
    sums = df.groupBy(*keys, segment).agg(F.sum(value).alias("__sum"))
    by = Window.partitionBy(*keys).orderBy(segment) if keys else Window.orderBy(segment)
    starts = sums.withColumn("__before", F.sum("__sum").over(by) - F.col("__sum")).drop("__sum")
    inside = Window.partitionBy(*keys, segment).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn("__in", F.sum(value).over(inside) - F.col(value))
            .join(starts, [*keys, segment]).withColumn(name, F.col("__before") + F.col("__in"))
            .drop("__before", "__in"))


def sizes(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, text_key, src, no_src, size, shuffled): src is '' for a
    null source, told apart by no_src; ``shuffled`` orders a source's rows."""
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(U.WORD)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       words.alias("size"), U.text_key().alias("text_key"))
    return rows.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text_key",
                       F.coalesce("source", F.lit("")).alias("src"), F.col("source").isNull().alias("no_src"), "size",
                       F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_key").cast("binary"))
                       .alias("shuffled"))


def targets(rows: DataFrame, weights=WEIGHTS, share: float = TOTAL_SHARE, epochs: int = MAX_EPOCHS,
            block_words: int = BLOCK_WORDS) -> DataFrame:
    """(src, no_src, idx, source_size, target, blocks, slots, lo, hi): the
    source's number of blocks and slots; lo and hi bound its part of [0, 1).

    A target is min(epochs * size, level * weight).  The level is found by
    raising it until no further source reaches its bound; each round is one
    aggregate over the sources."""
    by_source = rows.groupBy("src", "no_src").agg(F.sum("size").alias("source_size"))
    s = index_sorted(by_source, F.col("no_src"), F.col("src"))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                            (F.col("idx") % len(weights) + 1).cast("int")).cast("long"))
    s = materialise(s, "sources")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    cap = F.lit(epochs) * F.col("source_size")
    level, bound = 0.0, -1
    while total:
        full = cap < F.lit(level) * F.col("weight")
        n, capped, free = s.agg(F.sum(full.cast("long")), F.sum(F.when(full, cap)),
                                F.sum(F.when(~full, F.col("weight")))).first()
        if n == bound or not free:
            break
        bound, level = n, (share * total - (capped or 0)) / free
    target = F.when(cap < F.lit(level) * F.col("weight"), cap.cast("double")).otherwise(F.lit(level) * F.col("weight"))
    size = F.col("source_size")
    blocks = F.greatest(F.ceil(size / F.lit(block_words)), F.least(size, F.lit(LEAST_BLOCKS))).cast("long")
    slots = F.coalesce(F.floor(F.try_divide(F.col("target") * F.col("blocks"), size) + 0.5), F.lit(0)).cast("long")
    s = (s.withColumn("target", target).withColumn("blocks", blocks).withColumn("slots", slots)
         .withColumn("__seg", F.floor(F.col("idx") / SEGMENT)))
    s = materialise(running_start(s, [], "__seg", ["idx"], "slots", "__start"), "slots")
    all_ = float(s.agg(F.sum("slots")).first()[0] or 1)
    return s.select("src", "no_src", "idx", "source_size", "target", "blocks", "slots", "__start", (F.col("__start") / all_).alias("lo"),
                    ((F.col("__start") + F.col("slots")) / all_).alias("hi"))


def schedule(spark, sources: DataFrame) -> DataFrame:
    """(slot, idx, rank, epoch, block): the mix, slot by slot; every source of
    ``sources`` has its ``slots``, with ranks from 0.

    Points and shares meet on equal cells of [0, 1), which the points fill
    evenly.  What a source has beyond its number of slots is dealt, in the order
    of the slots, to the sources that lack some."""
    n_sources, slots = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("slots"), F.lit(0))).first()
    cells = max(1024, n_sources)
    points = (spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", golden_point(F.col("slot")))
              .withColumn("cell", F.floor(F.col("point") * cells)))
    shares = (sources.filter("slots > 0").select("idx", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * cells), F.floor(F.least(F.col("hi"), F.lit(1.0)) * cells))).alias("cell")))
    last = sources.filter("slots > 0").agg(F.max("idx")).first()[0]
    picked = (points.join(shares, "cell")
              .filter((F.col("point") >= F.col("lo")) & ((F.col("point") < F.col("hi")) | (F.col("idx") == F.lit(last)))))
    picked = picked.select("slot", "idx", F.floor(F.col("slot") / SEGMENT).alias("__seg"), F.lit(1).cast("long").alias("one"))
    ranked = materialise(running_start(picked, ["idx"], "__seg", ["slot"], "one", "rank")
                         .join(sources.select("idx", "slots", "blocks"), "idx"), "ranked")
    fit = ranked.filter("rank < slots")
    over = running_start(ranked.filter("rank >= slots").select("slot", "__seg", "one"), [], "__seg", ["slot"], "one", "no")
    have = ranked.groupBy("idx").agg(F.count(F.lit(1)).alias("have"))
    short = (sources.join(have, "idx", "left").withColumn("have", F.coalesce("have", F.lit(0))).filter("have < slots")
             .withColumn("lack", F.col("slots") - F.col("have")).withColumn("__seg", F.floor(F.col("idx") / SEGMENT)))
    short = running_start(short.select("idx", "have", "slots", "lack", "__seg"), [], "__seg", ["idx"], "lack", "first")
    short = short.select("idx", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("lack") - 1)).alias("no"))
    every = fit.select("slot", "idx").unionByName(over.select("slot", "no").join(short, "no").select("slot", "idx"))
    every = every.withColumn("__seg", F.floor(F.col("slot") / SEGMENT)).withColumn("one", F.lit(1).cast("long"))
    return (running_start(every, ["idx"], "__seg", ["slot"], "one", "rank").join(sources.select("idx", "blocks"), "idx")
            .select("slot", "idx", "rank", F.floor(F.col("rank") / F.col("blocks")).alias("epoch"),
                    (F.col("rank") % F.col("blocks")).alias("block")))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The schedule, and a row per document: row_id, doc_id, text_key, size,
    source_size, target, taken.

    Null texts have no words and nothing is taken of them; null sources are a
    source of their own, the last; repeated rows are documents of their own.
    ``taken`` is at most MAX_EPOCHS times ``size``; of a source it is its target
    to half a block and a word."""
    rows = materialise(sizes(docs), "sizes")
    sources = materialise(targets(rows, block_words=block_words), "targets")
    plan = materialise(schedule(docs.sparkSession, sources), "schedule")
    rows = (rows.join(sources.select("src", "no_src", "idx", "source_size", "target", "blocks"), ["src", "no_src"])
            .withColumn("__seg", F.substring("shuffled", 1, SHUFFLE_PREFIX)))
    rows = materialise(running_start(rows, ["idx"], "__seg", ["shuffled", "doc_id", "text_key", "row_id"], "size", "at")
                       .select("row_id", "doc_id", "text_key", "idx", "size", "source_size", "target", "blocks", "at"), "places")
    # The first ``more`` blocks of a source have ``least`` + 1 words, the others ``least``.
    least, more = F.floor(F.col("source_size") / F.col("blocks")), F.col("source_size") % F.col("blocks")
    end, cut = F.col("at") + F.col("size"), more * (least + 1)

    def block_of(p: Column) -> Column:
        return F.when(p < cut, F.floor(p / (least + 1))).otherwise(more + F.floor((p - cut) / least))

    def start_of(j: Column) -> Column:
        return j * least + F.least(j, more)
    parts = rows.filter("size > 0").select("row_id", "idx", "at", end.alias("end"), "source_size", "blocks",
                                           F.explode(F.sequence(block_of(F.col("at")), block_of(end - 1))).alias("block"))
    parts = parts.select("row_id", "idx", "block", (F.least(F.col("end"), start_of(F.col("block") + 1))
                                                    - F.greatest(F.col("at"), start_of(F.col("block")))).alias("words"))
    times = plan.groupBy("idx", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = (parts.join(times, ["idx", "block"]).groupBy("row_id")
             .agg(F.sum(F.col("words") * F.col("times")).alias("taken")))
    return plan, (rows.join(taken, "row_id", "left")
                  .select("row_id", "doc_id", "text_key", "size", "source_size", "target",
                          F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix in whole documents: each row of ``docs`` as often as the words
    taken of it make up its text, to the nearest whole number.

    Texts without words give nothing to a mix of words and are not in it.
    Rows equal in doc_id and text share what is taken of them evenly."""
    rows = settled(docs.sparkSession, "mix", lambda: mix(docs, block_words)[1])
    plan = (rows.filter("size > 0").groupBy("doc_id", "text_key")
            .agg(F.floor(F.sum("taken") / F.sum("size") + 0.5).cast("int").alias("__times")).filter("__times > 0")
            .select(F.col("doc_id").alias("__kid"), F.col("text_key").alias("__kkey"), "__times"))
    left = docs.withColumn("__key", U.text_key()).withColumn("__id", F.col("doc_id").cast("long"))
    return (left.join(plan, left["__key"].eqNullSafe(plan["__kkey"]) & left["__id"].eqNullSafe(plan["__kid"]))
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op9_source_mix(spark, sf_dir: str) -> DataFrame:
    return settled(spark, "mix", lambda: mix(U.documents(spark, sf_dir))[1]).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS src, source IS NULL AS no_src,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         sha256(coalesce(text, '')) AS k,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || k) AS shuffled FROM documents
), s0 AS (SELECT src, no_src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY ALL
), s1 AS (SELECT *, row_number() OVER (ORDER BY no_src, src) - 1 AS idx FROM s0
), s AS (SELECT *, CASE idx % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS weight FROM s1
), t AS (SELECT {TOTAL_SHARE} * sum(source_size) AS share FROM s
), c AS (
  SELECT *, {MAX_EPOCHS}.0 * source_size / weight AS ratio,
         (share - coalesce(sum({MAX_EPOCHS} * source_size) OVER (ORDER BY {MAX_EPOCHS}.0 * source_size / weight, idx
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY {MAX_EPOCHS}.0 * source_size / weight, idx
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s, t
), l AS (SELECT coalesce(arg_min(level, (ratio, idx)), 0) AS level FROM c WHERE ratio >= level
), g AS (SELECT s.*, CAST(least({MAX_EPOCHS} * source_size, level * weight) AS DOUBLE) AS target FROM s, l
), b AS (SELECT *, CAST(greatest(ceil(source_size / {BLOCK_WORDS}.0), least(source_size, {LEAST_BLOCKS})) AS BIGINT) AS blocks FROM g
), n AS (SELECT *, CAST(floor(target * blocks / nullif(source_size, 0) + 0.5) AS BIGINT) AS slots,
                source_size // nullif(blocks, 0) AS least, source_size % nullif(blocks, 0) AS more FROM b
), q AS (SELECT idx, blocks, unnest(range(slots)) AS rank FROM n
), u AS (SELECT idx, rank % blocks AS block, count(*) AS times FROM q GROUP BY ALL
), e AS (
  SELECT d.*, n.idx, n.source_size, n.target, n.least, n.more,
         CAST(sum(size) OVER (PARTITION BY n.idx ORDER BY shuffled, doc_id, k, r ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS pos
  FROM d JOIN n ON d.src = n.src AND d.no_src = n.no_src
), w AS (
  SELECT *, CASE WHEN pos < more * (least + 1) THEN pos // (least + 1) ELSE more + (pos - more * (least + 1)) // least END AS first,
         CASE WHEN pos + size - 1 < more * (least + 1) THEN (pos + size - 1) // (least + 1)
              ELSE more + (pos + size - 1 - more * (least + 1)) // least END AS last FROM e WHERE size > 0
), f AS (SELECT r, idx, pos, size, least, more, unnest(range(first, last + 1)) AS block FROM w
), k AS (
  SELECT r, CAST(sum((least(pos + size, (f.block + 1) * f.least + least(f.block + 1, f.more))
                      - greatest(pos, f.block * f.least + least(f.block, f.more))) * times) AS BIGINT) AS taken
  FROM f JOIN u ON f.idx = u.idx AND f.block = u.block GROUP BY r
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM e LEFT JOIN k ON e.r = k.r
"""
