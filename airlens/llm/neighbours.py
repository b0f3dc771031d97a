"""Approximate nearest neighbours over sharded small-world graphs (operator 12).

Equal vectors are one node, which carries the ``k + 1`` smallest ids of its
rows: no list of k can show more of them, so large groups of copies cost
nothing and lose nothing.  Distinct vectors are dealt to shards of bounded size
by a hash; each shard is one graph, kept as one row of flat arrays in the
shared folder.  Blocks of queries meet every shard of vectors of their
length, candidates are measured again on the original vectors in double
precision, and the nearest of all shards stay.

Vectors have no structure that a query could be routed by (on the given
tables the ten nearest lie in 8 of 16 k-means cells at 0.86 recall), so every
query asks every shard; a shard is as large as one task's memory and time
allow, since the cost of a search grows with the logarithm of its size only.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens.llm import common as U
from airlens.llm import hnsw
from airlens.session import materialise, settled

K, QUERY_MOD = 10, 100
#: Vectors of a shard, on average: some 5 MB with its graph at 64 components.
SHARD_ROWS = 8192
#: Queries searched together, and blocks of them that one task takes for a shard.
BLOCK, BLOCKS_A_TASK = 1024, 32
#: Stands for a null vec_id among ids.
NO_ID = (1 << 63) - 1
INDEX = ("shard int, dims int, n int, single boolean, vectors binary, id_counts binary, ids binary, "
         "sizes array<int>, layers array<binary>")
FOUND = "q_row long, query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part: not null, not empty,
    no component null, infinite or not a number, and not all zero."""
    e = F.col("embedding")
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .filter((F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                    & F.exists(e, lambda x: x != 0)))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of equal length as an array."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """(embedding, ids): the distinct vectors, each with its k + 1 smallest
    ids.  The rank limit is applied before the shuffle as well."""
    w = Window.partitionBy("embedding").orderBy(F.col("vec_id").asc_nulls_last())
    ranked = vectors.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k + 1)
    return ranked.groupBy("embedding").agg(
        F.array_sort(F.collect_list(F.coalesce("vec_id", F.lit(NO_ID)))).alias("ids"))


def shard_plan(distinct: DataFrame, shard_rows: int) -> DataFrame:
    """(dims, shards, base): how many shards the vectors of each length have
    and the number of the first.  One row for each length."""
    counts = (distinct.groupBy(F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
              .select("dims", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards")))
    before = Window.orderBy("dims").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("base", F.coalesce(F.sum("shards").over(before), F.lit(0)).cast("int"))


def _pack(shard: int, batch: pa.Table) -> dict:
    vectors = _matrix(batch.column("embedding").combine_chunks())
    ids = batch.column("ids").combine_chunks()
    order, graph = hnsw.build(vectors)
    lists = [ids[int(i)].as_py() for i in order]
    return {"shard": shard, "dims": vectors.shape[1], "n": len(vectors), "single": vectors.dtype == np.float32,
            "vectors": vectors[order].tobytes(), "id_counts": np.array([len(x) for x in lists], np.int32).tobytes(),
            "ids": np.array([i for x in lists for i in x], np.int64).tobytes(),
            "sizes": graph.sizes, "layers": [layer.tobytes() for layer in graph.layers]}


class Shard:
    """A stored shard, read back."""

    def __init__(self, row: dict):
        dims, n = row["dims"], row["n"]
        self.vectors = np.frombuffer(row["vectors"], np.float32 if row["single"] else np.float64).reshape(n, dims)
        self.counts = np.frombuffer(row["id_counts"], np.int32)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        layers = [np.frombuffer(raw, np.int32).reshape(size, -1) for raw, size in zip(row["layers"], row["sizes"])]
        self.graph = hnsw.Graph(self.vectors, list(row["sizes"]), layers)

    def nearest(self, ids: np.ndarray, q: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vec_id, distance) of up to k rows for each query, its own
        row left out; distances in double precision on the original vectors."""
        nodes = self.graph.search(q, max(beam, k + 1))
        row, col = np.nonzero(nodes >= 0)
        node = nodes[row, col]
        d = np.empty(len(node))
        for at in range(0, len(node), 1 << 15):
            part = slice(at, at + (1 << 15))
            diff = self.vectors[node[part]].astype(np.float64) - q[row[part]].astype(np.float64)
            d[part] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
        many = self.counts[node]
        start = np.cumsum(many) - many
        at = np.arange(many.sum()) - np.repeat(start, many) + np.repeat(self.first[node], many)
        row, found, d = np.repeat(row, many), self.ids[at], np.repeat(d, many)
        order = np.lexsort((found, d, row))
        row, found, d = row[order], found[order], d[order]
        own = (d == 0) & (found == ids[row])
        # One row with the query's id and vector is the query itself.
        where = np.flatnonzero(own)
        keep = np.ones(len(row), bool)
        keep[where[np.diff(row[where], prepend=-1) > 0]] = False
        row, found, d = row[keep], found[keep], d[keep]
        count = np.bincount(row, minlength=len(q))
        best = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) < k
        return row[best], found[best], d[best]


def build_index(vectors: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The graph of every shard, one row each, written to the shared folder.

    Every distinct usable vector is a node of one shard; the hash of the
    vector deals them evenly whatever the number of its copies."""
    spark = vectors.sparkSession

    def build() -> DataFrame:
        distinct = materialise(distinct_vectors(usable(vectors), k), "distinct-vectors")
        plan = materialise(shard_plan(distinct, shard_rows), "shards")
        total = plan.agg(F.coalesce(F.sum("shards"), F.lit(0))).first()[0]
        # One row for each length of vector: a small side, left to the planner.
        dealt = (distinct.withColumn("dims", F.size("embedding")).join(plan, "dims")
                 .withColumn("key", F.xxhash64("embedding"))
                 .select((F.col("base") + F.pmod("key", F.col("shards").cast("long"))).cast("int").alias("shard"),
                         "embedding", "ids", "key"))

        def run(batches):
            for shard, parts in groupby(_runs(batches, "shard"), key=lambda x: x[0]):
                row = _pack(shard, pa.Table.from_batches([p for _, p in parts]))
                yield pa.RecordBatch.from_pylist([row], schema=_INDEX_ARROW)
        return (dealt.repartitionById(max(int(total), 1), F.col("shard")).sortWithinPartitions("shard", "key", "embedding")
                .mapInArrow(run, INDEX))
    return settled(spark, "shard-graphs", build)


_INDEX_ARROW = pa.schema([("shard", pa.int32()), ("dims", pa.int32()), ("n", pa.int32()), ("single", pa.bool_()),
                          ("vectors", pa.binary()), ("id_counts", pa.binary()), ("ids", pa.binary()),
                          ("sizes", pa.list_(pa.int32())), ("layers", pa.list_(pa.binary()))])


_BLOCK_ARROW = pa.schema([("dims", pa.int32()), ("q_rows", pa.binary()), ("ids", pa.binary()), ("vectors", pa.binary())])


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(value, rows) for each run of equal values of a sorted column."""
    for batch in batches:
        if batch.num_rows:
            value = batch.column(column).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(value)) + 1), len(value)]
            for a, b in zip(cuts, cuts[1:]):
                yield int(value[a]), batch.slice(a, b - a)


def query_blocks(queries: DataFrame) -> DataFrame:
    """(block, dims, q_rows, ids, vectors): blocks of up to 1,024 queries of
    one length, as flat arrays of doubles."""
    def run(batches):
        held: dict[int, list] = {}

        def block(dims: int) -> pa.RecordBatch:
            rows = held.pop(dims)
            return pa.RecordBatch.from_pylist([{
                "dims": dims, "q_rows": np.concatenate([r[0] for r in rows]).tobytes(),
                "ids": np.concatenate([r[1] for r in rows]).tobytes(),
                "vectors": np.concatenate([r[2] for r in rows]).tobytes()}], schema=_BLOCK_ARROW)
        for batch in batches:
            sizes = np.diff(batch.column("embedding").offsets.to_numpy())
            for dims in np.unique(sizes):
                mine = batch.filter(pa.array(sizes == dims))
                for at in range(0, mine.num_rows, BLOCK):
                    part = mine.slice(at, BLOCK)
                    held.setdefault(int(dims), []).append((
                        part.column("q_row").to_numpy(), part.column("vec_id").to_numpy(),
                        _matrix(part.column("embedding")).astype(np.float64)))
                    if sum(len(r[0]) for r in held[int(dims)]) >= BLOCK:
                        yield block(int(dims))
        for dims in list(held):
            yield block(dims)
    blocks = queries.mapInArrow(run, "dims int, q_rows binary, ids binary, vectors binary")
    return blocks.select(F.monotonically_increasing_id().alias("block"), "*")


def search(index: DataFrame, queries: DataFrame, k: int = K, beam: int = hnsw.BEAM_SEARCH) -> DataFrame:
    """(q_row, query_id, rank, vec_id, score): up to ``k`` nearest rows of the
    index for each row of ``queries`` (q_row, vec_id, embedding), nearest first,
    ties to the smaller vec_id (null last).  A row with the query's vec_id and
    vector is the query itself, once; vectors of another length are not compared."""
    blocks = materialise(query_blocks(queries), "query-blocks")
    shards, n_blocks = index.count(), blocks.count()
    splits = max(1, -(-n_blocks // BLOCKS_A_TASK))
    split = F.pmod(F.xxhash64("block"), F.lit(splits)).cast("int")
    asked = (blocks.join(index.select("dims", "shard"), "dims")
             .select("shard", split.alias("split"), F.lit(1).alias("kind"), "q_rows", "ids", "vectors",
                     *[F.lit(None).cast(t).alias(c) for c, t in (("dims", "int"), ("n", "int"), ("single", "boolean"),
                                                                 ("id_counts", "binary"), ("sizes", "array<int>"),
                                                                 ("layers", "array<binary>"))]))
    stored = index.select("shard", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("split"), F.lit(0).alias("kind"),
                          F.lit(None).cast("binary").alias("q_rows"), "ids", "vectors", "dims", "n", "single",
                          "id_counts", "sizes", "layers")
    # A graph, then the blocks that ask it, in one task.
    tasks = max(1, min(shards * splits, 1 << 15))
    met = (stored.unionByName(asked)
           .repartitionById(tasks, F.pmod(F.col("shard").cast("long") * splits + F.col("split"), F.lit(tasks)).cast("int"))
           .sortWithinPartitions("shard", "split", "kind"))

    def run(batches):
        shard, asked_rows = None, []

        def answer():
            rows, ids, q = (np.concatenate(x) for x in zip(*asked_rows))
            asked_rows.clear()
            at, found, d = shard.nearest(ids, q, k, beam)
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[at]), pa.array(ids[at]), pa.array(found, mask=found == NO_ID), pa.array(d)],
                ["q_row", "query_id", "vec_id", "score"])
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["kind"] == 0:
                    if asked_rows:
                        yield answer()
                    shard = Shard(row)
                    continue
                q_rows = np.frombuffer(row["q_rows"], np.int64)
                asked_rows.append((q_rows, np.frombuffer(row["ids"], np.int64),
                                   np.frombuffer(row["vectors"], np.float64).reshape(len(q_rows), -1)))
                if sum(len(x[0]) for x in asked_rows) >= BLOCK:
                    yield answer()
        if asked_rows:
            yield answer()
    nearest = met.mapInArrow(run, FOUND)
    w = Window.partitionBy("q_row").orderBy("score", F.col("vec_id").asc_nulls_last())
    return (nearest.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("q_row", "query_id", "rank", "vec_id", "score"))


OUT = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()),
                    T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])


def nearest_rows(vectors: DataFrame, k: int = K, query_mod: int = QUERY_MOD, shard_rows: int = SHARD_ROWS,
                 beam: int = hnsw.BEAM_SEARCH) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found among all other rows
    for each row whose vec_id is divisible by ``query_mod``.

    Unusable vectors take no part, a null vec_id is no query but may be found,
    repeated ids are rows of their own, and where there are fewer candidates
    all of them are returned."""
    spark = vectors.sparkSession

    def build() -> DataFrame:
        index = build_index(vectors, k, shard_rows)
        queries = usable(vectors).filter(F.col("vec_id") % query_mod == 0).withColumn("q_row", F.monotonically_increasing_id())
        return search(index, queries, k, beam).select(*OUT.names)
    return settled(spark, "nearest", build)


def op12_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest_rows(U.table(spark, sf_dir, "embeddings"))
