"""Centroid clustering with Orchard's nearest-centroid search (operator 11).

Every centroid has the list of all others, nearest first.  A vector starts at
one centroid and walks its list; as soon as a closer centroid is found, it
jumps to that one's list.  Centroids already compared are marked and skipped.
The walk ends when the list reaches a centroid strictly farther from the
current one than twice the vector's distance: by the triangle inequality
nothing beyond can be as near, so ties are never lost.

All comparisons are on integers, so results do not depend on how rows are
dealt to tasks.  A round reads the vectors once and returns the sums of each
centroid; centroids are a fixed number of rows (``k`` times the dimension).
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens.llm import common as U
from airlens.session import materialise

DIMS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, "2:"
#: Components up to this size keep every squared distance below 2^61.
_SAFE = 1 << 26
_ROWS = 4096


def kept_vectors(vectors: DataFrame, dims: int = DIMS) -> DataFrame:
    """(vec_id, embedding) of the vectors with exactly ``dims`` components,
    none of them null, infinite or not a number."""
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .filter((F.size("embedding") == dims) & ok))


def to_integers(values: np.ndarray) -> np.ndarray:
    """floor(256 x): 64-bit integers, or Python's where those are too small."""
    q = np.floor(float(SCALE) * values.astype(np.float64)) if len(values) else np.zeros(values.shape)
    if not q.size or np.abs(q).max() <= _SAFE:
        return q.astype(np.int64)
    # A product beyond a double's range is exact all the same.
    return np.array([[SCALE * int(x) if abs(x) >= 2.0 ** 53 else int(y) for x, y in zip(r, s)]
                     for r, s in zip(values.tolist(), q.tolist())], dtype=object)


class Orchard:
    """Nearest of a fixed set of integer centroids; ties go to the smaller number."""

    def __init__(self, centroids: list[list[int]]):
        big = max((abs(x) for c in centroids for x in c), default=0) > _SAFE
        self.centroids = np.array(centroids, dtype=object if big else np.int64)
        exact = self.centroids.astype(object)
        self.apart = np.array([[int(((a - b) ** 2).sum()) for b in exact] for a in exact], dtype=object)
        number = np.arange(len(exact))
        #: For each centroid the others, nearest first.
        self.lists = np.array([[j for j in sorted(number, key=lambda j: (self.apart[i, j], j)) if j != i]
                               for i in number], np.int64).reshape(len(exact), max(len(exact) - 1, 0))
        if not big:
            self.apart = self.apart.astype(np.int64)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance) of the nearest centroid of each point, and
        how many distances were computed."""
        cents, apart = self.centroids, self.apart
        if points.dtype == object or cents.dtype == object:
            points, cents, apart = points.astype(object), cents.astype(object), apart.astype(object)
        n, k = len(points), len(cents)
        at = np.zeros(n, np.int64)
        best = ((points - cents[0]) ** 2).sum(axis=1)
        seen = np.zeros((n, k), bool)
        seen[:, 0] = True
        place = np.zeros(n, np.int64)
        walking, computed = np.arange(n), n
        while walking.size:
            walking = walking[place[walking] < k - 1]
            candidate = self.lists[at[walking], place[walking]]
            near = ~(apart[at[walking], candidate] > 4 * best[walking]).astype(bool)
            walking, candidate = walking[near], candidate[near]
            place[walking] += 1
            fresh = ~seen[walking, candidate]
            rows, number = walking[fresh], candidate[fresh]
            seen[rows, number] = True
            computed += len(rows)
            d = ((points[rows] - cents[number]) ** 2).sum(axis=1)
            closer = ((d < best[rows]) | ((d == best[rows]) & (number < at[rows]))).astype(bool)
            rows = rows[closer]
            at[rows], best[rows], place[rows] = number[closer], d[closer], 0
        return at, best, computed


def _points(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            values = part.column("embedding").flatten().to_numpy(zero_copy_only=False)
            yield part.column("vec_id"), to_integers(values.reshape(-1, dims))


def _limbs(n: int) -> list[tuple[int, int]]:
    """n as signed 64-bit digits: [(place, digit)]."""
    out, place = [], 0
    while not -(1 << 63) <= n < 1 << 63:
        out.append((place, n & ((1 << 64) - 1)))
        n, place = n >> 64, place + 1
    return out + [(place, n)]


def centroid_sums(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(cluster, pos, limb, total): sums of the vectors of each centroid by
    component, ``pos`` -1 their number.  Sums are taken in each task first."""
    k, dims = len(centroids), len(centroids[0])

    def run(batches):
        search, sums, counts = Orchard(centroids), [[0] * dims for _ in range(k)], [0] * k
        for _, points in _points(batches, dims):
            at, _, _ = search.nearest(points)
            for c in np.unique(at):
                mine = points[at == c]
                counts[c] += len(mine)
                sums[c] = [a + int(b) for a, b in zip(sums[c], mine.sum(axis=0))]
        rows = [(c, pos, limb, str(digit)) for c in range(k) if counts[c]
                for pos, total in [(-1, counts[c]), *enumerate(sums[c])] for limb, digit in _limbs(total)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.string()))], ["cluster", "pos", "limb", "digit"])

    found = vectors.mapInArrow(run, "cluster int, pos int, limb int, digit string")
    return (found.groupBy("cluster", "pos", "limb")
            .agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("total")))


def first_centroids(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    """Integer components of the k vectors with the smallest hash of seed and
    vec_id.  A null vec_id comes last; equal ids are ordered by components."""
    key = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(key.asc_nulls_last(), "embedding").limit(k).select("embedding").collect()
    return to_integers(np.array([r[0] for r in rows], np.float64)).tolist() if rows else []


def fit(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> list[list[int]]:
    """Centroids after ``rounds`` rounds over kept vectors.  What reaches the
    driver is k rows of sums a round, whatever the number of vectors."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        total: dict[tuple[int, int], int] = {}
        for r in centroid_sums(vectors, centroids).collect():
            total[r["cluster"], r["pos"]] = total.get((r["cluster"], r["pos"]), 0) + (int(r["total"]) << (64 * r["limb"]))
        centroids = [[total.get((c, p), 0) // total[c, -1] for p in range(len(old))] if (c, -1) in total else old
                     for c, old in enumerate(centroids)]
    return centroids


def assign(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance); a squared distance beyond a long is null."""
    dims = len(centroids[0])

    def run(batches):
        search = Orchard(centroids)
        for ids, points in _points(batches, dims):
            at, best, _ = search.nearest(points)
            d = [int(x) if x < 1 << 63 else None for x in best] if best.dtype == object else best
            yield pa.RecordBatch.from_arrays([ids, pa.array(at.astype(np.int32)), pa.array(d, pa.int64())],
                                             ["vec_id", "cluster", "distance"])
    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


OUT = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("cluster", T.IntegerType()),
                    T.StructField("distance", T.LongType()), T.StructField("cluster_inertia", T.LongType()),
                    T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType())])


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, seed: str = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    One row per kept vector; repeated rows are clustered each for itself and a
    null vec_id stays null.  With fewer than k vectors there are fewer
    centroids, with none an empty result.  An inertia that holds a distance
    beyond a long, or is beyond one itself, is null."""
    spark = vectors.sparkSession
    vectors = kept_vectors(vectors, dims)
    centroids = fit(vectors, k, rounds, seed)
    if not centroids:
        return spark.createDataFrame([], OUT)
    found = materialise(assign(vectors, centroids), "assigned")
    whole = F.count("distance") == F.count(F.lit(1))
    sums = found.groupBy("cluster").agg(F.when(whole, F.sum(F.col("distance").cast("decimal(38,0)"))).alias("s")).collect()
    size = {r["cluster"]: None if r["s"] is None else int(r["s"]) for r in sums}

    def fits(total: int | None) -> int | None:
        return total if total is not None and total < 1 << 63 else None
    inertia = fits(None if None in size.values() else sum(size.values()))
    rows = [(c, fits(s), inertia, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
            for c, s in size.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # At most k rows.
    return found.join(F.broadcast(facts), "cluster").select(*OUT.names)


def op11_centroid_clusters(spark, sf_dir: str) -> DataFrame:
    return cluster(U.table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The same rounds as plain joins on components: every distance is computed."""
    parts = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         [CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT) FOR e IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = {DIMS} AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0)""",
             f"x AS MATERIALIZED (SELECT rid, unnest(range({DIMS})) AS pos, unnest(v) AS x FROM kept)",
             f"""first AS MATERIALIZED (
  SELECT v, row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS k
  FROM (SELECT v, sha256('{SEED}' || CAST(vec_id AS VARCHAR)) AS h FROM kept) ORDER BY h NULLS LAST, v LIMIT {CENTROIDS})""",
             f"c0 AS MATERIALIZED (SELECT k, unnest(range({DIMS})) AS pos, unnest(v) AS y FROM first)"]
    for i in range(ROUNDS + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, k, d FROM (SELECT rid, k, d, row_number() OVER (PARTITION BY rid ORDER BY d, k) AS rn
    FROM (SELECT rid, k, sum((x - y) * (x - y)) AS d FROM x JOIN c{i} USING (pos) GROUP BY rid, k)) WHERE rn = 1)""")
        if i < ROUNDS:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT k, pos, CAST(CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END AS BIGINT) AS y
  FROM (SELECT k, pos, sum(x) AS s, count(*) AS n FROM a{i} JOIN x USING (rid) GROUP BY k, pos)
  UNION ALL SELECT k, pos, y FROM c{i} WHERE k NOT IN (SELECT k FROM a{i}))""")
    last = ROUNDS
    return f"""WITH {', '.join(parts)}
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{last} JOIN kept USING (rid)
JOIN (SELECT k, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY pos)) AS h FROM c{last} GROUP BY k) USING (k)"""


OP11_SQL = _sql()
