"""Near-duplicate groups by b-bit MinHash (operator 6).

Per text: the set of hashed word shingles, one minimum per hash function, band
keys over groups of full minima, and the low bits of all minima packed into a
signature.  Texts that share a band key are candidates.  In a bucket the
resemblance is estimated from the number of equal low bits, corrected for the
bits that agree by chance, and links of a spanning forest are kept, so a
bucket of n texts gives at most n - 1 links.  The components of these links
are clusters; inside a cluster full shingle sets are compared, again up to a
spanning forest, which gives the exact components: a comparison is left out
only between texts already known to be connected.

Texts with the same set are one node from the start.  Buckets and clusters
beyond a fixed size are split into chunks and handled chunk pair by chunk
pair, so no task holds more than two chunks.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm import common as U
from airlens.llm.components import components
from airlens.llm.wordhash import mix, shingle_hashes, word_hashes
from airlens.session import materialise, settled

#: Members of a bucket, and shingles of a cluster, that one chunk holds.
BUCKET_CHUNK = 2048
CLUSTER_CHUNK = 2_000_000


@dataclass(frozen=True)
class MinHash:
    """Resemblance of ``percent`` / 100 or more over shingles of ``words``.

    ``bands`` follows from ``miss``, the chance that a pair just at the
    threshold shares no band.  ``slack`` is how many standard deviations below
    the threshold an estimate may lie and still be compared exactly."""
    words: int = 5
    percent: int = 80
    rows: int = 5
    bits: int = 2
    miss: float = 1e-6
    slack: float = 6.0

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def most_unequal(self) -> int:
        """Unequal minima (by their low bits) at which a pair is still compared."""
        chance = 2.0 ** -self.bits
        equal = self.percent / 100 * (1 - chance) + chance
        return math.ceil(self.hashes * (1 - equal) + self.slack * math.sqrt(self.hashes * equal * (1 - equal)))

    def resemblance(self, unequal: np.ndarray) -> np.ndarray:
        """Estimate corrected for low bits that agree by chance."""
        chance = 2.0 ** -self.bits
        return ((1 - unequal / self.hashes) - chance) / (1 - chance)

    def alike(self, common, a, b):
        """The exact test on set sizes."""
        return 100 * common >= self.percent * (a + b - common)


def pack_bits(minima: np.ndarray, bits: int) -> np.ndarray:
    """Low ``bits`` of each minimum, in 64-bit words; a row per text."""
    per = 64 // bits
    n, h = minima.shape
    low = np.zeros((n, -(-h // per) * per), np.uint64)
    low[:, :h] = minima & np.uint64((1 << bits) - 1)
    shift = (np.arange(per, dtype=np.uint64) * np.uint64(bits))
    return np.bitwise_or.reduce(low.reshape(n, -1, per) << shift, axis=2)


def unequal_fields(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Number of packed fields in which the rows of a and b differ."""
    x = a ^ b
    any_ = x.copy()
    for i in range(1, bits):
        any_ |= x >> np.uint64(i)
    lowest = np.uint64(sum(1 << (i * bits) for i in range(64 // bits)))
    return np.bitwise_count(any_ & lowest).sum(axis=-1, dtype=np.int64)


def shingle_sets(texts: list[str], words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z lower-cased."""
    hashes, counts = word_hashes([t.encode().lower() for t in texts])
    for h in np.split(hashes, np.cumsum(counts)[:-1]):
        yield np.unique(shingle_hashes(h, words))


def minima(sets: list[np.ndarray], hashes: int, chunk: int = 1 << 14) -> np.ndarray:
    """Smallest value of each hash function over each set (none empty)."""
    rng = np.random.default_rng(7)
    mult = rng.integers(1, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(0, 1 << 63, hashes, dtype=np.uint64)
    out = np.full((len(sets), hashes), np.iinfo(np.uint64).max, np.uint64)
    flat = np.concatenate(sets)
    ends = np.cumsum([len(s) for s in sets])
    starts = ends - [len(s) for s in sets]
    for lo in range(0, len(flat), chunk):
        part = flat[lo:lo + chunk]
        first, last = np.searchsorted(ends, lo, side="right"), np.searchsorted(starts, lo + len(part))
        at = np.maximum(starts[first:last] - lo, 0)
        for j in range(hashes):
            low = np.minimum.reduceat(part * mult[j] + plus[j], at)
            np.minimum(out[first:last, j], low, out=out[first:last, j])
    return out


SIGNATURES = "doc_id long, text_key string, n_shingles long, set_key binary, bands array<long>, signature binary"


def sign_batches(batches: Iterator[pa.RecordBatch], m: MinHash) -> Iterator[pa.RecordBatch]:
    """Texts without words get a null set_key and take no further part."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = part.column("text").to_pylist()
            sets = list(shingle_sets(texts, m.words))
            full = [s for s in sets if len(s)]
            keys, bands, signatures = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            if full:
                low = minima(full, m.hashes)
                band = low.reshape(len(full), m.bands, m.rows)
                key = np.repeat(np.arange(1, m.bands + 1, dtype=np.uint64)[None, :], len(full), axis=0)
                for r in range(m.rows):
                    key = mix(key + band[:, :, r])
                packed, n = pack_bits(low, m.bits), 0
                for k, s in enumerate(sets):
                    if len(s):
                        keys[k] = blake2b(s.tobytes(), digest_size=16).digest()
                        bands[k], signatures[k] = key[n].view(np.int64), packed[n].tobytes()
                        n += 1
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array([sha256(t.encode()).hexdigest() for t in texts]),
                pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())), pa.array(signatures, pa.binary()),
            ], names=["doc_id", "text_key", "n_shingles", "set_key", "bands", "signature"])


def groups_in(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``keys``; a group is held
    until the next one begins."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1] for k in keys]
        if held and [held[-1].column(k)[held[-1].num_rows - 1] for k in keys] == last:
            held.append(batch)
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            c = batch.column(k).to_numpy(zero_copy_only=False)
            change |= c[1:] != c[:-1]
        cuts = np.flatnonzero(change)
        if not len(cuts) and held and [held[-1].column(k)[held[-1].num_rows - 1] for k in keys] != last:
            yield pa.Table.from_batches(held)
            held = [batch]
            continue
        cut = int(cuts[-1]) + 1 if len(cuts) else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def runs(table: pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the groups in a table sorted by ``keys``."""
    n = table.num_rows
    change = np.ones(n, bool)
    change[1:] = False
    for k in keys:
        c = table.column(k).to_numpy()
        change[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(change)
    return starts, np.append(starts[1:], n)


def forest(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(member, newly reached members): a spanning forest of 0..n-1, where
    linked(i, others) tells which of ``others`` are linked to i."""
    rest = np.arange(n)
    while len(rest) > 1:
        todo, rest = [int(rest[0])], rest[1:]
        while todo and len(rest):
            i = todo.pop()
            hit = linked(i, rest)
            if hit.any():
                new = rest[hit]
                yield i, new
                todo.extend(new.tolist())
                rest = rest[~hit]


def _edges(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())],
                                      names=["a", "b"])


def link_buckets(batches: Iterator[pa.RecordBatch], m: MinHash) -> Iterator[pa.RecordBatch]:
    """Forest links of each bucket (key, i, j) by the estimate."""
    keys, most = ["key", "i", "j"], m.most_unequal
    for table in groups_in(batches, keys):
        nodes = table.column("node").to_numpy()
        sig = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint64).reshape(len(nodes), -1)
        starts, ends = runs(table, keys)
        a, b = [], []
        two = starts[ends - starts == 2]
        near = two[unequal_fields(sig[two], sig[two + 1], m.bits) <= most]
        a.append(nodes[near])
        b.append(nodes[near + 1])
        for s, e in zip(starts.tolist(), ends.tolist()):
            if e - s > 2:
                own = sig[s:e]
                for i, new in forest(e - s, lambda i, rest: unequal_fields(own[rest], own[i], m.bits) <= most):
                    a.append(np.full(len(new), nodes[s + i]))
                    b.append(nodes[s + new])
        yield _edges(a, b)


def exact_links(sets: list[np.ndarray], m: MinHash) -> Iterator[tuple[int, np.ndarray]]:
    """Spanning forest under the exact test on full sets."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        if m.alike(common, sizes[0], sizes[1]):
            yield 0, np.array([1])
        return
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    marked = np.zeros(int(flat.max()) + 1, np.int64)
    view = {"of": None}  # members still to reach, with their sets side by side

    def linked(i: int, rest: np.ndarray) -> np.ndarray:
        if view["of"] is None or len(view["of"]) > 2 * len(rest):
            view["of"] = rest
            view["flat"] = np.concatenate([flat[ends[r] - sizes[r]:ends[r]] for r in rest])
            view["at"] = np.cumsum(sizes[rest]) - sizes[rest]
        own = flat[ends[i] - sizes[i]:ends[i]]
        marked[own] = 1
        common = np.add.reduceat(marked[view["flat"]], view["at"])
        marked[own] = 0
        common = common[np.searchsorted(view["of"], rest)]
        return m.alike(common, sizes[i], sizes[rest])

    yield from forest(len(sets), linked)


def confirm_clusters(batches: Iterator[pa.RecordBatch], m: MinHash) -> Iterator[pa.RecordBatch]:
    """Forest links of each cluster chunk pair on full sets."""
    keys = ["cluster", "i", "j"]
    for table in groups_in(batches, keys):
        nodes = table.column("node").to_numpy()
        shingles = table.column("shingles")
        starts, ends = runs(table, keys)
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for s, e in zip(starts.tolist(), ends.tolist()):
            if e - s > 1:
                sets = [np.frombuffer(shingles[k].as_py(), np.uint64) for k in range(s, e)]
                for i, new in exact_links(sets, m):
                    a.append(np.full(len(new), nodes[s + i]))
                    b.append(nodes[s + new])
        yield _edges(a, b)


def set_batches(batches: Iterator[pa.RecordBatch], m: MinHash) -> Iterator[pa.RecordBatch]:
    """(node, shingles) of the rows whose text has the wanted set."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sets = list(shingle_sets(part.column("text").to_pylist(), m.words))
            keep = [k for k, (s, key) in enumerate(zip(sets, part.column("set_key").to_pylist()))
                    if blake2b(s.tobytes(), digest_size=16).digest() == key]
            yield pa.RecordBatch.from_arrays([part.column("node").take(pa.array(keep, pa.int64())),
                                              pa.array([sets[k].tobytes() for k in keep], pa.binary())],
                                             names=["node", "shingles"])


def in_chunk_pairs(members: DataFrame, chunks: str) -> DataFrame:
    """Adds i <= j: a member of a group of ``chunks`` chunks goes to every pair
    of chunks that has its own; groups of one chunk go to (0, 0) alone."""
    own = F.pmod(F.xxhash64("node"), F.col(chunks))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col(chunks) - 1))
    return (members.withColumn("__own", own).withColumn("__other", other)
            .withColumn("i", F.least("__own", "__other")).withColumn("j", F.greatest("__own", "__other"))
            .drop("__own", "__other", chunks))


def link(docs: DataFrame, m: MinHash) -> DataFrame:
    """A row per row of ``docs``: doc_id, text_key, n_shingles and group."""
    spark = docs.sparkSession
    signed = materialise(U.doc_text(docs).mapInArrow(lambda it: sign_batches(it, m), SIGNATURES), "signatures")
    full = signed.filter("set_key is not null")
    nodes = materialise(full.dropDuplicates(["set_key"]).withColumn("node", F.monotonically_increasing_id())
                        .select("node", "set_key", "doc_id", "text_key", "n_shingles", "bands", "signature"), "nodes")

    # Buckets of two or more nodes, split where they are large.
    entries = nodes.select("node", F.explode("bands").alias("key"))
    shared = (entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
              .select("key", F.ceil(F.col("n") / BUCKET_CHUNK).cast("long").alias("chunks")))
    members = entries.join(shared, "key").join(nodes.select("node", "signature"), "node")
    members = in_chunk_pairs(members, "chunks").select("key", "i", "j", "node", "signature")
    links = (members.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
             .mapInArrow(lambda it: link_buckets(it, m), "a long, b long").distinct())
    clusters = settled(spark, "clusters", lambda: components(links).withColumnRenamed("label", "cluster"))

    # Exact comparison inside the clusters.
    wanted = clusters.join(nodes.select("node", "set_key", "doc_id", "text_key", "n_shingles"), "node")
    chunks = (wanted.groupBy("cluster").agg(F.sum("n_shingles").alias("n"))
              .select("cluster", F.ceil(F.col("n") / CLUSTER_CHUNK).cast("long").alias("chunks")))
    text = U.doc_text(docs).withColumn("__key", U.text_key())
    sets = (wanted.select("node", "set_key", F.col("doc_id").alias("__id"), "text_key")
            .join(text, (F.col("text_key") == F.col("__key")) & F.col("__id").eqNullSafe(text["doc_id"]))
            .select("node", "set_key", "text")
            .mapInArrow(lambda it: set_batches(it, m), "node long, shingles binary"))
    sets = materialise(sets.dropDuplicates(["node"]), "sets")
    members = in_chunk_pairs(clusters.join(chunks, "cluster"), "chunks").join(sets, "node")
    exact = (members.select("cluster", "i", "j", "node", "shingles")
             .repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "node")
             .mapInArrow(lambda it: confirm_clusters(it, m), "a long, b long"))
    labels = settled(spark, "labels", lambda: components(exact))

    of_set = (nodes.select("node", "set_key").join(labels, "node", "left")
              .select("set_key", F.coalesce("label", "node").alias("group")))
    return (signed.select("doc_id", "text_key", "n_shingles", "set_key").join(of_set, "set_key", "left")
            .drop("set_key"))


def near_groups(docs: DataFrame, m: MinHash = MinHash()) -> DataFrame:
    """A row per row of ``docs``: doc_id, text_key, n_shingles, component_id
    and group (an opaque number; null for texts without words).

    component_id is the smallest doc_id of the group, null if it has none
    (null doc_ids only); texts without words are linked with nothing and keep
    their own doc_id.  Repeated rows have equal sets and so are one group."""
    rows = settled(docs.sparkSession, "near-rows", lambda: link(docs, m))
    least = settled(docs.sparkSession, "least-ids", lambda: rows.filter("group is not null").groupBy("group").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    return rows.join(least, "group", "left").select(
        "doc_id", "text_key", "n_shingles",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), "group")


def drop_near_copies(docs: DataFrame, m: MinHash = MinHash()) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id (nulls
    last, then by text).  Texts without words all stay."""
    rows = settled(docs.sparkSession, "near-groups", lambda: near_groups(docs, m))
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key")
    first = rows.filter("group is not null").groupBy("group").agg(F.min(order).alias("keep"))
    kept = first.select(F.col("keep.doc_id").alias("doc_id"), F.col("keep.text_key").alias("text_key"))
    copies = (rows.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies"))
              .select(F.col("doc_id").alias("i"), F.col("text_key").alias("k"), "copies"))
    kept = (kept.unionByName(rows.filter("group is null").select("doc_id", "text_key"))
            .join(copies, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")))
            .select("doc_id", "text_key", "copies"))
    return U.keep_rows(docs, kept)


#: The contract of the registered query: three words, 85 in 100.
CONTRACT = MinHash(words=3, percent=85)


def op6_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    rows = near_groups(U.documents(spark, sf_dir), CONTRACT)
    return rows.select("doc_id", "n_shingles", "component_id",
                       (F.col("doc_id") == F.col("component_id")).alias("kept"))


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
           ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS s FROM w)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), e2 AS (SELECT a, b FROM e UNION SELECT b, a FROM e
), r(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e2.b FROM r JOIN e2 ON e2.a = r.other
), m AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT m.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, m.doc_id = component_id AS kept
FROM m LEFT JOIN n ON n.doc_id = m.doc_id
"""
