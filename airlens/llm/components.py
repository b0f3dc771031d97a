"""Connected components by alternating large-star and small-star steps."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.session import materialise


def _star(pairs: DataFrame) -> DataFrame:
    """(u, v) with the smallest of u and its v's as ``m``.  The minima are
    written first, so that both sides of the join are plain shuffles and a node
    with very many links is split."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(materialise(least, "least"), "u")


#: Links that a task contracts at a time.
CONTRACTED = 1 << 18


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node that the links u-v lead to from each)."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            return nodes, nodes[label]
        for side in (a, b):  # links and the present roots of their ends
            np.minimum.at(label, label[side], low)
            np.minimum.at(label, side, low)
        while (label[label] != label).any():
            label = label[label]


def contract_batches(batches: Iterator[pa.RecordBatch], most: int = CONTRACTED) -> Iterator[pa.RecordBatch]:
    """Links (u, v) in runs of about ``most``, each run's components as stars
    around their smallest nodes."""
    held: list[pa.RecordBatch] = []

    def stars() -> pa.RecordBatch:
        u, v = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in ("u", "v"))
        nodes, least = least_reachable(u, v)
        far = nodes > least
        return pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(least[far])], names=["u", "v"])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= most:
            yield stars()
            held = []
    if held:
        yield stars()


def _contracted(links: DataFrame) -> DataFrame:
    return links.mapInArrow(contract_batches, "u long, v long")


def _are_stars(links: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u."""
    up = links.select(F.col("u").alias("node"), F.col("v").alias("to"), F.lit(False).alias("below"))
    down = links.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("to"), F.lit(True).alias("below"))
    ends = up.unionByName(down).groupBy("node").agg(F.min("to").alias("lo"), F.max("to").alias("hi"), F.max("below").alias("below"))
    return ends.filter("lo < hi or (below and lo is not null)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a long, b long): label is the
    smallest node that can be reached.

    Links and labels stay distributed.  Each task first contracts the links it
    reads, a bounded run at a time; rounds follow only while links of different
    runs are left to join.  Each round halves the depth at least and its links
    are written to the shared folder; the number of rounds grows with the
    logarithm of the longest chain."""
    up = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v")
    links = materialise(_contracted(materialise(up, "up")), "links")
    while not _are_stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
        large = materialise(_star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
                            "large")
        small = _star(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        links = materialise(_contracted(materialise(small, "small")), "links")
    labels = links.select(F.col("u").alias("node"), F.col("v").alias("label")).distinct()
    return labels.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
