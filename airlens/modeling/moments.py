"""Additive second moments.

The sums of products of all columns, with an indicator of each column's
nulls, are additive over blocks of rows.  One pass gives them per time block;
an expanding fold is the sum of the blocks before its test block, and mean
imputation is a linear change of the columns.  So every ridge of every fold,
its error on the test block and the matrix of correlations follow from these
matrices without reading a row again.
"""
from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens import constants as C
from airlens.modeling.selection import positions


class Moments:
    """Sums over rows of z z' with z = (1, x - shift where present, null?) and
    of (x - shift)^2 null?', for the named columns."""

    def __init__(self, cols: Sequence[str], shift: np.ndarray, zz: np.ndarray, sq: np.ndarray):
        self.cols, self.shift, self.zz, self.sq = list(cols), shift, zz, sq

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.cols, self.shift, self.zz + other.zz, self.sq + other.sq)

    @property
    def n(self) -> float:
        return self.zz[0, 0]

    def filled(self, means: Mapping[str, float]) -> np.ndarray:
        """Sums of products of (1, x - shift) with nulls replaced by ``means``."""
        m = len(self.cols)
        t = np.zeros((1 + 2 * m, 1 + m))
        t[0, 0] = 1
        for i, c in enumerate(self.cols):
            t[1 + i, 1 + i], t[1 + m + i, 1 + i] = 1, means.get(c, 0.0) - self.shift[i]
        return t.T @ self.zz @ t

    def correlations(self) -> np.ndarray:
        """Pearson correlation of every pair over the rows where both are
        present; nan where one of them is constant there."""
        m = len(self.cols)
        x, q = slice(1, 1 + m), slice(1 + m, 1 + 2 * m)
        n = self.n - self.zz[0, q][:, None] - self.zz[0, q][None] + self.zz[q, q]
        s = self.zz[0, x][:, None] - self.zz[x, q]           # sum of x_i where j is present
        ss = np.diag(self.zz[x, x])[:, None] - self.sq       # and of its square
        with np.errstate(all="ignore"):
            var = np.maximum(ss - s * s / n, 0)
            var = np.where(var <= 1e-12 * np.maximum(ss, 1e-300), 0, var)
            return (self.zz[x, x] - s * s.T / n) / np.sqrt(var * var.T)


def block_moments(df: DataFrame, cols: Sequence[str], block: str | None = None) -> dict[int, Moments]:
    """Moments of each value of the integer column ``block`` (one block without).

    Tasks sum their rows first; what is shuffled and collected is one number
    for each block and pair of columns, whatever the number of rows."""
    cols, m = list(cols), len(cols)
    first = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).first()
    shift = np.array([0.0 if first is None or v is None or not np.isfinite(v) else v for v in (first or [None] * m)])
    size = 1 + 2 * m

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            v = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], 1).astype(float)
            null = np.stack([c.is_null().to_numpy(zero_copy_only=False) for c in batch.columns[1:]], 1)
            u = np.where(null, 0.0, v - shift)
            z = np.concatenate([np.ones((len(u), 1)), u, null.astype(float)], 1)
            for b in np.unique(at):
                mine = at == b
                both = np.concatenate([(z[mine].T @ z[mine]).ravel(), ((u[mine] ** 2).T @ null[mine]).ravel()])
                sums[int(b)] = sums.get(int(b), 0) + both
        for b, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), b, np.int32)), pa.array(at.astype(np.int32)),
                                              pa.array(total[at])], ["block", "place", "value"])
    src = df.select((F.col(block) if block else F.lit(0)).cast("int").alias("block"),
                    *[F.col(c).cast("double").alias(c) for c in cols])
    rows = src.mapInArrow(run, "block int, place int, value double").groupBy("block", "place").agg(F.sum("value").alias("value"))
    flat: dict[int, np.ndarray] = {}
    for r in rows.collect():
        flat.setdefault(r["block"], np.zeros(size * size + m * m))[r["place"]] = r["value"]
    return {b: Moments(cols, shift, x[:size * size].reshape(size, size), x[size * size:].reshape(m, m)) for b, x in flat.items()}


def ridge(train: Moments, target: str, means: Mapping[str, float], alpha: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept (of shifted columns) of the standardised
    ridge with penalty ``alpha`` on the sum of squares."""
    s, y = train.filled(means), 1 + train.cols.index(target)
    x = [i for i in range(1, len(s)) if i != y]
    n, mean = s[0, 0], s[0] / s[0, 0]
    cov = s[np.ix_(x, x)] - n * np.outer(mean[x], mean[x])
    sd = np.sqrt(np.maximum(np.diag(cov) / n, 0))
    live = sd > 1e-9 * np.sqrt(np.maximum(np.diag(s)[x] / n, 1e-300))
    w = np.zeros(len(x))
    if live.any():
        scaled = cov[np.ix_(live, live)] / np.outer(sd[live], sd[live])
        xy = (s[x, y] - n * mean[x] * mean[y])[live] / sd[live]
        w[live] = np.linalg.solve(scaled + alpha * np.eye(int(live.sum())), xy) / sd[live]
    return w, mean[y] - w @ mean[x]


def squared_error(test: Moments, target: str, means: Mapping[str, float], w: np.ndarray, intercept: float) -> float:
    s, y = test.filled(means), 1 + test.cols.index(target)
    at = np.zeros(len(s))
    at[y], at[0] = 1.0, -intercept
    at[[i for i in range(1, len(s)) if i != y]] = -w
    return max(float(at @ s @ at), 0.0)


def ridge_cv(train: DataFrame, features: Sequence[str], target: str, means: Mapping[str, float], alphas: Sequence[float],
             key="city", order: str = "date", n_splits: int = C.CV_SPLITS) -> dict[float, list[float]]:
    """RMSE of each fold of W19 for every ``alpha``, from one pass over ``train``."""
    size = F.floor(F.col("n") / (n_splits + 1))
    block = F.greatest(F.lit(0), n_splits - F.floor((F.col("n") - F.col("rn")) / F.nullif(size, F.lit(0))))
    rows = positions(train, key, order).withColumn("_block", F.coalesce(block, F.lit(0)))
    blocks = block_moments(rows, [*features, target], "_block")
    out = {}
    for alpha in alphas:
        so_far, scores = blocks[0], []
        for k in range(1, n_splits + 1):
            if k not in blocks:
                break
            w, b = ridge(so_far, target, means, alpha)
            scores.append(float(np.sqrt(squared_error(blocks[k], target, means, w, b) / blocks[k].n)))
            so_far = so_far + blocks[k]
        out[alpha] = scores
    return out


def correlation_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A14/A15 from one pass: (feature, target, corr) for every pair of ``cols``."""
    spark, cols = df.sparkSession, list(cols)
    r = next(iter(block_moments(df, cols).values()), None)
    r = r.correlations() if r is not None else np.full((len(cols), len(cols)), np.nan)
    rows = [(a, b, float(r[i, j]) if np.isfinite(r[i, j]) else None) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return spark.createDataFrame(rows, "feature string, target string, corr double")
