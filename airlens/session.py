"""Spark session settings the library relies on.

Everything here is plain session configuration: UTC calendar days, dynamic
partition overwrite for keyed upserts, AQE for runtime re-planning (skewed
joins, partition coalescing), and a checkpoint folder taken from the cluster
setting ``spark.checkpoint.dir`` when one is configured.
"""
from __future__ import annotations

import atexit
import os
import re
import shutil
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every job needs regardless of cluster size.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Bounded batches between the JVM and Python, whatever the length of a text.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings the operators assume (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    # Python workers find the package where the driver found it.
    root, env = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    # A task has one core: matrix products in several threads would take its neighbours'.
    env.setdefault("OPENBLAS_NUM_THREADS", "1")
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "airlens") -> SparkSession:
    """Session for tests, bench and local runs.  On a cluster use the
    session the platform hands out and call :func:`configure` on it."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
          .config("spark.driver.memory", os.environ.get("AIRLENS_DRIVER_MEMORY", "8g"))
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Uses ``spark.checkpoint.dir`` from the session (the cluster's shared
    folder).  When nothing is configured, a local master gets a folder below
    the JVM's own temporary folder (tests, bench); any other master is an
    error, because its nodes would not see each other's files.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all nodes share")
        d = f"{sc._jvm.java.lang.System.getProperty('java.io.tmpdir')}/airlens-{sc.applicationId}"
        spark.conf.set("spark.checkpoint.dir", d)
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for one intermediate table, in the shared folder."""
    sc = spark.sparkContext
    return f"{checkpoint_dir(spark).rstrip('/')}/tables-{sc.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


#: Tables written inside the running :func:`settled` call, if any.
_PASSING: ContextVar[list | None] = ContextVar("passing", default=None)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Later jobs read the written rows, so they survive lost executors and
    neither repeat nor vary the work above them."""
    path = scratch_path(df.sparkSession, name)
    if _PASSING.get() is not None:
        _PASSING.get().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """:func:`materialise` what ``build()`` returns and delete the tables that
    were written on the way to it."""
    token = _PASSING.set(passing := [])
    try:
        df = build()
        path = scratch_path(spark, name)
        df.write.parquet(path)
    finally:
        _PASSING.reset(token)
        for p in passing:
            _delete(spark, p)
    if _PASSING.get() is not None:
        _PASSING.get().append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def transient(spark: SparkSession) -> Iterator[None]:
    """Tables that are materialised inside are deleted at the end, whether the
    block succeeds or not; for work that leaves no lazy frame behind."""
    token = _PASSING.set(passing := [])
    try:
        yield
    finally:
        _PASSING.reset(token)
        for p in passing:
            _delete(spark, p)


def drop_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table this application has written."""
    _delete(spark, f"{checkpoint_dir(spark).rstrip('/')}/tables-{spark.sparkContext.applicationId}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss; never a local one)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
