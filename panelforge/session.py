"""Spark session helpers.

Every operator in this package is a lazy DataFrame transformation; the only
session-level requirements are a UTC clock (year() of timestamps must agree with
other engines), ANSI-safe arithmetic (operators use ``try_divide``) and a shared
checkpoint folder for the few jobs that cut lineage.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Bytes of an Arrow batch sent to a Python worker; Spark's 10,000 rows are tens of MB of texts, held by the executor and by the worker.
BATCH_BYTES = 4 << 20


def build_session(master: str | None = None, app_name: str = "panelforge",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests, the bench and local runs.

    On a cluster, pass nothing: master and shuffle partitions come from the
    submitting environment; AQE coalesces partitions at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = "16g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Idempotent per-session settings every query relies on."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session by their bytes; batches of narrow rows stay as they are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session; only when it is unset under a local master (tests,
    laptops) a fresh local folder is taken.  On a cluster an unset folder is an error.
    """
    path = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not path:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="panelforge-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location for written intermediates."""
    return os.path.join(checkpoint_dir(spark), name)


def materialize(df):
    """Cut lineage before a multi-pass operator: a reliable checkpoint in the shared folder.

    Multi-pass operators (regressions with robust errors, rank tests, model fits)
    scan their input several times; the checkpoint makes the expensive upstream
    plan run once and survives executor loss (unlike a local checkpoint).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def at_once(spark: SparkSession, jobs: Sequence[Callable[[], object]], n: int = 8) -> list:
    """Results of ``jobs``, ``n`` at a time: fits of many small jobs each wait for each other, not for the cluster."""
    run = inheritable_thread_target(spark)(lambda job: job())
    with ThreadPool(max(1, min(n, len(jobs)))) as pool:
        return pool.map(run, jobs, chunksize=1)
