"""Session helpers: defaults for tests/bench, shared scratch folders.

Library operators never create a session; they take the one they are given.
``build_session`` is for tests, the bench and command-line runs only.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", app_name: str = "barflow",
                  shuffle_partitions: int = 8, driver_memory: str = "8g",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    try:
        d = spark.sparkContext.getCheckpointDir()
        if d:
            return d
    except Exception:  # Spark Connect has no SparkContext
        pass
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir; a local one is made only for a local
    master (tests, single-machine runs), and removed when Python exits. On a cluster
    ``spark.checkpoint.dir`` must name a shared folder: executors would each write
    a machine-local one to a disk of their own."""
    d = checkpoint_dir(spark)
    if d:
        return d
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a shared folder (master {master!r})")
    d = tempfile.mkdtemp(prefix="barflow-ckpt-")
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(d)
    return checkpoint_dir(spark) or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir for written
    intermediate tables (never a machine-local temp dir on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/barflow-scratch/{name}-{uuid.uuid4().hex}"


def materialise(df, name: str):
    """``df`` written once, columnar, to a scratch table and read back, and its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table wherever its file system is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
KEPT_LISTS = "spark.sql.hive.manageFilesourcePartitions"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """While paths are listed: a task for many of them, and not one each up to 10,000; and the
    lists are not kept in the driver's shared cache (up to 250 MB) after the frame is gone. The
    session gets its own settings back; a stream reads them at each batch, so its whole run
    belongs inside."""
    before = {k: spark.conf.get(k) for k in (LISTING, KEPT_LISTS)}
    spark.conf.set(LISTING, str(min(int(before[LISTING]), 4 * spark.sparkContext.defaultParallelism)))
    spark.conf.set(KEPT_LISTS, "false")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def child_names(spark: SparkSession, path: str, pattern: str) -> list[str] | None:
    """Names directly under ``path`` that fit ``pattern`` and are not hidden to Spark's readers, in
    order; None where ``path`` is no folder. They come to Python as one text."""
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop
    folder = hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder) or fs.getFileStatus(folder).isFile():
        return None
    found = hadoop.fs.FileUtil.stat2Paths(fs.listStatus(folder, hadoop.fs.GlobFilter(pattern)))
    if not len(found):
        return []
    # "{file:/folder/one,file:/folder/two}": a name holds no slash, so that the folder tells names apart
    base = found[0].getParent().toString().rstrip("/") + "/"
    names = jvm.org.apache.commons.lang3.ArrayUtils.toString(found)[1:-1].removeprefix(base).split("," + base)
    return sorted(n for n in names if not n.startswith(".") and (not n.startswith("_") or "=" in n)
                  and not n.endswith("._COPYING_"))


def reliable_checkpoint(df, eager: bool = True):
    """``df.checkpoint()`` into the session's shared checkpoint dir (set for
    tests only when missing). Cuts lineage; files survive executor loss, and
    Spark removes them with the frame where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
