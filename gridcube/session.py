"""SparkSession construction and checkpoint-directory handling."""

from __future__ import annotations

import os
import threading
import uuid
import warnings

from pyspark.sql import SparkSession

# Settings every job relies on. ANSI stays on (Spark 4 default), so every
# division in the library goes through try_divide.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "gridcube",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Where that is
    unset (tests, a plain session) intermediate tables go to a folder beside
    the session's warehouse tables; on a cluster, whose executors need not see
    that folder, this is said once as a warning."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and not spark.sparkContext.master.startswith("local"):
        warnings.warn("spark.checkpoint.dir is not set: intermediate tables go to the warehouse folder, which all executors have to share", stacklevel=2)
    return d or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_intermediate")


class _Mine(threading.local):
    """Scratch folders handed out to this thread, oldest first: a job cleans up
    what its own thread made and nothing of another's."""

    def __init__(self):
        self.created: list[str] = []


_mine = _Mine()
_everyone: dict[str, list[str]] = {}     # folder -> the list it is in, for ``release``
_lock = threading.Lock()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables;
    ``cleanup`` deletes it once its job is over."""
    path = os.path.join(checkpoint_dir(spark), name)
    with _lock:
        _mine.created.append(path)
        _everyone[path] = _mine.created
    return path


def materialize(df, name: str = "table", codec: str | None = None, partition_by: list[str] | None = None):
    """Write an intermediate once as Parquet under the shared checkpoint
    folder and read it back: one job, lineage cut, survives executor loss,
    and every later consumer reads the files instead of recomputing.
    (``Dataset.checkpoint`` would compute an unpersisted input twice.)"""
    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex[:12]}")
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path, compression=codec)
    return spark.read.parquet(path)


def mark() -> int:
    """A point in this thread's list of scratch folders, for ``cleanup``."""
    return len(_mine.created)


def _plain(spark: SparkSession, path: str) -> str:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath().rstrip("/")


def _delete(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))


def cleanup(spark: SparkSession, since: int = 0, keep=()) -> int:
    """Delete the scratch folders (materialised tables, exports, stream tables)
    handed out to this thread since ``mark``, but for those that a DataFrame in
    ``keep`` reads. For jobs: mark, build, consume or write the result, clean up.
    Other threads' folders are left alone. Returns the number of folders deleted."""
    needed = [_plain(spark, f) for df in keep for f in df.inputFiles()]
    with _lock:
        some = _mine.created[since:]
        del _mine.created[since:]
    kept, gone = [], 0
    for path in some:
        if any(f.startswith(_plain(spark, path) + "/") for f in needed):
            kept.append(path)
        else:
            gone += _delete(spark, path)
    with _lock:
        _mine.created.extend(kept)
        for path in set(some) - set(kept):
            _everyone.pop(path, None)
    return gone


def release(df) -> int:
    """Delete the scratch folders that a finished result read from, whichever
    thread made them; call it once the result's action has run. Returns the number
    of folders deleted."""
    spark = df.sparkSession
    read = [_plain(spark, f) for f in df.inputFiles()]
    with _lock:
        found = [p for p in _everyone if any(f.startswith(_plain(spark, p) + "/") for f in read)]
        for path in found:
            _everyone.pop(path).remove(path)
    for path in found:
        _delete(spark, path)
    return len(found)
