"""Session helpers.

``local_session`` builds the session used by tests and ``bench.py``; on a
cluster the caller owns the session and only ``shared_dir`` is used.
"""
from __future__ import annotations

import contextlib
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rankwise") -> SparkSession:
    """A local session tuned like a small cluster: AQE on, UTC, no UI."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_HELD: dict[tuple[int, str], list] = {}      # blocks inside, the value before them
_HELD_LOCK = threading.Lock()


@contextlib.contextmanager
def held_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session's ``key`` is ``value`` while the block runs.

    Threads share a session: of blocks that overlap, the last to end puts back what
    was there before the first.
    """
    name = (id(spark), key)
    with _HELD_LOCK:
        held = _HELD.setdefault(name, [0, spark.conf.get(key, None)])
        held[0] += 1
        spark.conf.set(key, value)
    try:
        yield
    finally:
        with _HELD_LOCK:
            held[0] -= 1
            if not held[0]:
                del _HELD[name]
                if held[1] is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, held[1])


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for written intermediate tables.

    Taken from ``spark.checkpoint.dir``, or from a checkpoint folder that the
    caller has set on the context. Where neither exists a session on one machine
    (a ``local`` master, as in tests) gets a temporary folder; on any other master
    that is an error, as executors would each write to their own disk.
    """
    sc = spark.sparkContext
    known = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if sc.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="rankwise-shared-")
    return _LOCAL_DIRS[sc.applicationId]


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/rankwise/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused path for one write, below this application's folder."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written table, through the file system that Spark wrote it to."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that this application wrote to scratch paths.

    To be called once no DataFrame reads them any more: results of operators
    that write intermediate tables are lazy and may still point there.
    """
    remove_path(spark, _scratch_root(spark))
