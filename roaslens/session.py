"""Session helpers: local sessions for tests/bench, checkpoint location, materialisation."""

from __future__ import annotations

import os
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Sequence, TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Settings the engine relies on.  AQE re-plans joins at run time: a join side
# whose measured shuffle output is below the broadcast threshold is broadcast,
# larger sides stay sort-merge joins, and skewed partitions are split.
ENGINE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "roaslens") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ROASLENS_DRIVER_MEMORY", "8g"))
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    log_dir = os.environ.get("ROASLENS_EVENT_LOG_DIR")
    if log_dir:  # stage / shuffle statistics for the bench, written to a scratch folder
        builder = (builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{log_dir}")
                   .config("spark.eventLog.compress", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, a folder that driver and executors share.

    Only a single-process session (``local[...]``, tests and bench), whose driver is its only
    executor, may go without the setting; it then gets a folder of its own.  Any other session
    must name one: executors would not see each other's local files."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^-\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints-{uuid.uuid4().hex}"
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_CUTS: dict[str, list[str]] = {}


def in_parallel(jobs: Sequence[Callable[[], T]], threads: int = 4) -> list[T]:
    """Results of ``jobs``, each of which starts Spark jobs of its own: small ones overlap in planning and scheduling.
    Local properties (job group, pool) are those of the caller."""
    with ThreadPoolExecutor(threads) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(job)) for job in jobs]]


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared checkpoint folder, which ``release_cuts`` deletes with the rest of the session's."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    _CUTS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write an intermediate as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts lineage and plan size like ``checkpoint()``, in one job, and the
    re-read carries file-size statistics the planner uses for broadcast
    decisions.  ``drop_cut`` deletes one early, ``release_cuts`` all of the session."""
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_cut(*frames: DataFrame) -> None:
    """Delete the files of frames returned by ``cut`` that nothing will read again."""
    for df in frames:
        path = df._cut_path
        _CUTS[df.sparkSession.sparkContext.applicationId].remove(path)
        _delete(df.sparkSession, path)


def release_cuts(spark: SparkSession) -> int:
    """Delete all intermediates this session has written; call it once its results are written."""
    paths = _CUTS.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)
