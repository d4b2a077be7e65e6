"""Spark session construction and shared scratch locations.

Jobs never write to a machine-local temporary folder on a cluster: every
intermediate table lives under the shared folder named by
``spark.checkpoint.dir``. Only when that setting is missing (local runs and
tests) do we pick a folder of our own and register it with the session.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lakeloom") -> SparkSession:
    """Session with the settings every job here relies on.

    * AQE on: runtime coalescing of small shuffle partitions, skew-join
      splitting and runtime broadcast conversion (the broadcast threshold is the
      size check; nothing is force-broadcast unless its size is bounded).
    * Session time zone pinned to UTC (test timestamps are ``timestamp_ntz``).
    * UI off: no server is started.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Checkpoints used to freeze range cuts are removed once unreferenced.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for a while; what was set before comes back."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of its file system (never by catching a failed read)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it is not there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job of this library has written."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def replace_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder that a job of this library has written to ``target``, in place of what is there."""
    src, dst = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = dst.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(dst, True)
    if not fs.rename(src, dst):
        raise OSError(f"cannot move {source} to {target}")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only if
    neither is set -- as in local tests -- a fresh folder is created and
    registered, so later ``DataFrame.checkpoint()`` calls land there too.
    """
    configured = spark.conf.get(_CHECKPOINT_CONF, None)
    sc = spark.sparkContext
    if not configured:
        configured = sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"set {_CHECKPOINT_CONF} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lakeloom-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    # Not created here: Spark writers create it, and ``errorifexists`` sinks
    # need it absent.
    return f"{root}/lakeloom/{name}-{uuid.uuid4().hex[:12]}"


def freeze(df):
    """Materialise ``df`` to the shared checkpoint folder and cut its lineage.

    Used where two passes over the same data must agree on something computed
    at run time (e.g. range-partition boundaries, which are sampled anew by
    every plan that contains the shuffle). Reliable checkpoint, so a lost
    executor does not lose the frozen data.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
