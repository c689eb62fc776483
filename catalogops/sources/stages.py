"""Staged tables in the cluster's shared folder.

A staged table cuts lineage in a way that survives lost executors, and because
it is a file the planner knows its true size: a later join broadcasts it only
when that size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import atexit
import hashlib
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a ``local`` master, where driver and executors are one process, may
    fall back to a temporary folder, which goes when the process ends.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by the cluster")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="catalogops-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/catalogops/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: one evaluation, known size, no lineage."""
    return stage_at(df, name)[0]


def stage_at(df: DataFrame, name: str, **options: object) -> tuple[DataFrame, str]:
    """As ``stage``, with the path, for callers that discard the table when it is no longer read, and options of the writer."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table; nothing may read it any more."""
    if "/catalogops/" not in path:
        raise ValueError(f"not a staged table: {path}")
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a previous run committed its output at ``path``."""
    fs, target = _file_system(spark, f"{path.rstrip('/')}/_SUCCESS")
    return bool(fs.exists(target))


def fingerprint(*parts: object) -> str:
    """Short name of what a step depends on; equal parts give equal names in every run."""
    return hashlib.sha1(repr(parts).encode()).hexdigest()[:12]


def materialize(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], reset: bool = False
) -> DataFrame:
    """Resumable step: reuse committed output, otherwise build and commit it.

    The path stands for what the step depends on: a caller whose input, pack or
    options may change puts their :func:`fingerprint` into it.
    """
    if reset or not is_complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
