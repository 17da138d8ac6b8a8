"""Session settings, shared scratch space and file-system tests."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "labtables", **conf: str) -> SparkSession:
    """A session with the defaults above; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="labtables-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Where it is unset, a session on one
    machine (tests) gets a local temporary folder, and any other one an error, as its executors would
    each write to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_dir()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through Hadoop, so that it also holds for object stores and HDFS."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Existence test for a path or a pattern of paths."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jpath)
    return found is not None and len(found) > 0


def is_complete(spark: SparkSession, path: str) -> bool:
    """True once the write that made ``path`` was committed (its ``_SUCCESS`` marker is there)."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def read_small(spark: SparkSession, path: str) -> str | None:
    """Text of a small file, null if it is not there."""
    if not path_exists(spark, path):
        return None
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def swap_small(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: readers see the old text or the new one, never a part."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    fresh = hadoop.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    out = target.getFileSystem(conf).create(fresh)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    overwrite = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = getattr(hadoop.Options.Rename, "OVERWRITE")
    hadoop.FileContext.getFileContext(target.toUri(), conf).rename(fresh, target, overwrite)
