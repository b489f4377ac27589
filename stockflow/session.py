"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are designed for. AQE sizes the reduce side, splits skewed
# joins and turns a join into a broadcast only after it has seen the real size.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # recording the Python call site of every column expression doubles the planning time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str, master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with the recommended settings, `settings` on top of them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by `spark.checkpoint.dir`.

    Only a session whose executors are threads of this process may do with a folder of this
    machine; it is made once per application.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder(context.applicationId)


@lru_cache(1)
def _own_folder(application: str) -> str:
    """A folder of this machine for one application, removed when the process ends."""
    folder = tempfile.mkdtemp(prefix="stockflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder, read back.

    The rows are fixed from here on and survive the loss of executors. Unlike a
    checkpoint, the plan above is computed once and later steps read only the columns
    they need.
    """
    path = scratch_path(df.sparkSession, name)
    for paths in _OPEN[-1:]:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_OPEN: list[list[str]] = []


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what `written` leaves behind within the block."""
    paths: list[str] = []
    _OPEN.append(paths)
    try:
        yield
    finally:
        _OPEN.remove(paths)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table, wherever the shared folder lies."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
