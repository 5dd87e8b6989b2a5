"""Session settings the jobs rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings to a session builder. ANSI mode stays at Spark's default (on)."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


# The folder of each local application without the setting, which no running session can change.
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local-mode session, where driver and executors share one disk, gets a
    temporary folder when the setting is missing.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    application = spark.sparkContext.applicationId
    if application not in _local:
        _local[application] = tempfile.mkdtemp(prefix="loglark-")
    return _local[application]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files below a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def side_by_side(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Run jobs that do not need each other at the same time; what they return, in their order.

    All have ended when this returns or raises the error of the first that failed.
    """
    inherit = inheritable_thread_target(spark)
    if inherit is spark:  # threads of Python and Java are not paired, so there is nothing to hand on
        inherit = lambda job: job
    with ThreadPoolExecutor(max(1, len(jobs))) as threads:
        running = [threads.submit(inherit(copy_context().run), job) for job in jobs]
    return [job.result() for job in running]


_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Deletes at the end of the block what ``staged`` writes inside; frames that read it end with it."""
    paths: list[str] = []
    outer = _staged.set(paths)
    try:
        yield
    finally:
        _staged.reset(outer)
        for path in paths:
            delete_folder(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Later passes see the same rows whatever happens to executors, and still
    prune columns, which a checkpointed RDD would not. The table's size is known, so
    a join broadcasts it only below ``spark.sql.autoBroadcastJoinThreshold``. Outside a
    ``staging`` block it stays until the job clears the shared folder.
    """
    path = new_folder(df.sparkSession, name)
    if (paths := _staged.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
