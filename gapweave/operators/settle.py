"""Cut the lineage of a table that several later steps read."""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, a part of the warehouse.

    Both are folders that every executor reaches.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir") + "/settled").rstrip("/")


def _remove_at_exit(path: str) -> None:
    # Only where the folder is a plain local one, as in tests; a cluster's folder has its own retention.
    where = urlparse(path)
    if where.scheme in ("", "file"):
        atexit.register(shutil.rmtree, where.path, ignore_errors=True)


#: The folders settled by the step that ``settle_last`` runs.
_OF_STEP: ContextVar[list[str] | None] = ContextVar("of_step", default=None)

#: Shuffle files go with the job that wrote them, not when the driver's memory is next collected.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """The session's setting for as long as a job takes."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def settle(df: DataFrame) -> DataFrame:
    """Write the table to the shared folder and read it back.

    The rows are then safe from lost executors and are not computed again.  Texts and packed arrays take
    the most room there, so they are packed tighter than Spark's default does.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    _remove_at_exit(path)
    if _OF_STEP.get() is not None:
        _OF_STEP.get().append(path)
    with setting(spark, SHUFFLE_CLEANUP, "true"):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_last(step: Callable[[], DataFrame]) -> DataFrame:
    """Settle what ``step`` returns; the tables that it settled on the way are then removed.

    Nothing but the returned table may read those, so they should not leave the step.
    """
    on_the_way: list[str] = []
    outer = _OF_STEP.set(on_the_way)
    try:
        result = step()
    finally:
        _OF_STEP.reset(outer)
    out = settle(result)
    context = out.sparkSession.sparkContext
    for folder in on_the_way:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return out
