"""Current rows kept up to date by a stream of changes, on plain files.

Every batch adds one folder with its last change per key, so a batch costs what it changes
and running it again after a failure replaces its own folder. ``compact`` folds the folders
into a base from time to time. A table format with MERGE can do the same in place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators.versions import latest


def changes_writer(
    path: str, keys: Sequence[str], order: Sequence[str]
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds one batch of changes."""

    def write(changes: DataFrame, batch: int) -> None:
        newest = latest(changes, keys, order)
        newest.write.mode("overwrite").parquet(f"{path}/changes/batch={batch}")

    return write


def current_rows(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The last row per key over the newest base and the batches after it."""
    changes = spark.read.parquet(f"{path}/changes")
    upto = _newest_base(spark, path)
    if upto is not None:
        base = spark.read.parquet(f"{path}/base/upto={upto}")
        changes = changes.where(F.col("batch") > upto).drop("batch").unionByName(base)
    else:
        changes = changes.drop("batch")
    return latest(changes, keys, order)


def compact(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Fold everything written so far into a new base; earlier folders are no longer read."""
    upto = spark.read.parquet(f"{path}/changes").agg(F.max("batch")).first()[0]
    if upto is not None and upto != _newest_base(spark, path):
        rows = current_rows(spark, path, keys, order)
        # What a crash left of this base was not committed, so it is replaced.
        rows.write.mode("overwrite").parquet(f"{path}/base/upto={upto}")


def _newest_base(spark: SparkSession, path: str) -> int | None:
    """The last base whose write was committed; a crash may leave parts of a later one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    marks = hadoop.Path(f"{path}/base/upto=*/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks)
    names = [mark.getPath().getParent().getName() for mark in found or []]
    return max((int(name.removeprefix("upto=")) for name in names), default=None)
