"""Tables and written intermediates the operators share."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import filterfalse
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.session import ensure_checkpoint_dir

#: Letters for sure, whatever the version of Unicode; for sets in patterns.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Parquet tables in the shared checkpoint folder, removed when the session ends.

    A written table is computed once, survives lost executors and is read column by column,
    where ``checkpoint()`` computes its last stage twice and keeps whole rows.
    """

    def __init__(self, spark: SparkSession, name: str):
        ensure_checkpoint_dir(spark)
        self.spark = spark
        self.folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid4().hex[:12]}"
        self._path(self.folder, lambda system, path: system.deleteOnExit(path))

    def _path(self, folder: str, act) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        act(path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the table read back."""
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.get(name, df)

    def get(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.folder}/{name}")

    def drop(self, name: str) -> None:
        """Remove a table no later plan reads."""
        self._path(f"{self.folder}/{name}", lambda system, path: system.delete(path, True))


def two_hashes(value: Column) -> list[Column]:
    """128 bits of a value in two independent longs (the seed of the second differs)."""
    return [F.xxhash64(value), F.xxhash64(F.lit(7), value)]


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound the rows of an Arrow batch: whole texts are long, and workers hold some batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


class Remembered(dict):
    """A dictionary in two generations: when the new one is full it becomes the old one.

    What is in use moves back to the new generation, so frequent keys stay and the whole is
    bounded by twice ``room`` entries and one batch.
    """

    def __init__(self, room: int) -> None:
        super().__init__()
        self.room = room
        self.old: dict = {}

    def missing(self, keys: Iterable, turn: bool = True) -> set:
        """The keys that are in neither generation; those in the old one are moved.

        Without ``turn`` no generation ends, so keys that were found before stay at hand.
        """
        if turn and len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        # Each key is looked up; set operations would go through all that is remembered.
        absent = set(filterfalse(self.__contains__, keys))
        again = list(filter(self.old.__contains__, absent))
        for key in again:
            self[key] = self.old[key]
        return absent.difference(again)
