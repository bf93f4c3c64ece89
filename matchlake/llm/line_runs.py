"""Line dedup over levelled sorted runs of line hashes.

A run is a table of (h1, h2, n): the 128-bit hash of a line key and the number of documents of
some batches that hold it, bucketed and sorted by the hash. Every batch of documents is counted,
merge-anti-joined against the keys that runs have settled already (those whose count reached
``min_docs``), and added as a run of level 0. Two runs of one level are merged into one run of the
next, so each count is rewritten a logarithmic number of times and a batch meets few runs. As all
runs have the same buckets, merges and anti-joins read them in order, bucket by bucket, and
shuffle none of them. The work is DataFrame operations only.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.shared import Scratch, two_hashes
from matchlake.operators.skew import ROWS_PER_TASK, HotKeys, spread_join

BATCHES = 4
#: Fixed: the white space that is stripped from both ends of a line.
WHITE = " \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    """The lines of a whole text; null and empty text are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE))


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased, other letters as they are."""
    trimmed = stripped(line)
    plain = F.octet_length(trimmed) == F.length(trimmed)
    by_letter = F.translate(trimmed, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(trimmed)).otherwise(by_letter)


def keyed_lines(docs: DataFrame, text: str, min_chars: int, *kept: Column) -> DataFrame:
    """A row per line whose key has ``min_chars`` code points: ``kept``, pos, h1, h2."""
    # What is kept is worked out per document, before its lines are unfolded.
    whole = docs.select(*kept, F.col(f"`{text}`").alias("_text"))
    names = whole.columns[:-1]
    lines = whole.select(*names, F.posexplode(lines_of(F.col("_text"))).alias("pos", "line"))
    # A key is as long as the stripped line.
    long_enough = lines.where(F.length(stripped(F.col("line"))) >= min_chars)
    first, second = two_hashes(F.col("key"))
    return long_enough.select(*names, "pos", line_key(F.col("line")).alias("key")).select(
        *names, "pos", first.alias("h1"), second.alias("h2")
    )


class LineRuns:
    """Runs of line hashes; ``levels[i]`` names the runs of level i, oldest first.

    Keep one per corpus and ``add`` batches as they arrive, then ask for ``repeated`` keys. All
    runs have ``buckets`` buckets, the session's number of shuffle partitions unless told; more
    than one task should hold of the keys does not belong into a bucket.
    """

    def __init__(
        self,
        spark: SparkSession,
        min_docs: int = 10,
        min_chars: int = 1,
        buckets: int | None = None,
    ):
        self.spark, self.scratch = spark, Scratch(spark, "line-runs")
        self.min_docs, self.min_chars = min_docs, min_chars
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.made = 0
        # Tables live in the session's catalog by name, and their files in the shared folder.
        self.prefix = self.scratch.folder.rsplit("/", 1)[-1].replace("-", "_")

    def _names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _write(self, rows: DataFrame) -> str:
        """A bucketed, sorted table of ``rows``, which come bucket by bucket."""
        self.made += 1
        name = f"{self.prefix}_{self.made}"
        writer = rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
        writer.option("path", f"{self.scratch.folder}/{name}").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        self.scratch.drop(name)

    def _put(self, counts: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._write(counts.select(*KEY, "n")))

    def _merged(self, names: Sequence[str]) -> DataFrame:
        """Two runs as one, by a merge join of their buckets."""
        one, other = (self.spark.table(name) for name in names)
        n = F.coalesce(one["n"], F.lit(0)) + F.coalesce(other["n"], F.lit(0))
        return one.hint("merge").join(other, KEY, "full").select(*KEY, n.alias("n"))

    def _merge(self, names: Sequence[str], level: int) -> None:
        self._put(self._merged(names), level)
        for name in names:
            self._drop(name)

    def add(self, docs: DataFrame, text: str = "text") -> None:
        """Count the lines of a batch that no run has settled, and add them as a run.

        A document is known by a number within the batch, so repeated rows count each.
        """
        number = F.monotonically_increasing_id().alias("_number")
        counts = (
            keyed_lines(docs, text, self.min_chars, number)
            .groupBy("_number", *KEY)
            .agg(F.lit(1).alias("_held"))
            .groupBy(*KEY)
            .agg(F.count(F.lit(1)).alias("n"))
            .repartition(self.buckets, *KEY)
        )
        for name in self._names():
            settled = self.spark.table(name).where(F.col("n") >= self.min_docs)
            counts = counts.join(settled.select(*KEY).hint("merge"), KEY, "left_anti")
        self._put(counts, 0)
        level = 0
        while len(self.levels[level]) == 2:
            names, self.levels[level] = self.levels[level], []
            self._merge(names, level + 1)
            level += 1

    def repeated(self) -> DataFrame:
        """Keys found in ``min_docs`` or more documents of all batches, and in how many (n).

        A settled key is not counted any further, so n is at least ``min_docs`` and no more than
        the documents that hold the key.
        """
        while len(names := self._names()) > 1:
            # The youngest runs are the smallest.
            self.levels = [[n for n in level if n not in names[:2]] for level in self.levels]
            self._merge(names[:2], len(self.levels))
        if not names:
            return self.spark.createDataFrame([], "h1 long, h2 long, n long")
        many = self.spark.table(names[0]).where(F.col("n") >= self.min_docs)
        return self.scratch.put(many, "repeated")

    def close(self) -> None:
        """Forget all runs, so that none stays in the catalog; ``repeated`` keys stay written."""
        for name in self._names():
            self._drop(name)
        self.levels = []


def id_batches(docs: DataFrame, id_col: str, batches: int) -> list[DataFrame]:
    """The documents cut into ranges of ids, so that a scan can skip the files of others."""
    low, high = docs.agg(F.min(id_col), F.max(id_col)).first()
    if low is None:
        return [docs]
    cuts = [low + (high - low + 1) * i // batches for i in range(1, batches)]
    key = F.col(id_col)
    ends = [(None, cuts[0]), *zip(cuts, cuts[1:]), (cuts[-1], None)] if cuts else [(None, None)]
    parts = []
    for start, end in ends:
        if start is None:
            inside = F.lit(True) if end is None else key.isNull() | (key < end)
        else:
            inside = key >= start if end is None else (key >= start) & (key < end)
        parts.append(docs.where(inside))
    return parts


def without(lines: Column, gone: Column) -> Column:
    """Lines whose positions are not in the sorted array ``gone``: the stretches between these."""
    count = F.size(gone)

    def stretch(k: Column) -> Column:
        start = F.when(k == 0, 0).otherwise(F.get(gone, k - 1) + 1)
        stop = F.when(k == count, F.size(lines)).otherwise(F.get(gone, k))
        return F.slice(lines, start + 1, stop - start)

    return F.flatten(F.transform(F.sequence(F.lit(0), count), stretch))


def drop_repeated_lines(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = BATCHES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Documents without the lines whose key ``min_docs`` or more documents hold.

    Returns (row, kept, n_lines, n_dropped): ``row`` is the whole input row as a struct, so no
    column name can clash, and ``kept`` the other lines, joined by line feeds. Every input row
    counts as a document, also repeated rows and rows without id. Null and empty text have one
    empty line, which has no key and stays; a document all of whose lines go keeps empty text.
    The work of a document grows with its lines, not with their square. The lines of a key that
    very many documents hold are dealt over several tasks.
    """
    spark = docs.sparkSession
    runs = LineRuns(spark, min_docs, min_chars)
    for batch in id_batches(docs, id_col, batches):
        runs.add(batch, text)
    repeated = runs.repeated()
    runs.close()
    # A row is known by its id and text; rows that are equal in both lose equal lines.
    r1, r2 = two_hashes(F.struct(F.col(f"`{id_col}`"), F.col(f"`{text}`")))
    row = [r1.alias("r1"), r2.alias("r2")]
    often = repeated.where(F.col("n") > rows_per_task).select(F.xxhash64(*KEY).alias("h"), "n")
    hot = HotKeys(tuple(KEY), {r["h"]: r["n"] for r in often.collect()}, rows_per_task)
    drops = (
        spread_join(keyed_lines(docs, text, min_chars, *row), repeated.select(*KEY), KEY, ["r1"], hot)
        .groupBy("r1", "r2")
        .agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    )
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    base = docs.select(whole.alias("row"), F.col(f"`{text}`").alias("text"), *row)
    body = F.coalesce(F.col("text"), F.lit(""))
    left = F.array_join(without(F.col("lines"), F.col("gone")), "\n")
    return (
        base.join(drops, ["r1", "r2"], "left")
        .withColumn("lines", lines_of(F.col("text")))
        .select(
            "row",
            F.when(F.col("gone").isNull(), body).otherwise(left).alias("kept"),
            F.size("lines").cast("long").alias("n_lines"),
            F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        )
    )
