"""Removal of byte strings that stand more than once, by external induced suffix sorting.

Every string of ``length`` bytes has an anchor: the stretch of ``GRAM`` bytes in it with the
smallest hash. Equal strings have equal anchors at equal offsets, so neighbouring strings of one
anchor form a context, and only contexts of one anchor hash can hold equal strings. Contexts that
are equal as a whole are counted, each distinct one of an anchor with several is sorted: a task
lays the contexts of whole anchors end to end and sorts all suffixes by external induction;
suffixes that share ``length`` bytes with a neighbour stand more than once.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm import induced_sort
from matchlake.llm.shared import Scratch, two_hashes
from matchlake.operators.skew import ROWS_PER_TASK, HotKeys, spread_join

LENGTH = 200
GRAM = 64
#: Text of a task, and of the anchors it sorts at a time, both aimed at.
SHARD_BYTES = 64 << 20
SORTED_BYTES = 6 << 20
#: Distinct contexts of one anchor that are sorted together, at most.
GROUP = 20_000
#: Arrays of a task above so many bytes are kept in files.
ROOM = 64 << 20
SEGMENT = 1 << 19
PLACE_BITS = 20
#: Fixed values of the rolling hash: an odd base and two mixing factors.
BASE = 0x9E3779B97F4A7C15
MIX = 0xFF51AFD7ED558CCD
#: Symbols before those of bytes: the end of the text and the end of a context.
MARKS = 2


class Anchors:
    """Contexts of a text by the anchors of its windows, which are strings of ``length`` bytes."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        size = SEGMENT + length
        powers = np.full(size, BASE, np.uint64)
        powers[0] = 1
        inverse = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        self.powers = np.multiply.accumulate(powers)
        self.inverse = np.multiply.accumulate(inverse)

    def _hashes(self, part: np.ndarray) -> np.ndarray:
        """A hash of every stretch of ``gram`` bytes, which depends on these bytes alone."""
        terms = (part.astype(np.uint64) + np.uint64(1)) * self.powers[: len(part)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
        count = len(part) - self.gram + 1
        out = (sums[self.gram :] - sums[:count]) * self.inverse[:count]
        out ^= out >> np.uint64(33)
        out *= np.uint64(MIX)
        return out ^ (out >> np.uint64(29))

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor hash, context hash, first window, windows and anchor's offset per context.

        The anchor of a window is the leftmost stretch of those with the smallest leading bits of
        their hash. A context is a run of windows with one anchor; its hash tells the bytes from
        its first window's beginning to its last window's end, and where the anchor stands.
        """
        raw = np.frombuffer(data, np.uint8)
        windows = max(0, len(raw) - self.length + 1)
        width = self.length - self.gram + 1
        low = np.uint64((1 << PLACE_BITS) - 1)
        places, hashes = [], []
        for start in range(0, windows, SEGMENT):
            count = min(SEGMENT, windows - start)
            full = self._hashes(raw[start : start + count + self.length - 1])
            least = full & ~low | np.arange(len(full), dtype=np.uint64)
            span = 1
            while span * 2 <= width:
                least = np.minimum(least[:-span], least[span:])
                span *= 2
            if span < width:
                least = np.minimum(least[: count], least[width - span :])
            at = (least & low).astype(np.int64)
            places.append(at + start)
            hashes.append(full[at])
        if not places:
            return (np.zeros(0, np.int64),) * 5
        place, full = np.concatenate(places), np.concatenate(hashes)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        count = np.diff(np.append(first, windows))
        offset = place[first] - first
        context = np.fromiter(
            (
                xxhash.xxh3_64_intdigest(data[f : f + n + self.length - 1], o)
                for f, n, o in zip(first.tolist(), count.tolist(), offset.tolist())
            ),
            np.uint64,
            len(first),
        )
        return full[first].view(np.int64), context.view(np.int64), first, count, offset


FOUND = (
    "r1 long, r2 long, anchors array<struct<a:long,c:long,first:int,windows:int,offset:int>>"
)


def _anchored(length: int, gram: int):
    kind = pa.struct(
        [("a", pa.int64()), ("c", pa.int64()), ("first", pa.int32()), ("windows", pa.int32()), ("offset", pa.int32())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length, gram)
        for batch in batches:
            found = [anchors.of(data) for data in batch.column("data").to_pylist()]
            sizes = np.concatenate(([0], np.cumsum([len(f[0]) for f in found]))).astype(np.int32)
            columns = [np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*found)] or [np.zeros(0)] * 5
            fields = [pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(columns, kind)]
            lists = pa.ListArray.from_arrays(pa.array(sizes), pa.StructArray.from_arrays(fields, fields=list(kind)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("r1"), batch.column("r2"), lists], ["r1", "r2", "anchors"]
            )

    return work


# --- sorting -----------------------------------------------------------------


def _scratch_folder() -> str:
    """A folder of this task's own, where Spark itself spills on this executor."""
    place = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return tempfile.mkdtemp(prefix="suffixes-", dir=place if os.path.isdir(place) else None)


def repeated(text: np.ndarray, length: int, files: induced_sort.Files) -> np.ndarray:
    """Where the next ``length`` symbols of ``text`` stand elsewhere in it too."""
    out = files.array(len(text), bool)
    last = 0
    for places, common in induced_sort.falling(text, MARKS + 256, length, files):
        same = common >= length
        out[places[same]] = True
        out[np.append(last, places[:-1])[same]] = True
        last = places[-1]
    return out


MARKED = "a long, c long, spans array<struct<first:int,windows:int>>"


def _sorted(length: int, room: int, at_once: int):
    """Contexts (g, a, c, off, data), ordered by g, to the runs of their windows that repeat."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = _scratch_folder()
        files = induced_sort.Files(folder, room)
        try:
            for shelf in _shelves(batches, folder, at_once):
                yield from shelf.marks(length, files)
        finally:
            shutil.rmtree(folder, ignore_errors=True)

    return work


class Shelf:
    """The contexts of some whole groups, laid end to end in a file."""

    def __init__(self, folder: str):
        self.file = tempfile.TemporaryFile(dir=folder)
        self.keys: list[tuple[int, int, int]] = []
        self.sizes: list[int] = []
        self.bytes = 0
        self.seen: set[tuple[int, int, int]] = set()

    def add(self, key: tuple[int, int, int], data: bytes) -> None:
        # A row that is there twice is one place.
        if key in self.seen:
            return
        self.seen.add(key)
        self.keys.append(key)
        self.sizes.append(len(data))
        self.bytes += len(data) + 1
        raw = np.frombuffer(data, np.uint8).astype(np.uint16) + np.uint16(MARKS)
        self.file.write(np.append(raw, np.uint16(MARKS - 1)).tobytes())

    def marks(self, length: int, files: induced_sort.Files) -> Iterator[pa.RecordBatch]:
        self.seen.clear()
        self.file.write(np.uint16(0).tobytes())
        self.file.flush()
        text = np.memmap(self.file, np.uint16, "r")
        if text.nbytes <= files.room:
            text = np.array(text)
        flags = repeated(text, length, files)
        sizes = np.array(self.sizes)
        starts = np.cumsum(sizes + 1) - sizes - 1
        out = []
        for key, start, size in zip(self.keys, starts.tolist(), self.sizes):
            runs = spans(flags[start : start + size - length + 1])
            if runs:
                out.append((key[0], key[1], [{"first": key[2] + f, "windows": n} for f, n in runs]))
        self.file.close()
        kind = pa.list_(pa.struct([("first", pa.int32()), ("windows", pa.int32())]))
        for start in range(0, len(out), 4096):
            a, c, found = zip(*out[start : start + 4096])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(c, pa.int64()), pa.array(found, kind)],
                ["a", "c", "spans"],
            )


def _shelves(batches, folder: str, at_once: int) -> Iterator[Shelf]:
    """Whole groups by the shelf: one is full once a group ends beyond ``at_once`` bytes."""
    shelf, last = Shelf(folder), None
    for batch in batches:
        g, a, c, off, data = (batch.column(n).to_pylist() for n in ("g", "a", "c", "off", "data"))
        for n in range(len(g)):
            if g[n] != last and shelf.bytes >= at_once:
                yield shelf
                shelf = Shelf(folder)
            last = g[n]
            shelf.add((a[n], c[n], off[n]), data[n])
    if shelf.keys:
        yield shelf


def spans(flags: np.ndarray) -> list[tuple[int, int]]:
    """Beginning and length of every run of true."""
    if not flags.any():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [(int(f), int(e - f)) for f, e in zip(edges[::2], edges[1::2])]


# --- large groups ------------------------------------------------------------

PIECE = "g long, e long, a long, c long, off int, offset int, least int, most int, data binary"


def _halved(length: int):
    """Pieces cut by where their windows hold the anchor, each half with a longer core.

    A piece holds windows with the anchor from ``least`` to ``most`` bytes in. All of these share
    a core around the anchor, whose hash names the group of the half; equal windows have equal
    cores. A piece with one such place has the whole window as its core.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p in batch.to_pylist():
                data, offset = p["data"], p["offset"]
                middle = (p["least"] + p["most"]) // 2
                for least, most in ((p["least"], middle), (middle + 1, p["most"])):
                    first = max(0, offset - most)
                    last = min(len(data) - length, offset - least)
                    if first > last:
                        continue
                    core = data[offset - least : offset - most + length]
                    half = data[first : last + length]
                    seed = least << 16 | most
                    rows.append(
                        {
                            "g": _signed(xxhash.xxh3_64_intdigest(core, seed)),
                            "e": _signed(xxhash.xxh3_64_intdigest(half, seed << 16 | offset - first)),
                            "a": p["a"],
                            "c": p["c"],
                            "off": p["off"] + first,
                            "offset": offset - first,
                            "least": least,
                            "most": most,
                            "data": half,
                        }
                    )
            yield pa.RecordBatch.from_pylist(rows, batch.schema)

    return work


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _hot(counts: DataFrame, keys: list[str], size: str, rows_per_task: int) -> HotKeys:
    """Hot keys of a counted table: fewer than its rows / ``rows_per_task``."""
    many = counts.where(F.col(size) > rows_per_task).select(F.xxhash64(*keys).alias("h"), size)
    return HotKeys(tuple(keys), {r["h"]: r[size] for r in many.collect()}, rows_per_task)


def _split_large(
    pieces: DataFrame, length: int, group: int, rows_per_task: int, scratch: Scratch
) -> tuple[DataFrame, list[DataFrame]]:
    """Pieces of groups of at most ``group``, and marks found by counting on the way.

    Larger groups are halved again and again. Halves that are equal are counted, all of them
    repeat, and one of them stays to be compared with others; halves that hold one window place
    have nothing else to be compared with, so this ends.
    """
    small, marks, level = [], [], 0
    while True:
        sizes = pieces.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
        large = scratch.put(sizes.where(F.col("n") > group), f"large-{level}")
        if not large.head(1):
            break
        small.append(pieces.join(large, "g", "left_anti"))
        level += 1
        columns = [f.split()[0] for f in PIECE.split(", ")]
        cut = pieces.join(large, "g", "left_semi").select(*columns)
        halves = scratch.put(cut.mapInArrow(_halved(length), PIECE), f"halves-{level}")
        who = F.struct("a", "c", "off")
        counted = scratch.put(
            halves.groupBy("g", "e").agg(F.count(F.lit(1)).alias("n"), F.min(who).alias("who")),
            f"counted-{level}",
        )
        hot = _hot(counted, ["g", "e"], "n", rows_per_task)
        known = spread_join(halves, counted, ["g", "e"], ["a", "c", "off"], hot)
        windows = (F.octet_length("data") - length + 1).cast("int")
        marks.append(
            known.where("n > 1").select(
                "a", "c", F.array(F.struct(F.col("off").alias("first"), windows.alias("windows"))).alias("spans")
            )
        )
        pieces = scratch.put(
            known.where((F.col("who") == who) & (F.col("least") < F.col("most"))).select(*columns),
            f"pieces-{level}",
        )
    for part in small:
        pieces = pieces.unionByName(part)
    return pieces, marks


# --- documents ---------------------------------------------------------------


def repeated_spans(
    rows: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    group: int = GROUP,
    shard_bytes: int = SHARD_BYTES,
    at_once: int = SORTED_BYTES,
    room: int = ROOM,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """(r1, r2, spans) of the rows (r1, r2, data) that hold a repeated string of ``length`` bytes.

    ``spans`` lists windows that repeat as (first, windows) in any order. Rows of equal r1, r2 are
    equal rows.
    """
    scratch = Scratch(rows.sparkSession, "suffix-dedup")
    long_rows = rows.where(F.octet_length("data") >= length).select("r1", "r2", "data")
    anchored = scratch.put(long_rows.mapInArrow(_anchored(length, gram), FOUND), "anchors")
    flat = anchored.select("r1", "r2", F.explode("anchors").alias("x")).select("r1", "r2", "x.*")
    contexts = scratch.put(
        flat.groupBy("a", "c").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("r1", "r2", "first", "windows", "offset")).alias("at"),
        ),
        "contexts",
    )
    groups = scratch.put(
        contexts.groupBy("a").agg(F.count(F.lit(1)).alias("distinct")).where("distinct > 1"), "groups"
    )
    hot = _hot(groups, ["a"], "distinct", rows_per_task)
    compared = spread_join(contexts, groups, ["a"], ["c"], hot).select("a", "c", "at.*")
    wanted = compared.groupBy("r1", "r2").agg(
        F.collect_list(F.struct("a", "c", "first", "windows", "offset")).alias("wanted")
    )
    # The bytes are cut out before the list is unfolded, so no text is repeated.
    cut = F.transform(
        "wanted",
        lambda w: F.struct(
            w["a"].alias("a"),
            w["c"].alias("c"),
            w["offset"].alias("offset"),
            F.substring(F.col("data"), w["first"] + 1, w["windows"] + F.lit(length - 1)).alias("data"),
        ),
    )
    place = F.lit(length - gram)
    pieces = scratch.put(
        long_rows.join(wanted, ["r1", "r2"])
        .select(F.explode(cut).alias("p"))
        .select(
            F.col("p.a").alias("g"),
            F.lit(0).cast("long").alias("e"),
            "p.a",
            "p.c",
            F.lit(0).alias("off"),
            "p.offset",
            F.lit(0).alias("least"),
            place.alias("most"),
            "p.data",
        ),
        "pieces",
    )
    pieces, marks = _split_large(pieces, length, group, rows_per_task, scratch)
    total = pieces.agg(F.sum(F.octet_length("data") + 1)).first()[0] or 0
    # Small inputs are spread as well.
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-total // shard_bytes), min(spread, -(-total // at_once)))
    dealt = pieces.select("g", "a", "c", "off", "data").repartition(shards, "g")
    ordered = dealt.sortWithinPartitions("g")
    marks.append(ordered.mapInArrow(_sorted(length, room, at_once), MARKED))
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("at.windows").alias("windows")))
    marks.append(contexts.where("copies > 1").select("a", "c", whole.alias("spans")))
    every = marks[0]
    for more in marks[1:]:
        every = every.unionByName(more)
    marked = scratch.put(
        every.groupBy("a", "c").agg(F.flatten(F.collect_list("spans")).alias("spans")), "marked"
    )
    often = _hot(contexts, ["a", "c"], "copies", rows_per_task)
    here = flat.select("r1", "r2", "a", "c", F.col("first").alias("at"))
    hits = spread_join(here, marked, ["a", "c"], ["r1", "r2"], often).select(
        "r1",
        "r2",
        F.explode("spans").alias("s"),
        "at",
    )
    span = F.struct((F.col("at") + F.col("s.first")).alias("first"), F.col("s.windows").alias("windows"))
    return hits.groupBy("r1", "r2").agg(F.collect_set(span).alias("spans"))


def drop_repeated_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **limits
) -> DataFrame:
    """Each row without the bytes covered by a string of ``length`` bytes that stands elsewhere too.

    Elsewhere is any other place in any row, also in the row itself; overlapping places count, and
    all is judged on the input. Returns the input as the struct ``row``, ``kept`` (binary), n_bytes,
    n_removed and n_spans. A null text is an empty one; texts shorter than ``length`` bytes stay
    whole. Rows that repeat an id or a text, and rows without an id, are rows of their own; an
    empty table gives an empty result.
    """
    data = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    # A row is known by its id and text, so that copies of a text do not share a key.
    r1, r2 = two_hashes(F.struct(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), data.alias("data"), r1.alias("r1"), r2.alias("r2"))
    found = repeated_spans(rows.select("r1", "r2", "data"), length, **limits)

    @F.arrow_udf("struct<kept:binary,n_removed:long,n_spans:long>")
    def without(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for text, marks in zip(texts.to_pylist(), lists.to_pylist()):
            kept, removed, runs = remove(text, marks, length)
            out.append({"kept": kept, "n_removed": removed, "n_spans": runs})
        kind = pa.struct([("kept", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])
        return pa.array(out, kind)

    cleaned = rows.join(found, ["r1", "r2"], "left").withColumn("out", without("data", "spans"))
    return cleaned.select("row", "out.*", F.octet_length("data").cast("long").alias("n_bytes"))


def remove(text: bytes, marks: list[dict] | None, length: int) -> tuple[bytes, int, int]:
    """``text`` without the bytes that windows cover, how many these are, and in how many runs."""
    kept, end, removed, runs = [], 0, 0, 0
    for mark in sorted(marks or [], key=lambda m: m["first"]):
        first, stop = mark["first"], mark["first"] + mark["windows"] + length - 1
        if first > end or not runs:
            kept.append(text[end:first])
            runs += 1
            removed -= first
            end = stop
            removed += stop
        elif stop > end:
            removed += stop - end
            end = stop
    kept.append(text[end:])
    return b"".join(kept), removed, runs
