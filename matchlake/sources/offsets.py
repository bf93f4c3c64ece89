"""Change topics as segments with offsets, read by range, with committed positions of a group.

A topic's partition is a folder of Parquet segments ``<path>/<topic>/<partition>/<first offset>``
with the columns offset, arrival_ts and value, offsets rising. The footers tell which offsets a
segment holds, so planning reads no records, and a task reads the segments of its range alone. A
reader belongs to a group, whose committed offsets lie in ``<path>/_groups/<group>.json``.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

FORMAT = "topic_segments"
SCHEMA = "topic string, `offset` bigint, arrival_ts timestamp, value string"
GROUP = "facts"
#: Records that one trigger takes, at most, over all partitions.
OFFSETS_PER_TRIGGER = 5_000_000

Offsets = dict[str, int]


@dataclass
class Range(InputPartition):
    """Offsets from ``start`` up to ``end`` of one segment."""

    topic: str
    file: str
    start: int
    end: int


class Log:
    """The segments under a path, which any file system that Arrow knows may hold."""

    def __init__(self, path: str, topics: Sequence[str]):
        self.system, self.root = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        self.topics = list(topics)

    def _names(self, folder: str) -> list[str]:
        found = self.system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return sorted(f.base_name for f in found if f.base_name[0] not in "._")

    def partitions(self) -> list[str]:
        """Names of the partitions, as topic/number."""
        return [f"{t}/{n}" for t in self.topics for n in self._names(f"{self.root}/{t}")]

    def segments(self, partition: str) -> list[tuple[int, str]]:
        """First offset and path of every segment of a partition, in order."""
        folder = f"{self.root}/{partition}"
        return sorted((int(n.split(".")[0]), f"{folder}/{n}") for n in self._names(folder))

    def last(self, file: str) -> int:
        """The last offset of a segment, from its footer."""
        with self.system.open_input_file(file) as source:
            footer = pq.ParquetFile(source).metadata
            at = footer.schema.to_arrow_schema().get_field_index("offset")
            groups = [footer.row_group(i).column(at).statistics.max for i in range(footer.num_row_groups)]
        return max(groups, default=-1)

    def earliest(self) -> Offsets:
        held = {p: self.segments(p) for p in self.partitions()}
        return {p: segments[0][0] for p, segments in held.items() if segments}

    def latest(self) -> Offsets:
        """The offset after the last one of every partition."""
        held = {p: self.segments(p) for p in self.partitions()}
        return {p: self.last(segments[-1][1]) + 1 for p, segments in held.items() if segments}

    def ranges(self, start: Mapping[str, int], end: Mapping[str, int]) -> list[Range]:
        """The ranges of segments between two positions; a new partition begins at its first."""
        out = []
        for partition, stop in end.items():
            segments = self.segments(partition)
            begin = start.get(partition, segments[0][0] if segments else 0)
            for (first, file), (after, _) in zip(segments, [*segments[1:], (stop, "")]):
                low, high = max(begin, first), min(stop, after)
                if low < high:
                    out.append(Range(partition.split("/")[0], file, low, high))
        return out

    def read(self, wanted: Range | None) -> Iterator[pa.RecordBatch]:
        """The records of a range, a row group at a time; without a range there are none."""
        if wanted is None:
            return
        with self.system.open_input_file(wanted.file) as source:
            segment = pq.ParquetFile(source)
            for i in range(segment.metadata.num_row_groups):
                table = segment.read_row_group(i, columns=["offset", "arrival_ts", "value"])
                at = table.column("offset")
                table = table.filter(
                    pc.and_(pc.greater_equal(at, wanted.start), pc.less(at, wanted.end))
                )
                arrival = table.column("arrival_ts").cast(pa.timestamp("us", "UTC"))
                topic = pa.array([wanted.topic] * table.num_rows, pa.string())
                whole = pa.table(
                    [topic, table.column("offset").cast(pa.int64()), arrival, table.column("value")],
                    names=["topic", "offset", "arrival_ts", "value"],
                )
                yield from whole.to_batches()

    # The positions of a group.

    def _group(self, group: str) -> str:
        return f"{self.root}/_groups/{group}.json"

    def committed(self, group: str) -> Offsets:
        file = self._group(group)
        if self.system.get_file_info(file).type == fs.FileType.NotFound:
            return {}
        with self.system.open_input_stream(file) as source:
            return json.loads(source.read())

    def commit(self, group: str, offsets: Mapping[str, int]) -> None:
        """Replace the group's positions in one step; a position never goes back."""
        now = self.committed(group)
        whole = now | {p: max(o, now.get(p, 0)) for p, o in offsets.items()}
        file = self._group(group)
        self.system.create_dir(file.rsplit("/", 1)[0])
        with self.system.open_output_stream(f"{file}.draft") as out:
            out.write(json.dumps(whole).encode())
        self.system.move(f"{file}.draft", file)

    def begin(self, group: str, starting: str) -> Offsets:
        """Where a new reader starts: the group's positions, else (or if asked) the earliest."""
        if starting not in ("committed", "earliest", "latest"):
            raise ValueError(f"starting: {starting!r}")
        if starting == "latest":
            return self.latest()
        return self.earliest() | (self.committed(group) if starting == "committed" else {})


class _Options:
    def __init__(self, options: Mapping[str, str]):
        self.log = Log(options["path"], options["topics"].split(","))
        self.group = options.get("group", GROUP)
        self.starting = options.get("starting", "committed")
        self.limit = int(options.get("offsetspertrigger", OFFSETS_PER_TRIGGER))


class SegmentReader(DataSourceReader):
    """A batch from the group's positions, or the earliest offsets, to the latest ones."""

    def __init__(self, options: Mapping[str, str]):
        self.options = _Options(options)

    def partitions(self) -> list[Range]:
        o = self.options
        return o.log.ranges(o.log.begin(o.group, o.starting), o.log.latest())

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.options.log.read(partition)


class SegmentStreamReader(DataSourceStreamReader):
    """Triggers of a bounded number of offsets; what a query has committed, its group has too.

    A restarted query goes on from its checkpoint, whatever the group says.
    """

    def __init__(self, options: Mapping[str, str]):
        self.options = _Options(options)
        self.reached: Offsets | None = None

    def initialOffset(self) -> dict:
        self.reached = self.options.log.begin(self.options.group, self.options.starting)
        return self.reached

    def latestOffset(self) -> dict:
        o = self.options
        latest = o.log.latest()
        if self.reached is None:
            # A restart: the checkpoint's position is known once the first trigger is planned.
            self.reached = o.log.begin(o.group, "committed")
        begin = o.log.earliest() | self.reached
        share = max(1, o.limit // max(1, sum(begin[p] < latest[p] for p in latest)))
        self.reached = {p: min(end, begin[p] + share) for p, end in latest.items()}
        return self.reached

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.reached = dict(end)
        return self.options.log.ranges(start, end)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.options.log.read(partition)

    def commit(self, end: dict) -> None:
        self.options.log.commit(self.options.group, end)


class TopicSegments(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SegmentReader:
        return SegmentReader(self.options)

    def streamReader(self, schema) -> SegmentStreamReader:
        return SegmentStreamReader(self.options)


def topic_segments(
    spark: SparkSession,
    path: str,
    topics: Sequence[str],
    streaming: bool = True,
    group: str = GROUP,
    starting: str = "committed",
    offsets_per_trigger: int = OFFSETS_PER_TRIGGER,
) -> DataFrame:
    """The records of ``topics`` as (topic, offset, arrival_ts, value).

    A new query starts at the group's committed offsets and, where there are none, at the
    earliest; ``starting`` may ask for ``earliest`` or ``latest`` instead. A batch reads from
    there to the latest offsets and commits nothing; ``Log.commit`` does. Offsets that were
    cleaned away are passed over.
    """
    # The reader travels with the query, so executors need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(TopicSegments)
    source = (spark.readStream if streaming else spark.read).format(FORMAT)
    return source.options(
        path=path,
        topics=",".join(topics),
        group=group,
        starting=starting,
        offsetsPerTrigger=str(offsets_per_trigger),
    ).load()
