"""Topics read by offset range: earliest, committed and resumed starts, without a broker."""

import os
import tempfile
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from matchlake.sources import cdc, offsets
from matchlake.sources.offsets import Log, topic_segments

A, B = "dbserver1.public.players", "dbserver1.public.ranks"


def segment(path, topic, partition, first, count):
    """Records ``first`` to ``first + count`` of a partition, as one file in one step."""
    folder = f"{path}/{topic}/{partition}"
    os.makedirs(folder, exist_ok=True)
    numbers = range(first, first + count)
    table = pa.table(
        {
            "offset": pa.array(numbers, pa.int64()),
            "arrival_ts": pa.array([1_700_000_000_000_000 + n for n in numbers], pa.timestamp("us", "UTC")),
            "value": [f"{topic}/{partition}/{n}" for n in numbers],
        }
    )
    pq.write_table(table, f"{folder}/.draft", row_group_size=7)
    os.replace(f"{folder}/.draft", f"{folder}/{first:012d}.parquet")


@pytest.fixture
def log(tmp_path):
    path = str(tmp_path / "log")
    segment(path, A, 0, 0, 30)
    segment(path, A, 0, 30, 20)
    segment(path, A, 1, 5, 10)
    segment(path, B, 0, 0, 12)
    segment(path, "other", 0, 0, 3)
    return path


def values(df):
    return sorted((r.topic, r.offset, r.value) for r in df.select("topic", "offset", "value").collect())


def every(topic, partition, first, stop):
    return [(topic, n, f"{topic}/{partition}/{n}") for n in range(first, stop)]


def test_batch_from_earliest_and_from_committed(spark, log):
    read = lambda **o: topic_segments(spark, log, [A, B], streaming=False, **o)
    whole = [*every(A, 0, 0, 50), *every(A, 1, 5, 15), *every(B, 0, 0, 12)]
    assert values(read()) == sorted(whole)
    assert values(read(starting="latest")) == []
    mine = Log(log, [A, B])
    mine.commit("facts", {f"{A}/0": 33, f"{B}/0": 12})
    rest = [*every(A, 0, 33, 50), *every(A, 1, 5, 15)]
    assert values(read()) == sorted(rest)
    assert values(read(group="another")) == values(read(starting="earliest")) == sorted(whole)
    # A position never goes back.
    mine.commit("facts", {f"{A}/0": 2})
    assert mine.committed("facts")[f"{A}/0"] == 33
    first = read(starting="earliest").orderBy("arrival_ts").first()
    assert first.arrival_ts.microsecond == 0
    assert values(topic_segments(spark, log, ["absent"], streaming=False)) == []


def test_change_topics_as_a_log(spark, log):
    """The segments have the columns of every other log, and only the tables asked for."""
    whole = cdc.segment_log(spark, log, ["players", "ranks"], streaming=False)
    assert whole.schema.simpleString() == spark.createDataFrame([], cdc.LOG_SCHEMA).schema.simpleString()
    assert whole.count() == 50 + 10 + 12
    each = cdc.segment_logs(spark, log, ["players", "ranks"], streaming=False)
    assert {t: df.count() for t, df in each.items()} == {"players": 60, "ranks": 12}
    assert cdc.segment_log(spark, log, ["players"]).isStreaming


def test_ranges_read_no_other_segment(log):
    ranges = Log(log, [A]).ranges({f"{A}/0": 25}, {f"{A}/0": 40, f"{A}/1": 8})
    assert [(os.path.basename(r.file), r.start, r.end) for r in ranges] == [
        ("000000000000.parquet", 25, 30),
        ("000000000030.parquet", 30, 40),
        ("000000000005.parquet", 5, 8),
    ]


class Sink:
    """A streaming query into files, stopped and started again."""

    def __init__(self, spark, path, **options):
        self.spark, self.path, self.options = spark, path, options
        self.folder = tempfile.mkdtemp(prefix="matchlake-offsets-")

    def run(self, expected):
        stream = topic_segments(self.spark, self.path, [A, B], **self.options)
        query = (
            stream.writeStream.format("parquet")
            .option("path", f"{self.folder}/out")
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .trigger(processingTime="200 milliseconds")
            .start()
        )
        try:
            end = time.time() + 60
            while self.rows() != expected and time.time() < end:
                assert query.exception() is None, query.exception()
                time.sleep(0.3)
            batches = [p["numInputRows"] for p in query.recentProgress]
        finally:
            query.stop()
        assert self.rows() == expected
        return batches

    def rows(self):
        if not os.path.isdir(f"{self.folder}/out/_spark_metadata"):
            return []
        return values(self.spark.read.schema(offsets.SCHEMA).parquet(f"{self.folder}/out"))


def test_stream_resumes_from_its_checkpoint_and_a_new_one_from_the_group(spark, log):
    sink = Sink(spark, log, offsets_per_trigger=15)
    whole = [*every(A, 0, 0, 50), *every(A, 1, 5, 15), *every(B, 0, 0, 12)]
    batches = sink.run(sorted(whole))
    assert max(batches) <= 15
    # The query goes on where it stopped, and takes a new partition from its beginning.
    segment(log, A, 0, 50, 4)
    segment(log, B, 1, 100, 3)
    more = [*every(A, 0, 50, 54), *every(B, 1, 100, 103)]
    sink.run(sorted(whole + more))
    # What was committed last is committed with the trigger after it.
    segment(log, A, 1, 15, 2)
    last = every(A, 1, 15, 17)
    sink.run(sorted(whole + more + last))
    done = Log(log, [A, B]).committed("facts")
    assert done[f"{A}/0"] >= 50 and done[f"{B}/0"] == 12
    # A query without a checkpoint starts at the group's positions, others at the earliest.
    here = [r for r in sorted(whole + more + last) if r[1] >= done.get(r[2].rsplit("/", 1)[0], 0)]
    Sink(spark, log).run(here)
    Sink(spark, log, group="new").run(sorted(whole + more + last))
