"""Alerts evaluated on a stream, counters as a table and the gauge of the state store."""

import json
import os
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from matchlake.operators import replay
from matchlake.plans import alerts
from matchlake.sources import cdc
from matchlake.sources.testdata import bind
from matchlake.streaming import counters
from matchlake.streaming.alerts import AlertStream, horizon_seconds
from matchlake.streaming.job import append_files, facts_stream
from test_streaming import Run, cut, same, wait


@pytest.fixture(scope="module")
def samples(spark, small):
    rows = bind(spark, small).alert_samples.collect()
    return sorted(rows, key=lambda r: (r.ts, r.name, str(r.labels)))


def feed(folder, rows, n):
    """Samples as one file of a stream of JSON."""
    lines = [
        json.dumps({"name": r.name, "labels": r.labels, "ts": r.ts.strftime("%Y-%m-%dT%H:%M:%S.%fZ"), "value": r.value})
        for r in rows
    ]
    draft = os.path.join(os.path.dirname(folder), f"{n}.json")
    with open(draft, "w") as f:
        f.write("\n".join(lines))
    stamp = time.time() - 1000 + n
    os.utime(draft, (stamp, stamp))
    os.replace(draft, os.path.join(folder, f"{n}.json"))


def stream(spark, folder):
    schema = "name string, labels map<string,string>, ts timestamp, value double"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)


def parts(rows, count):
    """Samples in order of time; those of one instant stay together."""
    edges = [len(rows) * i // count for i in range(count + 1)]
    for i in range(1, count):
        while rows[edges[i]].ts == rows[edges[i] - 1].ts:
            edges[i] += 1
    return [rows[a:b] for a, b in zip(edges, edges[1:])]


def equal_to_batch(spark, running, rows):
    whole = spark.createDataFrame(rows, "name string, labels map<string,string>, ts timestamp, value double")
    due = running._clock(spark).agg(F.max("due")).first()[0]
    expected = alerts.evaluate(whole).where(F.col("ts") <= F.lit(due))
    found = running.evaluated(spark)
    assert found.columns == expected.columns
    keys = ["alert", "group", "ts"]
    got = {tuple(r[k] for k in keys): r for r in found.collect()}
    want = {tuple(r[k] for k in keys): r for r in expected.collect()}
    assert found.count() == len(got) and got.keys() == want.keys()
    for key, row in want.items():
        assert got[key].state == row.state, key
        assert got[key].value == pytest.approx(row.value)
        assert got[key].slope == (None if row.slope is None else pytest.approx(row.slope))
    return want


def test_streamed_alerts_equal_the_batch_across_a_restart(spark, samples):
    folder = tempfile.mkdtemp(prefix="matchlake-alerts-")
    source = os.path.join(folder, "in")
    os.mkdir(source)
    running = AlertStream(os.path.join(folder, "out"))
    pieces = parts(samples, 3)
    feed(source, pieces[0], 0)
    for n, more in enumerate([pieces[1], pieces[2]], 1):
        query = running.start(stream(spark, source), os.path.join(folder, "checkpoint"), "1 second")
        try:
            batches = lambda: running._clock(spark).count()
            assert wait(query, lambda: batches() == n)
        finally:
            query.stop()
        feed(source, more, n)
    query = running.start(stream(spark, source), os.path.join(folder, "checkpoint"), "1 second")
    try:
        assert wait(query, lambda: batches() == 3)
    finally:
        query.stop()
    want = equal_to_batch(spark, running, samples)
    assert {r.state for r in want.values()} == {"inactive", "pending", "firing"}
    # Every change of state is there once, and none between equal states.
    changed = running.changes(spark).collect()
    assert changed and all(r.before != r.state for r in changed)


def test_late_samples_within_the_delay(spark, samples):
    """Samples up to a minute late, taken trigger by trigger; a trigger is run twice."""
    rng = random.Random(3)
    shuffled = sorted(samples, key=lambda r: r.ts.timestamp() + rng.random() * 60)
    running = AlertStream(tempfile.mkdtemp(prefix="matchlake-alerts-"), delay_seconds=60)
    size = len(shuffled) // 3 + 1
    for n in range(3):
        part = spark.createDataFrame(
            shuffled[n * size : (n + 1) * size], "name string, labels map<string,string>, ts timestamp, value double"
        )
        for _ in range(2 if n == 1 else 1):
            running.take(part, n)
    equal_to_batch(spark, running, samples)


def test_horizon_covers_every_rule():
    rules = alerts.RULES
    assert horizon_seconds(rules, 15, 300) == 300 + 900 + 300 + 30
    assert horizon_seconds(rules[:1], 15, 300) == 300 + 300 + 30


@pytest.fixture(scope="module")
def log(spark, small):
    inputs = bind(spark, small)
    return inputs, inputs.arrival_log.orderBy("arrival_ts", "topic", "offset").collect()


def test_counters_and_gauge(spark, log):
    """Half a log: counted per batch, and what is left open equals the replay's open sessions."""
    inputs, rows = log
    first, second = cut(rows, 2)
    run = Run(spark)
    table = f"{run.folder}/counters"
    listener = counters.CounterTable(spark, table)
    spark.streams.addListener(listener)
    observed = {}
    try:
        for n, piece in enumerate([first, second]):
            run.deliver(piece)
            facts = facts_stream(cdc.replay_log(spark, run.log, files_per_trigger=1), flush_ms=600_000, lanes=16)
            query = append_files(facts, run.out, run.checkpoint, "500 milliseconds")
            try:
                seen = lambda: [p for p in query.recentProgress if p["numInputRows"] > 10]
                assert wait(query, lambda: len(seen()) == 1)
                assert wait(query, lambda: len(query.recentProgress) >= 3)
                for p in query.recentProgress:
                    for values in p["observedMetrics"].values():
                        for name, value in values.asDict().items():
                            observed[p["batchId"], name] = value
                assert wait(query, lambda: os.path.isdir(table) and len(batches_of(table)) > n)
            finally:
                query.stop()
            if n == 0:
                check_gauge(spark, run.checkpoint, inputs, first)
    finally:
        spark.streams.removeListener(listener)
    time.sleep(2)
    counted = counters.counts(spark, table)
    got = {(r.batch, r.counter): r.value for r in counted.collect()}
    assert counted.count() == len(got)
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in observed.items() if v}
    assert sum(v for (_, c), v in got.items() if c.startswith("player_lookup")) == 1000
    # Reported again, a batch is replaced.
    samples = counters.as_samples(counted)
    last = samples.groupBy("name").agg(F.max("value").alias("value")).collect()
    totals = {r.name.removeprefix(counters.METRIC_PREFIX): r.value for r in last}
    assert totals["player_lookup_hits"] == sum(v for (_, c), v in got.items() if c == "player_lookup_hits")
    assert set(totals) == set(counters.METRICS.values())


def batches_of(table):
    return [b for q in os.listdir(table) for b in os.listdir(f"{table}/{q}")]


def check_gauge(spark, checkpoint, inputs, delivered):
    """The buffer after half the log against sessions of the same records that had not fired."""
    last = {}
    people = spark.createDataFrame(
        [tuple(r) for r in delivered], "topic string, `offset` bigint, arrival_ts timestamp, value string"
    )
    log = {t: cdc.decode(cdc.of_table(people, t), t, keep=["arrival_ts", "offset"]) for t in cdc.PUBLISHED}
    looked = replay.lookup_on_arrival(log["match_participants"], log["players"])
    arrivals = replay.match_arrivals(looked, log["match_events"])
    sessions = replay.quiet_sessions(arrivals).collect()
    # A match's last session stays open, as only a later record of the match ends it here.
    for s in sorted(sessions, key=lambda s: s.session_start):
        last[s.match_id] = s.participants
    gauge = counters.buffered_participants(spark, checkpoint).first()
    assert gauge.buffered_participants == sum(last.values()) > 0
    assert gauge.open_matches == len(last)
