"""The streaming job against the replay of the same log."""

import json
import os
import tempfile
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.operators import replay
from matchlake.operators.joins import fact_rows
from matchlake.schemas import FACT_COLUMNS
from matchlake.sources import cdc, lake
from matchlake.sources.testdata import bind
from matchlake.streaming.job import (
    append_files,
    append_table,
    facts_stream,
    heartbeat,
    print_facts,
    read_files,
)

LIMIT = 150
LANES = 16


class Run:
    """One query's folders: its log, its output and its checkpoint."""

    def __init__(self, spark):
        self.spark = spark
        self.folder = tempfile.mkdtemp(prefix="matchlake-stream-")
        self.log, self.out, self.checkpoint = (
            os.path.join(self.folder, n) for n in ("log", "out", "checkpoint")
        )
        os.mkdir(self.log)
        self.files = 0

    def deliver(self, records, folder=None):
        """Put records into the log as one file, in one step."""
        lines = [
            json.dumps(
                {
                    "topic": r[0],
                    "offset": r[1],
                    "arrival_ts": r[2].strftime("%Y-%m-%dT%H:%M:%S.%fZ"),
                    "value": r[3],
                }
            )
            for r in records
        ]
        draft = os.path.join(self.folder, f"{self.files}.json")
        with open(draft, "w") as f:
            f.write("\n".join(lines))
        stamp = time.time() - 1000 + self.files
        os.utime(draft, (stamp, stamp))
        os.replace(draft, os.path.join(folder or self.log, f"{self.files}.json"))
        self.files += 1

    def start(self, flush_ms=6000, **options):
        log = heartbeat(self.spark, cdc.replay_log(self.spark, self.log, files_per_trigger=1))
        facts = facts_stream(log, flush_ms=flush_ms, lanes=LANES, **options)
        return append_files(facts, self.out, self.checkpoint, "500 milliseconds")

    def facts(self):
        if not os.path.isdir(os.path.join(self.out, "_spark_metadata")):
            return None
        return read_files(self.spark, self.out).drop("ingested_at")

    def rows(self):
        facts = self.facts()
        return 0 if facts is None else facts.count()


def wait(query, condition):
    end = time.time() + LIMIT
    while time.time() < end:
        assert query.exception() is None, query.exception()
        if condition():
            return True
        time.sleep(0.5)
    return False


def read_files_of(query):
    """How many log files the query has taken in and committed."""
    return sum(p["numInputRows"] > 10 for p in query.recentProgress)


@pytest.fixture(scope="module")
def log(spark, small):
    inputs = bind(spark, small)
    rows = inputs.arrival_log.orderBy("arrival_ts", "topic", "offset").collect()
    replayed = replay.arrival_replay(
        inputs.participant_log, inputs.player_log, inputs.event_log, inputs.rank_log
    )
    expected = fact_rows(replayed).select(FACT_COLUMNS[:-1]).cache()
    assert expected.count() == 132
    return rows, expected


def same(found, expected):
    return (
        found.count() == expected.count()
        and found.exceptAll(expected).isEmpty()
        and expected.exceptAll(found).isEmpty()
    )


def cut(rows, pieces):
    size = -(-len(rows) // pieces)
    edges = [i * size for i in range(pieces)] + [len(rows)]
    # Records of one instant stay together.
    for i in range(1, pieces):
        while rows[edges[i]].arrival_ts == rows[edges[i] - 1].arrival_ts:
            edges[i] += 1
    return [rows[a:b] for a, b in zip(edges, edges[1:])]


def test_one_stream_per_topic(spark, log):
    """A folder per topic: every table reads its own records, and facts are the same."""
    rows, expected = log
    run = Run(spark)
    for table in cdc.PUBLISHED:
        folder = os.path.join(run.log, cdc.topic(table))
        os.mkdir(folder)
        run.deliver([r for r in rows if r[0] == cdc.topic(table)], folder)
    logs = heartbeat(spark, cdc.replay_logs(spark, run.log))
    query = append_files(
        facts_stream(logs, flush_ms=6000, lanes=LANES), run.out, run.checkpoint, "500 milliseconds"
    )
    try:
        assert wait(query, lambda: run.rows() >= expected.count())
        sources = [p["sources"] for p in query.recentProgress if p["numInputRows"] > 10][0]
    finally:
        query.stop()
    assert same(run.facts(), expected)
    assert len([s for s in sources if "FileStreamSource" in s["description"]]) == 4
    assert sum(s["numInputRows"] for s in sources if "File" in s["description"]) == len(rows)


def test_append_to_a_table_and_print(spark):
    run = Run(spark)
    run.deliver(match_records(1, 12))
    lake.ensure_table(spark, "demo.streamed")
    facts = facts_stream(heartbeat(spark, cdc.replay_log(spark, run.log)), flush_ms=1000, lanes=LANES)
    query = append_table(facts, "demo.streamed", run.checkpoint, "500 milliseconds")
    try:
        assert wait(query, lambda: lake.read_facts(spark, "demo.streamed").count() == 12)
    finally:
        query.stop()
    printed = print_facts(facts, run.checkpoint + "-print", "500 milliseconds")
    try:
        assert wait(printed, lambda: read_files_of(printed) == 1)
        assert "Console" in printed.lastProgress["sink"]["description"]
    finally:
        printed.stop()


@pytest.mark.parametrize("pieces, salts", [(1, 1), (3, 2)])
def test_stream_equals_replay(spark, log, pieces, salts):
    rows, expected = log
    run = Run(spark)
    for piece in cut(rows, pieces):
        run.deliver(piece)
    query = run.start(salts=salts)
    try:
        assert wait(query, lambda: run.rows() >= expected.count())
        progress = [p["observedMetrics"] for p in query.recentProgress]
        totals = {
            name: sum(p[group][name] for p in progress if group in p)
            for group, name in [
                ("lookup", "player_lookup_hits"),
                ("lookup", "player_lookup_misses"),
                ("join", "complete"),
                ("rank", "rank_as_of_found"),
                ("rank", "rank_as_of_defaulted"),
            ]
        }
    finally:
        query.stop()
    assert same(run.facts(), expected)
    assert totals["player_lookup_hits"] + totals["player_lookup_misses"] == 1000
    assert totals["complete"] == 11
    assert totals["rank_as_of_found"] + totals["rank_as_of_defaulted"] == 132


def test_restart_goes_on_where_it_stopped(spark, log):
    rows, expected = log
    first, second = cut(rows, 2)
    run = Run(spark)
    run.deliver(first)
    query = run.start(flush_ms=25_000)
    try:
        assert wait(query, lambda: read_files_of(query) == 1)
    finally:
        query.stop()
    before = run.rows()
    run.deliver(second)
    query = run.start(flush_ms=25_000)
    try:
        assert wait(query, lambda: run.rows() >= expected.count())
    finally:
        query.stop()
    assert before < expected.count()
    assert same(run.facts(), expected)
    # A finished run has nothing left to add.
    query = run.start(flush_ms=25_000)
    try:
        assert wait(query, lambda: len(query.recentProgress) >= 3)
    finally:
        query.stop()
    assert same(run.facts(), expected)


def test_restored_timer_fires_without_new_records(spark):
    run = Run(spark)
    run.deliver(match_records(1, 12))
    query = run.start(flush_ms=20_000)
    try:
        assert wait(query, lambda: read_files_of(query) == 1)
    finally:
        query.stop()
    assert run.rows() == 0
    query = run.start(flush_ms=20_000)
    try:
        assert wait(query, lambda: run.rows() == 12)
    finally:
        query.stop()


T0 = datetime(2026, 1, 15, 12)


def match_records(match, size, at=100, gap_after=None, event=True):
    """Players, one match and its participants; some participants may come later."""

    def record(table, offset, ms, **after):
        text = json.dumps({"payload": {"after": after}})
        return (cdc.topic(table), offset, T0 + timedelta(milliseconds=ms), text)

    iso = "2026-01-15T12:00:00Z"
    base = match * 100
    rows = [
        record(
            "players",
            base + i,
            0,
            id=base + i,
            account_name=f"p{base + i}",
            email="e",
            created_at=iso,
            account_status="active",
        )
        for i in range(size)
    ]
    rows += [
        record(
            "match_participants",
            base + i,
            at + (4000 if gap_after is not None and i >= gap_after else 0),
            id=base + i,
            match_id=match,
            player_id=base + i,
            team=i % 2,
            hero_played="Loki",
        )
        for i in range(size)
    ]
    if event:
        rows.append(
            record(
                "match_events",
                match,
                at,
                id=match,
                map_name="Klyntar",
                match_duration_seconds=500,
                started_at=iso,
                ended_at=iso,
                winning_team=0,
            )
        )
    return rows


def test_incomplete_and_bad_matches_emit_nothing(spark):
    run = Run(spark)
    bad = (cdc.topic("match_participants"), 999, T0, '{"payload":{"after":{"id":')
    gone = (cdc.topic("players"), 998, T0, '{"payload":{"after":null}}')
    run.deliver(
        match_records(1, 12)
        + match_records(2, 11)
        + match_records(3, 13)
        + match_records(4, 12, event=False)
        + match_records(5, 12, gap_after=6)
        + [bad, gone]
    )
    run.deliver(match_records(6, 12, at=60_000))
    query = run.start(flush_ms=3000)
    try:
        assert wait(query, lambda: run.rows() >= 24)
        closed = {}

        def all_closed():
            observed = [p["observedMetrics"].get("join") for p in query.recentProgress]
            for name in ("complete", "incomplete"):
                closed[name] = sum(o[name] for o in observed if o)
            return closed == {"complete": 2, "incomplete": 5}

        assert wait(query, all_closed), closed
    finally:
        query.stop()
    facts = run.facts()
    assert {r.match_id for r in facts.select("match_id").distinct().collect()} == {1, 6}
    assert facts.where(F.col("rank_tier_at_match_start") == "bronze").count() == 24
