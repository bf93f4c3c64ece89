"""The fact table in the catalog, and current rows kept by a stream."""

import tempfile
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from matchlake.operators.joins import fact_rows
from matchlake.plans import reports
from matchlake.plans.match_facts import facts_of
from matchlake.schemas import MATCH_FACTS, struct
from matchlake.sources import lake
from matchlake.sources.testdata import bind
from matchlake.streaming.upsert import changes_writer, compact, current_rows


def test_table_life(spark, small):
    assert not lake.ready(spark)
    lake.ensure_table(spark)
    lake.ensure_table(spark)
    assert not lake.ready(spark)
    assert [(f.name, f.dataType) for f in lake.read_facts(spark).schema] == [
        (f.name, f.dataType) for f in struct(MATCH_FACTS)
    ]
    facts = fact_rows(facts_of(bind(spark, small)))
    lake.append_facts(facts)
    assert lake.ready(spark)
    lake.append_facts(facts)
    landed = lake.read_facts(spark)
    assert landed.count() == 312
    board = reports.dashboard(landed)
    assert set(board) == set(reports.REPORTS)
    assert board["facts_landed"].first().facts == 312
    assert board["hero_win_rate"].count() == 47
    rates = [r.win_rate for r in board["hero_win_rate"].collect()]
    assert rates == sorted(rates, reverse=True)


def test_scan_reads_only_what_a_report_needs(spark, small):
    lake.ensure_table(spark, "demo.narrow")
    lake.append_facts(fact_rows(facts_of(bind(spark, small))), "demo.narrow")
    report = reports.map_results(lake.read_facts(spark, "demo.narrow").where("winning_team = 1"))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "account_name" not in plan
    assert "PushedFilters: [IsNotNull(winning_team), EqualTo(winning_team,1)]" in plan


def test_table_by_day(spark, small):
    lake.ensure_table(spark, "demo.daily", by_day=True)
    facts = fact_rows(facts_of(bind(spark, small)))
    lake.append_facts(facts, "demo.daily")
    landed = lake.read_facts(spark, "demo.daily")
    assert landed.count() == 156
    assert landed.where("started_on <> cast(started_at as date)").count() == 0
    first = landed.where("started_on = date'2024-01-03'")
    assert "PartitionFilters: [isnotnull(started_on" in (
        first._jdf.queryExecution().executedPlan().toString()
    )


def test_current_rows_follow_the_changes(spark):
    path = tempfile.mkdtemp(prefix="matchlake-upsert-")
    keys, order = ["player_id"], ["updated_at", "seq"]
    write = changes_writer(path, keys, order)
    t0 = datetime(2026, 1, 1)

    def changes(*rows):
        full = [(p, n, t0 + timedelta(seconds=s), s) for p, n, s in rows]
        return spark.createDataFrame(
            full, "player_id bigint, rank_points int, updated_at timestamp, seq bigint"
        )

    def state():
        rows = current_rows(spark, path, keys, order).select("player_id", "rank_points")
        return dict(tuple(r) for r in rows.collect())

    write(changes((1, 30, 1), (2, 0, 1), (1, 60, 2)), 0)
    assert state() == {1: 60, 2: 0}
    for _ in range(2):  # the second run stands for a retry after a failure
        write(changes((2, 30, 3), (3, 30, 3), (1, 15, 0)), 1)
        assert state() == {1: 60, 2: 30, 3: 30}
    for _ in range(2):
        compact(spark, path, keys, order)
        assert state() == {1: 60, 2: 30, 3: 30}
    write(changes((3, 0, 4)), 2)
    assert state() == {1: 60, 2: 30, 3: 0}
    # A crash while a base is committed leaves some of its files, without the mark.
    whole = state()
    compact(spark, path, keys, order)
    base = Path(path, "base", "upto=2")
    (base / "_SUCCESS").unlink()
    next(base.glob("part-*")).unlink()
    assert state() == whole
    compact(spark, path, keys, order)
    assert (base / "_SUCCESS").exists() and state() == whole


def test_stream_keeps_current_rows(spark):
    folder = tempfile.mkdtemp(prefix="matchlake-upsert-")
    keys, order = ["player_id"], ["seq"]
    rows = spark.range(100).select(
        (F.col("id") % 7).alias("player_id"), F.col("id").alias("seq")
    )
    rows.write.parquet(f"{folder}/in")
    query = (
        spark.readStream.schema(rows.schema)
        .parquet(f"{folder}/in")
        .writeStream.foreachBatch(changes_writer(f"{folder}/out", keys, order))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    found = current_rows(spark, f"{folder}/out", keys, order).collect()
    assert {r.player_id: r.seq for r in found} == {i % 7: i for i in range(100)}
