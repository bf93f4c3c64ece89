"""Physical plans: shuffles, pushdown, and what must never appear."""

import re

import pytest

from matchlake.operators import metrics
from matchlake.plans.match_facts import ranked_facts
from matchlake.plans.queries import BUILDERS, QUERIES
from matchlake.sources import cdc
from matchlake.sources.testdata import bind


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan):
    return len(re.findall(r"Exchange hashpartitioning", plan))


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    """The four source tables as plain files."""
    folder = tmp_path_factory.mktemp("tables")
    inputs = bind(spark, small)
    tables = {}
    for name in ("players", "match_participants", "match_events", "ranks"):
        getattr(inputs, name).write.parquet(f"{folder}/{name}")
        tables[name] = spark.read.parquet(f"{folder}/{name}")
    return tables


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def facts(stored):
    return ranked_facts(
        stored["players"],
        stored["match_participants"],
        stored["match_events"],
        stored["ranks"],
        "seq",
    )


def test_facts_shuffle_each_table_once_per_key(stored, no_broadcast):
    """Participants by player and by match, facts with ranks by player; the rest once."""
    plan = plan_of(facts(stored))
    assert shuffles(plan) == 5
    assert "BroadcastExchange" not in plan


def test_facts_with_small_dimensions_shuffle_twice(stored):
    plan = plan_of(facts(stored))
    assert shuffles(plan) == 2


def test_reports_read_only_their_columns(stored):
    from matchlake.plans import reports

    plan = plan_of(reports.map_results(facts(stored)))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    participants = next(s for s in scans if "match_id" in s)
    assert "hero_played" not in participants
    assert "healing" not in participants


def test_each_record_is_parsed_once(spark):
    log = spark.createDataFrame([], cdc.LOG_SCHEMA)
    for table in cdc.PUBLISHED:
        optimized = cdc.decode(log, table)._jdf.queryExecution().optimizedPlan().toString()
        assert optimized.count("from_json(") == 1


def test_each_topic_is_read_by_its_own_table(spark, tmp_path):
    from matchlake.plans.match_facts import facts_from_logs

    for table in cdc.PUBLISHED:
        spark.createDataFrame([], cdc.LOG_SCHEMA).write.json(str(tmp_path / cdc.topic(table)))
    plan = plan_of(facts_from_logs(cdc.read_logs(spark, str(tmp_path))))
    scans = [line for line in plan.splitlines() if "FileScan json" in line]
    read = {table for table in cdc.PUBLISHED for s in scans if cdc.topic(table) in s}
    assert len(scans) == len(read) == 4


def test_no_query_gathers_keys_in_one_task(spark, small, monkeypatch):
    """Hot keys are counted before a shuffle by key, never in a single task."""
    frame = type(spark.range(0))
    seen, collect = [], frame.collect

    def watched(df):
        seen.append(plan_of(df))
        return collect(df)

    monkeypatch.setattr(frame, "collect", watched)
    for name in ("match_facts", "alert_report", "metric_deriv"):
        BUILDERS[name](bind(spark, small))
    assert seen
    assert not any("SinglePartition" in plan for plan in seen)


def test_sliding_windows_shuffle_once(spark, small):
    samples = metrics.with_series(bind(spark, small).alert_samples)
    assert shuffles(plan_of(metrics.increase(samples, 600))) == 1
    assert shuffles(plan_of(metrics.deriv(samples, 600))) == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, small, name):
    plan = plan_of(BUILDERS[name](bind(spark, small)))
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert unwanted not in plan
