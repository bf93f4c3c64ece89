"""Every operator bound to the shared test tables, by query name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions.ranks import rank_division, rank_tier
from matchlake.functions.time import from_ms, wall_clock
from matchlake.operators import asof, joins, metrics, quality, rank_history, replay
from matchlake.operators.skew import HotKeys, find_hot_keys
from matchlake.operators.versions import latest
from matchlake.plans import alerts, reports
from matchlake.plans.match_facts import facts_of
from matchlake.schemas import FACT_COLUMNS
from matchlake.sources import cdc
from matchlake.sources.testdata import COUNTER, GAUGE, Inputs, bind

Query = Callable[[SparkSession, str], DataFrame]
BUILDERS: dict[str, Callable[[Inputs], DataFrame]] = {}

DAY = 86_400
HOUR = 3600


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register ``build`` under its name, less a trailing underscore."""
    BUILDERS[build.__name__.rstrip("_")] = build
    return build


def _clocks(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: wall_clock(F.col(n)) for n in names})


# --- change logs -------------------------------------------------------------


def _unwrapped(t: Inputs) -> DataFrame:
    parts = []
    for table in cdc.PUBLISHED:
        rows = cdc.unwrap(t.cdc_log(table), table)
        key = F.col("after")[_log_key(table)].try_cast("bigint")
        parts.append(rows.withColumn("key", key).drop("after", "value"))
    return reports.union_all(parts)


def _log_key(table: str) -> str:
    return "player_id" if table == "ranks" else "id"


@query
def cdc_source_counts(t: Inputs) -> DataFrame:
    return (
        cdc.published(t.cdc_log())
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
        )
    )


@query
def cdc_unwrap(t: Inputs) -> DataFrame:
    return _unwrapped(t).select("topic", "offset", "key", F.col("key").isNotNull().alias("has_row"))


@query
def cdc_drop_deletes(t: Inputs) -> DataFrame:
    return cdc.drop_deletes(_unwrapped(t)).select("topic", "offset", "fate")


@query
def cdc_rejects(t: Inputs) -> DataFrame:
    return reports.union_all(
        [cdc.rejects(t.cdc_log(table), table) for table in cdc.PUBLISHED]
    ).select("topic", "offset", "reason")


@query
def decode_after_rejects(t: Inputs) -> DataFrame:
    """Rows per table that decode to typed rows, next to those left out."""
    return reports.union_all(
        [
            cdc.drop_deletes(cdc.unwrap(t.cdc_log(table), table))
            .groupBy("topic")
            .agg(
                F.count_if(F.col("fate") == "row").alias("decoded"),
                F.count_if(F.col("fate") != "row").alias("rejected"),
            )
            for table in cdc.PUBLISHED
        ]
    )


def _decoded(t: Inputs, table: str) -> DataFrame:
    return cdc.decode(cdc.of_table(t.cdc_log(table), table), table)


@query
def decode_match_event(t: Inputs) -> DataFrame:
    return _clocks(_decoded(t, "match_events"), "started_at", "ended_at")


@query
def decode_participant(t: Inputs) -> DataFrame:
    return _decoded(t, "match_participants")


@query
def decode_player(t: Inputs) -> DataFrame:
    return _clocks(_decoded(t, "players"), "created_at", "deleted_at")


@query
def decode_rank(t: Inputs) -> DataFrame:
    return _clocks(_decoded(t, "ranks"), "updated_at")


# --- joins -------------------------------------------------------------------


def _looked(t: Inputs) -> DataFrame:
    return joins.player_lookup(t.match_participants, t.players, t.hot_players)


def _started(t: Inputs) -> DataFrame:
    """All participants with the start of their match, whether or not it is complete."""
    starts = t.match_events.select(F.col("id").alias("match_id"), "started_at")
    return t.match_participants.select("id", "match_id", "player_id").join(starts, "match_id")


def _ranked(t: Inputs, join: Callable[..., DataFrame]) -> DataFrame:
    return join(_started(t), t.ranks, "seq", "found", "id", t.hot_players).drop(
        "match_id", "started_at"
    )


@query
def player_lookup(t: Inputs) -> DataFrame:
    return _looked(t)


@query
def lookup_misses(t: Inputs) -> DataFrame:
    return joins.lookup_misses(t.match_participants, t.players, t.hot_players)


@query
def roster_join(t: Inputs) -> DataFrame:
    rows = joins.roster_join(_looked(t), t.match_events, hot=t.hot_matches)
    return _clocks(rows, "started_at", "ended_at")


@query
def rank_as_of(t: Inputs) -> DataFrame:
    return _ranked(t, asof.rank_as_of)


@query
def rank_as_of_broadcast(t: Inputs) -> DataFrame:
    return _ranked(t, asof.rank_as_of_broadcast)


@query
def rank_defaulted(t: Inputs) -> DataFrame:
    return asof.defaulted(_ranked(t, asof.rank_as_of), "found").select("id", "player_id")


@query
def match_facts(t: Inputs) -> DataFrame:
    return joins.fact_rows(facts_of(t)).select(*FACT_COLUMNS[:-1])


# --- versions, sessions and the replay ---------------------------------------


@query
def latest_player(t: Inputs) -> DataFrame:
    rows = latest(t.player_log, ["id"], ["arrival_ts", "offset"]).drop("offset")
    return _clocks(rows, "created_at", "deleted_at").withColumn(
        "arrival_ts", wall_clock(F.col("arrival_ts"))
    )


@query
def rank_history_(t: Inputs) -> DataFrame:
    rows = asof.history(t.rank_log, ["arrival_ts", "seq"]).drop("offset")
    return _clocks(rows, "updated_at", "arrival_ts")


def _session_times(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "match_id",
        wall_clock(from_ms(F.col("session_start"))).alias("session_start"),
        wall_clock(from_ms(F.col("fire_ms"))).alias("fired_at"),
        "participants",
        "events",
        "complete",
    )


@query
def quiet_sessions(t: Inputs) -> DataFrame:
    return _session_times(_sessions(t))


def _sessions(t: Inputs) -> DataFrame:
    looked = replay.lookup_on_arrival(t.participant_log, t.player_log, t.hot_players)
    arrivals = replay.match_arrivals(looked, t.event_log, hot=t.hot_matches)
    return replay.quiet_sessions(arrivals)


@query
def buffered_at(t: Inputs) -> DataFrame:
    looked = replay.lookup_on_arrival(t.participant_log, t.player_log, t.hot_players)
    arrivals = replay.match_arrivals(looked, t.event_log, hot=t.hot_matches)
    return _clocks(replay.buffered_at_scrapes(arrivals), "scraped_at")


@query
def arrival_replay(t: Inputs) -> DataFrame:
    facts = replay.arrival_replay(
        t.participant_log,
        t.player_log,
        t.event_log,
        t.rank_log,
        hot_players=t.hot_players,
        hot_matches=t.hot_matches,
    )
    return _clocks(facts, "started_at", "ended_at").select("id", *FACT_COLUMNS[:-1])


# --- reports -----------------------------------------------------------------


@query
def facts_landed(t: Inputs) -> DataFrame:
    return reports.facts_landed_chart(reports.facts_landed(facts_of(t)))


@query
def hero_win_rate(t: Inputs) -> DataFrame:
    return reports.ordered_report(facts_of(t), "hero_win_rate")


@query
def map_results(t: Inputs) -> DataFrame:
    return reports.ordered_report(facts_of(t), "map_results")


@query
def player_leaderboard(t: Inputs) -> DataFrame:
    return reports.ordered_report(facts_of(t), "player_leaderboard")


@query
def rank_as_of_mix(t: Inputs) -> DataFrame:
    return reports.ordered_report(facts_of(t), "rank_as_of_mix")


@query
def rank_vs_result(t: Inputs) -> DataFrame:
    return reports.ordered_report(facts_of(t), "rank_vs_result")


@query
def player_timeline(t: Inputs) -> DataFrame:
    return _clocks(reports.player_timeline(facts_of(t)), "started_at")


@query
def hero_top(t: Inputs) -> DataFrame:
    return reports.hero_top(facts_of(t))


@query
def leaderboard_top(t: Inputs) -> DataFrame:
    return reports.leaderboard_top(facts_of(t))


@query
def dataset_row_counts(t: Inputs) -> DataFrame:
    return reports.dataset_row_counts(facts_of(t))


@query
def dashboard_reports(t: Inputs) -> DataFrame:
    return reports.all_reports(facts_of(t))


# --- ranks and quality -------------------------------------------------------


@query
def derive_rank(t: Inputs) -> DataFrame:
    points = F.col("healing") % 2600 - 100
    return t.match_participants.select(
        "id",
        points.alias("points"),
        rank_tier(points).alias("rank_tier"),
        rank_division(points).alias("rank_division"),
    )


@query
def rank_points_history(t: Inputs) -> DataFrame:
    rows = rank_history.points_history(t.results, t.hot_players)
    return _clocks(rows, "updated_at").select("player_id", "updated_at", "seq", "rank_points")


@query
def wins_losses_history(t: Inputs) -> DataFrame:
    rows = rank_history.points_history(t.results, t.hot_players)
    return _clocks(rows, "updated_at").select(
        "player_id", "updated_at", "seq", "wins", "losses"
    )


@query
def current_rank(t: Inputs) -> DataFrame:
    return _clocks(rank_history.current_ranks(t.ranks), "updated_at")


@query
def match_quality(t: Inputs) -> DataFrame:
    return quality.match_quality(t.match_participants, t.match_events)


def _tables(t: Inputs) -> dict[str, DataFrame]:
    return {
        "players": t.players,
        "ranks": rank_history.current_ranks(t.ranks),
        "match_events": t.match_events,
        "match_participants": t.match_participants,
    }


@query
def constraint_report(t: Inputs) -> DataFrame:
    return quality.constraint_report(_tables(t))


@query
def fk_violations(t: Inputs) -> DataFrame:
    return quality.fk_violations(_tables(t))


@query
def roster_quality(t: Inputs) -> DataFrame:
    return quality.session_quality(_sessions(t))


@query
def final_roster_quality(t: Inputs) -> DataFrame:
    return quality.roster_quality(_looked(t), t.match_events)


@query
def lookup_quality(t: Inputs) -> DataFrame:
    return quality.lookup_quality(t.match_participants, t.players)


@query
def lookup_miss_rate(t: Inputs) -> DataFrame:
    return quality.lookup_miss_rate(quality.lookup_quality(t.match_participants, t.players))


@query
def rank_quality(t: Inputs) -> DataFrame:
    return quality.rank_quality(facts_of(t, "found"), "found")


@query
def rank_default_rate(t: Inputs) -> DataFrame:
    return quality.rank_default_rate(quality.rank_quality(facts_of(t, "found"), "found"))


# --- metrics and alerts ------------------------------------------------------


def _series(t: Inputs, name: str) -> DataFrame:
    return metrics.with_series(metrics.select(t.samples, name=name))


def _short_rows(series: DataFrame) -> DataFrame:
    """Samples with the labels that are shown in place of the map, as scans sort whole rows."""
    shown = [F.col("labels")[label].alias(label) for label in ("event_type", "shard")]
    return series.select(*metrics.SERIES, *shown, "pos", "value")


def _shown(df: DataFrame, *values: Column | str) -> DataFrame:
    ts = F.timestamp_micros("pos")
    return df.select("event_type", "shard", wall_clock(ts).alias("ts"), *values)


def _hot_series(t: Inputs, series: DataFrame) -> HotKeys:
    return find_hot_keys(series, metrics.SERIES, t.rows_per_task)


def _labelled(df: DataFrame, *values: Column | str) -> DataFrame:
    return df.select(
        F.col("labels")["event_type"].alias("event_type"),
        F.col("labels")["shard"].alias("shard"),
        wall_clock(F.col("ts")).alias("ts"),
        *values,
    )


@query
def metric_select(t: Inputs) -> DataFrame:
    chosen = metrics.select(
        t.samples, name_like="session_v.*", equal={"shard": "1"}, like={"event_type": "c.*|.*w"}
    )
    return _labelled(chosen, "name", "value")


@query
def metric_increase(t: Inputs) -> DataFrame:
    counter = _short_rows(_series(t, COUNTER))
    grown = metrics.increase(counter, DAY, hot=_hot_series(t, counter))
    return _shown(grown, "value", "increase")


@query
def metric_rate(t: Inputs) -> DataFrame:
    counter = _short_rows(_series(t, COUNTER))
    grown = metrics.increase(counter, HOUR, hot=_hot_series(t, counter))
    return _shown(grown, F.round("rate", 9).alias("rate"))


@query
def metric_deriv(t: Inputs) -> DataFrame:
    gauge = _short_rows(_series(t, GAUGE))
    fitted = metrics.deriv(gauge, 2 * DAY, hot=_hot_series(t, gauge))
    return _shown(fitted, F.round("slope", 8).alias("slope"))


@query
def metric_or_zero(t: Inputs) -> DataFrame:
    """The checkpoint durations of a job whose samples are held up at times, or zero."""
    durations = metrics.with_series(
        metrics.select(t.alert_samples, name="flink_jobmanager_job_lastCheckpointDuration")
    )
    summed = metrics.sum_by(metrics.on_grid(durations), [])
    return metrics.or_zero_on_grid(summed).select(
        wall_clock(F.timestamp_micros("pos")).alias("ts"), "value"
    )


def _hourly(t: Inputs, name: str) -> DataFrame:
    return metrics.on_grid(_series(t, name), HOUR, 6 * HOUR)


def _hourly_sums(t: Inputs) -> DataFrame:
    return metrics.sum_by(_hourly(t, GAUGE), ["event_type"])


@query
def metric_sum_by(t: Inputs) -> DataFrame:
    return _hourly_sums(t).select(
        "event_type",
        wall_clock(F.timestamp_micros("pos")).alias("ts"),
        F.round("value", 4).alias("value"),
        "highest",
        "series_count",
    )


@query
def metric_ratio(t: Inputs) -> DataFrame:
    return (
        metrics.metric_ratio(_hourly(t, COUNTER), _hourly(t, GAUGE))
        .where("value > 0.8")
        .select(
            "series",
            wall_clock(F.timestamp_micros("pos")).alias("ts"),
            F.round("value", 6).alias("value"),
        )
    )


@query
def alert_lag_climbing(t: Inputs) -> DataFrame:
    """Sum over 100 and growing faster than 0.002 a second over six hours."""
    fitted = metrics.deriv(_hourly_sums(t), 6 * HOUR, ["event_type"])
    return fitted.where("value > 100 and slope > 0.002").select(
        "event_type",
        wall_clock(F.timestamp_micros("pos")).alias("ts"),
        F.round("value", 4).alias("value"),
        F.round("slope", 8).alias("slope"),
    )


@query
def alert_hold(t: Inputs) -> DataFrame:
    """Above 5 for twelve hours on end, looked at each hour."""
    gauge = _series(t, GAUGE)
    ticks = metrics.on_grid(gauge, HOUR, 6 * HOUR, hot=_hot_series(t, gauge))
    held = metrics.hold(
        ticks, F.col("value") > 5, DAY // 2, max_gap_seconds=HOUR, hot=_hot_series(t, ticks)
    )
    return _labelled(held, "value", "state")


@query
def alert_report(t: Inputs) -> DataFrame:
    evaluated = alerts.evaluate(t.alert_samples, rows_per_task=t.rows_per_task)
    report = alerts.alert_report(evaluated)
    return _clocks(report, "first_firing")


def _runner(build: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, folder: build(bind(spark, folder))


QUERIES: dict[str, Query] = {name: _runner(build) for name, build in BUILDERS.items()}
