"""Hand-made rows with known results."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.functions.ranks import rank_division, rank_tier, ratio
from matchlake.operators import asof, joins, metrics, rank_history, replay
from matchlake.operators.joins import fact_rows
from matchlake.operators.versions import latest
from matchlake.plans import alerts, reports
from matchlake.plans.match_facts import facts_from_logs, ranked_facts
from matchlake.schemas import (
    FACT_COLUMNS,
    MATCH_EVENTS,
    MATCH_FACTS,
    MATCH_PARTICIPANTS,
    PLAYERS,
    RANKS,
    struct,
)
from matchlake.sources import cdc

T0 = datetime(2026, 1, 15, 12, 0, 0)


def ms(n):
    return T0 + timedelta(milliseconds=n)


def players(spark, ids, name="p{}"):
    rows = [(i, name.format(i), f"{i}@x", T0, "active", None) for i in ids]
    return spark.createDataFrame(rows, PLAYERS)


def participants(spark, ids, match=42):
    rows = [
        (100 + i, match, i, n // 6 % 2, "Loki", None, 3, 10, "win") for n, i in enumerate(ids)
    ]
    return spark.createDataFrame(rows, MATCH_PARTICIPANTS)


def events(spark, ids=(42,), start=T0, name="Klyntar"):
    rows = [(i, name, 500, start, start + timedelta(seconds=500), 1) for i in ids]
    return spark.createDataFrame(rows, MATCH_EVENTS)


def ranks(spark, rows=()):
    """Rows of (player, tier, division, points, updated_at, seq)."""
    full = [(p, t, d, n, 0, 0, at, s) for p, t, d, n, at, s in rows]
    return spark.createDataFrame(full, RANKS + ", seq bigint")


def one_fact(spark, start=T0, player=7):
    return spark.createDataFrame(
        [(1, player, start)], "id bigint, player_id bigint, started_at timestamp"
    )


RANK = ("rank_tier_at_match_start", "rank_division_at_match_start", "rank_points_at_match_start")


def rank_of(df):
    row = df.first()
    return tuple(row[c] for c in RANK)


# 1: the layout of the fact table


def test_fact_layout(spark):
    rows = spark.createDataFrame(
        [
            (
                *(42, "Klyntar", 100, T0, T0 + timedelta(seconds=500), 1),
                *(7, "x", 0, "Loki", None, 3, 10, "win"),
                *("bronze", 3, 0),
            )
        ],
        "match_id bigint, map_name string, match_duration_seconds int, started_at timestamp, "
        "ended_at timestamp, winning_team int, player_id bigint, account_name string, "
        "team int, hero_played string, kills int, deaths int, healing int, result string, "
        "rank_tier_at_match_start string, rank_division_at_match_start int, "
        "rank_points_at_match_start int",
    )
    laid = fact_rows(rows)
    assert [(f.name, f.dataType) for f in laid.schema] == [
        (f.name, f.dataType) for f in struct(MATCH_FACTS)
    ]
    row = laid.first()
    assert row.match_id == 42
    assert row.map_name == "Klyntar"
    assert row.kills is None
    assert row.deaths == 3
    assert row.started_at == datetime(2026, 1, 15, 12, 0, 0)
    assert row.ended_at == datetime(2026, 1, 15, 12, 8, 20)
    assert row.ingested_at is not None


# 2-5: as-of


BOTH = [asof.rank_as_of, asof.rank_as_of_broadcast]


@pytest.mark.parametrize("join", BOTH)
@pytest.mark.parametrize(
    "history, start, expected",
    [
        ([(7, "gold", 2, 900, ms(0), 1)], ms(0), ("gold", 2, 900)),
        (
            [(7, "gold", 2, 900, T0 + timedelta(microseconds=900), 1)],
            T0 + timedelta(microseconds=500),
            ("gold", 2, 900),
        ),
        ([(7, "gold", 2, 900, ms(1), 1)], ms(0), ("bronze", 3, 0)),
        ([], ms(0), ("bronze", 3, 0)),
        ([(8, "gold", 2, 900, ms(0), 1)], ms(5), ("bronze", 3, 0)),
        ([(7, "bronze", 4, 0, ms(0), 1)], ms(5), ("bronze", 4, 0)),
        (
            [(7, "gold", 2, 900, ms(0), 1), (7, "gold", 1, 1100, ms(0), 2)],
            ms(5),
            ("gold", 1, 1100),
        ),
        (
            [(7, "gold", 1, 1100, ms(0), 2), (7, "gold", 2, 900, ms(0), 1)],
            ms(0),
            ("gold", 1, 1100),
        ),
        (
            [(7, "silver", 2, 600, ms(0), 1), (7, "gold", 2, 900, ms(3), 2)],
            ms(2),
            ("silver", 2, 600),
        ),
    ],
)
def test_as_of(spark, join, history, start, expected):
    joined = join(one_fact(spark, start), ranks(spark, history), "seq", "found")
    assert rank_of(joined) == expected
    assert joined.first().found == (expected != ("bronze", 3, 0))


def test_broadcast_falls_back_above_its_limits(spark):
    history = ranks(spark, [(7, "gold", 2, 900, ms(n), n) for n in range(10)])
    for limits in ({"max_versions": 5}, {"max_per_player": 5}):
        joined = asof.rank_as_of_broadcast(one_fact(spark), history, "seq", **limits)
        assert rank_of(joined) == ("gold", 2, 900)
        assert "Broadcast" not in joined._jdf.queryExecution().toString()


def test_history_keeps_the_later_arrival(spark):
    kept = asof.history(
        ranks(spark, [(7, "gold", 2, 900, ms(0), 1), (7, "gold", 1, 1100, ms(0), 2)]), ["seq"]
    )
    assert [(r.rank_points, r.seq) for r in kept.collect()] == [(1100, 2)]


# 6-7: the roster gate


def facts_of(spark, people, known, match_events):
    return ranked_facts(
        players(spark, known), participants(spark, people), match_events, ranks(spark), "seq"
    )


def test_full_roster(spark):
    assert facts_of(spark, range(12), range(12), events(spark)).count() == 12


def test_unknown_player_drops_the_match(spark):
    assert facts_of(spark, range(12), range(11), events(spark)).count() == 0


@pytest.mark.parametrize("people, ids", [(13, (42,)), (12, ()), (12, (41,)), (11, (42,))])
def test_wrong_roster_or_no_event(spark, people, ids):
    assert facts_of(spark, range(people), range(people), events(spark, ids)).count() == 0


def test_roster_size_is_a_parameter(spark):
    looked = joins.player_lookup(participants(spark, range(4)), players(spark, range(4)))
    assert joins.roster_join(looked, events(spark), 4).count() == 4
    assert joins.roster_join(looked, events(spark), 5).count() == 0


# 8-11, 23, 24: arrival against final


def arriving(df, at, offset=0):
    return df.withColumns({"arrival_ts": F.lit(ms(at)), "offset": F.lit(offset).cast("bigint")})


class Log:
    """A small arrival log: players, participants, events and ranks with their arrivals."""

    def __init__(self, spark, people=range(12), at=None, player_at=0, event_at=(100,)):
        at = at or {}
        self.spark = spark
        self.players = arriving(players(spark, people), player_at)
        arrivals = [(100 + i, ms(at.get(i, 50))) for i in people]
        self.participants = participants(spark, people).join(
            spark.createDataFrame(arrivals, "id bigint, arrival_ts timestamp"), "id"
        ).withColumn("offset", F.col("id"))
        self.events = None
        for n, when in enumerate(event_at):
            one = arriving(events(spark, name=f"map{n}"), when, n)
            self.events = one if self.events is None else self.events.unionByName(one)
        self.ranks = ranks(spark).withColumn("arrival_ts", F.lit(ms(0)))

    def replayed(self):
        return replay.arrival_replay(self.participants, self.players, self.events, self.ranks)

    def final(self):
        return ranked_facts(
            latest(self.players, ["id"], ["arrival_ts", "offset"]).drop("arrival_ts", "offset"),
            self.participants.drop("arrival_ts", "offset"),
            latest(self.events, ["id"], ["arrival_ts", "offset"]).drop("arrival_ts", "offset"),
            self.ranks,
            "seq",
        )


def test_dense_arrivals_give_the_final_result(spark):
    log = Log(spark)
    replayed = log.replayed().select("id", "account_name", "map_name", *RANK)
    assert sorted(replayed.collect()) == sorted(log.final().select(*replayed.columns).collect())
    assert replayed.count() == 12


def test_player_after_participant(spark):
    log = Log(spark, player_at=60)
    assert (log.replayed().count(), log.final().count()) == (0, 12)


def test_player_at_the_same_instant(spark):
    assert Log(spark, player_at=50).replayed().count() == 12


@pytest.mark.parametrize("gap, expected", [(3500, 0), (3001, 0), (3000, 12)])
def test_two_halves(spark, gap, expected):
    log = Log(spark, at={i: 50 + gap for i in range(6)}, event_at=(50,))
    assert (log.replayed().count(), log.final().count()) == (expected, 12)


def test_last_event_version_of_the_session(spark):
    log = Log(spark, event_at=(100, 200))
    assert {r.map_name for r in log.replayed().collect()} == {"map1"}


def test_renamed_player(spark):
    log = Log(spark)
    log.players = log.players.unionByName(
        arriving(players(spark, range(12), "renamed{}"), 9000, 1)
    )
    assert {r.account_name[:1] for r in log.replayed().collect()} == {"p"}
    assert {r.account_name[:7] for r in log.final().collect()} == {"renamed"}


@pytest.mark.parametrize("turned", [False, True])
def test_one_millisecond_is_ordered_by_offset(spark, turned):
    """Two versions of a player and of an event arrive at once, in any order of rows."""
    log = Log(spark)
    names = [arriving(players(spark, range(12), x), 0, n) for n, x in enumerate(("old{}", "new{}"))]
    maps = [arriving(events(spark, name=x), 100, n) for n, x in enumerate(("old", "new"))]
    for versions in (names, maps):
        if turned:
            versions.reverse()
    log.players, log.events = (a.unionByName(b).coalesce(1) for a, b in (names, maps))
    rows = log.replayed().collect()
    assert {r.account_name[:3] for r in rows} == {r.map_name for r in rows} == {"new"}
    assert {r.account_name[:3] for r in log.final().collect()} == {"new"}


def test_rank_after_the_fire_time(spark):
    log = Log(spark)
    rows = [(i, "gold", 2, 900, ms(-10), 1) for i in range(12)]
    early = [(i, "silver", 1, 700, ms(-20), 0) for i in range(6)]
    log.ranks = (
        ranks(spark, rows)
        .withColumn("arrival_ts", F.lit(ms(3101)))
        .unionByName(ranks(spark, early).withColumn("arrival_ts", F.lit(ms(0))))
    )
    tiers = sorted(r[RANK[0]] for r in log.replayed().collect())
    assert tiers == ["bronze"] * 6 + ["silver"] * 6
    assert {r[RANK[0]] for r in log.final().collect()} == {"gold"}


def test_rank_at_the_fire_time(spark):
    log = Log(spark)
    rows = [(i, "gold", 2, 900, ms(-10), 1) for i in range(12)]
    log.ranks = ranks(spark, rows).withColumn("arrival_ts", F.lit(ms(3100)))
    assert {r[RANK[0]] for r in log.replayed().collect()} == {"gold"}


def test_redelivered_participant(spark):
    log = Log(spark)
    again = log.participants.where("id = 100").withColumn("arrival_ts", F.lit(ms(20_000)))
    log.participants = log.participants.unionByName(again)
    assert (log.replayed().count(), log.final().count()) == (12, 0)


# 12-16: change records


def record(text, table="players", offset=0, at=0):
    return (cdc.topic(table), offset, ms(at), text)


def log_of(spark, *records):
    return spark.createDataFrame(list(records), cdc.LOG_SCHEMA)


PLAYER = (
    '{"payload":{"after":{"id":%s,"account_name":"x","email":"e",'
    '"created_at":"2026-01-15T12:00:00Z","account_status":"active"}}}'
)
EVENT = (
    '{"payload":{"after":{"id":%s,"map_name":%s,"match_duration_seconds":500,'
    '"started_at":"2026-01-15T12:00:00Z","ended_at":"2026-01-15T12:08:20Z",'
    '"winning_team":1}}}'
)
PART = (
    '{"payload":{"after":{"id":%s,"match_id":42,"player_id":%s,"team":0,'
    '"hero_played":"Loki"%s}}}'
)


def test_delete_is_ignored(spark):
    log = log_of(
        spark, record(PLAYER % 7), record('{"payload":{"after":null}}', offset=1), record(None)
    )
    assert [r.id for r in cdc.decode(log, "players").collect()] == [7]
    assert cdc.rejects(log, "players").count() == 0


@pytest.mark.parametrize("extra", ["", ',"kills":null,"result":null'])
def test_missing_and_null_numbers(spark, extra):
    log = log_of(spark, record(PART % (1, 2, extra), "match_participants"))
    row = cdc.decode(log, "match_participants").first()
    assert (row.kills, row.result, row.hero_played) == (None, None, "Loki")


def test_null_text(spark):
    log = log_of(spark, record(EVENT % (1, "null"), "match_events"))
    assert cdc.decode(log, "match_events").first().map_name is None
    assert cdc.decode(log, "match_events", null_text="literal").first().map_name == "null"


@pytest.mark.parametrize(
    "text, number", [("7", 7), ('"7"', 7), ("7.9", 7), ('"7.9"', 7), ("true", 1)]
)
def test_numbers_are_coerced(spark, text, number):
    assert cdc.decode(log_of(spark, record(PLAYER % text)), "players").first().id == number


def test_record_without_payload(spark):
    inner = (PLAYER % 7)[len('{"payload":') : -1]
    assert cdc.decode(log_of(spark, record(inner)), "players").first().id == 7


BAD = [
    '{"payload":{"after":{"id"',
    '{"payload":{"after":{"id":1}}}',
    "{}",
    PLAYER % '"seven"',
    (PLAYER % 8).replace('"active"', '"active","deleted_at":"garbage"'),
    (PLAYER % 8).replace("2026-01-15T12:00:00Z", "10:00"),
    (PLAYER % 8).replace("2026-01-15T12:00:00Z", "2026-01-15"),
    (PLAYER % 8).replace("2026-01-15T12:00:00Z", "2026-01-15T12:00:00"),
]


@pytest.mark.parametrize("text", BAD)
def test_bad_records(spark, text):
    log = log_of(spark, record(PLAYER % 7), record(text, offset=1))
    assert [r.id for r in cdc.decode(log, "players").collect()] == [7]
    assert [r.offset for r in cdc.rejects(log, "players").collect()] == [1]
    with pytest.raises(Exception, match="bad players record"):
        cdc.decode(log, "players", on_error="fail").collect()


@pytest.mark.parametrize("extra", [',"kills":"abc"', ',"healing":"1e999"', ',"deaths":[1]'])
def test_bad_values_of_nullable_fields(spark, extra):
    log = log_of(spark, record(PART % (1, 2, extra), "match_participants"))
    assert cdc.decode(log, "match_participants").count() == 0
    assert [r.reason for r in cdc.rejects(log, "match_participants").collect()] == ["bad_value"]
    with pytest.raises(Exception, match="bad match_participants record"):
        cdc.decode(log, "match_participants", on_error="fail").collect()


@pytest.mark.parametrize("zone", ["Z", "+00:00", ".123Z"])
def test_instants_have_a_zone(spark, zone):
    text = (PLAYER % 7).replace("00Z", f"00{zone}")
    created = cdc.decode(log_of(spark, record(text)), "players").first().created_at
    assert created.replace(microsecond=0) == T0


@pytest.mark.parametrize("first", [0, 2**20 - 1])
def test_rank_versions_of_one_millisecond_follow_their_offsets(spark, first):
    rank = (
        '{"payload":{"after":{"player_id":3,"rank_tier":"gold","rank_division":2,'
        '"rank_points":%s,"wins":1,"losses":0,"updated_at":"2026-01-15T12:00:00Z"}}}'
    )
    log = log_of(
        spark,
        *[record(PLAYER % i, offset=i) for i in range(12)],
        record(EVENT % (42, '"Klyntar"'), "match_events"),
        *[record(PART % (i, i, ""), "match_participants", offset=i) for i in range(12)],
        record(rank % 900, "ranks", first + 1),
        record(rank % 100, "ranks", first),
    )
    points = {r.player_id: r[RANK[2]] for r in facts_from_logs(log).collect()}
    assert points[3] == 900


def test_only_published_tables(spark):
    log = log_of(spark, record(PLAYER % 7), ("dbserver1.public.secrets", 0, T0, "x"))
    assert cdc.published(log).count() == 1
    with pytest.raises(ValueError):
        cdc.topic("secrets")


def test_kafka_needs_its_package(spark):
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        cdc.kafka_log(spark)


def test_facts_from_logs(spark):
    log = log_of(
        spark,
        *[record(PLAYER % i, offset=i) for i in range(12)],
        record(EVENT % (42, '"Klyntar"'), "match_events"),
        *[record(PART % (i, i, ""), "match_participants", offset=i) for i in range(12)],
        record(
            '{"payload":{"after":{"player_id":3,"rank_tier":"gold","rank_division":2,'
            '"rank_points":900,"wins":1,"losses":0,"updated_at":"2026-01-15T12:00:00Z"}}}',
            "ranks",
        ),
    )
    facts = facts_from_logs(log)
    assert facts.columns == FACT_COLUMNS
    tiers = {r.player_id: r[RANK[0]] for r in facts.collect()}
    assert len(tiers) == 12
    assert tiers[3] == "gold"
    assert tiers[4] == "bronze"
    again = log.unionByName(log_of(spark, record(PART % (0, 0, ""), "match_participants", 99, 9)))
    assert facts_from_logs(again).count() == 0
    assert facts_from_logs(again, dedup_participants=True).count() == 12


# 17-19: reports and ranks


def test_leaderboard_without_deaths(spark):
    facts = spark.createDataFrame(
        [("x", "win", 3, 0), ("x", "loss", 4, 0), ("y", None, 4, 2), ("y", "win", 1, 0)],
        "account_name string, result string, kills int, deaths int",
    )
    rows = {r.account_name: (r.wins, r.kd) for r in reports.player_leaderboard(facts).collect()}
    assert rows == {"x": (1, None), "y": (1, 2.0)}


def test_derive_rank(spark):
    df = spark.createDataFrame(
        [(p,) for p in (-15, 0, 99, 100, 399, 400, 1999, 2500)], "points int"
    )
    points = F.col("points")
    found = df.select(rank_tier(points), rank_division(points)).collect()
    assert [tuple(r) for r in found] == [
        ("bronze", 4),
        ("bronze", 4),
        ("bronze", 4),
        ("bronze", 3),
        ("bronze", 1),
        ("silver", 4),
        ("diamond", 1),
        ("diamond", 1),
    ]


def test_points_walk(spark):
    results = ["loss", "win", "loss", "loss", "loss", "win"]
    df = spark.createDataFrame(
        [(7, ms(i), i, r) for i, r in enumerate(results)],
        "player_id bigint, updated_at timestamp, seq bigint, result string",
    )
    rows = rank_history.points_history(df).orderBy("seq").collect()
    assert [r.rank_points for r in rows] == [0, 30, 15, 0, 0, 30]
    assert (rows[-1].wins, rows[-1].losses) == (2, 4)


# 20-22: metrics


def series(spark, values, step=15, name="m"):
    rows = [(name, {"a": "b"}, T0 + timedelta(seconds=step * i), v) for i, v in enumerate(values)]
    ddl = "name string, labels map<string,string>, ts timestamp, value double"
    return metrics.with_series(spark.createDataFrame(rows, ddl))


def test_increase_over_a_restart(spark):
    grown = metrics.increase(series(spark, [5.0, 9.0, 2.0, 4.0]), 60).orderBy("pos").collect()
    assert [r.increase for r in grown] == [None, 4.0, 6.0, 8.0]
    assert grown[-1].rate == 8.0 / 60


def test_increase_does_not_count_growth_from_before_the_window(spark):
    rows = [("m", {"a": "b"}, T0 + timedelta(seconds=s), v) for s, v in [(0, 0.0), (36_000, 50.0)]]
    ddl = "name string, labels map<string,string>, ts timestamp, value double"
    gap = metrics.with_series(spark.createDataFrame(rows, ddl))
    assert [r.increase for r in metrics.increase(gap, 900).orderBy("pos").collect()] == [None, None]
    assert metrics.increase(gap, 36_000).orderBy("pos").collect()[1].increase == 50.0


def at_instants(spark, rows, name="m"):
    """Samples of (label value, milliseconds, value)."""
    ddl = "name string, labels map<string,string>, ts timestamp, value double"
    full = [(name, {"a": a}, T0 + timedelta(milliseconds=t), float(v)) for a, t, v in rows]
    return metrics.with_series(spark.createDataFrame(full, ddl))


def test_grid_has_the_last_sample_within_the_lookback(spark):
    grid = metrics.on_grid(at_instants(spark, [("x", 1, 1), ("x", 15_000, 2), ("x", 700_001, 3)]))
    start = int(T0.timestamp())
    got = [(r.pos // metrics.SECOND - start, r.value) for r in grid.orderBy("pos").collect()]
    assert got[:2] == [(15, 2.0), (30, 2.0)]
    assert got[20:22] == [(315, 2.0), (705, 3.0)]
    assert len(got) == 21 + 20


def test_series_scraped_apart_add_up(spark):
    rows = [(a, 15_000 * i + off, 150) for i in range(8) for a, off in (("x", 0), ("y", 5000))]
    grid = metrics.on_grid(at_instants(spark, rows), lookback_seconds=14)
    sums = metrics.sum_by(grid, []).orderBy("pos").collect()
    assert [(r.value, r.series_count) for r in sums][1:] == [(300.0, 2)] * 7 + [(150.0, 1)]


def test_ratio_by_zero_is_infinite(spark):
    rows = [("x", 0, 5), ("y", 0, 0), ("z", 0, 6)]
    part = at_instants(spark, rows)
    whole = at_instants(spark, [("x", 0, 0), ("y", 0, 0), ("z", 0, 2)])
    got = {r.series[-4]: r.value for r in metrics.metric_ratio(part, whole).collect()}
    assert got == {"x": float("inf"), "y": None, "z": 3.0}


SLOT = "pg_debezium_slot_active"


@pytest.mark.parametrize("drift", [0, 7])
def test_page_is_not_lost_to_drifting_scrapes(spark, drift):
    samples = at_instants(spark, [("x", i * (15_000 + drift), 0) for i in range(20)], SLOT)
    rules = [r for r in alerts.RULES if r.name == SLOT]
    states = [r.state for r in alerts.evaluate(samples, rules).orderBy("ts").collect()]
    assert states[:4] == ["pending"] * 4
    assert states.count("firing") >= 16 and "inactive" not in states


def test_lag_of_another_group_does_not_page(spark):
    topic = cdc.topic("ranks")
    ddl = "name string, labels map<string,string>, ts timestamp, value double"
    rows = [
        (
            "kafka_consumergroup_lag",
            {"consumergroup": group, "topic": topic, "partition": "0"},
            T0 + timedelta(seconds=15 * i),
            float(i * step),
        )
        for i in range(60)
        for group, step in (("ours", 0), ("theirs", 1000))
    ]
    samples = spark.createDataFrame(rows, ddl)
    for group, fires in (("ours", False), ("theirs", True)):
        rules = [r for r in alerts.rules_of(group) if r.min_slope is not None]
        states = {r.state for r in alerts.evaluate(samples, rules).collect()}
        assert ("firing" in states) == fires


def test_ratio_of_nothing(spark):
    df = spark.createDataFrame([(0, 0), (1, 3)], "a int, b int")
    found = df.select(ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [r.r for r in found] == [0.0, 0.25]


@pytest.mark.parametrize("samples, state", [(5, "pending"), (6, "firing")])
def test_hold(spark, samples, state):
    held = metrics.hold(series(spark, [1.0] * samples, 60), F.col("value") > 0, 300)
    assert held.orderBy(F.desc("pos")).first().state == state


def test_hold_is_interrupted_by_a_gap(spark):
    gappy = series(spark, [1.0] * 12, 60).where("second(ts) = 0 and minute(ts) != 4")
    whole = metrics.hold(gappy, F.col("value") > 0, 300).orderBy("pos").collect()
    cut = metrics.hold(gappy, F.col("value") > 0, 300, max_gap_seconds=60)
    assert [r.state for r in whole].count("firing") == 7
    assert [r.state for r in cut.orderBy("pos").collect()].count("firing") == 2


def test_selectors_match_the_whole_text(spark):
    df = series(spark, [1.0], name="kafka_lag")
    assert metrics.select(df, name_like="kafka_.*").count() == 1
    assert metrics.select(df, name_like="kafka").count() == 0
    assert metrics.select(df, equal={"a": "b"}).count() == 1
    assert metrics.select(df, like={"a": "[bc]", "missing": ""}).count() == 1


@pytest.mark.parametrize(
    "pattern, prefix",
    [("kafka_.*", "kafka_"), ("kafka_lags?", "kafka_lag"), ("a|b", ""), (".*x", ""), ("up", "up")],
)
def test_prefix_of_a_pattern(pattern, prefix):
    assert metrics._prefix(pattern) == prefix


def test_scan_skips_other_metrics(spark, tmp_path):
    series(spark, [1.0, 2.0], name="kafka_lag").write.parquet(str(tmp_path / "samples"))
    stored = spark.read.parquet(str(tmp_path / "samples"))
    plan = metrics.select(stored, name="up")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(name,up)" in plan
    plan = metrics.select(stored, name_like="kafka_.*")._jdf.queryExecution().executedPlan()
    assert "StringStartsWith(name,kafka_)" in plan.toString()


def test_or_zero(spark):
    empty = series(spark, [1.0]).where("false")
    assert metrics.or_zero(empty).first().value == 0.0
