"""What the in-flight join computes, given when every record arrived.

All clocks are bigint milliseconds. Nothing here looks at the wall clock, so a replay of
one log always gives one result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions.ranks import ROSTER_SIZE
from matchlake.functions.time import epoch_ms, floor_div, from_ms
from matchlake.operators.asof import RANK_COLUMNS, with_rank, as_of
from matchlake.operators.skew import (
    NO_HOT_KEYS,
    HotKeys,
    Scan,
    find_hot_keys,
    running,
    spread_join,
)
from matchlake.session import pinned

QUIET_MS = 3000
SCRAPE_MS = 15_000
DAY_MS = 86_400_000
MAX_LEVEL = 40


def lookup_on_arrival(
    participants: DataFrame, player_log: DataFrame, hot: HotKeys = NO_HOT_KEYS
) -> DataFrame:
    """Each participant with the player version that had arrived by then, if any.

    Versions of one player and millisecond count in the order of their ``offset``.
    """
    versions = player_log.select(
        F.col("id").alias("player_id"),
        epoch_ms(F.col("arrival_ts")).alias("_pos"),
        F.col("offset").cast("bigint").alias("_version"),
        F.struct("account_name").alias("_player"),
    )
    rows = participants.withColumn("_pos", epoch_ms(F.col("arrival_ts")))
    seen = as_of(rows, versions, ["player_id"], "_player", "id", hot)
    return (
        seen.where(F.col("_player").isNotNull())
        .withColumn("account_name", F.col("_player.account_name"))
        .drop("_player")
    )


def match_arrivals(
    participants: DataFrame,
    event_log: DataFrame,
    quiet_ms: int = QUIET_MS,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Both inputs of the roster buffer, with the session each record falls into.

    A session ends once nothing arrives for its match for ``quiet_ms``; ``session_start``
    is its first arrival. Records are ``participant`` or ``event`` structs; both logs carry
    ``arrival_ts`` and ``offset``.
    """
    event_fields = [c for c in event_log.columns if c != "arrival_ts"]
    merged = participants.select(
        "match_id",
        epoch_ms(F.col("arrival_ts")).alias("arrival_ms"),
        F.col("id").alias("_tie"),
        F.struct(*participants.columns).alias("participant"),
    ).unionByName(
        event_log.select(
            F.col("id").alias("match_id"),
            epoch_ms(F.col("arrival_ts")).alias("arrival_ms"),
            F.lit(-1).cast("bigint").alias("_tie"),
            F.struct(*event_fields).alias("event"),
        ),
        allowMissingColumns=True,
    )
    opens = F.when(
        F.col("_before").isNull() | (F.col("arrival_ms") - F.col("_before") > quiet_ms),
        F.col("arrival_ms"),
    )
    scans = [
        {"_before": Scan("lag", F.col("arrival_ms"))},
        {"session_start": Scan("last", opens)},
    ]
    return running(merged, ["match_id"], "arrival_ms", "_tie", scans, hot).drop(
        "_before", "_tie"
    )


_SESSION = ["match_id", "session_start"]


def _session_values() -> dict[str, Column]:
    is_event = F.col("event").isNotNull()
    return {
        "participants": F.count("participant"),
        "events": F.count("event"),
        "last_ms": F.max("arrival_ms"),
        "last_event": F.max_by(
            F.col("event"), F.when(is_event, F.struct("arrival_ms", "event.offset"))
        ),
    }


def quiet_sessions(
    arrivals: DataFrame, quiet_ms: int = QUIET_MS, roster_size: int = ROSTER_SIZE
) -> DataFrame:
    """One row per session: what it held when its timer fired, and whether it emits."""
    values = _session_values()
    return (
        arrivals.groupBy(*_SESSION)
        .agg(*[v.alias(n) for n, v in values.items() if n != "last_event"])
        .withColumn("fire_ms", F.col("last_ms") + quiet_ms)
        .withColumn("complete", _emits(roster_size))
        .drop("last_ms")
    )


def _emits(roster_size: int) -> Column:
    return (F.col("participants") == roster_size) & (F.col("events") > 0)


def emitted(
    arrivals: DataFrame,
    quiet_ms: int = QUIET_MS,
    roster_size: int = ROSTER_SIZE,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Participants of the emitting sessions with their session's last event."""
    hot.check(["match_id"])
    values = _session_values()
    complete = _emits(roster_size)
    per_session = Window.partitionBy(*_SESSION)
    whole = (
        arrivals.where(~hot.is_hot())
        .withColumns({n: v.over(per_session) for n, v in values.items()})
        .where(complete & F.col("participant").isNotNull())
    )
    if hot:
        crowded = pinned(arrivals.where(hot.is_hot()))
        sessions = (
            crowded.groupBy(*_SESSION)
            .agg(*[v.alias(n) for n, v in values.items()])
            .where(complete)
        )
        crowded_sessions = find_hot_keys(crowded, _SESSION, hot.rows_per_task)
        whole = whole.unionByName(
            spread_join(
                crowded.where(F.col("participant").isNotNull()),
                sessions,
                _SESSION,
                ["arrival_ms", "participant"],
                crowded_sessions,
            )
        )
    fire = (F.col("last_ms") + quiet_ms).alias("fire_ms")
    return whole.select("participant.*", "last_event", fire).select(
        "id",
        "match_id",
        *[
            F.col(f"last_event.{c}").alias(c)
            for c in (
                "map_name",
                "match_duration_seconds",
                "started_at",
                "ended_at",
                "winning_team",
            )
        ],
        "player_id",
        "account_name",
        "team",
        "hero_played",
        "kills",
        "deaths",
        "healing",
        "result",
        "fire_ms",
    )


def rank_on_two_clocks(
    facts: DataFrame, rank_log: DataFrame, hot: HotKeys = NO_HOT_KEYS
) -> DataFrame:
    """The latest rank version before the match start among those arrived by ``fire_ms``.

    Most facts find that their version by start time had arrived in time. For the others
    every player's versions, numbered by arrival, form blocks of 1, 2, 4, ... versions; the
    versions arrived in time are a handful of whole blocks, and an as-of join inside each
    gives the candidates. Work grows with versions times the logarithm of a history, never
    with pairs.
    """
    versions = rank_log.select(
        "player_id",
        epoch_ms(F.col("updated_at")).alias("_pos"),
        epoch_ms(F.col("arrival_ts")).alias("_arrival"),
        "seq",
        F.struct(*RANK_COLUMNS).alias("_rank"),
    )
    numbered = running(
        versions.withColumn("_one", F.lit(1)),
        ["player_id"],
        "_arrival",
        "seq",
        {"_nth": Scan("sum", F.col("_one")), "_all": Scan("total", F.col("_one"))},
        hot,
    ).withColumn("_nth", F.col("_nth") - 1)
    if hot:  # the split plans below would each compute it again
        numbered = pinned(numbered)
    candidate = F.struct(
        F.col("_pos").alias("pos"), F.col("_nth").alias("nth"), "_arrival", "_rank"
    )
    by_start = numbered.select(
        "player_id", "_pos", F.col("_nth").alias("_version"), candidate.alias("_pick")
    )
    started = facts.withColumn("_pos", epoch_ms(F.col("started_at")))
    tried = as_of(started, by_start, ["player_id"], "_pick", "id", hot)
    if hot:
        tried = pinned(tried)
    late = F.col("_pick._arrival") > F.col("fire_ms")
    in_time = tried.where(F.col("_pick").isNull() | ~late).select(
        *facts.columns, F.col("_pick._rank").alias("_rank")
    )

    by_arrival = numbered.select(
        "player_id",
        F.col("_arrival").alias("_pos"),
        F.col("_nth").alias("_version"),
        F.struct((F.col("_nth") + 1).alias("n")).alias("_arrived"),
    )
    waiting = tried.where(late).select(*facts.columns, F.col("fire_ms").alias("_pos"))
    counted = as_of(waiting, by_arrival, ["player_id"], "_arrived", "id", hot)
    levels = F.sequence(F.lit(0), F.lit(MAX_LEVEL))
    n = F.coalesce(F.col("_arrived.n"), F.lit(0))
    asked = counted.withColumn(
        "_level",
        F.explode_outer(F.filter(levels, lambda b: _bit(n, b) == 1)),
    ).select(
        *facts.columns,
        "_level",
        (_shift_right(n, F.col("_level") + 1) * 2).alias("_block"),
        epoch_ms(F.col("started_at")).alias("_pos"),
    )
    nth, total = F.col("_nth"), F.col("_all")
    whole_even = F.filter(
        F.sequence(F.lit(0), F.lit(MAX_LEVEL)),
        lambda b: (_bit(nth, b) == 0)
        & (_shift_left(_shift_right(nth, b) + 1, b) <= total),
    )
    blocks = numbered.withColumn("_level", F.explode(whole_even)).select(
        "player_id",
        "_level",
        _shift_right(nth, F.col("_level")).alias("_block"),
        "_pos",
        nth.alias("_version"),
        candidate.alias("_pick"),
    )
    keys = ["player_id", "_level", "_block"]
    block_hot = find_hot_keys(blocks, keys, hot.rows_per_task) if hot else NO_HOT_KEYS
    answered = as_of(asked, blocks, keys, "_pick", "id", block_hot)
    rest = [c for c in facts.columns if c != "id"]
    late_facts = (
        answered.groupBy("id")
        .agg(F.any_value(F.struct(*rest)).alias("_fact"), F.max("_pick").alias("_best"))
        .select("id", "_fact.*", F.col("_best._rank").alias("_rank"))
        .select(*facts.columns, "_rank")
    )
    return with_rank(in_time.unionByName(late_facts), None)


def _shift_right(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value.cast("bigint"), bits)


def _shift_left(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits)


def _bit(value: Column, position: Column) -> Column:
    return _shift_right(value, position) % 2


def arrival_replay(
    participants: DataFrame,
    player_log: DataFrame,
    event_log: DataFrame,
    rank_log: DataFrame,
    quiet_ms: int = QUIET_MS,
    roster_size: int = ROSTER_SIZE,
    hot_players: HotKeys = NO_HOT_KEYS,
    hot_matches: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """The facts the stream emits for this log, with the participant ``id``."""
    looked = lookup_on_arrival(participants, player_log, hot_players)
    arrivals = match_arrivals(looked, event_log, quiet_ms, hot_matches)
    facts = emitted(arrivals, quiet_ms, roster_size, hot_matches)
    return rank_on_two_clocks(facts, rank_log, hot_players)


def buffered_at_scrapes(
    arrivals: DataFrame, quiet_ms: int = QUIET_MS, every_ms: int = SCRAPE_MS
) -> DataFrame:
    """How many participants sat in open sessions, at each scrape where that changed."""
    sessions = quiet_sessions(arrivals, quiet_ms)
    came = arrivals.where(F.col("participant").isNotNull()).select(
        F.col("arrival_ms").alias("at"), F.lit(1).cast("bigint").alias("change")
    )
    left = sessions.select(
        F.col("fire_ms").alias("at"), (-F.col("participants")).alias("change")
    )
    changes = (
        came.unionByName(left)
        .groupBy((-floor_div(-F.col("at"), every_ms)).alias("scrape"))
        .agg(F.sum("change").alias("change"))
        .withColumn("day", floor_div(F.col("scrape") * every_ms, DAY_MS))
    )
    # Summed inside each day, then over the days: the only window without a key sees one
    # row per calendar day.
    inside = Window.partitionBy("day").orderBy("scrape")
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = changes.groupBy("day").agg(F.sum("change").alias("total"))
    opening = days.select("day", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("open"))
    return (
        changes.withColumn("inside", F.sum("change").over(inside))
        .join(opening, "day")
        .select(
            from_ms(F.col("scrape") * every_ms).alias("scraped_at"),
            (F.col("open") + F.col("inside")).alias("buffered_participants"),
        )
    )
