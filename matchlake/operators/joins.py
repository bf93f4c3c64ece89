"""Player lookup and the roster gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions.ranks import ROSTER_SIZE
from matchlake.functions.time import wall_clock
from matchlake.operators.skew import NO_HOT_KEYS, HotKeys, spread_join
from matchlake.schemas import FACT_COLUMNS


def _names(players: DataFrame) -> DataFrame:
    return players.select(F.col("id").alias("player_id"), "account_name")


def player_lookup(
    participants: DataFrame, players: DataFrame, hot: HotKeys = NO_HOT_KEYS
) -> DataFrame:
    """Participants with their account name; unknown players are dropped.

    ``players`` holds one row per id. ``hot`` are the hot ``player_id`` values.
    """
    return spread_join(participants, _names(players), ["player_id"], ["id"], hot)


def lookup_misses(
    participants: DataFrame, players: DataFrame, hot: HotKeys = NO_HOT_KEYS
) -> DataFrame:
    """The participants ``player_lookup`` drops."""
    known = _names(players).select("player_id")
    return spread_join(participants, known, ["player_id"], ["id"], hot, "left_anti")


def complete_rosters(
    looked: DataFrame, roster_size: int = ROSTER_SIZE, hot: HotKeys = NO_HOT_KEYS
) -> DataFrame:
    """Participants of matches with exactly ``roster_size`` of them.

    The count is a window over ``match_id``, so the rows shuffle once and stay where the
    event join needs them. A hot match is counted with map-side partial counts instead,
    and only if it is exactly full do its few rows go on.
    """
    hot.check(["match_id"])
    per_match = Window.partitionBy("match_id")
    full = (
        looked.where(~hot.is_hot())
        .withColumn("_n", F.count(F.lit(1)).over(per_match))
        .where(F.col("_n") == roster_size)
        .drop("_n")
    )
    if not hot:
        return full
    crowded = looked.where(hot.is_hot())
    exact = (
        crowded.groupBy("match_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") == roster_size)
        .select("match_id")
    )
    return full.unionByName(crowded.join(F.broadcast(exact), "match_id"))


def roster_join(
    looked: DataFrame,
    events: DataFrame,
    roster_size: int = ROSTER_SIZE,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """All participants of a match with its event, or nothing for that match.

    ``events`` holds one row per id; ``hot`` are the hot ``match_id`` values.
    """
    rosters = complete_rosters(looked, roster_size, hot)
    matches = events.withColumnRenamed("id", "match_id")
    return rosters.join(matches, "match_id").select(
        "id",
        "match_id",
        "map_name",
        "match_duration_seconds",
        "started_at",
        "ended_at",
        "winning_team",
        "player_id",
        "account_name",
        "team",
        "hero_played",
        "kills",
        "deaths",
        "healing",
        "result",
    )


def fact_rows(ranked: DataFrame) -> DataFrame:
    """The table layout: 18 columns in order, UTC wall clocks, stamped on emission."""
    return ranked.withColumns(
        {
            "started_at": wall_clock(F.col("started_at")),
            "ended_at": wall_clock(F.col("ended_at")),
            "ingested_at": wall_clock(F.current_timestamp()),
        }
    ).select(*FACT_COLUMNS)
