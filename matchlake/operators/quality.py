"""Match rules, table constraints and join-quality counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions.ranks import (
    MAX_DURATION_SECONDS,
    MIN_DURATION_SECONDS,
    ROSTER_SIZE,
    TEAM_SIZE,
    ratio,
)

# The constraints of the source tables.
PRIMARY_KEYS = {
    "players": "id",
    "ranks": "player_id",
    "match_events": "id",
    "match_participants": "id",
}
UNIQUE = {"players": ["email"]}
NOT_NULL = {
    "players": ["id", "account_name", "email", "created_at", "account_status"],
    "ranks": [
        "player_id",
        "rank_tier",
        "rank_division",
        "rank_points",
        "wins",
        "losses",
        "updated_at",
    ],
    "match_events": [
        "id",
        "match_duration_seconds",
        "started_at",
        "ended_at",
        "winning_team",
    ],
    "match_participants": ["id", "match_id", "player_id", "team", "hero_played"],
}
FOREIGN_KEYS = [
    ("ranks", "player_id", "players"),
    ("match_participants", "match_id", "match_events"),
    ("match_participants", "player_id", "players"),
]


def _rows(part: str = "n"):
    return F.count(F.lit(1)).alias(part)


# --- match rules -------------------------------------------------------------


def match_quality(participants: DataFrame, events: DataFrame) -> DataFrame:
    """Violations per match: roster, teams, results, end time, duration."""
    won, lost = F.col("result") == "win", F.col("result") == "loss"
    right = {
        team: F.count_if((F.col("team") == team) & won).alias(f"won_{team}")
        for team in (0, 1)
    }
    rosters = participants.groupBy("match_id").agg(
        _rows("players"),
        F.count_if(F.col("team") == 0).alias("team_0"),
        F.count_if(F.col("team") == 1).alias("team_1"),
        *right.values(),
        *[
            F.count_if((F.col("team") == team) & lost).alias(f"lost_{team}")
            for team in (0, 1)
        ],
    )
    matches = events.withColumnRenamed("id", "match_id")
    fair = F.when(
        F.col("winning_team") == 0, F.col("won_0") + F.col("lost_1")
    ).otherwise(F.col("won_1") + F.col("lost_0"))
    length = F.unix_seconds("ended_at") - F.unix_seconds("started_at")
    duration = F.col("match_duration_seconds")
    players = F.coalesce("players", F.lit(0))

    def flag(broken):
        return F.when(broken, 1).otherwise(0)

    return matches.join(rosters, "match_id", "left").select(
        "match_id",
        flag(players != ROSTER_SIZE).alias("roster"),
        flag(
            (F.coalesce("team_0", F.lit(0)) != TEAM_SIZE)
            | (F.coalesce("team_1", F.lit(0)) != TEAM_SIZE)
        ).alias("teams"),
        (players - F.coalesce(fair, F.lit(0))).alias("results"),
        flag(length != duration).alias("end_time"),
        flag(~duration.between(MIN_DURATION_SECONDS, MAX_DURATION_SECONDS)).alias("duration"),
    )


# --- constraints -------------------------------------------------------------


def _duplicates(df: DataFrame, column: str) -> DataFrame:
    """How many values of ``column`` occur more than once."""
    return df.groupBy(column).agg(_rows()).agg(
        F.count_if(F.col("n") > 1).alias("violations")
    )


def _missing_keys(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Referenced values without a parent row; counted first, so repeats cost nothing."""
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key"))
    known = parent.select(F.col(key).alias("key"))
    return used.agg(_rows("violations")).join(known, "key", "left_anti")


def fk_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Each missing key with the number of rows that refer to it."""
    parts = [
        _missing_keys(tables[child], column, tables[parent], PRIMARY_KEYS[parent]).select(
            F.lit(child).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.col("key").alias("missing_key"),
            "violations",
        )
        for child, column, parent in FOREIGN_KEYS
    ]
    return reduce(DataFrame.unionByName, parts)


def constraint_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared constraint with the number of violations."""
    parts: list[DataFrame] = []

    def add(table: str, rule: str, counted: DataFrame) -> None:
        parts.append(
            counted.select(
                F.lit(table).alias("table_name"),
                F.lit(rule).alias("rule"),
                F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"),
            )
        )

    for table, df in tables.items():
        key = PRIMARY_KEYS[table]
        add(table, f"primary key {key}", _duplicates(df, key))
        for column in UNIQUE.get(table, []):
            add(table, f"unique {column}", _duplicates(df, column))
        parts.append(_null_counts(df, table, NOT_NULL[table]))
    for child, column, parent in FOREIGN_KEYS:
        missing = _missing_keys(tables[child], column, tables[parent], PRIMARY_KEYS[parent])
        add(
            child,
            f"foreign key {column} to {parent}",
            missing.agg(F.sum("violations").alias("violations")),
        )
    return reduce(DataFrame.unionByName, parts)


def _null_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rules = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(f"not null {c}").alias("rule"),
                F.col(c).alias("violations"),
            )
            for c in columns
        ]
    )
    return counts.select(F.inline(rules))


# --- join quality ------------------------------------------------------------


def lookup_quality(participants: DataFrame, players: DataFrame) -> DataFrame:
    """Hits and misses of the player lookup; counted per player before the join."""
    per_player = participants.groupBy("player_id").agg(_rows())
    known = players.select(F.col("id").alias("player_id"), F.lit(True).alias("known"))
    n = F.col("n")
    return per_player.join(known, "player_id", "left").agg(
        F.coalesce(F.sum(F.when(F.col("known"), n)), F.lit(0)).alias("player_lookup_hits"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), n)), F.lit(0)).alias(
            "player_lookup_misses"
        ),
    )


def roster_quality(
    looked: DataFrame, events: DataFrame, roster_size: int = ROSTER_SIZE
) -> DataFrame:
    """Complete and incomplete matches, once every record has arrived.

    The final view has one roster per match; ``session_quality`` counts what fired.
    """
    rosters = looked.groupBy("match_id").agg(_rows())
    matches = events.select(F.col("id").alias("match_id"), F.lit(True).alias("event"))
    full = F.col("event") & (F.col("n") == roster_size)
    return rosters.join(matches, "match_id", "full").agg(
        F.count_if(full).alias("complete"),
        F.count_if(~F.coalesce(full, F.lit(False))).alias("incomplete"),
    )


def session_quality(sessions: DataFrame) -> DataFrame:
    """Complete and incomplete sessions: a match that fires twice counts twice."""
    return sessions.agg(
        F.count_if("complete").alias("complete"), F.count_if(~F.col("complete")).alias("incomplete")
    )


def rank_quality(ranked: DataFrame, mark: str) -> DataFrame:
    """Facts whose rank was found, and facts that got the default."""
    return ranked.agg(
        F.count_if(F.col(mark)).alias("rank_as_of_found"),
        F.count_if(~F.col(mark)).alias("rank_as_of_defaulted"),
    )


def lookup_miss_rate(counts: DataFrame) -> DataFrame:
    return counts.select(
        ratio(F.col("player_lookup_misses"), F.col("player_lookup_hits")).alias("miss_rate")
    )


def rank_default_rate(counts: DataFrame) -> DataFrame:
    return counts.select(
        ratio(F.col("rank_as_of_defaulted"), F.col("rank_as_of_found")).alias("default_rate")
    )
