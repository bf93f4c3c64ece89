"""Table schemas, as Spark DDL."""

from __future__ import annotations

from pyspark.sql import types as T

# Table names, column names and column types of the data model.
PLAYERS = (
    "id bigint, account_name string, email string, created_at timestamp, "
    "account_status string, deleted_at timestamp"
)
RANKS = (
    "player_id bigint, rank_tier string, rank_division int, rank_points int, "
    "wins int, losses int, updated_at timestamp"
)
MATCH_EVENTS = (
    "id bigint, map_name string, match_duration_seconds int, started_at timestamp, "
    "ended_at timestamp, winning_team int"
)
MATCH_PARTICIPANTS = (
    "id bigint, match_id bigint, player_id bigint, team int, hero_played string, "
    "kills int, deaths int, healing int, result string"
)
MATCH_FACTS = (
    "match_id bigint, map_name string, match_duration_seconds int, "
    "started_at timestamp_ntz, ended_at timestamp_ntz, winning_team int, "
    "player_id bigint, account_name string, team int, hero_played string, "
    "kills int, deaths int, healing int, result string, "
    "rank_tier_at_match_start string, rank_division_at_match_start int, "
    "rank_points_at_match_start int, ingested_at timestamp_ntz"
)
METRIC_SAMPLES = "name string, labels map<string,string>, ts timestamp, value double"

TABLES = {
    "players": PLAYERS,
    "ranks": RANKS,
    "match_events": MATCH_EVENTS,
    "match_participants": MATCH_PARTICIPANTS,
}

# Columns a change record may leave out or set to null; all others are required.
NULLABLE = {
    "players": {"deleted_at"},
    "ranks": set(),
    "match_events": {"map_name"},
    "match_participants": {"kills", "deaths", "healing", "result"},
}

# Key of the current row of each table.
KEYS = {
    "players": "id",
    "ranks": "player_id",
    "match_events": "id",
    "match_participants": "id",
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def columns(ddl: str) -> list[str]:
    """Column names of a flat schema; needs no session, unlike ``struct``."""
    return [part.split()[0] for part in ddl.split(",")]


FACT_COLUMNS = columns(MATCH_FACTS)
