"""The fact table from its four source tables, or from their change logs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from matchlake.functions.ranks import ROSTER_SIZE
from matchlake.operators import asof
from matchlake.operators.asof import rank_as_of
from matchlake.operators.joins import fact_rows, player_lookup, roster_join
from matchlake.operators.skew import (
    NO_HOT_KEYS,
    ROWS_PER_TASK,
    HotKeys,
    find_all_hot_keys,
)
from matchlake.operators.versions import latest
from matchlake.sources.cdc import decode, of_table
from matchlake.sources.testdata import Inputs

_ARRIVAL = ["arrival_ts", "offset"]


def ranked_facts(
    players: DataFrame,
    participants: DataFrame,
    events: DataFrame,
    ranks: DataFrame,
    rank_order: str | None = None,
    mark: str | None = None,
    roster_size: int = ROSTER_SIZE,
    hot_players: HotKeys = NO_HOT_KEYS,
    hot_matches: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Facts with the participant ``id``, before the table layout is applied."""
    looked = player_lookup(participants, players, hot_players)
    rosters = roster_join(looked, events, roster_size, hot_matches)
    return rank_as_of(rosters, ranks, rank_order, mark, "id", hot_players)


def facts_of(inputs: Inputs, mark: str | None = None) -> DataFrame:
    return ranked_facts(
        inputs.players,
        inputs.match_participants,
        inputs.match_events,
        inputs.ranks,
        "seq",
        mark,
        hot_players=inputs.hot_players,
        hot_matches=inputs.hot_matches,
    )


def facts_from_logs(
    logs: Mapping[str, DataFrame] | DataFrame,
    on_error: str = "quarantine",
    null_text: str = "null",
    dedup_participants: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The fact table once everything in the log has arrived.

    Players and match events are upserts, ranks a version history; participants are a
    bag unless ``dedup_participants`` keeps the last record per id. The participants are
    read once beforehand to find players and matches too large for ``rows_per_task``.
    """

    def rows(table: str) -> DataFrame:
        log = logs if isinstance(logs, DataFrame) else logs[table]
        return decode(of_table(log, table), table, on_error, null_text, keep=_ARRIVAL)

    participants = rows("match_participants")
    if dedup_participants:
        participants = latest(participants, ["id"], _ARRIVAL)
    keys = [["player_id"], ["match_id"]]
    hot_players, hot_matches = find_all_hot_keys(participants, keys, rows_per_task)
    ranks = asof.history(rows("ranks"), _ARRIVAL).drop(*_ARRIVAL)
    return fact_rows(
        ranked_facts(
            latest(rows("players"), ["id"], _ARRIVAL).drop(*_ARRIVAL),
            participants.drop(*_ARRIVAL),
            latest(rows("match_events"), ["id"], _ARRIVAL).drop(*_ARRIVAL),
            ranks,
            hot_players=hot_players,
            hot_matches=hot_matches,
        )
    )
