"""Backward as-of join: the last version at or before each row's own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions.ranks import DEFAULT_DIVISION, DEFAULT_POINTS, DEFAULT_TIER
from matchlake.functions.search import count_before
from matchlake.functions.time import epoch_ms
from matchlake.operators.skew import NO_HOT_KEYS, HotKeys, Scan, running

# Largest version history worth sending to every executor, in all and per player.
MAX_BROADCAST_VERSIONS = 1_000_000
MAX_PLAYER_VERSIONS = 1_000

RANK_COLUMNS = ["rank_tier", "rank_division", "rank_points"]
FACT_RANKS = {
    "rank_tier": ("rank_tier_at_match_start", DEFAULT_TIER),
    "rank_division": ("rank_division_at_match_start", DEFAULT_DIVISION),
    "rank_points": ("rank_points_at_match_start", DEFAULT_POINTS),
}


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    picked: str,
    spread_by: str | None = None,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Add to each row the struct ``picked`` of its latest version, or null.

    Both sides carry a bigint ``_pos``; versions also carry ``_version`` (>= 0), which
    decides between versions of one position, and the struct ``picked``. A version at
    the very position of a row is used. One shuffle and one sort, whatever the number
    of versions: both sides are merged and the last version is carried forward.
    """
    kept = [c for c in rows.columns if c not in (*keys, "_pos")]
    tie = F.lit(0) if spread_by is None else F.pmod(F.xxhash64(spread_by), F.lit(2**62))
    # The row travels as one struct, so that a version does not carry a null per column.
    merged = rows.select(
        *keys,
        "_pos",
        tie.cast("bigint").alias("_tie"),
        F.struct(*kept).alias("_row"),
        F.lit(None).cast(versions.schema[picked].dataType).alias("_seen"),
    ).unionByName(
        versions.select(
            *keys,
            "_pos",
            (F.col("_version").cast("bigint") - F.lit(2**62)).alias("_tie"),
            F.col(picked).alias("_seen"),
        ),
        allowMissingColumns=True,
    )
    scanned = running(
        merged, keys, "_pos", "_tie", {picked: Scan("last", F.col("_seen"))}, hot
    )
    return scanned.where(F.col("_row").isNotNull()).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}") for c in rows.columns if c != "_pos"],
        picked,
    )


def _versions(ranks: DataFrame, order: str | None) -> DataFrame:
    return ranks.select(
        "player_id",
        epoch_ms(F.col("updated_at")).alias("_pos"),
        (F.lit(0) if order is None else F.col(order)).cast("bigint").alias("_version"),
        F.struct(*RANK_COLUMNS).alias("_rank"),
    )


def with_rank(found: DataFrame, mark: str | None) -> DataFrame:
    """Spread the picked struct over the fact columns; defaults only where none matched."""
    hit = F.col("_rank").isNotNull()
    ranks = {
        out: F.when(hit, F.col(f"_rank.{col}")).otherwise(F.lit(default))
        for col, (out, default) in FACT_RANKS.items()
    }
    marked = {mark: hit} if mark else {}
    return found.withColumns(ranks | marked).drop("_rank")


def rank_as_of(
    facts: DataFrame,
    ranks: DataFrame,
    order: str | None = None,
    mark: str | None = None,
    spread_by: str | None = None,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Each fact with its player's rank when the match started.

    ``order`` names the rank column that decides between versions of one millisecond,
    ``mark`` an output column telling found from defaulted.
    """
    rows = facts.withColumn("_pos", epoch_ms(F.col("started_at")))
    found = as_of(rows, _versions(ranks, order), ["player_id"], "_rank", spread_by, hot)
    return with_rank(found, mark)


def rank_as_of_broadcast(
    facts: DataFrame,
    ranks: DataFrame,
    order: str | None = None,
    mark: str | None = None,
    spread_by: str | None = None,
    hot: HotKeys = NO_HOT_KEYS,
    max_versions: int = MAX_BROADCAST_VERSIONS,
    max_per_player: int = MAX_PLAYER_VERSIONS,
) -> DataFrame:
    """``rank_as_of`` without shuffling the facts, for a small rank history.

    The history is counted first; above ``max_versions`` in all or ``max_per_player``
    for one player the shuffled form runs. Each fact finds its version by binary search
    in its player's sorted history, so no pairs are produced.
    """
    versions = _versions(ranks, order)
    per_player = versions.groupBy("player_id").agg(F.count(F.lit(1)).alias("n"))
    size = per_player.agg(F.sum("n").alias("all"), F.max("n").alias("longest")).first()
    longest = size["longest"] or 0
    if (size["all"] or 0) > max_versions or longest > max_per_player:
        return rank_as_of(facts, ranks, order, mark, spread_by, hot)
    history = versions.groupBy("player_id").agg(
        F.sort_array(F.collect_list(F.struct("_pos", "_version", "_rank"))).alias("_all")
    )
    at = epoch_ms(F.col("started_at"))
    number = count_before(F.col("_all"), longest, lambda v: v["_pos"] <= at)
    found = (
        facts.join(F.broadcast(history), "player_id", "left")
        .withColumn(
            "_rank",
            F.when(
                F.col("_all").isNotNull(), F.get(F.col("_all"), number - 1)["_rank"]
            ),
        )
        .drop("_all")
    )
    return with_rank(found, mark)


def defaulted(facts: DataFrame, mark: str) -> DataFrame:
    """The facts that got the default rank."""
    return facts.where(~F.col(mark))


def found(facts: DataFrame, mark: str) -> DataFrame:
    return facts.where(F.col(mark))


def history(ranks: DataFrame, order: Sequence[str]) -> DataFrame:
    """One version per player and millisecond; the last by ``order`` overwrites."""
    rest = [c for c in ranks.columns if c != "player_id"]
    return (
        ranks.withColumn("_ms", epoch_ms(F.col("updated_at")))
        .groupBy("player_id", "_ms")
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_v"))
        .select("player_id", "_v.*")
    )
