"""Rank points and records as they develop from match results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions.ranks import points_delta, rank_division, rank_tier
from matchlake.functions.time import epoch_ms
from matchlake.operators.skew import NO_HOT_KEYS, HotKeys, Scan, running
from matchlake.operators.versions import latest


def points_history(results: DataFrame, hot: HotKeys = NO_HOT_KEYS) -> DataFrame:
    """Points after each result, never below zero.

    With the running sum S, a walk floored at zero stands at S - min(0, lowest S so far),
    so two running values replace the step-by-step walk. ``results`` has player_id,
    updated_at, seq and result.
    """
    steps = results.withColumns(
        {"_pos": epoch_ms(F.col("updated_at")), "_step": points_delta(F.col("result"))}
    )
    won = F.when(F.col("result") == "win", 1).otherwise(0)
    sums = {
        "_sum": Scan("sum", F.col("_step")),
        "wins": Scan("sum", won),
        "losses": Scan("sum", 1 - won),
    }
    floors = {"_low": Scan("min", F.col("_sum"))}
    walked = running(steps, ["player_id"], "_pos", "seq", [sums, floors], hot)
    points = F.col("_sum") - F.least(F.lit(0), F.col("_low"))
    return walked.withColumn("rank_points", points.cast("int")).drop(
        "_pos", "_step", "_sum", "_low"
    )


def rank_updates(results: DataFrame, hot: HotKeys = NO_HOT_KEYS) -> DataFrame:
    """The rank row each result writes, with ``seq`` as its order."""
    points = F.col("rank_points")
    return points_history(results, hot).select(
        "player_id",
        rank_tier(points).alias("rank_tier"),
        rank_division(points).alias("rank_division"),
        "rank_points",
        F.col("wins").cast("int").alias("wins"),
        F.col("losses").cast("int").alias("losses"),
        "updated_at",
        "seq",
    )


def current_ranks(updates: DataFrame) -> DataFrame:
    """One row per player: the last update replaces all earlier ones."""
    return latest(updates, ["player_id"], ["updated_at", "seq"]).drop("seq")
