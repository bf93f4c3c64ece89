"""Rank arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rank ladder.
TIERS = ["bronze", "silver", "gold", "platinum", "diamond"]
POINTS_PER_DIVISION = 100
DIVISIONS_PER_TIER = 4
POINTS_PER_TIER = 400
MAX_POINTS = 1999
WIN_POINTS = 30
LOSS_POINTS = -15
ROSTER_SIZE = 12
TEAM_SIZE = 6
MIN_DURATION_SECONDS = 300
MAX_DURATION_SECONDS = 1200

# Rank of a player without any version yet. A real 0-point rank is bronze 4.
DEFAULT_TIER = "bronze"
DEFAULT_DIVISION = 3
DEFAULT_POINTS = 0


def clamp(value: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(value, F.lit(high)))


def rank_tier(points: Column) -> Column:
    step = F.floor(clamp(points, 0, MAX_POINTS) / POINTS_PER_TIER).cast("int")
    return F.element_at(F.array(*[F.lit(t) for t in TIERS]), step + 1)


def rank_division(points: Column) -> Column:
    """Divisions count down: 4 is the lowest of a tier, 1 the highest."""
    inside = clamp(points, 0, MAX_POINTS) % POINTS_PER_TIER
    return (F.lit(DIVISIONS_PER_TIER) - F.floor(inside / POINTS_PER_DIVISION)).cast("int")


def points_delta(result: Column) -> Column:
    return F.when(result == "win", WIN_POINTS).otherwise(LOSS_POINTS)


def ratio(part: Column, rest: Column) -> Column:
    """Share of ``part``; the denominator never drops below one."""
    return part.cast("double") / F.greatest(part + rest, F.lit(1))
