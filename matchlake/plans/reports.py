"""The dashboard queries over the fact table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHART_ROWS = 100
TIMELINE_ROWS = 20


def _mean(value: Column, digits: int = 2) -> Column:
    return F.round(F.avg(value), digits)


def facts_landed(facts: DataFrame) -> DataFrame:
    return facts.agg(F.count(F.lit(1)).alias("facts"))


def facts_landed_chart(counts: DataFrame) -> DataFrame:
    """The chart shows the largest count when several are stacked up."""
    return counts.agg(F.max("facts").alias("facts"))


def hero_win_rate(facts: DataFrame) -> DataFrame:
    won = F.when(F.col("result") == "win", 1.0).otherwise(0.0)
    return facts.groupBy("hero_played").agg(
        F.round(F.avg(won) * 100, 1).alias("win_rate"),
        _mean(F.col("kills").cast("double")).alias("avg_kills"),
        _mean(F.col("deaths").cast("double")).alias("avg_deaths"),
    )


def map_results(facts: DataFrame) -> DataFrame:
    """Durations are averaged over facts, so each match weighs by its facts."""
    return facts.groupBy("map_name").agg(
        _mean(F.col("match_duration_seconds").cast("double")).alias("avg_duration_seconds"),
        F.countDistinct("match_id").alias("matches"),
    )


def player_leaderboard(facts: DataFrame) -> DataFrame:
    """Grouped by name. Rows without deaths do not count towards the ratio."""
    per_death = F.col("kills").cast("double") / F.nullif(F.col("deaths"), F.lit(0))
    return facts.groupBy("account_name").agg(
        F.count_if(F.col("result") == "win").alias("wins"),
        _mean(per_death).alias("kd"),
    )


def rank_as_of_mix(facts: DataFrame) -> DataFrame:
    return facts.groupBy("rank_tier_at_match_start", "rank_division_at_match_start").agg(
        F.count(F.lit(1)).alias("facts")
    )


def rank_vs_result(facts: DataFrame) -> DataFrame:
    return facts.groupBy("rank_tier_at_match_start", "result").agg(
        F.count(F.lit(1)).alias("facts")
    )


def top_n(df: DataFrame, order: Sequence[Column], n: int = CHART_ROWS) -> DataFrame:
    """The first ``n`` rows; ``order`` should be total so that the rows are certain."""
    return df.orderBy(*order).limit(n)


def hero_top(facts: DataFrame, n: int = CHART_ROWS) -> DataFrame:
    return top_n(hero_win_rate(facts), [F.desc("win_rate"), F.asc("hero_played")], n)


def leaderboard_top(facts: DataFrame, n: int = CHART_ROWS) -> DataFrame:
    return top_n(player_leaderboard(facts), [F.desc("wins"), F.asc("account_name")], n)


def player_timeline(facts: DataFrame, n: int = TIMELINE_ROWS) -> DataFrame:
    """Ties of one player and start are broken by match and participant id."""
    order = [F.asc(c) for c in ("player_id", "started_at", "match_id", "id")]
    return top_n(facts, order, n).select(
        "player_id",
        "started_at",
        "result",
        "rank_tier_at_match_start",
        "rank_division_at_match_start",
        "rank_points_at_match_start",
    )


# Report name -> the columns it groups by, and its chart order.
GROUPED = {
    "hero_win_rate": (["hero_played"], ["win_rate"]),
    "map_results": (["map_name"], ["matches"]),
    "player_leaderboard": (["account_name"], ["wins"]),
    "rank_as_of_mix": (
        ["rank_tier_at_match_start", "rank_division_at_match_start"],
        [],
    ),
    "rank_vs_result": (["rank_tier_at_match_start", "result"], []),
}

REPORTS = {
    "facts_landed": facts_landed,
    "hero_win_rate": hero_win_rate,
    "map_results": map_results,
    "player_leaderboard": player_leaderboard,
    "rank_as_of_mix": rank_as_of_mix,
    "rank_vs_result": rank_vs_result,
}


def ordered_report(facts: DataFrame, name: str) -> DataFrame:
    """A report in the order its dashboard lists it."""
    report = REPORTS[name](facts)
    if name not in GROUPED:
        return report
    keys, falling = GROUPED[name]
    return report.orderBy(*[F.desc(c) for c in falling], *[F.asc(k) for k in keys])


def dashboard(facts: DataFrame) -> dict[str, DataFrame]:
    """All six reports over one read of the facts; cache ``facts`` if it is costly."""
    return {name: ordered_report(facts, name) for name in REPORTS}


def all_reports(facts: DataFrame) -> DataFrame:
    """All six reports as one table, from one read of the facts by grouping sets.

    A row per report and group: (report, key_1, key_2, facts, ...) with the figures of its report
    and nulls for those of others. Maps are grouped by match first, so that matches are counted by
    adding up groups; everything else is added up before the shuffle as well. An empty table has
    no groups and gives no rows.
    """
    sets = {
        "facts_landed": [],
        "hero_win_rate": ["hero_played"],
        "map_results": ["map_name", "match_id"],
        "player_leaderboard": ["account_name"],
        "rank_as_of_mix": ["rank_tier_at_match_start", "rank_division_at_match_start"],
        "rank_vs_result": ["rank_tier_at_match_start", "result"],
    }
    columns = list(dict.fromkeys(c for keys in sets.values() for c in keys))
    # The number of a grouping set: a bit per column that it leaves out, the last one lowest.
    numbers = {
        name: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in keys)
        for name, keys in sets.items()
    }
    won = F.col("won")
    per_death = F.col("kills").cast("double") / F.nullif(F.col("deaths"), F.lit(0))
    measured = facts.select(
        *columns,
        F.when(F.col("result") == "win", 1).otherwise(0).alias("won"),
        "kills",
        "deaths",
        per_death.alias("per_death"),
        F.col("match_duration_seconds").alias("duration"),
    )
    totals = {"facts": F.count(F.lit(1)), "wins": F.sum(won)}
    for name in ("kills", "deaths", "per_death", "duration"):
        totals |= {f"{name}_sum": F.sum(F.col(name).cast("double")), f"{name}_n": F.count(name)}
    grouped = measured.groupingSets(
        [[F.col(c) for c in keys] for keys in sets.values()], *columns
    ).agg(*[v.alias(n) for n, v in totals.items()], F.grouping_id().alias("number"))
    report = F.coalesce(*[F.when(F.col("number") == n, F.lit(r)) for r, n in numbers.items()])
    keys = {"key_1": None, "key_2": None}
    for name, chosen in sets.items():
        for i, column in enumerate([c for c in chosen if c != "match_id"], 1):
            value = F.when(F.col("report") == name, F.col(column).cast("string"))
            keys[f"key_{i}"] = value if keys[f"key_{i}"] is None else F.coalesce(keys[f"key_{i}"], value)
    by_key = (
        grouped.withColumn("report", report)
        .groupBy("report", *[v.alias(k) for k, v in keys.items()])
        .agg(*[F.sum(n).alias(n) for n in totals], F.count(F.lit(1)).alias("parts"))
    )

    def only(name: str, value: Column) -> Column:
        return F.when(F.col("report") == name, value)

    def mean(name: str) -> Column:
        return F.round(F.col(f"{name}_sum") / F.nullif(F.col(f"{name}_n"), F.lit(0)), 2)

    rate = F.round(F.col("wins") / F.col("facts") * 100, 1)
    return by_key.select(
        "report",
        *keys,
        "facts",
        only("hero_win_rate", rate).alias("win_rate"),
        only("hero_win_rate", mean("kills")).alias("avg_kills"),
        only("hero_win_rate", mean("deaths")).alias("avg_deaths"),
        only("map_results", mean("duration")).alias("avg_duration_seconds"),
        only("map_results", F.col("parts")).alias("matches"),
        only("player_leaderboard", F.col("wins")).alias("wins"),
        only("player_leaderboard", mean("per_death")).alias("kd"),
    )


def dataset_row_counts(facts: DataFrame) -> DataFrame:
    """How many rows each report has, in one pass: a report has a row per group.

    A struct is never null, so groups with a null key count like any other.
    """
    counts = facts.agg(
        *[F.countDistinct(F.struct(*keys)).alias(name) for name, (keys, _) in GROUPED.items()]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("dataset"), F.col(name).alias("rows"))
            for name in GROUPED
        ]
    )
    return counts.select(F.inline(pairs))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
