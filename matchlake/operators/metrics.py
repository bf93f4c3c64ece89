"""Time-series operators over metric samples ``(name, labels, ts, value)``.

A series is a metric name with one set of labels. Positions are bigint microseconds.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions.time import floor_div
from matchlake.operators.skew import (
    NO_HOT_KEYS,
    HotKeys,
    Scan,
    find_hot_keys,
    merged_fit,
    running,
)

SECOND = 1_000_000
SERIES = ["name", "series"]
# A tick of the evaluation grid, and how long a sample stands for its series.
STEP_SECONDS = 15
LOOKBACK_SECONDS = 300
# Ticks that one row is unfolded into at a time.
STEPS_AT_ONCE = 240


def label_key(labels: Column) -> Column:
    """A map of labels as one comparable text, whatever the order of its entries."""
    return F.to_json(F.array_sort(F.map_entries(labels)))


def with_series(samples: DataFrame) -> DataFrame:
    """Add ``series`` (the labels as text) and ``pos`` (the time in microseconds)."""
    return samples.withColumns(
        {"series": label_key(F.col("labels")), "pos": F.unix_micros(F.col("ts"))}
    )


# --- selection and aggregation -----------------------------------------------


LABELS = "array<struct<key:string,value:string>>"


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def _prefix(pattern: str) -> str:
    """Text every match begins with; unlike a pattern, a scan can skip files by it."""
    if "|" in pattern:
        return ""
    plain = re.match(r"[A-Za-z0-9_]*", pattern).group()
    optional = pattern[len(plain) : len(plain) + 1] in ("*", "?", "{")
    return plain[:-1] if optional else plain


def matches(
    name: str | None = None,
    name_like: str | None = None,
    equal: Mapping[str, str] | None = None,
    like: Mapping[str, str] | None = None,
) -> Column:
    """Condition for a metric name and labels; patterns match the whole text."""
    wanted = F.lit(True)
    if name is not None:
        wanted = wanted & (F.col("name") == name)
    if name_like is not None:
        wanted = wanted & F.col("name").startswith(_prefix(name_like))
        wanted = wanted & F.col("name").rlike(_whole(name_like))
    for label, value in (equal or {}).items():
        wanted = wanted & (F.coalesce(F.col("labels")[label], F.lit("")) == value)
    for label, pattern in (like or {}).items():
        wanted = wanted & F.coalesce(F.col("labels")[label], F.lit("")).rlike(_whole(pattern))
    return wanted


def select(samples: DataFrame, **selector) -> DataFrame:
    return samples.where(matches(**selector))


def on_grid(
    samples: DataFrame,
    step_seconds: int = STEP_SECONDS,
    lookback_seconds: Column | int = LOOKBACK_SECONDS,
    keys: Sequence[str] = SERIES,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Each series at the ticks of a fixed grid: its last sample at or before the tick.

    A sample older than ``lookback_seconds`` is no longer used, so a gap leaves ticks out. Series
    scraped at different instants meet at the same ticks. A sample covers the ticks up to the
    next sample or the end of the lookback, so there is about one row per sample. ``pos`` and
    ``ts`` become the tick; of samples of one instant one is used.
    """
    if isinstance(lookback_seconds, int):
        lookback_seconds = F.lit(lookback_seconds)
    step = step_seconds * SECOND
    pos = F.col("pos")
    turned = samples.withColumns({"_back": -pos, "_tie": F.xxhash64("value")})
    ahead = running(turned, keys, "_back", "_tie", {"_next": Scan("lag", pos)}, hot)
    oldest = pos + lookback_seconds.cast("bigint") * SECOND
    first = -floor_div(-pos, step) * step
    last = floor_div(F.least(F.col("_next") - 1, oldest), step) * step
    ticks = F.when(first <= last, F.sequence(first, last, F.lit(step).cast("bigint")))
    kept = [F.col(c) for c in samples.columns if c not in ("pos", "ts")]
    return ahead.select(*kept, F.explode(ticks).alias("pos")).withColumn(
        "ts", F.timestamp_micros("pos")
    )


def sum_by(samples: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Sum, maximum and number of series per instant and label values."""
    return samples.groupBy("pos", *[F.col("labels")[label].alias(label) for label in labels]).agg(
        F.sum("value").alias("value"),
        F.max("value").alias("highest"),
        F.count(F.lit(1)).alias("series_count"),
    )


def or_zero(single: DataFrame, column: str = "value") -> DataFrame:
    """A one-row result with zero where there was nothing to aggregate."""
    return single.agg(F.coalesce(F.max(column), F.lit(0.0)).alias(column))


def or_zero_on_grid(
    ticks: DataFrame, step_seconds: int = STEP_SECONDS, labels: Sequence[str] = (), column: str = "value"
) -> DataFrame:
    """Each group at every tick of the grid, with zero where it has no value.

    ``ticks`` has a row per tick ``pos`` and group of ``labels`` at most; the grid goes from its
    first tick to its last. A group is one that has a value at any tick, so an absent target
    reads as zero instead of leaving a gap. Without ``labels`` there is one group, which is there
    at every tick. Ticks are made hour by hour of the steps, not in one row.
    """
    step, run = step_seconds * SECOND, step_seconds * SECOND * STEPS_AT_ONCE
    ends = ticks.agg(F.min("pos").alias("first"), F.max("pos").alias("last")).where("first IS NOT NULL")
    spine = ends.select("last", F.explode(F.sequence("first", "last", F.lit(run))).alias("begin")).select(
        F.explode(
            F.sequence("begin", F.least("last", F.col("begin") + run - step), F.lit(step))
        ).alias("pos")
    )
    if labels:
        # One row of the grid's ends meets every group, so this is no join of rows with rows.
        groups = ticks.select(*labels).distinct().select(F.struct(*labels).alias("_group"))
        spine = groups.join(F.broadcast(ends)).select(
            "_group", "last", F.explode(F.sequence("first", "last", F.lit(run))).alias("begin")
        ).select(
            "_group.*",
            F.explode(
                F.sequence("begin", F.least("last", F.col("begin") + run - step), F.lit(step))
            ).alias("pos"),
        )
    values = ticks.select(*[F.col(c).alias(f"_{c}") for c in (*labels, "pos")], column)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*labels, "pos")]
    return spine.join(values, reduce(Column.__and__, same), "left").select(
        *labels, "pos", F.coalesce(column, F.lit(0.0)).alias(column)
    )


def divided(part: Column, whole: Column) -> Column:
    """Division of metrics: by zero it is an infinity, and nothing where both are zero."""
    infinite = F.when(part > 0, F.lit(float("inf"))).when(part < 0, F.lit(float("-inf")))
    return F.when(whole == 0, infinite).otherwise(part / F.nullif(whole, F.lit(0.0)))


def metric_ratio(part: DataFrame, whole: DataFrame) -> DataFrame:
    """Two metrics divided series by series at equal instants, such as ticks of a grid."""
    return (
        part.select("series", "pos", F.col("value").alias("part"))
        .join(whole.select("series", "pos", F.col("value").alias("whole")), ["series", "pos"])
        .withColumn("value", divided(F.col("part"), F.col("whole")))
    )


# --- sliding windows ---------------------------------------------------------


def _trailing(
    samples: DataFrame,
    keys: Sequence[str],
    width: Column | int,
    scan: Callable[[Column], Scan],
    hot: HotKeys,
    whole: Mapping[str, Scan] | None = None,
) -> DataFrame:
    """Add ``_came`` and ``_stays``, which together cover the last ``width`` microseconds.

    Time is cut into slices of that width, so a window (both ends in) reaches back into
    one earlier slice at most. Each row counts in its own slice from its time on, scanned
    forwards as ``_came``, and in the next one until it falls out of the window, scanned
    backwards as ``_stays``. Nothing is ever subtracted, the work per row does not depend
    on how many rows a window holds, and a long series spreads over its slices.

    ``scan`` is given the condition under which a row takes part, and may use ``_x``, the
    time since the slice began, and the scans of the slice in ``whole``.
    """
    mine = F.col("_own")
    sliced, slice_keys, hot_slices = _sliced(
        samples, keys, width, F.lit(True), F.col("pos"), hot
    )
    steps = [s for s in (whole, {"_came": scan(mine)}) if s]
    came = running(sliced, slice_keys, "_at", None, steps, hot_slices, spread=True)
    stays = {"_stays": scan(~mine)}
    stays = running(came, slice_keys, "_back", None, stays, hot_slices, spread=True)
    return stays.where(mine).select(*samples.columns, "_came", "_stays")


def _sliced(
    samples: DataFrame,
    keys: Sequence[str],
    width: Column | int,
    stays: Column,
    leaves: Column,
    hot: HotKeys,
) -> tuple[DataFrame, list[str], HotKeys]:
    """Each row in its own slice, and in the next one until ``leaves`` falls out of the window.

    Rows for which ``stays`` is false have fallen out before the next slice begins.
    """
    width = (F.lit(width) if isinstance(width, int) else width).cast("bigint")
    pos = F.col("pos")
    own = floor_div(pos, width)
    later = F.struct(
        (own + 1).alias("slice"), (leaves + width).alias("at"), F.lit(False).alias("own")
    )
    halves = F.array_compact(
        F.array(
            F.struct(own.alias("slice"), pos.alias("at"), F.lit(True).alias("own")),
            F.when(stays, later),
        )
    )
    sliced = samples.withColumn("_half", F.explode(halves)).select(
        *samples.columns,
        F.col("_half.slice").alias("_slice"),
        F.col("_half.at").alias("_at"),
        (-F.col("_half.at")).alias("_back"),
        F.col("_half.own").alias("_own"),
        (pos - F.col("_half.slice") * width).alias("_x"),
    )
    slice_keys = [*keys, "_slice"]
    if hot:
        return sliced, slice_keys, find_hot_keys(sliced, slice_keys, hot.rows_per_task)
    return sliced, slice_keys, HotKeys(tuple(slice_keys), total=2 * hot.total)


def trailing_sum(
    samples: DataFrame,
    keys: Sequence[str],
    width: Column | int,
    value: str,
    name: str,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Add the sum of ``value`` over the rows of the last ``width`` microseconds."""
    both = _trailing(
        samples, keys, width, lambda mine: Scan("sum", F.when(mine, F.col(value))), hot
    )
    total = F.coalesce("_came", F.lit(0.0)) + F.coalesce("_stays", F.lit(0.0))
    return both.withColumn(name, total).drop("_came", "_stays")


def trailing_slope(
    samples: DataFrame,
    keys: Sequence[str],
    width: Column | int,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Add the least-squares ``slope`` of ``value`` per second; null below two instants.

    Values are taken above the lowest of their slice before anything is summed. So the level of a
    series is gone before partial sums meet, in whatever order they do.
    """
    above = (F.col("value") - F.col("_level")).alias("y")
    point = F.struct(above, (F.col("_x") / SECOND).alias("x"))
    both = _trailing(
        samples,
        keys,
        width,
        lambda mine: Scan("fit", F.when(mine, point)),
        hot,
        whole={"_level": Scan("lowest", F.col("value"))},
    )
    fit = merged_fit(F.col("_came"), F.col("_stays"))
    slope = F.when((fit["n"] >= 2) & (fit["sxx"] > 0), fit["sxy"] / fit["sxx"])
    return both.withColumn("slope", slope).drop("_came", "_stays")


def increments(
    samples: DataFrame, keys: Sequence[str] = SERIES, hot: HotKeys = NO_HOT_KEYS
) -> DataFrame:
    """Add ``step``, the growth of a counter since the sample before, and that one's ``since``.

    A value below the one before means the counter restarted from zero. The first sample of a
    series has neither.
    """
    scans = {"_before": Scan("lag", F.col("value")), "since": Scan("lag", F.col("pos"))}
    tied = samples.withColumn("_tie", F.xxhash64("value"))
    seen = running(tied, keys, "pos", "_tie", scans, hot, spread=True)
    grown = F.col("value") - F.col("_before")
    step = F.when(grown < 0, F.col("value")).otherwise(grown)
    return seen.withColumn("step", step).drop("_before", "_tie")


def trailing_growth(
    grown: DataFrame,
    keys: Sequence[str],
    width: Column | int,
    name: str,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Add the sum of the ``step`` that lie inside the last ``width`` microseconds as a whole.

    A step lies inside while its earlier sample, ``since``, does; null where there is none. So
    growth across a window's beginning does not count. Rows without a step only ask.

    A step within one slice counts in it from its own time on, and in the next slice until its
    earlier sample leaves. Only a slice's first step can begin before the slice; it counts from
    its time until its earlier sample leaves, which is within the slice.
    """
    wide = (F.lit(width) if isinstance(width, int) else width).cast("bigint")
    inside = F.coalesce(floor_div(F.col("since"), wide) == floor_div(F.col("pos"), wide), F.lit(False))
    rows = grown.withColumn("_inside", inside)
    sliced, slice_keys, hot_slices = _sliced(rows, keys, wide, inside, F.col("since"), hot)
    mine = F.col("_own")
    edge = F.struct(F.col("step").alias("step"), (F.col("since") + wide).alias("until"))
    forward = {
        "_came": Scan("sum", F.when(mine & F.col("_inside"), F.col("step"))),
        "_edge": Scan("last", F.when(mine & ~F.col("_inside") & F.col("step").isNotNull(), edge)),
    }
    came = running(sliced, slice_keys, "_at", None, forward, hot_slices, spread=True)
    stays = {"_stays": Scan("sum", F.when(~mine, F.col("step")))}
    both = running(came, slice_keys, "_back", None, stays, hot_slices, spread=True)
    first = F.when(F.col("_edge.until") >= F.col("pos"), F.col("_edge.step"))
    parts = [F.col("_came"), F.col("_stays"), first]
    some = F.coalesce(*parts).isNotNull()
    total = reduce(Column.__add__, [F.coalesce(p, F.lit(0.0)) for p in parts])
    return both.where(mine).select(*grown.columns, F.when(some, total).alias(name))


def increase(
    samples: DataFrame,
    seconds: int,
    keys: Sequence[str] = SERIES,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Add ``increase`` and the per-second ``rate`` of a counter over the last ``seconds``.

    Growth is added up between the samples in the window, both ends in; nothing is extrapolated
    to its ends, and fewer than two samples in it give null.
    """
    grown = increments(samples, keys, hot)
    summed = trailing_growth(grown, keys, seconds * SECOND, "increase", hot)
    return summed.withColumn("rate", F.col("increase") / seconds).drop("step", "since")


def deriv(
    samples: DataFrame,
    seconds: int,
    keys: Sequence[str] = SERIES,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Add ``slope``: the fitted change per second over the last ``seconds``."""
    return trailing_slope(samples, keys, seconds * SECOND, hot)


# --- holding -----------------------------------------------------------------


def hold(
    samples: DataFrame,
    condition: Column,
    seconds: Column | int,
    keys: Sequence[str] = SERIES,
    max_gap_seconds: int | None = None,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Add ``state``: inactive, pending, or firing once true for ``seconds`` on end.

    A gap above ``max_gap_seconds`` between samples interrupts a condition like a false
    sample does.
    """
    seconds = (F.lit(seconds) if isinstance(seconds, int) else seconds).cast("bigint")
    judged = samples.withColumns(
        {"_true": F.coalesce(condition, F.lit(False)), "_tie": F.lit(0)}
    )
    starts = ~F.coalesce("_was", F.lit(False))
    if max_gap_seconds is not None:
        gap = F.col("pos") - F.col("_at") > max_gap_seconds * SECOND
        starts = starts | F.coalesce(gap, F.lit(False))
    scans = [
        {"_was": Scan("lag", F.col("_true")), "_at": Scan("lag", F.col("pos"))},
        {"_since": Scan("last", F.when(F.col("_true") & starts, F.col("pos")))},
    ]
    held = running(judged, keys, "pos", "_tie", scans, hot)
    long_enough = F.col("pos") - F.col("_since") >= seconds * SECOND
    return held.withColumn(
        "state",
        F.when(~F.col("_true"), "inactive").when(long_enough, "firing").otherwise("pending"),
    ).drop("_true", "_was", "_at", "_since", "_tie")
