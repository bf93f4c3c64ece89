"""The alert rules as data, and one job that evaluates all of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.operators.metrics import (
    LOOKBACK_SECONDS,
    SECOND,
    STEP_SECONDS,
    divided,
    hold,
    increments,
    label_key,
    matches,
    on_grid,
    trailing_growth,
    trailing_slope,
)
from matchlake.operators.skew import ROWS_PER_TASK, HotKeys, find_all_hot_keys

# The consumer group of the facts job, unless a deployment names its own.
CONSUMER_GROUP = "facts"


@dataclass(frozen=True)
class Rule:
    """``value op threshold`` for ``hold_seconds``, per group of series.

    ``measure`` is value, increase or rate (the latter two over ``window_seconds``);
    ``combine`` adds up (sum) or takes the highest (max) of the series that agree on the
    labels ``by``, with None keeping every series apart. ``divide_by`` names a metric to
    divide by, series by series. ``min_slope`` asks for a fitted growth per second over
    ``slope_seconds`` as well.
    """

    alert: str
    severity: str
    op: str
    threshold: float
    name: str | None = None
    name_like: str | None = None
    equal: Mapping[str, str] = field(default_factory=dict)
    like: Mapping[str, str] = field(default_factory=dict)
    measure: str = "value"
    window_seconds: int = 0
    combine: str = "sum"
    by: Sequence[str] | None = None
    divide_by: str | None = None
    min_slope: float | None = None
    slope_seconds: int = 0
    hold_seconds: int = 0

    def selects(self) -> Column:
        return matches(self.name, self.name_like, self.equal, self.like)

    def divisor(self) -> Column:
        return matches(self.divide_by, None, self.equal, self.like)


def rules_of(consumer_group: str = CONSUMER_GROUP) -> list[Rule]:
    """The rules for a job that reads its topics as ``consumer_group``."""
    # The eleven rules with their metrics, thresholds, windows and holds.
    return [
        Rule(
            "Offline partitions",
            "page",
            ">",
            0,
            name="kafka_controller_kafkacontroller_value",
            equal={"name": "OfflinePartitionsCount"},
        ),
        Rule(
            "Consumer lag climbing",
            "page",
            ">",
            200,
            name="kafka_consumergroup_lag",
            equal={"consumergroup": consumer_group},
            like={"topic": r"dbserver1\.public\..+"},
            by=["topic"],
            min_slope=5,
            slope_seconds=600,
        ),
        Rule(
            "Failed checkpoints",
            "page",
            ">=",
            3,
            name="flink_jobmanager_job_numberOfFailedCheckpoints",
            measure="increase",
            window_seconds=900,
        ),
        Rule(
            "Job restart loop",
            "page",
            ">=",
            2,
            name="flink_jobmanager_job_fullRestarts",
            measure="increase",
            window_seconds=600,
        ),
        Rule(
            "CDC source stopped",
            "page",
            "==",
            0,
            name="pg_debezium_slot_active",
            hold_seconds=60,
        ),
        Rule(
            "Under-replicated partitions",
            "ticket",
            ">",
            0,
            name="kafka_server_replicamanager_value",
            equal={"name": "UnderReplicatedPartitions"},
        ),
        Rule(
            "Checkpoint duration high",
            "ticket",
            ">",
            10_000,
            name="flink_jobmanager_job_lastCheckpointDuration",
            hold_seconds=300,
        ),
        Rule(
            "Operator backpressure",
            "ticket",
            ">",
            500,
            name="flink_taskmanager_job_task_backPressuredTimeMsPerSecond",
            like={
                "task_name": ".*(PlayerLookup|MatchJoin|RankAsOf|match_events|match_participants|players|ranks|Iceberg).*"  # noqa: E501
            },
            by=["task_name"],
            hold_seconds=900,
        ),
        Rule(
            "TaskManager heap high",
            "ticket",
            ">",
            0.8,
            name="flink_taskmanager_Status_JVM_Memory_Heap_Used",
            divide_by="flink_taskmanager_Status_JVM_Memory_Heap_Max",
            hold_seconds=600,
        ),
        Rule(
            "Streaming source lag high",
            "ticket",
            ">",
            5000,
            name_like="debezium_.*millisecondsbehindsource",
            combine="max",
            by=[],
            hold_seconds=300,
        ),
        Rule(
            "Incomplete join rate",
            "ticket",
            ">",
            0,
            name="flink_taskmanager_job_task_operator_join_incomplete",
            measure="rate",
            window_seconds=300,
            hold_seconds=300,
        ),
    ]


RULES = rules_of()

_GROUP = ["alert", "group"]
_COUNTER = ["alert", "name", "series"]
_COMPARE = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "==": lambda a, b: a == b,
}


def _per_rule(rules: Sequence[Rule], value: Callable[[Rule], str | int]) -> Column:
    """A value that depends on the row's alert."""

    def text(x: str | int) -> str:
        return str(x) if isinstance(x, int) else "'" + x.replace("'", "\\'") + "'"

    cases = " ".join(f"WHEN {text(r.alert)} THEN {text(value(r))}" for r in rules)
    return F.expr(f"CASE alert {cases} END")


def _only(labels: Column, names: Sequence[str]) -> Column:
    return F.map_filter(labels, lambda label, _: label.isin(list(names)))


def _tagged(samples: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Each sample once per rule and role it serves, in a single pass."""
    labels = F.col("labels")
    uses = []
    conditions = []
    for rule in rules:
        kept = labels if rule.by is None else _only(labels, rule.by)
        roles = [(rule.selects(), "part")]
        if rule.divide_by:
            roles.append((rule.divisor(), "whole"))
        for wanted, role in roles:
            use = F.struct(
                F.lit(rule.alert).alias("alert"),
                F.lit(role).alias("role"),
                label_key(kept).alias("group"),
            )
            uses.append(F.when(wanted, use))
            conditions.append(wanted)
    wanted_at_all = reduce(Column.__or__, conditions)
    return (
        samples.where(wanted_at_all)
        .withColumn("_use", F.explode(F.array_compact(F.array(*uses))))
        .select(
            "_use.*",
            "name",
            label_key(labels).alias("series"),
            F.unix_micros("ts").alias("pos"),
            "value",
        )
    )


def _measured(
    tagged: DataFrame, rules: Sequence[Rule], every_seconds: int, hot: HotKeys
) -> DataFrame:
    """Counters at the grid's ticks by their growth in the rule's window up to the tick."""
    seconds = _per_rule(rules, lambda r: r.window_seconds)
    grown = increments(tagged, _COUNTER, hot).withColumn("_tick", F.lit(False))
    asked = on_grid(tagged, every_seconds, seconds, _COUNTER, hot).drop("ts")
    nothing = {c: F.lit(None).cast(grown.schema[c].dataType) for c in ("step", "since")}
    both = grown.unionByName(asked.withColumns(nothing | {"_tick": F.lit(True)}))
    summed = trailing_growth(both, _COUNTER, seconds.cast("bigint") * SECOND, "growth", hot)
    per = _per_rule(rules, lambda r: r.window_seconds if r.measure == "rate" else 1)
    return summed.where("_tick").withColumn("value", F.col("growth") / per)


def _grouped(measured: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One value per alert, group and tick."""
    part = F.when(F.col("role") == "part", F.col("value"))
    whole = F.sum(F.when(F.col("role") == "whole", F.col("value")))
    highest = F.col("alert").isin([r.alert for r in rules if r.combine == "max"])
    quotient = F.col("alert").isin([r.alert for r in rules if r.divide_by])
    return (
        measured.groupBy(*_GROUP, "pos")
        .agg(F.sum(part).alias("sum"), F.max(part).alias("max"), whole.alias("whole"))
        .select(
            *_GROUP,
            "pos",
            F.when(quotient, divided(F.col("sum"), F.col("whole")))
            .when(highest, F.col("max"))
            .otherwise(F.col("sum"))
            .alias("value"),
        )
        .where(F.col("value").isNotNull())
    )


def _valued(
    samples: DataFrame,
    rules: Sequence[Rule],
    every_seconds: int,
    lookback_seconds: int,
    hot_groups: HotKeys,
    hot_counters: HotKeys,
) -> list[DataFrame]:
    """Values of all rules; counters are read apart, as they need their samples as well."""
    counters = [r for r in rules if r.measure != "value"]
    plain = [r for r in rules if r.measure == "value"]
    parts = []
    if counters:
        tagged = _tagged(samples, counters)
        measured = _measured(tagged, counters, every_seconds, hot_counters)
        slope = F.lit(None).cast("double").alias("slope")
        parts.append(_grouped(measured, counters).select("*", slope))
    if plain:
        tagged = _tagged(samples, plain)
        ticks = on_grid(tagged, every_seconds, lookback_seconds, _COUNTER, hot_counters)
        # Rules that ask for no slope get one over a single tick, which is null.
        width = _per_rule(plain, lambda r: r.slope_seconds or every_seconds - 1)
        grouped = _grouped(ticks, plain)
        width = (width * SECOND).cast("bigint")
        parts.append(trailing_slope(grouped, _GROUP, width, hot_groups))
    return parts


def evaluate(
    samples: DataFrame,
    rules: Sequence[Rule] | None = None,
    every_seconds: int = STEP_SECONDS,
    rows_per_task: int = ROWS_PER_TASK,
    lookback_seconds: int = LOOKBACK_SECONDS,
) -> DataFrame:
    """Every group of every rule at every tick of a grid: value, slope and state.

    ``samples`` may come at any instants. At a tick a series has its last sample of the last
    ``lookback_seconds``; a tick at which a group has none interrupts its hold.
    """
    rules = RULES if rules is None else rules
    tagged = _tagged(samples, rules)
    groups, counters = find_all_hot_keys(tagged, [_GROUP, _COUNTER], rows_per_task)
    valued = reduce(
        DataFrame.unionByName,
        _valued(samples, rules, every_seconds, lookback_seconds, groups, counters),
    )
    seconds = _per_rule(rules, lambda r: r.hold_seconds).cast("bigint")
    held = hold(valued, _breach(rules), seconds, _GROUP, every_seconds, groups)
    return held.select(
        "alert",
        _per_rule(rules, lambda r: r.severity).alias("severity"),
        "group",
        F.timestamp_micros("pos").alias("ts"),
        "value",
        "slope",
        "state",
    )


def _breach(rules: Sequence[Rule]) -> Column:
    tests = []
    for rule in rules:
        test = _COMPARE[rule.op](F.col("value"), F.lit(float(rule.threshold)))
        if rule.min_slope is not None:
            test = test & F.coalesce(F.col("slope") > rule.min_slope, F.lit(False))
        tests.append((F.col("alert") == rule.alert) & test)
    return reduce(Column.__or__, tests)


def alert_report(evaluated: DataFrame) -> DataFrame:
    """Per alert and group: evaluated ticks, breaches, firings and the first firing."""
    firing = F.col("state") == "firing"
    return evaluated.groupBy("alert", "severity", "group").agg(
        F.count(F.lit(1)).alias("evaluations"),
        F.count_if(F.col("state") != "inactive").alias("breaches"),
        F.count_if(firing).alias("firings"),
        F.min(F.when(firing, F.col("ts"))).alias("first_firing"),
    )
