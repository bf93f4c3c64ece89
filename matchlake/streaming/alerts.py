"""Alert rules evaluated while samples come in, tick by tick of the same grid as in batch.

A trigger keeps its samples, then evaluates the ticks that have come due since the last one. A
tick looks back over a bounded time only: a sample, a window or a slope, and a hold. So a trigger
reads the samples of that time, and its result depends on the stored samples alone, not on which
trigger brought them. Everything a trigger writes has the trigger's number in its path and is
replaced when the trigger is run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchlake.operators.metrics import LOOKBACK_SECONDS, SECOND, STEP_SECONDS
from matchlake.operators.skew import ROWS_PER_TASK
from matchlake.plans import alerts
from matchlake.plans.alerts import Rule

SAMPLES = "name string, labels map<string,string>, ts timestamp, value double"
EVALUATED = (
    "alert string, severity string, `group` string, ts timestamp, value double, slope double, "
    "state string"
)
#: Samples are stored by such stretches of time, so that a trigger reads a few of them.
SLOT_SECONDS = 900


def horizon_seconds(rules: Sequence[Rule], every_seconds: int, lookback_seconds: int) -> int:
    """How long before a tick samples can still matter to it.

    A hold needs all ticks it lasts for, each of these the ticks of its slope, and each of those
    its samples; a step of a counter begins a sample earlier.
    """
    reach = max(
        max(r.window_seconds, lookback_seconds) + r.slope_seconds + r.hold_seconds for r in rules
    )
    return reach + lookback_seconds + 2 * every_seconds


class AlertStream:
    """The evaluated ticks of a stream of samples, in ``folder``.

    The clock is the newest sample's time less ``delay_seconds``, which is how long samples may
    be late; a tick is evaluated once, and later samples for it do not change it. With
    ``wall_clock`` ticks also come due while nothing arrives.
    """

    def __init__(
        self,
        folder: str,
        rules: Sequence[Rule] | None = None,
        every_seconds: int = STEP_SECONDS,
        lookback_seconds: int = LOOKBACK_SECONDS,
        delay_seconds: int = 0,
        wall_clock: bool = False,
        rows_per_task: int = ROWS_PER_TASK,
    ) -> None:
        self.folder = folder
        self.rules = alerts.RULES if rules is None else rules
        self.every_seconds, self.lookback_seconds = every_seconds, lookback_seconds
        self.delay_seconds, self.wall_clock = delay_seconds, wall_clock
        self.rows_per_task = rows_per_task

    def start(self, samples: DataFrame, checkpoint: str, interval: str | None = None) -> StreamingQuery:
        """Evaluate a stream (name, labels, ts, value) every ``interval``, a step unless told."""
        return (
            samples.writeStream.foreachBatch(self.take)
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval or f"{self.every_seconds} seconds")
            .start()
        )

    def take(self, new: DataFrame, batch: int) -> None:
        """Store the samples of a trigger and evaluate the ticks that are due by now."""
        spark = new.sparkSession
        slot = F.floor(F.unix_seconds("ts") / SLOT_SECONDS).cast("bigint")
        new.select("name", "labels", "ts", "value").withColumn("slot", slot).write.mode(
            "overwrite"
        ).partitionBy("slot").parquet(f"{self.folder}/samples/batch={batch}")
        before = self._clock(spark).where(F.col("batch") < batch)
        done = before.agg(F.max("due")).first()[0]
        stored = self._samples(spark).where(F.col("batch") <= batch)
        arrived = stored.where(F.col("batch") == batch).agg(F.min("ts"), F.max("ts")).first()
        times = [t for t in (arrived[1], before.agg(F.max("newest")).first()[0]) if t is not None]
        newest = max(times, default=None)
        now = spark.sql("SELECT current_timestamp()").first()[0] if self.wall_clock else newest
        if now is not None:
            step = self.every_seconds
            due = spark.range(1).select(self._tick(F.lit(now) - F.expr(f"INTERVAL {self.delay_seconds} SECONDS"), step)).first()[0]
            if done is not None:
                due = max(due, done)
            self._evaluate(stored, done, due, f"{self.folder}/evaluated/batch={batch}")
            clock = spark.createDataFrame([(newest, due)], "newest timestamp, due timestamp")
            clock.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/clock/batch={batch}")

    @staticmethod
    def _tick(ts, step: int):
        """The last tick at or before an instant."""
        return F.timestamp_seconds(F.floor(F.unix_micros(ts) / (step * SECOND)) * step)

    def _evaluate(self, stored: DataFrame, done, due, path: str) -> None:
        recent = stored.where(F.col("ts") <= F.lit(due))
        if done is not None:
            horizon = horizon_seconds(self.rules, self.every_seconds, self.lookback_seconds)
            begin = done - timedelta(seconds=horizon)
            first = F.floor(F.unix_seconds(F.lit(begin)) / SLOT_SECONDS)
            recent = recent.where((F.col("slot") >= first) & (F.col("ts") > F.lit(begin)))
        ticks = alerts.evaluate(
            recent.select("name", "labels", "ts", "value"),
            self.rules,
            self.every_seconds,
            self.rows_per_task,
            self.lookback_seconds,
        ).where(F.col("ts") <= F.lit(due))
        if done is not None:
            ticks = ticks.where(F.col("ts") > F.lit(done))
        ticks.write.mode("overwrite").parquet(path)

    def _samples(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{SAMPLES}, batch bigint, slot bigint").parquet(
            f"{self.folder}/samples"
        )

    def _clock(self, spark: SparkSession) -> DataFrame:
        schema = "newest timestamp, due timestamp, batch bigint"
        try:
            return spark.read.schema(schema).parquet(f"{self.folder}/clock")
        except AnalysisException:
            # Nothing was evaluated yet.
            return spark.createDataFrame([], schema)

    def evaluated(self, spark: SparkSession) -> DataFrame:
        """All ticks of committed triggers: value, slope and state per alert and group.

        A trigger counts once its clock is written, which it is last.
        """
        ticks = spark.read.schema(f"{EVALUATED}, batch bigint").parquet(f"{self.folder}/evaluated")
        whole = self._clock(spark).select("batch")
        return ticks.join(whole, "batch", "left_semi").drop("batch")

    def changes(self, spark: SparkSession) -> DataFrame:
        """When an alert of a group became pending, firing or inactive."""
        past = Window.partitionBy("alert", "group").orderBy("ts")
        known = self.evaluated(spark).withColumn(
            "before", F.coalesce(F.lag("state").over(past), F.lit("inactive"))
        )
        return known.where("state != before").select(
            "alert", "severity", "group", "ts", "before", "state", "value"
        )
