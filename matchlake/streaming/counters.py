"""Counts of the running job as tables: what every batch observed, and what state holds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

COUNTS = (
    "query string, batch bigint, ended_at timestamp, observed string, counter string, value bigint"
)
# The metric names that the job's counters have for dashboards and alert rules.
METRIC_PREFIX = "flink_taskmanager_job_task_operator_"
METRICS = {
    "player_lookup_hits": "player_lookup_hits",
    "player_lookup_misses": "player_lookup_misses",
    "complete": "join_complete",
    "incomplete": "join_incomplete",
    "rank_as_of_found": "rank_as_of_found",
    "rank_as_of_defaulted": "rank_as_of_defaulted",
}


class CounterTable(StreamingQueryListener):
    """Writes the observed counts of every batch to a folder, once per query and batch.

    A batch has a folder of its own, which is replaced when the batch is reported again, so a
    restart counts nothing twice. Attach with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        ended = datetime.fromisoformat(progress.timestamp)
        rows = [
            (str(progress.id), progress.batchId, ended, observed, counter, int(value or 0))
            for observed, values in progress.observedMetrics.items()
            for counter, value in values.asDict().items()
        ]
        if rows:
            batch = f"{self.folder}/query={progress.id}/batch={progress.batchId}"
            table = self.spark.createDataFrame(rows, COUNTS).drop("query", "batch")
            table.coalesce(1).write.mode("overwrite").parquet(batch)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def counts(spark: SparkSession, folder: str) -> DataFrame:
    """What was counted so far, a row per query, batch and counter."""
    return spark.read.schema(COUNTS).parquet(folder)


def as_samples(counted: DataFrame, job: str = "facts") -> DataFrame:
    """Running totals of the counters as metric samples, for rates and alert rules.

    A query has a row per batch and counter, so a window per query and counter orders batches,
    not records.
    """
    names = F.create_map(*[F.lit(x) for pair in METRICS.items() for x in pair])
    past = Window.partitionBy("query", "counter").orderBy("batch")
    return counted.select(
        F.concat(F.lit(METRIC_PREFIX), F.coalesce(names[F.col("counter")], F.col("counter"))).alias("name"),
        F.create_map(F.lit("job"), F.lit(job), F.lit("query"), F.col("query")).alias("labels"),
        F.col("ended_at").alias("ts"),
        F.sum("value").over(past).cast("double").alias("value"),
    )


def buffered_participants(spark: SparkSession, checkpoint: str) -> DataFrame:
    """How many participants sit in open sessions, and in how many matches, by the state store.

    Reads the last committed batch of a facts query's checkpoint; the query need not run.
    """
    operators = (
        spark.read.format("state-metadata")
        .load(checkpoint)
        .where(F.col("operatorProperties").contains('"open"'))
        .select("operatorId")
        .distinct()
        .collect()
    )
    if len(operators) != 1:
        raise ValueError(f"no roster buffer in {checkpoint}")
    sessions = (
        spark.read.format("statestore")
        .option("operatorId", operators[0]["operatorId"])
        .option("stateVarName", "open")
        .load(checkpoint)
    )
    return sessions.agg(
        F.coalesce(F.sum("list_element.held"), F.lit(0)).alias("buffered_participants"),
        F.count("list_element").alias("open_matches"),
    )
