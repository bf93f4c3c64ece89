"""The fact table in the catalog."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.schemas import FACT_COLUMNS, MATCH_FACTS

DATABASE = "demo"
TABLE = "match_facts"
FACTS = f"{DATABASE}.{TABLE}"
DAY = "started_on"


def ensure_table(
    spark: SparkSession,
    name: str = FACTS,
    schema: str = MATCH_FACTS,
    provider: str = "parquet",
    by_day: bool = False,
) -> None:
    """Create the database and table unless they exist.

    ``provider`` may name any installed table format, for example ``iceberg``. ``by_day``
    partitions a large table by the extra column ``started_on``, so that reports over a
    period read that period only.
    """
    database = name.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns, layout = schema, ""
    if by_day:
        columns, layout = f"{schema}, {DAY} date", f"PARTITIONED BY ({DAY})"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider} {layout}")


def append_facts(facts: DataFrame, name: str = FACTS) -> None:
    """Append a batch; the columns go by position, as the table declares them.

    For a table by day, rows are first gathered into files of sensible size per day, which
    also splits a day that dominates the batch.
    """
    rows = facts.select(*FACT_COLUMNS)
    if DAY in facts.sparkSession.table(name).columns:
        rows = rows.withColumn(DAY, F.col("started_at").cast("date")).hint("rebalance", DAY)
    rows.write.mode("append").insertInto(name)


def read_facts(spark: SparkSession, name: str = FACTS) -> DataFrame:
    return spark.table(name)


def ready(spark: SparkSession, name: str = FACTS) -> bool:
    """Whether at least one fact has landed; a missing table counts as none."""
    try:
        return not spark.table(name).isEmpty()
    except AnalysisException:
        return False
