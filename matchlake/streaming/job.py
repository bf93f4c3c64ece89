"""The facts job as one streaming query: lookup, roster gate, as-of rank, append."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchlake.functions.ranks import ROSTER_SIZE
from matchlake.functions.time import epoch_ms, floor_div
from matchlake.operators.asof import FACT_RANKS
from matchlake.operators.joins import fact_rows
from matchlake.operators.replay import QUIET_MS
from matchlake.schemas import FACT_COLUMNS, MATCH_FACTS
from matchlake.session import ROCKSDB_PROVIDER, use_utc
from matchlake.sources.cdc import PUBLISHED, decode, of_table
from matchlake.streaming import processors
from matchlake.streaming.processors import (
    EMITTED,
    LOOKED_UP,
    RANKED,
    PlayerLookup,
    RankAsOf,
    RosterGate,
)

# The processors travel with the query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(processors)

COMMIT_INTERVAL = "10 seconds"
#: Hash buckets of keys, which are what state is kept by.
LANES = 256
_LOG = ["arrival_ts", "offset"]

# What passes through the state steps as text.
PARTICIPANT = (
    "id bigint, player_id bigint, team int, hero_played string, kills int, deaths int, "
    "healing int, result string"
)
EVENT = (
    "map_name string, match_duration_seconds int, started_us bigint, ended_us bigint, "
    "winning_team int"
)
RANK = "rank_tier string, rank_division int, rank_points int"


def packed(ddl: str) -> Column:
    return F.to_json(F.struct(*[F.col(part.split()[0]) for part in ddl.split(", ")]))


Logs = DataFrame | Mapping[str, DataFrame]


def heartbeat(spark: SparkSession, log: Logs) -> Logs:
    """The log kept awake by a source that always has news but adds no rows.

    Timers only fire while batches run; after a restart an idle log would run none. Of logs by
    table one is enough.
    """
    if isinstance(log, Mapping):
        return {**log, "match_events": heartbeat(spark, log["match_events"])}
    beat = spark.readStream.format("rate").option("rowsPerSecond", 1).load().where("value < 0")
    return log.unionByName(
        beat.select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in log.schema.fields]
        )
    )


def facts_stream(
    log: Logs,
    quiet_ms: int = QUIET_MS,
    flush_ms: int | None = None,
    roster_size: int = ROSTER_SIZE,
    salts: int = 1,
    ttl_ms: int | None = None,
    on_error: str = "quarantine",
    lanes: int = LANES,
) -> DataFrame:
    """Facts of a streaming change log, in the table layout.

    ``log`` is one stream of all topics, which every table reads, or better a stream per table.
    ``salts`` deals every player's participants and facts over that many keys and repeats
    the player's versions for each; raise it when single players dominate the traffic.
    ``flush_ms`` is how long a match may be idle before its buffer is judged, and
    ``ttl_ms`` lets player and rank state expire. Keys are hashed into ``lanes``, which bound how
    many tasks a step can use; a checkpoint keeps the number it began with. Batch counts are
    observed as ``lookup``, ``join`` and ``rank``.
    """
    logs = log if isinstance(log, Mapping) else dict.fromkeys(PUBLISHED, log)
    spark = use_utc(logs["match_events"].sparkSession)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)

    def rows(table: str) -> DataFrame:
        decoded = decode(of_table(logs[table], table), table, on_error, keep=_LOG)
        return decoded.withColumns(
            {"arrival_ms": epoch_ms(F.col("arrival_ts")), "log_offset": F.col("offset")}
        ).drop(*_LOG)

    zero, text = F.lit(0).cast("bigint"), F.lit("")

    def keyed(df: DataFrame, kind: int, key: str, *salt: str, **columns: Column) -> DataFrame:
        """Records of one kind in the columns of a step; numbers are never null."""
        lane = F.pmod(F.xxhash64(key, *salt), F.lit(lanes)).cast("int")
        return df.select(
            lane.alias("lane"),
            F.lit(kind).alias("kind"),
            F.col(key).alias("id"),
            *[c.alias(n) for n, c in columns.items()],
            "arrival_ms",
            "log_offset",
        )

    def dealt(df: DataFrame, by: str) -> DataFrame:
        return df.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))

    def repeated(df: DataFrame) -> DataFrame:
        return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def step(records: DataFrame, processor, output: str) -> DataFrame:
        return records.groupBy("lane").transformWithStateInPandas(
            processor, output, "append", "ProcessingTime"
        )

    participants = keyed(
        dealt(rows("match_participants"), "id"),
        processors.PARTICIPANT, "player_id", "salt",
        match_id=F.col("match_id"), payload=packed(PARTICIPANT),
    )
    players = keyed(
        repeated(rows("players").withColumnRenamed("id", "player_id")),
        processors.PLAYER, "player_id", "salt",
        match_id=zero, payload=F.col("account_name"),
    )
    looked = step(participants.unionByName(players), PlayerLookup(ttl_ms), LOOKED_UP).observe(
        "lookup",
        F.count("name").alias("player_lookup_hits"),
        F.count_if(F.col("name").isNull()).alias("player_lookup_misses"),
    )
    rosters = keyed(
        looked.where(F.col("name").isNotNull()),
        processors.ROSTER, "match_id",
        payload=F.col("payload"), name=F.col("name"),
    )
    timed = rows("match_events").withColumns(
        {"started_us": F.unix_micros("started_at"), "ended_us": F.unix_micros("ended_at")}
    )
    events = keyed(
        timed.withColumnRenamed("id", "match_id"),
        processors.EVENT, "match_id",
        payload=packed(EVENT), name=text,
    )
    gate = RosterGate(quiet_ms, quiet_ms if flush_ms is None else flush_ms, roster_size)
    emitted = (
        step(rosters.unionByName(events), gate, EMITTED)
        .observe(
            "join",
            F.count_if(~F.col("is_fact") & F.col("complete")).alias("complete"),
            F.count_if(~F.col("is_fact") & ~F.col("complete")).alias("incomplete"),
        )
        .where("is_fact")
        .withColumns(
            {
                "p": F.from_json("payload", PARTICIPANT),
                "started_us": F.from_json("event", EVENT)["started_us"],
            }
        )
    )
    asking = keyed(
        dealt(
            emitted.select(
                "*", "p.player_id", "p.id", F.col("fire_ms").alias("arrival_ms"), zero.alias("log_offset")
            ),
            "id",
        ),
        processors.FACT, "player_id", "salt",
        match_id=F.col("match_id"), event=F.col("event"), payload=F.col("payload"),
        name=F.col("name"), at_ms=floor_div(F.col("started_us"), 1000),
    )
    ranks = keyed(
        repeated(rows("ranks")),
        processors.RANK, "player_id", "salt",
        match_id=zero, event=text, payload=packed(RANK), name=text,
        at_ms=epoch_ms(F.col("updated_at")),
    )
    ranked = (
        step(asking.unionByName(ranks), RankAsOf(ttl_ms), RANKED)
        .withColumn("found", F.col("rank").isNotNull())
        .observe(
            "rank",
            F.count_if("found").alias("rank_as_of_found"),
            F.count_if(~F.col("found")).alias("rank_as_of_defaulted"),
        )
    )
    facts = ranked.select(
        "match_id",
        F.col("name").alias("account_name"),
        "found",
        F.from_json("payload", PARTICIPANT).alias("p"),
        F.from_json("event", EVENT).alias("e"),
        F.from_json("rank", RANK).alias("r"),
    ).select("match_id", "account_name", "found", "p.*", "e.*", "r.*")
    defaults = {
        out: F.when(F.col("found"), F.col(col)).otherwise(F.lit(default))
        for col, (out, default) in FACT_RANKS.items()
    }
    return fact_rows(
        facts.withColumns(
            {
                "started_at": F.timestamp_micros("started_us"),
                "ended_at": F.timestamp_micros("ended_us"),
                **defaults,
            }
        )
    )


def append_files(
    facts: DataFrame, path: str, checkpoint: str, interval: str = COMMIT_INTERVAL
) -> StreamingQuery:
    """Append to a folder of Parquet files; each batch becomes visible as a whole."""
    return (
        facts.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(processingTime=interval)
        .start()
    )


def append_table(
    facts: DataFrame, table: str, checkpoint: str, interval: str = COMMIT_INTERVAL
) -> StreamingQuery:
    """Append to a catalog table, such as one made by ``ensure_table``."""
    return (
        facts.writeStream.option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(processingTime=interval)
        .toTable(table)
    )


def print_facts(facts: DataFrame, checkpoint: str, interval: str = COMMIT_INTERVAL):
    """Print every fact, for debugging; its own query with its own checkpoint."""
    return (
        facts.select(F.lit("MATCH_FACTS").alias("prefix"), *FACT_COLUMNS)
        .writeStream.format("console")
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(processingTime=interval)
        .start()
    )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The facts a streaming query has committed so far."""
    return spark.read.schema(MATCH_FACTS).parquet(path)
