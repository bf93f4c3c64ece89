"""The shared test tables as the four source tables and their logs."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions.ranks import ROSTER_SIZE
from matchlake.functions.time import floor_div, from_ms
from matchlake.operators.rank_history import rank_updates
from matchlake.operators.skew import (
    ROWS_PER_TASK,
    HotKeys,
    Scan,
    find_all_hot_keys,
    find_hot_keys,
    running,
)
from matchlake.schemas import KEYS
from matchlake.session import use_utc
from matchlake.sources.cdc import PUBLISHED, envelope, topic

CYCLE_MS = 20_000
UNKNOWN = 1_000_000_000


@dataclass(frozen=True)
class Inputs:
    """Source tables bound to one folder of Parquet files."""

    spark: SparkSession
    folder: str
    rows_per_task: int = ROWS_PER_TASK

    def read(self, table: str) -> DataFrame:
        return use_utc(self.spark).read.parquet(f"{self.folder}/{table}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        """Twelve consecutive events make a match."""
        return self.read("events").select(
            "event_id",
            floor_div(F.col("event_id"), ROSTER_SIZE).alias("match_id"),
            (F.col("event_id") % ROSTER_SIZE).cast("int").alias("slot"),
            F.col("ts").cast("timestamp").alias("ts"),
            "user_id",
            "event_type",
            "value",
        )

    @cached_property
    def players(self) -> DataFrame:
        customers = self.read("customer")
        key = F.col("c_custkey")
        created = F.timestamp_seconds(F.lit(1_672_531_200) + key * 60)
        closed = key % 10 == 0
        return customers.select(
            key.alias("id"),
            F.col("c_name").alias("account_name"),
            F.concat("c_name", F.lit("@mail.test")).alias("email"),
            created.alias("created_at"),
            F.when(closed, "closed").otherwise("active").alias("account_status"),
            F.when(closed, F.timestamp_seconds(F.lit(1_672_617_600) + key * 60)).alias(
                "deleted_at"
            ),
        )

    @cached_property
    def match_events(self) -> DataFrame:
        """A match starts when the one before it ended.

        Each event counts for its own match and, as an end time, for the next one.
        """
        own = F.struct(
            F.col("match_id").alias("id"),
            F.col("ts").alias("ts"),
            F.lit(None).cast("timestamp").alias("before"),
        )
        following = F.struct(
            (F.col("match_id") + 1).alias("id"),
            F.lit(None).cast("timestamp").alias("ts"),
            F.col("ts").alias("before"),
        )
        spans = (
            self.events.select(F.explode(F.array(own, following)).alias("e"))
            .select("e.*")
            .groupBy("id")
            .agg(
                F.min("ts").alias("first"),
                F.max("ts").alias("ended_at"),
                F.max("before").alias("before"),
            )
            .where(F.col("ended_at").isNotNull())
        )
        return spans.select(
            "id",
            F.concat(F.lit("map_"), (F.col("id") % 7).cast("string")).alias("map_name"),
            (300 + (F.col("id") * 7919) % 901).cast("int").alias("match_duration_seconds"),
            F.coalesce("before", "first").alias("started_at"),
            "ended_at",
            (F.col("id") % 2).cast("int").alias("winning_team"),
        )

    @cached_property
    def match_participants(self) -> DataFrame:
        key = F.col("event_id")
        team = F.when(F.col("slot") < 6, 0).otherwise(1)
        return self.events.select(
            key.alias("id"),
            "match_id",
            player_of(F.col("user_id")).alias("player_id"),
            team.alias("team"),
            F.concat("event_type", F.lit("_"), (key % 10).cast("string")).alias(
                "hero_played"
            ),
            F.when(key % 17 != 0, F.floor("value").cast("int") % 41).alias("kills"),
            (key % 21).cast("int").alias("deaths"),
            ((key * 37) % 10001).cast("int").alias("healing"),
            F.when(team == F.col("match_id") % 2, "win").otherwise("loss").alias("result"),
        )

    @cached_property
    def results(self) -> DataFrame:
        """One row per finished participation, in time order ``updated_at, seq``."""
        ends = self.match_events.select(
            F.col("id").alias("match_id"),
            F.date_trunc("millisecond", "ended_at").alias("updated_at"),
        )
        return (
            self.match_participants.select(
                "player_id", "match_id", F.col("id").alias("seq"), "result"
            )
            .join(ends, "match_id")
            .drop("match_id")
        )

    @cached_property
    def ranks(self) -> DataFrame:
        """Every version of every player's rank row."""
        return rank_updates(self.results, self.hot_players)

    @cached_property
    def _hot(self) -> list[HotKeys]:
        keys = [["player_id"], ["match_id"]]
        return find_all_hot_keys(self.match_participants, keys, self.rows_per_task)

    @property
    def hot_players(self) -> HotKeys:
        return self._hot[0]

    @property
    def hot_matches(self) -> HotKeys:
        return self._hot[1]

    # --- arrival clock, in milliseconds ---

    @cached_property
    def player_log(self) -> DataFrame:
        """First versions early on; another name for even ids later."""
        key = F.col("id")
        at = (key * 7919) % 600_000

        def version(n: int, arrival_ms: Column) -> Column:
            name = F.col("account_name") if n == 0 else F.concat("account_name", F.lit(f"#{n}"))
            return F.struct(
                arrival_ms.alias("arrival_ms"),
                (key * 4 + n).cast("bigint").alias("offset"),
                name.alias("name"),
            )

        # Every third player is renamed within the millisecond of the first version.
        versions = F.array_compact(
            F.array(
                version(0, at),
                F.when(key % 3 == 0, version(1, at)),
                F.when(key % 2 == 0, version(2, 9_000_000 + key)),
            )
        )
        return (
            self.players.withColumn("_v", F.explode(versions))
            .withColumns(
                {
                    "account_name": F.col("_v.name"),
                    "arrival_ts": from_ms(F.col("_v.arrival_ms")),
                    "offset": F.col("_v.offset"),
                }
            )
            .drop("_v")
        )

    @cached_property
    def participant_log(self) -> DataFrame:
        key = F.col("id")
        arrival = F.col("match_id") * CYCLE_MS + (key * key * 31 + key * 7919) % 9000
        return self.match_participants.withColumns(
            {"arrival_ts": from_ms(arrival), "offset": key}
        )

    @cached_property
    def event_log(self) -> DataFrame:
        """Match events; every fifth one is written twice within its millisecond."""
        key = F.col("id")
        again = F.struct(
            (key * 2 + 1).alias("offset"), F.concat("map_name", F.lit("#1")).alias("map_name")
        )
        once = F.struct((key * 2).alias("offset"), F.col("map_name"))
        versions = F.array_compact(F.array(once, F.when(key % 5 == 0, again)))
        return self.match_events.withColumn("_v", F.explode(versions)).withColumns(
            {
                "map_name": F.col("_v.map_name"),
                "offset": F.col("_v.offset"),
                "arrival_ts": from_ms(key * CYCLE_MS + 6000),
            }
        ).drop("_v")

    @cached_property
    def rank_log(self) -> DataFrame:
        seq = F.col("seq")
        arrival = floor_div(seq, ROSTER_SIZE) * CYCLE_MS + 9000 + (seq % 23) * 2000
        return self.ranks.withColumns({"arrival_ts": from_ms(arrival), "offset": seq})

    @cached_property
    def arrival_log(self) -> DataFrame:
        """The four logs above as change records with their arrival times."""
        logs = {
            "players": self.player_log,
            "match_participants": self.participant_log,
            "match_events": self.event_log,
            "ranks": self.rank_log,
        }
        parts = [
            log.select(
                F.lit(topic(table)).alias("topic"),
                "offset",
                "arrival_ts",
                envelope(table).alias("value"),
            )
            for table, log in logs.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    # --- change log ---

    def cdc_log(self, *tables: str) -> DataFrame:
        """Tables as change records, with deletes, tombstones and bad records.

        A row with key k owns the offsets 6k (the row), 6k+1 (a delete), 6k+2 (a tombstone),
        6k+3 (cut-off text), 6k+4 (a row image without its required columns) and 6k+5 (a field
        whose text is no value of its type).
        """
        parts = [
            _change_records(getattr(self, table), table, "seq" if table == "ranks" else "id")
            for table in tables or PUBLISHED
        ]
        return reduce(DataFrame.unionByName, parts)

    # --- metric samples ---

    @cached_property
    def samples(self) -> DataFrame:
        """Per event one gauge and one counter sample; counters restart every 50 samples."""
        series = self.events.select(
            "event_type",
            (F.col("user_id") % 5).cast("string").alias("shard"),
            "ts",
            "value",
            "event_id",
            F.lit(1).alias("one"),
        )
        keys = ["event_type", "shard"]
        numbered = running(
            series,
            keys,
            "event_id",
            "one",
            {"n": Scan("sum", F.col("one"))},
            self.hot_series,
            spread=True,
        )
        pair = F.array(
            F.struct(F.lit(GAUGE).alias("name"), F.col("value").alias("value")),
            F.struct(
                F.lit(COUNTER).alias("name"),
                ((F.col("n") - 1) % 50).cast("double").alias("value"),
            ),
        )
        return numbered.withColumn("_s", F.explode(pair)).select(
            "_s.name",
            F.create_map(
                F.lit("event_type"), "event_type", F.lit("shard"), "shard"
            ).alias("labels"),
            "ts",
            "_s.value",
        )

    @cached_property
    def hot_series(self) -> HotKeys:
        shard = (F.col("user_id") % 5).cast("string").alias("shard")
        series = self.events.select("event_type", shard)
        return find_hot_keys(series, ["event_type", "shard"], self.rows_per_task)

    @cached_property
    def alert_samples(self) -> DataFrame:
        """Series scraped about every 15 seconds, one event to a scrape of a series.

        Every series has a second of its own within the scrape, and each scrape drifts by less
        than another one. Series ``GAPPY`` is held up for 25 scrapes of each 97: their samples
        come 25 scrapes and a second later, which leaves a gap above the lookback.
        """
        n = len(ALERT_SERIES)
        scrape = floor_div(F.col("event_id"), n)
        table = F.array(
            *[
                F.struct(
                    F.lit(name).alias("name"),
                    F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]).alias(
                        "labels"
                    ),
                )
                for name, labels, _ in ALERT_SERIES
            ]
        )
        noise = F.floor("value")
        values = [shape(scrape, noise).cast("double") for _, _, shape in ALERT_SERIES]
        which = F.col("event_id") % n
        value = F.when(which == 0, values[0])
        for i in range(1, n):
            value = value.when(which == i, values[i])
        drift = which * 7 % 15 * 1000 + F.col("event_id") * 137 % 900
        held_up = (which == GAPPY) & (scrape % 97).between(50, 74)
        delay = F.when(held_up, 25 * 15_000 + 1000).otherwise(0)
        at = F.lit(1_704_067_200_000) + scrape * 15_000 + drift + delay
        return (
            self.events.select(
                F.get(table, which.cast("int")).alias("s"),
                F.timestamp_millis(at).alias("ts"),
                value.alias("value"),
            )
            .select("s.*", "ts", "value")
        )


# The series of checkpoint durations, whose target is down at times.
GAPPY = 8
GAUGE = "session_value"
COUNTER = "session_total"


def _in_turn(scrape, length, value, rest=0):
    """``value`` in every second stretch of ``length`` scrapes."""
    return F.when(floor_div(scrape, length) % 2 == 1, value).otherwise(rest)


# Metric, labels and the value of a sample as a function of scrape number and noise.
ALERT_SERIES = [
    (
        "kafka_controller_kafkacontroller_value",
        {"name": "OfflinePartitionsCount"},
        lambda s, n: F.when(n > 200, 1).otherwise(0),
    ),
    (
        "kafka_consumergroup_lag",
        {"topic": "dbserver1.public.match_events", "partition": "0", "consumergroup": "facts"},
        lambda s, n: s % 200 * 100 + n,
    ),
    (
        "kafka_consumergroup_lag",
        {"topic": "dbserver1.public.ranks", "partition": "0", "consumergroup": "facts"},
        lambda s, n: s % 200 * 50 + n,
    ),
    (
        "kafka_consumergroup_lag",
        {"topic": "dbserver1.public.match_events", "partition": "1", "consumergroup": "facts"},
        lambda s, n: n,
    ),
    (
        "flink_jobmanager_job_numberOfFailedCheckpoints",
        {"job": "facts"},
        lambda s, n: floor_div(s * s, 500) % 50,
    ),
    (
        "flink_jobmanager_job_fullRestarts",
        {"job": "facts"},
        lambda s, n: floor_div(s, 35) % 7,
    ),
    (
        "pg_debezium_slot_active",
        {"slot": "lake"},
        lambda s, n: F.when(s % 30 < 8, 0).otherwise(1),
    ),
    (
        "kafka_server_replicamanager_value",
        {"name": "UnderReplicatedPartitions"},
        lambda s, n: F.when(n > 150, 1).otherwise(0),
    ),
    (
        "flink_jobmanager_job_lastCheckpointDuration",
        {"job": "facts"},
        lambda s, n: _in_turn(s, 40, 12_000 + n, n),
    ),
    (
        "flink_taskmanager_job_task_backPressuredTimeMsPerSecond",
        {"task_name": "MatchJoin", "subtask": "0"},
        lambda s, n: _in_turn(s, 100, 450 + n % 50, n % 50),
    ),
    (
        "flink_taskmanager_job_task_backPressuredTimeMsPerSecond",
        {"task_name": "MatchJoin", "subtask": "1"},
        lambda s, n: _in_turn(s, 100, 100 + n, n % 50),
    ),
    (
        "flink_taskmanager_job_task_backPressuredTimeMsPerSecond",
        {"task_name": "Compaction", "subtask": "0"},
        lambda s, n: 900 + n,
    ),
    (
        "flink_taskmanager_Status_JVM_Memory_Heap_Used",
        {"tm": "0"},
        lambda s, n: _in_turn(s, 60, 900 + n % 50, 600),
    ),
    (
        "flink_taskmanager_Status_JVM_Memory_Heap_Max",
        {"tm": "0"},
        lambda s, n: F.lit(1000),
    ),
    (
        "debezium_lake_millisecondsbehindsource",
        {"table": "ranks"},
        lambda s, n: _in_turn(s, 30, 6000 + n, n),
    ),
    (
        "debezium_lake_millisecondsbehindsource",
        {"table": "players"},
        lambda s, n: n * 20,
    ),
    (
        "flink_taskmanager_job_task_operator_join_incomplete",
        {"subtask": "0"},
        lambda s, n: F.least(s % 150, F.lit(60)),
    ),
    (
        "kafka_controller_kafkacontroller_value",
        {"name": "ActiveControllerCount"},
        lambda s, n: F.lit(1),
    ),
    (
        "kafka_consumergroup_lag",
        {"topic": "audit", "partition": "0", "consumergroup": "facts"},
        lambda s, n: s * 1000,
    ),
    ("up", {"job": "kafka"}, lambda s, n: F.lit(1)),
    (
        "kafka_consumergroup_lag",
        {"topic": "dbserver1.public.players", "partition": "0", "consumergroup": "other"},
        lambda s, n: s * 1000,
    ),
]


#: A field of each table, nullable or not, with text that is no value of its type.
BAD_VALUES = {
    "players": ("deleted_at", "garbage"),
    "ranks": ("updated_at", "10:00"),
    "match_events": ("started_at", "2026-01-15"),
    "match_participants": ("kills", "abc"),
}


def player_of(user: Column) -> Column:
    """Every eleventh user is no known player."""
    return F.when(user % 11 == 0, user + UNKNOWN).otherwise(user)


def _change_records(df: DataFrame, table: str, key: str) -> DataFrame:
    k, name = F.col(key), KEYS[table]
    every = [(0, 1), (1, 50), (2, 61), (3, 97), (4, 89), (5, 83)]
    kinds = F.array(*[F.when(k % n == 0, kind) for kind, n in every])
    whole = F.when(k % 2 == 0, envelope(table)).otherwise(envelope(table, keep_nulls=False))
    text = k.cast("string")
    kind = F.col("kind")
    return df.withColumn("kind", F.explode(F.array_compact(kinds))).select(
        F.lit(topic(table)).alias("topic"),
        (k * len(every) + kind).alias("offset"),
        F.when(kind == 0, whole)
        .when(kind == 1, '{"payload":{"after":null}}')
        .when(kind == 3, F.concat(F.lit('{"payload":{"after":{"id":'), text))
        .when(kind == 4, F.concat(F.lit(f'{{"payload":{{"after":{{"{name}":'), text, F.lit("}}}")))
        .when(kind == 5, envelope(table, instead={f: F.lit(v) for f, v in [BAD_VALUES[table]]}))
        .alias("value"),
    )


def bind(spark: SparkSession, folder: str, rows_per_task: int = ROWS_PER_TASK) -> Inputs:
    return Inputs(use_utc(spark), folder, rows_per_task)
