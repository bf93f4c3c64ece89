"""Change logs: reading, encoding and decoding one JSON envelope per row change."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.schemas import NULLABLE, TABLES, struct
from matchlake.sources.offsets import topic_segments

# Topic prefix and the published tables, which are all of TABLES.
TOPIC_PREFIX = "dbserver1.public."
PUBLISHED = ["players", "ranks", "match_events", "match_participants"]

# What one trigger takes from a backlog, unless the caller says otherwise.
FILES_PER_TRIGGER = 100
OFFSETS_PER_TRIGGER = 5_000_000

LOG_SCHEMA = "topic string, `offset` bigint, arrival_ts timestamp, value string"
# An instant has a date, a time and a zone; a bare time or date names none.
INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def topic(table: str) -> str:
    if table not in PUBLISHED:
        raise ValueError(f"{table!r} is not a published table")
    return TOPIC_PREFIX + table


# --- reading -----------------------------------------------------------------


def read_log(spark: SparkSession, path: str, tables: Sequence[str] = PUBLISHED) -> DataFrame:
    """A stored change log as a batch; every table decoded from it reads all of it."""
    return published(spark.read.schema(LOG_SCHEMA).json(path), tables)


def read_logs(
    spark: SparkSession, path: str, tables: Sequence[str] = PUBLISHED
) -> dict[str, DataFrame]:
    """Logs stored with a folder per topic, by table: each table reads its own records alone."""
    return {t: read_log(spark, f"{path}/{topic(t)}", [t]) for t in tables}


def replay_log(
    spark: SparkSession,
    path: str,
    tables: Sequence[str] = PUBLISHED,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """A stored change log as a stream, oldest files first, so many files at a time.

    The query checkpoint remembers what was read, so a restart goes on from there.
    """
    reader = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
    return published(reader.json(path), tables)


def replay_logs(
    spark: SparkSession,
    path: str,
    tables: Sequence[str] = PUBLISHED,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> dict[str, DataFrame]:
    """``replay_log`` of a folder per topic, by table."""
    return {
        t: replay_log(spark, f"{path}/{topic(t)}", [t], files_per_trigger) for t in tables
    }


def kafka_log(
    spark: SparkSession,
    tables: Sequence[str] = PUBLISHED,
    servers: str | None = None,
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """The change topics on a broker; needs the Kafka connector package.

    A new query starts at the earliest offset, a restarted one at its checkpoint; a trigger
    takes ``OFFSETS_PER_TRIGGER`` records at most unless ``options`` say otherwise.
    """
    servers = servers or os.environ.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")
    source = spark.readStream if streaming else spark.read
    source = source.format("kafka").options(
        **{
            "kafka.bootstrap.servers": servers,
            "subscribe": ",".join(topic(t) for t in tables),
            "startingOffsets": "earliest",
            **({"maxOffsetsPerTrigger": str(OFFSETS_PER_TRIGGER)} if streaming else {}),
            **options,
        }
    )
    try:
        records = source.load()
    except AnalysisException as missing:
        raise RuntimeError(
            "add the spark-sql-kafka package to the session, or use replay_log"
        ) from missing
    return records.select(
        "topic",
        "offset",
        F.col("timestamp").alias("arrival_ts"),
        F.col("value").cast("string").alias("value"),
    )


def kafka_logs(
    spark: SparkSession, tables: Sequence[str] = PUBLISHED, **options
) -> dict[str, DataFrame]:
    """``kafka_log`` with a subscription of its own for every table."""
    return {t: kafka_log(spark, [t], **options) for t in tables}


def segment_log(
    spark: SparkSession,
    path: str,
    tables: Sequence[str] = PUBLISHED,
    streaming: bool = True,
    **options,
) -> DataFrame:
    """The change topics as segments with offsets, from a group's committed positions on.

    ``options`` are those of ``topic_segments``: group, starting and offsets_per_trigger.
    """
    return topic_segments(spark, path, [topic(t) for t in tables], streaming, **options)


def segment_logs(
    spark: SparkSession, path: str, tables: Sequence[str] = PUBLISHED, **options
) -> dict[str, DataFrame]:
    """``segment_log`` with a stream of its own for every table."""
    return {t: segment_log(spark, path, [t], **options) for t in tables}


def published(log: DataFrame, tables: Sequence[str] = PUBLISHED) -> DataFrame:
    """Only the records of the given published tables."""
    return log.where(F.col("topic").isin([topic(t) for t in tables]))


def of_table(log: DataFrame, table: str) -> DataFrame:
    return log.where(F.col("topic") == topic(table))


# --- encoding ----------------------------------------------------------------


def envelope(
    table: str, keep_nulls: bool = True, instead: Mapping[str, Column] | None = None
) -> Column:
    """The envelope of a typed row of ``table``; ``instead`` replaces values of fields."""
    fields = []
    for f in struct(TABLES[table]).fields:
        value = (instead or {}).get(f.name, F.col(f.name))
        if f.name not in (instead or {}) and isinstance(f.dataType, T.TimestampType):
            value = F.date_format(value, TIME_FORMAT)
        fields.append(value.alias(f.name))
    wrapped = F.struct(F.struct(F.struct(*fields).alias("after")).alias("payload"))
    return F.to_json(wrapped, {"ignoreNullFields": str(not keep_nulls).lower()})


# --- decoding ----------------------------------------------------------------


def unwrap(log: DataFrame, table: str) -> DataFrame:
    """Parse each record once: adds ``after`` (all text) and ``fate``.

    ``fate`` is row, delete, malformed, missing_field or bad_value: text in any field, nullable
    or not, that is no value of the field's type. The row image is taken from the payload, or
    from the top level where the log was written without a payload.
    """
    return _unwrapped(log, table).drop("_typed")


def _unwrapped(log: DataFrame, table: str) -> DataFrame:
    """``unwrap`` with the typed row in ``_typed``, so that each value is typed once."""
    fields = struct(TABLES[table]).fieldNames()
    image = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    schema = T.StructType(
        [
            T.StructField("payload", T.StructType([T.StructField("after", image)])),
            T.StructField("after", image),
            T.StructField("_corrupt", T.StringType()),
        ]
    )
    parsed = F.from_json(
        "value", schema, {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
    )
    # The one-element explodes keep later steps from parsing the text or typing a value again.
    opened = log.withColumn("_parsed", F.explode(F.array(parsed)))
    opened = opened.withColumn("after", F.coalesce("_parsed.payload.after", "_parsed.after"))
    values = [v.alias(n) for n, v in _typed(F.col("after"), table).items()]
    opened = opened.withColumn("_typed", F.explode(F.array(F.struct(*values))))
    typed = F.col("_typed")
    incomplete = _any(F.col("after")[f].isNull() for f in fields if f not in NULLABLE[table])
    unreadable = _any(F.col("after")[f].isNotNull() & typed[f].isNull() for f in fields)
    names = F.json_object_keys("value")
    enveloped = F.array_contains(names, "payload") | F.array_contains(names, "after")
    fate = (
        F.when(F.col("value").isNull(), "delete")
        .when(F.col("_parsed._corrupt").isNotNull(), "malformed")
        .when(
            F.col("after").isNull(),
            F.when(F.coalesce(enveloped, F.lit(False)), "delete").otherwise("malformed"),
        )
        .when(unreadable, "bad_value")
        .when(incomplete, "missing_field")
        .otherwise("row")
    )
    return opened.withColumn("fate", fate).drop("_parsed")


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(Column.__or__, conditions)


def drop_deletes(unwrapped: DataFrame) -> DataFrame:
    """Deletes carry no new row image and never retract anything."""
    return unwrapped.where(F.col("fate") != "delete")


def decode(
    log: DataFrame,
    table: str,
    on_error: str = "quarantine",
    null_text: str = "null",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed rows of one table's change log, with the log columns in ``keep``.

    ``on_error='quarantine'`` leaves bad records to ``rejects``; ``'fail'`` stops the job
    at the first one. ``null_text='literal'`` turns absent required text into ``'null'``.
    """
    if on_error not in ("quarantine", "fail"):
        raise ValueError(f"on_error: {on_error!r}")
    if null_text not in ("null", "literal"):
        raise ValueError(f"null_text: {null_text!r}")
    unwrapped = drop_deletes(_unwrapped(log, table))
    good = F.col("fate") == "row"
    if null_text == "literal":
        good = good | (F.col("fate") == "missing_field") & _keyed(table)
    if on_error == "fail":
        stop = F.raise_error(
            F.concat(F.lit(f"bad {table} record: "), F.coalesce("value", F.lit("")))
        ).cast("boolean")
        good = F.when(good, F.lit(True)).otherwise(stop)
    literal = [
        f.name
        for f in struct(TABLES[table]).fields
        if null_text == "literal" and isinstance(f.dataType, T.StringType) and f.name != "result"
    ]
    typed = F.col("_typed")
    return unwrapped.where(good).select(
        *keep,
        *[
            (F.coalesce(typed[f], F.lit("null")) if f in literal else typed[f]).alias(f)
            for f in struct(TABLES[table]).fieldNames()
        ],
    )


def rejects(log: DataFrame, table: str) -> DataFrame:
    """The records ``decode`` leaves out as bad, with the reason."""
    return (
        unwrap(log, table)
        .where(F.col("fate").isin("malformed", "missing_field", "bad_value"))
        .select("topic", "offset", F.col("fate").alias("reason"), "value")
    )


def _typed(after: Column, table: str) -> dict[str, Column]:
    return {f.name: _scalar(after[f.name], f) for f in struct(TABLES[table]).fields}


def _scalar(text: Column, f: T.StructField) -> Column:
    """Coerce one JSON scalar, whatever its JSON type, to the column type."""
    if isinstance(f.dataType, T.StringType):
        return text
    if isinstance(f.dataType, T.TimestampType):
        return F.when(text.rlike(INSTANT), text.try_cast("timestamp"))
    flag = F.when(text == "true", 1).when(text == "false", 0)
    whole = F.coalesce(
        text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"), flag
    )
    return whole if isinstance(f.dataType, T.LongType) else whole.try_cast(f.dataType)


def _keyed(table: str) -> Column:
    """All required fields but text are present."""
    return reduce(
        Column.__and__,
        [
            F.col("_typed")[f.name].isNotNull()
            for f in struct(TABLES[table]).fields
            if f.name not in NULLABLE[table] and not isinstance(f.dataType, T.StringType)
        ],
    )
