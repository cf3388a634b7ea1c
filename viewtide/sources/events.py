"""Event streams: JSON files, a message topic, decoding and validation."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from viewtide.functions.eventtime import parsed_time
from viewtide.functions.missing import missing, nan_to_null
from viewtide.schemas import WATCH_EVENT


def read_event_files(
    spark: SparkSession,
    path: str,
    schema: StructType = WATCH_EVENT,
    max_files: int | None = 1,
    fmt: str = "json",
) -> DataFrame:
    """A rate-limited file stream. NaN tokens arrive as NULL for JSON input."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    events = reader.load(path)
    return nan_to_null(events) if fmt == "json" else events


def topic_options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    Offsets that the broker no longer has stop the query, unless told otherwise.
    ``min_partitions`` splits hot topic partitions over several tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_event_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """The raw envelope of a topic; needs Spark's Kafka connector on the classpath."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **options)).load()


def _decoded(schema: StructType, column: str) -> Column:
    """The fields of each message as columns.

    Parsing sits in a generator, so filters on the fields stay above it. In a
    plain projection they would be pushed down and parse again per field.
    """
    return F.inline(F.array(F.from_json(F.col(column).cast("string"), schema)))


def decode_json(
    envelope: DataFrame, schema: StructType = WATCH_EVENT, column: str = "value"
) -> DataFrame:
    """Bytes or text to typed columns.

    A malformed message yields a row of NULLs, a bad field a NULL field, and
    NaN tokens become NULL.
    """
    return nan_to_null(envelope.select(_decoded(schema, column)))


def encode_json(df: DataFrame, column: str = "value") -> DataFrame:
    """One JSON message per row, without a key; ready for a Kafka write."""
    return df.select(F.to_json(F.struct(*[F.col(name) for name in df.columns])).alias(column))


def validate_events(
    envelope: DataFrame,
    required: Iterable[str] = ("session_id", "user_id", "movie_id"),
    schema: StructType = WATCH_EVENT,
    column: str = "value",
    time_column: str | None = "timestamp",
) -> DataFrame:
    """Decode every message and say why it is unusable, if it is.

    Adds ``event_time``, keeps the raw text, and sets ``reject_reason`` to
    ``malformed``, ``missing <field>``, ``bad <time field>`` or NULL. All rows
    stay; :func:`split_valid` parts them.
    """
    raw = F.col(column).cast("string").alias("raw")
    parsed = envelope.select(raw).select("raw", _decoded(schema, "raw"))
    events = nan_to_null(parsed)
    empty = reduce(lambda a, b: a & b, [missing(events, field) for field in schema.fieldNames()])
    reasons = [F.when(empty, "malformed")]
    reasons += [F.when(missing(events, field), f"missing {field}") for field in required]
    if time_column:
        events = events.withColumn("event_time", parsed_time(events, time_column))
        reasons.append(F.when(F.col("event_time").isNull(), f"bad {time_column}"))
    return events.withColumn("reject_reason", F.coalesce(*reasons).cast(StringType()))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantined)``: typed rows, and raw text with its reason."""
    valid = validated.filter(F.col("reject_reason").isNull()).drop("raw", "reject_reason")
    rejected = validated.filter(F.col("reject_reason").isNotNull()).select("raw", "reject_reason")
    return valid, rejected
