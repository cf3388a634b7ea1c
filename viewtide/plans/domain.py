"""Engagement tables derived from the driver tables.

``customer``, ``part``, ``lineitem`` with ``orders``, and ``events`` play users,
items, sessions, reviews and the event stream. ``oracle.py`` states the same
views as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from viewtide.functions.eventtime import with_watch_month
from viewtide.session import scratch_path
from viewtide.sources.events import read_event_files

RAW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its footer is read for the schema only the first time."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    age = (
        F.when(key % 8 == 0, None)
        .when(key % 97 == 1, 110.0)
        .otherwise((18 + key % 50).cast("double"))
    )
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("user_id"),
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("subscription_plan"),
            F.col("r_name").alias("region"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("monthly_spend"),
            age.alias("age"),
            F.when(key % 40 != 0, F.col("c_name")).alias("email"),
        )
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return (
        table(spark, sf_dir, "part")
        .filter(size <= 48)
        .select(
            F.col("p_partkey").alias("movie_id"),
            F.col("p_name").alias("title"),
            F.col("p_type").alias("genre_primary"),
            F.col("p_brand").alias("content_type"),
            F.when(size <= 45, size.cast("double") / 5.0).alias("imdb_rating"),
            (size <= 25).alias("is_original"),
        )
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )


def watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return _lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("session_id"),
        F.col("l_linenumber").alias("session_seq"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        F.col("l_shipdate").alias("watch_date"),
        F.col("o_orderpriority").alias("device_type"),
        F.when(F.col("l_quantity") <= 46, F.col("l_quantity")).alias("watch_duration_minutes"),
        F.round(F.col("l_discount") * 1000, 0).alias("progress_percentage"),
        F.when(flag == "A", "completed")
        .when(flag == "R", "stopped")
        .otherwise("started")
        .alias("action"),
        F.when(F.col("l_linestatus") == "F", "SD").otherwise("4K").alias("quality"),
    )


def dated_watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_watch_month(watch(spark, sf_dir))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _lines(spark, sf_dir)
        .filter(F.col("l_returnflag") == "R")
        .select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("movie_id"),
            F.round(1 + F.col("l_tax") * 50, 1).alias("rating"),
        )
    )


def tastes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings that depend on who rates what, with some noise; ids are text."""
    user, item = F.col("o_custkey"), F.col("l_partkey")
    alike = F.when(user % 3 == item % 3, 2.0).otherwise(0.0)
    return (
        _lines(spark, sf_dir)
        .select(
            F.concat(F.lit("u"), user).alias("user_id"),
            F.concat(F.lit("m"), item).alias("movie_id"),
            F.round(1 + alike + F.col("l_tax") * 10, 1).alias("rating"),
        )
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a change of its user's attributes and state."""
    state = F.col("c_acctbal") + F.col("o_orderkey") % 1000 > 5000
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("changed_at"),
            F.col("o_orderkey").alias("change_id"),
            F.col("o_orderstatus").alias("country"),
            F.col("o_orderpriority").alias("subscription_plan"),
            F.col("c_acctbal").alias("monthly_spend"),
            state.alias("is_active"),
        )
    )


def raw_watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions with copies, missing users, NaN durations and an empty column."""
    sessions = watch(spark, sf_dir)
    # One scan: the seventh line of a session occurs twice.
    copies = F.when(F.col("session_seq") == 7, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    repeated = sessions.withColumn("copy", F.explode(copies)).drop("copy")
    duration = F.col("watch_duration_minutes")
    return repeated.select(
        F.when(F.col("session_id") % 50 != 0, F.concat(F.lit("u"), "user_id")).alias("user_id"),
        "movie_id",
        "session_id",
        "session_seq",
        "watch_date",
        F.when(duration == 46, float("nan")).otherwise(duration).alias("watch_duration_minutes"),
        "action",
        "quality",
        F.lit(None).cast("double").alias("unused"),
    )


def _choice(column: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (column % len(values) + 1).cast("int"))


def as_events(rows: DataFrame) -> DataFrame:
    """Domain events from rows of the ``events`` table, batch or stream."""
    key, kind = F.col("event_id"), F.col("event_type")
    return rows.select(
        key,
        F.col("ts").alias("event_time"),
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("movie_id"),
        F.when(kind == "purchase", "completed")
        .when(kind == "error", "stopped")
        .when(kind == "click", "paused")
        .when(kind != "signup", "started")
        .alias("action"),
        F.when(key % 10 != 0, F.col("value")).alias("progress_percentage"),
        F.col("value").alias("watch_duration_minutes"),
        _choice(key, "SD", "HD", "4K", "Ultra HD").alias("quality"),
        _choice(key, "TV", "Mobile", "Laptop").alias("device_type"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_events(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str, max_files: int = 1000) -> DataFrame:
    """The same events as a stream; watermarks need a zoned timestamp."""
    schema = table(spark, sf_dir, "events").schema
    # A glob, because a plain stream path must be a folder.
    rows = read_event_files(spark, f"{sf_dir}/events*.parquet", schema, max_files, "parquet")
    return as_events(rows.withColumn("ts", F.col("ts").cast("timestamp")))


#: Parts of the month in which the sliced stream comes, and how many parts some events are late.
SLICE_DAYS, LATE_SLICES, SLICES = 5, 3, 9
#: Events of the smallest slice for each of its files, and the most files of a slice.
FILE_ROWS, MOST_FILES = 20_000, 64


def event_slices(spark: SparkSession, sf_dir: str) -> str:
    """The events as files, as many a slice, in the order in which a stream is to read them.

    A slice has the events of five days; every 13th event comes three slices late. All slices
    have the same number of files, one where a slice is small.
    """
    rows = table(spark, sf_dir, "events")
    own = F.least(F.floor((F.dayofmonth("ts") - 1) / SLICE_DAYS), F.lit(SLICES - LATE_SLICES - 1))
    late = F.when(F.col("event_id") % 13 == 0, LATE_SLICES).otherwise(0)
    slices = [own + late == k for k in range(SLICES)]
    counts = rows.agg(*[F.count_if(inside).alias(f"n{k}") for k, inside in enumerate(slices)]).first()
    files = max(1, min(MOST_FILES, min(counts) // FILE_ROWS))
    path = scratch_path(spark, "slices")
    for inside in slices:
        # A file stream reads files in the order of their times.
        part = rows.filter(inside)
        part = part.coalesce(1) if files == 1 else part.repartition(files)
        part.write.mode("append").parquet(path)
    return path


def sliced_stream(spark: SparkSession, path: str, sf_dir: str) -> DataFrame:
    """The slices as a stream, one a batch."""
    schema = table(spark, sf_dir, "events").schema
    files = len(spark.read.schema(schema).parquet(path).inputFiles()) // SLICES
    rows = read_event_files(spark, path, schema, max(1, files), "parquet")
    return as_events(rows.withColumn("ts", F.col("ts").cast("timestamp")))
