"""Preparing recorded sessions for replay as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtide.functions.eventtime import EVENT_TIME_FORMAT, assembled_time
from viewtide.session import materialise

REPLAY_FILES = 30
EVENTS_PER_FILE = 150


def recent_events(
    events: DataFrame,
    time: str = "watch_date",
    tie_break: Sequence[str] = ("session_id",),
    n: int = REPLAY_FILES * EVENTS_PER_FILE,
) -> DataFrame:
    """The ``n`` latest events; ties go to the higher ``tie_break``."""
    return events.orderBy(F.desc(time), *[F.desc(c) for c in tie_break]).limit(n)


def with_replay_time(
    events: DataFrame,
    date: str = "watch_date",
    offsets: Sequence[str] = ("hour", "minute", "second"),
    into: str = "timestamp",
) -> DataFrame:
    """Assemble the event-time text from a date and its offset columns."""
    moment = assembled_time(date, *offsets)
    return events.withColumn(into, F.date_format(moment, EVENT_TIME_FORMAT)).drop(*offsets)


def ordered_slices(
    events: DataFrame,
    order_by: Sequence[str],
    size: int = EVENTS_PER_FILE,
    into: str = "slice",
    partitions: int | None = None,
) -> DataFrame:
    """Number the events in global order and cut them into slices of ``size``.

    A global ``row_number`` would sort everything in one task. Here the rows are
    range-partitioned and each task numbers its own; a partition's offset is the
    sum of the row counts before it, one small row per partition. A row's input
    position ends the sort key, so even a hot moment or a group of copies is
    spread over partitions. The numbered rows are written once, which keeps
    their placement fixed when executors are lost.
    """
    position = "__position"
    keyed = events.withColumn(position, F.monotonically_increasing_id())
    keys = [*order_by, position]
    ranged = (
        keyed.repartitionByRange(partitions, *keys) if partitions else keyed.repartitionByRange(*keys)
    )
    # The lower 33 bits of the generated id count the rows of a partition.
    numbered = (
        ranged.sortWithinPartitions(*keys)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
        .drop(position)
    )
    placed = materialise(numbered, "slices")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("__part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    # At most one row per partition, so the broadcast is bounded.
    number = F.col("offset") + F.col("__row")
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(into, F.floor(number / size))
        .withColumn(f"{into}_row", number % size)
        .drop("__part", "__row", "offset")
    )


def write_slices(sliced: DataFrame, path: str, into: str = "slice") -> None:
    """Write one JSON file per slice, rows in order, below ``path/slice=N``."""
    # Range partitioning keeps neighbouring slices together: a task writes
    # whole slices, in order, without a file per task and slice.
    (
        sliced.repartitionByRange(into)
        .sortWithinPartitions(into, f"{into}_row")
        .drop(f"{into}_row")
        .write.mode("overwrite")
        .partitionBy(into)
        .json(path)
    )
