"""Starting, running and observing streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StructField, StructType

from viewtide.sinks.ledger import Ledger

TRIGGER_INTERVAL = "10 seconds"
#: A batch as soon as the one before has ended.
AT_ONCE = "0 seconds"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: State on executor disks; each trigger uploads its changes, not all state.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@dataclass(frozen=True)
class StreamSettings:
    """How a query runs.

    ``checkpoint`` names a folder shared by all executors: offsets and state
    live there, and a restart continues from it. ``interval`` is the processing
    time trigger; None processes what is available and stops. The number of
    state partitions is fixed by the first run of a checkpoint, so size it for
    the whole life of the query. ``large_state`` keeps state in RocksDB instead
    of executor memory.
    """

    checkpoint: str
    interval: str | None = TRIGGER_INTERVAL
    state_partitions: int | None = None
    large_state: bool = False


@contextmanager
def _session_settings(spark: SparkSession, settings: StreamSettings) -> Iterator[None]:
    """Settings a query copies from the session when it starts."""
    wanted = {}
    if settings.state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(settings.state_partitions)
    if settings.large_state:
        wanted |= LARGE_STATE
    previous = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in previous.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _start(writer: DataStreamWriter, spark: SparkSession, settings: StreamSettings) -> StreamingQuery:
    writer = writer.option("checkpointLocation", settings.checkpoint)
    if settings.interval:
        writer = writer.trigger(processingTime=settings.interval)
    else:
        writer = writer.trigger(availableNow=True)
    with _session_settings(spark, settings):
        return writer.start()


def to_memory(
    df: DataFrame, name: str, settings: StreamSettings, mode: str = "complete"
) -> StreamingQuery:
    """A named in-memory table, readable by SQL.

    The rows are held by the driver: only for monitoring small, bounded
    results. :func:`to_batches` writes a table instead. A memory table in
    complete mode can restart from its checkpoint; in append mode it cannot.
    """
    writer = df.writeStream.queryName(name).format("memory").outputMode(mode)
    return _start(writer, df.sparkSession, settings)


def to_files(
    df: DataFrame,
    path: str,
    settings: StreamSettings,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append rows to files, each exactly once.

    A windowed aggregate emits a window when the watermark passes its end; the
    state is then dropped, and later events for it are ignored. The last
    windows stay open until newer events arrive.
    """
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(writer, df.sparkSession, settings)


def append_to_end(
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    path: str,
    settings: StreamSettings,
    time: str = "event_time",
    ahead: timedelta = timedelta(days=366),
) -> None:
    """Run a bounded event stream into files, its last windows included.

    Append mode emits a window when later events move the watermark past it, so the end of
    a bounded source would stay in state. The stream therefore reads a second folder beside
    ``source``. When all events are through, one mark is put there: a row with nothing but a
    time far ahead. The query, which goes on until then, reads it and closes every window
    of the events; the mark's own window stays open and is never written. ``build`` makes
    the windowed aggregate from the events; ``settings`` must not keep a trigger interval.
    """
    if settings.interval:
        raise ValueError("a run to the end processes what is available: set interval=None")
    spark = source.sparkSession
    # A mark leaves every column but its time empty.
    schema = StructType([StructField(f.name, f.dataType) for f in source.schema])
    marks = f"{settings.checkpoint}-marks"
    spark.createDataFrame([], schema).write.mode("ignore").parquet(marks)
    marked = source.unionByName(spark.readStream.schema(schema).parquet(marks))
    query = to_files(build(marked), path, replace(settings, interval=AT_ONCE))
    try:
        query.processAllAvailable()
        latest = [p["eventTime"].get("max") for p in query.recentProgress]
        if any(latest):
            end = datetime.fromisoformat(max(filter(None, latest)).replace("Z", "+00:00"))
            row = {name: None for name in schema.fieldNames()} | {time: end + ahead}
            spark.createDataFrame([tuple(row.values())], schema).write.mode("append").parquet(marks)
            query.processAllAvailable()
    finally:
        query.stop()


Target = Callable[[DataFrame, int], None]


def batch_writer(targets: Mapping[str, Target], done: Ledger | None = None) -> Target:
    """A ``foreachBatch`` function that hands each batch to every target.

    Empty batches are skipped. The batch is kept while the targets write it, so
    it is computed once however many there are. A batch that fails is run again
    after a restart, so a target must give the same result when repeated:
    replace a table, or write with :func:`add_batch`. With ``done``, a target
    that has ended is noted and not run again for that batch; then only a crash
    between a target's own end and its note repeats it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        waiting = {
            name: target
            for name, target in targets.items()
            if done is None or done.get(f"{batch_id}-{name}") is None
        }
        if not waiting:
            return
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                for name, target in waiting.items():
                    target(batch, batch_id)
                    if done is not None:
                        done.put(f"{batch_id}-{name}")
                        # A batch before the last cannot be run again.
                        done.forget(f"{batch_id - 2}-{name}")
        finally:
            batch.unpersist()

    return write


def add_batch(
    path: str, transform: Callable[[DataFrame], DataFrame] | None = None, fmt: str = "parquet"
) -> Target:
    """A target that keeps every batch, each in its own folder.

    A repeated batch replaces its folder, so no row is added twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        rows.write.format(fmt).mode("overwrite").save(f"{path}/batch={batch_id}")

    return write


def to_batches(
    df: DataFrame,
    targets: Mapping[str, Target],
    settings: StreamSettings,
    mode: str = "complete",
    once_each: bool = False,
) -> StreamingQuery:
    """One query feeding several targets on each trigger.

    ``once_each`` notes beside the checkpoint which targets have had a batch, so that a
    restart gives it to the others only.

    Complete mode hands over all windows every time: it keeps them in state and
    drops no late event, so it suits results that stay small. Sorting belongs
    in a target: there it orders one batch instead of the stream's plan.
    """
    done = Ledger(df.sparkSession, f"{settings.checkpoint}-targets") if once_each else None
    writer = df.writeStream.outputMode(mode).foreachBatch(batch_writer(targets, done))
    return _start(writer, df.sparkSession, settings)


def finish(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait for a query to end, and stop it on any error, interrupt or timeout."""
    try:
        query.awaitTermination(timeout) if timeout else query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()
    return query


def finish_all(spark: SparkSession, queries: Sequence[StreamingQuery]) -> None:
    """Wait for several queries; when one fails or is interrupted, stop them all."""
    try:
        # Errors of queries that ended earlier, which may be others, are not raised again.
        spark.streams.resetTerminated()
        while any(query.isActive for query in queries):
            for query in queries:
                if not query.isActive:
                    query.awaitTermination()
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for query in queries:
            # Raises the error of a query that ended before it was awaited.
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def query_status(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Identity and state of a query, with its batches and rows so far.

    Built from the few progress records the driver keeps, not from data.
    """
    progress = query.recentProgress
    row = (
        str(query.id),
        query.name,
        query.isActive,
        len(progress),
        sum(1 for p in progress if p["numInputRows"] > 0),
        sum(p["numInputRows"] for p in progress),
        progress[-1]["numInputRows"] if progress else 0,
    )
    return spark.createDataFrame(
        [row],
        "query_id STRING, query_name STRING, is_active BOOLEAN, batches BIGINT, "
        "batches_with_rows BIGINT, input_rows BIGINT, last_batch_rows BIGINT",
    )


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch: rows read, state size, watermark."""
    rows = [
        (
            p["batchId"],
            p["numInputRows"],
            sum(s["numRowsTotal"] for s in p["stateOperators"]),
            sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]),
            p["eventTime"].get("watermark"),
        )
        for p in query.recentProgress
    ]
    table = spark.createDataFrame(
        rows,
        "batch_id BIGINT, input_rows BIGINT, state_rows BIGINT, late_rows_dropped BIGINT, "
        "watermark STRING",
    )
    return table.withColumn("watermark", F.try_to_timestamp("watermark"))
