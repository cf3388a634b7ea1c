"""Tables in partitions that are replaced one by one, with readers on whole versions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from hashlib import md5
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from viewtide.sinks.ledger import Ledger

CURRENT = "current"
NO_VALUE = "null"


def _named(column: Column) -> Column:
    """A partition's name: its value as text behind a sign, so that NULL is told apart."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(NO_VALUE))


def _name(value: str | None) -> str:
    return NO_VALUE if value is None else f"={value}"


def _folder(name: str) -> str:
    """The folder of a partition; a digest, as values may hold what paths may not."""
    return md5(name.encode(), usedforsecurity=False).hexdigest()


class VersionedTable:
    """Partitioned files and a note that says which of them are the table.

    A write puts new files beside the old ones for the partitions it touches, and then
    replaces the note. Readers that opened the table before keep the files they saw: files
    leave the table with one write and are deleted by the next but one. One writer at a time; the note has an
    entry for each partition, so partitions should be hours or days, not keys.

    Writes carry a number that grows, such as a stream's batch id. A write whose number is
    not above the table's has been made before and does nothing.
    """

    def __init__(self, spark: SparkSession, location: str, partition: str):
        self.spark, self.location, self.partition = spark, location.rstrip("/"), partition
        self.notes = Ledger(spark, f"{self.location}/_versions")

    def current(self) -> dict | None:
        return self.notes.get(CURRENT)

    def number(self) -> int:
        """The number of the last write, -1 before any."""
        note = self.current()
        return note["number"] if note else -1

    def read(self, only: Sequence[str | None] | None = None) -> DataFrame | None:
        """The table as of now, or some of its partitions; None before the first write."""
        note = self.current()
        if note is None:
            return None
        parts = note["parts"]
        wanted = None if only is None else {_name(value) for value in only}
        paths = [path for name, path in sorted(parts.items()) if wanted is None or name in wanted]
        schema = StructType.fromJson(note["schema"])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def replace(self, rows: DataFrame, touched: Sequence[str | None], number: int) -> bool:
        """Put ``rows`` in place of the partitions ``touched``; False if that was done before."""
        note = self.current() or {"number": -1, "parts": {}, "leaving": [], "schema": None}
        if number <= note["number"]:
            return False
        data = f"{self.location}/{number}-{uuid4().hex}"
        named = rows.withColumn("_part", F.md5(_named(F.col(self.partition)).cast("binary")))
        # Whole files for each partition, and several where one is heavy.
        named.hint("rebalance", "_part").write.partitionBy("_part").parquet(data)
        parts = dict(note["parts"])
        names = [_name(value) for value in touched]
        leaving = [parts.pop(name) for name in names if name in parts]
        for name in names:
            path = f"{data}/_part={_folder(name)}"
            if self.notes.exists(path):
                parts[name] = path
        schema = rows.schema.jsonValue()
        gone = note["leaving"]
        self.notes.put(CURRENT, {"number": number, "parts": parts, "leaving": leaving, "schema": schema})
        for path in gone:
            self.notes.delete_data(path)
        return True

    def upsert(self, rows: DataFrame, keys: Sequence[str], number: int) -> list[str | None]:
        """Replace the rows of equal ``keys`` and add the others; the partitions touched.

        Only partitions that ``rows`` belong to are read and written.
        """
        # One row for each partition of the batch: a stream's open windows.
        touched = [
            row[0] for row in rows.select(F.col(self.partition).cast("string")).distinct().collect()
        ]
        if number > self.number():
            held = self.read(touched)
            merged = rows
            if held is not None:
                same = reduce(_both, [held[k].eqNullSafe(rows[k]) for k in keys])
                merged = held.join(rows, same, "left_anti").unionByName(rows)
            self.replace(merged, touched, number)
        return touched


def _both(a: Column, b: Column) -> Column:
    return a & b


def upsert_windows(
    table: VersionedTable,
    keys: Sequence[str],
    partition: Column,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    result: VersionedTable | None = None,
) -> Callable[[DataFrame, int], None]:
    """A target for a windowed aggregate in update mode.

    Each batch has the windows that changed; they replace their rows in ``table``.
    ``partition`` makes the table's partition column from ``window_start``. With ``finish``, the touched
    partitions are also turned into those of ``result``. A batch that is run again after a crash finds what
    it has done by its number.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        touched = table.upsert(batch.withColumn(table.partition, partition), keys, batch_id)
        if finish is not None and batch_id > result.number():
            made = finish(table.read(touched).drop(table.partition))
            result.replace(made.withColumn(result.partition, partition), touched, batch_id)

    return write
