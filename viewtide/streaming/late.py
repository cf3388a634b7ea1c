"""Late rows told apart instead of dropped."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from viewtide.sinks.ledger import Ledger
from viewtide.streaming.queries import StreamSettings, Target, add_batch, to_batches

DELAY = timedelta(minutes=10)


def _millis(time: str) -> Column:
    return F.unix_millis(time)


class LateParter:
    """Parts each batch as a windowed aggregate with a watermark would.

    Such an aggregate drops a row when the row's window ends at or before the watermark with
    which the batch before was run, that is, the latest event time of all batches before that
    one, less the delay. Those times are noted by batch, so a batch that is run again parts
    its rows in the same way.
    """

    def __init__(self, notes: Ledger, duration: timedelta, time: str = "event_time", delay: timedelta = DELAY):
        self.notes, self.time = notes, time
        self.duration_ms, self.delay_ms = (int(x.total_seconds() * 1000) for x in (duration, delay))

    def watermark(self, batch_id: int) -> int | None:
        """In milliseconds, for the late rows of a batch; None while there is none."""
        latest = self._latest(batch_id - 2)
        return None if latest is None else latest - self.delay_ms

    def _latest(self, batch_id: int) -> int | None:
        """The latest event time up to a batch; empty batches leave no note."""
        known = [k for k in map(int, self.notes.names()) if k <= batch_id]
        return self.notes.get(str(max(known)))["latest"] if known else None

    def note(self, batch: DataFrame, batch_id: int) -> None:
        """Remember the latest event time up to this batch."""
        own = batch.agg(F.max(_millis(self.time))).first()[0]
        times = [x for x in (self._latest(batch_id - 1), own) if x is not None]
        self.notes.put(str(batch_id), {"latest": max(times, default=None)})
        # This batch and the next may still look for the last of these.
        for old in sorted(k for k in map(int, self.notes.names()) if k <= batch_id - 2)[:-1]:
            self.notes.forget(str(old))

    def is_late(self, batch_id: int) -> Column:
        """Whether a row's window was closed; rows without a time belong to none, and are not late."""
        mark = self.watermark(batch_id)
        if mark is None:
            return F.lit(False)
        # Windows are counted from 1970; the window function would drop rows without a time.
        own, length = _millis(self.time), F.lit(self.duration_ms)
        end = own - F.pmod(own, length) + length
        return F.coalesce(end <= F.lit(mark), F.lit(False))


def start_parted(
    events: DataFrame,
    kept_path: str,
    late_path: str,
    settings: StreamSettings,
    duration: timedelta,
    time: str = "event_time",
    delay: timedelta = DELAY,
) -> StreamingQuery:
    """Append a stream's rows to two tables: those in time, and those behind the watermark.

    Each row comes into exactly one, in the folder of its batch (column ``batch``).
    """
    parter = LateParter(Ledger(events.sparkSession, f"{settings.checkpoint}-latest"), duration, time, delay)

    def side(path: str, late: bool) -> Target:
        def write(batch: DataFrame, batch_id: int) -> None:
            flag = parter.is_late(batch_id)
            add_batch(path, lambda rows: rows.filter(flag if late else ~flag))(batch, batch_id)

        return write

    targets = {"kept": side(kept_path, False), "late": side(late_path, True), "latest": parter.note}
    return to_batches(events, targets, settings, mode="append")
