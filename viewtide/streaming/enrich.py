"""Enriching an event stream with static dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.operators.cleaning import dedupe_by_key, impute_constant
from viewtide.session import materialise

WATERMARK_DELAY = "10 minutes"


def prepare_dimension(
    dimension: DataFrame,
    key: str,
    columns: Sequence[str],
    order_by: Sequence | None = None,
    defaults: Mapping[str, object] | None = None,
    store: bool = False,
) -> DataFrame:
    """One row per key with the wanted columns, missing values set to ``defaults``.

    Duplicate dimension rows would multiply the events that match them. The
    kept row is the first by ``order_by``, or by the columns themselves with
    NULLs last. ``store`` writes the result once, so that micro-batches do not
    repeat the work and the join sees its true size.
    """
    order = order_by or [F.asc_nulls_last(c) for c in columns]
    keyed = dimension.filter(F.col(key).isNotNull())
    single = dedupe_by_key(keyed, [key], order).select(key, *columns)
    filled = impute_constant(single, defaults) if defaults else single
    return materialise(filled, "dimension") if store else filled


def enrich(
    events: DataFrame,
    users: DataFrame | None = None,
    items: DataFrame | None = None,
    watermark: str | None = WATERMARK_DELAY,
    time: str = "event_time",
) -> DataFrame:
    """Left-join prepared dimensions, then set the watermark.

    Events of unknown users or items stay, with NULL attributes. The join
    strategy is Spark's: a dimension is broadcast only below the size limit.
    """
    if users is not None:
        events = events.join(users, "user_id", "left")
    if items is not None:
        events = events.join(items, "movie_id", "left")
    return events.withWatermark(time, watermark) if watermark else events
