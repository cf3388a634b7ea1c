"""The two stream jobs: trending content and engagement health."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from viewtide.functions.eventtime import with_event_time
from viewtide.functions.signals import with_engagement_flags
from viewtide.operators import windowed
from viewtide.sinks.tables import TableSink
from viewtide.sinks.versioned import VersionedTable, upsert_windows
from viewtide.sources.events import split_valid, validate_events
from viewtide.streaming.enrich import WATERMARK_DELAY, enrich, prepare_dimension
from viewtide.streaming.queries import (
    StreamSettings,
    Target,
    add_batch,
    to_batches,
    to_files,
    to_memory,
)

#: Attribute names of the two jobs.
ITEM_COLUMNS = ("title", "content_type", "genre_primary", "release_year")
HEALTH_ITEM_COLUMNS = (
    "title", "content_type", "genre_primary", "imdb_rating", "is_original", "release_year", "rating",
)
HEALTH_USER_COLUMNS = (
    "country", "subscription_plan", "monthly_spend", "age", "gender", "is_active",
)
#: What unknown attributes count as in the health metrics.
ITEM_DEFAULTS = {"imdb_rating": 0.0, "is_original": False}
USER_DEFAULTS = {"monthly_spend": 0.0, "age": 0, "gender": "Unknown"}


def _dimension(
    table: DataFrame, key: str, columns: Sequence[str], defaults: Mapping | None = None
) -> DataFrame:
    absent = [c for c in columns if c not in table.columns]
    if absent:
        raise ValueError(f"the dimension of {key} lacks {', '.join(absent)}")
    known = {k: v for k, v in (defaults or {}).items() if k in columns}
    return prepare_dimension(table, key, columns, defaults=known, store=True)


def item_dimension(items: DataFrame) -> DataFrame:
    """The stored item dimension of the trending job."""
    return _dimension(items, "movie_id", ITEM_COLUMNS)


def trending_stream(
    events: DataFrame,
    items: DataFrame,
    duration: str = windowed.WINDOW_DURATION,
    watermark: str = WATERMARK_DELAY,
) -> DataFrame:
    """Trending content over raw watch events (text ``timestamp``).

    Viewers are approximate. Items are counted by id and given their
    attributes afterwards.
    """
    counted = windowed.trending_approx(
        enrich(with_event_time(events), watermark=watermark), duration
    )
    return windowed.with_item_attributes(counted, item_dimension(items))


def exact_trending_stream(
    events: DataFrame,
    duration: str = windowed.WINDOW_DURATION,
    watermark: str = WATERMARK_DELAY,
) -> DataFrame:
    """One row per window, item and user, to be finished by :func:`exact_trending`."""
    return windowed.trending_by_user(
        enrich(with_event_time(events), watermark=watermark), duration
    )


def exact_trending(partials: DataFrame, items: DataFrame) -> DataFrame:
    """Trending content with exact viewers, from a batch or table of partial rows."""
    return windowed.with_item_attributes(windowed.trending_from_users(partials), items)


def health_stream(
    events: DataFrame,
    users: DataFrame,
    items: DataFrame,
    duration: str = windowed.WINDOW_DURATION,
    watermark: str = WATERMARK_DELAY,
    keys: Sequence[str] = windowed.HEALTH_KEYS,
    exact: bool = False,
) -> DataFrame:
    """Engagement health over raw watch events.

    With ``exact`` the result has one row per window, segment and user, for
    :func:`~viewtide.operators.windowed.health_from_users`; otherwise users are
    approximate and the result is final. The segments are made of user and item
    attributes, so the dimensions are joined first, with the attributes that
    ``keys`` and the measures use; a table that lacks one is an error.
    """
    of_users = [c for c in HEALTH_USER_COLUMNS if c in keys or c == "monthly_spend"]
    of_items = [c for c in HEALTH_ITEM_COLUMNS if c in keys or c == "imdb_rating"]
    enriched = enrich(
        with_event_time(events),
        users=_dimension(users, "user_id", of_users, USER_DEFAULTS),
        items=_dimension(items, "movie_id", of_items, ITEM_DEFAULTS),
        watermark=watermark,
    )
    flagged = with_engagement_flags(enriched)
    if exact:
        return windowed.health_by_user(flagged, duration, keys)
    return windowed.health_approx(flagged, duration, keys)


def health_partials(
    events: DataFrame, duration: str = windowed.WINDOW_DURATION, watermark: str = WATERMARK_DELAY
) -> DataFrame:
    """Engagement health of raw watch events by ids, to be finished by :func:`finished_health`.

    No dimension is joined to the stream, so their changes show in all windows and hot users
    or items load no task.
    """
    counted = enrich(with_event_time(events), watermark=watermark)
    return windowed.health_by_ids(with_engagement_flags(counted), duration)


def finished_health(
    partials: DataFrame, users: DataFrame, items: DataFrame, keys: Sequence[str] = windowed.HEALTH_KEYS
) -> DataFrame:
    """Exact engagement health per segment, from a batch or table of partial rows."""
    of_users = [c for c in HEALTH_USER_COLUMNS if c in keys or c == "monthly_spend"]
    of_items = [c for c in HEALTH_ITEM_COLUMNS if c in keys or c == "imdb_rating"]
    return windowed.health_from_ids(
        partials,
        _dimension(users, "user_id", of_users, USER_DEFAULTS),
        _dimension(items, "movie_id", of_items, ITEM_DEFAULTS),
        keys,
    )


def start_live_windows(
    stream: DataFrame,
    keys: Sequence[str],
    partials: VersionedTable,
    finished: Callable[[DataFrame], DataFrame],
    result: VersionedTable,
    settings: StreamSettings,
) -> StreamingQuery:
    """Keep a table up to date in update mode: only hours with changed windows are replaced.

    ``stream`` is a windowed aggregate with additive rows of ``keys``, kept in ``partials``,
    and ``finished`` turns those of the touched hours into ``result``. State is dropped as
    windows close, and readers of either table see whole versions.
    """
    hour = F.date_format(F.date_trunc("hour", "window_start"), "yyyy-MM-dd-HH")
    target = upsert_windows(partials, [*windowed.WINDOW_BOUNDS, *keys], hour, finished, result)
    return to_batches(stream, {"windows": target}, settings, mode="update", once_each=True)


def replace_table(sink: TableSink, name: str, sort_by: Sequence[str] = ()) -> Target:
    """A target that overwrites one table with each batch, sorted for reading."""

    def write(batch: DataFrame, _: int) -> None:
        sink.overwrite(batch, name, sort_by=sort_by)

    return write


def start_live_table(
    stream: DataFrame,
    sink: TableSink,
    name: str,
    settings: StreamSettings,
    sort_by: Sequence[str] = (),
    monitor: str | None = None,
    monitor_settings: StreamSettings | None = None,
) -> list[StreamingQuery]:
    """Keep ``name`` up to date in complete mode.

    With ``monitor``, a second query also offers the rows as an in-memory
    table; it reads the source again and needs its own checkpoint.
    """
    if monitor and monitor_settings is None:
        raise ValueError("the monitor query needs settings with a checkpoint of its own")
    queries = [to_batches(stream, {name: replace_table(sink, name, sort_by)}, settings)]
    if monitor:
        queries.append(to_memory(stream, monitor, monitor_settings))
    return queries


def start_history(stream: DataFrame, path: str, settings: StreamSettings) -> StreamingQuery:
    """Append closed windows to files by day; state is dropped as windows close."""
    dated = stream.withColumn("window_day", F.to_date("window_start"))
    return to_files(dated, path, settings, partition_by=("window_day",))


def start_intake(
    envelope: DataFrame, valid_path: str, quarantine_path: str, settings: StreamSettings, **rules
) -> StreamingQuery:
    """Validate messages once and part them into typed events and rejects."""

    def valid(batch: DataFrame) -> DataFrame:
        return split_valid(batch)[0]

    def rejected(batch: DataFrame) -> DataFrame:
        return split_valid(batch)[1]

    targets = {
        "valid": add_batch(valid_path, valid),
        "quarantine": add_batch(quarantine_path, rejected),
    }
    return to_batches(validate_events(envelope, **rules), targets, settings, mode="append")
