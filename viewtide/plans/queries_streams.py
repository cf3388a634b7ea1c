"""Catalogue entries: the stream operators, run over the events as a stream."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.functions.signals import with_engagement_flags
from viewtide.operators import metrics, snapshots, windowed
from viewtide.plans import domain
from viewtide.plans.catalog import query
from viewtide.plans.oracle import buckets, health, rounded, trending
from viewtide.plans.queries_batch import rounding
from viewtide.plans.queries_events import (
    COARSE_KEYS,
    TOP_GENRES_COUNTRIES,
    item_dimension,
    shown_trending,
    user_dimension,
)
from viewtide.session import scratch_path
from viewtide.sinks.tables import TableSink
from viewtide.streaming.enrich import enrich
from viewtide.streaming.queries import (
    StreamSettings,
    append_to_end,
    finish,
    query_status,
    to_batches,
    to_files,
    to_memory,
)


#: Fixed for a checkpoint's life, so it is a plain setting; enough for the catalogue's tables.
STATE_PARTITIONS = 8


def once(spark) -> StreamSettings:
    """Process what is available."""
    return StreamSettings(
        scratch_path(spark, "checkpoint"), interval=None, state_partitions=STATE_PARTITIONS
    )


def plain_times(df: DataFrame) -> DataFrame:
    """Zoned timestamps back to the zone-free type of the driver tables."""
    return df.withColumns(
        {n: F.col(n).cast("timestamp_ntz") for n, kind in df.dtypes if kind == "timestamp"}
    )


def appended(spark, stream: DataFrame) -> DataFrame:
    """Run ``stream`` into files and read them back."""
    path = scratch_path(spark, "stream")
    finish(to_files(stream, path, once(spark)))
    return plain_times(spark.read.schema(stream.schema).parquet(path))


def windows_of(spark, sf_dir, build) -> DataFrame:
    """Run a windowed aggregate of the events to its end and read it back."""
    path = scratch_path(spark, "stream")
    source = domain.event_stream(spark, sf_dir)
    append_to_end(source, build, path, once(spark))
    return plain_times(spark.read.schema(build(source).schema).parquet(path))


def watched(spark, sf_dir) -> DataFrame:
    """The bare event stream with a watermark."""
    return enrich(domain.event_stream(spark, sf_dir))


def enriching(spark, sf_dir):
    """Enrichment with stored dimensions: no micro-batch dedupes them again."""
    users, items = (make(spark, sf_dir, store=True) for make in (user_dimension, item_dimension))
    return lambda events: enrich(events, users, items)


def enriched_stream(spark, sf_dir) -> DataFrame:
    return enriching(spark, sf_dir)(domain.event_stream(spark, sf_dir))


def near_exact(result: DataFrame, exact: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Replace an approximate count by whether it is within a tenth, and one, of the exact one."""
    named = exact.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col(count).alias("_exact"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    close = F.abs(F.col(count) - F.col("_exact")) <= F.col("_exact") / 10 + 1
    joined = result.join(named, same, "left").withColumn(f"{count}_close", F.coalesce(close, F.lit(False)))
    return joined.select(*(c for c in result.columns if c != count), f"{count}_close")


def titled(spark, sf_dir, trending_items: DataFrame) -> DataFrame:
    return windowed.with_item_attributes(trending_items, item_dimension(spark, sf_dir, store=True))


@query("stream_file_source", "SELECT * FROM v_events")
def stream_file_source(spark, sf_dir):
    return appended(spark, domain.event_stream(spark, sf_dir))


@query(
    "stream_static_join",
    """SELECT event_id, event_time, user_id, movie_id, country, title, genre_primary, content_type
       FROM v_enriched""",
)
def stream_static_join(spark, sf_dir):
    stream = enriched_stream(spark, sf_dir).select(
        "event_id", "event_time", "user_id", "movie_id", "country", "title", "genre_primary",
        "content_type",
    )
    return appended(spark, stream)


@query("stream_trending_content", trending("5 minutes"))
def stream_trending_content(spark, sf_dir):
    """Append mode to the end of the events, with exact viewers."""
    partials = windows_of(spark, sf_dir, lambda events: windowed.trending_by_user(enrich(events)))
    return shown_trending(titled(spark, sf_dir, windowed.trending_from_users(partials)))


@query(
    "stream_trending_approx",
    f"""SELECT * EXCLUDE (unique_viewers), TRUE AS unique_viewers_close
        FROM ({trending('1 hour')}) t""",
)
def stream_trending_approx(spark, sf_dir):
    """One streaming aggregate; its viewer count is a sketch, compared within a tenth."""
    items = item_dimension(spark, sf_dir, store=True)

    def build(events: DataFrame) -> DataFrame:
        return windowed.with_item_attributes(windowed.trending_approx(enrich(events), "1 hour"), items)

    exact = windowed.trending_from_users(
        windowed.trending_by_user(domain.events(spark, sf_dir), "1 hour")
    )
    counted = shown_trending(windows_of(spark, sf_dir, build))
    return near_exact(counted, exact, ["window_start", "movie_id"], "unique_viewers")


@query(
    "stream_engagement_health",
    health("1 hour", ", ".join(windowed.HEALTH_KEYS)),
)
def stream_engagement_health(spark, sf_dir):
    """Counted by ids on the stream; users and items join the closed windows."""

    def build(events: DataFrame) -> DataFrame:
        return windowed.health_by_ids(with_engagement_flags(enrich(events)), "1 hour")

    counted = windows_of(spark, sf_dir, build)
    dimensions = [make(spark, sf_dir, store=True) for make in (user_dimension, item_dimension)]
    return windowed.health_from_ids(counted, *dimensions)


@query(
    "stream_engagement_health_approx",
    f"""SELECT * EXCLUDE (unique_users), TRUE AS unique_users_close
        FROM ({health('1 day', ', '.join(COARSE_KEYS))}) t""",
)
def stream_engagement_health_approx(spark, sf_dir):
    """The user count is a sketch, compared within a tenth."""
    enriched = enriching(spark, sf_dir)

    def build(events: DataFrame) -> DataFrame:
        return windowed.health_approx(with_engagement_flags(enriched(events)), "1 day", COARSE_KEYS)

    flagged = with_engagement_flags(enrich(domain.events(spark, sf_dir), *(
        make(spark, sf_dir) for make in (user_dimension, item_dimension)), watermark=None))
    exact = windowed.health_from_users(
        windowed.health_by_user(flagged, "1 day", COARSE_KEYS), COARSE_KEYS
    )
    counted = windows_of(spark, sf_dir, build)
    return near_exact(counted, exact, ["window_start", *COARSE_KEYS], "unique_users")


@query(
    "stream_append",
    f"""SELECT {buckets('5 minutes')}, COUNT(watch_duration_minutes) AS sessions,
               {rounded('AVG(watch_duration_minutes)')} AS avg_session_duration
        FROM v_events GROUP BY ALL""",
)
def stream_append(spark, sf_dir):
    result = windows_of(
        spark, sf_dir, lambda events: windowed.avg_session_duration(enrich(events), "5 minutes")
    )
    return rounding(result, "avg_session_duration")


@query(
    "stream_active_users_per_minute",
    f"""SELECT {buckets('1 minute')}, COUNT(DISTINCT user_id) AS active_users
        FROM v_events GROUP BY ALL""",
)
def stream_active_users_per_minute(spark, sf_dir):
    activity = windows_of(spark, sf_dir, lambda events: windowed.user_activity(enrich(events)))
    return windowed.active_users_from_activity(activity)


@query(
    "stream_event_type_distribution",
    f"""SELECT *, {rounded('event_count / SUM(event_count) OVER (PARTITION BY window_start)', 6)}
                    AS share
        FROM (SELECT {buckets('1 hour', 'action')}, COUNT(*) AS event_count
              FROM v_events GROUP BY ALL) c""",
)
def stream_event_type_distribution(spark, sf_dir):
    counts = windows_of(spark, sf_dir, lambda events: windowed.event_type_counts(enrich(events)))
    return rounding(windowed.with_share(counts), "share", scale=6)


@query(
    "stream_memory_table",
    f"SELECT {buckets('1 day', 'action')}, COUNT(*) AS event_count FROM v_events GROUP BY ALL",
)
def stream_memory_table(spark, sf_dir):
    """Complete mode into a named table: one row per day and action."""
    name = f"event_types_{uuid4().hex}"
    counts = windowed.event_type_counts(watched(spark, sf_dir), "1 day")
    finish(to_memory(counts, name, once(spark)))
    return plain_times(spark.table(name))


def _snapshot(spark, sf_dir) -> tuple[str, str]:
    """Run the daily trending stream into two replaced tables."""
    sink = TableSink(scratch_path(spark, "snapshot"))
    items = item_dimension(spark, sf_dir, store=True)

    def counted(batch: DataFrame) -> DataFrame:
        return windowed.with_item_attributes(windowed.trending_from_users(batch), items)

    def write_all(batch: DataFrame, _: int) -> None:
        sink.overwrite(counted(batch), "trending")

    def write_top(batch: DataFrame, _: int) -> None:
        top = snapshots.top_trending(counted(batch))
        sink.overwrite(top, "top_trending", sort_by=["-view_count", "window_start"])

    stream = windowed.trending_by_user(watched(spark, sf_dir), "1 day")
    finish(to_batches(stream, {"trending": write_all, "top": write_top}, once(spark)))
    return sink.target("trending"), sink.target("top_trending")


@query("stream_foreach_batch", trending("1 day"))
def stream_foreach_batch(spark, sf_dir):
    """Complete mode: every window, replaced on each trigger."""
    trending_path, _ = _snapshot(spark, sf_dir)
    return shown_trending(plain_times(spark.read.parquet(trending_path)))


@query(
    "stream_top_trending",
    f"""SELECT window_start, window_end, title, genre_primary, view_count, unique_viewers,
               {rounded('completion', 1)} AS completion_pct, {rounded('watched', 1)} AS watch_time_min
        FROM (SELECT {buckets('1 day', 'movie_id, title, genre_primary, content_type')},
                     COUNT(*) AS view_count, COUNT(DISTINCT user_id) AS unique_viewers,
                     AVG(progress_percentage) AS completion, SUM(watch_duration_minutes) AS watched
              FROM v_enriched GROUP BY ALL) t
        ORDER BY view_count DESC, window_start, movie_id LIMIT 10""",
)
def stream_top_trending(spark, sf_dir):
    _, top_path = _snapshot(spark, sf_dir)
    return plain_times(spark.read.parquet(top_path))


@query("stream_top_genres_countries", TOP_GENRES_COUNTRIES)
def stream_top_genres_countries(spark, sf_dir):
    """Complete mode over one row per genre and country, ranked on each trigger."""
    sink = TableSink(scratch_path(spark, "snapshot"))

    def write(batch: DataFrame, _: int) -> None:
        sink.overwrite(metrics.top_from_views(batch), "top", sort_by=["dimension", "position"])

    views = metrics.genre_country_views(enriched_stream(spark, sf_dir))
    finish(to_batches(views, {"top": write}, once(spark)))
    return spark.read.parquet(sink.target("top"))


@query(
    "stream_progress",
    "SELECT COUNT(*) AS input_rows, FALSE AS is_active FROM events",
)
def stream_progress(spark, sf_dir):
    stream = domain.event_stream(spark, sf_dir)
    run = finish(to_files(stream, scratch_path(spark, "stream"), once(spark)))
    return query_status(spark, run).select("input_rows", "is_active")
