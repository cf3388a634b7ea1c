"""Catalogue entries: decoding, windows, snapshots and replay on event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.functions.eventtime import EVENT_TIME_FORMAT, with_watch_month
from viewtide.functions.signals import with_engagement_flags
from viewtide.operators import metrics, replay, snapshots, windowed
from viewtide.plans import domain
from viewtide.plans.catalog import query
from viewtide.plans.oracle import buckets, health, rounded, trending
from viewtide.plans.queries_batch import rounding
from viewtide.schemas import fields
from viewtide.sources.events import decode_json, encode_json, split_valid, validate_events
from viewtide.streaming.enrich import enrich, prepare_dimension

COARSE_KEYS = ("genre_primary", "device_type")
MESSAGE_SCHEMA = fields(
    event_id="long", user_id="long", movie_id="long", timestamp="string", action="string",
    progress_percentage="double", watch_duration_minutes="double", quality="string",
    device_type="string",
)


def user_dimension(spark, sf_dir, store: bool = False) -> DataFrame:
    return prepare_dimension(
        domain.users(spark, sf_dir),
        "user_id",
        ["country", "subscription_plan", "monthly_spend"],
        defaults={"monthly_spend": 0.0},
        store=store,
    )


def item_dimension(spark, sf_dir, store: bool = False) -> DataFrame:
    return prepare_dimension(
        domain.movies(spark, sf_dir),
        "movie_id",
        ["title", "genre_primary", "content_type", "imdb_rating", "is_original"],
        defaults={"imdb_rating": 0.0, "is_original": False},
        store=store,
    )


def enriched(spark, sf_dir) -> DataFrame:
    return enrich(
        domain.events(spark, sf_dir),
        user_dimension(spark, sf_dir),
        item_dimension(spark, sf_dir),
        watermark=None,
    )


def flagged(spark, sf_dir) -> DataFrame:
    return with_engagement_flags(enriched(spark, sf_dir))


def messages(spark, sf_dir) -> DataFrame:
    """Events as messages; every 50th lacks its user, every 50th its time."""
    key = F.col("event_id")
    time = F.date_format("event_time", EVENT_TIME_FORMAT)
    return domain.events(spark, sf_dir).select(
        key,
        F.when(key % 50 != 1, F.col("user_id")).alias("user_id"),
        "movie_id",
        F.when(key % 50 == 2, "not a time").otherwise(time).alias("timestamp"),
        "action",
        "progress_percentage",
        "watch_duration_minutes",
        "quality",
        "device_type",
    )


@query(
    "parse_event_time",
    """SELECT event_id, CASE WHEN event_id % 30 = 0 OR event_id % 31 = 0 THEN NULL
                             ELSE date_trunc('second', event_time) END AS event_time,
              CASE WHEN event_id % 30 = 0 OR event_id % 31 = 0 THEN NULL
                   ELSE CAST(YEAR(event_time) AS INTEGER) END AS watch_year,
              CASE WHEN event_id % 30 = 0 OR event_id % 31 = 0 THEN NULL
                   ELSE CAST(MONTH(event_time) AS INTEGER) END AS watch_month
       FROM v_events""",
)
def parse_event_time(spark, sf_dir):
    key = F.col("event_id")
    text = (
        F.when(key % 30 == 0, "n/a")
        .when(key % 31 == 0, F.date_format("event_time", "yyyy-MM-dd"))
        .otherwise(F.date_format("event_time", EVENT_TIME_FORMAT))
    )
    texts = domain.events(spark, sf_dir).select(key, text.alias("watch_date"))
    return with_watch_month(texts).select(
        "event_id",
        F.col("watch_date_parsed").cast("timestamp_ntz").alias("event_time"),
        "watch_year",
        "watch_month",
    )


@query("encode_json_events", "SELECT event_id, value FROM v_encoded")
def encode_json_events(spark, sf_dir):
    encoded = encode_json(messages(spark, sf_dir))
    return encoded.select(
        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), "value"
    )


@query("decode_json_events", "SELECT * FROM v_messages")
def decode_json_events(spark, sf_dir):
    envelope = encode_json(messages(spark, sf_dir)).select(F.col("value").cast("binary"))
    return decode_json(envelope, MESSAGE_SCHEMA)


@query(
    "quarantine_events",
    """SELECT CASE WHEN event_id % 50 = 3 THEN RTRIM(value, '}') ELSE value END AS raw,
              CASE event_id % 50 WHEN 1 THEN 'missing user_id' WHEN 2 THEN 'bad timestamp'
                   ELSE 'malformed' END AS reject_reason
       FROM v_encoded WHERE event_id % 50 IN (1, 2, 3)""",
)
def quarantine_events(spark, sf_dir):
    encoded = encode_json_events(spark, sf_dir)
    # Every 50th message also loses its closing brace.
    broken = F.rtrim("value", F.lit("}"))
    sent = F.when(F.col("event_id") % 50 == 3, broken).otherwise(F.col("value"))
    validated = validate_events(
        encoded.select(sent.alias("value")),
        required=["event_id", "user_id", "movie_id"],
        schema=MESSAGE_SCHEMA,
    )
    _, rejected = split_valid(validated)
    return rejected


@query(
    "engagement_flags",
    """SELECT event_id, progress_percentage, watch_duration_minutes, quality, action,
              is_low_engagement, is_quality_downgrade, is_abandoned, is_completed FROM v_flags""",
)
def engagement_flags(spark, sf_dir):
    return with_engagement_flags(domain.events(spark, sf_dir)).select(
        "event_id", "progress_percentage", "watch_duration_minutes", "quality", "action",
        "is_low_engagement", "is_quality_downgrade", "is_abandoned", "is_completed",
    )


def shown_trending(df: DataFrame) -> DataFrame:
    return rounding(df, "avg_completion_pct", "total_watch_time_min")


def trending_titles(spark, sf_dir, duration: str = windowed.WINDOW_DURATION) -> DataFrame:
    counted = windowed.trending_content(domain.events(spark, sf_dir), duration)
    return windowed.with_item_attributes(counted, item_dimension(spark, sf_dir))


@query("trending_content", trending("5 minutes"))
def trending_content(spark, sf_dir):
    return shown_trending(trending_titles(spark, sf_dir))


@query("trending_content_daily", trending("1 day"))
def trending_content_daily(spark, sf_dir):
    return shown_trending(trending_titles(spark, sf_dir, "1 day"))


HEALTH_COLUMNS = "country, genre_primary, device_type, quality, is_original, content_type"


@query("engagement_health", health("5 minutes", HEALTH_COLUMNS))
def engagement_health(spark, sf_dir):
    return windowed.engagement_health(flagged(spark, sf_dir))


@query("engagement_health_daily", health("1 day", ", ".join(COARSE_KEYS)))
def engagement_health_daily(spark, sf_dir):
    return windowed.engagement_health(flagged(spark, sf_dir), "1 day", COARSE_KEYS)


@query(
    "active_users_per_minute",
    f"""SELECT {buckets('1 minute')}, COUNT(DISTINCT user_id) AS active_users
        FROM v_events GROUP BY ALL""",
)
def active_users_per_minute(spark, sf_dir):
    return windowed.active_users(domain.events(spark, sf_dir))


@query(
    "event_type_distribution",
    f"""SELECT *, {rounded('event_count / SUM(event_count) OVER (PARTITION BY window_start)', 6)}
                    AS share
        FROM (SELECT {buckets('1 hour', 'action')}, COUNT(*) AS event_count
              FROM v_events GROUP BY ALL) c""",
)
def event_type_distribution(spark, sf_dir):
    result = windowed.event_type_distribution(domain.events(spark, sf_dir))
    return rounding(result, "share", scale=6)


@query(
    "avg_session_duration",
    f"""SELECT {buckets('1 hour')}, COUNT(watch_duration_minutes) AS sessions,
               {rounded('AVG(watch_duration_minutes)')} AS avg_session_duration
        FROM v_events GROUP BY ALL""",
)
def avg_session_duration(spark, sf_dir):
    result = windowed.avg_session_duration(domain.events(spark, sf_dir))
    return rounding(result, "avg_session_duration")


TOP_GENRES_COUNTRIES = """
    SELECT dimension, value, total_views, CAST(position AS INTEGER) AS position FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY dimension ORDER BY total_views DESC, value) AS position
      FROM (SELECT 'genre' AS dimension, genre_primary AS value, COUNT(*) AS total_views
            FROM v_enriched WHERE genre_primary IS NOT NULL GROUP BY genre_primary
            UNION ALL
            SELECT 'country', country, COUNT(*) FROM v_enriched
            WHERE country IS NOT NULL GROUP BY country) t) r WHERE position <= 10"""


@query("top_genres_countries", TOP_GENRES_COUNTRIES)
def top_genres_countries(spark, sf_dir):
    return metrics.top_genres_countries(enriched(spark, sf_dir))


@query(
    "top_trending",
    f"""SELECT window_start, window_end, title, genre_primary, view_count, unique_viewers,
               {rounded('completion', 1)} AS completion_pct, {rounded('watched', 1)} AS watch_time_min
        FROM (SELECT {buckets('1 day', 'movie_id, title, genre_primary, content_type')},
                     COUNT(*) AS view_count, COUNT(DISTINCT user_id) AS unique_viewers,
                     AVG(progress_percentage) AS completion, SUM(watch_duration_minutes) AS watched
              FROM v_enriched GROUP BY ALL) t
        ORDER BY view_count DESC, window_start, movie_id LIMIT 10""",
)
def top_trending(spark, sf_dir):
    return snapshots.top_trending(trending_titles(spark, sf_dir, "1 day"))


@query(
    "top_risk_segments",
    f"""SELECT window_start, country, genre_primary, device_type, quality, total_sessions,
               unique_users, avg_completion_pct, low_engagement_rate, abandonment_rate, alert_level
        FROM ({health('1 day', HEALTH_COLUMNS)}) s WHERE total_sessions >= 1
        ORDER BY low_engagement_rate DESC, total_sessions DESC, window_start,
                 country NULLS FIRST, genre_primary NULLS FIRST, device_type, quality,
                 is_original NULLS FIRST, content_type NULLS FIRST LIMIT 10""",
)
def top_risk_segments(spark, sf_dir):
    return snapshots.top_risk_segments(windowed.engagement_health(flagged(spark, sf_dir), "1 day"))


@query(
    "overall_health",
    f"""SELECT COUNT(*) AS total_segments, CAST(SUM(total_sessions) AS BIGINT) AS total_sessions,
               {rounded('AVG(low_engagement_rate)')} AS avg_churn_risk,
               COUNT(*) FILTER (WHERE alert_level = 'HIGH') AS high_risk_segments
        FROM ({health('1 day', ', '.join(COARSE_KEYS))}) s""",
)
def overall_health(spark, sf_dir):
    health_table = windowed.engagement_health(flagged(spark, sf_dir), "1 day", COARSE_KEYS)
    return rounding(snapshots.overall_health(health_table), "avg_churn_risk")


@query(
    "replay_recent",
    """SELECT event_id, event_time, user_id, movie_id FROM v_events
       ORDER BY event_time DESC, event_id DESC LIMIT 4500""",
)
def replay_recent(spark, sf_dir):
    events = domain.events(spark, sf_dir).select("event_id", "event_time", "user_id", "movie_id")
    return replay.recent_events(events, "event_time", ["event_id"])


@query(
    "replay_event_time",
    """SELECT session_id, session_seq, user_id, movie_id,
              strftime(watch_date + to_hours(session_id % 24) + to_minutes(movie_id % 60)
                       + to_seconds(user_id % 60), '%Y-%m-%d %H:%M:%S') AS timestamp
       FROM v_watch""",
)
def replay_event_time(spark, sf_dir):
    rows = domain.watch(spark, sf_dir).select(
        "session_id",
        "session_seq",
        "user_id",
        "movie_id",
        "watch_date",
        (F.col("session_id") % 24).alias("hour"),
        (F.col("movie_id") % 60).alias("minute"),
        (F.col("user_id") % 60).alias("second"),
    )
    return replay.with_replay_time(rows).drop("watch_date").orderBy("timestamp", "session_id")


@query(
    "replay_slices",
    """SELECT event_id, event_time, n // 150 AS slice, n % 150 AS slice_row
       FROM (SELECT event_id, event_time,
                    ROW_NUMBER() OVER (ORDER BY event_time, event_id) - 1 AS n FROM v_events) r""",
)
def replay_slices(spark, sf_dir):
    events = domain.events(spark, sf_dir).select("event_id", "event_time")
    return replay.ordered_slices(events, ["event_time", "event_id"])
