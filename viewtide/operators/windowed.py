"""Event-time window metrics for tables and streams.

Exact distinct users cannot be kept in one streaming aggregate. The metrics are
therefore split in two groupings: first per group **and user** (additive, runs
on a stream, spreads a hot group over its users), then per group over those
partial rows (runs on a table or on each snapshot of the stream). On a table
the two steps compose to the exact metric. ``*_approx`` variants keep one
streaming aggregate with a sketch of the users instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.functions.rounding import stable_round
from viewtide.functions.signals import alert_level, percentage

#: Names of the keys and results below.
WINDOW_DURATION = "5 minutes"
TRENDING_KEYS = ("movie_id",)
ITEM_ATTRIBUTES = ("title", "genre_primary", "content_type")
HEALTH_KEYS = (
    "country",
    "genre_primary",
    "device_type",
    "quality",
    "is_original",
    "content_type",
)
WINDOW_BOUNDS = ["window_start", "window_end"]


def _rows() -> Column:
    return F.count(F.lit(1))


def _mean(total: str, count: str) -> Column:
    return F.try_divide(F.col(total).cast("double"), F.col(count))


def windowed(
    events: DataFrame,
    duration: str,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    time: str = "event_time",
) -> DataFrame:
    """Aggregate per tumbling window and keys, with flat window bounds.

    Rows without an event time belong to no window.
    """
    grouped = events.groupBy(F.window(time, duration), *keys).agg(*aggregates)
    names = [c for c in grouped.columns if c not in ("window", *keys)]
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        *names,
    )


# -- trending content -------------------------------------------------------


def _trending_sums() -> list[Column]:
    return [
        _rows().alias("view_count"),
        F.sum("progress_percentage").alias("progress_sum"),
        F.count("progress_percentage").alias("progress_count"),
        F.sum("watch_duration_minutes").alias("total_watch_time_min"),
        F.count_if(F.col("action") == "completed").alias("completed_views"),
    ]


def trending_by_user(
    events: DataFrame, duration: str = WINDOW_DURATION, keys: Sequence[str] = TRENDING_KEYS
) -> DataFrame:
    """Trending measures per window, item and user."""
    return windowed(events, duration, [*keys, "user_id"], _trending_sums())


def trending_from_users(partials: DataFrame, keys: Sequence[str] = TRENDING_KEYS) -> DataFrame:
    sums = ["view_count", "progress_sum", "progress_count", "total_watch_time_min", "completed_views"]
    return _trending_columns(
        partials.groupBy(*WINDOW_BOUNDS, *keys).agg(
            F.count("user_id").alias("unique_viewers"), *[F.sum(c).alias(c) for c in sums]
        ),
        keys,
    )


def trending_approx(
    events: DataFrame, duration: str = WINDOW_DURATION, keys: Sequence[str] = TRENDING_KEYS
) -> DataFrame:
    """Trending content with approximate viewers, as one streaming aggregate."""
    viewers = F.approx_count_distinct("user_id").alias("unique_viewers")
    return _trending_columns(windowed(events, duration, keys, [viewers, *_trending_sums()]), keys)


def trending_content(
    events: DataFrame, duration: str = WINDOW_DURATION, keys: Sequence[str] = TRENDING_KEYS
) -> DataFrame:
    """Views, viewers, completion and watch time per window and item.

    ``completed_views`` counts events whose action is ``completed``. (Counting
    the comparison itself would count every event that has an action.) Missing
    progress and durations are ignored.
    """
    return trending_from_users(trending_by_user(events, duration, keys), keys)


def with_item_attributes(
    trending: DataFrame, items: DataFrame, attributes: Sequence[str] = ITEM_ATTRIBUTES
) -> DataFrame:
    """Attach item attributes to counted items; unknown items keep NULLs.

    An item's attributes follow from its id, so grouping by the id alone gives
    the same groups. Joining afterwards keeps titles out of the shuffles and
    the streaming state, and a hot item meets the join as one row per window
    instead of all its events. ``items`` has one row per id.
    """
    fixed = [*WINDOW_BOUNDS, "movie_id"]
    measures = [c for c in trending.columns if c not in fixed]
    joined = trending.join(items.select("movie_id", *attributes), "movie_id", "left")
    return joined.select(*fixed, *attributes, *measures)


def _trending_columns(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(
        *WINDOW_BOUNDS,
        *keys,
        "view_count",
        "unique_viewers",
        _mean("progress_sum", "progress_count").alias("avg_completion_pct"),
        "total_watch_time_min",
        "completed_views",
    )


# -- engagement health ------------------------------------------------------


def _health_sums() -> list[Column]:
    return [
        _rows().alias("total_sessions"),
        F.sum("watch_duration_minutes").alias("total_watch_minutes"),
        F.sum("progress_percentage").alias("progress_sum"),
        F.sum("imdb_rating").alias("imdb_sum"),
        F.count("imdb_rating").alias("imdb_count"),
        F.sum("is_low_engagement").alias("low_engagement_count"),
        F.sum("is_abandoned").alias("abandonment_count"),
        F.sum("is_quality_downgrade").alias("quality_downgrade_count"),
        F.sum("is_completed").alias("completion_count"),
        F.sum("monthly_spend").alias("spend_sum"),
        F.count("monthly_spend").alias("spend_count"),
    ]


_HEALTH_SUMS = [
    "total_sessions", "total_watch_minutes", "progress_sum", "imdb_sum", "imdb_count",
    "low_engagement_count", "abandonment_count", "quality_downgrade_count", "completion_count",
    "spend_sum", "spend_count",
]


def health_by_user(
    events: DataFrame, duration: str = WINDOW_DURATION, keys: Sequence[str] = HEALTH_KEYS
) -> DataFrame:
    """Health measures per window, segment and user; events carry the flags."""
    return windowed(events, duration, [*keys, "user_id"], _health_sums())


def health_from_users(partials: DataFrame, keys: Sequence[str] = HEALTH_KEYS) -> DataFrame:
    return _health_columns(
        partials.groupBy(*WINDOW_BOUNDS, *keys).agg(
            F.count("user_id").alias("unique_users"), *[F.sum(c).alias(c) for c in _HEALTH_SUMS]
        ),
        keys,
    )


#: What an event itself says of its segment; the rest follows from its user and item.
EVENT_KEYS = ("device_type", "quality")


def health_by_ids(
    events: DataFrame, duration: str = WINDOW_DURATION, event_keys: Sequence[str] = EVENT_KEYS
) -> DataFrame:
    """Health measures per window, user, item and event keys, before any dimension is joined.

    Runs on a stream: its state holds ids instead of attributes, and a hot user or item meets
    a join as a few rows instead of all events. Events carry the flags.
    """
    own = [
        _rows().alias("total_sessions"),
        F.sum("watch_duration_minutes").alias("total_watch_minutes"),
        F.sum("progress_percentage").alias("progress_sum"),
        F.sum("is_low_engagement").alias("low_engagement_count"),
        F.sum("is_abandoned").alias("abandonment_count"),
        F.sum("is_quality_downgrade").alias("quality_downgrade_count"),
        F.sum("is_completed").alias("completion_count"),
    ]
    return windowed(events, duration, ["user_id", "movie_id", *event_keys], own)


def health_from_ids(
    partials: DataFrame, users: DataFrame, items: DataFrame, keys: Sequence[str] = HEALTH_KEYS
) -> DataFrame:
    """Engagement health from :func:`health_by_ids` and dimensions of one row per id.

    A rating or a spend counts once for each of its sessions, as if joined to the events.
    """
    joined = partials.join(users, "user_id", "left").join(items, "movie_id", "left")
    n = F.col("total_sessions")
    measured = joined.withColumns(
        {
            "imdb_sum": F.col("imdb_rating") * n,
            "imdb_count": F.when(F.col("imdb_rating").isNotNull(), n).otherwise(0),
            "spend_sum": F.col("monthly_spend") * n,
            "spend_count": F.when(F.col("monthly_spend").isNotNull(), n).otherwise(0),
        }
    )
    by_user = measured.groupBy(*WINDOW_BOUNDS, *keys, "user_id").agg(*[F.sum(c).alias(c) for c in _HEALTH_SUMS])
    return health_from_users(by_user, keys)


def health_approx(
    events: DataFrame, duration: str = WINDOW_DURATION, keys: Sequence[str] = HEALTH_KEYS
) -> DataFrame:
    """Engagement health with approximate users, as one streaming aggregate."""
    users = F.approx_count_distinct("user_id").alias("unique_users")
    return _health_columns(windowed(events, duration, keys, [users, *_health_sums()]), keys)


def engagement_health(
    events: DataFrame, duration: str = WINDOW_DURATION, keys: Sequence[str] = HEALTH_KEYS
) -> DataFrame:
    """Sessions, churn signals, KPIs and alert level per window and segment.

    ``revenue_impact`` and ``avg_subscriber_value`` weigh a user's monthly
    spend by their events, so a user with k events counts k times. Users or
    items unknown to the dimensions form segments with NULL values.
    """
    return health_from_users(health_by_user(events, duration, keys), keys)


def _health_columns(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(
        *WINDOW_BOUNDS,
        *keys,
        "total_sessions",
        "unique_users",
        stable_round(F.col("total_watch_minutes"), 1).alias("total_watch_minutes"),
        stable_round(_mean("progress_sum", "total_sessions"), 2).alias("avg_completion_pct"),
        stable_round(_mean("imdb_sum", "imdb_count"), 2).alias("avg_content_quality"),
        "low_engagement_count",
        "abandonment_count",
        "quality_downgrade_count",
        "completion_count",
        percentage("low_engagement_count", "total_sessions").alias("low_engagement_rate"),
        percentage("abandonment_count", "total_sessions").alias("abandonment_rate"),
        percentage("completion_count", "total_sessions").alias("completion_rate"),
        stable_round(F.col("spend_sum"), 2).alias("revenue_impact"),
        stable_round(_mean("spend_sum", "spend_count"), 2).alias("avg_subscriber_value"),
        alert_level("low_engagement_count", "total_sessions").alias("alert_level"),
    )


# -- real-time engagement ---------------------------------------------------


def user_activity(events: DataFrame, duration: str = "1 minute") -> DataFrame:
    """One row per window and active user; runs on a stream."""
    return windowed(events, duration, ["user_id"], [_rows().alias("events")])


def active_users_from_activity(activity: DataFrame) -> DataFrame:
    return activity.groupBy(*WINDOW_BOUNDS).agg(F.count("user_id").alias("active_users"))


def active_users(events: DataFrame, duration: str = "1 minute") -> DataFrame:
    """Distinct users per window."""
    return active_users_from_activity(user_activity(events, duration))


def active_users_approx(events: DataFrame, duration: str = "1 minute") -> DataFrame:
    return windowed(
        events, duration, [], [F.approx_count_distinct("user_id").alias("active_users")]
    )


def event_type_counts(events: DataFrame, duration: str = "1 hour") -> DataFrame:
    """Events per window and action; runs on a stream."""
    return windowed(events, duration, ["action"], [_rows().alias("event_count")])


def with_share(counts: DataFrame) -> DataFrame:
    total = F.sum("event_count").over(Window.partitionBy(*WINDOW_BOUNDS))
    return counts.withColumn("share", F.col("event_count") / total)


def event_type_distribution(events: DataFrame, duration: str = "1 hour") -> DataFrame:
    """Count and share of each action per window; no action is its own group."""
    return with_share(event_type_counts(events, duration))


def avg_session_duration(events: DataFrame, duration: str = "1 hour") -> DataFrame:
    """Mean watch duration per window; runs on a stream."""
    return windowed(
        events,
        duration,
        [],
        [
            F.count("watch_duration_minutes").alias("sessions"),
            F.avg("watch_duration_minutes").alias("avg_session_duration"),
        ],
    )
