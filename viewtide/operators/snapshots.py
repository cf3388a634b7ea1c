"""Ranked and summary queries over a result table or stream snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.functions.rounding import stable_round

TOP_N = 10


def top_trending(trending: DataFrame, n: int = TOP_N) -> DataFrame:
    """The ``n`` most viewed window and item pairs; ties go to the earlier window."""
    return (
        trending.orderBy(F.desc("view_count"), "window_start", "movie_id")
        .limit(n)
        .select(
            "window_start",
            "window_end",
            "title",
            "genre_primary",
            "view_count",
            "unique_viewers",
            stable_round(F.col("avg_completion_pct"), 1).alias("completion_pct"),
            stable_round(F.col("total_watch_time_min"), 1).alias("watch_time_min"),
        )
    )


def top_risk_segments(health: DataFrame, n: int = TOP_N, min_sessions: int = 1) -> DataFrame:
    """The ``n`` segments with the most low engagement, larger ones first.

    Remaining ties are broken by window and segment, for a repeatable result.
    """
    segment = ["window_start", "country", "genre_primary", "device_type", "quality"]
    rest = [c for c in ("is_original", "content_type") if c in health.columns]
    return (
        health.filter(F.col("total_sessions") >= min_sessions)
        .orderBy(
            F.desc("low_engagement_rate"),
            F.desc("total_sessions"),
            *[F.asc_nulls_first(c) for c in [*segment, *rest]],
        )
        .limit(n)
        .select(
            *segment,
            "total_sessions",
            "unique_users",
            "avg_completion_pct",
            "low_engagement_rate",
            "abandonment_rate",
            "alert_level",
        )
    )


def overall_health(health: DataFrame) -> DataFrame:
    """Segments, sessions, mean churn risk and high-risk segments, as one row."""
    return health.agg(
        F.count(F.lit(1)).alias("total_segments"),
        F.sum("total_sessions").alias("total_sessions"),
        F.avg("low_engagement_rate").alias("avg_churn_risk"),
        F.count_if(F.col("alert_level") == "HIGH").alias("high_risk_segments"),
    )
