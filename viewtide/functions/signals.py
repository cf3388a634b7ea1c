"""Engagement signals of one event and the KPIs built from their counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.functions.missing import missing
from viewtide.functions.rounding import stable_round

# Fixed values of the metric definitions.
LOW_ENGAGEMENT_BELOW = 20.0
ABANDONED_BELOW = 50
REDUCED_QUALITIES = ("SD", "HD")
HIGH_RISK_ABOVE = 0.6
MEDIUM_RISK_ABOVE = 0.4


def zero_if_missing(df: DataFrame, name: str) -> Column:
    return F.when(missing(df, name), F.lit(0).cast(df.schema[name].dataType)).otherwise(F.col(name))


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def with_engagement_flags(
    events: DataFrame,
    low_engagement_below: float = LOW_ENGAGEMENT_BELOW,
    abandoned_below: float = ABANDONED_BELOW,
) -> DataFrame:
    """Zero-fill progress and duration, then add four 0/1 flags.

    A missing progress counts as 0 and thus as low engagement.
    ``is_quality_downgrade`` is a level test (SD or HD): no earlier quality of
    the session is looked at.
    """
    filled = events.withColumns(
        {
            name: zero_if_missing(events, name)
            for name in ("progress_percentage", "watch_duration_minutes")
        }
    )
    progress = F.col("progress_percentage")
    return filled.withColumns(
        {
            "is_low_engagement": _flag(progress < low_engagement_below),
            "is_quality_downgrade": _flag(F.col("quality").isin(*REDUCED_QUALITIES)),
            "is_abandoned": _flag((F.col("action") == "stopped") & (progress < abandoned_below)),
            "is_completed": _flag(F.col("action") == "completed"),
        }
    )


def percentage(part: str, whole: str, scale: int = 2) -> Column:
    return stable_round(F.col(part) / F.col(whole) * 100, scale)


def alert_level(
    part: str,
    whole: str,
    high_above: float = HIGH_RISK_ABOVE,
    medium_above: float = MEDIUM_RISK_ABOVE,
) -> Column:
    """HIGH, MEDIUM or LOW by the unrounded ratio; both limits are exclusive."""
    ratio = F.col(part) / F.col(whole)
    return F.when(ratio > high_above, "HIGH").when(ratio > medium_above, "MEDIUM").otherwise("LOW")
