"""Distinct viewers that can be added up: sketches kept with short windows.

Exact viewers of an hour do not follow from those of its minutes. A sketch of the users does:
the windows of a stored table are merged into longer ones without the events.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.operators.windowed import TRENDING_KEYS, WINDOW_DURATION, windowed

#: Registers of a sketch as a power of two, and how many standard errors its bounds allow.
LG_K, ERRORS = 14, 3
SUMS = ["view_count", "total_watch_time_min", "completed_views"]


def relative_error(lg_k: int = LG_K, errors: int = ERRORS) -> float:
    return errors * 1.04 / math.sqrt(1 << lg_k)


def viewer_windows(
    events: DataFrame,
    duration: str = WINDOW_DURATION,
    keys: Sequence[str] = TRENDING_KEYS,
    lg_k: int = LG_K,
) -> DataFrame:
    """Additive measures and a sketch of the users per window and keys; runs on a stream."""
    measures = [
        F.count(F.lit(1)).alias("view_count"),
        F.sum("watch_duration_minutes").alias("total_watch_time_min"),
        F.count_if(F.col("action") == "completed").alias("completed_views"),
        F.hll_sketch_agg("user_id", F.lit(lg_k)).alias("viewers_sketch"),
    ]
    return windowed(events, duration, keys, measures)


def merged_windows(windows: DataFrame, duration: str, keys: Sequence[str] = TRENDING_KEYS) -> DataFrame:
    """Stored windows merged into longer ones, by fewer keys if wanted; may be merged again."""
    measures: list[Column] = [F.sum(c).alias(c) for c in SUMS]
    measures.append(F.hll_union_agg("viewers_sketch").alias("viewers_sketch"))
    return windowed(windows.drop("window_end"), duration, keys, measures, time="window_start")


def with_viewers(windows: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """The sketches as counts with bounds.

    Sketches of few users hold every one of them, and count exactly; larger ones err by more
    than the bounds in about one of 400 cases.
    """
    error = relative_error(lg_k)
    viewers = F.hll_sketch_estimate("viewers_sketch")
    counted = windows.withColumn("viewers", F.coalesce(viewers, F.lit(0)).cast("long"))
    low = F.floor(F.col("viewers") * F.lit(1 - error)).cast("long")
    high = F.ceil(F.col("viewers") * F.lit(1 + error)).cast("long")
    kept = [c for c in counted.columns if c not in ("viewers_sketch", "viewers")]
    return counted.select(*kept, "viewers", low.alias("viewers_low"), high.alias("viewers_high"))


