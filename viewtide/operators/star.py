"""The star join: sessions with their user, item and review rating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.functions.eventtime import with_watch_month
from viewtide.functions.missing import missing


def review_ratings(reviews: DataFrame) -> DataFrame:
    """Average rating per (user, item): one row per pair, so no fan-out when joined."""
    return reviews.groupBy("user_id", "movie_id").agg(F.avg("rating").alias("user_rating"))


def star_join(
    watch: DataFrame, users: DataFrame, items: DataFrame, reviews: DataFrame | None = None
) -> DataFrame:
    """Sessions with their user and item; optionally with the review average.

    Sessions of unknown users or items are dropped. With ``reviews``, the
    average replaces any ``user_rating`` the sessions carry and is NULL where
    the user never reviewed the item; leave it out for metrics that do not need
    ratings, as it costs a shuffle of the sessions by (user, item).

    No join is hinted. Spark broadcasts a side only when its measured size is
    below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and
    merges. Adaptive execution splits the partition of a hot user or item,
    provided what follows is grouped by something else; metrics grouped by user
    should start from :func:`star_user_months`.
    """
    if reviews is None:
        return watch.join(users, "user_id").join(items, "movie_id")
    # The widest side comes last: ratings meet sessions that carry nothing else yet, and titles
    # are carried by no shuffle of the joins.
    rated = watch.drop("user_rating").join(review_ratings(reviews), ["user_id", "movie_id"], "left")
    return rated.join(users.drop("user_rating"), "user_id").join(items.drop("user_rating"), "movie_id")


def valid_sessions(star: DataFrame) -> DataFrame:
    """Sessions the metrics count: a parsed date and a duration are present."""
    dated = star if "watch_date_parsed" in star.columns else with_watch_month(star)
    return dated.filter(
        F.col("watch_date_parsed").isNotNull() & ~missing(dated, "watch_duration_minutes")
    )


def star_user_months(watch: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Per user and month: first date, watch time, sessions, and the user's attributes.

    The same rows as grouping the star by user and month, in another order:
    sessions are reduced before they meet the users. They are combined
    map-side, so a user with a third of all sessions ships one row per task and
    month, and the users join a table of user-months instead of sessions.
    """
    played = valid_sessions(watch).join(items.select("movie_id"), "movie_id")
    months = played.groupBy("user_id", "watch_year", "watch_month").agg(
        F.min("watch_date_parsed").alias("first_watch_date"),
        F.sum("watch_duration_minutes").alias("total_watch_time_minutes"),
        F.count(F.lit(1)).alias("total_sessions"),
    )
    return months.join(users.select("user_id", "country", "subscription_plan"), "user_id")
