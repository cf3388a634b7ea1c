"""Batch metrics over valid sessions of the star.

Input columns: ``watch_year``, ``watch_month``, ``watch_date_parsed``,
``user_id``, ``movie_id``, ``watch_duration_minutes`` and the dimensions named
in each metric. Results are unordered; ``PRESENTATION_ORDER`` gives the order
to write them in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.functions.eventtime import month_index
from viewtide.functions.missing import missing
from viewtide.functions.signals import LOW_ENGAGEMENT_BELOW

MONTH = ["watch_year", "watch_month"]
COHORT = ["cohort_year", "cohort_month"]
WATCHED = "watch_duration_minutes"

#: Sort keys applied when a result is written; ``-`` marks a descending key.
PRESENTATION_ORDER = {
    "content_performance": [*MONTH, "genre_primary"],
    "genre_performance": ["-total_watch_time_minutes", "genre_primary"],
    "monthly_engagement": [*MONTH, "country", "subscription_plan"],
    "monthly_active_users": MONTH,
    "cohort_retention": [*COHORT, *MONTH],
}


def _reach(sessions: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Per group: views, the sums, and the distinct users and items.

    Two distinct counts in one grouping triple every row. Here a session becomes one row
    for its user, which carries the sums, and one for its item; they shrink to a row per
    group and user or item before the shuffle, and counting those is a plain count.
    """
    sides = F.array(
        F.struct(F.lit(True).alias("of_user"), F.col("user_id").alias("user"), F.lit(None).alias("item")),
        F.struct(F.lit(False).alias("of_user"), F.lit(None).alias("user"), F.col("movie_id").alias("item")),
    )
    rows = sessions.select(*keys, *(c.alias(name) for name, c in sums.items()), F.inline(sides))
    single = rows.groupBy(*keys, "of_user", "user", "item").agg(
        F.count_if("of_user").alias("views"),
        *(F.sum(F.when(F.col("of_user"), F.col(name))).alias(name) for name in sums),
    )
    return single.groupBy(*keys).agg(
        F.sum("views").alias("views"),
        *(F.sum(name).alias(name) for name in sums),
        F.count("user").alias("users"),
        F.count("item").alias("items"),
    )


def _present(name: str) -> Column:
    return F.col(name).isNotNull().cast("long")


def content_performance(sessions: DataFrame) -> DataFrame:
    """Ratings and reach per month and genre, over rated sessions only."""
    rated = sessions.filter(~missing(sessions, "user_rating"))
    keys = [*MONTH, "genre_primary"]
    reach = _reach(rated, keys, {"ratings": F.col("user_rating"), "watched": F.col(WATCHED)})
    return reach.select(
        *keys,
        (F.col("ratings") / F.col("views")).alias("avg_rating"),
        F.col("views").alias("total_views"),
        F.col("watched").alias("total_watch_time_minutes"),
        F.col("items").alias("unique_movies"),
        F.col("users").alias("unique_users"),
    )


def genre_performance(sessions: DataFrame) -> DataFrame:
    """Views, time and reach per genre; unrated sessions count too."""
    sums = {
        "watched": F.col(WATCHED),
        "watches": _present(WATCHED),
        "ratings": F.col("user_rating"),
        "rated": _present("user_rating"),
    }
    return _reach(sessions, ["genre_primary"], sums).select(
        "genre_primary",
        F.col("views").alias("total_views"),
        F.col("watched").alias("total_watch_time_minutes"),
        F.try_divide("watched", "watches").alias("avg_watch_duration"),
        F.col("items").alias("unique_movies"),
        F.col("users").alias("unique_users"),
        F.try_divide("ratings", "rated").alias("avg_rating"),
    )


def monthly_engagement(sessions: DataFrame) -> DataFrame:
    """Watch time, users and sessions per month, country and plan."""
    keys = [*MONTH, "country", "subscription_plan"]
    sums = {"watched": F.col(WATCHED), "watches": _present(WATCHED)}
    return _reach(sessions, keys, sums).select(
        *keys,
        F.col("watched").alias("total_watch_time_minutes"),
        F.col("users").alias("monthly_active_users"),
        F.col("views").alias("total_sessions"),
        F.try_divide("watched", "watches").alias("avg_session_duration"),
        F.col("items").alias("unique_content_viewed"),
    )


def _views():
    return F.count(F.lit(1))


def user_months(sessions: DataFrame) -> DataFrame:
    """One row per user, month, country and plan: the rollup behind user metrics.

    Active users, cohorts, retention and churn all need a user's months rather
    than the sessions. From a written star this groups its rows; from the
    tables themselves, ``star_user_months`` gets it without joining sessions to
    users. Every later grouping by user works on at most (months) rows per user.
    """
    return sessions.groupBy("user_id", *MONTH, "country", "subscription_plan").agg(
        F.min("watch_date_parsed").alias("first_watch_date"),
        F.sum(WATCHED).alias("total_watch_time_minutes"),
        _views().alias("total_sessions"),
    )


def active_users_from(months: DataFrame) -> DataFrame:
    """:func:`monthly_active_users` from :func:`user_months`."""
    return months.groupBy(*MONTH).agg(
        F.count_distinct("user_id").alias("monthly_active_users"),
        F.count_distinct("country").alias("countries"),
        F.sum("total_watch_time_minutes").alias("total_watch_time_minutes"),
    )


def monthly_active_users(sessions: DataFrame) -> DataFrame:
    """Users, countries and watch time per month.

    Two distinct counts triple the rows they read, so the sessions are first
    reduced to one row per user and month.
    """
    rollup = sessions.groupBy("user_id", *MONTH, "country").agg(
        F.sum(WATCHED).alias("total_watch_time_minutes")
    )
    return active_users_from(rollup)


def mau_by_plan_country(rows: DataFrame) -> DataFrame:
    """Active users per month, plan and country, from sessions or user months."""
    return (
        rows.groupBy(*MONTH, "subscription_plan", "country")
        .agg(F.count_distinct("user_id").alias("monthly_active_users"))
    )


def user_cohorts(rows: DataFrame) -> DataFrame:
    """The first watch date of each user, and its year and month.

    Takes sessions or their :func:`user_months`.
    """
    time = "first_watch_date" if "first_watch_date" in rows.columns else "watch_date_parsed"
    first = rows.groupBy("user_id").agg(F.min(time).alias("first_watch_date"))
    return first.withColumns(
        {"cohort_year": F.year("first_watch_date"), "cohort_month": F.month("first_watch_date")}
    )


def _active_months(rows: DataFrame, time: str) -> DataFrame:
    return rows.groupBy("user_id", *MONTH).agg(F.min(time).alias("first_in_month"))


def _retention(active_months: DataFrame) -> DataFrame:
    first = F.min("first_in_month").over(Window.partitionBy("user_id"))
    return (
        active_months.withColumn("cohort", first)
        .groupBy(
            F.year("cohort").alias("cohort_year"), F.month("cohort").alias("cohort_month"), *MONTH
        )
        .agg(F.count("user_id").alias("active_users"))
        .withColumn("months_since_cohort", month_index(*MONTH) - month_index(*COHORT))
    )


def cohort_retention(sessions: DataFrame) -> DataFrame:
    """Users of each first-watch month active in each later month.

    Sessions are reduced to a user's months before they meet by user. The
    cohort is then the minimum over those few rows, so the sessions are neither
    joined to themselves nor sorted by user, and counting rows counts users.
    """
    return _retention(_active_months(sessions, "watch_date_parsed"))


def retention_from(months: DataFrame) -> DataFrame:
    """:func:`cohort_retention` from :func:`user_months`.

    A user has a row a month at most for each country and plan, so one exchange by user
    serves both the grouping and the cohort.
    """
    return _retention(_active_months(months.repartition("user_id"), "first_watch_date"))


def retention_rate(retention: DataFrame) -> DataFrame:
    """Retention counts with cohort size and the share still active.

    The cohort size is its count at month 0, when every member is active.
    """
    at_start = F.when(F.col("months_since_cohort") == 0, F.col("active_users"))
    size = F.max(at_start).over(Window.partitionBy(*COHORT))
    return retention.withColumn("cohort_size", size).withColumn(
        "retention_rate", F.try_divide("active_users", "cohort_size")
    )


def monthly_churn(rows: DataFrame) -> DataFrame:
    """Users active in a month and absent in the next; the last month is open.

    Takes sessions or their :func:`user_months`.
    """
    active = rows.select("user_id", *MONTH).distinct().withColumn("m", month_index(*MONTH))
    following = F.lead("m").over(Window.partitionBy("user_id").orderBy("m"))
    per_month = (
        active.withColumn("lost", ~following.eqNullSafe(F.col("m") + 1))
        .groupBy(*MONTH, "m")
        .agg(_views().alias("active_users"), F.count_if("lost").alias("churned_users"))
    )
    # One row per month is left, so the unpartitioned window is as small.
    last = F.max("m").over(Window.partitionBy())
    return (
        per_month.withColumn("last", last)
        .filter("m < last")
        .select(
            *MONTH,
            "active_users",
            "churned_users",
            (F.col("churned_users") / F.col("active_users")).alias("churn_rate"),
        )
    )


def skip_rate_trend(sessions: DataFrame, skipped_below: float = LOW_ENGAGEMENT_BELOW) -> DataFrame:
    """Share of sessions stopped early, and mean duration, per month.

    Sessions without progress are left out of the share.
    """
    known = ~missing(sessions, "progress_percentage")
    skipped = F.when(known, (F.col("progress_percentage") < skipped_below).cast("int"))
    return sessions.groupBy(*MONTH).agg(
        _views().alias("total_sessions"),
        F.count(skipped).alias("sessions_with_progress"),
        F.sum(skipped).alias("skipped_sessions"),
        F.avg(skipped).alias("skip_rate"),
        F.avg(WATCHED).alias("avg_watch_duration"),
    )


def genre_trend(sessions: DataFrame) -> DataFrame:
    """Genre performance per month; unrated sessions count too."""
    keys = [*MONTH, "genre_primary"]
    return _reach(sessions, keys, {"watched": F.col(WATCHED), "watches": _present(WATCHED)}).select(
        *keys,
        F.col("views").alias("total_views"),
        F.col("watched").alias("total_watch_time_minutes"),
        F.try_divide("watched", "watches").alias("avg_watch_duration"),
        F.col("items").alias("unique_movies"),
        F.col("users").alias("unique_users"),
    )


def genre_country_views(rows: DataFrame) -> DataFrame:
    """Views per genre and country; runs on a stream in complete mode."""
    return rows.groupBy("genre_primary", "country").agg(_views().alias("views"))


def top_from_views(views: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most viewed genres and countries, both from one small rollup."""
    pairs = F.inline(
        F.array(
            *[
                F.struct(F.lit(name).alias("dimension"), F.col(source).alias("value"), F.col("views"))
                for name, source in (("genre", "genre_primary"), ("country", "country"))
            ]
        )
    )
    totals = (
        views.select(pairs)
        .filter(F.col("value").isNotNull())
        .groupBy("dimension", "value")
        .agg(F.sum("views").alias("total_views"))
    )
    rank = F.row_number().over(
        Window.partitionBy("dimension").orderBy(F.desc("total_views"), "value")
    )
    return totals.withColumn("position", rank).filter(F.col("position") <= n)


def top_genres_countries(rows: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most viewed genres and countries; ties go by name."""
    return top_from_views(genre_country_views(rows), n)
