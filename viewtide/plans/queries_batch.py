"""Catalogue entries: batch metrics over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame

from viewtide.functions.rounding import stable_round
from viewtide.operators import metrics
from viewtide.operators.star import star_join, star_user_months, valid_sessions
from viewtide.plans import domain
from viewtide.plans.catalog import query
from viewtide.plans.oracle import rounded


def sessions(spark, sf_dir, rated: bool = False) -> DataFrame:
    """Valid sessions of the star; the review join only where ratings are used."""
    return valid_sessions(
        star_join(
            domain.dated_watch(spark, sf_dir),
            domain.users(spark, sf_dir),
            domain.movies(spark, sf_dir),
            domain.reviews(spark, sf_dir) if rated else None,
        )
    )


def user_months_of(spark, sf_dir) -> DataFrame:
    """The user-month rollup, reduced before the user join."""
    return star_user_months(
        domain.dated_watch(spark, sf_dir),
        domain.users(spark, sf_dir),
        domain.movies(spark, sf_dir),
    )


def rounding(df: DataFrame, *columns: str, scale: int = 4) -> DataFrame:
    return df.withColumns({c: stable_round(df[c], scale) for c in columns})


_TIME = f"{rounded('SUM(watch_duration_minutes)')} AS total_watch_time_minutes"
_REACH = "COUNT(DISTINCT movie_id) AS unique_movies, COUNT(DISTINCT user_id) AS unique_users"


@query(
    "content_performance",
    f"""SELECT watch_year, watch_month, genre_primary, {rounded('AVG(user_rating)')} AS avg_rating,
               COUNT(*) AS total_views, {_TIME}, {_REACH}
        FROM v_sessions WHERE user_rating IS NOT NULL GROUP BY watch_year, watch_month, genre_primary""",
)
def content_performance(spark, sf_dir):
    result = metrics.content_performance(sessions(spark, sf_dir, rated=True))
    return rounding(result, "avg_rating", "total_watch_time_minutes")


@query(
    "genre_performance",
    f"""SELECT genre_primary, COUNT(*) AS total_views, {_TIME},
               {rounded('AVG(watch_duration_minutes)')} AS avg_watch_duration, {_REACH},
               {rounded('AVG(user_rating)')} AS avg_rating
        FROM v_sessions GROUP BY genre_primary ORDER BY total_watch_time_minutes DESC""",
)
def genre_performance(spark, sf_dir):
    result = metrics.genre_performance(sessions(spark, sf_dir, rated=True))
    result = rounding(result, "total_watch_time_minutes", "avg_watch_duration", "avg_rating")
    return result.orderBy(result["total_watch_time_minutes"].desc(), "genre_primary")


@query(
    "monthly_engagement",
    f"""SELECT watch_year, watch_month, country, subscription_plan, {_TIME},
               COUNT(DISTINCT user_id) AS monthly_active_users, COUNT(*) AS total_sessions,
               {rounded('AVG(watch_duration_minutes)')} AS avg_session_duration,
               COUNT(DISTINCT movie_id) AS unique_content_viewed
        FROM v_sessions GROUP BY watch_year, watch_month, country, subscription_plan""",
)
def monthly_engagement(spark, sf_dir):
    result = metrics.monthly_engagement(sessions(spark, sf_dir))
    return rounding(result, "total_watch_time_minutes", "avg_session_duration")


@query(
    "monthly_active_users",
    f"""SELECT watch_year, watch_month, COUNT(DISTINCT user_id) AS monthly_active_users,
               COUNT(DISTINCT country) AS countries, {_TIME}
        FROM v_sessions GROUP BY watch_year, watch_month""",
)
def monthly_active_users(spark, sf_dir):
    return rounding(
        metrics.active_users_from(user_months_of(spark, sf_dir)), "total_watch_time_minutes"
    )


@query(
    "mau_by_plan_country",
    """SELECT watch_year, watch_month, subscription_plan, country,
              COUNT(DISTINCT user_id) AS monthly_active_users
       FROM v_sessions GROUP BY watch_year, watch_month, subscription_plan, country""",
)
def mau_by_plan_country(spark, sf_dir):
    return metrics.mau_by_plan_country(user_months_of(spark, sf_dir))


@query(
    "user_months",
    f"""SELECT user_id, watch_year, watch_month, country, subscription_plan,
               MIN(watch_date) AS first_watch_date, {_TIME}, COUNT(*) AS total_sessions
        FROM v_sessions GROUP BY user_id, watch_year, watch_month, country, subscription_plan""",
)
def user_months(spark, sf_dir):
    """Rebalancing holds a task's groups to the session's advisory size, apart from the join's sort."""
    spread = sessions(spark, sf_dir).hint("rebalance")
    return rounding(metrics.user_months(spread), "total_watch_time_minutes")


@query(
    "user_cohorts",
    """SELECT user_id, MIN(watch_date) AS first_watch_date,
              CAST(YEAR(MIN(watch_date)) AS INTEGER) AS cohort_year,
              CAST(MONTH(MIN(watch_date)) AS INTEGER) AS cohort_month
       FROM v_sessions GROUP BY user_id""",
)
def user_cohorts(spark, sf_dir):
    return metrics.user_cohorts(user_months_of(spark, sf_dir))


@query(
    "star_user_months",
    f"""SELECT user_id, watch_year, watch_month, country, subscription_plan,
               MIN(watch_date) AS first_watch_date, {_TIME}, COUNT(*) AS total_sessions
        FROM v_sessions GROUP BY user_id, watch_year, watch_month, country, subscription_plan""",
)
def star_months(spark, sf_dir):
    """The same rollup, reduced before the user join."""
    return rounding(user_months_of(spark, sf_dir), "total_watch_time_minutes")


@query("cohort_retention", "SELECT * FROM v_retention")
def cohort_retention(spark, sf_dir):
    return metrics.retention_from(user_months_of(spark, sf_dir))


@query(
    "retention_rate",
    f"""SELECT r.*, s.active_users AS cohort_size,
               {rounded('r.active_users / s.active_users', 6)} AS retention_rate
        FROM v_retention r JOIN (SELECT * FROM v_retention WHERE months_since_cohort = 0) s
          ON r.cohort_year = s.cohort_year AND r.cohort_month = s.cohort_month""",
)
def retention_rate(spark, sf_dir):
    result = metrics.retention_rate(metrics.retention_from(user_months_of(spark, sf_dir)))
    return rounding(result, "retention_rate", scale=6)


@query(
    "monthly_churn",
    f"""WITH a AS (SELECT DISTINCT user_id, watch_year, watch_month,
                          watch_year * 12 + watch_month AS m FROM v_sessions)
        SELECT a.watch_year, a.watch_month, COUNT(*) AS active_users,
               COUNT(*) FILTER (WHERE n.user_id IS NULL) AS churned_users,
               {rounded('COUNT(*) FILTER (WHERE n.user_id IS NULL) / COUNT(*)', 6)} AS churn_rate
        FROM a LEFT JOIN a n ON a.user_id = n.user_id AND n.m = a.m + 1
        WHERE a.m < (SELECT MAX(m) FROM a) GROUP BY a.watch_year, a.watch_month""",
)
def monthly_churn(spark, sf_dir):
    return rounding(metrics.monthly_churn(user_months_of(spark, sf_dir)), "churn_rate", scale=6)


@query(
    "skip_rate_trend",
    f"""SELECT watch_year, watch_month, COUNT(*) AS total_sessions,
               COUNT(progress_percentage) AS sessions_with_progress,
               COUNT(*) FILTER (WHERE progress_percentage < 20) AS skipped_sessions,
               {rounded('COUNT(*) FILTER (WHERE progress_percentage < 20) / COUNT(progress_percentage)',
                        6)} AS skip_rate,
               {rounded('AVG(watch_duration_minutes)')} AS avg_watch_duration
        FROM v_sessions GROUP BY watch_year, watch_month""",
)
def skip_rate_trend(spark, sf_dir):
    result = metrics.skip_rate_trend(sessions(spark, sf_dir))
    return rounding(rounding(result, "avg_watch_duration"), "skip_rate", scale=6)


@query(
    "genre_trend",
    f"""SELECT watch_year, watch_month, genre_primary, COUNT(*) AS total_views, {_TIME},
               {rounded('AVG(watch_duration_minutes)')} AS avg_watch_duration, {_REACH}
        FROM v_sessions GROUP BY watch_year, watch_month, genre_primary""",
)
def genre_trend(spark, sf_dir):
    result = metrics.genre_trend(sessions(spark, sf_dir))
    return rounding(result, "total_watch_time_minutes", "avg_watch_duration")
