"""Feature tables per user and per title, for segmentation, churn and popularity."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.functions.missing import missing
from viewtide.operators.asof import as_of_join
from viewtide.operators.cleaning import impute_constant
from viewtide.operators.distribution import column_quantiles

RFM = ("recency_days", "frequency", "monetary")


def last_date(watch: DataFrame, time: str = "watch_date") -> datetime:
    """The latest session date, the default point of view of a feature table."""
    return watch.agg(F.max(time)).first()[0]


def rfm_features(
    watch: DataFrame, users: DataFrame, as_of: datetime | None = None, time: str = "watch_date"
) -> DataFrame:
    """Recency, frequency and monetary value per user.

    Sessions are reduced to one row per user before the users are joined. All users
    stay: those without sessions have ``has_sessions`` false, no recency and a frequency of
    0, and those missing from ``users`` have ``is_known`` false. A missing spend counts
    as 0. Sessions without a user belong to none.
    """
    as_of = as_of or last_date(watch, time)
    activity = watch.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.date_diff(F.lit(as_of), F.max(time)).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
    )
    spend = users.select("user_id", F.col("monthly_spend").alias("monetary"), F.lit(True).alias("is_known"))
    joined = activity.join(spend, "user_id", "full").select(
        "user_id",
        "recency_days",
        F.coalesce("frequency", F.lit(0)).alias("frequency"),
        "monetary",
        F.col("frequency").isNotNull().alias("has_sessions"),
        F.coalesce("is_known", F.lit(False)).alias("is_known"),
    )
    return impute_constant(joined, {"monetary": 0.0})


def _score(column: str, cuts: Sequence[float], highest_first: bool) -> Column:
    above = reduce(lambda a, b: a + b, [(F.col(column) > cut).cast("int") for cut in cuts])
    return above + 1 if not highest_first else F.lit(len(cuts) + 1) - above


def rfm_scores(features: DataFrame, groups: int = 5) -> DataFrame:
    """Scores 1 to ``groups`` by exact quantiles; recent users score high.

    Ranking users by a global window would sort them in one task. The quantile
    limits are a few numbers instead, and scoring is a projection. Equal values
    score alike. Users without sessions (``has_sessions``) shift no limit and have no scores.
    """
    points = [i / groups for i in range(1, groups)]
    scored = F.col("has_sessions") if "has_sessions" in features.columns else F.lit(True)
    cuts = column_quantiles(features.filter(scored), {column: points for column in RFM})
    scores = {}
    for column, letter in zip(RFM, "rfm"):
        score = F.lit(None).cast("int")
        if cuts[column][0] is not None:
            score = _score(column, cuts[column], highest_first=column == "recency_days")
        scores[f"{letter}_score"] = F.when(scored, score)
    return features.withColumns(scores)


def churn_features(
    watch: DataFrame,
    users: DataFrame,
    cutoff: datetime | None = None,
    horizon_days: int = 90,
    time: str = "watch_date",
    changes: DataFrame | None = None,
    ties: Sequence[str] = (),
    label: str | None = None,
) -> DataFrame:
    """What is known of each user before ``cutoff``, and whether they then left.

    ``churned`` is 1 for users without a session in the ``horizon_days`` from
    ``cutoff`` on, which defaults to that long before the last session. One grouping of
    the sessions gives features and label. All users stay: those unseen before the cutoff
    have ``seen_before`` false and no label, and those missing from ``users`` have
    ``is_known`` false.

    Attributes are those of ``users``, or, with ``changes`` (user_id, changed_at and the
    attributes), as they were at the cutoff. ``label`` names a column of ``changes``,
    such as ``is_active``: users then churn who are not active at the horizon's end, and whose
    state is unknown have no label.
    """
    cutoff = cutoff or last_date(watch, time) - timedelta(days=horizon_days)
    known = F.col(time) < F.lit(cutoff)
    later = (F.col(time) >= F.lit(cutoff)) & (
        F.col(time) < F.lit(cutoff + timedelta(days=horizon_days))
    )

    def before(name: str) -> Column:
        return F.when(known & ~missing(watch, name), F.col(name))

    activity = watch.groupBy("user_id").agg(
        F.count_if(known).alias("sessions"),
        F.coalesce(F.sum(before("watch_duration_minutes")), F.lit(0.0)).alias("watch_minutes"),
        F.coalesce(F.avg(before("progress_percentage")), F.lit(0.0)).alias("avg_progress"),
        F.count_if(known & (F.col("action") == "completed")).alias("completed_sessions"),
        F.date_diff(F.lit(cutoff), F.max(F.when(known, F.col(time)))).alias("days_since_last"),
        (F.count_if(later) == 0).cast("int").alias("churned"),
    )
    names = ["country", "subscription_plan", "monthly_spend"]
    known_users = users.select("user_id", *([] if changes is not None else names), F.lit(True).alias("is_known"))
    table = activity.filter(F.col("user_id").isNotNull()).join(known_users, "user_id", "full")
    numbers = {"sessions": 0, "watch_minutes": 0.0, "avg_progress": 0.0, "completed_sessions": 0}
    table = table.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in numbers.items()}).withColumns(
        {"seen_before": F.col("sessions") > 0, "is_known": F.coalesce("is_known", F.lit(False))}
    )
    table = table.withColumn("churned", F.when(F.col("seen_before"), F.col("churned")))
    if changes is not None:
        # At the cutoff itself a change is not known yet.
        before = changes.filter(F.col("changed_at") < F.lit(cutoff))
        table = _state_at(table, before, cutoff, names, ties)
        if label:
            end = cutoff + timedelta(days=horizon_days)
            state = _state_at(table, changes.filter(F.col("changed_at") < F.lit(end)), end, [label], ties)
            left = F.when(F.col("seen_before"), (~F.col(label)).cast("int"))
            table = state.withColumn("churned", left).drop(label)
    first = ["user_id", "country", "subscription_plan", "monthly_spend"]
    ordered = table.select(*first, *[c for c in table.columns if c not in first])
    return impute_constant(ordered, {"monthly_spend": 0.0})


def _state_at(table: DataFrame, changes: DataFrame, at: datetime, columns: Sequence[str], ties: Sequence[str]) -> DataFrame:
    asked = table.withColumn("__at", F.lit(at))
    return as_of_join(asked, changes, "user_id", "__at", columns, ties=ties).drop("__at", "as_of")


def weekly_popularity(
    watch: DataFrame, time: str = "watch_date", keys: Sequence[str] = ("movie_id",)
) -> DataFrame:
    """Views and watch time per title and week, with the week before.

    A week without views has no row; the row after it has 0 previous views.
    The window runs over one row per title and week.
    """
    weekly = watch.groupBy(*keys, F.date_trunc("week", time).cast("date").alias("week")).agg(
        F.count(F.lit(1)).alias("views"),
        F.sum("watch_duration_minutes").alias("watch_minutes"),
    )
    order = Window.partitionBy(*keys).orderBy("week")
    adjacent = F.lag("week").over(order) == F.date_sub("week", 7)
    return weekly.withColumn(
        "previous_views", F.when(adjacent, F.lag("views").over(order)).otherwise(0)
    ).withColumn("view_change", F.col("views") - F.col("previous_views"))
