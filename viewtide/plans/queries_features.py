"""Catalogue entries: user and title features, and the models over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewtide.operators import features, models
from viewtide.operators.asof import as_of_join
from viewtide.operators.star import review_ratings
from viewtide.plans import domain
from viewtide.plans.catalog import query
from viewtide.plans.oracle import rounded
from viewtide.plans.queries_batch import rounding
from viewtide.session import freed_shuffles, materialise


def rfm(spark, sf_dir):
    return features.rfm_features(domain.watch(spark, sf_dir), domain.users(spark, sf_dir))


_RFM = """
    SELECT COALESCE(w.user_id, u.user_id) AS user_id, recency_days, COALESCE(frequency, 0) AS frequency,
           COALESCE(monthly_spend, 0) AS monetary, frequency IS NOT NULL AS has_sessions,
           u.user_id IS NOT NULL AS is_known
    FROM (SELECT user_id, CAST(date_diff('day', MAX(watch_date), (SELECT MAX(watch_date) FROM v_watch))
                            AS INTEGER) AS recency_days, COUNT(*) AS frequency
          FROM v_watch GROUP BY user_id) w FULL JOIN v_users u ON w.user_id = u.user_id"""


def _score(column: str) -> str:
    return " + ".join(
        f"CASE WHEN {column} > (SELECT quantile_cont({column}, {i / 5}) FROM r WHERE has_sessions) THEN 1 ELSE 0 END"
        for i in range(1, 5)
    )


@query(
    "rfm_scores",
    f"""WITH r AS ({_RFM})
        SELECT *, CASE WHEN has_sessions THEN CAST(5 - ({_score('recency_days')}) AS INTEGER) END AS r_score,
               CASE WHEN has_sessions THEN CAST(1 + {_score('frequency')} AS INTEGER) END AS f_score,
               CASE WHEN has_sessions THEN CAST(1 + {_score('monetary')} AS INTEGER) END AS m_score
        FROM r""",
)
def rfm_scores(spark, sf_dir):
    # Scoring reads its input several times.
    return features.rfm_scores(materialise(rfm(spark, sf_dir), "rfm"))


_CUTOFF = "(SELECT MAX(watch_date) - INTERVAL 90 DAY FROM v_watch)"


#: What the sessions tell of each user before the cutoff, and of the 90 days after it.
_SEEN = f"""SELECT user_id, COUNT(*) FILTER (WHERE known) AS sessions,
                     {rounded("COALESCE(SUM(watch_duration_minutes) FILTER (WHERE known), 0)")}
                       AS watch_minutes,
                     {rounded("COALESCE(AVG(progress_percentage) FILTER (WHERE known), 0)")}
                       AS avg_progress,
                     COUNT(*) FILTER (WHERE known AND action = 'completed') AS completed_sessions,
                     CAST(date_diff('day', MAX(watch_date) FILTER (WHERE known), ANY_VALUE(cutoff))
                       AS INTEGER) AS days_since_last,
                     COUNT(*) FILTER (WHERE watch_date >= cutoff
                                      AND watch_date < cutoff + INTERVAL 90 DAY) AS later
              FROM (SELECT *, {_CUTOFF} AS cutoff, watch_date < {_CUTOFF} AS known FROM v_watch) x
              GROUP BY user_id"""
_KNOWN = """COALESCE(sessions, 0) AS sessions, COALESCE(watch_minutes, 0) AS watch_minutes,
               COALESCE(avg_progress, 0) AS avg_progress, COALESCE(completed_sessions, 0) AS completed_sessions,
               days_since_last, u.user_id IS NOT NULL AS is_known, COALESCE(sessions, 0) > 0 AS seen_before"""

_CHURN = f"""SELECT COALESCE(w.user_id, u.user_id) AS user_id, u.country, u.subscription_plan,
               COALESCE(u.monthly_spend, 0) AS monthly_spend, {_KNOWN},
               CAST(CASE WHEN sessions > 0 THEN CASE WHEN later = 0 THEN 1 ELSE 0 END END AS INTEGER) AS churned
        FROM ({_SEEN}) w FULL JOIN v_users u ON w.user_id = u.user_id"""


@query("churn_features", _CHURN)
def churn_features(spark, sf_dir):
    table = features.churn_features(domain.watch(spark, sf_dir), domain.users(spark, sf_dir))
    return rounding(table, "watch_minutes", "avg_progress")


@query(
    "weekly_popularity",
    f"""WITH w AS (SELECT movie_id, CAST(date_trunc('week', watch_date) AS DATE) AS week,
                         COUNT(*) AS views, SUM(watch_duration_minutes) AS minutes
                  FROM v_watch GROUP BY ALL)
        SELECT w.movie_id, w.week, w.views, {rounded('w.minutes')} AS watch_minutes,
               COALESCE(p.views, 0) AS previous_views,
               w.views - COALESCE(p.views, 0) AS view_change
        FROM w LEFT JOIN w p ON w.movie_id = p.movie_id AND p.week = w.week - 7""",
)
def weekly_popularity(spark, sf_dir):
    return rounding(features.weekly_popularity(domain.watch(spark, sf_dir)), "watch_minutes")


def _state(until: str) -> str:
    return f"""(SELECT user_id, arg_max(country, (changed_at, change_id)) AS country,
            arg_max(subscription_plan, (changed_at, change_id)) AS subscription_plan,
            arg_max(monthly_spend, (changed_at, change_id)) AS monthly_spend,
            arg_max(is_active, (changed_at, change_id)) AS is_active
        FROM v_changes WHERE changed_at < {until} GROUP BY user_id)"""


_CHURN_THEN = f"""SELECT k.user_id, b.country, b.subscription_plan, COALESCE(b.monthly_spend, 0) AS monthly_spend,
               sessions, watch_minutes, avg_progress, completed_sessions, days_since_last, is_known, seen_before,
               CAST(CASE WHEN seen_before THEN CASE WHEN e.is_active THEN 0 WHEN NOT e.is_active THEN 1 END END
                 AS INTEGER) AS churned
        FROM (SELECT COALESCE(w.user_id, u.user_id) AS user_id, {_KNOWN}
              FROM ({_SEEN}) w FULL JOIN v_users u ON w.user_id = u.user_id) k
        LEFT JOIN {_state(_CUTOFF)} b ON k.user_id = b.user_id
        LEFT JOIN {_state(_CUTOFF + " + INTERVAL 90 DAY")} e ON k.user_id = e.user_id"""


def churn_then(spark, sf_dir):
    """Attributes as they were at the cutoff; users churn who are not active 90 days later."""
    return features.churn_features(
        domain.watch(spark, sf_dir),
        domain.users(spark, sf_dir),
        changes=domain.changes(spark, sf_dir),
        ties=["change_id"],
        label="is_active",
    )


@query("churn_features_as_of", _CHURN_THEN)
def churn_features_as_of(spark, sf_dir):
    return rounding(churn_then(spark, sf_dir), "watch_minutes", "avg_progress")


@query(
    "attributes_as_of",
    """SELECT w.session_id, w.session_seq, w.user_id, w.watch_date, c.changed_at AS as_of, c.subscription_plan
       FROM v_watch w ASOF LEFT JOIN (
           SELECT user_id, changed_at, arg_max(subscription_plan, change_id) AS subscription_plan
           FROM v_changes GROUP BY user_id, changed_at) c
         ON w.user_id = c.user_id AND w.watch_date >= c.changed_at""",
)
def attributes_as_of(spark, sf_dir):
    """Each session with its user's plan at that time."""
    sessions = domain.watch(spark, sf_dir).select("session_id", "session_seq", "user_id", "watch_date")
    return as_of_join(
        sessions, domain.changes(spark, sf_dir), "user_id", "watch_date", ["subscription_plan"], ties=["change_id"]
    )


SEGMENTS = 4


def _segmented(spark, sf_dir):
    table = materialise(rfm(spark, sf_dir), "rfm")
    model = models.segment_model(table, SEGMENTS)
    return model, models.with_segments(model, table)


@query(
    "user_segments",
    f"""SELECT *, has_sessions AS nearest, CAST({SEGMENTS} AS BIGINT) AS segments FROM ({_RFM}) r""",
)
def user_segments(spark, sf_dir):
    """Users with sessions are in the segment whose centre is nearest, and all segments are used.

    ``user_segment_values`` has the segments themselves.
    """
    model, found = _segmented(spark, sf_dir)
    nearest = F.coalesce(F.col("segment") == models.nearest_centre(model), F.lit(False))
    used = found.agg(F.count_distinct("segment")).first()[0]
    checks = [nearest.alias("nearest"), F.lit(used).cast("long").alias("segments")]
    return found.select("user_id", *features.RFM, "has_sessions", "is_known", *checks)


@query("user_segment_values")
def user_segment_values(spark, sf_dir):
    """All users with their scores' inputs and their segment."""
    return _segmented(spark, sf_dir)[1]


def _churn_scored(spark, sf_dir):
    """All users scored by a model of four in five, and the base rate of those."""
    table = materialise(churn_then(spark, sf_dir), "churn").withColumn("held_out", F.col("user_id") % 5 == 0)
    learns = table.filter("NOT held_out")
    base = learns.agg(F.avg("churned")).first()[0]
    scored = models.churn_scores(models.churn_model(learns), table)
    return scored.withColumn("held_out", F.col("user_id") % 5 == 0), base


@query(
    "churn_scores",
    f"""SELECT user_id, churned, user_id % 5 = 0 AS held_out, seen_before AS scored, TRUE AS better_than_base
        FROM ({_CHURN_THEN}) c""",
)
def churn_scores(spark, sf_dir):
    """Every user seen before has a probability, and on held-out users the model's log loss is
    less than that of the base rate. ``churn_probabilities`` has the probabilities themselves."""
    scored, base = _churn_scored(spark, sf_dir)
    own, constant = models.churn_quality(scored.filter("held_out AND churned IS NOT NULL"), base)
    known = F.coalesce(F.col("churn_probability").between(0, 1), F.lit(False))
    return scored.select(
        "user_id", "churned", "held_out", known.alias("scored"), F.lit(own < constant).alias("better_than_base")
    )


@query("churn_probabilities")
def churn_probabilities(spark, sf_dir):
    return _churn_scored(spark, sf_dir)[0]


_HELD_OUT = "CAST(substr(user_id, 2) AS BIGINT) + CAST(substr(movie_id, 2) AS BIGINT)"


def _rated(spark, sf_dir):
    """All ratings, with text ids, and a model of four in five."""
    with freed_shuffles(spark):
        ratings = materialise(review_ratings(domain.tastes(spark, sf_dir)), "ratings")
    ratings = ratings.withColumn("held_out", F.expr(_HELD_OUT.replace("VARCHAR", "STRING")) % 5 == 0)
    return ratings, models.rating_model(ratings.filter("NOT held_out"))


@query(
    "predicted_ratings",
    f"""WITH t AS (SELECT *, ({_HELD_OUT}) % 5 = 0 AS held_out FROM v_tastes)
        SELECT user_id, movie_id, {rounded('user_rating')} AS user_rating, held_out,
               user_id IN (SELECT user_id FROM t WHERE NOT held_out)
               AND movie_id IN (SELECT movie_id FROM t WHERE NOT held_out) AS predicted,
               TRUE AS better_than_mean
        FROM t""",
)
def predicted_ratings(spark, sf_dir):
    """Every pair stays, with a prediction where user and item are known; on held-out pairs the
    error is less than the mean's. ``rating_predictions`` has the ratings themselves."""
    ratings, model = _rated(spark, sf_dir)
    with freed_shuffles(spark):
        found = materialise(models.predicted_ratings(model, ratings), "predicted")
    own, constant = models.rating_errors(found.filter("held_out"), model.mean)
    checks = [
        F.col("predicted_rating").isNotNull().alias("predicted"),
        F.lit(own < constant).alias("better_than_mean"),
    ]
    return rounding(found.select("user_id", "movie_id", "user_rating", "held_out", *checks), "user_rating")


@query("rating_predictions")
def rating_predictions(spark, sf_dir):
    ratings, model = _rated(spark, sf_dir)
    return models.predicted_ratings(model, ratings)


RECOMMENDED = 5


@query(
    "recommended_items",
    f"""SELECT DISTINCT user_id, CAST({RECOMMENDED} AS BIGINT) AS items, TRUE AS in_order, TRUE AS to_taste
        FROM v_tastes WHERE ({_HELD_OUT}) % 5 <> 0""",
)
def recommended_items(spark, sf_dir):
    """The best items of every known user: as many as asked for, by falling prediction, and most
    of them of the kind that the user's ratings prefer."""
    _, model = _rated(spark, sf_dir)
    best = models.recommendations(model, RECOMMENDED)
    kind = F.substring("user_id", 2, 20).cast("long") % 3 == F.substring("movie_id", 2, 20).cast("long") % 3
    order = F.array_sort(F.collect_list(F.struct("position", "predicted_rating")))["predicted_rating"]
    checked = best.groupBy("user_id").agg(
        F.count_distinct("movie_id").alias("items"), order.alias("o"), F.avg(kind.cast("int")).alias("kind")
    )
    falling = F.col("o") == F.reverse(F.array_sort("o"))
    return checked.select("user_id", "items", falling.alias("in_order"), (F.col("kind") > 0.5).alias("to_taste"))


_TERMS = """
    SELECT conv_id, turn, term, COUNT(*) AS uses FROM (
        SELECT conv_id, turn, UNNEST(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS term
        FROM conversations) t
    WHERE term <> '' GROUP BY ALL"""


@query(
    "search_terms",
    f"""WITH u AS ({_TERMS}), n AS (SELECT COUNT(*) + 1 AS n FROM (SELECT DISTINCT conv_id, turn FROM conversations) c),
             k AS (SELECT term, COUNT(*) + 1 AS k FROM u GROUP BY term)
        SELECT conv_id, turn, term, uses, {rounded('uses * ln((SELECT n FROM n) / k)', 6)} AS weight
        FROM u JOIN k USING (term)""",
)
def search_terms(spark, sf_dir):
    """The turns of the conversations play the search queries: all of them, whoever speaks."""
    turns = domain.table(spark, sf_dir, "conversations")
    return rounding(models.search_terms(turns, ["conv_id", "turn"], "text"), "weight", scale=6)
