import datetime as dt
import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from viewtide.operators import features, models

WATCH = (
    "user_id INT, movie_id INT, watch_date TIMESTAMP, watch_duration_minutes DOUBLE, "
    "progress_percentage DOUBLE, action STRING"
)


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture
def watch(spark):
    return spark.createDataFrame(
        [
            (1, 1, day(0), 10.0, 50.0, "completed"),
            (1, 1, day(5), None, float("nan"), "stopped"),
            (1, 2, day(100), 30.0, 10.0, "started"),
            (2, 1, day(3), 20.0, None, "started"),
            (2, 1, day(12), 20.0, 30.0, "completed"),
            (3, 1, day(60), 5.0, 5.0, "started"),
        ],
        WATCH,
    )


@pytest.fixture
def users(spark):
    return spark.createDataFrame(
        [(1, "USA", "Basic", 9.0), (2, "USA", "Premium", None), (3, "Canada", "Basic", 7.0), (4, "USA", "Basic", 1.0)],
        "user_id INT, country STRING, subscription_plan STRING, monthly_spend DOUBLE",
    )


def test_rfm_features(watch, users, rows):
    more = watch.unionByName(watch.limit(1).withColumn("user_id", F.lit(5)))
    no_user = watch.limit(1).withColumn("user_id", F.lit(None).cast("int"))
    found = features.rfm_features(more.unionByName(no_user), users)
    assert rows(found, "user_id", *features.RFM, "has_sessions", "is_known") == [
        (1, 0, 3, 9.0, True, True),
        (2, 88, 2, 0.0, True, True),
        (3, 40, 1, 7.0, True, True),
        # A user without sessions, and one that the users lack, both stay.
        (4, None, 0, 1.0, False, True),
        (5, 100, 1, 0.0, True, False),
    ]


def test_rfm_scores_rank_without_a_global_window(spark, rows):
    df = spark.range(100).select(
        F.col("id").alias("user_id"),
        F.col("id").cast("int").alias("recency_days"),
        F.col("id").alias("frequency"),
        F.lit(5.0).alias("monetary"),
    )
    scored = features.rfm_scores(df)
    sizes = {r["f_score"]: r["count"] for r in scored.groupBy("f_score").count().collect()}
    assert sizes == {1: 20, 2: 20, 3: 20, 4: 20, 5: 20}
    assert scored.filter("r_score + f_score <> 6 OR m_score <> 1").count() == 0
    assert "Window" not in scored._jdf.queryExecution().toString()
    assert features.rfm_scores(df.limit(0)).columns[-3:] == ["r_score", "f_score", "m_score"]


def test_churn_features_split_at_the_cutoff(watch, users, rows):
    table = features.churn_features(watch, users, cutoff=day(50), horizon_days=60)
    columns = ["user_id", "sessions", "watch_minutes", "avg_progress", "completed_sessions",
               "days_since_last", "churned", "monthly_spend", "seen_before"]
    assert rows(table, *columns) == [
        (1, 2, 10.0, 50.0, 1, 45, 0, 9.0, True),
        (2, 2, 40.0, 30.0, 1, 38, 1, 0.0, True),
        # Unseen before the cutoff, or without any session: kept, without a label.
        (3, 0, 0.0, 0.0, 0, None, None, 7.0, False),
        (4, 0, 0.0, 0.0, 0, None, None, 1.0, False),
    ]


def test_churn_features_as_of_the_cutoff(spark, watch, users, rows):
    changes = spark.createDataFrame(
        [
            (1, day(0), 1, "USA", "Basic", 1.0, True),
            (1, day(49), 2, "USA", "Premium", 2.0, True),
            # Neither at nor after the cutoff is known yet.
            (1, day(50), 3, "Canada", "Basic", 3.0, False),
            (2, day(20), 5, "USA", "Late", 5.0, False),
            (2, day(20), 4, "USA", "Early", 4.0, True),
            (3, day(1), 6, "USA", "Basic", 6.0, True),
        ],
        "user_id INT, changed_at TIMESTAMP, id INT, country STRING, subscription_plan STRING, monthly_spend DOUBLE, is_active BOOLEAN",
    )
    table = features.churn_features(
        watch, users, cutoff=day(50), horizon_days=60, changes=changes, ties=["id"], label="is_active"
    )
    columns = ["user_id", "country", "subscription_plan", "monthly_spend", "sessions", "churned"]
    assert rows(table, *columns) == [
        (1, "USA", "Premium", 2.0, 2, 1),
        (2, "USA", "Late", 5.0, 2, 1),
        (3, "USA", "Basic", 6.0, 0, None),
        (4, None, None, 0.0, 0, None),
    ]


def test_models_leave_unseen_users_out_and_keep_them(spark, watch, users):
    table = features.rfm_features(watch, users)
    model = models.segment_model(table, k=2)
    found = {r["user_id"]: r for r in models.with_segments(model, table).withColumn("near", models.nearest_centre(model)).collect()}
    assert set(found) == {1, 2, 3, 4} and found[4]["segment"] is None
    assert all(found[k]["segment"] == found[k]["near"] for k in (1, 2, 3))
    churn = features.churn_features(watch, users, cutoff=day(50), horizon_days=60)
    scored = models.churn_scores(models.churn_model(churn), churn).collect()
    assert {r["user_id"]: r["churn_probability"] is None for r in scored} == {1: False, 2: False, 3: True, 4: True}


def test_a_constant_model_does_not_beat_the_base_rate(spark):
    scored = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.6), (0, 0.1)], "churned INT, churn_probability DOUBLE")
    own, base = models.churn_quality(scored, 0.5)
    assert own < base
    own, base = models.churn_quality(scored.withColumn("churn_probability", F.lit(0.5)), 0.5)
    assert own == base


def test_weekly_popularity_knows_gaps(watch, rows):
    weekly = features.weekly_popularity(watch)
    assert rows(weekly, "movie_id", "week", "views", "previous_views", "view_change") == [
        (1, dt.date(2024, 1, 1), 3, 0, 3),
        (1, dt.date(2024, 1, 8), 1, 3, -2),
        (1, dt.date(2024, 2, 26), 1, 0, 1),
        (2, dt.date(2024, 4, 8), 1, 0, 1),
    ]


def test_segments_find_separate_groups(spark):
    rng = random.Random(1)
    rows = [(i, int(10 + rng.random()), 1 + i % 2, 1.0) for i in range(40)]
    rows += [(i, int(500 + rng.random()), 90 + i % 2, 50.0) for i in range(40, 80)]
    df = spark.createDataFrame(rows, "user_id INT, recency_days INT, frequency INT, monetary DOUBLE")
    found = models.user_segments(df, k=2)
    assert set(found.columns) == {*df.columns, "segment"}
    groups = found.groupBy(F.col("user_id") < 40, "segment").count().collect()
    assert sorted(r["count"] for r in groups) == [40, 40]


@pytest.mark.parametrize("forest", [False, True])
def test_churn_model_learns_a_clear_signal(spark, forest):
    rng = random.Random(2)
    rows = [
        (i, "USA" if i % 2 else "Canada", "Basic", float(rng.randrange(1, 9)), rng.randrange(1, 9),
         rng.random(), rng.random(), rng.randrange(3), idle, int(idle > 60))
        for i, idle in enumerate(rng.randrange(1, 120) for _ in range(200))
    ]
    df = spark.createDataFrame(
        rows,
        "user_id INT, country STRING, subscription_plan STRING, monthly_spend DOUBLE, sessions INT, "
        "watch_minutes DOUBLE, avg_progress DOUBLE, completed_sessions INT, days_since_last INT, churned INT",
    )
    scored = models.churn_scores(models.churn_model(df, forest=forest), df)
    right = scored.filter("(churn_probability > 0.5) = (churned = 1)").count()
    assert scored.count() == 200 and right > 180


def test_ratings_are_recovered(spark):
    rng = random.Random(3)
    taste = {u: rng.choice([1.0, 5.0]) for u in range(30)}
    rows = [(u, m, taste[u]) for u in range(30) for m in range(20) if (u * 7 + m) % 3]
    ratings = spark.createDataFrame(rows, "user_id INT, movie_id INT, user_rating DOUBLE")
    unseen = spark.createDataFrame([(u, m) for u in range(30) for m in range(20)] + [(99, 1)], "user_id INT, movie_id INT")
    found = models.predicted_ratings(models.rating_model(ratings, rank=3), unseen).collect()
    assert len(found) == 601
    assert [r["predicted_rating"] for r in found if r["user_id"] == 99] == [None]
    assert all(abs(r["predicted_rating"] - taste[r["user_id"]]) < 1 for r in found if r["user_id"] < 99)


def test_search_terms_weigh_rare_words(spark):
    queries = ["space drama", "space comedy", "space space documentary!", "Space", "", "  "]
    df = spark.createDataFrame(list(enumerate(queries)), "id INT, query STRING")
    found = models.search_terms(df, ["id"])
    assert found.columns == ["id", "term", "uses", "weight"]
    weights = {(r["id"], r["term"], r["uses"]): r["weight"] for r in found.collect()}
    rare, common = math.log(7 / 2), math.log(7 / 5)
    assert weights == {
        (0, "space", 1): pytest.approx(common),
        (0, "drama", 1): pytest.approx(rare),
        (1, "space", 1): pytest.approx(common),
        (1, "comedy", 1): pytest.approx(rare),
        (2, "space", 2): pytest.approx(2 * common),
        (2, "documentary", 1): pytest.approx(rare),
        (3, "space", 1): pytest.approx(common),
    }
