import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from viewtide.operators import metrics
from viewtide.operators.star import review_ratings, star_join, star_user_months, valid_sessions

WATCH = (
    "session_id STRING, user_id STRING, movie_id STRING, watch_date STRING, "
    "watch_duration_minutes DOUBLE, progress_percentage DOUBLE, user_rating DOUBLE"
)


def at(month, day=1):
    return f"{month}-{day:02d} 10:00:00"


@pytest.fixture
def users(spark):
    return spark.createDataFrame(
        [("u1", "USA", "Basic"), ("u2", "USA", "Premium"), ("u3", "Canada", "Basic")],
        "user_id STRING, country STRING, subscription_plan STRING",
    )


@pytest.fixture
def movies(spark):
    return spark.createDataFrame(
        [("m1", "One", "Drama"), ("m2", "Two", "Comedy")],
        "movie_id STRING, title STRING, genre_primary STRING",
    )


@pytest.fixture
def watch(spark):
    return spark.createDataFrame(
        [
            ("s1", "u1", "m1", at("2024-11"), 10.0, 5.0, 9.0),
            ("s2", "u1", "m2", at("2024-12"), 20.0, 50.0, None),
            ("s3", "u1", "m1", at("2025-02"), 30.0, None, None),
            ("s4", "u2", "m1", at("2024-12"), 40.0, 20.0, None),
            ("s5", "u2", "m1", at("2024-12", 2), 50.0, 19.0, None),
            ("s6", "u3", "m2", at("2025-01"), None, 10.0, None),
            ("s7", "u9", "m1", at("2024-12"), 60.0, 10.0, None),
            ("s8", "u1", "m9", at("2024-12"), 60.0, 10.0, None),
            ("s9", "u2", "m2", "not a date", 60.0, 10.0, None),
            ("s10", "u3", "m2", at("2025-01"), float("nan"), 10.0, None),
        ],
        WATCH,
    )


@pytest.fixture
def reviews(spark):
    return spark.createDataFrame(
        [("u1", "m1", 2.0), ("u1", "m1", 4.0), ("u2", "m2", 5.0), ("u1", "m2", None)],
        "user_id STRING, movie_id STRING, rating DOUBLE",
    )


@pytest.fixture
def star(watch, users, movies, reviews):
    return star_join(watch, users, movies, reviews)


def test_review_ratings_has_one_row_per_pair(reviews, rows):
    assert rows(review_ratings(reviews)) == sorted(
        [("u1", "m1", 3.0), ("u1", "m2", None), ("u2", "m2", 5.0)], key=repr
    )


def test_star_drops_unknown_and_replaces_ratings(star, watch, rows):
    assert star.columns.count("user_rating") == 1
    assert rows(star, "session_id", "user_rating") == sorted(
        [("s1", 3.0), ("s2", None), ("s3", 3.0), ("s4", None), ("s5", None), ("s6", None),
         ("s9", 5.0), ("s10", None)],
        key=repr,
    )
    assert star.count() <= watch.count()


def test_star_without_reviews_keeps_own_rating(watch, users, movies, rows):
    plain = star_join(watch, users, movies)
    assert ("s1", 9.0) in rows(plain, "session_id", "user_rating")


def test_valid_sessions_need_date_and_duration(star, rows):
    assert [r[0] for r in rows(valid_sessions(star), "session_id")] == ["s1", "s2", "s3", "s4", "s5"]


def test_monthly_engagement(star, rows):
    result = metrics.monthly_engagement(valid_sessions(star))
    assert rows(result) == sorted(
        [
            (2024, 11, "USA", "Basic", 10.0, 1, 1, 10.0, 1),
            (2024, 12, "USA", "Basic", 20.0, 1, 1, 20.0, 1),
            (2024, 12, "USA", "Premium", 90.0, 1, 2, 45.0, 1),
            (2025, 2, "USA", "Basic", 30.0, 1, 1, 30.0, 1),
        ],
        key=repr,
    )


def test_content_performance_counts_rated_sessions_only(star, rows):
    result = metrics.content_performance(valid_sessions(star))
    assert rows(result) == [(2024, 11, "Drama", 3.0, 1, 10.0, 1, 1), (2025, 2, "Drama", 3.0, 1, 30.0, 1, 1)]


def test_genre_performance_counts_all_sessions(star, rows):
    result = metrics.genre_performance(valid_sessions(star))
    assert rows(result) == [("Comedy", 1, 20.0, 20.0, 1, 1, None), ("Drama", 4, 130.0, 32.5, 1, 2, 3.0)]


def test_retention_crosses_the_year(star, rows):
    result = metrics.cohort_retention(valid_sessions(star))
    assert rows(result) == sorted(
        [
            (2024, 11, 2024, 11, 1, 0),
            (2024, 11, 2024, 12, 1, 1),
            (2024, 11, 2025, 2, 1, 3),
            (2024, 12, 2024, 12, 1, 0),
        ],
        key=repr,
    )


def test_churn_leaves_the_last_month_open(star, rows):
    result = metrics.monthly_churn(valid_sessions(star))
    # u1 is away in January but back in February; u2 leaves after December.
    assert rows(result) == [(2024, 11, 1, 0, 0.0), (2024, 12, 2, 2, 1.0)]


def test_skip_rate_ignores_missing_progress(star, rows):
    result = metrics.skip_rate_trend(valid_sessions(star))
    assert rows(result) == sorted(
        [
            (2024, 11, 1, 1, 1, 1.0, 10.0),
            (2024, 12, 3, 3, 1, 1 / 3, 110.0 / 3),
            (2025, 2, 1, 0, None, None, 30.0),
        ],
        key=repr,
    )


def test_top_lists_break_ties_by_name(spark, rows):
    events = spark.createDataFrame(
        [("Drama", "USA"), ("Comedy", "USA"), ("Action", None), (None, "Canada")],
        "genre_primary STRING, country STRING",
    )
    assert rows(metrics.top_genres_countries(events, 2)) == [
        ("country", "Canada", 1, 2),
        ("country", "USA", 2, 1),
        ("genre", "Action", 1, 1),
        ("genre", "Comedy", 1, 2),
    ]


@pytest.fixture(scope="module")
def random_star(spark):
    """Random sessions; one user has a third of them."""
    rng = random.Random(11)
    sessions = []
    for i in range(1500):
        user = "hot" if i % 3 == 0 else f"u{rng.randrange(60)}"
        year, month = divmod(rng.randrange(24), 12)
        sessions.append(
            (f"s{i}", user, f"m{rng.randrange(25)}", at(f"{2023 + year}-{month + 1:02d}", rng.randrange(1, 29)),
             float(rng.randrange(1, 200)), float(rng.randrange(101)), None)
        )
    names = sorted({s[1] for s in sessions})
    watch = spark.createDataFrame(sessions, WATCH).repartition(6)
    users = spark.createDataFrame(
        [(n, f"c{i % 4}", f"p{i % 3}") for i, n in enumerate(names)],
        "user_id STRING, country STRING, subscription_plan STRING",
    )
    movies = spark.createDataFrame(
        [(f"m{i}", f"t{i}", f"g{i % 5}") for i in range(20)],
        "movie_id STRING, title STRING, genre_primary STRING",
    )
    return sessions, watch, users, movies


def test_user_metrics_agree_from_star_and_rollup(random_star, rows):
    sessions, watch, users, movies = random_star
    star = valid_sessions(star_join(watch, users, movies))
    months = star_user_months(watch, users, movies)
    columns = months.columns
    assert rows(metrics.user_months(star), *columns) == rows(months)
    assert rows(metrics.monthly_active_users(star)) == rows(metrics.active_users_from(months))
    assert rows(metrics.cohort_retention(star)) == rows(metrics.retention_from(months))
    assert rows(metrics.monthly_churn(star)) == rows(metrics.monthly_churn(months))
    assert rows(metrics.user_cohorts(star)) == rows(metrics.user_cohorts(months))
    assert rows(metrics.mau_by_plan_country(star)) == rows(metrics.mau_by_plan_country(months))


def test_retention_and_churn_equal_brute_force(random_star, rows):
    sessions, watch, users, movies = random_star
    active = defaultdict(set)
    for _, user, movie, date, *_ in sessions:
        if int(movie[1:]) < 20:
            active[user].add(int(date[:4]) * 12 + int(date[5:7]) - 1)
    counts = defaultdict(int)
    for months in active.values():
        for m in months:
            counts[(min(months), m)] += 1
    star = valid_sessions(star_join(watch, users, movies))
    retention = metrics.cohort_retention(star)
    found = {
        (r["cohort_year"] * 12 + r["cohort_month"] - 1, r["watch_year"] * 12 + r["watch_month"] - 1):
        (r["active_users"], r["months_since_cohort"])
        for r in retention.collect()
    }
    assert found == {k: (n, k[1] - k[0]) for k, n in counts.items()}

    rated = metrics.retention_rate(retention)
    assert rated.filter("months_since_cohort = 0 AND retention_rate <> 1").count() == 0
    assert rated.filter("retention_rate > 1 OR cohort_size IS NULL").count() == 0

    last = max(m for months in active.values() for m in months)
    lost = defaultdict(int)
    for months in active.values():
        for m in months:
            lost[m] += m + 1 not in months
    churn = {r["watch_year"] * 12 + r["watch_month"] - 1: r["churned_users"]
             for r in metrics.monthly_churn(star).collect()}
    assert churn == {m: n for m, n in lost.items() if m < last}


def test_session_totals_are_kept(random_star):
    _, watch, users, movies = random_star
    star = valid_sessions(star_join(watch, users, movies))
    total = star.count()
    sums = [
        metrics.monthly_engagement(star).agg(F.sum("total_sessions")).first()[0],
        metrics.genre_trend(star).agg(F.sum("total_views")).first()[0],
        metrics.genre_performance(star).agg(F.sum("total_views")).first()[0],
        star_user_months(watch, users, movies).agg(F.sum("total_sessions")).first()[0],
    ]
    assert sums == [total] * 4


def test_duplicate_dimension_rows_weigh_alike(random_star, rows):
    _, watch, users, movies = random_star
    doubled = users.union(users.limit(5))
    star = valid_sessions(star_join(watch, doubled, movies))
    months = star_user_months(watch, doubled, movies)
    assert rows(metrics.active_users_from(metrics.user_months(star))) == rows(
        metrics.active_users_from(months)
    )
