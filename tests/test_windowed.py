import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from viewtide.functions.signals import with_engagement_flags
from viewtide.operators import snapshots, windowed

SCHEMA = (
    "event_time TIMESTAMP, user_id STRING, movie_id STRING, title STRING, genre_primary STRING, "
    "content_type STRING, device_type STRING, quality STRING, country STRING, is_original BOOLEAN, "
    "action STRING, progress_percentage DOUBLE, watch_duration_minutes DOUBLE, imdb_rating DOUBLE, "
    "monthly_spend DOUBLE"
)
START = dt.datetime(2024, 1, 1)


def event(minute, user="u", movie="m", action="started", progress=30.0, duration=10.0, **more):
    time = None if minute is None else START + dt.timedelta(minutes=minute)
    row = dict(
        event_time=time, user_id=user, movie_id=movie, title=f"t{movie}", genre_primary="g",
        content_type="c", device_type="TV", quality="HD", country="USA", is_original=True,
        action=action, progress_percentage=progress, watch_duration_minutes=duration,
        imdb_rating=5.0, monthly_spend=10.0,
    )
    return tuple((row | more).values())


def test_trending_counts_completions_not_actions(spark, rows):
    events = spark.createDataFrame(
        [
            event(0, action="completed"),
            event(4.99, action="stopped", progress=None),
            event(5, action=None),
            event(1, user=None),
            event(None),
        ],
        SCHEMA,
    )
    result = windowed.trending_content(events)
    columns = ["view_count", "unique_viewers", "avg_completion_pct", "total_watch_time_min", "completed_views"]
    assert rows(result, *columns) == [(1, 1, 30.0, 10.0, 0), (3, 1, 30.0, 30.0, 1)]


@pytest.fixture(scope="module")
def events(spark):
    """Random events; a third of them share one item, a third one user."""
    rng = random.Random(5)
    rows = []
    for i in range(1200):
        rows.append(
            event(
                rng.random() * 120,
                user="hot" if i % 3 == 1 else (None if i % 40 == 0 else f"u{rng.randrange(300)}"),
                movie="hot" if i % 3 == 0 else f"m{rng.randrange(12)}",
                action=rng.choice(["started", "completed", "stopped", "paused", None]),
                progress=rng.choice([None, float("nan"), float(rng.randrange(101))]),
                duration=rng.choice([None, float(rng.randrange(1, 90))]),
                device_type=rng.choice(["TV", "Mobile"]),
                quality=rng.choice(["SD", "HD", "4K", None]),
                country=rng.choice(["USA", "Canada", None]),
                monthly_spend=rng.choice([9.99, 15.49, None]),
                imdb_rating=rng.choice([0.0, 6.1, 8.3, None]),
            )
        )
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def _brute(rows, keys, minutes):
    groups = defaultdict(list)
    for r in rows:
        slot = (r["event_time"] - START) // dt.timedelta(minutes=minutes)
        groups[(START + dt.timedelta(minutes=minutes * slot), *[r[k] for k in keys])].append(r)
    return groups


def test_trending_equals_brute_force(events):
    clean = events.withColumn(
        "progress_percentage", F.when(~F.isnan("progress_percentage"), F.col("progress_percentage"))
    )
    groups = _brute(clean.collect(), windowed.TRENDING_KEYS, 5)
    found = windowed.trending_content(clean).collect()
    assert len(found) == len(groups)
    for r in found:
        g = groups[(r["window_start"], *[r[k] for k in windowed.TRENDING_KEYS])]
        progress = [x["progress_percentage"] for x in g if x["progress_percentage"] is not None]
        durations = [x["watch_duration_minutes"] for x in g if x["watch_duration_minutes"] is not None]
        assert r["window_end"] - r["window_start"] == dt.timedelta(minutes=5)
        assert r["view_count"] == len(g)
        assert r["unique_viewers"] == len({x["user_id"] for x in g} - {None})
        assert r["avg_completion_pct"] == (pytest.approx(sum(progress) / len(progress)) if progress else None)
        assert r["total_watch_time_min"] == (sum(durations) if durations else None)
        assert r["completed_views"] == sum(x["action"] == "completed" for x in g)


def test_attributes_join_after_counting(events, spark, rows):
    items = spark.createDataFrame([("hot", "Hot"), ("m1", "One")], "movie_id STRING, title STRING")
    counted = windowed.trending_content(events, "1 hour").drop("avg_completion_pct")
    titled = windowed.with_item_attributes(counted, items, ["title"])
    assert titled.columns == [*counted.columns[:3], "title", *counted.columns[3:]]
    assert rows(titled.drop("title")) == rows(counted)
    assert {(r["movie_id"], r["title"]) for r in titled.collect()} >= {("hot", "Hot"), ("m2", None)}


@pytest.mark.parametrize("keys", [windowed.HEALTH_KEYS, ("genre_primary", "device_type")])
def test_health_equals_brute_force(events, keys):
    flagged = with_engagement_flags(events)
    groups = _brute(flagged.collect(), keys, 60)
    found = windowed.engagement_health(flagged, "1 hour", keys).collect()
    assert len(found) == len(groups)
    for r in found:
        g = groups[(r["window_start"], *[r[k] for k in keys])]
        low = sum(x["is_low_engagement"] for x in g)
        spend = [x["monthly_spend"] for x in g if x["monthly_spend"] is not None]
        imdb = [x["imdb_rating"] for x in g if x["imdb_rating"] is not None]
        assert r["total_sessions"] == len(g)
        assert r["unique_users"] == len({x["user_id"] for x in g} - {None})
        assert r["low_engagement_count"] == low
        assert r["low_engagement_rate"] == pytest.approx(low / len(g) * 100, abs=0.0051)
        assert r["abandonment_count"] == sum(
            x["action"] == "stopped" and x["progress_percentage"] < 50 for x in g
        )
        assert r["quality_downgrade_count"] == sum(x["quality"] in ("SD", "HD") for x in g)
        assert r["avg_completion_pct"] == pytest.approx(
            sum(x["progress_percentage"] for x in g) / len(g), abs=0.0051
        )
        if imdb:
            assert r["avg_content_quality"] == pytest.approx(sum(imdb) / len(imdb), abs=0.0051)
        else:
            assert r["avg_content_quality"] is None
        if spend:
            assert r["revenue_impact"] == pytest.approx(sum(spend), abs=0.0051)
            assert r["avg_subscriber_value"] == pytest.approx(sum(spend) / len(spend), abs=0.0051)
        level = "HIGH" if low / len(g) > 0.6 else "MEDIUM" if low / len(g) > 0.4 else "LOW"
        assert r["alert_level"] == level
        assert low <= len(g)


def test_approximate_users_stay_within_three_deviations(events):
    keys = ["window_start", *windowed.TRENDING_KEYS]
    exact = windowed.trending_content(events, "1 hour").select(*keys, F.col("unique_viewers").alias("n"))
    approx = windowed.trending_approx(events, "1 hour")
    off = approx.join(exact, keys).filter(F.abs(F.col("unique_viewers") - F.col("n")) > 0.15 * F.col("n") + 1)
    assert off.count() == 0
    assert approx.drop("unique_viewers").exceptAll(
        windowed.trending_content(events, "1 hour").drop("unique_viewers")
    ).count() == 0
    assert windowed.health_approx(with_engagement_flags(events)).count() == windowed.engagement_health(
        with_engagement_flags(events)
    ).count()
    assert windowed.active_users_approx(events, "1 hour").count() == 2


def test_real_time_metrics(spark, rows):
    events = spark.createDataFrame(
        [
            event(0, user="a", action="started", duration=10.0),
            event(0.5, user="a", action="paused", duration=None),
            event(0.9, user="b", action="started", duration=20.0),
            event(1, user="b", action=None, duration=40.0),
            event(1, user=None, action=None, duration=None),
        ],
        SCHEMA,
    )
    assert rows(windowed.active_users(events), "active_users") == [(1,), (2,)]
    distribution = windowed.event_type_distribution(events)
    assert rows(distribution, "action", "event_count", "share") == sorted(
        [("started", 2, 0.4), ("paused", 1, 0.2), (None, 2, 0.4)], key=repr
    )
    durations = windowed.avg_session_duration(events)
    assert rows(durations, "sessions", "avg_session_duration") == [(3, 70.0 / 3)]


def test_snapshots_rank_and_summarise(spark, rows):
    events = spark.createDataFrame(
        [event(m, user=f"u{m}", movie=str(i)) for i in range(15) for m in range(i % 4 + 1)], SCHEMA
    )
    items = spark.createDataFrame([(str(i), f"t{i}", "g", "c") for i in range(15)],
                                  "movie_id STRING, title STRING, genre_primary STRING, content_type STRING")
    trending = windowed.with_item_attributes(windowed.trending_content(events), items)
    top = snapshots.top_trending(trending, 3)
    # Items 3, 7 and 11 lead with four views; their ids break the tie.
    assert [(r["title"], r["view_count"]) for r in top.collect()] == [("t11", 4), ("t3", 4), ("t7", 4)]
    flagged = with_engagement_flags(
        spark.createDataFrame(
            [event(0, user="a", progress=5.0), event(0, user="b", progress=5.0, device_type="Mobile"),
             event(1, user="c", progress=5.0, device_type="Mobile"), event(2, progress=90.0, quality="4K")],
            SCHEMA,
        )
    )
    health = windowed.engagement_health(flagged)
    risk = snapshots.top_risk_segments(health, 2)
    assert [(r["device_type"], r["total_sessions"]) for r in risk.collect()] == [("Mobile", 2), ("TV", 1)]
    assert snapshots.top_risk_segments(health, 9, min_sessions=2).count() == 1
    assert rows(snapshots.overall_health(health)) == [(3, 4, pytest.approx(200 / 3), 2)]
