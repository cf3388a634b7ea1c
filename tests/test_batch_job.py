import csv
import random
from collections import defaultdict

import pytest

from viewtide.plans import batch
from viewtide.plans.batch import export, run_batch
from viewtide.session import scratch_path
from viewtide.sinks.ledger import Ledger
from viewtide.sinks.tables import TableSink
from viewtide.sources.tables import load_tables

TABLES = {
    "users": ["user_id", "email", "country", "subscription_plan", "nothing"],
    "movies": ["movie_id", "title", "genre_primary", "rating"],
    "watch_history": [
        "session_id", "user_id", "movie_id", "watch_date", "watch_duration_minutes",
        "progress_percentage", "action", "user_rating",
    ],
    "reviews": ["user_id", "movie_id", "rating"],
    "recommendation_logs": ["user_id", "movie_id", "clicked"],
    "search_logs": ["user_id", "query"],
}


@pytest.fixture(scope="module")
def data():
    rng = random.Random(4)
    users = [[f"u{i}", f"e{i}@x", rng.choice(["USA", "Canada"]), rng.choice(["Basic", "Premium"]), ""]
             for i in range(40)]
    users.append(["u40", "", "USA", "Basic", ""])
    movies = [[f"m{i}", f"t{i}", f"g{i % 3}", "PG"] for i in range(15)]
    watch = [
        [f"s{i}", f"u{rng.randrange(42)}" if i % 50 else "", f"m{rng.randrange(17)}",
         f"2024-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d} 10:00:00",
         rng.choice(["", str(rng.randrange(1, 90))]), str(rng.randrange(101)), "started", ""]
        for i in range(800)
    ]
    reviews = [[f"u{rng.randrange(40)}", f"m{rng.randrange(15)}", str(rng.randrange(1, 6))] for _ in range(200)]
    logs = [["u1", "m1", "true"], ["u1", "m1", "true"], ["", "m1", "false"]]
    searches = [["u1", "space"], ["", "drama"]]
    return {
        "users": users + users[:3],
        "movies": movies + movies[:2],
        "watch_history": watch + watch[:30],
        "reviews": reviews,
        "recommendation_logs": logs,
        "search_logs": searches,
    }


@pytest.fixture(scope="module")
def run(spark, data, tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    for name, lines in data.items():
        with open(base / f"{name}.csv", "w", newline="") as handle:
            writer = csv.writer(handle)
            writer.writerow(TABLES[name])
            writer.writerows(lines)
    tables = load_tables(spark, str(base), schemas={})
    return run_batch(
        spark, tables, TableSink(scratch_path(spark, "clean")), TableSink(scratch_path(spark, "result"))
    )


def _clean(lines, required):
    return [list(r) for r in dict.fromkeys(tuple(r) for r in lines) if all(r[i] for i in required)]


def test_reports(run, data):
    quality = {(r["table_name"], r["column_name"]): r["row_count"] for r in run.quality.collect()}
    assert quality[("users", "*")] == 3 and quality[("users", "nothing")] == 44
    assert quality[("users", "email")] == 1
    summary = {r["table_name"]: r.asDict() for r in run.summary.collect()}
    assert summary["users"]["rows_after"] == 40
    assert (summary["users"]["columns_before"], summary["users"]["columns_after"]) == (5, 4)
    # user_rating is empty throughout, so the sessions lose that column too.
    assert summary["watch_history"]["columns_removed"] == 1
    assert summary["watch_history"]["rows_after"] == len(_clean(data["watch_history"], [0, 1, 2]))


def test_cleaned_tables(spark, run, data):
    names = {path.rsplit("/", 1)[1] for path in run.cleaned.values()}
    assert names == {"Users", "Movies", "WatchHistory", "RecommendationLogs", "Reviews", "SearchLogs"}
    counts = {name: spark.read.parquet(path).count() for name, path in run.cleaned.items()}
    assert counts["recommendation_logs"] == 1 and counts["search_logs"] == 1
    assert counts["movies"] == 15


def test_results_equal_brute_force(spark, run, data):
    users = {r[0]: r for r in _clean(data["users"], [0, 1])}
    movies = {r[0]: r for r in _clean(data["movies"], [0, 1])}
    watch = [r for r in _clean(data["watch_history"], [0, 1, 2]) if r[1] in users and r[2] in movies]
    sessions = [r for r in watch if r[4]]
    star = spark.read.parquet(run.results["star"])
    assert star.count() == len(watch)

    expected = defaultdict(lambda: [0.0, set(), 0, set()])
    for r in sessions:
        group = expected[(int(r[3][:4]), int(r[3][5:7]), users[r[1]][2], users[r[1]][3])]
        group[0] += float(r[4])
        group[1].add(r[1])
        group[2] += 1
        group[3].add(r[2])
    found = spark.read.parquet(run.results["monthly_engagement"]).collect()
    assert {
        tuple(r)[:4]: (r["total_watch_time_minutes"], r["monthly_active_users"], r["total_sessions"],
                       r["unique_content_viewed"])
        for r in found
    } == {k: (t, len(u), n, len(m)) for k, (t, u, n, m) in expected.items()}

    ratings = defaultdict(list)
    for user, movie, rating in _clean(data["reviews"], [0, 1]):
        ratings[(user, movie)].append(float(rating))
    rated = defaultdict(list)
    for r in sessions:
        if (r[1], r[2]) in ratings:
            pair = ratings[(r[1], r[2])]
            rated[(int(r[3][:4]), int(r[3][5:7]), movies[r[2]][2])].append(sum(pair) / len(pair))
    content = spark.read.parquet(run.results["content_performance"]).collect()
    assert {tuple(r)[:3]: r["total_views"] for r in content} == {k: len(v) for k, v in rated.items()}
    for r in content:
        values = rated[tuple(r)[:3]]
        assert r["avg_rating"] == pytest.approx(sum(values) / len(values))

    active = defaultdict(set)
    for r in sessions:
        active[(int(r[3][:4]), int(r[3][5:7]))].add(r[1])
    mau = spark.read.parquet(run.results["monthly_active_users"]).collect()
    assert {tuple(r)[:2]: r["monthly_active_users"] for r in mau} == {k: len(v) for k, v in active.items()}
    retention = spark.read.parquet(run.results["cohort_retention"])
    assert retention.agg({"active_users": "sum"}).first()[0] == sum(len(v) for v in active.values())


def test_results_are_written_in_order(spark, run):
    files = spark.read.parquet(run.results["genre_performance"]).collect()
    times = [r["total_watch_time_minutes"] for r in files]
    assert times == sorted(times, reverse=True)


def test_export_copies_every_table(spark, run):
    warehouse = TableSink(scratch_path(spark, "warehouse"), format="json")
    export(spark, run, TableSink("unused"), warehouse)
    assert spark.read.json(warehouse.target("Users")).count() == 40
    assert spark.read.json(warehouse.target("monthly_engagement")).count() > 0


def test_empty_critical_column_stops_the_run(spark):
    tables = {"users": spark.createDataFrame([(None, "e")], "user_id STRING, email STRING")}
    with pytest.raises(ValueError, match="user_id"):
        run_batch(spark, tables, TableSink(scratch_path(spark, "c")), TableSink(scratch_path(spark, "r")))


def test_a_broken_run_redoes_only_what_is_left(spark, data, tmp_path, monkeypatch):
    """A job that breaks in its star, then one that resumes, then one after a table has changed."""
    for name, lines in data.items():
        with open(tmp_path / f"{name}.csv", "w", newline="") as handle:
            csv.writer(handle).writerows([TABLES[name], *lines])
    sinks = [TableSink(scratch_path(spark, kind)) for kind in ("clean", "result")]
    notes = Ledger(spark, scratch_path(spark, "steps"))
    written = []
    overwrite = TableSink.overwrite

    def counted(self, df, name, *args, **more):
        written.append(name)
        return overwrite(self, df, name, *args, **more)

    monkeypatch.setattr(TableSink, "overwrite", counted)

    def job():
        written.clear()
        tables = load_tables(spark, str(tmp_path), schemas={})
        return run_batch(spark, tables, *sinks, notes=notes)

    star = batch.star_join
    monkeypatch.setattr(batch, "star_join", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        job()
    assert len(written) == 6
    monkeypatch.setattr(batch, "star_join", star)
    done = job()
    results = {"star", "user_months", "monthly_engagement", "cohort_retention", "content_performance", "genre_performance", "monthly_active_users"}
    assert set(written) == results and len(written) == 7
    again = job()
    assert written == [] and again.results == done.results
    assert sorted(map(tuple, again.quality.collect())) == sorted(map(tuple, done.quality.collect()))
    # Another search log touches no result; another review touches all that come from the star.
    with open(tmp_path / "search_logs.csv", "a") as handle:
        handle.write("u3,comedy\n")
    job()
    assert written == ["SearchLogs"]
    with open(tmp_path / "reviews.csv", "a") as handle:
        handle.write("u3,m3,5\n")
    fresh = job()
    assert set(written) == results | {"Reviews"}
    assert spark.read.parquet(fresh.cleaned["reviews"]).filter("user_id = 'u3' AND movie_id = 'm3' AND rating = 5").count() == 1
