import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from viewtide.functions.eventtime import with_event_time
from viewtide.operators import windowed
from viewtide.plans import streams
from viewtide.schemas import WATCH_EVENT
from viewtide.session import scratch_path
from viewtide.sinks.tables import TableSink
from viewtide.sinks.versioned import VersionedTable
from viewtide.sources.events import nan_to_null, read_event_files
from viewtide.streaming.enrich import enrich, prepare_dimension
from viewtide.streaming.queries import (
    ROCKSDB,
    StreamSettings,
    add_batch,
    batch_writer,
    finish,
    finish_all,
    progress_table,
    query_status,
    to_batches,
    to_files,
    to_memory,
)

START = dt.datetime(2024, 1, 1)


def record(minute, i=0, **more):
    time = START + dt.timedelta(minutes=minute)
    row = {
        "session_id": f"s{i}",
        "user_id": f"u{i % 7}",
        "movie_id": f"m{i % 4}",
        "watch_date": "2024-01-01",
        "device_type": "TV",
        "watch_duration_minutes": float(i % 50),
        "progress_percentage": float(i * 13 % 101),
        "action": ["started", "completed", "stopped"][i % 3],
        "quality": ["SD", "HD", "4K"][i % 3],
        "location_country": "USA",
        "is_download": False,
        "user_rating": float("nan"),
        "timestamp": time.strftime("%Y-%m-%d %H:%M:%S"),
    }
    return row | more


def put(folder, name, records):
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "events"
    path.mkdir()
    rng = random.Random(2)
    for part in range(3):
        put(
            path,
            f"part-{part:05d}.json",
            [record(part * 20 + rng.random() * 25, part * 100 + i) for i in range(100)],
        )
    return path


@pytest.fixture
def settings(spark):
    return StreamSettings(scratch_path(spark, "checkpoint"), interval=None, state_partitions=2)


@pytest.fixture
def movies(spark):
    # m1 has two rows and m3 none.
    return spark.createDataFrame(
        [("m0", "Zero", "Drama", "Movie", 2000), ("m1", "One", "Drama", "Movie", 2001),
         ("m1", None, "Drama", "Movie", 2001), ("m2", "Two", "Comedy", "Series", 2002),
         (None, "Nameless", "Drama", "Movie", 1999)],
        "movie_id STRING, title STRING, genre_primary STRING, content_type STRING, release_year INT",
    )


@pytest.fixture
def users(spark):
    return spark.createDataFrame(
        [(f"u{i}", "USA", "Basic", None if i == 2 else 10.0) for i in range(6)] + [("u0", "USA", "Basic", 99.0)],
        "user_id STRING, country STRING, subscription_plan STRING, monthly_spend DOUBLE",
    )


def static_events(spark, folder):
    return with_event_time(nan_to_null(spark.read.schema(WATCH_EVENT).json(str(folder))))


def test_dimension_is_unique_and_prefers_complete_rows(spark, movies, users, rows):
    items = prepare_dimension(movies, "movie_id", ["title", "genre_primary"], store=True)
    assert rows(items) == [("m0", "Zero", "Drama"), ("m1", "One", "Drama"), ("m2", "Two", "Comedy")]
    spend = prepare_dimension(users, "user_id", ["monthly_spend"], defaults={"monthly_spend": 0.0})
    assert dict(rows(spend))["u2"] == 0.0 and dict(rows(spend))["u0"] == 10.0
    kept = prepare_dimension(users, "user_id", ["monthly_spend"], order_by=[F.desc("monthly_spend")])
    assert dict(rows(kept))["u0"] == 99.0


def test_complete_stream_equals_batch(spark, folder, movies, settings, rows):
    stream = streams.exact_trending_stream(read_event_files(spark, str(folder)))
    items = streams.item_dimension(movies)
    sink = TableSink(scratch_path(spark, "live"))

    def write(batch, _):
        sink.overwrite(streams.exact_trending(batch, items), "trending")

    query = finish(to_batches(stream, {"trending": write}, settings))
    found = spark.read.parquet(sink.target("trending"))
    # The same groups as joining first and grouping by the attributes too.
    keys = ["movie_id", *windowed.ITEM_ATTRIBUTES]
    joined = enrich(static_events(spark, folder), items=items, watermark=None)
    batch = windowed.trending_content(joined, keys=keys)
    assert rows(found) == rows(batch, *found.columns)
    assert found.agg(F.sum("view_count")).first()[0] == 300
    status = query_status(spark, query).first()
    assert (status["input_rows"], status["batches_with_rows"], status["is_active"]) == (300, 3, False)


def test_health_stream_equals_batch_where_exact(spark, folder, movies, users, settings, rows):
    with_rating = movies.withColumns({"imdb_rating": F.lit(7.0), "is_original": F.lit(True)})
    events = read_event_files(spark, str(folder))
    stream = streams.health_stream(events, users, with_rating, duration="30 minutes")
    name = "health_" + settings.checkpoint[-8:]
    finish(to_memory(stream, name, settings))
    found = spark.table(name)
    assert found.agg(F.sum("total_sessions")).first()[0] == 300
    assert found.filter("unique_users > total_sessions").count() == 0
    # u6 and m3 are unknown: their events stay, in segments without attributes.
    assert found.filter("country IS NULL").count() > 0
    assert found.filter("genre_primary IS NULL").count() > 0
    exact = streams.health_stream(
        static_events(spark, folder).drop("event_time"), users, with_rating, "30 minutes", exact=True
    )
    columns = [c for c in found.columns if c != "unique_users"]
    assert rows(found, *columns) == rows(windowed.health_from_users(exact), *columns)


def test_restart_continues_from_the_checkpoint(spark, folder, settings, rows):
    events = read_event_files(spark, str(folder))
    path = scratch_path(spark, "out")
    first = finish(to_files(events, path, settings))
    assert query_status(spark, first).first()["input_rows"] == 300
    again = finish(to_files(events, path, settings))
    assert query_status(spark, again).first()["input_rows"] == 0
    put(folder, "part-00003.json", [record(70, 1000)])
    third = finish(to_files(events, path, settings))
    assert query_status(spark, third).first()["input_rows"] == 1
    written = spark.read.schema(events.schema).parquet(path)
    assert written.count() == 301
    assert written.select("session_id").distinct().count() == 301


def _counts(spark, folder):
    events = with_event_time(read_event_files(spark, str(folder)))
    return windowed.windowed(
        enrich(events), "5 minutes", [], [F.count(F.lit(1)).alias("n")]
    )


def test_append_drops_late_events_and_keeps_the_last_window_open(spark, tmp_path, settings, rows):
    path = tmp_path / "late"
    path.mkdir()
    put(path, "a.json", [record(0), record(1)])
    counts = _counts(spark, path)
    out = scratch_path(spark, "out")
    finish(to_files(counts, out, settings))
    put(path, "b.json", [record(60)])
    finish(to_files(counts, out, settings))
    # The watermark is now at minute 50: minute 2 is late, minute 55 is not.
    put(path, "c.json", [record(2), record(55)])
    last = finish(to_files(counts, out, settings))
    put(path, "d.json", [record(100)])
    finish(to_files(counts, out, settings))
    found = spark.read.schema(counts.schema).parquet(out)
    minutes = [(int((r["window_start"] - START).total_seconds() // 60), r["n"]) for r in found.collect()]
    assert sorted(minutes) == [(0, 2), (55, 1), (60, 1)]
    dropped = progress_table(spark, last).agg(F.sum("late_rows_dropped")).first()[0]
    assert dropped == 1


def test_complete_mode_counts_late_events(spark, tmp_path, settings):
    path = tmp_path / "late"
    path.mkdir()
    name = "late_" + settings.checkpoint[-8:]
    put(path, "a.json", [record(0)])
    finish(to_memory(_counts(spark, path), name, settings))
    put(path, "b.json", [record(60)])
    put(path, "c.json", [record(2)])
    finish(to_memory(_counts(spark, path), name, settings))
    assert sorted(r["n"] for r in spark.table(name).collect()) == [1, 2]


def test_missing_attribute_is_an_error(spark, folder, movies, users):
    events = read_event_files(spark, str(folder))
    with pytest.raises(ValueError, match="lacks release_year"):
        streams.trending_stream(events, movies.drop("release_year"))
    with pytest.raises(ValueError, match="lacks imdb_rating"):
        streams.health_stream(events, users, movies)


def test_history_keeps_days_apart_and_needs_no_large_state(spark, folder, movies, settings):
    stream = streams.trending_stream(read_event_files(spark, str(folder)), movies)
    path = scratch_path(spark, "history")
    with_rocksdb = StreamSettings(settings.checkpoint, None, 2, large_state=True)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    query = finish(streams.start_history(stream, path, with_rocksdb))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    assert before != ROCKSDB
    found = spark.read.parquet(path)
    assert found.count() > 0 and "window_day" in found.columns
    last = progress_table(spark, query).orderBy(F.desc("batch_id")).first()
    # Only the windows within the watermark are still held.
    assert 0 < last["state_rows"] < 4 * 6


def test_live_table_with_monitor(spark, folder, movies, settings):
    stream = streams.trending_stream(read_event_files(spark, str(folder)), movies)
    sink = TableSink(scratch_path(spark, "live"))
    name = "monitor_" + settings.checkpoint[-8:]
    with pytest.raises(ValueError, match="checkpoint"):
        streams.start_live_table(stream, sink, "t", settings, monitor=name)
    assert not spark.streams.active
    own = StreamSettings(scratch_path(spark, "checkpoint"), None, 2)
    fresh = StreamSettings(scratch_path(spark, "checkpoint"), None, 2)
    queries = streams.start_live_table(
        stream, sink, "t", own, sort_by=["-view_count"], monitor=name, monitor_settings=fresh
    )
    finish_all(spark, queries)
    live = spark.read.parquet(sink.target("t"))
    assert live.count() == spark.table(name).count() > 0


def test_intake_parts_messages_and_repeats_safely(spark, tmp_path, settings):
    raw = tmp_path / "raw"
    raw.mkdir()
    lines = [json.dumps(record(1, i)) for i in range(5)] + ["broken", json.dumps(record(1, 9, user_id=None))]
    (raw / "a.txt").write_text("\n".join(lines))
    envelope = spark.readStream.text(str(raw))
    valid, rejected = scratch_path(spark, "valid"), scratch_path(spark, "rejected")
    finish(streams.start_intake(envelope, valid, rejected, settings))
    assert spark.read.parquet(valid).count() == 5
    found = {r["reject_reason"] for r in spark.read.parquet(rejected).collect()}
    assert found == {"malformed", "missing user_id"}


def test_repeated_batch_adds_nothing(spark):
    path = scratch_path(spark, "batches")
    write = batch_writer({"rows": add_batch(path)})
    write(spark.range(3), 0)
    write(spark.range(3), 0)
    write(spark.range(2), 1)
    write(spark.range(0), 2)
    assert spark.read.parquet(path).count() == 5


def test_interval_query_runs_until_stopped(spark, folder, settings):
    events = read_event_files(spark, str(folder))
    paced = StreamSettings(settings.checkpoint, "1 second", 2)
    query = to_files(events, scratch_path(spark, "out"), paced)
    assert query.isActive
    query.processAllAvailable()
    finish(query, timeout=1)
    assert not query.isActive
    assert sum(p["numInputRows"] for p in query.recentProgress) == 300


def test_failing_target_stops_the_query(spark, folder, settings):
    def fail(batch, batch_id):
        raise RuntimeError("target is down")

    events = read_event_files(spark, str(folder))
    with pytest.raises(Exception, match="target is down"):
        finish(to_batches(events, {"t": fail}, settings, mode="append"))
    assert not spark.streams.active


def test_one_failure_stops_all_queries(spark, folder, settings):
    def fail(batch, batch_id):
        raise RuntimeError("target is down")

    events = read_event_files(spark, str(folder))
    paced = StreamSettings(scratch_path(spark, "checkpoint"), "1 second", 2)
    steady = to_files(events, scratch_path(spark, "out"), paced)
    failing = to_batches(events, {"t": fail}, settings, mode="append")
    with pytest.raises(Exception, match="target is down"):
        finish_all(spark, [steady, failing])
    assert not steady.isActive and not failing.isActive
    spark.streams.resetTerminated()


def test_an_earlier_failure_does_not_stop_other_queries(spark, folder, settings):
    def fail(batch, batch_id):
        raise RuntimeError("target is down")

    events = read_event_files(spark, str(folder))
    steady = to_files(events, scratch_path(spark, "out"), StreamSettings(scratch_path(spark, "checkpoint"), None, 2))
    with pytest.raises(Exception, match="target is down"):
        finish(to_batches(events, {"t": fail}, settings, mode="append"))
    finish_all(spark, [steady])
    assert steady.exception() is None


def test_live_windows_by_ids_equal_the_batch(spark, folder, movies, users, settings, rows):
    """Counted by ids, joined afterwards, and kept by changed hours."""
    items = movies.withColumns({"imdb_rating": F.when(F.col("movie_id") != "m2", 7.5), "is_original": F.lit(True)})
    stream = streams.health_partials(read_event_files(spark, str(folder)), "30 minutes")
    base = scratch_path(spark, "live")
    partials, result = (VersionedTable(spark, f"{base}/{name}", "hour") for name in ("partials", "result"))
    ids = ["user_id", "movie_id", *windowed.EVENT_KEYS]
    finished = lambda part: streams.finished_health(part, users, items)
    query = finish(streams.start_live_windows(stream, ids, partials, finished, result, settings))
    batch = streams.health_stream(static_events(spark, folder).drop("event_time"), users, items, "30 minutes", exact=True)
    want = windowed.health_from_users(batch)
    assert rows(result.read(), *want.columns) == rows(want)
    assert query_status(spark, query).first()["input_rows"] == 300
