"""Hot keys, changed windows, late rows, targets once each, and mergeable viewers."""

import datetime as dt
import os
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from viewtide.operators import sketches, windowed
from viewtide.session import scratch_path
from viewtide.sinks.ledger import Ledger
from viewtide.sinks.versioned import VersionedTable, upsert_windows
from viewtide.streaming import hotkeys
from viewtide.streaming.late import start_parted
from viewtide.streaming.queries import StreamSettings, add_batch, finish, progress_table, to_batches, to_files

SCHEMA = "event_id long, event_time timestamp, user_id long, movie_id long, action string, watch_duration_minutes double, progress_percentage double"
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def event(k, minute, user=None, movie=None):
    time = START + dt.timedelta(minutes=minute)
    return (k, time, k % 7 if user is None else user, k % 3 if movie is None else movie, "completed" if k % 2 else "stopped", float(k % 40), 50.0)


def slices(spark, parts):
    """One file a batch, in order."""
    path = scratch_path(spark, "slices")
    for rows in parts:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path, spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture
def settings(spark):
    return StreamSettings(scratch_path(spark, "checkpoint"), interval=None, state_partitions=2)


@pytest.fixture
def ordered(spark):
    """Six batches of an hour each, in order."""
    rng = random.Random(3)
    return slices(spark, [[event(100 * h + k, 60 * h + rng.random() * 60) for k in range(100)] for h in range(6)])


# -- notes ------------------------------------------------------------------------------


def test_notes_are_replaced_and_forgotten(spark):
    notes = Ledger(spark, scratch_path(spark, "notes"))
    assert notes.names() == [] and notes.get("a/b") is None
    notes.put("a/b", {"x": 1})
    notes.put("a/b", {"x": 2})
    notes.put("c")
    assert notes.names() == ["a/b", "c"] and notes.get("a/b") == {"x": 2} and notes.get("c") == {}
    notes.forget("a/b")
    assert notes.names() == ["c"]


# -- several targets, once each -----------------------------------------------------------


def test_a_crash_between_targets_repeats_only_the_second(spark, ordered, settings, tmp_path):
    _, stream = ordered
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    failing = {2}

    def append(batch, batch_id):
        batch.write.mode("append").parquet(first)

    def fragile(batch, batch_id):
        if batch_id in failing:
            raise RuntimeError("stopped between the targets")
        batch.write.mode("append").parquet(second)

    targets = {"first": append, "second": fragile}
    with pytest.raises(StreamingQueryException):
        finish(to_batches(stream, targets, settings, mode="append", once_each=True))
    # The first target has the batch, the second has not.
    assert spark.read.parquet(first).count() == 300 and spark.read.parquet(second).count() == 200
    failing.clear()
    finish(to_batches(stream, targets, settings, mode="append", once_each=True))
    for path in (first, second):
        found = spark.read.parquet(path)
        assert found.count() == found.select("event_id").distinct().count() == 600
    notes = Ledger(spark, f"{settings.checkpoint}-targets").names()
    assert notes == ["4-first", "4-second", "5-first", "5-second"]


# -- changed windows ----------------------------------------------------------------------


def upserted(spark, stream, settings, watermark, seen=None, **more):
    base = scratch_path(spark, "windows")
    partials = VersionedTable(spark, f"{base}/partials", "hour")
    result = VersionedTable(spark, f"{base}/result", "hour")
    hour = F.date_format(F.date_trunc("hour", "window_start"), "yyyy-MM-dd-HH")
    keys = [*windowed.WINDOW_BOUNDS, "movie_id", "user_id"]
    write = upsert_windows(partials, keys, hour, windowed.trending_from_users, result)

    def watched(batch, batch_id):
        if seen is not None:
            seen.append((batch_id, result.read()))
        write(batch, batch_id)

    counted = windowed.trending_by_user(stream.withWatermark("event_time", watermark), "10 minutes")
    query = finish(to_batches(counted, {"windows": watched}, settings, mode="update", **more))
    return query, partials, result


def test_changed_windows_make_the_whole_table_and_state_falls(spark, ordered, settings, rows):
    path, stream = ordered
    query, partials, result = upserted(spark, stream, settings, "10 minutes")
    batch = windowed.trending_content(spark.read.schema(SCHEMA).parquet(path), "10 minutes")
    assert rows(result.read(), *batch.columns) == rows(batch)
    state = [r["state_rows"] for r in progress_table(spark, query).orderBy("batch_id").collect()]
    # An hour comes in each batch; of the hours before only the open windows are kept.
    held = partials.read().count()
    assert max(state) < held / 2 and state[-1] < max(state)
    assert result.number() == partials.number() == 5
    note = result.current()
    assert len(note["parts"]) == 6 and all(f"/{k}-" in p for k, p in enumerate(v for _, v in sorted(note["parts"].items())))


def test_a_reader_sees_one_version_while_others_are_written(spark, settings, rows):
    # Every batch changes the same windows.
    _, stream = slices(spark, [[event(100 * b + k, k % 50) for k in range(100)] for b in range(4)])
    seen = []
    _, _, result = upserted(spark, stream, settings, "2 hours", seen)
    assert [b for b, _ in seen] == [0, 1, 2, 3] and seen[0][1] is None
    # Opened before batch 3, read after it: the files of batch 2 are still there.
    assert seen[3][1].agg(F.sum("view_count")).first()[0] == 300
    assert result.read().agg(F.sum("view_count")).first()[0] == 400
    paths = list(result.current()["parts"].values()) + result.current()["leaving"]
    assert len(paths) == 2 and all(os.path.exists(p) for p in paths)
    with pytest.raises(Exception, match="(?i)not.?exist|PATH_NOT_FOUND|FileNotFound"):
        seen[1][1].count()


def test_a_write_made_before_is_not_made_again(spark):
    table = VersionedTable(spark, scratch_path(spark, "table"), "day")
    assert table.read() is None and table.number() == -1
    one = spark.createDataFrame([("a", None, 1, "x"), ("b", 1, 2, "y")], "key string, k2 long, n long, day string")
    assert sorted(table.upsert(one, ["key", "k2"], 3)) == ["x", "y"]
    more = spark.createDataFrame([("a", None, 5, "x"), ("c", 1, 6, "x")], one.schema)
    for _ in range(2):
        table.upsert(more, ["key", "k2"], 4)
    assert sorted((r.key, r.n, r.day) for r in table.read().collect()) == [("a", 5, "x"), ("b", 2, "y"), ("c", 6, "x")]
    assert table.read(["y"]).count() == 1 and table.read([]).count() == 0
    assert not table.replace(one, ["x"], 4)
    # A partition without rows leaves the table.
    assert table.replace(one.limit(0), ["y"], 5) and table.read().count() == 2


def test_partitions_of_any_value(spark):
    """Values that paths cannot hold, and none at all."""
    table = VersionedTable(spark, scratch_path(spark, "table"), "day")
    rows = spark.createDataFrame([(1, "a/b: c=%?"), (2, None), (3, "null"), (4, "")], "key long, day string")
    assert len(table.upsert(rows, ["key"], 0)) == 4
    table.upsert(spark.createDataFrame([(2, None), (5, None)], rows.schema), ["key"], 1)
    found = sorted((r.key, r.day) for r in table.read().collect())
    assert found == [(1, "a/b: c=%?"), (2, None), (3, "null"), (4, ""), (5, None)]
    assert [r.key for r in table.read(["a/b: c=%?"]).collect()] == [1] and table.read([None]).count() == 2


# -- late rows ------------------------------------------------------------------------------


def test_late_rows_are_those_that_the_aggregate_drops(spark, settings):
    rng = random.Random(5)
    parts = []
    for h in range(7):
        own = [event(1000 * h + k, 60 * h + rng.random() * 60) for k in range(60)]
        late = [event(1000 * h + 500 + k, 60 * max(0, h - 2) + rng.random() * 90) for k in range(20)]
        parts.append(own + late)
    parts.append([event(9000, 5), (9001, None, 1, 1, "a", 1.0, 1.0)])
    path, stream = slices(spark, parts)
    kept, late = scratch_path(spark, "kept"), scratch_path(spark, "late")
    finish(start_parted(stream, kept, late, settings, dt.timedelta(minutes=5)))
    sides = [spark.read.parquet(p) for p in (kept, late)]
    assert sum(s.count() for s in sides) == 562
    # One group an event, so that the record counts events and not groups.
    counted = windowed.windowed(
        stream.filter("event_time IS NOT NULL").withWatermark("event_time", "10 minutes"), "5 minutes", ["event_id"], [F.count(F.lit(1)).alias("n")]
    )
    other = StreamSettings(scratch_path(spark, "checkpoint"), interval=None, state_partitions=2)
    query = finish(to_files(counted, scratch_path(spark, "windows"), other))
    dropped = {r["batch_id"]: r["late_rows_dropped"] for r in progress_table(spark, query).collect()}
    mine = {r["batch"]: r["count"] for r in sides[1].groupBy("batch").count().collect()}
    assert mine and mine == {k: n for k, n in dropped.items() if n}


def test_a_batch_run_again_parts_its_rows_alike(spark, settings):
    path, stream = slices(spark, [[event(b * 10 + k, 60 * b + k - 130 * (k == 0)) for k in range(10)] for b in range(4)])
    kept, late = scratch_path(spark, "kept"), scratch_path(spark, "late")
    for _ in range(2):
        finish(start_parted(stream, kept, late, settings, dt.timedelta(minutes=5)))
    assert spark.read.parquet(kept).count() + spark.read.parquet(late).count() == 40
    assert sorted(r[0] for r in spark.read.parquet(late).select("event_id").collect()) == [20, 30]


# -- hot keys -------------------------------------------------------------------------------


@pytest.fixture
def unbroadcast(spark):
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_one_user_with_half_of_all_events_fills_no_task(spark, unbroadcast, rows):
    # A third of the other events have no user.
    user = F.expr("CASE WHEN id % 2 = 0 THEN 7 WHEN id % 3 = 0 THEN NULL ELSE xxhash64(id) % 4000 END")
    events = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("event_id"), user.alias("user_id"))
    users = spark.range(-4000, 3000).select(F.col("id").alias("user_id"), (F.col("id") % 9).alias("country"))
    heavy = hotkeys.heavy_keys(events, "user_id")
    assert list(heavy) == [7] and abs(heavy[7] - 30_000) < 300
    joined = hotkeys.join_evenly(events, users, "user_id")
    plain = events.join(users, "user_id", "left")

    def tasks(df):
        return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())

    even, uneven = tasks(joined), tasks(plain)
    assert len(even) == 16 and even[-1] <= 2 * even[8] and uneven[-1] > 8 * uneven[8]
    assert rows(joined, "event_id", "user_id", "country") == rows(plain, "event_id", "user_id", "country")


def test_batches_without_heavy_keys_or_rows(spark, rows):
    users = spark.createDataFrame([("a", 1), ("b", 2)], "user_id string, country long")
    for values in ([], [("a",), (None,), ("z",)]):
        events = spark.createDataFrame(values, "user_id string")
        assert rows(hotkeys.join_evenly(events, users, "user_id")) == rows(events.join(users, "user_id", "left"))


# -- mergeable viewers ------------------------------------------------------------------------


def test_merged_sketches_stay_within_their_bounds(spark):
    events = spark.range(0, 120_000, 1, 4).select(
        F.timestamp_seconds(F.col("id") / 2).alias("event_time"),
        (F.xxhash64("id") % 30_000).alias("user_id"),
        (F.col("id") % 2).alias("movie_id"),
        F.lit("completed").alias("action"),
        F.lit(1.0).alias("watch_duration_minutes"),
    )
    windows = sketches.viewer_windows(events)
    hours = sketches.merged_windows(windows, "1 hour")
    days = sketches.with_viewers(sketches.merged_windows(hours, "1 day"))
    exact = events.groupBy(F.window("event_time", "1 day").start.alias("window_start"), "movie_id").agg(
        F.countDistinct("user_id").alias("exact"), F.count(F.lit(1)).alias("n")
    )
    for r in days.join(exact, ["window_start", "movie_id"]).collect():
        assert r["viewers_low"] <= r["exact"] <= r["viewers_high"] and r["view_count"] == r["n"]
        assert r["viewers_high"] - r["viewers_low"] < 0.06 * r["exact"]


def test_no_users_count_zero(spark):
    events = spark.createDataFrame([event(1, 0, None, 1)], SCHEMA).withColumn("user_id", F.lit(None).cast("long"))
    assert sketches.with_viewers(sketches.viewer_windows(events)).first()["viewers"] == 0


@pytest.mark.parametrize("rows_a_file, files", [(5, 5), (1000, 1)])
def test_slices_of_several_files_are_a_batch_each(spark, tmp_path, monkeypatch, rows_a_file, files):
    from viewtide.plans import domain
    from viewtide.plans.queries_streams import once
    from viewtide.streaming.queries import add_batch, finish, to_batches

    monkeypatch.setattr(domain, "FILE_ROWS", rows_a_file)
    monkeypatch.setattr(domain, "MOST_FILES", 5)
    spark.range(3000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(id % 30 AS INT)) AS ts",
        "id % 7 AS user_id", "'click' AS event_type", "CAST(id AS DOUBLE) AS value", "'{}' AS props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    path = domain.event_slices(spark, str(tmp_path))
    assert len(spark.read.parquet(path).inputFiles()) == files * domain.SLICES
    out = str(tmp_path / "out")
    stream = domain.sliced_stream(spark, path, str(tmp_path))
    finish(to_batches(stream, {"kept": add_batch(out)}, once(spark), mode="append"))
    own = lambda k: min(k % 30 // 5, 5) + (3 if k % 13 == 0 else 0)
    assert sorted((r.event_id, r.batch) for r in spark.read.parquet(out).collect()) == [(k, own(k)) for k in range(3000)]


def test_changed_windows_keep_their_state_on_disk(spark, tmp_path, monkeypatch, rows):
    """No window closes here, so the state grows with the events and must not be in memory."""
    from viewtide.plans import domain, queries_live
    from viewtide.streaming.enrich import enrich

    spark.range(2000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(id % 30 AS INT)) AS ts",
        "id % 7 AS user_id", "'click' AS event_type", "CAST(id AS DOUBLE) AS value", "'{\"k\": 3}' AS props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    ended = []
    monkeypatch.setattr(queries_live, "finish", lambda query: ended.append(finish(query)))
    keys = [*windowed.WINDOW_BOUNDS, "movie_id", "user_id"]
    build = lambda events: windowed.trending_by_user(enrich(events, watermark=queries_live.PATIENCE), "1 hour")
    found = queries_live._upserted(spark, str(tmp_path), build, keys, windowed.trending_from_users)
    state = ended[0].lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == 210 and any(name.startswith("rocksdb") for name in state["customMetrics"])
    whole = windowed.trending_content(domain.events(spark, str(tmp_path)), "1 hour")
    assert rows(found, *whole.columns) == rows(whole)
