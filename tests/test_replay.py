import glob
import json

import pytest
from pyspark.sql import functions as F

from viewtide.operators import replay
from viewtide.session import scratch_path


def test_recent_events_break_ties(spark, rows):
    df = spark.createDataFrame(
        [("s1", "2024-01-01"), ("s2", "2024-01-02"), ("s3", "2024-01-02"), ("s4", "2023-01-01")],
        "session_id STRING, watch_date STRING",
    )
    assert rows(replay.recent_events(df, n=2), "session_id") == [("s2",), ("s3",)]
    assert rows(replay.recent_events(df, n=1), "session_id") == [("s3",)]


def test_replay_time_from_offsets(spark):
    df = spark.sql(
        "SELECT DATE'2024-02-28' AS watch_date, 23 AS hour, 59 AS minute, 58 AS second "
        "UNION ALL SELECT DATE'2024-02-28', 24, 0, 1"
    )
    found = replay.with_replay_time(df)
    assert found.columns == ["watch_date", "timestamp"]
    assert sorted(r["timestamp"] for r in found.collect()) == ["2024-02-28 23:59:58", "2024-02-29 00:00:01"]


@pytest.mark.parametrize("partitions", [None, 7])
def test_slices_are_complete_and_ordered(spark, partitions):
    # A third of the events share one moment, and a tenth are copies of one row.
    df = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 10 == 0, 1500).otherwise(F.col("id")).alias("event_id"),
        F.when(F.col("id") % 3 == 0, 1000).otherwise(F.col("id") * 7 % 2000).alias("event_time"),
    )
    sliced = replay.ordered_slices(df, ["event_time", "event_id"], size=70, partitions=partitions)
    found = sorted(
        (r["slice"], r["slice_row"], r["event_time"], r["event_id"]) for r in sliced.collect()
    )
    assert [(s, n) for s, n, _, _ in found] == [divmod(i, 70) for i in range(3000)]
    expected = sorted((r["event_time"], r["event_id"]) for r in df.collect())
    assert [(t, e) for _, _, t, e in found] == expected


def test_slices_of_no_rows(spark):
    empty = spark.range(0).withColumnRenamed("id", "event_time")
    assert replay.ordered_slices(empty, ["event_time"]).count() == 0


def test_written_slices_are_one_ordered_file_each(spark):
    df = spark.range(500).select(F.col("id").alias("event_id"), (500 - F.col("id")).alias("event_time"))
    path = scratch_path(spark, "slices-out")
    replay.write_slices(replay.ordered_slices(df, ["event_time"], size=150), path)
    sizes = []
    for number in range(4):
        files = glob.glob(f"{path}/slice={number}/*.json")
        assert len(files) == 1
        times = [json.loads(line)["event_time"] for line in open(files[0])]
        assert times == sorted(times)
        sizes.append(len(times))
    assert sizes == [150, 150, 150, 50]
