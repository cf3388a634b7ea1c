import json

import pytest

import __spark_entry__ as driver
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from viewtide import schemas
from viewtide.session import scratch_path, shared_dir
from viewtide.sinks.tables import TableSink, write_tables
from viewtide.sinks.topic import topic_sink_options
from viewtide.sources import events, tables


def test_csv_with_schema_checks_the_header(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,x\n,y\n")
    good = tables.read_csv(spark, str(path), StructType.fromDDL("a INT, b STRING"))
    assert [tuple(r) for r in good.collect()] == [(1, "x"), (None, "y")]
    inferred = tables.read_csv(spark, str(path))
    assert inferred.dtypes == [("a", "int"), ("b", "string")]
    swapped = tables.read_csv(spark, str(path), StructType.fromDDL("b STRING, a INT"))
    with pytest.raises(Exception, match="header does not conform"):
        swapped.collect()


def test_load_tables_and_shapes(spark, tmp_path, rows):
    (tmp_path / "u.csv").write_text("user_id,n\nu1,1\nu2,2\n")
    (tmp_path / "m.csv").write_text("movie_id\nm1\n")
    loaded = tables.load_tables(spark, f"{tmp_path}/", {"users": "u.csv", "movies": "m.csv"}, {})
    assert rows(tables.table_shapes(loaded)) == [("movies", 1, 1), ("users", 2, 2)]
    report = tables.key_columns_report(loaded)
    assert rows(report) == [
        ("movies", "movie_id", "string", 1, 0),
        ("users", "user_id", "string", 2, 0),
    ]
    assert tables.sample_keys(loaded["users"], 1).columns == ["user_id"]


def test_movies_schema_takes_the_platform_flag():
    assert "is_ours" in schemas.movies_schema("is_ours").fieldNames()
    assert len(schemas.movies_schema()) == 18
    assert (len(schemas.USERS), len(schemas.WATCH_HISTORY), len(schemas.WATCH_EVENT)) == (16, 12, 13)


def test_orphans_count_null_and_hot_keys(spark, rows):
    fact = spark.range(900).select(
        F.when(F.col("id") < 300, "hot").when(F.col("id") < 301, None).otherwise("known").alias("k")
    )
    dimension = spark.createDataFrame([("known",), ("known",)], "k STRING")
    assert rows(tables.orphan_keys(fact, dimension, "k")) == [("hot", 300), (None, 1)]


def _envelope(spark, *messages):
    frame = spark.createDataFrame([(m,) for m in messages], "value STRING")
    return frame.select(F.col("value").cast("binary"))


def test_decode_maps_nan_and_keeps_bad_rows(spark):
    envelope = _envelope(
        spark,
        '{"session_id":"s1","quality":NaN,"progress_percentage":NaN,"is_download":true}',
        '{"session_id":"s2","progress_percentage":"oops"}',
        '{"session_id":',
    )
    found = events.decode_json(envelope).select(
        "session_id", "quality", "progress_percentage", "is_download"
    )
    assert [tuple(r) for r in found.collect()] == [
        ("s1", None, None, True),
        ("s2", None, None, None),
        (None, None, None, None),
    ]


def test_json_file_stream_and_kafka_agree_on_nan(spark, tmp_path):
    record = {"session_id": "s", "quality": float("nan"), "progress_percentage": float("nan")}
    text = json.dumps(record)
    (tmp_path / "part.json").write_text(text + "\n")
    static = spark.read.schema(schemas.WATCH_EVENT).json(str(tmp_path))
    cleaned = events.nan_to_null(static).first()
    assert cleaned == events.decode_json(_envelope(spark, text)).first()


def test_validation_names_the_first_fault(spark, rows):
    good = {"session_id": "s", "user_id": "u", "movie_id": "m", "timestamp": "2024-01-01 00:00:00"}
    messages = [
        json.dumps(good),
        json.dumps(good | {"user_id": None}),
        json.dumps(good | {"timestamp": "yesterday"}),
        "not json",
        "{}",
    ]
    valid, rejected = events.split_valid(events.validate_events(_envelope(spark, *messages)))
    assert valid.count() == 1
    assert "event_time" in valid.columns and "raw" not in valid.columns
    assert rows(rejected) == sorted(
        [
            (messages[1], "missing user_id"),
            (messages[2], "bad timestamp"),
            (messages[3], "malformed"),
            (messages[4], "malformed"),
        ],
        key=repr,
    )


def test_encode_decode_roundtrip(spark, rows):
    df = spark.createDataFrame(
        [("s1", 'quo"te', 1.5), ("s2", None, None)], "session_id STRING, title STRING, x DOUBLE"
    )
    encoded = events.encode_json(df)
    assert encoded.columns == ["value"]
    assert rows(events.decode_json(encoded, df.schema)) == rows(df)


def test_topic_options():
    assert events.topic_options("b:9092", "t") == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    limited = events.topic_options("b", "t", max_offsets=10, min_partitions=30)
    assert (limited["maxOffsetsPerTrigger"], limited["minPartitions"]) == ("10", "30")
    sink = topic_sink_options("b", "t", linger_ms="5")
    assert sink == {
        "kafka.bootstrap.servers": "b",
        "topic": "t",
        "kafka.acks": "all",
        "kafka.linger.ms": "5",
    }


def test_write_tables_overwrites_and_capitalises(spark, rows):
    sink = TableSink(scratch_path(spark, "test"))
    first = {"users": spark.range(5), "extra": spark.range(2)}
    write_tables(first, sink, schemas.CLEANED_NAMES)
    paths = write_tables({"users": spark.range(3), "extra": spark.range(1)}, sink, {"users": "Users"})
    assert paths["users"].endswith("/Users") and paths["extra"].endswith("/Extra")
    assert spark.read.parquet(paths["users"]).count() == 3


def test_sink_sorts_and_names_warehouse_tables(spark):
    sink = TableSink(scratch_path(spark, "test"), format="json")
    frame = spark.createDataFrame([(1, "a"), (3, "b"), (3, "a")], "n INT, s STRING")
    path = sink.overwrite(frame.coalesce(1), "sorted", sort_by=["-n", "s"])
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert lines == ['{"n":3,"s":"a"}', '{"n":3,"s":"b"}', '{"n":1,"s":"a"}']
    assert TableSink("proj.set", "x", name_option="table").target("t") == "proj.set.t"


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master):
        self.conf, self.sparkContext = {}, Context(master)


@pytest.mark.parametrize("master", ["spark://host:7077", "local[4]"])
def test_missing_shared_dir_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session(master))


@pytest.mark.parametrize(
    "master, named", [("local", True), ("local[*]", True), ("local-cluster[2,1,1024]", False), ("yarn", False)]
)
def test_entry_names_a_folder_for_local_sessions_only(master, named):
    session = Session(master)
    driver._with_scratch(lambda spark, sf_dir: None)(session, "")
    assert (session.sparkContext.folder is not None) == named


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (configured or shared_dir(spark)).rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_documented_schemas_read_their_files(spark, tmp_path):
    lines = {
        "users": "u1,a@x,A,B,NaN,,USA,TX,Austin,Basic,2024-01-05,True,,TV,,2024-01-05 10:11:12",
        "movies": "m1,One,Movie,Drama,,2020,95.5,PG,English,USA,,1.5e6,,,,False,2023-05-06,True",
        "watch_history": "s1,u1,m1,2024-05-01,TV,,12.5,started,HD,USA,False,",
    }
    for name, line in lines.items():
        header = ",".join(schemas.TABLE_SCHEMAS[name].fieldNames())
        (tmp_path / f"{name}.csv").write_text(f"{header}\n{line}\n")
    files = {name: f"{name}.csv" for name in lines}
    loaded = tables.load_tables(spark, str(tmp_path), files, schemas.TABLE_SCHEMAS)
    user = loaded["users"].first()
    assert user["is_active"] is True and user["monthly_spend"] is None
    assert user["gender"] is None and str(user["created_at"]) == "2024-01-05 10:11:12"
    movie = loaded["movies"].first()
    assert (movie["release_year"], movie["production_budget"]) == (2020, 1.5e6)
    assert movie["is_original"] is False and str(movie["added_to_platform"]) == "2023-05-06"
    watched = loaded["watch_history"].first()
    assert str(watched["watch_date"]) == "2024-05-01 00:00:00"
    assert watched["user_rating"] is None and watched["is_download"] is False
