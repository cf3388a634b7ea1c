"""Copies by hashes, bit sets of months, top lists, as-of joins, steps, rejected lines, dense ids."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from viewtide.operators import activity, asof, copies, metrics, models, quality, toplists
from viewtide.session import discard, materialise, scratch_path, shared_dir
from viewtide.sinks.ledger import Ledger, Steps, combined, fingerprint
from viewtide.sources.tables import csv_with_rejects
from viewtide.schemas import fields

# -- copies -------------------------------------------------------------------------------


@pytest.fixture
def wide(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(40) if k % 9 else None, "x" * 200 + str(k % 70), float("nan") if k % 11 == 0 else k % 5 * 1.0, None) for k in range(400)]
    rows += [(1, "hot", 1.0, None)] * 300 + [(2, "zero", 0.0, None), (2, "zero", -0.0, None)]
    return spark.createDataFrame(rows, "id int, text string, `n.x` double, empty string").repartition(5)


@pytest.mark.parametrize("critical", [[], ["id"], ["id", "n.x"]])
def test_profile_by_hashes_is_the_whole_profile(wide, critical):
    mine = copies.repeated_rows(wide).profile(critical)
    assert mine.columns == quality.table_profile(wide, critical).columns
    assert mine.first() == quality.table_profile(wide, critical).first()
    assert [f.name for f in copies.profile_schema(wide)] == mine.columns


def test_distinct_rows_and_empty_tables(wide, rows):
    shown = [F.col("id"), F.col("text"), F.col("`n.x`").cast("string").alias("n")]
    assert rows(copies.repeated_rows(wide).distinct().select(*shown)) == rows(wide.dropDuplicates().select(*shown))
    none = copies.repeated_rows(wide.limit(0))
    assert none.distinct().count() == 0 and none.profile().first() == quality.table_profile(wide.limit(0)).first()


def test_equal_hashes_do_not_make_copies(spark, wide, monkeypatch):
    """With hashes of one bit all rows are fetched, and still only equal ones are copies."""
    weak = lambda df: df.withColumns({"__h1": F.length("text") % 2, "__h2": F.lit(0)}).withColumns(
        {h: F.col(h).cast("long") for h in copies.HASHES}
    )
    monkeypatch.setattr(copies, "_hashed", weak)
    assert copies.repeated_rows(wide).profile().first() == quality.table_profile(wide).first()


def test_only_hashes_are_shuffled(spark):
    """The exchange below the counting of hashes holds them and a count, however wide the rows."""
    columns = [F.repeat(F.sha2(F.concat("id", F.lit(str(i))), 256), 3).alias(f"c{i}") for i in range(12)]
    wide = materialise(spark.range(0, 3000, 1, 3).select("id", *columns), "wide")
    assert copies.repeated_rows(wide).hashes.count() == 0
    counted = copies._hashed(wide).groupBy(*copies.HASHES).count()
    plan = counted._jdf.queryExecution().executedPlan()
    exchange = next(line for line in plan.toString().splitlines() if "Exchange" in line)
    partial = next(line for line in plan.toString().splitlines() if "partial_count" in line)
    assert "__h1" in exchange and "__h1" in partial
    assert not any(f"c{i}#" in line for line in (exchange, partial) for i in range(12))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def many(spark):
    """Rows of which a tenth repeats, by a join; and how many there are."""
    left = spark.range(40_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    right = spark.range(40_000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, 2).otherwise(1).alias("n"))
    return left.join(right, "k").withColumn("copy", F.explode(F.sequence(F.lit(1), "n"))).drop("copy", "n")


def test_rows_are_found_by_a_bitmap_and_not_made_again(spark, many, rows):
    """Without joins by size, wide rows still are not shuffled, and the table's own join runs once."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = copies.repeated_rows(many)
        assert found.hashes.count() == 4000
        few = found._by_bitmap("left_semi")
        assert "SortMergeJoin" not in _plan(few) and "Exchange hash" not in _plan(few)
        assert 8000 <= few.count() < 12_000
        assert few.count() + found._by_bitmap("left_anti").count() == 44_000
        assert rows(found.candidates().groupBy().count()) == [(8000,)]
        assert _plan(found.distinct()).count("SortMergeJoin") == 0
        assert rows(found.distinct()) == rows(many.distinct())
        assert found.profile(["text"]).first() == quality.table_profile(many, ["text"]).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_bitmaps_are_bounded_and_may_be_too_small(many, rows, monkeypatch):
    assert [copies._bitmaps_for(n) for n in (0, 1, 2048, 2049, 10_000, 10**12)] == [1, 1, 1, 2, 8, copies.MOST_BITMAPS]
    monkeypatch.setattr(copies, "MOST_BITMAPS", 1)
    monkeypatch.setattr(copies, "BITMAP_BITS", 64)
    found = copies.repeated_rows(many)
    assert found.count == 1 and found.distinct().count() == 40_000
    assert found.profile().first() == quality.table_profile(many).first()


def test_stored_rows_keep_names_and_empty_columns(spark):
    odd = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "`a b,(c)` int, `x.y` string").withColumn("void", F.lit(None))
    found = copies.repeated_rows(odd)
    assert found.distinct().schema == odd.schema and found.distinct().count() == 2
    assert found.profile().first() == quality.table_profile(odd).first()


# -- bit sets -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sessions(spark):
    rng = random.Random(4)
    rows = []
    for k in range(3000):
        year, month = 1999 + rng.randrange(8), rng.randrange(1, 13)
        rows.append((rng.randrange(60), year, month, dt.datetime(year, month, rng.randrange(1, 28))))
    # One user over many blocks of months, with neighbouring months across a block's end.
    rows += [(99, y, m, dt.datetime(y, m, 1)) for y, m in ((1994, 12), (2005, 3), (2005, 4), (2005, 5), (2010, 8), (2010, 9))]
    return materialise(spark.createDataFrame(rows, "user_id int, watch_year int, watch_month int, watch_date_parsed timestamp"), "s")


def test_every_added_month_gives_the_metrics_of_all_sessions(sessions, rows):
    stored = None
    for upto in (2001, 2004, 2005, 2011):
        new = sessions.filter(f"watch_year * 12 <= {upto * 12}")
        new = new if stored is None else new.filter(f"watch_year > {last}")  # noqa: F821
        added = activity.active_months(new)
        stored = materialise(added if stored is None else activity.merge_months(stored, added), "bits")
        last = upto
        seen = sessions.filter(f"watch_year <= {upto}")
        assert rows(activity.retention(stored)) == rows(metrics.cohort_retention(seen), *activity.retention(stored).columns)
        assert rows(activity.churn(stored)) == rows(metrics.monthly_churn(seen))
        users = seen.groupBy("watch_year", "watch_month").agg(F.countDistinct("user_id"))
        assert rows(activity.monthly_users(stored)) == rows(users)
    # A month that comes again changes nothing.
    again = activity.merge_months(stored, activity.active_months(sessions.filter("watch_year = 2004")))
    assert rows(again, "user_id", "block", "bits") == rows(stored, "user_id", "block", "bits")


def test_no_sessions(sessions):
    none = activity.active_months(sessions.limit(0))
    assert [activity.retention(none).count(), activity.churn(none).count()] == [0, 0]


# -- top lists --------------------------------------------------------------------------------


@pytest.mark.parametrize("skewed, tracked, proven", [(True, 256, True), (False, 64, False), (False, 4096, True)])
def test_top_lists_are_exact_whether_proven_or_not(spark, rows, skewed, tracked, proven):
    item = "cast(pow(2, (xxhash64(id) % 1000 + 1000) / 200.0) AS long)" if skewed else "abs(xxhash64(id)) % 900"
    events = spark.range(0, 20_000, 1, 4).select(
        F.timestamp_seconds(F.col("id") * 7).alias("event_time"),
        F.expr(f"CASE WHEN id % 50 <> 0 THEN {item} END").alias("item"),
    )
    windows = materialise(toplists.item_windows(events, "item", "1 hour", tracked=tracked), "top")
    best, sure = toplists.top_items(events, windows, "item", 5, tracked)
    full = toplists.counts_of(events, "item").orderBy(F.desc("views"), "item").limit(5)
    assert [tuple(r) for r in best.collect()] == [tuple(r) for r in full.collect()] and sure == proven


def test_the_bound_covers_all_other_items(spark):
    rng = random.Random(6)
    items = [int(rng.paretovariate(0.7)) % 5000 for _ in range(30_000)]
    events = spark.createDataFrame([(dt.datetime(2024, 1, 1 + k % 9), x) for k, x in enumerate(items)], "event_time timestamp, item int")
    windows = materialise(toplists.item_windows(events, "item", "1 day", tracked=64), "top")
    named, bound = toplists.leading_items(windows, 20, 64)
    counts = Counter(items)
    assert max((n for x, n in counts.items() if x not in set(named)), default=0) <= bound
    assert toplists.top_items(events.limit(0), windows.limit(0), "item", 5)[0].count() == 0


# -- as of ----------------------------------------------------------------------------------


@pytest.mark.parametrize("period", ["day", "month", "year"])
def test_last_change_before_each_row(spark, period):
    rng = random.Random(8)
    start = dt.datetime(2023, 11, 1)
    moment = lambda: start + dt.timedelta(hours=rng.randrange(24 * 120)) if rng.random() > 0.05 else None
    # One key has most of the rows.
    key = lambda: None if rng.random() < 0.05 else 0 if rng.random() < 0.6 else rng.randrange(1, 6)
    changes = [(key(), moment(), k, None if rng.random() < 0.1 else f"p{k}", k * 1.5) for k in range(150)]
    changes += [(0, start, 900, "tie", 1.0), (0, start, 901, "later", 2.0), (0, start, 899, "earlier", 3.0)]
    asked = [(k, key(), moment()) for k in range(400)] + [(500, 0, start), (501, 77, start), (500, 0, start)]
    found = asof.as_of_join(
        spark.createDataFrame(asked, "row int, user_id int, at timestamp").repartition(3),
        spark.createDataFrame(changes, "user_id int, changed_at timestamp, id int, plan string, n double").repartition(3),
        "user_id", "at", ["plan", "n"], ties=["id"], period=period,
    )
    assert found.columns == ["row", "user_id", "at", "as_of", "plan", "n"]
    want = []
    for row, user, at in asked:
        before = [(c[1], c[2], c[3], c[4]) for c in changes if user is not None and at is not None and c[0] == user and c[1] is not None and c[1] <= at]
        last = max(before, key=lambda c: c[:2], default=(None, None, None, None))
        want.append((row, user, at, last[0], last[2], last[3]))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


# -- steps ------------------------------------------------------------------------------------


def test_steps_are_repeated_only_where_their_note_does_not_fit(spark, tmp_path):
    notes, ran = Ledger(spark, scratch_path(spark, "steps")), []
    out = str(tmp_path / "out")

    def work():
        ran.append(1)
        spark.range(3).write.mode("overwrite").parquet(out)
        return {"rows": 3}

    steps = Steps(notes)
    assert steps.run("a", "f1", out, work) == steps.run("a", "f1", out, work) == {"rows": 3} and len(ran) == 1
    steps.run("a", "f2", out, work)
    steps.run("a", None, out, work)
    steps.run("a", None, out, work)
    assert len(ran) == 4

    def broken():
        raise RuntimeError("broke")

    steps.run("a", "f3", out, work)
    with pytest.raises(RuntimeError):
        steps.run("a", "f4", out, broken)
    # The old note is gone, since its output may be half replaced.
    steps.run("a", "f3", out, work)
    assert len(ran) == 6
    discard_out = Ledger(spark, str(tmp_path))
    discard_out.delete_data(out)
    steps.run("a", "f3", out, work)
    assert len(ran) == 7


def test_fingerprints_follow_the_files_and_the_plan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    read = lambda: spark.read.parquet(path)
    first = fingerprint(read())
    assert first == fingerprint(read()) != fingerprint(read().filter("id > 1"))
    assert fingerprint(read().filter("id > 1")) == fingerprint(read().filter("id > 1"))
    spark.range(5).write.mode("append").parquet(path)
    assert fingerprint(read()) != first
    assert fingerprint(spark.createDataFrame([(1,)], "a int")) is None
    assert combined("a", None) is None and combined("a", "b") != combined("ab")


def test_only_scratch_is_discarded(spark):
    path = scratch_path(spark, "gone")
    spark.range(2).write.parquet(path)
    discard(spark, path)
    assert not Ledger(spark, path).exists(path)
    for other in ("/tmp", shared_dir(spark), f"{shared_dir(spark)}/../x"):
        with pytest.raises(ValueError):
            discard(spark, other)


# -- rejected lines -------------------------------------------------------------------------------


def test_every_line_is_read_or_rejected(spark, tmp_path, rows):
    lines = ["id,n,text", "1,2.5,a", '2,x,"b, c"', "3,1.0", "4,1,b,more", '5,,"quoted, text"', ",,", "y,1,z"]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    schema = fields(id="long", n="double", text="string")
    good, rejected = csv_with_rejects(spark, str(tmp_path / "t.csv"), schema)
    assert rows(good) == sorted([(1, 2.5, "a"), (5, None, "quoted, text"), (None, None, None)], key=repr)
    assert sorted(r.line for r in rejected.collect()) == sorted(['2,x,"b, c"', "3,1.0", "4,1,b,more", "y,1,z"])
    assert rejected.first().file.endswith("t.csv")
    # The same lines are rejected whatever columns are read.
    assert good.select("text").count() == 3 and rejected.select("line").count() == 4


# -- dense ids ----------------------------------------------------------------------------------------


def test_ids_are_dense_and_keep_their_values(spark):
    values = spark.createDataFrame([(f"k{k % 500}",) for k in range(2000)] + [(None,)], "key string").repartition(7)
    numbered = models.dense_ids(values, "key", "id").collect()
    assert sorted(r["id"] for r in numbered) == list(range(500)) and len({r["key"] for r in numbered}) == 500


def test_recommendations_under_text_ids(spark):
    rows = [(f"u{u}", f"m{m}", 5.0 if u % 2 == m % 2 else 1.0) for u in range(20) for m in range(16) if (u + 3 * m) % 4]
    model = models.rating_model(spark.createDataFrame(rows, "user_id string, movie_id string, user_rating double"), rank=3)
    best = models.recommendations(model, 4).collect()
    assert len(best) == 80 and {r["position"] for r in best} == {1, 2, 3, 4}
    assert all(int(r["user_id"][1:]) % 2 == int(r["movie_id"][1:]) % 2 for r in best)
    pairs = spark.createDataFrame([("u1", "m1"), ("u1", "none"), (None, "m1"), ("u1", "m1")], "user_id string, movie_id string")
    found = models.predicted_ratings(model, pairs).collect()
    assert sorted((r["movie_id"], r["predicted_rating"] is None) for r in found) == [("m1", False), ("m1", False), ("m1", True), ("none", True)]
    known = spark.createDataFrame(rows, "user_id string, movie_id string, user_rating double")
    own, constant = models.rating_errors(models.predicted_ratings(model, known), model.mean)
    assert own < 0.5 < constant


def test_known_and_unknown_pairs_share_their_joins(spark):
    rows = [(f"u{u}", f"m{m}", float(u % 5)) for u in range(20) for m in range(16)]
    model = models.rating_model(spark.createDataFrame(rows, "user_id string, movie_id string, user_rating double"), rank=2, iterations=2)
    pairs = spark.createDataFrame([("u1", "m1"), ("u1", "none"), ("none", "m1"), (None, None)], "user_id string, movie_id string")
    found = models.predicted_ratings(model, pairs)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 4
    assert sum(r["predicted_rating"] is None for r in found.collect()) == 3
