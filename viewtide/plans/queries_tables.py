"""Catalogue entries: sources, sinks, keys and the star join."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewtide.functions.eventtime import with_watch_month
from viewtide.operators.star import review_ratings, star_join
from viewtide.plans import domain
from viewtide.plans.catalog import query
from viewtide.session import scratch_path
from viewtide.sinks.tables import TableSink, write_tables
from viewtide.sources.tables import key_columns_report, orphan_keys, read_csv, table_shapes


@query("scan_csv_roundtrip", "SELECT * FROM v_watch")
def scan_csv_roundtrip(spark, sf_dir):
    sessions = domain.watch(spark, sf_dir)
    path = scratch_path(spark, "csv")
    sessions.write.option("header", True).csv(path)
    return read_csv(spark, path, sessions.schema)


@query(
    "table_shapes",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {t}) AS row_count, "
        f"CAST((SELECT COUNT(*) FROM (DESCRIBE SELECT * FROM {t})) AS INTEGER) AS column_count"
        for t in domain.RAW_TABLES
    ),
)
def shapes(spark, sf_dir):
    return table_shapes({t: domain.table(spark, sf_dir, t) for t in domain.RAW_TABLES})


_KEYED = {
    "users": ["user_id"],
    "movies": ["movie_id"],
    "watch": ["user_id", "movie_id", "session_id"],
    "reviews": ["user_id", "movie_id"],
    "events": ["user_id", "movie_id"],
}


@query(
    "key_columns_report",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS key_column, 'bigint' AS data_type, "
        f"COUNT(*) AS row_count, COUNT(*) - COUNT({k}) AS missing_count FROM v_{t}"
        for t, keys in _KEYED.items()
        for k in keys
    ),
)
def keys_report(spark, sf_dir):
    return key_columns_report({t: getattr(domain, t)(spark, sf_dir) for t in _KEYED})


@query(
    "orphan_keys",
    """SELECT movie_id, COUNT(*) AS fact_rows FROM v_watch
       WHERE movie_id NOT IN (SELECT movie_id FROM v_movies) GROUP BY movie_id""",
)
def orphans(spark, sf_dir):
    return orphan_keys(domain.watch(spark, sf_dir), domain.movies(spark, sf_dir), "movie_id")


@query(
    "sink_roundtrip",
    "SELECT *, CAST(YEAR(watch_date) AS INTEGER) AS watch_year FROM v_watch",
)
def sink_roundtrip(spark, sf_dir):
    sessions = domain.watch(spark, sf_dir).withColumn("watch_year", F.year("watch_date"))
    sink = TableSink(scratch_path(spark, "sink"))
    # The second write replaces the first.
    sink.overwrite(sessions.filter("session_seq = 1"), "sessions")
    path = sink.overwrite(
        sessions.hint("rebalance", "watch_year"), "sessions", partition_by=["watch_year"]
    )
    return spark.read.parquet(path)


@query(
    "cleaned_tables",
    """SELECT 'Users' AS table_name, COUNT(*) AS row_count FROM v_users
       UNION ALL SELECT 'Movies', COUNT(*) FROM v_movies
       UNION ALL SELECT 'Reviews', COUNT(*) FROM v_reviews""",
)
def cleaned_tables(spark, sf_dir):
    names = ("users", "movies", "reviews")
    tables = {name: getattr(domain, name)(spark, sf_dir) for name in names}
    paths = write_tables(tables, TableSink(scratch_path(spark, "cleaned")))
    written = {path.rsplit("/", 1)[1]: spark.read.parquet(path) for path in paths.values()}
    return table_shapes(written).drop("column_count")


@query("review_ratings", "SELECT * FROM v_ratings")
def ratings(spark, sf_dir):
    return review_ratings(domain.reviews(spark, sf_dir))


@query(
    "star_join",
    """SELECT session_id, session_seq, user_id, movie_id, watch_date, watch_year, watch_month,
              country, subscription_plan, title, genre_primary, watch_duration_minutes, action,
              ROUND(user_rating, 4) AS user_rating FROM v_star""",
)
def star(spark, sf_dir):
    joined = star_join(
        domain.watch(spark, sf_dir),
        domain.users(spark, sf_dir),
        domain.movies(spark, sf_dir),
        domain.reviews(spark, sf_dir),
    )
    return with_watch_month(joined).select(
        "session_id", "session_seq", "user_id", "movie_id", "watch_date", "watch_year",
        "watch_month", "country", "subscription_plan", "title", "genre_primary",
        "watch_duration_minutes", "action", F.round("user_rating", 4).alias("user_rating"),
    )
