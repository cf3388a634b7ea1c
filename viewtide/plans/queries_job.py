"""Catalogue entries: the whole batch job, with its five results and its reports."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.plans import domain
from viewtide.plans.batch import BatchRun, run_batch
from viewtide.plans.catalog import CATALOG, query
from viewtide.plans.oracle import VIEWS
from viewtide.plans import queries_batch, queries_quality  # noqa: F401  (their SQL is used below)
from viewtide.plans.queries_batch import rounding
from viewtide.session import shared_dir
from viewtide.sinks.ledger import Ledger
from viewtide.sinks.tables import TableSink
from viewtide.sources.tables import table_shapes

_TEXT_ID = "'u' || CAST(user_id AS VARCHAR) AS user_id"
#: The raw tables as the job leaves them: complete in the critical columns, without copies.
CLEANED = {
    **{f"{name}_as_given": VIEWS[name].replace("v_watch", "v_watch_as_given") for name in ("v_watch", "v_users", "v_movies", "v_reviews")},
    "v_raw_watch": VIEWS["v_raw_watch"].replace("v_watch", "v_watch_as_given"),
    "v_users": f"SELECT DISTINCT * REPLACE ({_TEXT_ID}) FROM v_users_as_given WHERE email IS NOT NULL",
    "v_movies": "SELECT DISTINCT * FROM v_movies_as_given WHERE title IS NOT NULL",
    "v_watch": """SELECT DISTINCT * EXCLUDE (unused) REPLACE (
            CASE WHEN NOT isnan(watch_duration_minutes) THEN watch_duration_minutes END AS watch_duration_minutes)
        FROM v_raw_watch WHERE session_id IS NOT NULL AND user_id IS NOT NULL AND movie_id IS NOT NULL""",
    "v_reviews": f"SELECT DISTINCT * REPLACE ({_TEXT_ID}) FROM v_reviews_as_given",
}
JOB_VIEWS = CLEANED | {name: body for name, body in VIEWS.items() if name not in CLEANED}


def raw_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """Four raw tables: copies, missing values, an empty column, and ids as text."""

    def text_id(df: DataFrame) -> DataFrame:
        return df.withColumn("user_id", F.concat(F.lit("u"), "user_id"))

    return {
        "users": text_id(domain.users(spark, sf_dir)),
        "movies": domain.movies(spark, sf_dir),
        "watch_history": domain.raw_watch(spark, sf_dir),
        "reviews": text_id(domain.reviews(spark, sf_dir)),
    }


def job_folder(spark, sf_dir) -> str:
    return f"{shared_dir(spark)}/job-{zlib.crc32(sf_dir.encode()):08x}"


def job(spark, sf_dir) -> BatchRun:
    """Run the job, or what is left of it: queries share a folder, and later ones find all steps done."""
    folder = job_folder(spark, sf_dir)
    return run_batch(
        spark,
        raw_tables(spark, sf_dir),
        TableSink(f"{folder}/clean"),
        TableSink(f"{folder}/results"),
        notes=Ledger(spark, f"{folder}/steps"),
    )


def forget_job(spark, sf_dir) -> None:
    """Drop all notes, so that the next query runs the whole job."""
    notes = Ledger(spark, f"{job_folder(spark, sf_dir)}/steps")
    for name in notes.names():
        notes.forget(name)


def result(spark, sf_dir, name: str) -> DataFrame:
    return spark.read.parquet(job(spark, sf_dir).results[name])


@query("batch_monthly_engagement", CATALOG["monthly_engagement"].text, JOB_VIEWS)
def batch_monthly_engagement(spark, sf_dir):
    return rounding(result(spark, sf_dir, "monthly_engagement"), "total_watch_time_minutes", "avg_session_duration")


@query("batch_cohort_retention", CATALOG["cohort_retention"].text, JOB_VIEWS)
def batch_cohort_retention(spark, sf_dir):
    return result(spark, sf_dir, "cohort_retention")


@query("batch_content_performance", CATALOG["content_performance"].text, JOB_VIEWS)
def batch_content_performance(spark, sf_dir):
    return rounding(result(spark, sf_dir, "content_performance"), "avg_rating", "total_watch_time_minutes")


@query("batch_genre_performance", CATALOG["genre_performance"].text, JOB_VIEWS)
def batch_genre_performance(spark, sf_dir):
    found = result(spark, sf_dir, "genre_performance")
    return rounding(found, "total_watch_time_minutes", "avg_watch_duration", "avg_rating")


@query("batch_monthly_active_users", CATALOG["monthly_active_users"].text, JOB_VIEWS)
def batch_monthly_active_users(spark, sf_dir):
    return rounding(result(spark, sf_dir, "monthly_active_users"), "total_watch_time_minutes")


def _named(report: DataFrame) -> DataFrame:
    """The sessions under the name that the SQL has for them."""
    name = F.when(F.col("table_name") == "watch_history", "raw_watch").otherwise(F.col("table_name"))
    return report.withColumn("table_name", name)


@query("batch_quality", CATALOG["quality_all_tables"].text)
def batch_quality(spark, sf_dir):
    """The job's quality report."""
    return _named(job(spark, sf_dir).quality).withColumn("row_pct", F.round("row_pct", 4))


@query("batch_summary", CATALOG["cleaning_summary"].text)
def batch_summary(spark, sf_dir):
    """The job's cleaning report."""
    return _named(job(spark, sf_dir).summary)


@query(
    "batch_cleaned_tables",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT COUNT(*) FROM {view}) AS row_count, "
        f"CAST({columns} AS INTEGER) AS column_count"
        for name, view, columns in (
            # The sessions lose their empty column.
            ("Users", "v_users", 7), ("Movies", "v_movies", 6), ("WatchHistory", "v_watch", 8), ("Reviews", "v_reviews", 3),
        )
    ),
    JOB_VIEWS,
)
def batch_cleaned_tables(spark, sf_dir):
    """Rows and columns of the cleaned tables, the sessions among them."""
    paths = job(spark, sf_dir).cleaned.values()
    return table_shapes({path.rsplit("/", 1)[1]: spark.read.parquet(path) for path in paths})
