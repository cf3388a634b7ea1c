"""The batch job: profile, clean, join and aggregate the domain tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.functions.eventtime import parsed_time, with_watch_month
from viewtide.functions.missing import quoted
from viewtide.operators import metrics
from viewtide.operators.cleaning import drop_missing
from viewtide.operators.copies import RepeatedRows, profile_schema, repeated_rows
from viewtide.operators.quality import filled_columns, quality_from, summary_from
from viewtide.operators.star import star_join, valid_sessions
from viewtide.schemas import CLEANED_NAMES, CRITICAL_COLUMNS
from viewtide.session import discard
from viewtide.sinks.ledger import Ledger, Steps, combined, fingerprint
from viewtide.sinks.tables import TableSink
from viewtide.sources.tables import union_all

STAR_COLUMNS = (
    "session_id", "user_id", "movie_id", "watch_date", "watch_date_parsed", "watch_year",
    "watch_month", "country", "subscription_plan", "title", "genre_primary",
    "watch_duration_minutes", "progress_percentage", "action", "user_rating",
)


@dataclass(frozen=True)
class BatchRun:
    """Targets written by :func:`run_batch`, and its two reports."""

    quality: DataFrame
    summary: DataFrame
    cleaned: Mapping[str, str] = field(default_factory=dict)
    results: Mapping[str, str] = field(default_factory=dict)


def _profiled(rows: RepeatedRows, critical: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    """The table's profile as a one-row frame, and the columns that are not empty."""
    df = rows.df
    profile = rows.profile(critical or filled_columns(df))
    row = profile.first()
    kept = [c for i, c in enumerate(df.columns) if row[f"present_{i}"] or not row["total_rows"]]
    return df.sparkSession.createDataFrame([row], profile.schema), kept


def _side_by_side(spark: SparkSession, task: Callable, items: Iterable, at_once: int) -> list:
    """Submit independent jobs together, so that small ones fill idle cores."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(inheritable_thread_target(spark)(task), items))


def run_batch(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    cleaned_sink: TableSink,
    result_sink: TableSink,
    critical: Mapping[str, Sequence[str]] = CRITICAL_COLUMNS,
    at_once: int = 4,
    notes: Ledger | None = None,
) -> BatchRun:
    """Clean all tables, write them, and write the five engagement results.

    Copies are found by row hashes, so cleaning shuffles only rows whose hash
    repeats. A raw table is made once and stored; that copy is read for its hashes, for its
    profile, which feeds both reports and names the empty columns, and to be cleaned. The cleaned
    tables and the star are written and read back rather than cached: five
    results scan only the star columns they use, and a lost executor costs a
    file read instead of the whole lineage. The user metrics share one rollup.
    Up to ``at_once`` independent tables or results are in work together.

    With ``notes`` each step leaves a note of what it was made from: the files
    and plan of its tables, or the steps before it. A run after a crash, or
    after some tables have changed, repeats only steps whose note does not fit.

    ``cleaned_sink`` and ``result_sink`` must be file sinks that Spark can read
    back; :func:`export` copies from there to a warehouse.
    """
    steps = Steps(notes)
    made_from: dict[str, str | None] = {}

    def clean_one(name: str) -> tuple[DataFrame, DataFrame, str]:
        df, needed = tables[name], critical.get(name)
        target = cleaned_sink.target(CLEANED_NAMES.get(name, name.capitalize()))
        if notes:
            made_from[name] = combined(fingerprint(df), repr(needed), target)

        def work() -> dict:
            rows = repeated_rows(df)
            profile, filled = _profiled(rows, needed)
            # An empty column has the same value in all rows, so copies are copies without it.
            single = rows.distinct().select(*[quoted(c) for c in filled])
            cleaned_sink.overwrite(drop_missing(single, needed), CLEANED_NAMES.get(name, name.capitalize()))
            discard(spark, rows.path)
            return profile.first().asDict()

        row = steps.run(f"clean {name}", made_from.get(name), target, work)
        label = F.lit(name).alias("table_name")
        profile = spark.createDataFrame([tuple(row.values())], profile_schema(df))
        return (
            quality_from(profile, df.columns).select(label, "*"),
            summary_from(profile, df.columns).select(label, "*"),
            target,
        )

    done = _side_by_side(spark, clean_one, tables, at_once)
    reports, summaries, targets = zip(*done)
    cleaned = dict(zip(tables, targets))

    def write(df_of: Callable[[], DataFrame], name: str, *inputs: str, **how) -> str:
        """One step of the results."""
        target = result_sink.target(name)
        if notes:
            made_from[name] = combined(*(made_from[i] for i in inputs), name, target)

        def work() -> None:
            result_sink.overwrite(df_of(), name, **how)

        steps.run(f"result {name}", made_from.get(name), target, work)
        return target

    def stored(name: str) -> DataFrame:
        return spark.read.format(cleaned_sink.format).load(cleaned[name])

    def star() -> DataFrame:
        dated = with_watch_month(
            star_join(stored("watch_history"), stored("users"), stored("movies"), stored("reviews"))
        )
        # Rebalancing by month gives whole files per month without letting a
        # heavy month end in one task: large partitions are split. The parsed
        # date is made again behind the exchange.
        columns = [c for c in STAR_COLUMNS if c in dated.columns]
        carried = [c for c in columns if c != "watch_date_parsed"]
        by_month = dated.select(*carried).hint("rebalance", *metrics.MONTH)
        return by_month.withColumn("watch_date_parsed", parsed_time(by_month, "watch_date")).select(*columns)

    results = {
        "star": write(
            star, "star", "watch_history", "users", "movies", "reviews", partition_by=metrics.MONTH
        )
    }

    def result(name: str) -> DataFrame:
        return spark.read.format(result_sink.format).load(results[name])

    sessions = valid_sessions(result("star"))
    results["user_months"] = write(lambda: metrics.user_months(sessions), "user_months", "star")
    months = result("user_months")
    aggregates = {
        "monthly_engagement": (metrics.monthly_engagement, sessions, "star"),
        "cohort_retention": (metrics.retention_from, months, "user_months"),
        "content_performance": (metrics.content_performance, sessions, "star"),
        "genre_performance": (metrics.genre_performance, sessions, "star"),
        "monthly_active_users": (metrics.active_users_from, months, "user_months"),
    }

    def write_one(name: str) -> str:
        make, source, step = aggregates[name]
        return write(lambda: make(source), name, step, sort_by=metrics.PRESENTATION_ORDER[name])

    results |= zip(aggregates, _side_by_side(spark, write_one, aggregates, at_once))
    return BatchRun(union_all(reports), union_all(summaries), cleaned, results)


def export(spark: SparkSession, run: BatchRun, files: TableSink, warehouse: TableSink) -> None:
    """Copy all tables of a run from file sinks of ``files.format`` to a warehouse."""
    for name, path in run.cleaned.items():
        warehouse.overwrite(
            spark.read.format(files.format).load(path), CLEANED_NAMES.get(name, name.capitalize())
        )
    for name, path in run.results.items():
        warehouse.overwrite(spark.read.format(files.format).load(path), name)
