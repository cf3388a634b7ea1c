"""Catalogue entries: quality reports, cleaning and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.operators import cleaning, distribution, quality
from viewtide.plans import domain
from viewtide.plans.catalog import query
from viewtide.plans.oracle import rounded

_CRITICAL = ["session_id", "user_id", "movie_id"]
_TABLES = {
    "users": ["user_id", "country", "subscription_plan", "region", "monthly_spend", "age", "email"],
    "movies": ["movie_id", "title", "genre_primary", "content_type", "imdb_rating", "is_original"],
    "reviews": ["user_id", "movie_id", "rating"],
    "raw_watch": [
        "user_id", "movie_id", "session_id", "session_seq", "watch_date",
        "watch_duration_minutes", "action", "quality", "unused",
    ],
}
_CRITICAL_OF = {
    "users": ["user_id", "email"],
    "movies": ["movie_id", "title"],
    "reviews": ["user_id", "movie_id"],
    "raw_watch": _CRITICAL,
}
_DOUBLES = {"monthly_spend", "age", "imdb_rating", "rating", "watch_duration_minutes", "unused"}


def _tables(spark, sf_dir) -> dict[str, DataFrame]:
    return {name: getattr(domain, name)(spark, sf_dir) for name in _TABLES}


def _lacks(column: str) -> str:
    return f"{column} IS NULL" + (f" OR isnan({column})" if column in _DOUBLES else "")


def _missing_sql(table: str, column: str, head: str) -> str:
    count = f"COUNT(*) FILTER (WHERE {_lacks(column)})"
    return (
        f"SELECT {head}, {count} AS missing_count, {rounded(f'{count} * 100.0 / COUNT(*)')} "
        f"AS missing_pct FROM v_{table} HAVING {count} > 0"
    )


_REPEATS = "COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM v_{0}))"
_SHOWN = "CASE WHEN isnan(watch_duration_minutes) THEN -1 ELSE watch_duration_minutes END"
_RAW = "user_id, movie_id, session_id, session_seq, watch_date, action, quality"


def _show_nan(df: DataFrame) -> DataFrame:
    """NaN as -1, so that engines agree on how it compares."""
    column = F.col("watch_duration_minutes")
    return df.withColumn("watch_duration_minutes", F.when(F.isnan(column), -1.0).otherwise(column))


@query(
    "missing_report",
    " UNION ALL ".join(
        _missing_sql("raw_watch", c, f"'{c}' AS column_name") for c in _TABLES["raw_watch"]
    ),
)
def missing_report(spark, sf_dir):
    report = quality.missing_report(domain.raw_watch(spark, sf_dir))
    return report.withColumn("missing_pct", F.round("missing_pct", 4))


@query(
    "duplicate_report",
    f"""SELECT COUNT(*) AS total_rows, {_REPEATS.format('raw_watch')} AS duplicate_rows,
               {rounded('(' + _REPEATS.format('raw_watch') + ') * 100.0 / COUNT(*)')} AS duplicate_pct
        FROM v_raw_watch""",
)
def duplicate_report(spark, sf_dir):
    report = quality.duplicate_report(domain.raw_watch(spark, sf_dir))
    return report.withColumn("duplicate_pct", F.round("duplicate_pct", 4))


def _quality_sql(table: str) -> str:
    missing = [
        f"SELECT '{table}' AS table_name, 'missing' AS check_name, '{c}' AS column_name, "
        f"COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE {_lacks(c)}) AS row_count FROM v_{table} "
        f"HAVING COUNT(*) FILTER (WHERE {_lacks(c)}) > 0"
        for c in _TABLES[table]
    ]
    repeats = (
        f"SELECT '{table}', 'duplicate', '*', COUNT(*), {_REPEATS.format(table)} FROM v_{table}"
    )
    return " UNION ALL ".join([*missing, repeats])


@query(
    "quality_all_tables",
    f"""SELECT *, {rounded('row_count * 100.0 / total_rows')} AS row_pct
        FROM ({' UNION ALL '.join(_quality_sql(t) for t in _TABLES)}) q""",
)
def quality_all_tables(spark, sf_dir):
    report = quality.quality_of_tables(_tables(spark, sf_dir))
    return report.withColumn("row_pct", F.round("row_pct", 4))


@query(
    "null_total",
    f"""SELECT CAST(SUM({' + '.join(
            f'CASE WHEN {_lacks(c)} THEN 1 ELSE 0 END' for c in _TABLES['raw_watch']
        )}) AS BIGINT) AS missing_cells, {_REPEATS.format('raw_watch')} AS duplicate_rows
        FROM v_raw_watch""",
)
def null_total(spark, sf_dir):
    return quality.null_total(domain.raw_watch(spark, sf_dir))


@query("drop_empty_columns", f"SELECT {_RAW}, {_SHOWN} AS watch_duration_minutes FROM v_raw_watch")
def drop_empty_columns(spark, sf_dir):
    return _show_nan(cleaning.drop_empty_columns(domain.raw_watch(spark, sf_dir)))


@query(
    "clean_critical",
    f"""SELECT {_RAW}, watch_duration_minutes, unused FROM v_raw_watch
        WHERE user_id IS NOT NULL AND movie_id IS NOT NULL AND session_id IS NOT NULL
          AND watch_duration_minutes IS NOT NULL AND NOT isnan(watch_duration_minutes)""",
)
def clean_critical(spark, sf_dir):
    return cleaning.drop_missing(
        domain.raw_watch(spark, sf_dir), [*_CRITICAL, "watch_duration_minutes"]
    )


@query(
    "clean_dropna",
    f"""SELECT {_RAW}, watch_duration_minutes FROM v_raw_watch
        WHERE user_id IS NOT NULL AND watch_duration_minutes IS NOT NULL
          AND NOT isnan(watch_duration_minutes)""",
)
def clean_dropna(spark, sf_dir):
    return cleaning.drop_missing(cleaning.drop_empty_columns(domain.raw_watch(spark, sf_dir)))


@query(
    "dedupe_rows",
    f"SELECT DISTINCT {_RAW}, {_SHOWN} AS watch_duration_minutes, unused FROM v_raw_watch",
)
def dedupe_rows(spark, sf_dir):
    return _show_nan(cleaning.dedupe_rows(domain.raw_watch(spark, sf_dir)))


@query(
    "clean_table",
    f"""SELECT DISTINCT {_RAW}, {_SHOWN} AS watch_duration_minutes FROM v_raw_watch
        WHERE user_id IS NOT NULL AND movie_id IS NOT NULL AND session_id IS NOT NULL""",
)
def clean_table(spark, sf_dir):
    return _show_nan(cleaning.clean(domain.raw_watch(spark, sf_dir), _CRITICAL))


def _summary_sql(table: str) -> str:
    critical = " AND ".join(f"NOT ({_lacks(c)})" for c in _CRITICAL_OF[table])
    width = len(_TABLES[table])
    kept = " + ".join(f"CASE WHEN COUNT({c}) > 0 THEN 1 ELSE 0 END" for c in _TABLES[table])
    after = f"(SELECT COUNT(*) FROM (SELECT DISTINCT * FROM v_{table} WHERE {critical}))"
    return f"""SELECT '{table}' AS table_name, COUNT(*) AS rows_before, {after} AS rows_after,
        COUNT(*) - {after} AS rows_removed, CAST({width} AS INTEGER) AS columns_before,
        CAST({kept} AS INTEGER) AS columns_after, CAST({width} - ({kept}) AS INTEGER) AS columns_removed
        FROM v_{table}"""


@query("cleaning_summary", " UNION ALL ".join(_summary_sql(t) for t in _TABLES))
def cleaning_summary(spark, sf_dir):
    return quality.cleaning_summaries(_tables(spark, sf_dir), _CRITICAL_OF)


@query(
    "impute_constant",
    """SELECT user_id, country, COALESCE(email, 'Unknown') AS email,
              COALESCE(monthly_spend, 0) AS monthly_spend, COALESCE(age, 0) AS age FROM v_users""",
)
def impute_constant(spark, sf_dir):
    users = domain.users(spark, sf_dir).select("user_id", "country", "email", "monthly_spend", "age")
    return cleaning.impute_constant(users, {"email": "Unknown", "monthly_spend": 0, "age": 0})


@query(
    "impute_median",
    f"""SELECT user_id, {rounded('COALESCE(monthly_spend, (SELECT quantile_cont(monthly_spend, 0.5) '
                                 'FROM v_users))')} AS monthly_spend,
               {rounded('COALESCE(age, (SELECT quantile_cont(age, 0.5) FROM v_users))')} AS age
        FROM v_users""",
)
def impute_median(spark, sf_dir):
    users = domain.users(spark, sf_dir).select("user_id", "monthly_spend", "age")
    filled = cleaning.impute_median(users, ["monthly_spend", "age"])
    return filled.select(
        "user_id", *[F.round(F.round(c, 10), 4).alias(c) for c in ("monthly_spend", "age")]
    )


@query(
    "dedupe_by_key",
    """SELECT session_id, session_seq, movie_id, watch_date FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY session_id
                                      ORDER BY session_seq, movie_id, watch_date) AS n
         FROM v_raw_watch) r WHERE n = 1""",
)
def dedupe_by_key(spark, sf_dir):
    columns = ["session_id", "session_seq", "movie_id", "watch_date"]
    rows = domain.raw_watch(spark, sf_dir).select(*columns)
    return cleaning.dedupe_by_key(rows, columns[:1], columns[1:])


@query(
    "iqr_filter",
    """WITH q AS (SELECT quantile_cont(age, 0.25) AS q1, quantile_cont(age, 0.75) AS q3 FROM v_users)
       SELECT u.user_id, u.country, u.age FROM v_users u, q
       WHERE u.age >= q1 - 1.5 * (q3 - q1) AND u.age <= q3 + 1.5 * (q3 - q1)""",
)
def iqr_filter(spark, sf_dir):
    users = domain.users(spark, sf_dir).select("user_id", "country", "age")
    return cleaning.iqr_filter(users, "age")


@query(
    "value_counts",
    """SELECT subscription_plan AS value, COUNT(*) AS row_count FROM v_users
       WHERE subscription_plan IS NOT NULL GROUP BY subscription_plan""",
)
def value_counts(spark, sf_dir):
    return distribution.value_counts(domain.users(spark, sf_dir), "subscription_plan")


@query(
    "histogram",
    f"""WITH l AS (SELECT MIN(monthly_spend) AS lo, MAX(monthly_spend) AS hi FROM v_users),
             b AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 31)),
             c AS (SELECT CAST(LEAST(FLOOR((monthly_spend - lo) / (hi - lo) * 30), 29) AS INTEGER) + 1
                     AS bin, COUNT(*) AS n FROM v_users, l WHERE monthly_spend IS NOT NULL GROUP BY 1)
        SELECT b.bin, {rounded('lo + (b.bin - 1) * ((hi - lo) / 30)')} AS bin_start,
               {rounded('lo + b.bin * ((hi - lo) / 30)')} AS bin_end, COALESCE(n, 0) AS row_count
        FROM b CROSS JOIN l LEFT JOIN c ON b.bin = c.bin""",
)
def histogram(spark, sf_dir):
    bins = distribution.histogram(domain.users(spark, sf_dir), "monthly_spend", 30)
    return bins.withColumns({c: F.round(F.round(c, 10), 4) for c in ("bin_start", "bin_end")})


@query(
    "exact_quantiles",
    f"""SELECT {', '.join(
            f"{rounded(f'quantile_cont(watch_duration_minutes, {p})')} AS p{int(p * 100)}"
            for p in (0.05, 0.25, 0.5, 0.75, 0.95)
        )}, {rounded('MAX(watch_duration_minutes)')} AS largest FROM v_events""",
)
def exact_quantiles(spark, sf_dir):
    points = (0.05, 0.25, 0.5, 0.75, 0.95)
    events = domain.events(spark, sf_dir)
    values = distribution.exact_quantiles(events, "watch_duration_minutes", points)
    # The quantiles are literals; the maximum is read along with them.
    return events.agg(F.round(F.max("watch_duration_minutes"), 4).alias("largest")).select(
        *[F.round(F.round(F.lit(v), 10), 4).alias(f"p{int(p * 100)}") for p, v in zip(points, values)],
        "largest",
    )
