"""Catalogue entries: what is kept instead of raw rows, and rows that a reader rejects."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewtide.operators import activity, copies, quality, toplists
from viewtide.plans import domain
from viewtide.plans.catalog import CATALOG, query
from viewtide.plans import queries_batch, queries_events, queries_quality  # noqa: F401  (their SQL is used below)
from viewtide.plans.queries_batch import rounding, sessions
from viewtide.plans.queries_quality import _CRITICAL, _show_nan
from viewtide.schemas import fields
from viewtide.session import materialise, scratch_path
from viewtide.sources.tables import csv_with_rejects

# -- copies of wide rows ------------------------------------------------------------------


@query("wide_duplicate_report", CATALOG["duplicate_report"].text)
def wide_duplicate_report(spark, sf_dir):
    """Copies counted by row hashes, and settled among rows whose hash repeats."""
    profile = copies.repeated_rows(domain.raw_watch(spark, sf_dir)).profile()
    share = F.round(F.col("duplicate_rows") * 100.0 / F.col("total_rows"), 4)
    return profile.select("total_rows", "duplicate_rows", share.alias("duplicate_pct"))


@query("wide_clean_table", CATALOG["clean_table"].text)
def wide_clean_table(spark, sf_dir):
    """Distinct rows, of which only those with the bit of a repeated hash are shuffled whole."""
    rows = copies.repeated_rows(domain.raw_watch(spark, sf_dir))
    filled = quality.filled_columns(rows.df)
    single = rows.distinct().select(*filled)
    return _show_nan(single.filter(quality.usable(single, _CRITICAL)))


@query("wide_null_total", CATALOG["null_total"].text)
def wide_null_total(spark, sf_dir):
    df = domain.raw_watch(spark, sf_dir)
    profile = copies.repeated_rows(df).profile()
    cells = sum((F.col(f"missing_{i}") for i in range(len(df.columns))), F.lit(0))
    return profile.select(cells.alias("missing_cells"), "duplicate_rows")


# -- bit sets of active months ---------------------------------------------------------------

#: Sessions up to this year are stored first; then each year is merged in.
FIRST_YEAR, LAST_YEAR = 1996, 2001


def kept_months(spark, sf_dir):
    """Bit sets of the first years, and the later years merged one by one, each read once."""
    rows = sessions(spark, sf_dir).select("user_id", "watch_year", "watch_month")
    rows = materialise(rows, "months")
    kept = materialise(activity.active_months(rows.filter(F.col("watch_year") <= FIRST_YEAR)), "bits")
    for year in range(FIRST_YEAR + 1, LAST_YEAR):
        added = activity.active_months(rows.filter(F.col("watch_year") == year))
        kept = materialise(activity.merge_months(kept, added), "bits")
    return activity.merge_months(kept, activity.active_months(rows.filter(F.col("watch_year") >= LAST_YEAR)))


@query("bitmap_retention", CATALOG["cohort_retention"].text)
def bitmap_retention(spark, sf_dir):
    return activity.retention(materialise(kept_months(spark, sf_dir), "bits"))


@query("bitmap_churn", CATALOG["monthly_churn"].text)
def bitmap_churn(spark, sf_dir):
    return rounding(activity.churn(kept_months(spark, sf_dir)), "churn_rate", scale=6)


@query(
    "bitmap_active_users",
    """SELECT watch_year, watch_month, COUNT(DISTINCT user_id) AS monthly_active_users
       FROM v_sessions GROUP BY watch_year, watch_month""",
)
def bitmap_active_users(spark, sf_dir):
    return activity.monthly_users(kept_months(spark, sf_dir))


# -- proven top lists ----------------------------------------------------------------------

_TOP = """SELECT {item}, COUNT(*) AS views FROM v_events WHERE {item} IS NOT NULL
          GROUP BY {item} ORDER BY views DESC, {item} LIMIT 10"""


def _top(spark, sf_dir, item: str, tracked: int):
    events = domain.events(spark, sf_dir)
    windows = materialise(toplists.item_windows(events, item, "1 day", tracked=tracked), "top")
    return toplists.top_items(events, windows, item, 10, tracked)[0]


@query("sketched_top_items", _TOP.format(item="movie_id"))
def sketched_top_items(spark, sf_dir):
    """From daily sketches that hold every item: proven without counting the others."""
    return _top(spark, sf_dir, "movie_id", toplists.TRACKED)


@query("sketched_top_users", _TOP.format(item="user_id"))
def sketched_top_users(spark, sf_dir):
    """From sketches too small for even counts: where they prove nothing, all are counted."""
    return _top(spark, sf_dir, "user_id", 128)


# -- lines that a reader rejects ---------------------------------------------------------------

_LINE = """CAST(session_id AS VARCHAR) || ',' || CASE WHEN session_id % 50 = 2 THEN 'x' ELSE CAST(session_seq AS VARCHAR) END
           || ',' || CAST(movie_id AS VARCHAR) || CASE WHEN session_id % 50 = 3 THEN '' ELSE ',' || action END
           || CASE WHEN session_id % 50 = 1 THEN ',more' ELSE '' END"""
_BROKEN = "session_id % 50 IN (1, 2, 3)"
LINE_SCHEMA = fields(session_id="long", session_seq="integer", movie_id="long", action="string")


def _lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    text = F.expr(_LINE.replace("VARCHAR", "STRING")).alias("value")
    domain.watch(spark, sf_dir).select(text).write.text(path)
    return csv_with_rejects(spark, path, LINE_SCHEMA, header=False)


@query(
    "csv_good_lines",
    f"""SELECT session_id, CAST(session_seq AS INTEGER) AS session_seq, movie_id, action
        FROM v_watch WHERE NOT {_BROKEN}""",
)
def csv_good_lines(spark, sf_dir):
    """Lines that fit the schema; every 50th session's lines are broken in three ways."""
    return _lines(spark, sf_dir)[0]


@query("csv_rejected_lines", f"SELECT {_LINE} AS line FROM v_watch WHERE {_BROKEN}")
def csv_rejected_lines(spark, sf_dir):
    return _lines(spark, sf_dir)[1].select("line")
