"""Data-quality reports, each computed in one pass over its table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.functions.missing import missing, quoted
from viewtide.sources.tables import union_all


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * 100.0, whole.cast("double")), F.lit(0.0))


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values: count and percentage of rows.

    All columns are counted by a single aggregate, which needs no shuffle
    beyond one partial row per task. Complete columns are left out.
    """
    totals = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"m{i}").alias("missing_count"),
            _percent(F.col(f"m{i}"), F.col("total_rows")).alias("missing_pct"),
        )
        for i, c in enumerate(df.columns)
    ]
    return totals.select(F.inline(F.array(*rows))).filter("missing_count > 0")


def copies_of(df: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies, combined before the shuffle."""
    return df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__copies"))


def usable(df: DataFrame, columns: Sequence[str]) -> Column:
    """True where none of ``columns`` is missing."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"critical columns absent or empty: {', '.join(absent)}")
    return ~reduce(lambda a, b: a | b, [missing(df, c) for c in columns], F.lit(False))


def table_profile(df: DataFrame, critical: Sequence[str] = ()) -> DataFrame:
    """Everything the quality and cleaning reports need, as one row from one scan.

    Copies are counted first; a missing value then weighs as many rows as its
    distinct row has copies. Per column i: ``missing_i`` rows, and whether any
    row has a non-NULL value (``present_i``). Unused columns are pruned.
    """
    copies = F.col("__copies")
    return copies_of(df).agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).alias("duplicate_rows"),
        F.count_if(usable(df, critical)).alias("rows_after"),
        *[
            F.coalesce(F.sum(F.when(missing(df, c), copies)), F.lit(0)).alias(f"missing_{i}")
            for i, c in enumerate(df.columns)
        ],
        *[
            F.coalesce(F.max(quoted(c).isNotNull()), F.lit(False)).alias(f"present_{i}")
            for i, c in enumerate(df.columns)
        ],
    )


def duplicate_report(df: DataFrame) -> DataFrame:
    """Total rows, rows that repeat an earlier one, and their percentage."""
    return table_profile(df).select(
        "total_rows",
        "duplicate_rows",
        _percent(F.col("duplicate_rows"), F.col("total_rows")).alias("duplicate_pct"),
    )


def quality_from(profile: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Tidy rows of a profile: one per incomplete column, one for duplicates."""
    checks = [("missing", c, f"missing_{i}") for i, c in enumerate(columns)]
    rows = [
        F.struct(
            F.lit(check).alias("check_name"),
            F.lit(column).alias("column_name"),
            F.col("total_rows"),
            F.col(source).alias("row_count"),
            _percent(F.col(source), F.col("total_rows")).alias("row_pct"),
        )
        for check, column, source in [*checks, ("duplicate", "*", "duplicate_rows")]
    ]
    return profile.select(F.inline(F.array(*rows))).filter(
        "check_name = 'duplicate' OR row_count > 0"
    )


def quality_report(df: DataFrame) -> DataFrame:
    """Missing values per column and duplicate rows of one table."""
    return quality_from(table_profile(df), df.columns)


def quality_of_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        quality_report(df).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    )


def null_total(df: DataFrame) -> DataFrame:
    """Missing cells of the whole table and rows that repeat an earlier one."""
    cells = sum((F.col(f"missing_{i}") for i in range(len(df.columns))), F.lit(0))
    return table_profile(df).select(cells.alias("missing_cells"), "duplicate_rows")


def summary_from(profile: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and columns before and after cleaning, from a profile.

    Dropping empty columns cannot merge rows, so the cleaned row count is the
    number of distinct rows whose critical columns are present.
    """
    width = len(columns)
    present = sum((F.col(f"present_{i}").cast("int") for i in range(width)), F.lit(0))
    # A table without rows keeps its columns.
    kept = F.when(F.col("total_rows") == 0, F.lit(width)).otherwise(present)
    return profile.select(
        F.col("total_rows").alias("rows_before"),
        "rows_after",
        (F.col("total_rows") - F.col("rows_after")).alias("rows_removed"),
        F.lit(width).alias("columns_before"),
        kept.alias("columns_after"),
        (F.lit(width) - kept).alias("columns_removed"),
    )


def filled_columns(df: DataFrame) -> list[str]:
    """Columns with any non-NULL value, by one aggregate over all of them.

    A table without rows keeps its columns: nothing is known about them.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    ).first()
    return [c for i, c in enumerate(df.columns) if counts[f"n{i}"] or not counts["total"]]


def cleaning_summary(df: DataFrame, critical: Sequence[str] | None = None) -> DataFrame:
    """What :func:`~viewtide.operators.cleaning.clean` removes, from one scan.

    Without critical columns another scan finds the ones that must be complete.
    """
    return summary_from(table_profile(df, critical or filled_columns(df)), df.columns)


def cleaning_summaries(
    tables: Mapping[str, DataFrame], critical: Mapping[str, Sequence[str]]
) -> DataFrame:
    return union_all(
        cleaning_summary(df, critical.get(name)).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    )
