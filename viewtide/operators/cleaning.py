"""Cleaning: empty columns, missing rows, copies, imputation, outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtide.functions.missing import missing, quoted
from viewtide.operators.distribution import column_quantiles, exact_quantiles
from viewtide.operators.quality import filled_columns, usable


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any non-NULL value."""
    return df.select(*[quoted(c) for c in filled_columns(df)])


def drop_missing(df: DataFrame, critical: Sequence[str] | None = None) -> DataFrame:
    """Drop rows missing any critical column, or any column if none are named."""
    columns = list(critical) if critical else df.columns
    return df.filter(usable(df, columns)) if columns else df


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Full-row dedupe; copies are combined before the shuffle.

    Rows that share an id but differ elsewhere all stay: see
    :func:`dedupe_by_key` for those.
    """
    return df.dropDuplicates()


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """The first row of each key in the given order; NULL keys form one group.

    ``order_by`` must be total within a key for a repeatable choice. The rank
    filter is applied map-side too, so a hot key ships one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def clean(df: DataFrame, critical: Sequence[str] | None = None) -> DataFrame:
    """Drop empty columns, then rows with missing values, then copies.

    A critical column that is entirely empty is an error here, since the table
    could not be joined afterwards. Without critical columns, a row must be
    complete in the columns that are left.
    """
    return clean_rows(drop_empty_columns(df), critical)


def clean_rows(df: DataFrame, critical: Sequence[str] | None = None) -> DataFrame:
    """:func:`clean` for a table whose empty columns are already gone; lazy."""
    return dedupe_rows(drop_missing(df, critical))


def impute_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill missing values of each named column with its literal."""
    if not values:
        return df
    return df.withColumns(
        {
            name: F.when(missing(df, name), F.lit(value).cast(df.schema[name].dataType))
            .otherwise(quoted(name))
            for name, value in values.items()
        }
    )


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill missing values with the column's exact median; the result is double."""
    medians = column_quantiles(df, {name: [0.5] for name in columns})
    doubles = df.withColumns({name: quoted(name).cast("double") for name in columns})
    return impute_constant(doubles, {c: m for c, (m,) in medians.items() if m is not None})


def iqr_filter(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Keep rows within ``factor`` interquartile ranges of the quartiles.

    Both limits are inclusive; missing values do not pass. The limits are
    literals in the returned plan, so the filter reaches the scan.
    """
    first, third = exact_quantiles(df, column, [0.25, 0.75])
    if first is None:
        return df.limit(0)
    reach = factor * (third - first)
    return df.filter(
        ~missing(df, column) & quoted(column).between(first - reach, third + reach)
    )
