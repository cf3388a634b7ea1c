"""Missing values: NULL, or NaN in a floating-point column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType


def quoted(name: str) -> Column:
    """A column by its literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (FloatType, DoubleType))


def missing(df: DataFrame, name: str) -> Column:
    """True where ``name`` is NULL or NaN; never NULL itself.

    NaN exists only in float and double; ``isnan`` on other types would cast
    and, under ANSI, throw.
    """
    column = quoted(name)
    return column.isNull() | F.isnan(column) if is_floating(df, name) else column.isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Map NaN in floating columns, and the bare token ``NaN`` in text, to NULL.

    JSON written from floating-point records carries ``NaN`` tokens. A string
    field receives them as the text ``NaN``, quoted or not by source.
    """
    replaced = {}
    for field in df.schema.fields:
        column = quoted(field.name)
        if is_floating(df, field.name):
            replaced[field.name] = F.when(~F.isnan(column), column)
        elif isinstance(field.dataType, StringType):
            replaced[field.name] = F.when(~column.isin("NaN", '"NaN"'), column)
    return df.withColumns(replaced) if replaced else df
