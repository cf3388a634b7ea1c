"""Event time: parsing, calendar parts, assembly from a date and offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

#: Fixed value: the text format of event times.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parsed_time(df: DataFrame, name: str, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """``name`` as a timestamp; text that does not match ``fmt`` becomes NULL.

    A throwing parse would end a stream on one bad message; NULL rows can be
    filtered or quarantined instead. Dates are widened, timestamps pass through.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, StringType):
        return F.try_to_timestamp(F.col(name), F.lit(fmt))
    return F.col(name).cast("timestamp") if isinstance(kind, DateType) else F.col(name)


def with_event_time(df: DataFrame, name: str = "timestamp", into: str = "event_time") -> DataFrame:
    return df.withColumn(into, parsed_time(df, name))


def with_watch_month(df: DataFrame, name: str = "watch_date") -> DataFrame:
    """Add ``watch_date_parsed``, ``watch_year`` and ``watch_month``."""
    parsed = parsed_time(df, name)
    return df.withColumns(
        {"watch_date_parsed": parsed, "watch_year": F.year(parsed), "watch_month": F.month(parsed)}
    )


def month_index(year: str, month: str) -> Column:
    """Months since year 0, so that differences cross year ends."""
    return F.col(year) * 12 + F.col(month)


def assembled_time(date: str, hour: str, minute: str, second: str) -> Column:
    """A timestamp from a date column and integer offset columns."""
    seconds = F.col(hour) * 3600 + F.col(minute) * 60 + F.col(second)
    return F.timestamp_add("SECOND", seconds, F.col(date))
