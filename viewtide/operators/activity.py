"""Retention and churn from bit sets of active months, kept up month by month.

A user's months are bits of a number: bit ``m % 60`` of block ``m // 60``, with m counting
months. Sixteen bytes and the id stand for five years of sessions. A new month is merged by
a bitwise or with the stored rows; no old session is read again. (Spark's bitmap functions
keep 4 KB a user for the same; a number is enough here.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.functions.eventtime import month_index

#: Five years; the number's sign is no month.
BLOCK = 60


def _month_columns(index: Column, year: str, month: str) -> list[Column]:
    """A month's number back as year and month; months count from 1."""
    return [
        F.floor((index - 1) / 12).cast("int").alias(year),
        (F.pmod(index - 1, F.lit(12)) + 1).cast("int").alias(month),
    ]


def active_months(sessions: DataFrame) -> DataFrame:
    """(user_id, block, bits) from sessions or any rows with a user, a year and a month."""
    index = month_index("watch_year", "watch_month")
    bit = F.expr("shiftleft(1L, cast(__m % 60 AS int))")
    return (
        sessions.select("user_id", index.cast("long").alias("__m"))
        .filter("__m IS NOT NULL")
        .select("user_id", F.floor(F.col("__m") / BLOCK).alias("block"), bit.alias("bits"))
        .groupBy("user_id", "block")
        .agg(F.bit_or("bits").alias("bits"))
    )


def merge_months(stored: DataFrame, added: DataFrame) -> DataFrame:
    """Stored bit sets with those of newly arrived sessions."""
    both = stored.unionByName(added)
    return both.groupBy("user_id", "block").agg(F.bit_or("bits").alias("bits"))


def user_months_from(bits: DataFrame) -> DataFrame:
    """One row per user and active month: the user, and the month's number."""
    place = F.explode(F.sequence(F.lit(0), F.lit(BLOCK - 1)))
    spread = bits.withColumn("__p", place).filter(F.expr("getbit(bits, __p)") == 1)
    return spread.select("user_id", (F.col("block") * BLOCK + F.col("__p")).alias("m"))


def _first_month(bits: DataFrame) -> DataFrame:
    """Each user's first month, from the lowest bit of the first block."""
    # The bits below the lowest one, which are as many as its place.
    place = F.expr("bit_count(~bits & (bits - 1L))")
    return bits.groupBy("user_id").agg(F.min(F.col("block") * BLOCK + place).alias("first"))


def retention(bits: DataFrame) -> DataFrame:
    """Users of each first month active in each later month, as of :func:`metrics.cohort_retention`."""
    months = user_months_from(bits).join(_first_month(bits), "user_id")
    counted = months.groupBy("first", "m").agg(F.count(F.lit(1)).alias("active_users"))
    return counted.select(
        *_month_columns(F.col("first"), "cohort_year", "cohort_month"),
        *_month_columns(F.col("m"), "watch_year", "watch_month"),
        "active_users",
        (F.col("m") - F.col("first")).cast("int").alias("months_since_cohort"),
    )


def monthly_users(bits: DataFrame) -> DataFrame:
    """Active users per month."""
    counted = user_months_from(bits).groupBy("m").agg(F.count(F.lit(1)).alias("monthly_active_users"))
    return counted.select(*_month_columns(F.col("m"), "watch_year", "watch_month"), "monthly_active_users")


def churn(bits: DataFrame) -> DataFrame:
    """Users active in a month and absent in the next; the last month is open.

    A block's lost months are its bits without those of the month after, whose first comes
    from the block that follows.
    """
    order = Window.partitionBy("user_id").orderBy("block")
    following = F.when(F.lead("block").over(order) == F.col("block") + 1, F.lead("bits").over(order))
    carried = F.coalesce(following, F.lit(0).cast("long")).bitwiseAND(1)
    shifted = F.shiftrightunsigned("bits", 1).bitwiseOR(F.shiftleft(carried, BLOCK - 1))
    lost = bits.withColumn("lost", F.col("bits").bitwiseAND(F.bitwise_not(shifted)))
    place = F.explode(F.sequence(F.lit(0), F.lit(BLOCK - 1)))
    spread = lost.withColumn("__p", place).filter(F.expr("getbit(bits, __p)") == 1)
    months = spread.select(
        (F.col("block") * BLOCK + F.col("__p")).alias("m"), F.expr("getbit(lost, __p)").alias("gone")
    )
    per_month = months.groupBy("m").agg(
        F.count(F.lit(1)).alias("active_users"), F.sum("gone").cast("long").alias("churned_users")
    )
    # One row per month is left, so the unpartitioned window is as small.
    last = F.max("m").over(Window.partitionBy())
    return (
        per_month.withColumn("last", last)
        .filter("m < last")
        .select(
            *_month_columns(F.col("m"), "watch_year", "watch_month"),
            "active_users",
            "churned_users",
            (F.col("churned_users") / F.col("active_users")).alias("churn_rate"),
        )
    )
