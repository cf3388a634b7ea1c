"""Attributes as of a time: the last change before each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows and changes meet by key and by this unit of time.
PERIOD = "month"


def as_of_join(
    rows: DataFrame,
    changes: DataFrame,
    key: str,
    time: str,
    columns: Sequence[str],
    changed: str = "changed_at",
    ties: Sequence[str] = (),
    period: str = PERIOD,
) -> DataFrame:
    """``rows`` with each of ``columns`` as the last change of their key had it by their time.

    Rows and changes go into one table, sorted by time within a key and period, and the last
    change is carried forward; no pairs are compared. What holds at the start of a period comes
    from one row per key and period, so a key with many rows is spread over its periods.

    A change at the very time of a row counts. Of changes at one time the last by ``ties``, or
    else by their values, holds. A change sets all columns, to NULL as well. Rows before any
    change, without a key or without a time get NULLs; ``as_of`` is the time of the change.
    """
    value = F.struct(F.col(changed).alias("as_of"), *[F.col(c) for c in columns])
    order = F.struct(*[F.col(c) for c in (ties or columns)])
    state = changes.filter(F.col(key).isNotNull() & F.col(changed).isNotNull()).select(
        F.col(key).alias("__key"), F.col(changed).alias("__time"), F.date_trunc(period, changed).alias("__period"),
        value.alias("__value"), order.alias("__order"),
    )
    value_type, order_type = (state.schema[name].dataType for name in ("__value", "__order"))
    own = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    asked = rows.select(
        F.col(key).alias("__key"), F.col(time).alias("__time"), F.date_trunc(period, time).alias("__period"),
        own.alias("__row"),
    )
    row_type = asked.schema["__row"].dataType
    # Rows without a key or a time find nothing, and need not meet in one place.
    findable = F.col("__key").isNotNull() & F.col("__time").isNotNull()
    searched = asked.filter(findable)

    last = state.groupBy("__key", "__period").agg(F.max_by("__value", F.struct("__time", "__order")).alias("__value"))
    needed = searched.select("__key", "__period").distinct().withColumn("__value", F.lit(None).cast(value_type))
    # A period's own changes come after what it begins with.
    periods = last.withColumn("__own", F.lit(True)).unionByName(needed.withColumn("__own", F.lit(False)))
    carried = Window.partitionBy("__key").orderBy("__period", "__own").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    began = periods.withColumn("__value", F.last("__value", ignorenulls=True).over(carried)).filter("NOT __own")

    both = (
        state.withColumns({"__row": F.lit(None).cast(row_type), "__rank": F.lit(1)})
        .unionByName(
            searched.withColumns(
                {"__value": F.lit(None).cast(value_type), "__order": F.lit(None).cast(order_type), "__rank": F.lit(2)}
            )
        )
        .unionByName(
            began.drop("__own").withColumns(
                {
                    "__time": F.lit(None).cast(state.schema["__time"].dataType),
                    "__order": F.lit(None).cast(order_type),
                    "__row": F.lit(None).cast(row_type),
                    "__rank": F.lit(0),
                }
            )
        )
    )
    before = (
        Window.partitionBy("__key", "__period")
        # First what the period begins with, then by time; at one time changes come before rows.
        .orderBy(F.asc_nulls_first("__time"), "__rank", "__order")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = both.withColumn("__found", F.last("__value", ignorenulls=True).over(before)).filter("__rank = 2")
    rest = asked.filter(~F.coalesce(findable, F.lit(False))).withColumn("__found", F.lit(None).cast(value_type))
    shown = [F.col(f"__found.{c}").alias(c) for c in ("as_of", *columns)]
    return found.select("__row.*", *shown).unionByName(rest.select("__row.*", *shown))
