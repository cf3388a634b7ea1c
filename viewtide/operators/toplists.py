"""Proven top lists from sketches that are kept with the windows.

Each stored window carries a frequent-items sketch of bounded size instead of a count for
every item. Sketches are merged for any span of windows; their leading items are counted
again exactly. The merged sketch also bounds the count of every item it does not name, so
the list is either proven complete, or counted in full.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.operators.windowed import WINDOW_DURATION, windowed

#: Items that a sketch tracks, and how many candidates are counted for each place of a list.
TRACKED, CANDIDATES = 1024, 8


def item_windows(
    events: DataFrame,
    item: str,
    duration: str = WINDOW_DURATION,
    keys: Sequence[str] = (),
    tracked: int = TRACKED,
) -> DataFrame:
    """Rows and a sketch of their items per window and keys; missing items are left out."""
    measures = [
        F.count(item).alias("rows"),
        F.expr(f"approx_top_k_accumulate(`{item}`, {tracked})").alias("items_sketch"),
    ]
    return windowed(events.filter(F.col(item).isNotNull()), duration, keys, measures)


def leading_items(windows: DataFrame, most: int, tracked: int = TRACKED) -> tuple[list, int]:
    """The items that lead all of ``windows``, and a bound on the count of any other.

    An item's estimate is not below its count. Items beyond the ones returned have at most
    the last one's estimate, and items that the sketch has dropped at most its error, which
    is 3.5 rows in ``tracked``.
    """
    if windows.isEmpty():
        return [], 0
    merged = windows.agg(F.expr(f"approx_top_k_combine(items_sketch, {tracked})").alias("s"), F.sum("rows").alias("rows"))
    row = merged.select(F.expr(f"approx_top_k_estimate(s, {most})").alias("top"), "rows").first()
    # As many as asked for, whatever the number of windows.
    top = [(entry["item"], entry["count"]) for entry in row["top"] or ()]
    dropped = int(3.5 * (row["rows"] or 0) / tracked) + 1 if len(top) >= most or (row["rows"] or 0) >= tracked else 0
    return [item for item, _ in top], max(dropped, top[-1][1] if len(top) >= most else 0)


def counts_of(events: DataFrame, item: str) -> DataFrame:
    return events.filter(F.col(item).isNotNull()).groupBy(item).agg(F.count(F.lit(1)).alias("views"))


def top_items(events: DataFrame, windows: DataFrame, item: str, n: int, tracked: int = TRACKED) -> tuple[DataFrame, bool]:
    """The ``n`` most frequent items, ties by the item, and whether the sketches proved them.

    ``windows`` are the stored sketches of ``events``. Only candidates are counted; if one
    that is not a candidate might belong to the list, all items are.
    """
    candidates, bound = leading_items(windows, n * CANDIDATES, tracked)
    best = [F.desc("views"), item]
    if candidates:
        # The list is bounded by what was asked for.
        found = counts_of(events.filter(F.col(item).isin(candidates)), item).orderBy(*best).limit(n)
        rows = found.collect()
        if (len(rows) == n and rows[-1]["views"] > bound) or bound == 0:
            spark = events.sparkSession
            return spark.createDataFrame([tuple(r) for r in rows], found.schema), True
    return counts_of(events, item).orderBy(*best).limit(n), False
