"""Joining batches in which a few keys hold much of the rows.

Adaptive execution splits skewed join partitions of batch queries, but not those of a
micro-batch with state, and not where a grouping follows by the same key. Here each batch is
sketched first. Rows of its heavy keys are dealt over pieces, and only those keys' dimension
rows are copied to all pieces.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The share of a batch from which a key is heavy, keys that the sketch tracks, and pieces
#: in which a partition's worth of rows is dealt.
SHARE, TRACKED, PIECES = 0.005, 10_000, 16


def heavy_keys(batch: DataFrame, key: str, share: float = SHARE, tracked: int = TRACKED) -> dict:
    """Keys with at least ``share`` of the rows, and about how many they have.

    One pass with a frequent-items sketch: every such key is found if the sketch tracks enough,
    and there are at most ``1 / share`` of them. Counts may be a little too large. Missing
    keys are none.
    """
    most = math.ceil(1 / share)
    sketch = F.expr(f"approx_top_k(`{key}`, {most}, {max(tracked, most)})")
    row = batch.agg(F.count(F.lit(1)).alias("n"), sketch.alias("top")).first()
    least = max(2, share * row["n"])
    return {top["item"]: top["count"] for top in row["top"] or () if top["item"] is not None and top["count"] >= least}


def pieces_of(heavy: Mapping, rows: int, partitions: int, pieces: int = PIECES) -> dict:
    """How many pieces each heavy key is dealt in: one for every 1/pieces of a partition's rows."""
    each = max(1.0, rows / (partitions * pieces))
    return {key: max(1, math.ceil(count / each)) for key, count in heavy.items()}


def join_evenly(
    batch: DataFrame, dimension: DataFrame, key: str, share: float = SHARE, partitions: int | None = None
) -> DataFrame:
    """A left join of a batch with one row per key, even where keys are not.

    The result is that of the plain join. Rows without a key are dealt by their content. The
    copies of dimension rows number at most ``PIECES`` for each partition, whatever the data.
    """
    spark = batch.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64(*(F.col(f"`{c}`") for c in batch.columns))
    rows = batch.count()
    dealt = pieces_of(heavy_keys(batch, key, share), rows, partitions)
    free = F.lit(partitions * PIECES)
    if dealt:
        known = F.create_map(*(F.lit(x) for pair in dealt.items() for x in pair))
        pieces: Column = F.coalesce(known[F.col(key)], F.lit(1))
    else:
        pieces = F.lit(1)
    piece = F.when(F.col(key).isNull(), F.pmod(spread, free)).otherwise(F.pmod(spread, pieces))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), pieces.cast("long") - 1))
    left = batch.withColumn("_piece", piece.cast("long"))
    right = dimension.withColumn("_piece", copies)
    return left.join(right, [key, "_piece"], "left").drop("_piece")


def evenly_enriched(users: DataFrame | None = None, items: DataFrame | None = None, share: float = SHARE) -> Callable[[DataFrame], DataFrame]:
    """What :func:`~viewtide.streaming.enrich.enrich` does, as a transformation of each batch."""

    def transform(batch: DataFrame) -> DataFrame:
        if users is not None:
            batch = join_evenly(batch, users, "user_id", share)
        if items is not None:
            batch = join_evenly(batch, items, "movie_id", share)
        return batch

    return transform
