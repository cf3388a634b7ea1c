"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in a random but fixed order, form blocks. Block j of a source with
weight w is released at slot floor(j / w) and due at slot ceil((j + 1) / w); every slot takes
the released block with the earliest deadline. Weights are taken as exact fractions, and the
schedule is that of the whole run, so at every slot each source's share is less than one
block away from its target, whatever the ratios of the weights and the number of sources.

The schedule has a bounded number of slots: blocks grow with the corpus, and a weight
must be large enough for its first block to come within the bound. Only it and one row
for each source pass through the driver; documents find their slots by a join on their
source's block.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.session import materialise

#: Slots that a run has about, at most; documents in a block, at least; and the power of a
#: source's bytes of text that is its default weight.
SLOTS, BLOCK_DOCS, POWER = 1 << 20, 16, 0.7
#: A weight so small that its first block is due beyond so many slots is an error.
MOST_SLOTS = 1 << 24
#: Documents in one numbering range of a source.
RANGE_DOCS = 5_000


def exact_parts(weights: dict[str | None, float]) -> dict[str | None, int]:
    """The weights as whole numbers in the same ratios, without any rounding."""
    if any(w < 0 or not math.isfinite(w) for w in weights.values()) or not any(w > 0 for w in weights.values()):
        raise ValueError("weights must be finite, not negative, and not all zero")
    fractions = {source: Fraction(w) for source, w in weights.items() if w > 0}
    scale = math.lcm(*(f.denominator for f in fractions.values()))
    parts = {source: int(f * scale) for source, f in fractions.items()}
    common = math.gcd(*parts.values())
    return {source: part // common for source, part in parts.items()}


def schedule(parts: dict[str | None, int]) -> Iterator[tuple[str | None, int]]:
    """For each slot, without end, its source and which of the source's blocks it takes.

    Earliest deadline first among released blocks; ties go by the sources' names. One block
    of each source waits at a time, so a slot costs the logarithm of the sources' number.
    """
    total = sum(parts.values())
    names = sorted(parts, key=lambda s: (s is not None, s or ""))
    own = [parts[name] for name in names]
    coming = [(0, k, 0) for k in range(len(names))]
    ready: list[tuple[int, int, int]] = []
    now = 0
    while True:
        while coming and coming[0][0] <= now:
            _, k, j = heapq.heappop(coming)
            heapq.heappush(ready, (-(-(j + 1) * total // own[k]), k, j))
        due, k, j = heapq.heappop(ready)
        if due <= now:
            raise RuntimeError("a block missed its deadline")
        yield names[k], j
        heapq.heappush(coming, ((j + 1) * total // own[k], k, j + 1))
        now += 1


def block_size(sizes: dict[str | None, int], parts: dict[str | None, int], slots: int, least: int) -> int:
    """Documents in a block, so that every source is read whole in about ``slots`` slots."""
    total = sum(parts.values())
    small = [source for source in sizes if total > MOST_SLOTS * parts[source]]
    if small:
        raise ValueError(f"weights below 1/{MOST_SLOTS} of the sum: {sorted(map(str, small))}")
    longest = max(-(-n * total // parts[source]) for source, n in sizes.items())
    return max(least, -(-longest // slots))


def whole_run(blocks: dict[str | None, int], parts: dict[str | None, int]) -> list[tuple[str | None, int]]:
    """The schedule up to the slot in which the last source has been read whole."""
    waiting = sum(1 for n in blocks.values() if n)
    run = []
    for source, block in schedule(parts):
        run.append((source, block))
        if block + 1 == blocks[source]:
            waiting -= 1
            if not waiting:
                return run
    raise RuntimeError("a schedule has no end")


def default_weights(docs: DataFrame, power: float = POWER) -> dict[str | None, float]:
    """A weight for each source: its bytes of text (and 1 for each document) to a power."""
    held = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("held")
    return {row["source"]: float(row["held"]) ** power for row in docs.groupBy("source").agg(held).collect()}


def numbered(docs: DataFrame, by: Column | None = None) -> DataFrame:
    """Add ``number``: 0, 1, 2, ... within each source, in the order of ``by`` or a hash of id and text.

    A source is numbered in ranges of that hash, side by side, and a range starts after the
    rows of those before it; no source is sorted in one place.
    """
    n_docs = docs.count()
    ranges = max(1, math.ceil(n_docs / RANGE_DOCS))
    shuffled = docs.withColumn("_hash", F.xxhash64("doc_id", "text") if by is None else by)
    low, width = -(1 << 63), (1 << 64) / ranges
    place = F.floor((F.col("_hash").cast("double") - F.lit(float(low))) / F.lit(width))
    shuffled = shuffled.withColumn("_range", F.least(place, F.lit(ranges - 1)).cast("long"))
    counts = shuffled.groupBy(F.col("source").alias("_of"), F.col("_range").alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_of").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    # Rows of equal hash are copies of one document; which comes first makes no difference.
    within = Window.partitionBy("source", "_range").orderBy("_hash")
    placed = shuffled.withColumn("_rank", F.row_number().over(within) - 1)
    joined = placed.join(counts, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_at")))
    return joined.withColumn("number", F.col("_before") + F.col("_rank")).drop(
        "_hash", "_range", "_of", "_at", "_before", "_rank"
    )


def mix_sources(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    slots: int = SLOTS,
    block_docs: int = BLOCK_DOCS,
    by: Column | None = None,
) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, source) in mixed order, with their places.

    Adds ``epoch`` (which reading of the source), ``slot``, ``place`` in the slot's block,
    and ``position``, which orders the mixture. It runs until every source has been read
    whole, so smaller sources with larger weights repeat: each row comes once at least, and
    sources without a weight, or with 0, are an error rather than lost. Null is a source of
    its own; repeated rows are rows. Input columns of the added names are replaced. An empty
    table gives an empty one. A block has ``block_docs`` documents, or as many as give a run of
    about ``slots`` slots if that is more; a smallest share below 1 / ``slots`` makes it longer.
    """
    docs = docs.drop("number", "epoch", "slot", "place", "position")
    spark = docs.sparkSession
    # One row for each source.
    sizes = {row["source"]: row["count"] for row in docs.groupBy("source").count().collect()}
    extra = "cast(0 AS long) AS epoch, cast(0 AS long) AS slot, cast(0 AS int) AS place, cast(0 AS long) AS position"
    if not sizes:
        return docs.selectExpr("*", *extra.split(", "))
    weights = weights or default_weights(docs)
    missing = [source for source in sizes if not weights.get(source, 0) > 0]
    if missing:
        raise ValueError(f"sources without a positive weight: {sorted(map(str, missing))}")
    parts = exact_parts({source: weights[source] for source in sizes})
    block_docs = block_size(sizes, parts, slots, block_docs)
    blocks = {source: math.ceil(n / block_docs) for source, n in sizes.items()}
    run = whole_run(blocks, parts)
    taken = dict.fromkeys(sizes, 0)
    for source, _ in run:
        taken[source] += 1
    # Sources by number, so that null joins like any other.
    number = {source: k for k, source in enumerate(sizes)}
    plan = spark.createDataFrame(
        [(s, number[s], blocks[s], taken[s]) for s in sizes], "_source string, _which int, _blocks long, _taken long"
    )
    table = pa.table(
        {
            "_slot_of": pa.array(np.array([number[s] for s, _ in run], np.int32)),
            "_index": pa.array(np.array([j for _, j in run], np.int64)),
            "_slot": pa.array(np.arange(len(run), dtype=np.int64)),
        }
    )
    # A row for each slot, of which there are about ``slots`` at most; Spark chooses the join.
    table = materialise(spark.createDataFrame(table), "slots")
    rows = numbered(docs, by).join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("_source")))
    block = F.floor(F.col("number") / block_docs)
    rows = rows.withColumn("_block", block).withColumn("place", (F.col("number") % block_docs).cast("int"))
    rows = rows.withColumn("_turn", F.explode(F.expr("sequence(_block, _taken - 1, _blocks)")))
    rows = rows.withColumn("epoch", F.floor(F.col("_turn") / F.col("_blocks")))
    rows = rows.join(table, (F.col("_which") == F.col("_slot_of")) & (F.col("_turn") == F.col("_index")))
    rows = rows.withColumn("slot", F.col("_slot"))
    rows = rows.withColumn("position", F.col("slot") * block_docs + F.col("place"))
    return rows.select(*docs.columns, "epoch", "slot", "place", "position")


def mixed_texts(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    slots: int = SLOTS,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """Whole rows of ``docs`` in mixed order: as many ranges of positions as shuffle partitions, sorted within.

    Rows are numbered, scheduled and placed by a 64-bit key alone. The texts then move twice:
    to their places by that key, and to the ranges, which follow from the positions by
    arithmetic since those are dense. Rows equal in all columns are placed one by one, but
    meet their places as one row.
    """
    spark = docs.sparkSession
    key, position, part = (_unused(docs, name) for name in ("_key", "_position", "_part"))
    keyed = docs.withColumn(key, F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)))
    slim = keyed.select("source", F.col(key).alias("_key"))
    mixed = mix_sources(slim, weights or default_weights(docs), slots, block_docs, F.col("_key"))
    places = materialise(mixed.select(F.col("_key").alias(key), F.col("position").alias(position)), "places")
    last = places.agg(F.max(position)).first()[0]
    if last is None:
        return docs
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = places.join(keyed.dropDuplicates([key]), key)
    place = F.least(F.floor(F.col(position) * F.lit(ranges / (last + 1))).cast("int"), F.lit(ranges - 1))
    whole = whole.withColumn(part, place).repartitionById(ranges, part)
    return whole.sortWithinPartitions(position).select(*(F.col(f"`{c}`") for c in docs.columns))


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name = f"_{name}"
    return name
