"""SimHash fingerprints and their neighbours, in DataFrame functions only.

A text's terms are its runs of three lower-cased words, each weighted by how often it
occurs. Every term hash votes on 64 signed bits. Votes are counted in 32 numbers that hold
two 32-bit counters each, so one aggregation over the terms needs no 64 columns.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.llm.common import whole_text
from viewtide.session import materialise

TERM_WORDS = 3
#: Bits in which near fingerprints may differ, and the blocks that the tables choose from.
RADIUS, BLOCKS = 3, 6
#: Documents whose ids this divides are the queries that are sought among all documents.
QUERY_EVERY = 20
#: Bytes of text that neighbours in document order share a bucket of, and the quantiles that
#: place the buckets.
BUCKET_BYTES, KNOTS = 4 << 20, 64

_SPACES = " \t\n\x0b\f\r"


def vote_columns(term: str) -> list[Column]:
    """Sums of a term hash's bits: column k counts bit k in its low half and bit k + 32 in its high half."""
    pair = (1 << 32) + 1
    return [F.sum(F.shiftrightunsigned(term, k).bitwiseAND(F.lit(pair))).alias(f"v{k}") for k in range(32)]


def majority(n: str = "n_terms") -> Column:
    """The fingerprint as a number: bit k is set where more than half of the terms have it."""
    bits = []
    for k in range(32):
        low = F.col(f"v{k}").bitwiseAND(F.lit((1 << 32) - 1))
        high = F.shiftrightunsigned(f"v{k}", 32)
        for count, place in ((low, k), (high, k + 32)):
            bits.append(F.when(2 * count > F.col(n), F.shiftleft(F.lit(1).cast("long"), place)).otherwise(F.lit(0).cast("long")))
    whole = bits[0]
    for bit in bits[1:]:
        whole = whole.bitwiseOR(bit)
    return whole


def written(fingerprint: str) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def likeness(a: str, b: str) -> Column:
    return 1 - F.bit_count(F.col(a).bitwiseXOR(F.col(b))) / 64


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (*keys, fingerprint) for rows (*keys, text) with distinct keys.

    A text of fewer words than a term has is one term; one without words, or null, has none
    and gets the fingerprint 0. Where the input is dealt by some of the keys, nothing is
    shuffled.
    """
    trimmed = texts.select(*keys, F.btrim(F.lower(whole_text()), F.lit(_SPACES)).alias("trimmed"))
    words = trimmed.select(*keys, F.split("trimmed", f"[{_SPACES}]+").alias("words"))
    gets = ", ".join(f"get(words, i + {k})" for k in range(TERM_WORDS))
    # Splitting an empty text gives one empty word; its term is null and votes for nothing.
    run = f"if(size(words) = 1 AND words[0] = '', cast(NULL AS long), xxhash64({gets}))"
    runs = f"transform(sequence(0, greatest(size(words) - {TERM_WORDS}, 0)), i -> {run})"
    terms = words.select(*keys, F.explode(F.expr(runs)).alias("term"))
    counted = terms.groupBy(*keys).agg(F.count("term").alias("n_terms"), *vote_columns("term"))
    return counted.select(*keys, F.coalesce(majority(), F.lit(0).cast("long")).alias("fingerprint"))


def _bucket(docs: DataFrame, bucket_bytes: int) -> Column:
    """Ranges of ids that rise with the id; null is below all others.

    Between quantiles of the ids the ranges are even, so that ids with gaps still give
    buckets of similar size. An empty table has one bucket.
    """
    found = docs.agg(
        F.sum(F.octet_length("text")).alias("bytes"),
        F.percentile_approx("doc_id", [k / KNOTS for k in range(KNOTS + 1)], 10_000).alias("knots"),
    ).first()
    knots = sorted(set(found["knots"] or []))
    each = max(1, math.ceil((found["bytes"] or 0) / bucket_bytes / max(1, len(knots) - 1)))
    bucket = F.lit(0)
    for k, (low, high) in enumerate(itertools.pairwise(knots)):
        within = F.floor((F.col("doc_id") - low) / F.lit(float(high - low)) * each)
        bucket = F.when(F.col("doc_id") >= low, F.least(within, F.lit(each - 1)) + (1 + k * each)).otherwise(bucket)
    return F.when(F.col("doc_id").isNull(), -1).otherwise(bucket).cast("long")


def _next_buckets(buckets: DataFrame) -> DataFrame:
    """Rows (bucket, next): the next lower bucket in use; after the lowest, the highest.

    Neighbours are sought within a thousand buckets first, so that the one window over all
    rows sees one row for each thousand.
    """
    grouped = buckets.withColumn("thousand", F.floor(F.col("bucket") / 1000))
    down = Window.partitionBy("thousand").orderBy(F.desc("bucket"))
    near = grouped.withColumn("next", F.lead("bucket").over(down))
    tops = grouped.groupBy("thousand").agg(F.max("bucket").alias("top"))
    over_all = Window.orderBy(F.desc("thousand"))
    whole = over_all.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.select(
        "thousand", F.coalesce(F.lead("top").over(over_all), F.max("top").over(whole)).alias("below")
    )
    return near.join(tops, "thousand").select("bucket", F.coalesce("next", "below").alias("next"))


def with_next(rows: DataFrame, order: list[Column], value: str) -> DataFrame:
    """Add ``next_value``: ``value`` of the row after, through the buckets and round to the first.

    Rows are ordered within ``bucket`` by ``order``, and buckets by falling number.
    """
    within = Window.partitionBy("bucket").orderBy(*order)
    placed = rows.withColumn("rank", F.row_number().over(within)).withColumn("after", F.lead(value).over(within))
    heads = placed.filter("rank = 1").select(F.col("bucket").alias("next"), F.col(value).alias("head"))
    following = _next_buckets(heads.select(F.col("next").alias("bucket"))).join(heads, "next")
    following = following.select(F.col("bucket").alias("of_bucket"), "head")
    # Only a bucket's last row has nothing after it, and takes the head of the next bucket.
    joined = placed.join(following, (F.col("bucket") == F.col("of_bucket")) & F.col("after").isNull(), "left")
    return joined.withColumn("next_value", F.coalesce("after", "head")).drop("after", "head", "of_bucket")


def compare_with_edits(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, every: int = QUERY_EVERY) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text) and of its edited text.

    The edited text has its last half replaced by the first as many characters of the next
    document: the one with the next lower id, by text among equal ids, null ids last, and
    after the last one the first. A null text is empty. Each row gives one row. Those of ids
    that ``every`` divides have ``n_within`` and ``least_within``: the rows whose fingerprint is
    within the radius of theirs, their own among them, and the smallest id of these.
    """
    docs = docs.select("doc_id", whole_text().alias("text"))
    docs = docs.withColumn("bucket", _bucket(docs, bucket_bytes))
    paired = with_next(docs, [F.desc_nulls_last("doc_id"), F.col("text")], "text")
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.expr("left(text, char_length(text) - cast(floor(char_length(text) / 2) AS int))"), F.left("next_value", half))
    paired = paired.select("bucket", "rank", "doc_id", F.char_length("text").cast("long").alias("n_chars"), "text", edited.alias("edited"))
    paired = paired.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    both = F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")),
    )
    own = ["bucket", "rank", "doc_id", "n_chars", "edited_sha256"]
    texts = paired.select(*own, F.explode(both).alias("one")).select(*own, "one.which", "one.text")
    made = fingerprints(texts, [*own, "which"])
    made = materialise(
        made.groupBy(*own).agg(
            F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("first"),
            F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("second"),
        ),
        "fingerprints",
    )
    chained = with_next(made.withColumnRenamed("rank", "place"), [F.col("place")], "first")
    asked = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    # Joined by the fingerprint of every row: rows that do not ask have no common key of their own.
    chained = chained.join(near_rows(made, made.filter(asked)), F.col("first") == F.col("query"), "left")
    return chained.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written("first").alias("fingerprint"),
        written("second").alias("edited_fingerprint"),
        likeness("first", "second").alias("near_edited"),
        likeness("first", "next_value").alias("near_next"),
        F.when(asked, F.col("n_within")).alias("n_within"),
        F.when(asked, F.col("least_within")).alias("least_within"),
    )


def block_keys(fingerprint: str, radius: int = RADIUS, blocks: int = BLOCKS) -> Column:
    """The permuted tables of a fingerprint: an array of (table, key).

    Two fingerprints within the radius differ in ``radius`` blocks at most, so they agree in
    some choice of ``blocks - radius`` blocks, and each choice is a table keyed by them.
    """
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in itertools.pairwise(edges)]
    made = []
    for table, chosen in enumerate(itertools.combinations(masks, blocks - radius)):
        mask = sum(chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        made.append(F.struct(F.lit(table).alias("table"), F.col(fingerprint).bitwiseAND(F.lit(signed).cast("long")).alias("key")))
    return F.array(*made)


def within_radius(queries: DataFrame, found: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All pairs (query, fingerprint, distance) of distinct fingerprints within the radius.

    Both inputs have a column ``fingerprint`` of 64-bit numbers; repeated ones count once,
    nulls find nothing.
    """
    sides = []
    for rows, name in ((queries, "query"), (found, "fingerprint")):
        distinct = rows.select(F.col("fingerprint").alias(name)).dropna().distinct()
        sides.append(distinct.select(name, F.explode(block_keys(name, radius, blocks)).alias("block")).select(name, "block.*"))
    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("fingerprint")))
    pairs = sides[0].join(sides[1], ["table", "key"]).withColumn("distance", distance.cast("int"))
    return pairs.filter(F.col("distance") <= radius).select("query", "fingerprint", "distance").distinct()


def near_rows(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """Rows (query, n_within, least_within) for each fingerprint ``first`` of ``queries``.

    Counted and smallest are the rows of ``rows`` (doc_id, first) within the radius; rows of
    equal fingerprints meet the queries as one.
    """
    each = rows.groupBy(F.col("first").alias("fingerprint")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"))
    pairs = within_radius(queries.select(F.col("first").alias("fingerprint")), each)
    found = pairs.join(each, "fingerprint")
    return found.groupBy("query").agg(F.sum("n").alias("n_within"), F.min("least").alias("least_within"))
