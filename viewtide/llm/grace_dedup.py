"""Exact deduplication by Grace hash partitioning.

Records are dealt by a hash of their normalised text into buckets, whose spill files are
Spark's shuffle files. How large each bucket would be is known before any text moves, from a
table of hashes and lengths: a bucket beyond its limit is dealt again by another hash, and
its parts again, until all fit; so every text moves once, to its last bucket. A text whose
copies alone exceed the limit cannot be parted by hashing. Its copies are dealt over several
buckets, each of which leaves one, and those go through the same steps again.

In a bucket an open-addressing table with linear probing compares complete contents: two
texts of one hash are the same only if all their bytes are.
"""

from __future__ import annotations

import math
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.llm.common import flat, mix, whole_text
from viewtide.session import materialise

#: Bytes of text in a bucket, and what a record counts besides its text.
BUCKET_BYTES, RECORD_BYTES = 16 << 20, 64


def normalised(column: str = "text") -> Column:
    """The text with one space in place of each run of ASCII white space; null is empty."""
    # Single spaces stay as they are, so only other runs are looked for.
    return F.regexp_replace(whole_text(column), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


class ContentTable:
    """An open-addressing table over the rows of one bucket."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, hashes: np.ndarray):
        self.data, self.offsets, self.hashes = data.tobytes(), offsets, hashes
        self.lengths = np.diff(offsets)

    def content(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]]

    def groups(self) -> np.ndarray:
        """For each row the first row with the same content."""
        n = len(self.hashes)
        size = 1 << max(1, (2 * n - 1).bit_length())
        owner = np.full(size, -1, np.int64)
        place = (mix(self.hashes.view(np.uint64)) & np.uint64(size - 1)).astype(np.int64)
        first = np.full(n, -1, np.int64)
        waiting = np.arange(n)
        while len(waiting):
            # All waiting rows take one step: empty slots go to the first row that asks.
            asking = waiting[owner[place[waiting]] < 0][::-1]
            owner[place[asking]] = asking
            held = owner[place[waiting]]
            alike = (self.hashes[held] == self.hashes[waiting]) & (self.lengths[held] == self.lengths[waiting])
            for k in np.flatnonzero(alike & (held != waiting)).tolist():
                alike[k] = self.content(int(held[k])) == self.content(int(waiting[k]))
            first[waiting[alike]] = held[alike]
            waiting = waiting[~alike]
            place[waiting] = (place[waiting] + 1) & (size - 1)
        return first


def bucket_plan(sizes: DataFrame, limit: int) -> tuple[int, DataFrame | None]:
    """How hashes are dealt: the number of first buckets, and hashes that go elsewhere.

    ``sizes`` has (h, bytes, n), one row for each hash. The second result has (h, bucket, salts);
    None where every first bucket fits. A hash has more than one salt only if its own texts
    exceed half of the limit, and then four texts a salt at least, so that their number falls.
    """
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    n_buckets = max(1, math.ceil(2 * total / limit))
    dealt = sizes.withColumn("bucket", F.pmod("h", F.lit(n_buckets)))
    moved: list[DataFrame] = []
    # Hot hashes first, so that their buckets' other hashes stay where they are.
    hot = F.col("bytes") > limit // 2
    salts = F.expr(f"greatest(1, least(ceil(bytes / {limit // 2}), n div 4))").cast("int")
    own = sizes.filter(hot).select("h", F.xxhash64(F.lit("hot"), "h").alias("bucket"), salts.alias("salts"))
    moved.append(own)
    rest = dealt.filter(~hot)
    for level in range(1, 64):
        over = rest.groupBy("bucket").agg(F.sum("bytes").alias("held")).filter(F.col("held") > limit)
        over = materialise(over, "over")
        if over.isEmpty():
            break
        parted = rest.join(over, "bucket").withColumn("parts", F.ceil(2 * F.col("held") / F.lit(limit)))
        own_hash = F.pmod(F.xxhash64(F.lit(level), "h"), F.col("parts"))
        rest = materialise(parted.select("h", "bytes", F.xxhash64("bucket", own_hash).alias("bucket")), "parted")
        # A hash that is dealt again at the next level has its last place there.
        moved = [moved[0], *(m.join(rest.select("h"), "h", "left_anti") for m in moved[1:])]
        moved.append(rest.select("h", "bucket", F.lit(1).alias("salts")))
    plan = moved[0]
    for more in moved[1:]:
        plan = plan.unionByName(more)
    plan = materialise(plan, "plan")
    return n_buckets, None if plan.isEmpty() else plan


def _fold(carried: tuple[str, ...]):
    """One bucket: each row's group, smallest id, number of copies, and digest."""

    def fold(table: pa.Table) -> pa.Table:
        data, offsets = flat(table["_text"])
        known = ContentTable(data, offsets, table["_h"].to_numpy())
        first = known.groups()
        keepers, group = np.unique(first, return_inverse=True)
        # The smallest id, nulls last, and the first row that has it.
        order = pc.sort_indices(pa.table({"id": table["_id"]}), [("id", "ascending")], null_placement="at_end").to_numpy()
        _, at = np.unique(group[order], return_index=True)
        best = order[at]
        copies = np.zeros(len(keepers), np.int64)
        np.add.at(copies, group, table["_n"].to_numpy())
        digests = [sha256(known.content(row)).hexdigest() for row in keepers.tolist()]
        leads = np.zeros(len(group), bool)
        leads[best] = True
        salted = np.asarray(table["_salts"].to_numpy() > 1)
        texts = pc.if_else(pa.array(leads & salted), table["_text"].combine_chunks(), pa.scalar(None, table["_text"].type))
        made = {
            "_bucket": table["_bucket"],
            "_group": pa.array(group, pa.int64()),
            "_h": table["_h"],
            "_id": table["_id"],
            "_keep": table["_id"].take(pa.array(best[group])),
            "_size": pa.array(copies[group]),
            "_leads": pa.array(leads),
            "_salted": pa.array(salted),
            "_sha": pa.array(digests, pa.string()).take(pa.array(group)),
            "_text": texts,
        }
        return pa.table(made | {name: table[name] for name in carried})

    return fold


def _folded(records: DataFrame, limit: int, carried: tuple[str, ...]) -> DataFrame:
    """Rows of ``records`` (_h, _id, _n, _text, _spread) after one pass through their buckets; written."""
    weight = (F.octet_length("_text") + F.lit(RECORD_BYTES)).cast("long")
    sizes = records.select(F.col("_h").alias("h"), weight.alias("bytes")).groupBy("h")
    sizes = materialise(sizes.agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")), "sizes")
    n_buckets, plan = bucket_plan(sizes, limit)
    first = F.pmod("_h", F.lit(n_buckets))
    if plan is None:
        dealt = records.withColumns({"_bucket": first, "_salts": F.lit(1)})
    else:
        dealt = records.join(plan, F.col("_h") == F.col("h"), "left")
        salt = F.pmod("_spread", "salts")
        place = F.when(F.col("salts") > 1, F.xxhash64("bucket", salt)).otherwise(F.col("bucket"))
        dealt = dealt.withColumn("_bucket", F.coalesce(place, first))
        dealt = dealt.withColumn("_salts", F.coalesce("salts", F.lit(1))).drop("h", "bucket", "salts")
    kinds = {f.name: f.dataType.simpleString() for f in records.schema}
    id_type = kinds["_id"]
    schema = (
        f"_bucket long, _group long, _h long, _id {id_type}, _keep {id_type}, _size long, _leads boolean, "
        "_salted boolean, _sha string, _text string"
    )
    for name in carried:
        schema += f", `{name}` {kinds[name]}"
    return materialise(dealt.groupBy("_bucket").applyInArrow(_fold(carried), schema), "folded")


def exact_groups(
    docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, carry: bool = False, key: Column | None = None
) -> DataFrame:
    """Which row stays of all rows of ``docs`` (doc_id, text) with equal normalised text.

    One row for each input row: doc_id, keep_id (the smallest id; nulls are last), group_size,
    kept and text_sha256 (of the normalised text). Exactly one row of a group is kept, also
    where an id repeats. A null text is an empty one, equal to other empty ones. An empty
    table gives an empty one. ``docs`` should be a stored table, since copies of a hot text are
    spread by their rows' places in it, which a repeated task must find again. With ``carry`` all input columns come too, under their own names
    with ``in_`` before them. ``key`` is the hash by which ``_text`` is dealt; contents
    decide, so any will do.
    """
    carried = {f"in_{name}": F.col(f"`{name}`") for name in docs.columns} if carry else {}
    records = docs.select(F.col("doc_id").alias("_id"), normalised().alias("_text"), *(c.alias(n) for n, c in carried.items()))
    records = records.withColumn("_h", F.xxhash64("_text") if key is None else key)
    records = records.withColumns({"_n": F.lit(1).cast("long"), "_spread": F.monotonically_increasing_id()})
    folded = _folded(records, bucket_bytes, tuple(carried))
    names = {"_id": "doc_id", "_keep": "keep_id", "_size": "group_size", "_leads": "kept", "_sha": "text_sha256"}
    columns = [F.col(a).alias(b) for a, b in names.items()] + [F.col(f"`{name}`") for name in carried]
    hot = folded.filter("_salted AND _leads")
    if hot.isEmpty():
        return folded.select(*columns)
    # A hot text left one record in each of its buckets; those meet until one bucket holds them.
    parts: list[DataFrame] = []
    while not hot.isEmpty():
        # Another hash each time, so that different texts of one hash part as well.
        again = F.xxhash64(F.lit(len(parts)), "_text").alias("_h")
        came = [F.col("_bucket").alias("_from"), F.col("_group").alias("_of"), F.xxhash64("_bucket", "_group").alias("_spread")]
        left = hot.select(again, "_id", F.col("_size").alias("_n"), "_text", *came)
        parts.append(_folded(left, bucket_bytes, ("_from", "_of")))
        hot = parts[-1].filter("_salted AND _leads")
    # From the last meeting back: a record's group is the one its leader met.
    found = _verdicts(parts[-1])
    for met in reversed(parts[:-1]):
        found = _resolved(met, found, _verdicts).unionByName(_verdicts(met.filter("NOT _salted")))
    return _resolved(folded, found, lambda f: f).select(*columns).unionByName(folded.filter("NOT _salted").select(*columns))


def _verdicts(met: DataFrame) -> DataFrame:
    """For each record that came from a bucket's group: the group's final id, size and leader."""
    return met.select("_from", "_of", F.col("_keep").alias("_last"), F.col("_size").alias("_all"), F.col("_leads").alias("_wins"))


def _resolved(folded: DataFrame, found: DataFrame, shape) -> DataFrame:
    """Salted rows of ``folded`` with what their groups came to."""
    own = (F.col("_bucket") == F.col("_group_from")) & (F.col("_group") == F.col("_group_of"))
    found = found.withColumnsRenamed({"_from": "_group_from", "_of": "_group_of"})
    joined = folded.filter("_salted").join(found, own)
    joined = joined.withColumns({"_keep": F.col("_last"), "_size": F.col("_all"), "_leads": F.col("_leads") & F.col("_wins")})
    return shape(joined.drop("_group_from", "_group_of", "_last", "_all", "_wins"))


def keep_first(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, with all their columns."""
    kept = exact_groups(docs, bucket_bytes, carry=True).filter("kept")
    return kept.select(*(F.col(f"`in_{name}`").alias(name) for name in docs.columns))
