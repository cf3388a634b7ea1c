"""N-gram Jaccard join: word-shingle sets, light sets by subsets, heavy sets by inverted lists.

Texts with equal sets form a class, and links are sought between classes. A set is light
up to a boundary that the sizes' histogram chooses by cost. Two light sets link exactly if
they share a subset of the size their link needs, so light sets enumerate those subsets and
meet in their keys. Heavy sets scan inverted lists. A first scan over a third of each set
leaves the sets that share enough of it with others to link at all; those that only share a
passage do not. What is left is listed whole, rarest shingles first, and pairs that meet
early enough in both orders are verified.

A list may hold very many near copies of one another. So every member is first compared
with the plainest set of its lists, verified links are contracted to components, and only
members of different components are paired after that: no link between components is lost,
and links inside a component change nothing.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtide.llm.common import LOWER, SortedHashes, Words, count_keys, flat, frugal, mix, row_chunks, smaller_batches, whole_text, word_windows
from viewtide.llm.components import components
from viewtide.session import materialise

#: Words in a shingle; a link needs NEED_A * intersection >= NEED_B * union.
SHINGLE = 5
NEED_A, NEED_B = 4, 3
#: Largest set that may be light, and the work of a list entry and of verifying a heavy set, in
#: rows of a subset.
MOST_LIGHT, ENTRY_COST, VERIFY_COST = 14, 2.0, 8.0
#: Shingles known to be frequent: how many at most (it bounds the broadcast), and from what count.
#: They only order a set's shingles, which changes the work and not the result.
MOST_FREQUENT, FREQUENT = 1 << 18, 8
#: Members of a list that share a representative.
LIST_PART = 4096
#: Bytes of text whose words are arrays at once, and whose sets are.
CHUNK, BATCH = 1 << 20, 4 << 20


def overlap(a, b):
    """The least intersection of linked sets of these sizes: 3/7 of their sum, rounded up."""
    return -((-NEED_B * (a + b)) // (NEED_A + NEED_B))


def prefix(size: int) -> int:
    """First shingles that are listed: a third, where a quarter would do for one in common."""
    return size - -(-2 * size // 3) + 1


def least_shared(size: int) -> int:
    """So many of its first shingles a set shares with any linked set, whatever that one's size.

    Of the whole intersection, no more than the longer rest of the two sets lies beyond their
    first shingles. The bound is lowest for the smallest and the largest partner.
    """
    small, large = -(-NEED_B * size // NEED_A), NEED_A * size // NEED_B
    rest = max(size - prefix(size), small - prefix(small))
    return max(1, min(overlap(size, small) - rest, overlap(size, large) - (large - prefix(large))))


def shingle_sets(texts: pa.Array):
    """For each text in order its distinct shingles, as sorted hashes."""
    data, offsets = flat(texts)
    for start, stop in row_chunks(offsets, CHUNK):
        part = offsets[start : stop + 1]
        words = Words(LOWER[data[part[0] : part[-1]]], part - part[0])
        hashes = words.hashes()
        keys, _, text_of = word_windows(words, hashes, SHINGLE)
        at = np.searchsorted(text_of, np.arange(stop - start + 1))
        for row in range(stop - start):
            first, last = words.rows[row], words.rows[row + 1]
            if 0 < last - first < SHINGLE:
                own = hashes[first:last]
                whole = mix((own * (np.arange(1, len(own) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1))).sum(keepdims=True))
                yield whole + np.uint64(len(own))
            else:
                yield np.unique(keys[at[row] : at[row + 1]])


def set_id(shingles: np.ndarray) -> np.int64:
    """A 64-bit name of a set: equal sets have equal names."""
    return mix(mix(shingles).sum(keepdims=True) + np.uint64(len(shingles))).view(np.int64)[0]


def signatures(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, version, id, n, light) of documents, and rows (shingle, c) repeated in a batch.

    ``light`` holds the set itself where it is small enough to be light.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches):
        seen: set[int] = set()
        for batch in smaller_batches(batches, BATCH):
            ids, sizes, light, fresh = [], [], [], []
            for own in shingle_sets(batch.column("text")):
                name = int(set_id(own))
                ids.append(name)
                sizes.append(len(own))
                light.append(own.tobytes() if 0 < len(own) <= MOST_LIGHT else None)
                if name not in seen:
                    seen.add(name)
                    fresh.append(own)
            keys, counts = count_keys(np.concatenate(fresh)) if fresh else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            many = counts > 1
            n, m = len(ids), int(many.sum())
            none = {"doc_id": pa.nulls(m, batch.column("doc_id").type), "id": pa.nulls(m, pa.int64())}
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column("doc_id"), none["doc_id"]]),
                    pa.concat_arrays([batch.column("version"), none["id"]]),
                    pa.concat_arrays([pa.array(ids, pa.int64()), none["id"]]),
                    pa.concat_arrays([pa.array(sizes, pa.int64()), none["id"]]),
                    pa.concat_arrays([pa.array(light, pa.binary()), pa.nulls(m, pa.binary())]),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(keys[many].view(np.int64))]),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(counts[many])]),
                ],
                ["doc_id", "version", "id", "n", "light", "shingle", "c"],
            )

    return docs.mapInArrow(frugal(sign), f"doc_id {kind}, version long, id long, n long, light binary, shingle long, c long")


def light_boundary(histogram: dict[int, int]) -> int:
    """The largest light size, from how many classes there are of each size."""

    def subsets(size: int, most: int) -> int:
        return sum(math.comb(size, overlap(size, b)) for b in partners(size, most))

    def cost(most: int) -> float:
        total = 0.0
        for size, count in histogram.items():
            if 0 < size <= most:
                total += count * subsets(size, most)
            if NEED_A * size >= NEED_B * (most + 1):
                total += count * (prefix(size) * ENTRY_COST + VERIFY_COST)
        return total

    return min(range(MOST_LIGHT + 1), key=cost)


def partners(size: int, most: int) -> range:
    """Sizes up to ``most`` that a set of this size can link with."""
    return range(max(1, math.ceil(NEED_B * size / NEED_A)), min(most, NEED_A * size // NEED_B) + 1)


def light_edges(classes: DataFrame, most: int) -> DataFrame:
    """Links (u, v) that connect all linked light sets; no pair needs verifying.

    A key stands for a subset and two sizes. All sets of the smaller size under it (side 0)
    link with all of the larger (side 1), and those of a key for equal sizes (side 2) with
    each other, so each links to the lowest of the other side.
    """

    def enumerate_subsets(batches):
        for batch in batches:
            keys, sides, ids = [], [], []
            for name, light in zip(batch.column("id").to_pylist(), batch.column("light").to_pylist(), strict=True):
                own = mix(np.frombuffer(light, np.uint64))
                for size in partners(len(own), most):
                    small, large = min(len(own), size), max(len(own), size)
                    picks = np.array(list(itertools.combinations(range(len(own)), overlap(small, large))))
                    sizes = mix(np.array([1000 * small + large], np.uint64))
                    made = mix(own[picks].sum(axis=1, dtype=np.uint64) + sizes)
                    keys.append(made.view(np.int64))
                    sides.append(np.full(len(made), 2 if small == large else int(len(own) == large)))
                    ids.append(np.full(len(made), name))
            columns = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (keys, sides, ids)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "side", "id"])

    rows = classes.filter(F.col("n").between(1, most)).select("id", "light")
    rows = materialise(rows.mapInArrow(enumerate_subsets, "key long, side long, id long"), "subsets")
    lows = [F.min(F.when(F.col("side") == side, F.col("id"))).alias(f"low{side}") for side in range(3)]
    lowest = rows.groupBy(F.col("key").alias("of_key")).agg(*lows)
    other = F.when(F.col("side") == 0, F.col("low1")).when(F.col("side") == 1, F.col("low0")).otherwise(F.col("low2"))
    linked = rows.join(lowest, F.col("key") == F.col("of_key")).select(F.col("id").alias("u"), other.alias("v"))
    return linked.filter("u <> v").distinct()


def inverted_lists(docs: DataFrame, frequent: pa.Table, least: int) -> DataFrame:
    """Rows (shingle, part, id, n, k): the first shingles of each set of ``least`` or more.

    Shingles known to be frequent come last in a set's order. Their lists are dealt into
    parts, by how frequent they are. Lists with one member are left out. ``k`` is how many of
    its rows a set shares with every linked set.
    """
    keys = frequent["shingle"].to_numpy().view(np.uint64)
    held = docs.sparkSession.sparkContext.broadcast(SortedHashes(keys, frequent["c"].to_numpy()))

    def list_first(batches):
        known = held.value
        seen: set[int] = set()
        for batch in smaller_batches(batches, BATCH):
            firsts, counts, ids, sizes, shared = [], [], [], [], []
            for own in shingle_sets(batch.column("text")):
                name = int(set_id(own))
                if len(own) < least or name in seen:
                    continue
                seen.add(name)
                at = known.find(own)
                often = np.where(at >= 0, known.values[0][at], 0)
                if often.any():
                    order = np.lexsort((own, often))
                    own, often = own[order], often[order]
                k = prefix(len(own))
                firsts.append(own[:k])
                counts.append(often[:k])
                ids.append(np.full(k, name))
                sizes.append(np.full(k, len(own)))
                shared.append(np.full(k, least_shared(len(own))))
            if not firsts:
                continue
            ids, often = np.concatenate(ids), np.concatenate(counts)
            parts = often // LIST_PART + 1
            part = mix(ids.view(np.uint64)) % parts.astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(firsts).view(np.int64)),
                    pa.array(part.astype(np.int32)),
                    pa.array(parts.astype(np.int32)),
                    pa.array(ids),
                    pa.array(np.concatenate(sizes).astype(np.int32)),
                    pa.array(np.concatenate(shared).astype(np.int32)),
                ],
                ["shingle", "part", "parts", "id", "n", "k"],
            )

    rows = docs.select("text").mapInArrow(frugal(list_first), "shingle long, part int, parts int, id long, n int, k int")
    together = Window.partitionBy("shingle", "part")
    rows = rows.select("*", F.min("id").over(together).alias("low"), F.max("id").over(together).alias("high"))
    return rows.filter("low <> high OR parts > 1").drop("low", "high").distinct()


def able_to_link(lists: DataFrame) -> DataFrame:
    """Ids of the sets with as many shared first shingles as any link of theirs needs."""
    counted = lists.groupBy("id").agg(F.count(F.lit(1)).alias("q"), F.first("k").alias("k"))
    return counted.filter("q >= k").select("id")


def ordered_lists(sets: DataFrame) -> DataFrame:
    """Rows (shingle, id, n, place, own) of whole sets, each set's rarest shingles first.

    ``place`` counts from 0, and ``own`` is how many shingles no other set has. Kept are
    shared shingles among a set's first ones: linked sets have one there in common.
    """

    def spread(batches):
        for batch in smaller_batches(batches, BATCH, "shingles"):
            own = [np.frombuffer(x, np.int64) for x in batch.column("shingles").to_pylist()]
            sizes = np.array([len(x) for x in own], np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(own)),
                    pa.array(np.repeat(batch.column("id").to_numpy(), sizes)),
                    pa.array(np.repeat(sizes, sizes)),
                ],
                ["shingle", "id", "n"],
            )

    rows = sets.select("id", "shingles").mapInArrow(frugal(spread), "shingle long, id long, n int")
    lengths = rows.groupBy(F.col("shingle").alias("of")).agg(F.count(F.lit(1)).alias("length"))
    # A set's rows are as many as it has shingles.
    of_set = Window.partitionBy("id")
    ranked = rows.join(lengths, F.col("shingle") == F.col("of")).select(
        "shingle",
        "id",
        "n",
        "length",
        (F.row_number().over(of_set.orderBy("length", "shingle")) - 1).alias("place"),
        F.count_if(F.col("length") == 1).over(of_set).alias("own"),
    )
    return ranked.filter("length > 1 AND place <= n - ceil(3 * n / 4)").drop("length")


#: Two sets of sizes n and m can link, and this may be the first shingle they have in common.
EARLY = """4 * least(n, m) >= 3 * greatest(n, m)
    AND place <= n - ceil(3 * (n + m) / 7) AND place_v <= m - ceil(3 * (n + m) / 7)"""


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that link, by their whole sets."""

    def check(batches):
        for batch in smaller_batches(batches, BATCH, "a"):
            good = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                one, two = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                common = len(one) + len(two) - len(np.union1d(one, two))
                good.append(common >= overlap(len(one), len(two)))
            kept = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(name).filter(kept) for name in ("u", "v")], ["u", "v"])

    both = (
        pairs.select("u", "v")
        .join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("a")), "u")
        .join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("b")), "v")
    )
    return both.select("u", "v", "a", "b").mapInArrow(frugal(check), "u long, v long")


def sets_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (id, shingles) of the classes in ``wanted`` (id), from one document of each."""
    named = classes.join(wanted, "id").select(F.col("first_doc").alias("doc_id"))

    def build(batches):
        for batch in smaller_batches(batches, BATCH):
            built = [(int(set_id(own)), own.tobytes()) for own in shingle_sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in built], pa.int64()), pa.array([x for _, x in built], pa.binary())],
                ["id", "shingles"],
            )

    texts = docs.join(named, docs["doc_id"].eqNullSafe(named["doc_id"]), "left_semi").select("text")
    return texts.mapInArrow(frugal(build), "id long, shingles binary").join(wanted, "id", "left_semi").dropDuplicates(["id"])


def heavy_edges(sets: DataFrame, edges: DataFrame) -> DataFrame:
    """Links (u, v) that, with ``edges``, connect all linked sets of ``sets`` (id, shingles)."""
    lists = materialise(ordered_lists(sets), "ordered")
    # The set with the fewest shingles of its own is likely to link with most of its lists.
    hubs = lists.groupBy(F.col("shingle").alias("of")).agg(F.min(F.struct("own", "id", "n", "place")).alias("hub"))
    starred = lists.join(hubs, F.col("shingle") == F.col("of")).select(
        F.col("id").alias("u"),
        "n",
        "place",
        F.col("hub.id").alias("v"),
        F.col("hub.n").alias("m"),
        F.col("hub.place").alias("place_v"),
    )
    met = starred.filter("u <> v").filter(EARLY).groupBy("u", "v").agg(F.count(F.lit(1)).alias("times"))
    first = materialise(met.groupBy("u").agg(F.max_by("v", "times").alias("v")), "pairs")
    edges = edges.unionByName(materialise(verified(first, sets), "edges"))
    joined = lists.join(components(edges).withColumnRenamed("node", "id"), "id", "left")
    joined = joined.select("shingle", "id", "n", "place", F.coalesce("component", "id").alias("component"))
    open_lists = joined.groupBy("shingle").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    joined = materialise(joined.join(open_lists.filter("a <> b").select("shingle"), "shingle", "left_semi"), "lists")
    other = joined.select(
        "shingle",
        F.col("id").alias("v"),
        F.col("n").alias("m"),
        F.col("place").alias("place_v"),
        F.col("component").alias("component_v"),
    )
    pairs = joined.withColumnRenamed("id", "u").join(other, "shingle").filter("component < component_v").filter(EARLY)
    pairs = materialise(pairs.select("u", "v").distinct(), "pairs")
    return edges.unionByName(verified(pairs, sets))


def similar_groups(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, version, n_shingles, class_id, component, component_id) for each row of
    ``docs`` (doc_id, text).

    ``class_id`` is the smallest doc_id with the same set of shingles, null without any;
    ``component_id`` is the smallest doc_id that links reach, and ``component`` names the group
    itself; ``version`` is a hash of the text. A text without words has no shingles and stays
    by itself, as does a null text. Repeated rows and equal texts share a class; a null id
    never names a group that has another id.
    """
    docs = docs.select("doc_id", whole_text().alias("text"))
    docs = docs.withColumn("version", F.xxhash64("text"))
    signed = materialise(signatures(docs), "signatures")
    own = signed.filter("n IS NOT NULL").select("doc_id", "version", "id", "n", "light")
    classes = materialise(
        own.filter("n > 0").groupBy("id").agg(
            F.first("n").alias("n"), F.first("light").alias("light"), F.min("doc_id").alias("first_doc")
        ),
        "classes",
    )
    histogram = {row["size"]: row["count"] for row in classes.groupBy(F.least("n", F.lit(4 * MOST_LIGHT)).alias("size")).count().collect()}
    most = light_boundary(histogram)
    frequent = (
        signed.filter("shingle IS NOT NULL")
        .groupBy("shingle")
        .agg(F.sum("c").alias("c"))
        .filter(F.col("c") >= FREQUENT)
        .orderBy(F.desc("c"), "shingle")
        .limit(MOST_FREQUENT)
        .toArrow()
    )
    edges = materialise(light_edges(classes, most), "edges")
    # A heavy set's smallest partner may be light.
    lists = materialise(inverted_lists(docs, frequent, math.ceil(NEED_B * (most + 1) / NEED_A)), "lists")
    sets = materialise(sets_of(docs, classes, able_to_link(lists)), "sets")
    found = components(heavy_edges(sets, edges))
    named = classes.select("id", "first_doc").join(found.withColumnRenamed("node", "id"), "id", "left")
    named = named.withColumn("component", F.coalesce("component", "id"))
    lowest = named.groupBy(F.col("component").alias("of")).agg(F.min("first_doc").alias("component_id"))
    named = named.join(lowest, F.col("component") == F.col("of"))
    named = named.select("id", "component", "component_id", "first_doc")
    result = own.join(named, "id", "left")
    alone = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select(
        "doc_id",
        "version",
        F.col("n").alias("n_shingles"),
        F.col("first_doc").alias("class_id"),
        "component",
        alone.alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of ``docs``, with its columns: the one with the smallest doc_id.

    Texts without words are in no group and stay. Rows that repeat both id and text count as
    one document; null ids come last.
    """
    names = docs.columns
    groups = similar_groups(docs)
    first = F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "version")).alias("first")
    grouped = groups.filter("component IS NOT NULL").groupBy("component").agg(first).select("first.doc_id", "first.version")
    alone = groups.filter("component IS NULL").select("doc_id", "version").distinct()
    chosen = grouped.union(alone).select(F.col("doc_id").alias("of_doc"), F.col("version").alias("of_version"))
    rows = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in names)).alias("row"),
        "doc_id",
        F.xxhash64(whole_text()).alias("version"),
    )
    kept = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("version") == F.col("of_version")))
    repeats = Window.partitionBy("doc_id", "version").orderBy("version")
    return kept.withColumn("nth", F.row_number().over(repeats)).filter("nth = 1").select("row.*")
