"""Ranked lexical search: exact sparse inner products over ball trees.

A document is the sparse vector of its terms' weights, an item the vector of how often it
holds a term, and a score their inner product, an integer. Documents are dealt into cells of
similar ones by a few splits fitted on a bounded sample, and each cell into subtrees of bounded size. A
subtree is split in halves down to its leaves; every node has the centroid and the radius of
its documents, so that no score in it exceeds q*c + |q|*r, where q has only the terms that the
node's documents hold. An item visits nodes by decreasing bound and ends when the best
bound left, rounded up safely, is below its k-th score so far. Leaves are scored by exact
integers.

All documents are indexed. The sample decides how they are dealt and gives first thresholds,
which are scores of real documents; it decides nothing about results. Items are
taken in groups of bounded size, so that a group's terms may be held by every task.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtide.llm.common import LOWER, SortedHashes, Words, count_keys, flat, row_chunks, whole_text
from viewtide.session import discard, scratch_path

#: Best documents of an item, documents in a leaf, documents and vector entries in a
#: subtree, levels of splits above subtrees, sampled documents, and bytes of items in a group.
TOP, LEAF_DOCS, TREE_DOCS, TREE_ENTRIES, LEVELS, SAMPLE, ITEM_BYTES = 20, 32, 2048, 1 << 19, 5, 1024, 1 << 20
#: Bytes of text whose terms are held as arrays at once.
CHUNK = 4 << 20
#: Bounds are sums of doubles; so much they may be too small.
ROUNDING = 1e-9

#: Bytes that are in no term: ASCII other than digits and letters.
GAP = np.zeros(256, bool)
GAP[[c for c in range(128) if not chr(c).isalnum()]] = True


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of all texts' terms, and where each text's begin."""
    words = Words(LOWER[data], offsets, GAP)
    return words.hashes(), words.rows


class Items:
    """A group of items as vectors over the group's terms."""

    def __init__(self, texts: list[str | None]):
        hashes, rows = term_hashes(*flat(pa.array(texts, pa.string())))
        self.terms, at = np.unique(hashes, return_inverse=True)
        self.vectors = [np.unique(at[a:b], return_counts=True) for a, b in zip(rows[:-1], rows[1:], strict=True)]


def _vectors(terms: np.ndarray):
    """Each document's number of terms, and which of the known terms it holds how often."""

    def run(batches):
        known = SortedHashes(terms, np.arange(len(terms)))
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            counts, held, often = [], [], []
            for start, stop in row_chunks(offsets, CHUNK):
                part = offsets[start : stop + 1]
                hashes, rows = term_hashes(data[part[0] : part[-1]], part - part[0])
                at = known.find(hashes)
                row_of = np.repeat(np.arange(stop - start), np.diff(rows))
                found = np.flatnonzero(at >= 0)
                keys = row_of[found] * len(terms) + known.values[0][at[found]]
                keys, n = count_keys(keys)
                row, term = np.divmod(keys, max(1, len(terms)))
                ends = np.searchsorted(row, np.arange(stop - start + 1))
                term, n = term.astype(np.uint32), n.astype(np.uint32)
                counts.append(np.diff(rows))
                held += [term[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                often += [n[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            if batch.num_rows:
                columns = [batch.column("doc_id"), pa.array(np.concatenate(counts).astype(np.int64))]
                columns += [pa.array(held, pa.binary()), pa.array(often, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "often"])

    return run


def _holders(n_terms: int):
    """How many documents of a task hold each term."""

    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            data, _ = flat(batch.column(0))
            total += np.bincount(np.frombuffer(data.tobytes(), np.uint32), minlength=n_terms)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["term", "df"])

    return run


class Weights:
    """Numbers of the collection, and documents' vectors from them."""

    def __init__(self, n_docs: int, n_terms: int, holders: np.ndarray):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.of_term = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in holders.tolist()], np.int64)

    def values(self, n: np.ndarray, rows: np.ndarray, terms: np.ndarray, often: np.ndarray) -> np.ndarray:
        """What each entry adds to a score for each time that an item holds its term."""
        lengths = np.array([75 + 25 * k * self.n_docs // self.n_terms for k in n.tolist()], np.int64)
        often = often.astype(np.int64)
        return self.of_term[terms] * (1_000_000_000 * often // (1000 * often + 12 * np.repeat(lengths, np.diff(rows))))


class Sparse:
    """Rows of sparse vectors: row i has the entries ``rows[i]`` to ``rows[i + 1] - 1``."""

    def __init__(self, rows: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.rows, self.terms, self.values = rows, terms, values

    @classmethod
    def of(cls, weights: Weights, table) -> Sparse:
        """The vectors of Arrow rows (n, terms, often)."""
        terms, offsets = flat(table.column("terms"))
        often, _ = flat(table.column("often"))
        rows = offsets // 4
        terms = np.frombuffer(terms.tobytes(), np.uint32).astype(np.int64)
        n = table.column("n").to_numpy()
        return cls(rows, terms, weights.values(n, rows, terms, np.frombuffer(often.tobytes(), np.uint32)))

    def take(self, order: np.ndarray) -> Sparse:
        lengths = np.diff(self.rows)[order]
        rows = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(rows[-1]) + np.repeat(self.rows[:-1][order] - rows[:-1], lengths)
        return Sparse(rows, self.terms[at], self.values[at])

    def dot(self, dense: np.ndarray, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Inner products of some rows with a dense vector; exact for integers."""
        stop = len(self.rows) - 1 if stop is None else stop
        a, b = self.rows[start], self.rows[stop]
        # A closing 0 lets empty rows at the end begin there.
        products = np.append(dense[self.terms[a:b]] * self.values[a:b], dense.dtype.type(0))
        sums = np.add.reduceat(products, self.rows[start:stop] - a) if stop > start else products[:0]
        sums[np.diff(self.rows[start : stop + 1]) == 0] = 0
        return sums

    def squares(self) -> np.ndarray:
        """The squared length of each row."""
        sums = np.concatenate([[0.0], np.cumsum(self.values.astype(np.float64) ** 2)])
        return np.maximum(sums[self.rows[1:]] - sums[self.rows[:-1]], 0)

    def dense(self, row: int, size: int) -> np.ndarray:
        out = np.zeros(size)
        a, b = self.rows[row], self.rows[row + 1]
        out[self.terms[a:b]] = self.values[a:b]
        return out


def direction(vectors: Sparse, squares: np.ndarray, size: int) -> np.ndarray:
    """From one far document towards another: the line along which a node is split."""

    def farthest(row: int) -> int:
        return int((squares - 2 * vectors.dot(vectors.dense(row, size))).argmax())

    one = farthest(0)
    return vectors.dense(farthest(one), size) - vectors.dense(one, size)


def halves(vectors: Sparse, size: int, leaf_docs: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Documents in the order of a tree's leaves, and the nodes as ranges of them, parents first.

    A node of more than ``leaf_docs`` documents is split at its middle; its halves are the
    nodes that follow in pairs.
    """
    order = np.arange(len(vectors.rows) - 1)
    nodes = [(0, len(order))]
    for start, stop in nodes:
        if stop - start > leaf_docs:
            own = vectors.take(order[start:stop])
            along = own.dot(direction(own, own.squares(), size))
            order[start:stop] = order[start:stop][np.argsort(along, kind="stable")]
            middle = (start + stop) // 2
            nodes += [(start, middle), (middle, stop)]
    return order, nodes


class Tree:
    """A subtree ready for search: vectors in leaf order, and each node's centroid and radius."""

    def __init__(self, vectors: Sparse, nodes: list[tuple[int, int]], leaf_docs: int):
        known, local = np.unique(vectors.terms, return_inverse=True)
        self.known, self.vectors = known, Sparse(vectors.rows, local, vectors.values)
        self.nodes, self.children = nodes, {}
        coming = 1
        for node, (start, stop) in enumerate(nodes):
            if stop - start > leaf_docs:
                self.children[node] = (coming, coming + 1)
                coming += 2
        squares = self.vectors.squares()
        self.centroids = np.zeros((len(known), len(nodes)))
        self.radii = np.zeros(len(nodes))
        for node, (start, stop) in enumerate(nodes):
            a, b = self.vectors.rows[start], self.vectors.rows[stop]
            centre = np.bincount(local[a:b], vectors.values[a:b], len(known)) / max(1, stop - start)
            self.centroids[:, node] = centre
            length = float(centre @ centre)
            far = squares[start:stop] - 2 * self.vectors.dot(centre, start, stop) + length
            # What cancels is at most of the size of its parts.
            far += ROUNDING * (squares[start:stop] + length)
            self.radii[node] = math.sqrt(max(0.0, far.max(initial=0.0)))
        self.query = np.zeros(len(known), np.int64)

    def bounds(self, at: np.ndarray, often: np.ndarray) -> np.ndarray:
        """No document of a node scores more than this for the item's terms ``at``."""
        centres = self.centroids[at]
        length = np.sqrt((often.astype(np.float64) ** 2) @ (centres > 0))
        return (often @ centres + length * self.radii) * (1 + ROUNDING)

    def search(self, terms: np.ndarray, often: np.ndarray, threshold):
        """Yield (first document, scores) of the leaves that may reach ``threshold()``, best bound first."""
        at = np.searchsorted(self.known, terms)
        held = np.flatnonzero(at < len(self.known))
        held = held[self.known[at[held]] == terms[held]]
        if not len(held):
            return
        at, often = at[held], often[held]
        bounds = self.bounds(at, often)
        self.query[at] = often
        waiting = [(-bounds[0], 0)]
        while waiting and -waiting[0][0] >= threshold():
            _, node = heapq.heappop(waiting)
            if node in self.children:
                for child in self.children[node]:
                    heapq.heappush(waiting, (-bounds[child], child))
            else:
                start, stop = self.nodes[node]
                yield start, self.vectors.dot(self.query, start, stop)
        self.query[at] = 0


class Best:
    """The best documents of one item so far: by score, then by id with nulls last."""

    def __init__(self, top: int, floor: int = 1):
        self.top, self.floor, self.rows = top, max(1, floor), []

    def threshold(self) -> int:
        """What a document must score to matter still."""
        return self.floor

    def add(self, scores: np.ndarray, id_of) -> None:
        more = np.flatnonzero(scores >= self.floor)
        if not len(more):
            return
        if len(more) > self.top:
            # Ties with the last place stay, since ids decide among them.
            last = np.partition(scores[more], len(more) - self.top)[len(more) - self.top]
            more = more[scores[more] >= last]
        self.rows += [(-int(scores[k]), *_sortable(id_of(k))) for k in more.tolist()]
        self.rows = sorted(self.rows)[: self.top]
        if len(self.rows) == self.top:
            self.floor = max(self.floor, -self.rows[-1][0])


def _sortable(value) -> tuple:
    return (value is None, 0 if value is None else value)


class Cells:
    """Which cell a vector belongs to, by splits along a few lines."""

    def __init__(self, sample: Sparse, size: int, levels: int):
        self.lines: dict[int, tuple[np.ndarray, float]] = {}
        waiting = [(1, np.arange(len(sample.rows) - 1))]
        for node, members in waiting:
            if node < 1 << levels and len(members) > 1:
                own = sample.take(members)
                line = direction(own, own.squares(), size)
                along = own.dot(line)
                middle = float(np.median(along))
                self.lines[node] = (line.astype(np.float32), middle)
                waiting += [(2 * node, members[along <= middle]), (2 * node + 1, members[along > middle])]

    def of(self, vectors: Sparse) -> np.ndarray:
        cells = np.ones(len(vectors.rows) - 1, np.int64)
        for node, (line, middle) in self.lines.items():
            members = np.flatnonzero(cells == node)
            if len(members):
                cells[members] = 2 * node + (vectors.take(members).dot(line.astype(np.float64)) > middle)
        return cells


def _dealt(weights: Weights, cells: Cells):
    def run(batches):
        for batch in batches:
            columns = [batch.column(name) for name in batch.schema.names]
            columns.append(pa.array(cells.of(Sparse.of(weights, batch))))
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "cell"])

    return run


def _plant(weights: Weights, size: int, leaf_docs: int):
    """A group's documents as one row, in the order of their tree's leaves."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        vectors = Sparse.of(weights, table)
        order, nodes = halves(vectors, size, leaf_docs)
        vectors = vectors.take(order)
        ids = table["doc_id"].take(pa.array(order)).combine_chunks()
        ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        packed = (vectors.rows, vectors.terms.astype(np.uint32), vectors.values, np.array(nodes, np.int64))
        columns = [pa.array([part.astype(part.dtype).tobytes()], pa.binary()) for part in packed]
        return pa.Table.from_arrays([ids, *columns], ["ids", "rows", "terms", "values", "nodes"])

    return run


def _search(items: Items, floors: list[int], top: int, leaf_docs: int):
    """The best documents of a task's subtrees for each item."""

    def run(batches):
        best = [Best(top, floor) for floor in floors]
        kind = None
        for batch in batches:
            kind = batch.column(0).type.value_type
            for row in range(batch.num_rows):
                ids, rows, terms, values, nodes = (batch.column(k)[row] for k in range(5))
                parts = [np.frombuffer(x.as_buffer(), t) for x, t in ((rows, np.int64), (terms, np.uint32), (values, np.int64))]
                vectors = Sparse(parts[0], parts[1].astype(np.int64), parts[2])
                pairs = np.frombuffer(nodes.as_buffer(), np.int64).reshape(-1, 2)
                tree = Tree(vectors, [tuple(pair) for pair in pairs.tolist()], leaf_docs)
                known = ids.values
                for own, (held, often) in zip(best, items.vectors, strict=True):
                    for start, scores in tree.search(held, often, own.threshold):
                        own.add(scores, lambda k, start=start: known[start + k].as_py())
        found = [(k, -score, None if none else doc) for k, own in enumerate(best) for score, none, doc in own.rows]
        if found:
            numbers, scores, docs = zip(*found, strict=True)
            columns = [pa.array(numbers, pa.int32()), pa.array(docs, kind), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["number", "doc_id", "score"])

    return run


def _written(df: DataFrame, kind: str, paths: list[str]) -> DataFrame:
    paths.append(scratch_path(df.sparkSession, kind))
    df.write.parquet(paths[-1])
    return df.sparkSession.read.schema(df.schema).parquet(paths[-1])


def _search_group(docs: DataFrame, items: Items, top: int, leaf_docs: int, tree_docs: int, levels: int, sample: int) -> DataFrame | None:
    """(number, doc_id, score) of a group's best documents; None if no document has a term."""
    spark = docs.sparkSession
    size = len(items.terms)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    paths: list[str] = []
    schema = f"doc_id {id_type}, n long, terms binary, often binary"
    vectors = _written(docs.mapInArrow(_vectors(items.terms), schema), "vectors", paths)
    # Rows say where they lie in a stored table; a repeated task finds the same places.
    placed = vectors.withColumn("place", F.monotonically_increasing_id()).filter(F.octet_length("terms") > 0)
    totals = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    df = vectors.select("terms").mapInArrow(_holders(size), "term long, df long")
    holders = np.zeros(size, np.int64)
    # One row for each term of the group.
    for row in df.groupBy("term").agg(F.sum("df").alias("df")).collect():
        holders[row["term"]] = row["df"]
    if not holders.any():
        discard(spark, paths[0])
        return None
    weights = Weights(totals["docs"], totals["terms"], holders)
    some = placed.orderBy(F.xxhash64("place"), "place").limit(sample).select("n", "terms", "often").toArrow()
    known = Sparse.of(weights, some.combine_chunks())
    floors = []
    for held, often in items.vectors:
        query = np.zeros(size, np.int64)
        query[held] = often
        scores = np.sort(known.dot(query))
        floors.append(int(scores[-top]) if len(scores) >= top else 0)
    cells = Cells(known, size, levels)
    dealt = placed.mapInArrow(_dealt(weights, cells), f"{schema}, place long, cell long")
    weight = F.ceil(F.sum(F.octet_length("terms") / 4) / TREE_ENTRIES)
    # As many rows as there are cells.
    trees = dealt.groupBy("cell").agg(F.greatest(F.ceil(F.count(F.lit(1)) / tree_docs), weight).alias("trees")).collect()
    n_trees = F.create_map(*(F.lit(int(x)) for row in trees for x in (row["cell"], row["trees"])))
    dealt = dealt.withColumn("tree", F.pmod("place", n_trees[F.col("cell").cast("int")]))
    index = _written(
        dealt.groupBy("cell", "tree").applyInArrow(
            _plant(weights, size, leaf_docs), f"ids array<{id_type}>, rows binary, terms binary, values binary, nodes binary"
        ),
        "index",
        paths,
    )
    found = index.mapInArrow(_search(items, floors, top, leaf_docs), f"number int, doc_id {id_type}, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    result: list[str] = []
    found = _written(found, "ranked", result)
    for path in paths:
        discard(spark, path)
    return found


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    leaf_docs: int = LEAF_DOCS,
    tree_docs: int = TREE_DOCS,
    levels: int = LEVELS,
    sample: int = SAMPLE,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """The ``top`` documents of (doc_id, text) for each item of (item_id, text), by score.

    Returns (item_id, rank, doc_id, score): ranks from 1, the highest score first, equal ones
    by id, nulls last; only scores above 0, so an item without known terms has no rows, and
    neither table's being empty is an error. A null text has no terms. Rows of items that
    repeat id and text are one item; rows with one id and different texts are each ranked.
    Every row of ``docs`` is ranked, repeated ids and rows too. Other columns are ignored.
    Terms are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    id_type, item_type = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    docs = docs.select("doc_id", whole_text().alias("text"))
    items = items.select("item_id", whole_text().alias("text")).distinct()
    held = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(held / item_bytes))
    result = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")
    for group in range(groups):
        # A group of items is a part of the stated query set, of bounded size.
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == group).collect()
        vectors = Items([row["text"] for row in own])
        if not len(vectors.terms):
            continue
        found = _search_group(docs, vectors, top, leaf_docs, tree_docs, levels, sample)
        if found is not None:
            names = spark.createDataFrame([(k, row["item_id"]) for k, row in enumerate(own)], f"number int, item_id {item_type}")
            found = found.join(F.broadcast(names), "number")
            result = result.unionByName(found.select("item_id", "rank", "doc_id", "score"))
    return result
