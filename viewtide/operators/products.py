"""For each user the items of greatest inner product: exact, without multiplying all pairs.

Users are dealt into cells of similar direction. A few good items of each cell give every user a
bound that its best items reach. A cell then meets items in blocks, and only those that one of
its users may rank so high, by the angle of the cell and the length of the item, are multiplied
with them. Bounds leave out no item that belongs to a result; where they are loose, more pairs
are multiplied. A task holds a block of users and one of items.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtide.session import freed_shuffles, materialise, settings

#: Vectors of a block; users of a cell and the most cells; parts of a block that offer an item each.
BLOCK, CELL, MOST_CELLS, PARTS = 1 << 16, 64, 1 << 14, 256
#: Products that are held at once, and how far rounding may move one for vectors of length 1.
HELD, ROUNDING = 1 << 21, np.float32(1e-5)

_BLOCK = pa.schema([("ids", pa.binary()), ("vectors", pa.binary())])
_USERS = pa.schema([(name, pa.binary()) for name in ("user_ids", "users", "least", "starts", "centres", "reach", "floor")])
_FOUND = pa.schema([("user", pa.int32()), ("item", pa.int32()), ("rating", pa.float32())])


def _floats(data: bytes, rank: int) -> np.ndarray:
    return np.frombuffer(data, np.float32).reshape(-1, rank)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


def _directions(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; a zero vector stays."""
    lengths = _lengths(vectors)
    return vectors / np.where(lengths > 0, lengths, 1)[:, None].astype(np.float32)


def _stacked(batches, rank: int, most: int):
    """Columns of at most ``most`` rows each, from batches of any size; vectors become arrays."""
    held, rows = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            part = batch.slice(start, most)
            if rows and rows + part.num_rows > most:
                yield [np.concatenate(column) for column in zip(*held, strict=True)]
                held, rows = [], 0
            vectors = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, rank)
            others = [part.column(k).to_numpy(zero_copy_only=False) for k in range(part.num_columns) if k != 1]
            held.append([others[0].astype(np.int32), vectors, *others[1:]])
            rows += part.num_rows
    if rows:
        yield [np.concatenate(column) for column in zip(*held, strict=True)]


def _steps(rows: int, width: int):
    """Runs of rows whose products with ``width`` others are held at once."""
    step = max(1, HELD // max(1, width))
    return ((start, min(start + step, rows)) for start in range(0, rows, step))


def _blocks(items: DataFrame, rank: int) -> DataFrame:
    def pack(batches):
        for ids, vectors in _stacked(batches, rank, BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (ids, vectors)], schema=_BLOCK)

    return materialise(items.mapInArrow(pack, "ids binary, vectors binary"), "items")


def _offers(scores: np.ndarray, wanted: int) -> np.ndarray:
    """Places of high scores in each row: the best of each of the best parts."""
    width = max(1, scores.shape[1] // PARTS)
    whole = scores.shape[1] // width
    parts = scores[:, : whole * width].reshape(len(scores), whole, width)
    tops = parts.max(2)
    best = np.argpartition(tops, whole - min(wanted, whole), 1)[:, -min(wanted, whole):]
    row = np.arange(len(scores))[:, None]
    return best * width + parts[row, best].argmax(2)


def _probes(blocks: DataFrame, centres: np.ndarray, rank: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """A few items of high product with each centre: their vectors, and where each centre's begin."""

    def offer(batches):
        scores = vectors = None
        for batch in batches:
            for data in batch.column(1):
                items = _floats(data.as_py(), rank)
                found = []
                for a, b in _steps(len(centres), len(items)):
                    products = centres[a:b] @ items.T
                    at = _offers(products, wanted)
                    found.append((np.take_along_axis(products, at, 1), items[at]))
                new = [np.concatenate(x) for x in zip(*found, strict=True)]
                if scores is not None:
                    new = [np.concatenate([old, x], 1) for old, x in zip((scores, vectors), new, strict=True)]
                scores, vectors = new
                if scores.shape[1] > wanted:
                    best = np.argpartition(scores, scores.shape[1] - wanted, 1)[:, -wanted:]
                    row = np.arange(len(scores))[:, None]
                    scores, vectors = scores[row, best], vectors[row, best]
        if scores is not None:
            each = scores.shape[1]
            for a, b in _steps(len(scores), each * rank):
                cells = np.repeat(np.arange(a, b, dtype=np.int32), each)
                rows = [v.tobytes() for v in vectors[a:b].reshape(-1, rank)]
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(scores[a:b].ravel()), pa.array(rows, pa.binary())], ["cell", "score", "vector"])

    first = Window.partitionBy("cell").orderBy(F.desc("score"))
    offered = blocks.mapInArrow(offer, "cell int, score float, vector binary").withColumn("at", F.row_number().over(first))
    table = offered.filter(F.col("at") <= wanted).select("cell", "vector").toArrow()
    cells = table.column("cell").to_numpy()
    order = np.argsort(cells, kind="stable")
    vectors = _floats(b"".join(table.column("vector").to_pylist()), rank)[order]
    return vectors, np.searchsorted(cells[order], np.arange(len(centres) + 1))


def _placed(users: DataFrame, centres: np.ndarray, rank: int) -> DataFrame:
    """Users with the cell of the centre that they point to most."""

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, rank)
            directions = _directions(vectors)
            cells = [(directions[a:b] @ centres.T).argmax(1) for a, b in _steps(len(directions), len(centres))]
            cell = pa.array(np.concatenate(cells).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cell], ["id", "features", "cell"])

    return materialise(users.mapInArrow(place, "id int, features array<float>, cell int"), "placed")


def _user_blocks(placed: DataFrame, probes: np.ndarray, begins: np.ndarray, rank: int, n: int, partitions: int) -> DataFrame:
    """Users in blocks, cell by cell, with what each of them and each cell needs an item to reach."""

    def pack(batches):
        for ids, vectors, cells in _stacked(batches, rank, BLOCK):
            starts = np.flatnonzero(np.diff(cells, prepend=-1)).astype(np.int32)
            directions, lengths = _directions(vectors), _lengths(vectors)
            least = np.full(len(ids), -np.inf, np.float32)
            centres, reach, floor = [], [], []
            for a, b in zip(starts, [*starts[1:], len(ids)], strict=True):
                own = probes[begins[cells[a]] : begins[cells[a] + 1]]
                if len(own) >= n:
                    slack = ROUNDING * _lengths(own).max()
                    for s, e in _steps(b - a, len(own)):
                        products = vectors[a + s : a + e] @ own.T
                        least[a + s : a + e] = np.partition(products, -n, 1)[:, -n] - slack * lengths[a + s : a + e]
                centre = directions[a:b].mean(0)
                centres.append(centre)
                reach.append(_lengths(directions[a:b] - centre).max() + 2 * ROUNDING)
                with np.errstate(divide="ignore", invalid="ignore"):
                    floor.append(np.where(lengths[a:b] > 0, least[a:b] / lengths[a:b], -np.inf).min())
            found = (ids, vectors, least, np.append(starts, len(ids)).astype(np.int32), *(np.asarray(x, np.float32) for x in (centres, reach, floor)))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in found], schema=_USERS)

    dealt = placed.repartitionByRange(partitions, "cell").sortWithinPartitions("cell")
    return materialise(dealt.mapInArrow(pack, ", ".join(f"{name} binary" for name in _USERS.names)), "users")


def _best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores of each row, of equal ones those of higher ids."""
    order = np.lexsort((-ids.astype(np.int64), -scores, rows))
    begins = np.flatnonzero(np.diff(rows[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    return order[rank < n]


def _meet(users: dict[str, bytes], ids: np.ndarray, items: np.ndarray, rank: int, n: int):
    """The items of a block that may be among the ``n`` best of a user of a block."""
    vectors, centres = _floats(users["users"], rank), _floats(users["centres"], rank)
    least, reach, floor = (np.frombuffer(users[name], np.float32) for name in ("least", "reach", "floor"))
    user_ids, starts = (np.frombuffer(users[name], np.int32) for name in ("user_ids", "starts"))
    lengths = _lengths(items)
    for c0, c1 in _steps(len(centres), len(items)):
        high = centres[c0:c1] @ items.T
        high += reach[c0:c1, None] * lengths
        may = high >= floor[c0:c1, None]
        for cell in np.flatnonzero(may.any(1)):
            near = np.flatnonzero(may[cell])
            own, own_ids = items[near], ids[near]
            begin, end = starts[c0 + cell], starts[c0 + cell + 1]
            for a, b in _steps(end - begin, len(near)):
                a, b = begin + a, begin + b
                products = vectors[a:b] @ own.T
                at = np.flatnonzero(products >= least[a:b, None])
                if len(at):
                    row, column = np.divmod(at, len(near))
                    scores, found = products.ravel()[at], own_ids[column]
                    best = _best(row, found, scores, n)
                    yield user_ids[a + row[best]], found[best], scores[best]


def best_items(users: DataFrame, items: DataFrame, rank: int, n: int) -> DataFrame:
    """Rows (``user``, ``best``): the ``n`` items of greatest product, highest first, of equal ones
    those of higher ids first, as an array of (``rating``, ``item``).

    ``users`` and ``items`` have an int ``id`` and ``features``, an array of ``rank`` floats. The
    cells' centres, and a few items for each, pass through the driver.
    """
    spark = users.sparkSession
    users, items = (side.select("id", "features") for side in (users, items))
    with freed_shuffles(spark):
        blocks = _blocks(items, rank)
        cells = max(1, min(MOST_CELLS, users.count() // CELL))
        spread = users.orderBy(F.xxhash64("id")).limit(cells).select("features").toArrow()
        centres = _directions(spread.column(0).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, rank))
        probes, begins = _probes(blocks, centres, rank, n + 11)
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = _user_blocks(_placed(users, centres, rank), probes, begins, rank, n, partitions)

        def meet(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    ids, vectors = np.frombuffer(row["ids"], np.int32), _floats(row["vectors"], rank)
                    for found in _meet(row, ids, vectors, rank, n):
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], schema=_FOUND)

        # A row is a pair of blocks; more than one in a batch would only take memory.
        with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}):
            found = dealt.crossJoin(blocks).mapInArrow(meet, "user int, item int, rating float")
            found = materialise(found, "found")
    high = F.sort_array(F.collect_list(F.struct("rating", "item")), asc=False)
    return found.groupBy("user").agg(F.slice(high, 1, n).alias("best"))
