"""Vector code compression: product codebooks of integer vectors, refined under norm-of-sum bounds.

Vectors are cut into equal parts, and each part position has a codebook that Lloyd rounds
refine. A part keeps an upper bound of the distance to its own entry and a lower bound of the
distance to every other, each with the round in which it was exact. The codebooks of all
rounds are retained (their size does not depend on the data), so a bound is carried over
several rounds by the true net displacement of the entries since its stamp, the norm of the
summed moves, and not by the sum of the moves' norms, which is never smaller. Where the
bounds cannot part the entries, the own distance is computed, and only then all of them.

Distances are exact integers, bounds are rounded outwards, and entries are told apart by
strict inequality only, so the codes are those of the exact rounds, ties included.

Blocks of vectors stay in their partition with their bounds: a round reads the blocks, writes
them again, and adds up how the sums of entries changed. No vector is shuffled.
"""

from __future__ import annotations

import math
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.session import discard, scratch_path

#: Parts of a vector, entries of a codebook, rounds of refinement, and integer steps in 1.
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096


def finite(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there and has finite components only."""
    small = F.forall(column, lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)))
    return vectors.filter(F.col(column).isNotNull() & small)


def whole_numbers(column: pa.Array, parts: int, width: int, scale: int) -> np.ndarray:
    """A column of lists as integers, one row each, with zeros behind shorter lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    values = np.floor(np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64) * scale)
    dims = parts * width
    if len(lengths) and (lengths == dims).all():
        return values.reshape(len(lengths), dims).astype(np.int64)
    out = np.zeros((len(lengths), dims), np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    places = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = values
    return out


class Bounds:
    """What a block keeps between rounds: codes, bounds and the rounds they were exact in."""

    def __init__(self, codes, upper, lower, upper_round, lower_round):
        self.codes, self.upper, self.lower = codes, upper, lower
        self.upper_round, self.lower_round = upper_round, lower_round

    @classmethod
    def fresh(cls, n: int, parts: int) -> Bounds:
        small, wide = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.float32)
        return cls(small, wide + np.inf, wide, small.copy(), small.copy())

    def packed(self) -> tuple[bytes, bytes]:
        small = np.stack([self.codes, self.upper_round, self.lower_round])
        return small.tobytes(), np.stack([self.upper, self.lower]).tobytes()

    @classmethod
    def unpacked(cls, small: bytes, wide: bytes, parts: int) -> Bounds:
        codes, upper_round, lower_round = np.frombuffer(small, np.uint8).reshape(3, -1, parts).copy()
        upper, lower = np.frombuffer(wide, np.float32).reshape(2, -1, parts).copy()
        return cls(codes, upper, lower, upper_round, lower_round)


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


class Codebooks:
    """The codebooks of all rounds, ``rounds x parts x entries x width``, as exact numbers.

    ``kind`` is float64 where every squared distance is below 2**53 (sums of products are
    then exact too), and int64 otherwise.
    """

    def __init__(self, history: np.ndarray, kind: type):
        self.history = history.astype(kind)
        self.kind, self.now = kind, len(history) - 1
        moved = history[-1].astype(np.float64) - history.astype(np.float64)
        #: How far each entry is from where it was at each earlier round; rounded up.
        self.moved = np.sqrt((moved**2).sum(axis=3)) * (1 + 1e-12)
        entries = history.shape[2]
        self.others = np.zeros_like(self.moved)
        for j in range(entries if entries > 1 else 0):
            self.others[:, :, j] = np.delete(self.moved, j, axis=2).max(axis=2)

    def to_own(self, part: int, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Exact squared distances to the entries of ``codes``."""
        return ((x - self.history[-1, part][codes]) ** 2).sum(axis=1)

    def to_all(self, part: int, x: np.ndarray) -> np.ndarray:
        """Exact squared distances to all entries."""
        c = self.history[-1, part]
        return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)

    def assign(self, part: int, x: np.ndarray, kept: Bounds, first: bool) -> tuple[int, int]:
        """Bring one part's codes and bounds to this round; how many were tightened and rescanned."""
        codes = kept.codes[:, part]
        if first:
            open_rows = np.arange(len(x))
            tightened = 0
        else:
            own = kept.upper_round[:, part]
            upper = kept.upper[:, part] + self.moved[own, part, codes]
            lower = kept.lower[:, part] - self.others[kept.lower_round[:, part], part, codes]
            open_rows = np.flatnonzero(~(upper < lower))
            tightened = len(open_rows)
            exact = _up(np.sqrt(self.to_own(part, x[open_rows], codes[open_rows]).astype(np.float64)) * (1 + 1e-12))
            kept.upper[open_rows, part] = exact
            kept.upper_round[open_rows, part] = self.now
            open_rows = open_rows[~(exact < lower[open_rows])]
        if len(open_rows):
            squares = self.to_all(part, x[open_rows])
            best = squares.argmin(axis=1)
            rows = np.arange(len(open_rows))
            least = squares[rows, best].astype(np.float64)
            kept.codes[open_rows, part] = best
            kept.upper[open_rows, part] = _up(np.sqrt(least) * (1 + 1e-12))
            second = np.full(len(open_rows), np.inf)
            if squares.shape[1] > 1:
                second = np.partition(squares, 1, axis=1)[:, 1].astype(np.float64)
            kept.lower[open_rows, part] = _down(np.sqrt(second) * (1 - 1e-12))
            kept.upper_round[open_rows, part] = kept.lower_round[open_rows, part] = self.now
        return tightened, len(open_rows)


def step(books: Codebooks, vectors: np.ndarray, kept: Bounds, first: bool) -> np.ndarray:
    """One round for a block; how the entries' sums (and, last, their counts) changed."""
    parts, entries, width = books.history.shape[1:]
    split = vectors.reshape(len(vectors), parts, width)
    changed = np.zeros((parts, entries, width + 1), np.int64)
    for part in range(parts):
        before = kept.codes[:, part].copy()
        own = split[:, part]
        books.assign(part, own.astype(books.kind), kept, first)
        after = kept.codes[:, part]
        counted = np.concatenate([own, np.ones((len(own), 1), np.int64)], axis=1)
        if first:
            np.add.at(changed[part], after, counted)
        else:
            went = np.flatnonzero(after != before)
            np.add.at(changed[part], after[went], counted[went])
            np.subtract.at(changed[part], before[went], counted[went])
    return changed


def _listed(column: pa.Array, n: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), column)


def _first_round(books: Codebooks, stored: type, scale: int):
    parts, _, width = books.history.shape[1:]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = whole_numbers(batch.column(2), parts, width, scale)
            kept = Bounds.fresh(len(vectors), parts)
            changed = step(books, vectors, kept, True)
            ids, labels = (_listed(batch.column(k), len(vectors)) for k in (0, 1))
            yield _block(ids, labels, vectors.astype(stored).tobytes(), kept, changed)

    return run


def _block(ids, labels, vectors: bytes, kept: Bounds, changed: np.ndarray) -> pa.RecordBatch:
    small, wide = kept.packed()
    columns = [ids, labels] + [pa.array([x], pa.binary()) for x in (vectors, small, wide)]
    columns.append(pa.array([changed.ravel().tolist()], pa.list_(pa.int64())))
    return pa.RecordBatch.from_arrays(columns, ["ids", "labels", "vectors", "small", "wide", "changed"])


def _blocks_of(batches, parts: int, width: int, stored: type):
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            ids, labels, vectors, small, wide = (one.column(k) for k in range(5))
            own = np.frombuffer(vectors[0].as_buffer(), stored).astype(np.int64)
            kept = Bounds.unpacked(small[0].as_py(), wide[0].as_py(), parts)
            yield ids, labels, vectors, own.reshape(len(kept.codes), parts * width), kept


def _next_round(books: Codebooks, stored: type):
    parts, _, width = books.history.shape[1:]

    def run(batches):
        for ids, labels, raw, vectors, kept in _blocks_of(batches, parts, width, stored):
            changed = step(books, vectors, kept, False)
            yield _block(ids, labels, raw[0].as_py(), kept, changed)

    return run


def _last_round(books: Codebooks, stored: type):
    parts, _, width = books.history.shape[1:]

    def run(batches):
        for ids, labels, _, vectors, kept in _blocks_of(batches, parts, width, stored):
            step(books, vectors, kept, False)
            split = vectors.reshape(len(vectors), parts, width).astype(books.kind)
            errors = sum(books.to_own(p, split[:, p], kept.codes[:, p]).astype(np.int64) for p in range(parts))
            digits = np.ascontiguousarray(kept.codes).tobytes().hex()
            codes = [digits[k : k + 2 * parts] for k in range(0, len(digits), 2 * parts)]
            columns = [ids.flatten(), labels.flatten(), pa.array(codes, pa.string()), pa.array(errors)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return run


def refined(before: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Entries as the floored means of their parts; entries without parts stay."""
    counts = totals[:, :, -1:]
    means = totals[:, :, :-1] // np.maximum(counts, 1)
    return np.where(counts > 0, means, before)


def numeric_kind(most: float, parts: int, width: int, scale: int) -> type:
    """Numbers in which all squared distances are exact; an error where not even longs hold them."""
    reach = 2 * (int(most * scale) + 2)
    if width * reach**2 < 1 << 52:
        return np.float64
    if parts * width * reach**2 < 1 << 62:
        return np.int64
    raise ValueError(f"components as large as {most} have squared errors beyond a long")


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """Codes of the rows of ``vectors`` (vec_id, embedding, label), and the last codebooks.

    The frame has (vec_id, label, code, error): the parts' entries as two hexadecimal digits
    each, and the squared distance of the integer vector from them. Rows whose vector is null
    or has a null or non-finite component are left out. Every other row gives one row, so
    repeated ids stay. The first codebooks come from the rows with the smallest ids (null ids
    last, ties by the vector); fewer rows make fewer entries. Where the longest vector does not divide
    into the parts, or others are shorter, zeros follow. An empty table gives an empty one and
    codebooks without entries. Other columns are ignored. Components whose squared errors
    exceed 64 bits are an error.
    """
    spark = vectors.sparkSession
    kept = finite(vectors.select("vec_id", "label", "embedding"))
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()
    id_type, label_type = (vectors.schema[name].dataType.simpleString() for name in ("vec_id", "label"))
    if not first:
        none = spark.createDataFrame([], f"vec_id {id_type}, label {label_type}, code string, error long")
        return none, np.zeros((parts, 0, 0), np.int64)
    size = F.max(F.size("embedding")).alias("size")
    most = F.max(F.coalesce(F.array_max(F.transform("embedding", F.abs)), F.lit(0))).alias("most")
    stats = kept.agg(size, most).first()
    width = math.ceil(stats["size"] / parts)
    kind = numeric_kind(stats["most"], parts, width, scale)
    reach = int(stats["most"] * scale) + 2
    stored = np.int16 if reach < 1 << 15 else np.int32 if reach < 1 << 31 else np.int64

    lists = pa.array([row["embedding"] for row in first], pa.list_(pa.float64()))
    start = whole_numbers(lists, parts, width, scale).reshape(len(first), parts, width).transpose(1, 0, 2)
    history = start[None]
    totals = np.zeros((parts, len(first), width + 1), np.int64)
    schema = f"ids array<{id_type}>, labels array<{label_type}>, vectors binary, small binary, wide binary, changed array<long>"
    table, path = kept, None
    for number in range(rounds):
        books = Codebooks(history, kind)
        run = _next_round(books, stored) if number else _first_round(books, stored, scale)
        written = scratch_path(spark, f"codes-{number}")
        table.mapInArrow(run, schema).write.parquet(written)
        if path:
            discard(spark, path)
        table, path = spark.read.schema(schema).parquet(written), written
        # One row for each number of the codebooks, whatever the number of vectors.
        moved = table.select(F.posexplode("changed").alias("at", "by")).groupBy("at").agg(F.sum("by").alias("by"))
        for row in moved.collect():
            totals.ravel()[row["at"]] += row["by"]
        history = np.concatenate([history, refined(history[-1], totals)[None]])
    books = Codebooks(history, kind)
    if not rounds:
        table = table.mapInArrow(_first_round(books, stored, scale), schema)
    coded = scratch_path(spark, "codes")
    result = f"vec_id {id_type}, label {label_type}, code string, error long"
    table.mapInArrow(_last_round(books, stored), result).write.parquet(coded)
    if path:
        discard(spark, path)
    return spark.read.schema(result).parquet(coded), history[-1]


def digest(codebooks: np.ndarray) -> str:
    """The SHA-256 of all components, by part, entry and place."""
    return sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Add ``label_error``: the errors of all rows with an equal label; nulls are equal."""
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
