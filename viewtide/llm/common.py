"""Shared pieces: reading documents, sizing blocks, and texts as byte arrays."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import math
import time

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII lower case for single bytes; UTF-8's other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: The ASCII white space that separates words: space and \x09-\x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def text_blocks(docs: DataFrame, block_bytes: int) -> int:
    """How many blocks of about ``block_bytes`` the texts fill; one scan, no shuffle."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, math.ceil(total / block_bytes))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A string column as its UTF-8 bytes and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, most: int):
    """Row ranges of at most ``most`` bytes, one row at least, so that work arrays stay small."""
    start = 0
    while start < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        stop = max(stop, start + 1)
        yield start, stop
        start = stop


def rows_by_language(column: pa.Array) -> list[tuple[str | None, np.ndarray]]:
    """The rows of each language of a column, null among them."""
    coded = column.dictionary_encode()
    codes = np.asarray(coded.indices.fill_null(-1))
    names = coded.dictionary.to_pylist()
    return [(names[c] if c >= 0 else None, np.flatnonzero(codes == c)) for c in np.unique(codes)]


def smaller_batches(batches, most: int, column: str = "text"):
    """The same rows in batches of at most ``most`` bytes of text, one row at least."""
    for batch in batches:
        _, offsets = flat(batch.column(column))
        for start, stop in row_chunks(offsets, most):
            yield batch.slice(start, stop - start)


def give_back() -> None:
    """Return freed memory to the system; an idle Python worker otherwise keeps its peak."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that are no longer in use.

    It does so when the driver's collectors have found the plans, which may otherwise be
    long after a stage that filled the disks.
    """
    # Python gives up its plans in a thread of its own, a moment after they are collected.
    gc.collect()
    time.sleep(0.5)
    spark.sparkContext._jvm.System.gc()


def frugal(run):
    """A ``mapInArrow`` function whose worker keeps no freed memory when its task has ended."""

    def watched(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return watched


def sum_by_key(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of values of each."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(values, first)


def count_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.diff(np.append(first, len(keys)))


#: An odd multiplier for polynomial word hashes, and the multipliers of the final mixing.
BASE, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the power 0, 1, ... modulo 2**64, and the inverses."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        down = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, base in (("up", BASE), ("down", down)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all others; one to one."""
    h = (h ^ (h >> np.uint64(30))) * MIX1
    h = (h ^ (h >> np.uint64(27))) * MIX2
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of a run of texts: byte places in ``data`` and the words before each row.

    Words are runs of bytes other than ASCII white space, or than the bytes marked in ``gap``,
    of which the space must be one. ``rows`` has one entry more than there are texts: text i
    has the words ``rows[i]`` to ``rows[i + 1] - 1``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE):
        held = memoryview(np.ascontiguousarray(data))
        parts = [held[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        self.data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
        self.text_start = offsets + np.arange(len(offsets))
        inside = ~gap[self.data]
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        self.start, self.end = edges[0::2], edges[1::2]
        self.rows = np.searchsorted(self.start, self.text_start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        up, down = powers(len(self.data))
        sums = np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)
        before = np.where(self.start > 0, sums[self.start - 1], np.uint64(0))
        return mix((sums[self.end - 1] - before) * down[self.start])


def sums_by_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of ``values[rows[i]:rows[i + 1]]`` for each i; 0 for an empty range."""
    out = np.zeros(len(rows) - 1, values.dtype if values.dtype.kind == "f" else np.int64)
    full = np.flatnonzero(np.diff(rows))
    if len(full):
        out[full] = np.add.reduceat(values, rows[:-1][full])
    return out


class SortedHashes:
    """Values by 64-bit key: hashes in order, with a directory of where each leading part begins."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        hashes = mix(keys)
        order = np.argsort(hashes)
        # A last entry that no search passes, and that nothing matches unless it is a key.
        self.hashes = np.append(hashes[order], np.uint64(2**64 - 1))
        self.values = [np.append(v[order], v[:1] if len(v) else np.zeros(1, v.dtype)) for v in values]
        self.size = len(keys)
        bits = max(1, int(self.size).bit_length())
        self.shift = np.uint64(64 - bits)
        parts = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.begin = np.searchsorted(self.hashes[:-1], parts).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is unknown."""
        hashes = mix(keys)
        at = self.begin[hashes >> self.shift]
        here = self.hashes[at]
        late = np.flatnonzero(here < hashes)
        while len(late):
            at[late] += 1
            here[late] = self.hashes[at[late]]
            late = late[here[late] < hashes[late]]
        at[(here != hashes) | (at >= self.size)] = -1
        return at


def word_windows(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of ``size`` words within one text: their hash, first word and text."""
    text_of = np.repeat(np.arange(len(words.rows) - 1), np.diff(words.rows))
    n = max(0, len(hashes) - size + 1)
    within = np.flatnonzero(text_of[:n] == text_of[len(text_of) - n :])
    total = np.zeros(len(within), np.uint64)
    for k in range(size):
        total = (total + hashes[within + k]) * BASE
        total ^= total >> np.uint64(29)
    return mix(total), within, text_of[within]
