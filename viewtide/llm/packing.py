"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

Every lane (a hash-dealt set of items, bounded in number) packs its items best-fit in
decreasing order. Bins that are nearly full are final; the others go on, as items, to a
round with fewer lanes, until one lane is left or a round no longer joins bins. Each
round is written before the next one reads it, and a lane's order depends on its rows
alone, so that a repeated task gives the same bins.
"""

from __future__ import annotations

import math
import os
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.llm.common import LOWER, flat, row_chunks, whole_text
from viewtide.session import materialise

#: Tokens in a sequence, items in a lane, lanes joined into one, and the free tokens up to
#: which a bin counts as nearly full.
CAPACITY, LANE_ITEMS, FAN_IN, SLACK = 2048, 20_000, 8, 8
#: Words that a worker remembers with their ids.
REMEMBERED = 600_000

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
#: ASCII punctuation other than the apostrophe, which belongs to contractions.
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True

_TOKENIZERS: dict[str, Tokenize] = {}


class Tokenize:
    """Ids of texts, as little-endian unsigned 32-bit numbers, remembering words.

    The tokenizer drops white space, lower-cases, and never joins a letter with a mark, so a
    text's ids are those of its parts. Texts that name a special token go to it whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.ids: dict[bytes, bytes] = {}

    @classmethod
    def at(cls, path: str) -> Tokenize:
        return _TOKENIZERS.get(path) or _TOKENIZERS.setdefault(path, cls(path))

    def encode(self, parts: list[bytes]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast([part.decode() for part in parts], add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in got]

    def plain(self, parts: list[bytes]) -> list[bytes]:
        """Words of ASCII letters alone need no normalising and no splitting."""
        tokenize = self.tokenizer.model.tokenize
        return [np.array([t.id for t in tokenize(part.decode())], "<u4").tobytes() for part in parts]

    def learn(self, parts: set[bytes]) -> None:
        plain = [part for part in parts if part.isalpha()]
        other = [part for part in parts if not part.isalpha()]
        self.ids.update(zip(plain, self.plain(plain), strict=True))
        self.ids.update(zip(other, self.encode(other), strict=True))

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The ids of each text of one chunk."""
        whole, lower = data.tobytes(), LOWER[data]
        marked = np.flatnonzero(_LETTER[lower[:-1]] & _MARK[lower[1:]]) + 1
        # A text's first byte may follow another text's last one; a space between does no harm.
        spaced = np.insert(lower, marked, 32).tobytes()
        moved = offsets + np.searchsorted(marked, offsets, "right")
        texts = [spaced[a:b] for a, b in zip(moved[:-1], moved[1:], strict=True)]
        split = [text.split() for text in texts]
        new = {part for parts in split for part in parts if part not in self.ids}
        if len(self.ids) + len(new) > REMEMBERED:
            self.ids.clear()
            new = {part for parts in split for part in parts}
        self.learn(new)
        out = []
        for row, parts in enumerate(split):
            raw = whole[offsets[row] : offsets[row + 1]]
            if any(token in raw for token in self.special):
                out.append(self.encode([raw])[0])
            else:
                out.append(b"".join([self.ids[part] for part in parts]))
        return out


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32) of ``docs``; ``ids`` too where asked for.

    A document is its ids and a closing 0; only one longer than ``capacity`` is cut. A null
    text is empty: one piece of length 1. Repeated rows and ids each give their own pieces.
    """
    docs = docs.select("doc_id", whole_text().alias("text"))
    end = np.zeros(1, "<u4").tobytes()
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids

    def pieces(batches):
        encode = Tokenize.at(tokenizer_path)
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for first, last in row_chunks(offsets, 4 << 20):
                part = offsets[first : last + 1]
                for row, text_ids in enumerate(encode(data[part[0] : part[-1]], part - part[0]), first):
                    held = memoryview(text_ids + end)
                    for k, at in enumerate(range(0, len(held), 4 * capacity)):
                        own = held[at : at + 4 * capacity]
                        rows.append(row)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        if keep_ids:
                            ids.append(bytes(own))
            made = [
                batch.column("doc_id").take(pa.array(rows, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ] + [pa.array(ids, pa.binary())] * keep_ids
            yield pa.RecordBatch.from_arrays(made, ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)
        # The worker may go on to other work, and should not hold the words meanwhile.
        encode.ids.clear()

    return docs.mapInArrow(pieces, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each item and its place there; items come in the order given.

    Open bins are kept by free room; a bit mask of the rooms in use finds the tightest.
    """
    bins, places = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n_bins = 0, 0
    for i, size in enumerate(sizes.tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, own, n_bins = capacity, n_bins, n_bins + 1
        bins[i], places[i] = own, capacity - room
        left = room - size
        if left:
            open_bins[left].append(own)
            rooms |= 1 << left
    return bins, places


def _pack_lane(capacity: int, round_no: int):
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([(name, "ascending") for name in ("doc_id", "piece", "ids_crc32", "length", "sequence_id")])
        lane = table["lane"][0].as_py()
        unit, at = np.unique(table["sequence_id"].to_numpy(), return_inverse=True)
        fills = np.zeros(len(unit), np.int64)
        fills[at] = table["fill"].to_numpy()
        first = np.full(len(unit), len(at))
        np.minimum.at(first, at, np.arange(len(at)))
        order = np.lexsort((first, -fills))
        bins, places = np.empty(len(unit), np.int64), np.empty(len(unit), np.int64)
        bins[order], places[order] = best_fit(fills[order], capacity)
        full = np.bincount(bins, fills).astype(np.int64)
        made = {
            "sequence_id": (round_no << 58) + (lane << 26) + bins[at],
            "offset": table["offset"].to_numpy() + places[at],
            "fill": full[bins[at]],
        }
        for name, values in made.items():
            table = table.set_column(table.schema.get_field_index(name), name, pa.array(values))
        return table

    return pack


def pack_pieces(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    lane_items: int = LANE_ITEMS,
    fan_in: int = FAN_IN,
    slack: int = SLACK,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    Every row comes back once; an empty input gives an empty result.
    """
    lanes = max(1, math.ceil(pieces.count() / lane_items))
    spread = F.xxhash64("doc_id", "piece", "ids_crc32")
    rest = pieces.select(
        "*",
        F.pmod(spread, F.lit(lanes)).alias("lane"),
        # Items of equal key and length may share a number only if they are one item.
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.col("length").alias("fill"),
    )
    done: list[DataFrame] = []
    before = None
    for round_no in range(32):
        packed = materialise(
            rest.groupBy("lane").applyInArrow(_pack_lane(capacity, round_no + 1), rest.schema), "packed"
        )
        full = F.col("fill") >= capacity - slack
        open_bins = packed.filter(~full & (F.col("offset") == 0)).count()
        if lanes == 1 or not open_bins or (before is not None and open_bins > 0.98 * before):
            done.append(packed)
            break
        done.append(packed.filter(full))
        fewer = max(math.ceil(lanes / fan_in), math.ceil(open_bins / lane_items))
        rest = packed.filter(~full).withColumn("lane", F.pmod("lane", F.lit(fewer)))
        lanes, before = fewer, open_bins
    packed = reduce(DataFrame.unionByName, done)
    return packed.drop("lane", "fill")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = False, **sizes) -> DataFrame:
    """Tokenise ``docs`` and pack the pieces; see :func:`tokenized_pieces` and :func:`pack_pieces`."""
    pieces = materialise(tokenized_pieces(docs, tokenizer_path, capacity, keep_ids), "pieces")
    return pack_pieces(pieces, capacity, **sizes)
