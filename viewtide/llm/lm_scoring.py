"""LM scoring by context-tree weighting over bytes.

Texts meet the model block by block: a block is a hash-dealt set of whole documents of
bounded size. Each block lists its distinct words and grams with their training counts;
those lists (words by 64-bit hashes) are joined with corpus-wide values and return to the block, where the texts
are scored. What is shuffled are the distinct keys of each block and the texts, and no
model is collected or broadcast: only the shortest contexts (one byte at most, 65,536
nodes whatever the corpus) pass through the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtide.llm import ctw
from viewtide.llm.common import (
    LOWER,
    SortedHashes,
    Words,
    count_keys,
    drop_shuffles,
    flat,
    give_back,
    row_chunks,
    sum_by_key,
    sums_by_row,
    text_blocks,
    whole_text,
)
from viewtide.session import materialise

#: Bytes of preceding text in the longest contexts, and of text in a block.
DEPTH, BLOCK_BYTES = 5, 16 << 20
#: Bytes of text whose grams are held as arrays at once.
CHUNK = 1 << 20
#: Writer options by which keys in order are kept as differences.
DELTAS = {"parquet__writer__version": "v2"}
#: Counted keys that wait before they are added up.
WAITING = 1 << 19


def _added_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return sum_by_key(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _count_block(depth: int):
    def count(table: pa.Table) -> pa.Table:
        data, offsets = flat(table["text"])
        train = ~np.asarray(table["held_out"].to_numpy(zero_copy_only=False), bool)
        found: dict[bool, list] = {True: [], False: []}
        for start, stop in row_chunks(offsets, CHUNK):
            part = offsets[start : stop + 1]
            own = LOWER[data[part[0] : part[-1]]]
            words = Words(own, part - part[0])
            grams, at = ctw.grams_of(own, part - part[0], depth)
            for is_word, keys, rows in ((True, words.hashes(), words.rows), (False, grams, at)):
                learns = np.repeat(train[start:stop], np.diff(rows))
                for chosen, weight in ((keys[learns], 1), (keys[~learns], 0)):
                    k, n = count_keys(chosen)
                    found[is_word].append((k, n * weight))
                if sum(len(k) for k, _ in found[is_word]) > len(found[is_word][0][0]) + WAITING:
                    found[is_word] = [_added_up(found[is_word])]
        rows = []
        for is_word, parts in found.items():
            keys, counts = _added_up(parts)
            rows.append(
                pa.table(
                    {
                        "block": pa.array(np.full(len(keys), table["block"][0].as_py(), np.int32)),
                        "is_word": pa.array(np.full(len(keys), is_word)),
                        "key": pa.array(keys.view(np.int64)),
                        "n": pa.array(counts),
                    }
                )
            )
        del data, offsets, found, parts, keys, counts
        give_back()
        return pa.concat_tables(rows)

    return count


def _subtree(depth: int):
    """Bits mixed over contexts of two bytes or more, for all grams that share their last two.

    The rows of a group are distinct grams, bounded by the alphabet and not by the corpus.
    """

    def mix(table: pa.Table) -> pa.Table:
        grams = table["gram"].to_numpy().astype(np.uint64)
        counts = table["n"].to_numpy()
        order = np.argsort(grams)
        grams, counts = grams[order], counts[order]
        seen = counts > 0
        if seen.any():
            levels = ctw.levels_of(grams[seen], counts[seen], depth, 2)
            bits = ctw.mixed_bits(grams, levels, depth, 2)
            nodes, log_pw = levels[0].parents().astype(np.int64), levels[0].log_pw
        else:
            bits, nodes, log_pw = np.full((len(grams), 8), np.nan), np.zeros(0, np.int64), np.zeros(0)
        flat_bits = pa.array(bits.ravel())
        return pa.table(
            {
                "gram": pa.concat_arrays([pa.array(grams.astype(np.int64)), pa.nulls(len(nodes), pa.int64())]),
                "bits": pa.concat_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array(np.arange(0, bits.size + 1, 8), pa.int32()), flat_bits),
                        pa.nulls(len(nodes), pa.list_(pa.float64())),
                    ]
                ),
                "node": pa.concat_arrays([pa.nulls(len(grams), pa.int64()), pa.array(nodes)]),
                "log_pw": pa.concat_arrays([pa.nulls(len(grams), pa.float64()), pa.array(log_pw)]),
            }
        )

    return mix


def _top_levels(pairs: pd.DataFrame, children: pd.DataFrame) -> list[ctw.Level]:
    """Contexts of no and of one byte; both inputs have 65,536 rows at most."""
    last = pairs["last"].to_numpy().astype(np.uint64)
    symbol = pairs["symbol"].to_numpy().astype(np.uint64)
    counts = pairs["n"].to_numpy()
    one = ctw.Level(last, symbol, counts)
    sums = np.zeros(len(one.keys))
    sums[np.searchsorted(one.keys, children["node"].to_numpy().astype(np.uint64))] = children["log_pw"].to_numpy()
    one.weigh(sums)
    symbols, n = sum_by_key(symbol, counts)
    none = ctw.Level(np.zeros(len(symbols), np.uint64), symbols, n)
    none.weigh(ctw.children_of(one, none))
    return [none, one]


def gram_model(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``(gram, value)``: log10 of the byte's probability, for every gram of ``(gram, n)``.

    ``n`` counts training occurrences; grams that only other texts have come with 0.
    """
    totals = grams.groupBy("gram").agg(F.sum("n").alias("n"))
    two = F.shiftrightunsigned("gram", 8 * (depth - 1))
    mixed = materialise(
        totals.withColumn("two", two).groupBy("two").applyInArrow(
            _subtree(depth), "gram long, bits array<double>, node long, log_pw double"
        ),
        "ctw",
        "zstd",
    )
    pairs = (
        grams.filter("n > 0")
        .groupBy(F.shiftrightunsigned("gram", 8 * depth).alias("last"), F.expr("gram & 255").alias("symbol"))
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    children = mixed.filter("node IS NOT NULL").groupBy("node").agg(F.sum("log_pw").alias("log_pw")).toPandas()
    top = _top_levels(pairs, children) if len(pairs) else []

    def finish(batches):
        for batch in batches:
            keys = batch.column("gram").to_numpy().astype(np.uint64)
            chance = np.asarray(batch.column("bits").flatten().to_numpy(zero_copy_only=False)).reshape(-1, 8)
            nodes, bits = ctw.bit_nodes(keys & np.uint64(255))
            for d in (1, 0) if top else ():
                context = (keys >> np.uint64(8 * depth)) if d else np.zeros_like(keys)
                chance = top[d].refine((context << np.uint64(8))[:, None] | nodes.astype(np.uint64), bits, chance)
            value = ctw.log10_chance(chance)
            yield pa.RecordBatch.from_arrays([batch.column("gram"), pa.array(value)], ["gram", "value"])

    return mixed.filter("gram IS NOT NULL").select("gram", "bits").mapInArrow(finish, "gram long, value double")


def value_of(known: SortedHashes, keys: np.ndarray) -> np.ndarray:
    """Each key's value; a block's lists hold all keys of its texts."""
    return known.values[0][known.find(keys)]


def _score_block(depth: int):
    def score(docs: pa.Table, values: pa.Table) -> pa.Table:
        known: dict[bool, SortedHashes] = {}
        for is_word in (True, False):
            own = values.filter(pc.equal(values["is_word"], is_word))
            known[is_word] = SortedHashes(own["key"].to_numpy().view(np.uint64), own["value"].to_numpy())
        del values, own
        data, offsets = flat(docs["text"])
        sums = []
        for start, stop in row_chunks(offsets, CHUNK):
            part = offsets[start : stop + 1]
            own = LOWER[data[part[0] : part[-1]]]
            words = Words(own, part - part[0])
            logs = value_of(known[True], words.hashes())
            grams, at = ctw.grams_of(own, part - part[0], depth)
            sums.append(
                (
                    np.diff(words.rows),
                    sums_by_row(logs > 0, words.rows),
                    sums_by_row(logs, words.rows),
                    sums_by_row(value_of(known[False], grams), at),
                )
            )
        names = ("n_words", "n_known_words", "base_sum", "score")
        made = {name: pa.array(np.concatenate(x)) for name, x in zip(names, zip(*sums, strict=True), strict=True)}
        result = pa.table({"doc_id": docs["doc_id"], "held_out": docs["held_out"]} | made)
        known.clear()
        del docs, data, offsets
        give_back()
        return result

    return score


def score_texts(docs: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text, held_out), learning from those not held out.

    Adds ``score``, the log10 probability of the lower-cased bytes and the text's end under
    the context-tree model, with a word unigram score beside it. Each row gives one row, so
    repeated rows and ids stay; a null text is empty (its end alone is scored); a null
    ``held_out`` counts as false. With no training rows every bit has probability one half.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", whole_text().alias("text"), F.coalesce("held_out", F.lit(False)).alias("held_out"))
    blocks = text_blocks(docs, block_bytes)
    docs = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    counts = materialise(
        docs.groupBy("block").applyInArrow(
            _count_block(depth), "block int, is_word boolean, key long, n long"
        ),
        "counts",
        "zstd",
        **DELTAS,
    )
    # The texts' first shuffle is done with; they move once more, to be scored.
    drop_shuffles(spark)
    grams = counts.filter("NOT is_word").select("block", F.col("key").alias("gram"), "n")
    model = gram_model(grams.select("gram", "n"), depth)
    of_word = Window.partitionBy("key")
    words = materialise(
        counts.filter("is_word")
        .select("block", "key", F.sum("n").over(of_word).alias("c"), F.min("block").over(of_word).alias("first"))
        .select("block", "key", "c", F.expr("block = first").alias("first")),
        "words",
        "zstd",
        **DELTAS,
    )
    drop_shuffles(spark)
    # The end token counts once for each training text, and is one of the distinct tokens.
    ends = docs.filter(~F.col("held_out")).count()
    sums = words.filter("first AND c > 0").agg(F.sum("c").alias("n"), F.count("c").alias("v")).first()
    total, distinct = (sums["n"] or 0) + ends, sums["v"] + (ends > 0)
    values = words.select("block", F.lit(True).alias("is_word"), "key", F.log10(F.col("c") + 1.0).alias("value"))
    values = values.unionByName(
        grams.select("block", "gram")
        .join(model, "gram")
        .select("block", F.lit(False).alias("is_word"), F.col("gram").alias("key"), "value")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(
        _score_block(depth),
        f"doc_id {kind}, held_out boolean, n_words long, n_known_words long, base_sum double, score double",
    )
    return scored.select(
        "doc_id",
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_known_words") + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (
            F.col("base_sum")
            + F.lit(math.log10(ends + 1))
            - (F.col("n_words") + 1) * F.lit(math.log10(total + distinct + 1))
        ).alias("base_score"),
        "score",
    )


def held_out_by_id(docs: DataFrame) -> DataFrame:
    """Mark the documents whose crc32(doc_id as text) mod 7 is 2; a null id is not held out."""
    return docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False)))
