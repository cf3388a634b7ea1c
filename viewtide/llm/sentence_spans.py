"""Substring dedup by sliding sentence spans.

From every sentence the shortest run of several consecutive sentences with enough words is
hashed, and the shortest one that ends with it: every longer run is covered by such runs from
its first sentence to its last. Runs join globally by hash; the first occurrence (by document
id, then place) stays, and every sentence that some later occurrence covers is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.llm.common import BASE, LOWER, Words, flat, mix, powers, row_chunks, whole_text
from viewtide.session import materialise

#: Sentences and words that a run has at least, and the words from which one sentence is a run.
SENTENCES, WORDS, LONG_SENTENCE = 2, 10, 50
CHUNK = 1 << 20

_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
#: What may stand between a full stop and the white space after it.
_CLOSING = np.zeros(256, bool)
_CLOSING[list(b"\"')]")] = True


class Sentences:
    """The sentences of some texts, as ranges of their words.

    A sentence ends with a word that ends in a full stop, exclamation or question mark (and
    closing quotes or brackets), or before a line break.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = words = Words(LOWER[data], offsets)
        n = len(words.start)
        last = words.end - 1
        inner = np.where(_CLOSING[words.data[last]] & (last > words.start), last - 1, last) if n else last
        lines = np.concatenate(([0], np.cumsum(words.data == 10)))
        # A word that starts a text starts a sentence; the places of texts are no line breaks.
        begins = np.zeros(n, bool)
        begins[1:] = _STOP[words.data[inner[:-1]]] | (lines[words.start[1:]] > lines[words.end[:-1]])
        begins[words.rows[:-1][np.diff(words.rows) > 0]] = True
        #: The first word of each sentence, and the first sentence of each text.
        self.first = np.flatnonzero(begins)
        self.rows = np.searchsorted(self.first, words.rows)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text, first sentence within its text, and number of sentences of each run."""
        words, first = self.words, self.first
        n = len(first)
        text = np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))
        bound = np.append(first, len(words.start))
        each = np.arange(n)
        stop = np.maximum(np.searchsorted(bound, first + WORDS), each + SENTENCES)
        fits = np.flatnonzero(stop <= self.rows[text + 1])
        alone = np.flatnonzero(np.diff(bound) >= LONG_SENTENCE)
        ends = each + 1
        last = np.minimum(np.searchsorted(bound, bound[ends] - WORDS, "right") - 1, ends - SENTENCES)
        closes = np.flatnonzero(last >= self.rows[text])
        begin = np.concatenate((each[fits], alone, last[closes]))
        stop = np.concatenate((stop[fits], alone + 1, ends[closes]))
        begin, stop = np.unique(np.stack((begin, stop)), axis=1)
        if not len(begin):
            return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)
        up, down = powers(len(words.start) + 1)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(words.hashes() * up[:-1], dtype=np.uint64)))
        a, b = bound[begin], bound[stop]
        hashes = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * BASE)
        return hashes, text[begin], begin - self.rows[text[begin]], stop - begin

    def kept(self, row: int, covered: np.ndarray) -> np.ndarray:
        """The bytes of one text, in the original's places, that stay."""
        words = self.words
        start = words.start[self.first[self.rows[row] : self.rows[row + 1]]] - words.text_start[row]
        length = words.text_start[row + 1] - words.text_start[row] - 1
        bound = np.append(start, length)
        keep = np.ones(length, bool)
        for k in np.flatnonzero(covered):
            keep[bound[k] : bound[k + 1]] = False
        return keep


def find_runs(docs: DataFrame) -> DataFrame:
    """Rows (run, doc_id, version, place, size) of all runs of (doc_id, version, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            for begin, stop in row_chunks(offsets, CHUNK):
                part = offsets[begin : stop + 1]
                hashes, text, place, size = Sentences(data[part[0] : part[-1]], part - part[0]).runs()
                rows = pa.array(text + begin)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes.view(np.int64)),
                        batch.column("doc_id").take(rows),
                        batch.column("version").take(rows),
                        pa.array(place.astype(np.int32)),
                        pa.array(size.astype(np.int32)),
                    ],
                    ["run", "doc_id", "version", "place", "size"],
                )

    return docs.mapInArrow(find, f"run long, doc_id {kind}, version long, place int, size int")


def repeated_runs(runs: DataFrame) -> DataFrame:
    """Rows (doc_id, version, place, size, first_doc) of every occurrence but a run's first."""
    order = F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "version", "place")
    firsts = runs.groupBy(F.col("run").alias("of_run")).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    # Written first: a join of two plain shuffles is one whose hot runs Spark can split.
    repeated = materialise(firsts.filter("n > 1").select("of_run", "first"), "repeated")
    joined = runs.withColumn("own", order).join(repeated, F.col("run") == F.col("of_run"))
    return joined.filter("NOT own <=> first").select(
        "doc_id", "version", "place", "size", F.col("first.doc_id").alias("first_doc")
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with ``text`` cut, and n_sentences, n_removed, first_docs added.

    ``first_docs`` lists the documents that hold the removed passages first. A null text stays
    null and has no sentences. Rows that repeat both id and text count as one document and
    are cut alike; of equal ids with different texts the order is by a hash of the text, and
    null ids come last. Input columns of the added names are replaced.
    """
    added = ["n_sentences", "n_removed", "first_docs"]
    docs = docs.drop(*added)
    names = docs.columns
    spark = docs.sparkSession
    own = docs.select("doc_id", F.xxhash64("text").alias("version"), whole_text().alias("text"))
    repeats = repeated_runs(materialise(find_runs(own), "runs"))
    # At most as many as a document has sentences.
    cuts = repeats.groupBy(F.col("doc_id").alias("cut_id"), F.col("version").alias("cut_version")).agg(
        F.collect_set(F.struct("place", "size")).alias("cuts"), F.sort_array(F.collect_set("first_doc")).alias("first_docs")
    )
    keyed = docs.select(F.struct(*(F.col(f"`{name}`") for name in names)).alias("row"), "doc_id", "text", F.xxhash64("text").alias("version"))
    joined = keyed.join(
        cuts, F.col("doc_id").eqNullSafe(F.col("cut_id")) & (F.col("version") == F.col("cut_version")), "left"
    ).select("row", "text", "cuts", "first_docs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            data, offsets = flat(column)
            cuts = batch.column("cuts").to_pylist()
            texts, n_sentences, n_removed = column.to_pylist(), [], []
            for begin, stop in row_chunks(offsets, CHUNK):
                part = offsets[begin : stop + 1]
                bytes_ = data[part[0] : part[-1]]
                found = Sentences(bytes_, part - part[0])
                for row in range(stop - begin):
                    covered = np.zeros(found.rows[row + 1] - found.rows[row], bool)
                    for span in cuts[begin + row] or ():
                        covered[span["place"] : span["place"] + span["size"]] = True
                    n_sentences.append(len(covered))
                    n_removed.append(int(covered.sum()))
                    if covered.any():
                        whole = bytes_[part[row] - part[0] : part[row + 1] - part[0]]
                        texts[begin + row] = whole[found.kept(row, covered)].tobytes().decode()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(texts, pa.string()),
                    pa.array(n_sentences, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    batch.column("first_docs"),
                ],
                ["row", "cut_text", "n_sentences", "n_removed", "first_docs"],
            )

    schema = spark.createDataFrame([], "cut_text string, n_sentences long, n_removed long").schema
    kind = type(schema)([joined.schema["row"], *schema.fields, joined.schema["first_docs"]])
    made = joined.mapInArrow(cut, kind)
    columns = [F.col("cut_text").alias("text") if name == "text" else F.col(f"row.`{name}`") for name in names]
    return made.select(*columns, "n_sentences", "n_removed", F.coalesce("first_docs", F.array().cast(kind["first_docs"].dataType)).alias("first_docs"))
