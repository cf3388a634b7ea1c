"""Language identification of mixed text: script ranges, word scores and Viterbi spans.

A word is a run of letters. Its score in a language is the log likelihood of its bytes, each
with its two neighbours, as Spark counted them in the training texts. The scripts of its
letters narrow the languages to those that use them. Viterbi then finds each text's best
sequence of languages, in which every switch costs a penalty, and runs of one language are
the text's spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.llm.common import LOWER, SortedHashes, count_keys, flat, row_chunks, sum_by_key

#: What a switch costs, in units of log likelihood, and what a language that does not use a word's script loses.
SWITCH, FOREIGN = 16.0, 60.0
#: Share of a language's training letters from which a script counts as its own.
SCRIPT_SHARE = 0.01
#: Added to every count of a byte with its neighbours.
SMOOTHING = 0.5
CHUNK, BATCH = 1 << 20, 16 << 20

#: First code points of Unicode's script ranges, coarsely.
SCRIPTS = (
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0900, "devanagari"),
    (0x0980, "bengali"),
    (0x0A00, "indic"),
    (0x0B80, "tamil"),
    (0x0C00, "telugu"),
    (0x0C80, "south indic"),
    (0x0E00, "thai"),
    (0x0E80, "other"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "ethiopic"),
    (0x13A0, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "common"),
    (0x2E80, "han"),
    (0x3040, "kana"),
    (0x3100, "han"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "common"),
    (0x20000, "han"),
    (0x30000, "common"),
)
_FIRST = np.array([first for first, _ in SCRIPTS])
_NAMES = list(dict.fromkeys(name for _, name in SCRIPTS))
#: One bit for each script; common marks belong to all and have none.
_BIT = np.array([0 if name == "common" else 1 << _NAMES.index(name) for _, name in SCRIPTS], np.int64)

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


class LetterRuns:
    """Words of letters (ASCII letters and all other code points beyond ASCII) in some texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        held = memoryview(LOWER[data])
        parts = [held[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        self.data = np.frombuffer(b" " + b" ".join(parts) + b" ", np.uint8)
        self.text_start = offsets + np.arange(len(offsets)) + 1
        inside = _LETTER[self.data]
        self.at = np.flatnonzero(inside)
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        self.start, self.end = edges[0::2], edges[1::2]
        self.rows = np.searchsorted(self.start, self.text_start)
        #: Where each word's bytes begin among ``at``.
        self.first = np.searchsorted(self.at, self.start)

    def trigrams(self) -> np.ndarray:
        """Each letter byte with its neighbours; whatever is no letter is one space."""
        plain = np.where(_LETTER[self.data], self.data, 32).astype(np.uint64)
        at = self.at
        return (plain[at - 1] << np.uint64(16)) | (plain[at] << np.uint64(8)) | plain[at + 1]

    def scripts(self) -> np.ndarray:
        """The bits of the scripts of each letter byte; bytes inside a code point have none."""
        data, at = self.data.astype(np.int64), self.at
        bits = np.full(len(at), _BIT[0])
        wide = np.flatnonzero(data[at] >= 0x80)
        if len(wide):
            place = at[wide]
            lead = data[place]
            tail = [np.take(data, place + k, mode="clip") & 0x3F for k in (1, 2, 3)]
            two = (lead & 0x1F) << 6 | tail[0]
            three = (lead & 0x0F) << 12 | tail[0] << 6 | tail[1]
            four = (lead & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]
            point = np.select([lead < 0xE0, lead < 0xF0], [two, three], four)
            script = _BIT[np.searchsorted(_FIRST, point, "right") - 1]
            bits[wide] = np.where(lead < 0xC0, 0, script)
        return bits


def count_training(docs: DataFrame) -> DataFrame:
    """Counts (lang, script, key, n) over training texts (text, lang).

    Rows with ``script`` false count bytes with their neighbours; the others, letters by the
    number of a script's bit.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column("lang").dictionary_encode()
            codes = np.asarray(coded.indices)
            for code, lang in enumerate(coded.dictionary.to_pylist()):
                data, offsets = flat(batch.column("text").take(pa.array(np.flatnonzero(codes == code))))
                found = {False: [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], True: []}
                for start, stop in row_chunks(offsets, CHUNK):
                    part = offsets[start : stop + 1]
                    runs = LetterRuns(data[part[0] : part[-1]], part - part[0])
                    found[False].append(count_keys(runs.trigrams()))
                    found[True].append(count_keys(runs.scripts().astype(np.uint64)))
                for script, parts in found.items():
                    if parts:
                        keys, counts = sum_by_key(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                        n = len(keys)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([lang] * n, pa.string()),
                                pa.array([script] * n, pa.bool_()),
                                pa.array(keys.astype(np.int64)),
                                pa.array(counts),
                            ],
                            ["lang", "script", "key", "n"],
                        )

    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counted = rows.mapInArrow(count, "lang string, script boolean, key long, n long")
    return counted.groupBy("lang", "script", "key").agg(F.sum("n").alias("n"))


class Model:
    """Log likelihoods of bytes with neighbours, by language, and the scripts of each.

    There are 2**24 keys at most, whatever the corpus, with a number for each language.
    """

    def __init__(self, counts: pa.Table):
        script = counts["script"].to_numpy(zero_copy_only=False).astype(bool)
        names = np.array(counts["lang"].to_pylist(), object)
        keys, n = counts["key"].to_numpy(), counts["n"].to_numpy()
        self.langs = sorted(set(names.tolist()))
        code = np.array([self.langs.index(x) for x in names.tolist()], np.int64)
        known, at = np.unique(keys[~script], return_inverse=True)
        table = np.full((len(known) + 1, len(self.langs)), SMOOTHING)
        table[at, code[~script]] += n[~script]
        # The last row is for what training never saw.
        self.logs = np.log(table / table.sum(axis=0)).astype(np.float32)
        self.index = SortedHashes(known.astype(np.uint64), np.arange(len(known)))
        self.scripts = np.zeros(len(self.langs), np.int64)
        for lang in range(len(self.langs)):
            own = script & (code == lang)
            enough = own & (n >= SCRIPT_SHARE * n[own & (keys > 0)].sum())
            self.scripts[lang] = np.bitwise_or.reduce(keys[enough], initial=0)

    def word_scores(self, runs: LetterRuns) -> np.ndarray:
        """A row for each word: its log likelihood in each language."""
        if not len(runs.start):
            return np.zeros((0, len(self.langs)), np.float32)
        at = self.index.find(runs.trigrams())
        place = np.where(at >= 0, self.index.values[0][at], len(self.logs) - 1)
        scores = np.add.reduceat(self.logs[place], runs.first, axis=0)
        used = np.bitwise_or.reduceat(runs.scripts(), runs.first)
        foreign = (used[:, None] & ~self.scripts[None, :]) != 0
        foreign &= ~foreign.all(axis=1)[:, None]
        return scores - FOREIGN * foreign.astype(np.float32)


def viterbi(scores: np.ndarray, rows: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of each word, text by text: all texts take a step together."""
    n_words, n_langs = scores.shape
    labels = np.zeros(n_words, np.int32)
    lengths = np.diff(rows)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = rows[:-1][order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    best = np.zeros((len(starts), n_langs), np.float32)
    stays, tops = np.zeros((n_words, n_langs), bool), np.zeros(n_words, np.int32)
    for t in range(longest):
        n = active[t]
        at, own = starts[:n] + t, best[:n]
        if t:
            top = own.argmax(axis=1)
            moved = own[np.arange(n), top][:, None] - switch
            stays[at] = own >= moved
            tops[at] = top
            np.maximum(own, moved, out=own)
        own += scores[at]
        # Only differences count; without this, long texts would lose precision.
        own -= own.max(axis=1, keepdims=True)
    lang = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at, own = starts[:n] + t, lang[:n]
        labels[at] = own
        if t:
            lang[:n] = np.where(stays[at, own], own, tops[at])
    return labels


def _spans(runs: LetterRuns, labels: np.ndarray, langs: list[str]) -> list[list[dict]]:
    """Runs of one language in each text, in code points."""
    points = np.concatenate(([0], np.cumsum((runs.data & 0xC0) != 0x80)))
    first = np.zeros(len(labels), bool)
    first[runs.rows[:-1][np.diff(runs.rows) > 0]] = True
    first[1:] |= labels[1:] != labels[:-1]
    begin = np.flatnonzero(first)
    last = np.append(begin[1:], len(labels)) - 1
    text = np.searchsorted(runs.rows, begin, "right") - 1
    base = points[runs.text_start[text]]
    out: list[list[dict]] = [[] for _ in range(len(runs.rows) - 1)]
    for row, lang, a, b in zip(
        text, labels[begin], points[runs.start[begin]] - base, points[runs.end[last]] - base, strict=True
    ):
        out[row].append({"lang": langs[lang], "start": int(a), "stop": int(b)})
    return out


def _label(model: Model, texts: pa.Array) -> Iterator[tuple[str, float, list[dict]]]:
    data, offsets = flat(texts)
    n_langs = len(model.langs)
    for begin, end in row_chunks(offsets, BATCH):
        parts = []
        for start, stop in row_chunks(offsets[begin : end + 1], CHUNK):
            part = offsets[begin + start : begin + stop + 1]
            runs = LetterRuns(data[part[0] : part[-1]], part - part[0])
            parts.append((runs, model.word_scores(runs)))
        rows = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(runs.rows) for runs, _ in parts]))))
        labels = viterbi(np.concatenate([scores for _, scores in parts]), rows)
        done = text = 0
        for runs, scores in parts:
            own = labels[done : done + len(scores)]
            done += len(scores)
            n = len(runs.rows) - 1
            text_of = np.repeat(np.arange(n), np.diff(runs.rows))
            letters = np.bincount(text_of * n_langs + own, runs.end - runs.start, n * n_langs).reshape(n, n_langs)
            ascii_letter = np.concatenate(([0], np.cumsum(_LETTER[runs.data] & (runs.data < 128))))
            plain = np.diff(ascii_letter[runs.text_start]) > 0
            for row, spans in enumerate(_spans(runs, own, model.langs)):
                place = offsets[begin + text + row : begin + text + row + 2]
                if plain[row] or any(c.isalpha() for c in data[place[0] : place[1]].tobytes().decode()):
                    best = int(letters[row].argmax())
                    yield model.langs[best], float(letters[row, best] / letters[row].sum()), spans
                else:
                    yield "und", 0.0, []
            text += n


def identify(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``spans`` to every row of ``docs``, from its text alone.

    ``lang_pred`` is the language of most letters, ``score`` its share of them, and ``spans``
    holds (lang, start, stop) in code points. A text that is null, empty or has no letter is
    ``und`` with score 0 and no spans; so is every text if training had none. Input columns
    of these names are replaced, all others pass through.
    """
    docs = docs.drop("lang_pred", "score", "spans")
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(Model(counts.toArrow()))
    added = "lang_pred string, score double, spans array<struct<lang: string, start: long, stop: long>>"
    schema = spark.createDataFrame([], added).schema
    span = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            if model.langs and batch.num_rows:
                made = list(zip(*_label(model, batch.column("text")), strict=True))
            else:
                made = [["und"] * batch.num_rows, [0.0] * batch.num_rows, [[]] * batch.num_rows]
            columns = [pa.array(x, kind) for x, kind in zip(made, (pa.string(), pa.float64(), span), strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns + columns, batch.schema.names + schema.names)

    return docs.mapInArrow(label, type(schema)(docs.schema.fields + schema.fields))


def with_hold_out(docs: DataFrame) -> DataFrame:
    """Mark the documents whose crc32(doc_id as text) mod 3 is 1; a null id is not held out."""
    return docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)))


def identify_held_out(docs: DataFrame) -> DataFrame:
    """Predictions (doc_id, held_out, lang_pred, score, spans), learnt from rows not held out."""
    docs = with_hold_out(docs.select("doc_id", "text", "lang"))
    counts = count_training(docs.filter("NOT held_out"))
    return identify(docs.select("doc_id", "held_out", "text"), counts).drop("text")
