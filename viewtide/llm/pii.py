"""Personal data: base patterns, and information-theoretic sanitisation of revealing terms.

Every personal value found by a pattern is a protected entity. Documents with a term near it
are set against all documents that hold the term. Everything is counted in distinct texts: with
n texts of the entity, d of the term and c of the term near the entity, and N texts in all, the
term discloses
``PMI / IC = log(c N / (n d)) / log(N / n)``
of the entity's information. A term must share some distinct contexts with the entity, so that
one passage repeated in different documents marks nothing. The names in the local part of an
address belong to its person and need no such evidence: a name that hardly occurs but in the
address's documents discloses the address, and one that is a common word does not.

Terms from a threshold on are marked wherever they occur, with or without the entity beside
them: generalised, or removed where they disclose all.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.llm.common import (
    LOWER,
    SortedHashes,
    Words,
    count_keys,
    flat,
    frugal,
    row_chunks,
    smaller_batches,
    sum_by_key,
    whole_text,
)
from viewtide.session import materialise

#: Words on each side that are an entity's context, distinct contexts a term must share with
#: it, and the shares of its information from which terms are generalised and removed.
NEAR, LEAST, GENERALISE, REMOVE = 8, 3, 0.95, 1.0
#: Letters that a name in an address has at least.
NAME_LETTERS = 3
#: Terms that are broadcast at once (16 bytes each); more take further passes over the texts.
MOST_TERMS = 2_000_000
#: Bytes of text that are held as arrays at once, and of text in a batch.
CHUNK, BATCH = 1 << 20, 4 << 20

#: The kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No address starts inside a run of digits: whatever follows the run would follow there too.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    """Found from the at sign outwards, so that long runs without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            done = domain.end()
            yield "email", start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The base spans by kind, then start; a match that fails its test is dropped."""
    spans = list(_emails(text))
    if not _DIGIT.search(text):
        return spans
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in match[0].split(".")):
            spans.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = re.sub("[ -]", "", match[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *match.span()))
    for match in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in match[0]) <= 15:
            spans.append(("phone", *match.span()))
    return spans


def _entity(kind: str, value: str) -> int:
    plain = value.lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", value)
    return int.from_bytes(hashlib.blake2b(f"{kind}:{plain}".encode(), digest_size=8).digest(), "little", signed=True)


def _terms(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of letters and digits, lower-cased."""
    lower = LOWER[data]
    return Words(np.where(_TERM[data], lower, 32).astype(np.uint8), offsets)


def term_hashes(texts: list[str]) -> list[int]:
    """The hashes that stand for single terms."""
    encoded = [text.encode() for text in texts]
    words = _terms(np.frombuffer(b"".join(encoded), np.uint8), np.cumsum([0, *map(len, encoded)]))
    return words.hashes().view(np.int64).tolist()


def _contexts(text: str, spans: list[Span], words: Words, hashes: np.ndarray, row: int) -> Iterator[tuple[int, int | None, int | None]]:
    """(entity, term, context) of one text: an entity's context there is all its spans' terms.

    The context is null for names in an address.
    """
    own = slice(words.rows[row], words.rows[row + 1])
    start = words.start[own] - words.text_start[row]
    end = words.end[own] - words.text_start[row]
    held = hashes[own]
    # Where each code point begins, and where the text ends.
    points = np.append(np.flatnonzero((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80), len(text.encode()))
    around: dict[int, list[np.ndarray]] = {}
    for kind, a, b in spans:
        first, last = points[a], points[b]
        before, after = np.searchsorted(end, first, "right"), np.searchsorted(start, last)
        near = np.concatenate((held[max(0, before - NEAR) : before], held[after : after + NEAR]))
        entity = _entity(kind, text[a:b])
        if kind == "email" and entity not in around:
            at = points[a + text[a:b].index("@")]
            for k in range(np.searchsorted(start, first), np.searchsorted(start, at)):
                # A local part is ASCII, so its bytes are its code points.
                name = text[a + start[k] - first : a + end[k] - first]
                if len(name) >= NAME_LETTERS and not name.isdigit():
                    yield entity, int(held[k : k + 1].view(np.int64)[0]), None
        around.setdefault(entity, []).append(near)
    for entity, near in around.items():
        terms = np.unique(np.concatenate(near))
        context = hashlib.blake2b(terms.tobytes(), digest_size=8).digest()
        # An entity by itself has a context without terms.
        for term in terms.view(np.int64).tolist() or [None]:
            yield entity, term, int.from_bytes(context, "little", signed=True)


def count_corpus(docs: DataFrame) -> DataFrame:
    """Rows (entity, term, context, n): one for each document of an entity's context, and with
    null ones the documents of terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller_batches(batches, BATCH):
            data, offsets = flat(batch.column("text"))
            found: list[tuple[int, int | None, int | None]] = []
            total = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            for begin, stop in row_chunks(offsets, CHUNK):
                part = offsets[begin : stop + 1]
                own = data[part[0] : part[-1]]
                words = _terms(own, part - part[0])
                hashes = words.hashes()
                each = []
                for row in range(stop - begin):
                    each.append(np.unique(hashes[words.rows[row] : words.rows[row + 1]]))
                    text = own[part[row] - part[0] : part[row + 1] - part[0]].tobytes().decode()
                    spans = base_spans(text)
                    if spans:
                        found.extend(_contexts(text, spans, words, hashes, row))
                counted = count_keys(np.concatenate(each))
                total = sum_by_key(*(np.concatenate(x) for x in zip(total, counted, strict=True)))
            entity, term, context = zip(*found, strict=True) if found else ((), (), ())
            n, m = len(found), len(total[0])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(entity, pa.int64()), pa.nulls(m, pa.int64())]),
                    pa.concat_arrays([pa.array(term, pa.int64()), pa.array(total[0].view(np.int64))]),
                    pa.concat_arrays([pa.array(context, pa.int64()), pa.nulls(m, pa.int64())]),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(total[1])]),
                ],
                ["entity", "term", "context", "n"],
            )

    return docs.select("text").mapInArrow(frugal(count), "entity long, term long, context long, n long")


def revealing_terms(docs: DataFrame, least: int = LEAST, generalise: float = GENERALISE) -> DataFrame:
    """Rows (term, disclosure): terms that disclose an entity, with the largest share of it.

    Texts that occur in several rows of ``docs`` count once everywhere.
    """
    # Copies are combined before the shuffle, so a hot text is one row of each task.
    counted = materialise(count_corpus(docs.select("text").distinct()), "terms")
    n_texts = docs.select(F.xxhash64("text").alias("version")).distinct().count()
    near = counted.filter("context IS NOT NULL")
    contexts = near.groupBy("entity", "term", "context").agg(F.count(F.lit(1)).alias("n"))
    # A text has one context of an entity, and that has the same terms wherever it is.
    each = contexts.groupBy("entity", "context").agg(F.max("n").alias("n"))
    of_entity = each.groupBy("entity").agg(F.sum("n").alias("n_entity"))
    both = contexts.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("n_contexts"))
    both = both.filter(F.col("n_contexts") >= least).drop("n_contexts")
    names = counted.filter("entity IS NOT NULL AND context IS NULL").groupBy("entity", "term")
    both = both.unionByName(names.agg(F.count(F.lit(1)).alias("n_both")))
    of_term = counted.filter("entity IS NULL").groupBy("term").agg(F.sum("n").alias("n_term"))
    joined = both.join(of_entity, "entity").join(of_term, "term")
    rate = F.col("n_both") / F.col("n_term")
    information = F.log(F.lit(float(max(n_texts, 2))) / F.col("n_entity"))
    disclosed = F.when(information > 0, 1 + F.log(rate) / information).otherwise(F.lit(0.0))
    shares = joined.select("term", disclosed.alias("disclosure"))
    return shares.filter(F.col("disclosure") >= generalise).groupBy("term").agg(F.max("disclosure").alias("disclosure"))


def _term_spans(known: SortedHashes, texts: pa.Array) -> Iterator[list[tuple[int, int, bool]]]:
    """For each text the places of known terms in code points, and whether they disclose all."""
    data, offsets = flat(texts)
    for begin, stop in row_chunks(offsets, CHUNK):
        part = offsets[begin : stop + 1]
        own = data[part[0] : part[-1]]
        words = _terms(own, part - part[0])
        at = known.find(words.hashes())
        hits = np.flatnonzero(at >= 0)
        out: list[list[tuple[int, int, bool]]] = [[] for _ in range(stop - begin)]
        if len(hits):
            points = np.concatenate(([0], np.cumsum((words.data & 0xC0) != 0x80)))
            row = np.searchsorted(words.rows, hits, "right") - 1
            base = points[words.text_start[row]]
            whole = known.values[0][at[hits]] >= REMOVE
            for r, a, b, w in zip(row, points[words.start[hits]] - base, points[words.end[hits]] - base, whole, strict=True):
                out[r].append((int(a), int(b), bool(w)))
        yield from out


Batches = Iterator[pa.RecordBatch]


def find_personal(
    docs: DataFrame, terms: DataFrame, most: int = MOST_TERMS, then: Callable[[Batches], Batches] | None = None
) -> DataFrame:
    """Add ``personal``, an array of (kind, start, stop, whole), to every row of ``docs``.

    Spans come by kind as listed, terms last, then by start; places are code points. Terms
    inside or across a base span are left to it. A null text has none. An input column of
    that name is replaced; repeated rows each give their own. ``then`` gets the rows with
    their spans in the same tasks.
    """
    docs = docs.drop("personal")
    spark = docs.sparkSession
    n_terms = terms.count()
    passes = max(1, math.ceil(n_terms / most))
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("whole", pa.bool_())])
    )
    schema = spark.createDataFrame([], "personal array<struct<kind: string, start: long, stop: long, whole: boolean>>").schema
    for k in range(passes):
        own = terms.filter(F.pmod("term", F.lit(passes)) == k).toArrow()
        held = spark.sparkContext.broadcast(
            SortedHashes(own["term"].to_numpy().view(np.uint64), own["disclosure"].to_numpy())
        )
        names = [name for name in docs.columns if name != "personal"]

        def mark(batches: Iterator[pa.RecordBatch], held=held, first=k == 0, names=names) -> Iterator[pa.RecordBatch]:
            for batch in smaller_batches(batches, BATCH):
                texts = batch.column("text")
                made = []
                had = [None] * batch.num_rows if first else batch.column("personal").to_pylist()
                for text, before, found in zip(texts.to_pylist(), had, _term_spans(held.value, texts), strict=True):
                    spans = before
                    if first:
                        spans = [
                            {"kind": name, "start": a, "stop": b, "whole": False} for name, a, b in base_spans(text or "")
                        ]
                    # How far base spans reach that begin before a place.
                    base = sorted((s["start"], s["stop"]) for s in spans if s["kind"] != "term")
                    starts = [x for x, _ in base]
                    reach = list(itertools.accumulate((y for _, y in base), max))
                    for a, b, whole in found:
                        before = bisect.bisect_left(starts, b)
                        if not before or reach[before - 1] <= a:
                            spans.append({"kind": "term", "start": a, "stop": b, "whole": whole})
                    spans.sort(key=lambda s: ((*KINDS, "term").index(s["kind"]), s["start"]))
                    made.append(spans)
                columns = [batch.column(name) for name in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(made, kind)], [*names, "personal"])

        fields = [docs.schema[name] for name in names] + schema.fields
        last = then is not None and k == passes - 1
        run = (lambda batches, mark=mark: then(mark(batches))) if last else mark
        docs = docs.mapInArrow(frugal(run), type(schema)(fields))
        if k < passes - 1:
            docs = materialise(docs, "personal")
    return docs


def digest(found: DataFrame, *more: Column) -> DataFrame:
    """Counts by kind, the hash of the base spans, and all spans as ``kind:start:end``."""
    counts = {
        kind: F.size(F.expr(f"filter(personal, s -> s.kind = '{kind}')")).cast("long").alias(f"n_{kind}")
        for kind in (*KINDS, "term")
    }

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    base = F.filter("personal", lambda s: s["kind"] != "term")
    return found.select(
        "doc_id",
        *(counts[kind] for kind in KINDS),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("personal")).alias("spans"),
        counts["term"],
        *more,
    )


def _sanitised(batches: Batches) -> Batches:
    for batch in batches:
        place = batch.schema.get_field_index("text")
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("personal").to_pylist(), strict=True):
            parts, at = [], 0
            for s in sorted(spans or [], key=lambda s: (s["start"], -s["stop"])):
                if s["start"] >= at:
                    mark = MARKS.get(s["kind"]) or ("" if s["whole"] else "[TERM]")
                    parts += [text[at : s["start"]], mark]
                # What is left of an overlapping span is covered by the mark before it.
                at = max(at, s["stop"])
            out.append("".join([*parts, text[at:]]) if parts else text)
        columns = batch.columns
        columns[place] = pa.array(out, pa.string())
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def sanitise(found: DataFrame) -> DataFrame:
    """Replace the spans of ``personal`` in ``text`` by marks; terms that disclose all go.

    Where base spans overlap, the one that starts first (the longer of equals) stands.
    """
    return found.mapInArrow(frugal(_sanitised), found.schema).drop("personal")


def scan(docs: DataFrame) -> DataFrame:
    """The digest of every row of ``docs`` (doc_id, text); terms are learnt from all rows.

    Added are how many terms are generalised and removed, and the hash of the text that is left.
    """
    docs = docs.select("doc_id", whole_text().alias("text"))
    # The spans stay as they were found; the text beside them is what is left.
    found = find_personal(docs, materialise(revealing_terms(docs), "terms"), then=_sanitised)
    gone = F.size(F.expr("filter(personal, s -> s.kind = 'term' AND s.whole)")).cast("long").alias("n_removed")
    return digest(
        found,
        gone,
        F.size(F.expr("filter(personal, s -> s.kind = 'term' AND NOT s.whole)")).cast("long").alias("n_generalised"),
        F.sha2(F.col("text"), 256).alias("sanitised_sha256"),
    )
