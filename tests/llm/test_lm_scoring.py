import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.cases import documents, frame, lower, words
from viewtide.llm import ctw, lm_scoring


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def kt_model(texts, depth):
    """Counts of each context's nodes, kept in a dictionary."""
    counts = {}
    for text in texts:
        data = [0xFE] * depth + list(text) + [0xFF]
        for i in range(depth, len(data)):
            for d in range(depth + 1):
                context = bytes(data[i - d : i])
                for k in range(8):
                    node = (1 << k) | (data[i] >> (8 - k))
                    pair = counts.setdefault((context, node), [0, 0])
                    pair[data[i] >> (7 - k) & 1] += 1
    return counts


def log_pe(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)


def tree(counts, depth):
    """log Pw and the stopping weight of each node, longest contexts first."""
    pw, stop, children = {}, {}, {}
    for (context, node), (a, b) in sorted(counts.items(), key=lambda x: -len(x[0][0])):
        pe = log_pe(a, b)
        if len(context) == depth:
            pw[context, node], stop[context, node] = pe, 1.0
        else:
            own, other = pe - math.log(2), children[context, node] - math.log(2)
            pw[context, node] = np.logaddexp(own, other)
            stop[context, node] = math.exp(own - pw[context, node])
        if context:
            shorter = context[1:], node
            children[shorter] = children.get(shorter, 0.0) + pw[context, node]
    return stop


def score(text, counts, stop, depth):
    total, data = 0.0, [0xFE] * depth + list(text) + [0xFF]
    for i in range(depth, len(data)):
        for k in range(8):
            node, bit = (1 << k) | (data[i] >> (8 - k)), data[i] >> (7 - k) & 1
            p = None
            for d in range(depth, -1, -1):
                key = bytes(data[i - d : i]), node
                if key in counts:
                    kt = (counts[key][bit] + 0.5) / (sum(counts[key]) + 1)
                    p = kt if p is None else stop[key] * kt + (1 - stop[key]) * p
            total += math.log10(0.5 if p is None else p)
    return total


@pytest.mark.parametrize("depth", [2, 3, 5])
def test_scores_match_brute_force(spark, depth):
    rows = [r for r in documents() if r[0] != 14]
    made = lm_scoring.score_texts(lm_scoring.held_out_by_id(frame(spark, rows)), depth, block_bytes=2000).collect()
    train = [lower(r[1]).encode() for r in rows if not held_out(r[0])]
    counts = kt_model(train, depth)
    stop = tree(counts, depth)
    known = Counter(word for r in rows if not held_out(r[0]) for word in [*words(lower(r[1])), "\n"])
    n, v = sum(known.values()), len(known)
    want = []
    for r in rows:
        tokens = [*words(lower(r[1])), "\n"]
        base = sum(math.log10((known[t] + 1) / (n + v + 1)) for t in tokens)
        got = score(lower(r[1]).encode(), counts, stop, depth)
        want.append((str(r[0]), held_out(r[0]), len(tokens), sum(known[t] > 0 for t in tokens), n, round(base, 6), round(got, 6)))
    have = [
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
        for r in made
    ]
    assert sorted(have) == sorted(want)


def test_probabilities_add_up_to_one():
    data = np.frombuffer(b"the theatre then", np.uint8)
    grams, _ = ctw.grams_of(data, np.array([0, len(data)]), 3)
    levels = ctw.levels_of(*np.unique(grams, return_counts=True), 3, 0)
    for context in (grams[5], np.uint64(0x7A7A7A00)):
        every = (context & ~np.uint64(255)) | np.arange(256, dtype=np.uint64)
        assert math.isclose((10 ** ctw.log10_chance(ctw.mixed_bits(every, levels, 3, 0))).sum(), 1)


def test_large_counts_use_the_series():
    large = np.array([20_000, 5, 0])
    assert np.allclose(ctw.log_block(large, large[::-1]), [log_pe(a, b) for a, b in zip(large, large[::-1])])


def test_without_training_rows_and_empty(spark):
    rows = [(2, "ab", True), (3, None, True)]
    made = lm_scoring.score_texts(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")).collect()
    assert {(r.doc_id, r.train_tokens, r.n_known, round(r.score / math.log10(2))) for r in made} == {(2, 0, 0, -24), (3, 0, 0, -8)}
    none = spark.createDataFrame([], "doc_id long, text string, held_out boolean")
    assert lm_scoring.score_texts(none).collect() == []


def test_ordered_keys_are_stored_as_differences(spark):
    import os

    from pyspark.sql import functions as F

    from viewtide.llm import lm_scoring
    from viewtide.session import materialise

    keys = spark.range(0, 200_000, 1, 1).select(F.xxhash64("id").alias("key")).sortWithinPartitions("key")
    plain, apart = materialise(keys, "plain", "zstd"), materialise(keys, "apart", "zstd", **lm_scoring.DELTAS)
    size = [sum(os.path.getsize(f.removeprefix("file://")) for f in t.inputFiles()) for t in (plain, apart)]
    assert size[1] < 0.95 * size[0]
    assert apart.exceptAll(plain).count() == 0 and apart.count() == 200_000
