import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import documents, frame, plain, prose
from viewtide.llm import simhash


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))


def edit(text, following):
    text, half = text or "", len(text or "") // 2
    return text[: len(text) - half] + (following or "")[:half]


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def brute_fingerprint(spark, text):
    """Votes of single term hashes, one by one."""
    own = (text or "").lower().strip(" \t\n\x0b\f\r")
    import re

    words = re.split("[ \t\n\x0b\f\r]+", own) if own else []
    terms = [words[k : k + simhash.TERM_WORDS] for k in range(max(len(words) - simhash.TERM_WORDS, 0) + 1)] if words else []
    votes = [0] * 64
    for term in terms:
        h = spark.range(1).select(F.xxhash64(*(F.lit(w) for w in term))).first()[0] & ((1 << 64) - 1)
        for k in range(64):
            votes[k] += 1 if h >> k & 1 else -1
    return f"{sum(1 << k for k in range(64) if votes[k] > 0):016x}"


def test_fingerprints_match_votes(spark):
    texts = ["a b c d a b c", "one", "two words", "", None, "é ß x  y\nz"]
    rows = [(k, text, "en", "a") for k, text in enumerate(texts)]
    made = simhash.compare_with_edits(plain(spark, rows)).collect()
    for r in made:
        assert r.fingerprint == brute_fingerprint(spark, texts[r.doc_id])


@pytest.mark.parametrize("bucket_bytes", [200, 1 << 22])
def test_edits_and_neighbours(spark, bucket_bytes):
    rows = [r for r in documents() if r[0] != 14] + [
        (k * k * 50, prose(300 + k, 5 + k), "en", "a", 1, 0.5, "v", 7, "k", 3) for k in range(1, 60)
    ]
    made = simhash.compare_with_edits(frame(spark, rows), bucket_bytes).collect()
    ordered = in_order(rows)
    want, first = [], {}
    prints = {}
    for r in made:
        prints.setdefault(str(r.doc_id), set()).add(r.fingerprint)
    for row, following in zip(ordered, [*ordered[1:], ordered[0]]):
        edited = edit(row[1], following[1])
        want.append((str(row[0]), len(row[1] or ""), hashlib.sha256(edited.encode()).hexdigest()))
        first[str(row[0])] = str(following[0])
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in made) == sorted(want)
    for r in made:
        near = 1 - bin(int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).count("1") / 64
        assert r.near_edited == near
        if len(prints[str(r.doc_id)]) == 1 and len(prints[first[str(r.doc_id)]]) == 1:
            [other] = prints[first[str(r.doc_id)]]
            assert r.near_next == 1 - bin(int(r.fingerprint, 16) ^ int(other, 16)).count("1") / 64


def test_near_copies_are_near(spark):
    base = prose(5, 400)
    rows = [(2, base, "en", "a"), (1, base.replace("the", "The") + " end", "en", "a"), (0, prose(6, 400), "en", "a")]
    near = {r.doc_id: r.near_next for r in simhash.compare_with_edits(plain(spark, rows)).collect()}
    assert near[2] > 0.9 and near[1] < 0.75


@pytest.mark.parametrize("radius, blocks", [(3, 6), (2, 3), (0, 2), (5, 7)])
def test_block_tables_find_all_within_the_radius(spark, radius, blocks):
    rng = random.Random(radius)
    found = [rng.getrandbits(64) for _ in range(200)]
    queries = []
    for value in found[:60]:
        for bit in rng.sample(range(64), rng.randrange(0, radius + 3)):
            value ^= 1 << bit
        queries.append(value)
    want = {
        (signed(q), signed(f), bin(q ^ f).count("1"))
        for q, f in itertools.product(queries, found)
        if bin(q ^ f).count("1") <= radius
    }
    schema = "fingerprint long"
    rows = simhash.within_radius(
        spark.createDataFrame([(signed(q),) for q in queries] + [(None,)], schema),
        spark.createDataFrame([(signed(f),) for f in found * 2] + [(None,)], schema),
        radius,
        blocks,
    ).collect()
    assert sorted(map(tuple, rows)) == sorted(want)


def test_only_built_in_functions_and_empty(spark):
    frames = [simhash.compare_with_edits(frame(spark, []))]
    assert frames[0].collect() == []
    one = simhash.compare_with_edits(plain(spark, [(5, "a b c d", "en", "a")]))
    [row] = one.collect()
    assert row.near_next == 1
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_queries_are_sought_among_all_documents(spark):
    """Copies and near copies of long texts, against all pairs of written fingerprints."""
    rows = []
    for k in range(60):
        words = prose(k % 12, 500).split(" ")
        if k % 3:
            words[40 * (k % 7)] = f"changed{k}"
        rows.append((k, " ".join(words), "en", "a", 1, 0.5, "v", 7, "k", 3))
    rows += [(100 + k, text, "en", "a", 1, 0.5, "v", 7, "k", 3) for k, text in enumerate(["", None, "one"])]
    rows.append((None, rows[0][1], "en", "a", 1, 0.5, "v", 7, "k", 3))
    made = simhash.compare_with_edits(frame(spark, rows), every=4).collect()
    assert len(made) == len(rows)
    sizes = set()
    for r in made:
        near = [o for o in made if bin(int(r.fingerprint, 16) ^ int(o.fingerprint, 16)).count("1") <= simhash.RADIUS]
        asks = r.doc_id is not None and r.doc_id % 4 == 0
        want = (len(near), min(o.doc_id for o in near if o.doc_id is not None)) if asks else (None, None)
        assert (r.n_within, r.least_within) == want
        if asks:
            sizes.add((len(near), len({o.fingerprint for o in near}) > 1))
    assert max(sizes)[0] > 2 and any(several for _, several in sizes)
