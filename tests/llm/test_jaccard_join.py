import math
import random

import numpy as np
import pytest

from tests.llm.cases import documents, frame, lower, plain, prose, words
from viewtide.llm import components as cc
from viewtide.llm import jaccard_join as jj


def shingles(text):
    own = words(lower(text))
    if len(own) < 5:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[k : k + 5]) for k in range(len(own) - 4))


def brute(rows):
    """(doc_id, size, smallest reachable doc_id) by all pairs."""
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                group[find(a)] = find(b)
    members = {}
    for k in range(len(rows)):
        members.setdefault(find(k), []).append(rows[k][0])
    lowest = {root: min((i for i in ids if i is not None), default=None) for root, ids in members.items()}
    return sorted((str(rows[k][0]), len(sets[k]), str(lowest[find(k)] if sets[k] else rows[k][0])) for k in range(len(rows)))


def found(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def edited(text, rng, n):
    own = text.split(" ")
    for _ in range(n):
        own[rng.randrange(len(own))] = f"w{rng.randrange(999)}"
    return " ".join(own)


def corpus():
    """Short and long families with zero to many edits, and a passage that all documents share."""
    rng = random.Random(5)
    rows, passage = [], prose(77, 30)
    for family in range(14):
        base = prose(200 + family, rng.choice([6, 9, 12, 17, 60, 200, 400]))
        for _ in range(rng.randrange(2, 9)):
            rows.append((len(rows) * 3 + 1, edited(base, rng, rng.choice([0, 0, 1, 2, 4])), "en", "a"))
    for _ in range(40):
        rows.append((len(rows) * 3 + 1, prose(500 + len(rows), 25) + " " + passage, "en", "a"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("light", [None, 0, 12])
def test_groups_match_all_pairs(spark, monkeypatch, light):
    if light is not None:
        monkeypatch.setattr(jj, "light_boundary", lambda histogram: light)
    rows = corpus()
    assert found(jj.similar_groups(plain(spark, rows).repartition(4))) == brute(rows)


def test_dealt_lists_and_known_frequent_shingles(spark, monkeypatch):
    monkeypatch.setattr(jj, "LIST_PART", 4)
    monkeypatch.setattr(jj, "FREQUENT", 2)
    rows = corpus()
    rng = random.Random(8)
    base = prose(999, 150)
    rows += [(5000 + k, edited(base, rng, rng.choice([0, 1, 2, 6])), "en", "a") for k in range(60)]
    assert found(jj.similar_groups(plain(spark, rows).coalesce(2))) == brute(rows)


def test_awkward_rows(spark):
    assert found(jj.similar_groups(frame(spark))) == brute(documents())
    assert jj.similar_groups(frame(spark, [])).collect() == []


def test_keep_one_of_each_group(spark):
    docs = frame(spark)
    kept = jj.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    want = {(doc, component) for doc, _, component in brute(documents())}
    assert ids == sorted([doc for doc, component in want if doc == component] + ["16"] + ["None"])
    assert jj.keep_one(frame(spark, [])).collect() == []


@pytest.mark.parametrize("a, b", [(1, 1), (3, 4), (9, 12), (100, 100), (75, 100), (8, 10)])
def test_overlap_is_the_least_that_links(a, b):
    least = min(c for c in range(min(a, b) + 1) if 100 * c >= 75 * (a + b - c))
    assert jj.overlap(a, b) == least


def test_least_shared_holds_for_every_partner():
    for n in range(1, 150):
        assert jj.prefix(n) >= n - math.ceil(0.75 * n) + 1
        for m in range(math.ceil(0.75 * n), 4 * n // 3 + 1):
            shared = jj.overlap(n, m) - max(n - jj.prefix(n), m - jj.prefix(m))
            assert jj.least_shared(n) <= max(1, shared)


def test_boundary_follows_cost():
    assert jj.light_boundary({3: 1000, 4: 1000, 400: 10}) >= 4
    assert jj.light_boundary({14: 1000}) < 14
    assert jj.light_boundary({}) == 0


def test_hash_sets_depend_on_words_and_their_order():
    import pyarrow as pa

    sets = list(jj.shingle_sets(pa.array(["a b c", "a c b", "A  b\nc", "ab c", "", None, "a b c d e", "a b c d e f"])))
    assert [len(s) for s in sets] == [1, 1, 1, 1, 0, 0, 1, 2]
    assert np.array_equal(sets[0], sets[2])
    assert len({s[0] for s in (sets[0], sets[1], sets[3])}) == 3
    assert sets[6][0] in sets[7]


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 30)] + [(3, 3), (50, 7), (None, 4), (7, 8)]
    rows = cc.components(spark.createDataFrame(edges, "u long, v long")).collect()
    got = {r.node: r.component for r in rows}
    assert len(got) == len(rows)
    assert {got[k] for k in range(100, 141)} == {100}
    assert {got[k] for k in [7, 50, *range(8, 30)]} == {7}
    assert 3 not in got and 4 not in got
    assert cc.components(spark.createDataFrame([], "u long, v long")).collect() == []
