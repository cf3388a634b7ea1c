import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import oracle
from tests.llm.cases import documents, frame, lower, plain, prose
from viewtide.llm import ball_search
from viewtide.llm.queries import op13_ball_search, oracle_sql

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall(lower(text))


def brute_force(docs, items, top=20):
    """Every document scored for every item."""
    held = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    n_docs = sum(1 for _, tf in held if tf)
    n_terms = sum(sum(tf.values()) for _, tf in held)
    df = Counter(t for _, tf in held for t in tf)
    out = []
    for item_id, text in set(items):
        scores = []
        for doc_id, tf in held:
            if tf:
                m = 75 + 25 * sum(tf.values()) * n_docs // n_terms
                score = 0
                for t in terms(text):
                    if t in tf:
                        w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        score += w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m))
                if score > 0:
                    scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def checked(result, docs, items, top=20):
    got = sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in result.collect()), key=repr)
    assert got == brute_force(docs, items, top)


def items():
    return [
        (1, prose(1, 40)),
        (2, prose(2, 12).upper()),
        (3, "über sch nothing known"),
        (3, "one two three"),
        (4, None),
        (5, ""),
        (6, "!!! ..."),
        (7, "nowhere-to-be-found"),
        (None, "four 123"),
        (8, "one two three"),
        (8, "one two three"),
    ]


@pytest.mark.parametrize("sizes", [{}, {"leaf_docs": 2, "tree_docs": 5, "levels": 2, "sample": 6, "item_bytes": 60}])
def test_ranks_of_awkward_rows(spark, sizes):
    docs = [(r[0], r[1]) for r in documents()]
    result = ball_search.rank_documents(frame(spark), plain(spark, items(), ITEMS), **sizes)
    checked(result, docs, items())


@pytest.mark.parametrize("top", [1, 3, 20])
def test_copies_and_ties(spark, top):
    docs = [(k, prose(k % 7, 20)) for k in range(150)] + [(200 + k, prose(500 + k, 50)) for k in range(100)]
    own = [(k, prose(k, 20)) for k in range(10)] + [(20, prose(500, 50))]
    result = ball_search.rank_documents(
        plain(spark, docs, "doc_id long, text string").repartition(4), plain(spark, own, ITEMS), top, 4, 30, 3, 16
    )
    checked(result, docs, own, top)


def test_text_ids_and_extra_columns(spark):
    docs = spark.createDataFrame([("b", "one two", 1, 5), ("a", "one two", 1, 6)], "doc_id string, text string, rank int, n int")
    own = spark.createDataFrame([("x", "two", 3)], "item_id string, text string, doc_id int")
    rows = ball_search.rank_documents(docs, own).collect()
    # Both hold every term, and the weight of a term held by all is floor(1000 * ln(6 / 5)).
    assert [(r.item_id, r.rank, r.doc_id) for r in rows] == [("x", 1, "a"), ("x", 2, "b")]


@pytest.mark.parametrize("empty", ["docs", "items", "both"])
def test_empty(spark, empty):
    docs = frame(spark, [] if empty != "items" else None)
    own = plain(spark, [] if empty != "docs" else items(), ITEMS)
    assert ball_search.rank_documents(docs, own).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(1, 6))
def test_bounds_hold_and_searches_are_exact(seed, n, leaf_docs):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(0, 9, n)
    rows = np.concatenate([[0], np.cumsum(lengths)])
    held = [np.sort(rng.choice(30, k, replace=False)) for k in lengths]
    vectors = ball_search.Sparse(rows, np.concatenate(held).astype(np.int64), rng.integers(1, 10**10, rows[-1]))
    order, nodes = ball_search.halves(vectors, 30, leaf_docs)
    assert sorted(order.tolist()) == list(range(n))
    vectors = vectors.take(order)
    tree = ball_search.Tree(vectors, nodes, leaf_docs)
    at = np.unique(rng.integers(0, 30, 6))
    often = rng.integers(1, 4, len(at))
    query = np.zeros(30, np.int64)
    query[at] = often
    scores = vectors.dot(query)
    known = np.flatnonzero(np.isin(at, tree.known))
    if len(known):
        bounds = tree.bounds(np.searchsorted(tree.known, at[known]), often[known])
        for (start, stop), bound in zip(nodes, bounds):
            assert scores[start:stop].max(initial=0) <= bound
    best = ball_search.Best(3)
    visited = 0
    for start, own in tree.search(at, often, best.threshold):
        visited += 1
        best.add(own, lambda k, start=start: int(order[start + k]))
    want = sorted((-int(s), False, int(d)) for s, d in zip(scores, order) if s > 0)[:3]
    assert best.rows == want


def test_far_subtrees_are_not_visited():
    """Two groups of documents without common terms: an item of one visits none of the other."""
    terms_of = [np.arange(5) + (0 if k < 32 else 5) for k in range(64)]
    vectors = ball_search.Sparse(np.arange(65) * 5, np.concatenate(terms_of), np.full(320, 1000))
    order, nodes = ball_search.halves(vectors, 10, 8)
    tree = ball_search.Tree(vectors.take(order), nodes, 8)
    starts = [start for start, _ in tree.search(np.array([1, 2]), np.array([1, 1]), lambda: 1)]
    assert len(starts) == 4 and all((order[s : s + 8] < 32).all() for s in starts)
    # Equal documents have no radius, so a threshold above their score ends the search.
    assert list(tree.search(np.array([1, 2]), np.array([1, 1]), lambda: 2001)) == []


def test_query_equals_sql(spark):
    path = "/root/testdata/sf0.001"
    sql = oracle_sql()["op13_ball_search"]
    assert oracle.difference(op13_ball_search(spark, path), oracle.connect(path), sql) is None
