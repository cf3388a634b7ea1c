import re
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import oracle
from tests.llm.cases import documents, frame, plain, prose
from viewtide.llm import grace_dedup
from viewtide.llm.queries import op11_grace_dedup, oracle_sql


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_force(rows):
    """Each row's (doc_id, keep_id, group_size, text_sha256), and how many rows stay."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = min(ids, key=lambda x: (x is None, x or 0))
        digest = sha256(text.encode()).hexdigest()
        out += [(x, keep, len(ids), digest) for x in ids]
    return sorted(out, key=repr), len(groups)


def checked(result, rows):
    got = result.collect()
    want, n_groups = brute_force(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == n_groups and all(r.doc_id == r.keep_id for r in kept)


def hot_rows():
    rows = [(k, prose(k % 40, 30 + k % 40)) for k in range(200)]
    rows += [(1000 + k, "the  hot \n text " * 20) for k in range(300)]
    return rows + [(2000 + k, "") for k in range(60)] + [(None, "the hot text " * 20), (1000, "the hot text " * 20)]


@pytest.mark.parametrize("limit", [16 << 20, 20_000, 1_500])
def test_groups_of_awkward_rows(spark, limit):
    rows = [(r[0], r[1]) for r in documents()]
    checked(grace_dedup.exact_groups(frame(spark), limit), rows)


@pytest.mark.parametrize("limit", [40_000, 4_000, 900])
def test_hot_texts_meet_again(spark, limit):
    rows = hot_rows()
    checked(grace_dedup.exact_groups(plain(spark, rows, "doc_id long, text string").repartition(5), limit), rows)


def test_contents_decide_and_not_hashes(spark):
    rows = hot_rows()
    weak = F.length("_text").cast("long") % 3
    checked(grace_dedup.exact_groups(plain(spark, rows, "doc_id long, text string"), 6_000, key=weak), rows)


def test_large_buckets_are_dealt_again_until_they_fit(spark):
    one = F.lit(1).cast("long").alias("n")
    sizes = spark.range(4000).select((F.col("id") * 12).alias("h"), F.lit(100).cast("long").alias("bytes"), one)
    n, plan = grace_dedup.bucket_plan(sizes, 5_000)
    assert n == 160
    held = plan.join(sizes, "h").groupBy("bucket").agg(F.sum("bytes").alias("held"))
    assert held.agg(F.max("held")).first()[0] <= 5_000
    # Multiples of 12 use only 40 of 160 buckets, so all are too large.
    assert plan.count() == plan.select("h").distinct().count() == 4000


def test_nothing_moves_where_all_fit(spark):
    sizes = spark.range(10).select(F.xxhash64("id").alias("h"), F.lit(1).cast("long").alias("bytes"), F.lit(1).alias("n"))
    assert grace_dedup.bucket_plan(sizes, 1000) == (1, None)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=3), max_size=40), st.integers(1, 4))
def test_open_addressing_against_a_dictionary(texts, modulus):
    offsets = np.cumsum([0, *map(len, texts)])
    hashes = np.array([sum(t) % modulus for t in texts], np.int64)
    got = grace_dedup.ContentTable(np.frombuffer(b"".join(texts), np.uint8), offsets, hashes).groups()
    assert got.tolist() == [texts.index(t) for t in texts]


def test_whole_rows_stay(spark):
    docs = frame(spark).withColumn("_text", F.lit("x")).withColumn("in_text", F.lit(1)).withColumn("kept", F.lit(2))
    kept = grace_dedup.keep_first(docs, 20_000)
    assert kept.columns == docs.columns
    assert kept.count() == brute_force([(r[0], r[1]) for r in documents()])[1]


def test_empty(spark):
    assert grace_dedup.exact_groups(frame(spark, [])).collect() == []
    assert grace_dedup.keep_first(frame(spark, [])).collect() == []


def test_query_equals_sql(spark):
    path = "/root/testdata/sf0.001"
    sql = oracle_sql()["op11_grace_dedup"]
    assert oracle.difference(op11_grace_dedup(spark, path), oracle.connect(path), sql) is None
