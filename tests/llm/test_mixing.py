import itertools
import math
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import documents, frame, plain
from viewtide.llm import mixing


def naive(weights, n):
    """Every slot looks at all sources: the released block that is due first."""
    total = sum(map(Fraction, weights.values()))
    share = {source: Fraction(w) / total for source, w in weights.items()}
    had = dict.fromkeys(weights, 0)
    out = []
    for slot in range(n):
        released = [s for s in weights if math.floor(had[s] / share[s]) <= slot]
        first = min(released, key=lambda s: (math.ceil((had[s] + 1) / share[s]), s is not None, s or ""))
        out.append((first, had[first]))
        had[first] += 1
    return out


WEIGHTS = [
    {"a": 1.0},
    {"a": 0.5, "b": 0.3, "c": 0.2},
    {"a": 1e6, "b": 1.0, None: 333.3},
    {"a": 5, "b": 1, "c": 1e-3, None: 2},
    dict.fromkeys("abcdefg", 1),
    {f"s{k}": (k + 1) ** 0.7 for k in range(40)},
]


@pytest.mark.parametrize("weights", WEIGHTS)
def test_whole_run_is_that_of_the_naive_schedule(weights):
    n = 3000
    assert list(itertools.islice(mixing.schedule(mixing.exact_parts(weights)), n)) == naive(weights, n)


@pytest.mark.parametrize("weights, n", [(w, 20_000) for w in WEIGHTS] + [({"a": 1e6, "b": 1.0, "c": 1e3}, 1_200_000)])
def test_schedule_stays_within_a_block_of_the_stated_weights(weights, n):
    total = sum(map(Fraction, weights.values()))
    had = Counter()
    for slot, (source, block) in enumerate(itertools.islice(mixing.schedule(mixing.exact_parts(weights)), n)):
        assert block == had[source]
        had[source] += 1
        if slot % 997 == 0 or n == 20_000:
            for other, weight in weights.items():
                assert abs(had[other] - Fraction(weight) * (slot + 1) / total) < 1
    assert had.total() == n and set(had) == {s for s, w in weights.items() if Fraction(w) * n >= total}


def test_a_run_ends_when_all_are_read_and_has_few_slots():
    parts = mixing.exact_parts({"a": 0.5, "b": 0.25, "c": 0.25})
    run = mixing.whole_run({"a": 4, "b": 3, "c": 1}, parts)
    had = Counter(source for source, _ in run)
    assert had["a"] >= 4 and had["b"] == 3 and run[-1] == ("b", 2)
    sizes = {"a": 200_000_000, "b": 3_000_000, "c": 160}
    weights = {s: n**0.7 for s, n in sizes.items()}
    parts = mixing.exact_parts(weights)
    own = mixing.block_size(sizes, parts, 1 << 14, 16)
    run = mixing.whole_run({s: math.ceil(n / own) for s, n in sizes.items()}, parts)
    # The smallest source has one block, which is due after 1 / share slots.
    assert 1 << 13 < len(run) <= max(1 << 14, sum(weights.values()) / weights["c"]) + 3
    had = Counter(source for source, _ in run)
    for source, weight in weights.items():
        assert abs(had[source] - weight / sum(weights.values()) * len(run)) < 1


@pytest.mark.parametrize("weights", [{"a": -1.0, "b": 2}, {"a": 0.0}, {}, {"a": float("nan")}])
def test_bad_weights(weights):
    with pytest.raises(ValueError):
        mixing.exact_parts(weights)


def test_a_weight_whose_first_block_never_comes_is_an_error():
    with pytest.raises(ValueError, match="below"):
        mixing.block_size({"a": 5, "b": 5}, mixing.exact_parts({"a": 1.0, "b": 1e-9}), 100, 1)


def test_default_weights_follow_the_text(spark):
    rows = [(1, "xxxx", "en", "a"), (2, None, "en", "a"), (3, "é", "en", None)]
    assert mixing.default_weights(plain(spark, rows), 1.0) == {"a": 6.0, None: 3.0}


@pytest.mark.parametrize("slots", [1 << 20, 9])
def test_mixture_is_whole_and_near_its_weights(spark, slots):
    weights = {"a": 0.6, "b": 0.2, "c": 0.1, None: 0.1}
    mixed = mixing.mix_sources(frame(spark), weights, slots, block_docs=2)
    rows = mixed.collect()
    assert mixed.columns[: len(frame(spark).columns)] == frame(spark).columns
    every = Counter((r[0], r[1]) for r in documents())
    for epoch in range(3):
        once = Counter((r.doc_id, r.text) for r in rows if r.epoch == epoch)
        assert once == every if not epoch else all(once[k] <= every[k] for k in once)
    assert len({r.position for r in rows}) == len(rows)
    taken = {}
    block = {(r.position - r.place) // r.slot for r in rows if r.slot}
    assert len(block) == 1 and (block == {2}) == (slots > 9)
    for r in rows:
        assert taken.setdefault(r.slot, r.source) == r.source
    had = Counter()
    assert sorted(taken) == list(range(len(taken))) and len(taken) <= slots + 4
    for slot in range(len(taken)):
        had[taken[slot]] += 1
        for source, weight in weights.items():
            assert abs(had[source] - weight * (slot + 1)) < 1


def test_numbers_are_gapless_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_DOCS", 3)
    rows = mixing.numbered(frame(spark)).collect()
    numbers = {}
    for r in rows:
        numbers.setdefault(r.source, []).append(r.number)
    assert all(sorted(x) == list(range(len(x))) for x in numbers.values())
    assert len(rows) == len(documents())


def test_missing_weight_is_an_error(spark):
    with pytest.raises(ValueError, match="without a positive weight"):
        mixing.mix_sources(frame(spark), {"a": 1.0})


def test_whole_rows_come_in_mixed_order(spark):
    docs = frame(spark).withColumnsRenamed({"version": "_position", "key": "_key", "bucket": "_part"})
    by = docs.select("doc_id", "text", "source", F.xxhash64(*docs.columns).alias("hash"))
    want = mixing.mix_sources(by, block_docs=2, by=F.col("hash"))
    order = [(r.doc_id, r.text) for r in want.orderBy("position").collect()]
    mixed = mixing.mixed_texts(docs, block_docs=2)
    assert mixed.columns == docs.columns
    assert [(r.doc_id, r.text) for r in mixed.collect()] == order
    # Partitions are ranges of positions, filled alike.
    held = [r[0] for r in mixed.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(held) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(held) <= 2 * min(held) + 2


def test_empty(spark):
    assert mixing.mix_sources(frame(spark, [])).collect() == []
    assert mixing.mixed_texts(frame(spark, [])).collect() == []
