import math
import random
from hashlib import sha256

import numpy as np
import pytest

from viewtide.llm import vector_codes
from viewtide.llm.queries import op12_vector_codes, oracle_sql
import oracle

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, parts=8, entries=16, rounds=6):
    """All distances in every round, by Python integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return {}, ""
    width = math.ceil(max(len(r[1]) for r in kept) / parts)
    whole = []
    for _, vector, _ in kept:
        v = [math.floor(4096 * x) for x in vector] + [0] * (parts * width)
        whole.append([v[p * width : (p + 1) * width] for p in range(parts)])
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[list(whole[i][p]) for i in order] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(books[p]))

    for _ in range(rounds):
        made = [[nearest(p, v[p])[1] for p in range(parts)] for v in whole]
        for p in range(parts):
            for j in range(len(books[p])):
                own = [v[p] for v, codes in zip(whole, made) if codes[p] == j]
                if own:
                    books[p][j] = [sum(column) // len(own) for column in zip(*own)]
    result = []
    for (vec_id, _, label), v in zip(kept, whole):
        found = [nearest(p, v[p]) for p in range(parts)]
        result.append((vec_id, label, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found)))
    text = ",".join(str(x) for p in books for c in p for x in c)
    return sorted(result, key=repr), sha256(text.encode()).hexdigest()


def vectors(seed, n, dims, spread=0.3, scale=1.0):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(20)]
    rows = []
    for k in range(n):
        centre = rng.choice(centres)
        vector = [float(np.float32(scale * (c + rng.gauss(0, spread)))) for c in centre]
        rows.append((3 * k + rng.randrange(3), vector, rng.choice([0, 1, 1, None])))
    return rows


def awkward():
    rows = vectors(5, 60, 16)
    rows += [(7, None, 1), (None, [0.5] * 16, 2), (9, [], 1), (10, [None] * 16, 1), (11, [math.nan] * 16, 1)]
    rows += [(12, [math.inf] + [0.0] * 15, 1), (13, [0.25] * 5, None), (14, [0.1] * 16, 3), (14, [0.1] * 16, 3)]
    rows += [(15 + k, [0.1] * 16, 3) for k in range(40)]
    return rows


@pytest.mark.parametrize(
    "rows",
    [vectors(1, 300, 64), vectors(2, 200, 13), awkward(), vectors(3, 9, 16), vectors(4, 120, 16, scale=900.0), []],
    ids=["plain", "odd_width", "awkward", "few", "large", "empty"],
)
def test_codes_are_those_of_exact_rounds(spark, rows):
    coded, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3))
    want, text = brute_force(rows)
    got = sorted(((r.vec_id, r.label, r.code, r.error) for r in coded.collect()), key=repr)
    assert got == list(want)
    if rows:
        assert vector_codes.digest(books) == text


def test_long_numbers_are_exact(spark):
    rows = [(k, [2.0**11 * (k + 1) + 1 / 4096 * i for i in range(8)], 1) for k in range(30)]
    assert vector_codes.numeric_kind(2.0**11 * 31, 8, 1, 4096) is np.int64
    coded, _ = vector_codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    got = sorted(((r.vec_id, r.label, r.code, r.error) for r in coded.collect()), key=repr)
    assert got == brute_force(rows)[0]
    with pytest.raises(ValueError, match="beyond a long"):
        vector_codes.numeric_kind(1e30, 8, 1, 4096)


def test_net_displacement_is_tighter_and_saves_rescans():
    """An entry that comes back to its place has drifted, but has no displacement."""
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.integers(0, 50, (200, 4)), rng.integers(900, 950, (200, 4))])
    home = np.array([[25] * 4, [925] * 4])
    away = home + 400
    kept = vector_codes.Bounds.fresh(400, 1)
    history = home[None, None].astype(np.int64)
    scans = []
    for number, now in enumerate([home, away, home]):
        history = np.concatenate([history[:1]] if not number else [history, now[None, None]])
        books = vector_codes.Codebooks(history, np.float64)
        scans.append(books.assign(0, x.astype(np.float64), kept, number == 0)[1])
    assert scans[0] == 400 and scans[2] == 0
    drift = sum(np.sqrt(((history[k + 1] - history[k]) ** 2).sum(-1)) for k in range(2))
    assert (books.moved[0] < drift).all()


def test_extra_columns_and_types(spark):
    rows = [(str(k), [0.1 * k, 0.2, 0.3], f"l{k % 2}", 1, b"x") for k in range(20)]
    frame = spark.createDataFrame(rows, "vec_id string, embedding array<double>, label string, code int, ids binary")
    coded, _ = vector_codes.compress(frame)
    assert coded.columns == ["vec_id", "label", "code", "error"] and coded.count() == 20


def test_query_equals_sql(spark):
    path = "/root/testdata/sf0.001"
    sql = oracle_sql()["op12_vector_codes"]
    assert oracle.difference(op12_vector_codes(spark, path), oracle.connect(path), sql) is None
