"""Ratings: what a factorisation leaves on the disks, its predictions, and lists of the best items."""

import random
import time

import numpy as np
import pytest
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from viewtide.operators import models, products
from viewtide.session import FREED, freed_shuffles, materialise, release

PAIR = "user_id string, movie_id string"


def local_files(spark):
    """Shuffle files and kept blocks on this machine's disk."""
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def rated(spark, users=40, items=30):
    rng = random.Random(4)
    rows = [(f"u{u}", f"m{m}", 4.0 * (u % 3 == m % 3) + rng.random()) for u in range(users) for m in range(items) if (u + 3 * m) % 4]
    return spark.createDataFrame(rows, f"{PAIR}, user_rating double")


def settled(spark, most):
    """Files that stay once Spark has removed what nothing holds."""
    release(spark)
    for _ in range(50):
        if local_files(spark) <= most:
            break
        time.sleep(0.2)
    return local_files(spark)


def test_tables_written_inside_leave_no_shuffle_files(spark):
    release(spark)
    time.sleep(1)
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before, setting = local_files(spark), spark.conf.get(FREED)
    with freed_shuffles(spark):
        inside = materialise(grouped)
        assert spark.conf.get(FREED) == "true"
    assert local_files(spark) <= before and spark.conf.get(FREED) == setting
    assert inside.count() == 7


def test_a_rating_model_is_read_from_tables_and_keeps_no_shuffles(spark):
    before = settled(spark, 0)
    model = models.rating_model(rated(spark), rank=3, iterations=4)
    # The model is still in use here.
    assert settled(spark, before) <= before
    for side in (model.factors.userFactors, model.factors.itemFactors):
        assert side.inputFiles() and side.count() in (40, 30)


def test_predictions_are_those_of_the_factorisation(spark):
    ratings = rated(spark)
    model = models.rating_model(ratings, rank=3, iterations=3)
    numbered = ratings.join(model.users, "user_id").join(model.items, "movie_id")
    own = {(r.user_id, r.movie_id): r.prediction + model.mean for r in model.factors.transform(numbered).collect()}
    odd = [("u1", "none"), ("none", "m2"), (None, "m2"), ("u1", None), ("u1", "m2"), ("u1", "m2")]
    pairs = ratings.select("user_id", "movie_id").union(spark.createDataFrame(odd, PAIR))
    found = models.predicted_ratings(model, pairs).collect()
    assert len(found) == len(own) + 6 and all(r.predicted_rating == own.get((r.user_id, r.movie_id)) for r in found)


# -- greatest products ----------------------------------------------------------------------------


def vectors(spark, values, parts):
    schema = "id int, features array<float>"
    return spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(values)], schema).repartition(parts)


def check_best(found, users, items, n):
    products = users.astype(np.float64) @ items.astype(np.float64).T
    assert sorted(r.user for r in found) == list(range(len(users)))
    for r in found:
        ids, scores = [x["item"] for x in r.best], [x["rating"] for x in r.best]
        assert len(set(ids)) == len(ids) == min(n, len(items))
        assert np.allclose(scores, products[r.user][ids], atol=1e-4)
        # Of equal products the higher id comes first, and nothing greater is left out.
        assert [(-s, -k) for s, k in zip(scores, ids)] == sorted((-s, -k) for s, k in zip(scores, ids))
        assert np.allclose(scores, np.sort(products[r.user])[::-1][: len(ids)], atol=1e-4)


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_best_items_are_those_of_all_pairs(spark, spread):
    """Users in a few directions and users in all of them; some vectors are zero."""
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(4, 6))
    users = (middle[rng.integers(4, size=500)] + spread * rng.normal(size=(500, 6))).astype(np.float32)
    items = rng.normal(size=(700, 6)).astype(np.float32)
    users[:3], items[:3] = 0, 0
    found = products.best_items(vectors(spark, users, 3), vectors(spark, items, 4), 6, 5).collect()
    check_best(found, users, items, 5)


def test_fewer_items_than_wanted_and_equal_ones(spark):
    users, items = np.float32([[1, 0], [0, 0], [-1, 2]]), np.float32([[1, 1], [2, 0], [1, 1], [2, 0]])
    for n in (2, 9):
        found = products.best_items(vectors(spark, users, 2), vectors(spark, items, 2), 2, n).collect()
        check_best(found, users, items, n)
    best = {r.user: [x["item"] for x in r.best] for r in found}
    assert best == {0: [3, 1, 2, 0], 1: [3, 2, 1, 0], 2: [2, 0, 3, 1]}


def test_far_pairs_are_not_multiplied(spark, monkeypatch):
    def all_pairs(*_):
        raise AssertionError("all pairs")

    monkeypatch.setattr(ALSModel, "recommendForAllUsers", all_pairs)
    ratings = rated(spark)
    model = models.rating_model(ratings, rank=3, iterations=3)
    best = models.recommendations(model, 4).collect()
    assert len(best) == 160 and all(int(r.user_id[1:]) % 3 == int(r.movie_id[1:]) % 3 for r in best)
    pairs = spark.createDataFrame([(r.user_id, r.movie_id) for r in best], PAIR)
    own = {(r.user_id, r.movie_id): r.predicted_rating for r in models.predicted_ratings(model, pairs).collect()}
    assert all(abs(own[r.user_id, r.movie_id] - r.predicted_rating) < 1e-5 for r in best)

    rng = np.random.default_rng(6)
    middle = np.eye(8, dtype=np.float32)
    items = (middle[np.arange(4000) % 8] + rng.normal(scale=0.02, size=(4000, 8))).astype(np.float32)
    users = (middle[:1] + rng.normal(scale=0.02, size=(100, 8))).astype(np.float32)
    directions = users / np.linalg.norm(users, axis=1)[:, None]
    centre = directions.mean(0)
    least = np.sort(users @ items.T, 1)[:, -5] - np.float32(1e-4)
    block = {
        "users": users, "centres": centre, "least": least, "user_ids": np.arange(100, dtype=np.int32), "starts": np.int32([0, 100]),
        "reach": np.float32([np.linalg.norm(directions - centre, axis=1).max() + 1e-4]), "floor": np.float32([(least / np.linalg.norm(users, axis=1)).min()]),
    }
    # What a block's users get does not change when the items of the other directions are left out.
    held = {k: np.asarray(v, v.dtype).tobytes() for k, v in block.items()}
    near = np.arange(4000) % 8 == 0
    whole = [np.concatenate(x) for x in zip(*products._meet(held, np.arange(4000, dtype=np.int32), items, 8, 5))]
    alone = [np.concatenate(x) for x in zip(*products._meet(held, np.arange(4000, dtype=np.int32)[near], items[near], 8, 5))]
    assert all(np.allclose(a, b) for a, b in zip(whole, alone)) and len(whole[0]) == 500
