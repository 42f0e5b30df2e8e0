"""Centroid clustering against plain rounds in Python's own integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cindermill.llm import clustering

SCHEMA = "vec_id long, embedding array<float>, label int, v string, own int"


def hard_rows():
    rng = random.Random(3)
    centres = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, 0.15) for x in centres[i % 12]], i % 3, "x", 1) for i in range(500)]
    rows += [(600 + i, [0.25] * 64, 0, None, None) for i in range(60)]  # equal vectors: ties
    rows += [rows[7], rows[7], rows[9]]  # repeated rows
    rows += [(700, None, 0, "", 0), (701, [], 0, "", 0), (702, [0.1] * 63, 0, "", 0), (703, [0.1] * 63 + [None], 0, "", 0), (704, [0.1] * 63 + [math.nan], 0, "", 0), (705, [math.inf] + [0.1] * 63, 0, "", 0)]
    return rows + [(None, [-0.3] * 64, 0, "", 0), (706, [-500.0] * 64, 0, "", 0)]


def plain(rows):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e, *_ in rows if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:40]]
    if not kept:
        return []
    matrix = np.array([v for _, v in kept], object)

    def assign():
        d = np.array([((matrix - np.array(c, object)) ** 2).sum(1) for c in centroids]).T
        return [int(x) for x in d.argmin(1)], [int(x) for x in d.min(1)]

    for _ in range(5):
        own, _ = assign()
        for k in range(len(centroids)):
            if mine := [v for (_, v), o in zip(kept, own) if o == k]:
                centroids[k] = [sum(x) // len(mine) for x in zip(*mine)]
    own, d = assign()
    sums = [sum(x for x, o in zip(d, own) if o == k) for k in range(40)]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, o, x, sums[o], sum(d), names[o]) for (i, _), o, x in zip(kept, own, d)]


def test_digest_is_the_plain_result(spark):
    rows = hard_rows()
    out = clustering.digest(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(plain(rows), key=repr)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, n):
    rows = hard_rows()[:n]
    out = clustering.digest(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(plain(rows), key=repr)


def test_bounds_spare_distances_and_too_large_is_an_error(spark):
    rows = spark.createDataFrame(hard_rows()[:500], SCHEMA).select(F.col("vec_id").alias("id"), "embedding")
    state, history = clustering.clustered(clustering.integer_vectors(rows), rounds=8)
    assert len(history) == 9
    assert state.agg(F.sum("n_distances")).first()[0] < 500 * 40 / 4
    big = spark.createDataFrame([(1, [1e9] * 64)], "id long, embedding array<float>")
    with pytest.raises(ValueError, match="component"):
        clustering.clustered(clustering.integer_vectors(big))


def test_displacement_is_the_norm_of_the_sum():
    """A centroid that goes away and comes back loosens nothing: no distance is evaluated, though its drifts are large."""
    v = np.array([[0, 0], [100, 0]])
    history = [np.array([[0, 0], [100, 0]]), np.array([[40, 0], [60, 0]]), np.array([[0, 0], [100, 0]])]
    own, at = np.array([0, 1]), np.zeros((2, 2), np.int64)
    stored = clustering.all_squared(v, history[0])
    assert clustering.reassigned(v, own, stored, at, history) == 0
    assert own.tolist() == [0, 1]


def test_random_histories_stay_exact():
    rng = np.random.default_rng(5)
    for _ in range(30):
        v, c = rng.integers(-6, 6, (200, 3)), rng.integers(-6, 6, (7, 3))
        history = [c]
        stored = clustering.all_squared(v, c)
        own, at = stored.argmin(1), np.zeros(stored.shape, np.int64)
        for _ in range(6):
            history.append(history[-1] + rng.integers(-2, 3, c.shape))
            clustering.reassigned(v, own, stored, at, history)
            assert own.tolist() == clustering.all_squared(v, history[-1]).argmin(1).tolist()
