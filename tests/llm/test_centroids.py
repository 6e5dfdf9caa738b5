import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import centroids

from . import odd

COLUMNS = "vec_id bigint, embedding array<float>, label int, id string, v string, cluster string, distance double"


def frame(spark, rows):
    return spark.createDataFrame([(i, x, 1, "id", "v", "c", 0.5) for i, x in rows], COLUMNS).repartition(3)


def brute(rows, dims, clusters, rounds):
    kept = [(i, [math.floor(256 * float(c)) for c in x]) for i, x in rows
            if x is not None and len(x) == dims and all(c is not None and math.isfinite(c) for c in x)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middle = [list(v) for _, v in start[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), k) for k, m in enumerate(middle))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for k, vs in groups.items():
            middle[k] = [sum(c) // len(vs) for c in zip(*vs)]
    return sorted([(i, *nearest(v)[::-1]) for i, v in kept], key=repr), middle


def vectors(dims):
    rng = np.random.default_rng(5)
    spots = rng.normal(size=(5, dims))
    rows = [(i, (spots[i % 5] + rng.normal(size=dims) * 0.3).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200, None), (201, []), (202, [0.0] * (dims - 1)), (203, [float("nan")] * dims),
             (204, [None] + [1.0] * (dims - 1)), (205, [float("inf")] + [0.0] * (dims - 1)),
             (206, [0.0] * dims), (207, [-0.001] * dims), (None, [1.0] * dims), (None, [2.0] * dims)]
    return rows + [rows[3], rows[3]]


def test_equals_brute_force(spark):
    for dims, clusters, rounds in ((8, 7, 4), (8, 400, 2), (3, 1, 1)):
        rows = vectors(dims)
        found = centroids.cluster(frame(spark, rows), dims=dims, clusters=clusters, rounds=rounds)
        want, middle = brute(rows, dims, clusters, rounds)
        assert odd.plain(found.members, "vec_id", "cluster", "distance") == want
        assert found.centroids.tolist() == middle


def test_inertia_and_digests(spark):
    rows = vectors(8)
    found = centroids.cluster(frame(spark, rows), dims=8, clusters=6)
    want, middle = brute(rows, 8, 6, 5)
    got = centroids.with_inertia(found).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.inertia == sum(d for _, _, d in want)
        assert r.cluster_inertia == sum(d for _, k, d in want if k == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, middle[r.cluster])).encode()).hexdigest()


def test_empty_and_too_large(spark):
    none = centroids.cluster(frame(spark, [(1, None), (2, [1.0])]), dims=8)
    assert none.members.collect() == [] and len(none.centroids) == 0
    assert centroids.with_inertia(none).collect() == []
    with pytest.raises(Exception, match="vector 7"):
        centroids.cluster(frame(spark, [(7, [1e30] * 8)]), dims=8)


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_search_is_exact_and_skips_centroids(data):
    dims = data.draw(st.integers(1, 6))
    top = data.draw(st.sampled_from([2, 300, centroids.largest_component(dims) - 1]))
    number = st.integers(-top, top)
    rows = st.lists(st.lists(number, min_size=dims, max_size=dims), min_size=1, max_size=30)
    x, c = (np.array(data.draw(rows), np.int64) for _ in range(2))
    chosen, best, measured = centroids.Search(c).nearest(x)
    for row, k, d in zip(x.tolist(), chosen.tolist(), best.tolist()):
        assert (d, k) == min((sum((a - b) ** 2 for a, b in zip(row, m)), j) for j, m in enumerate(c.tolist()))
    assert measured <= len(x) * len(c)


def test_most_centroids_are_rejected_unmeasured():
    rng = np.random.default_rng(1)
    c = rng.integers(-200, 200, (40, 64)) + np.linspace(-400, 400, 40).astype(np.int64)[:, None]
    x = c[rng.integers(0, 40, 2000)] + rng.integers(-20, 20, (2000, 64))
    assert centroids.Search(c).nearest(x)[2] < 5 * len(x)
