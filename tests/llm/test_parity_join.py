import collections
import random

import pytest

from strata.llm import parity_join
from strata.llm.components import components

from . import odd


def brute(rows, percent, size):
    sets = []
    for _, text in rows:
        w = odd.words(odd.lowered(text))
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size
                    else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = collections.defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)].append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        group = min(least[root(i)], default=None) if sets[i] else doc
        out.append((doc, len(sets[i]), group))
    return sorted(out, key=repr)


def near_copies(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(words) for _ in range(rng.choice([8, 30, 90, 200]))] for _ in range(6)]
    rows = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("percent,shingle", [(90, 3), (80, 5)])
def test_components_equal_brute_force(spark, percent, shingle):
    rows = near_copies(percent)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for tile, bucket_bytes in ((3, 10_000), (4096, 1 << 24)):
        got = parity_join.similar_groups(df, percent=percent, shingle=shingle, tile=tile,
                                         bucket_bytes=bucket_bytes)
        assert odd.plain(got, "doc_id", "n_shingles", "component_id") == brute(rows, percent, shingle)


def test_odd_documents(spark):
    rows = [(r[0], r[1]) for r in odd.rows()]
    got = parity_join.similar_groups(odd.frame(spark))
    assert odd.plain(got, "doc_id", "n_shingles", "component_id") == brute(rows, 90, 3)
    assert parity_join.similar_groups(odd.empty(spark)).collect() == []
    kept = parity_join.keep_one(odd.frame(spark), percent=80, shingle=5)
    assert kept.columns == odd.frame(spark).columns
    ids = sorted((r.doc_id for r in kept.collect() if r.doc_id is not None))
    want = [doc for doc, _, group in brute(rows, 80, 5) if doc is not None and doc == group]
    assert ids == sorted(set(want))
    # neither of the rows without an id is in a group with an id
    assert kept.where("doc_id is null").count() == 2
    assert parity_join.keep_one(odd.empty(spark)).collect() == []


def test_linked_pairs_share_a_segment():
    import numpy as np
    rng = np.random.default_rng(2)
    for size in (1, 5, 12, 40, 300, 2000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        allowed = 2 * len(a) // 19
        gone = min(len(a) - 1, allowed // 2)
        b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2**63, gone).astype(np.uint64)]))
        keys = [set(parity_join.segment_keys(x, 90).tolist()) for x in (a, b)]
        assert keys[0] & keys[1]


def test_components_of_random_graphs(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_a_column_named_like_its_own_stays(spark):
    df = spark.createDataFrame([(1, "one two three four", "mine"), (2, "one two three four", "yours")],
                               "doc_id int, text string, __text_key string")
    assert [tuple(r) for r in parity_join.keep_one(df).collect()] == [(1, "one two three four", "mine")]
