import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import importance

from . import odd

ITEMS = [(1, "w1 w2 w3 w4 w5"), (2, None), (3, ""), (4, "Run run RUN; one, two! the same line")]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", odd.lowered(text))


def runs(text):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def bucket(run, buckets=10_000):
    return zlib.crc32(run.encode()) % buckets


def brute(docs, items, percent=5, min_words=20):
    s, t = (Counter(bucket(f) for _, x in rows for f in runs(x)) for rows in (docs, items))
    ss, tt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (ss + 10_000) / ((s[b] + 1) * (tt + 10_000)))) for b in s}
    out = []
    for i, x in docs:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in runs(x))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(words(x)), len(runs(x)), weight, score, None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[:len(able) * percent // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=repr)


def test_equals_brute_force(spark):
    docs = [(r[0], r[1]) for r in odd.rows()]
    columns = ("doc_id", "n_words", "n_features", "weight", "score", "rank")
    target = spark.createDataFrame(ITEMS, "item_id int, text string")
    for percent, least in ((5, 20), (50, 2), (100, 0)):
        found = importance.resample(odd.frame(spark), target, percent=percent, min_words=least)
        assert odd.plain(found, *columns) == brute(docs, ITEMS, percent, least)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id int, text string")
    assert importance.resample(odd.empty(spark), none).collect() == []
    docs = [(r[0], r[1]) for r in odd.rows()]
    found = importance.resample(odd.frame(spark), none)
    assert odd.plain(found, "doc_id", "n_words", "n_features", "weight", "score", "rank") == brute(docs, [])


TEXTS = st.lists(st.text(st.sampled_from("ab Z9é\n.一\x00"), max_size=40), max_size=6)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.sampled_from([1, 7, 1 << 20]))
def test_features_of_a_batch(texts, size):
    """Runs stay within their text, also where a batch is cut into pieces."""
    got = Counter()
    for n, doc, found in importance.features([t.encode() for t in texts], size=size):
        got.update((n, d, b) for d, b in zip(doc.tolist(), found.tolist()))
    assert got == Counter((f.count(" ") + 1, d, bucket(f)) for d, t in enumerate(texts) for f in runs(t))


def test_crc_of_joined_strings_with_long_tails():
    for length in (1, 2, 3, 255, 256, 70_001):
        head, tail = b"some head", b"x" * length
        tables, at = importance._shifts(np.array([length]))
        out = importance._appended(np.array([zlib.crc32(head)], np.uint32), tables, at,
                                   np.array([zlib.crc32(tail)], np.uint32))
        assert out[0] == zlib.crc32(head + tail)


def test_equal_ranks_are_gapless_over_ranges(spark):
    rows = spark.range(3000).selectExpr("id", "id % 7 as score")
    got = importance.ranked(rows, [rows["score"].desc(), rows["id"].asc()]).collect()
    want = sorted((-r.score, r.id) for r in got)
    assert [(-r.score, r.id) for r in sorted(got, key=lambda r: r.rank)] == want
    assert sorted(r.rank for r in got) == list(range(1, 3001))
