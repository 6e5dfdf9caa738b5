import hashlib
import random

import pytest

from strata.llm import recompression

from . import odd


def brute(rows, window=20):
    seen, out = set(), []
    for i, text in rows:
        w = odd.words(text)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            if key in seen:
                gone[s:s + window] = [True] * window
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=repr)


def test_odd_documents(spark):
    rows = sorted(((r[0], r[1]) for r in odd.rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    for block_bytes in (20_000, 1 << 24):
        got = recompression.deduplicate(odd.frame(spark), block_bytes=block_bytes)
        assert odd.plain(got, "doc_id", "n_words", "n_removed", "kept_sha256", "kept") == brute(rows)
    assert recompression.deduplicate(odd.empty(spark)).collect() == []


@pytest.mark.parametrize("vocabulary", [1, 2, 3, 60])
def test_repeats_runs_and_periods(spark, vocabulary):
    rng = random.Random(vocabulary)
    words = [f"w{i}" for i in range(vocabulary)]
    base = [rng.choice(words) for _ in range(300)]
    rows = []
    for d in range(40):
        text = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.6:
                a = rng.randint(0, 270)
                text += base[a:a + rng.randint(1, 60)]
            elif kind < 0.8:
                text += [rng.choice(words)] * rng.randint(1, 50)
            else:
                text += [rng.choice(words) for _ in range(rng.randint(1, 40))]
        rows.append((3 * d, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = recompression.deduplicate(df, block_bytes=2000)
    assert odd.plain(got, "doc_id", "n_words", "n_removed", "kept_sha256", "kept") == brute(rows)


def test_equal_windows_take_equal_names():
    import numpy as np
    rng = np.random.default_rng(1)
    for symbols in (1, 2, 5, 1000):
        shared = rng.integers(0, symbols, 45).astype(np.uint64)
        texts = [np.concatenate([rng.integers(0, symbols, k), shared, rng.integers(0, symbols, 9)])
                 .astype(np.uint64) for k in (0, 7, 31)]
        found = []
        for k, t in zip((0, 7, 31), texts, strict=True):
            begin, name, _ = recompression.window_names(t * np.uint64(0x9E3779B97F4A7C15), np.array([len(t)]))
            found.append(name[np.searchsorted(begin, np.arange(k, k + 26))].tolist())
        assert found[0] == found[1] == found[2]
