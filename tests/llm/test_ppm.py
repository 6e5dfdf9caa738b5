import collections
import math
import zlib

import numpy as np
import pyarrow as pa

from strata.llm import ppm

from . import odd


def trained(texts, depth, share=0.0):
    trie = ppm.Trie()
    trie.grow(np.full(ppm.SYMBOLS, ppm.ROOT), np.arange(ppm.SYMBOLS))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    for d in range(1, depth + 1):
        counted = np.zeros(2 * trie.size(d) * ppm.SYMBOLS, np.int64)
        cells, n = ppm.count_level(trie, d, iter([batch]))
        counted[cells] = n
        ppm.learn(trie, d, counted, d == depth, share)
    return trie


def scores(texts, scored, depth):
    """The scores that the query's functions give: grams of all texts meet, costs go back."""
    low = ppm.Low(trained(texts, min(depth, ppm.LOW)))
    grams = [ppm.grams_of(*ppm.symbols_of(pa.array([t])), depth) for t in [*texts, *scored]]
    found = ppm.GramCounts()
    for g in grams[:len(texts)]:
        found.add(g, np.ones(len(g), bool))
    for g in grams[len(texts):]:
        found.add(g, np.zeros(len(g), bool))
    known, n = found.result()
    cost = ppm.gram_costs(low, known, n, depth)
    return [cost[np.searchsorted(known, g)].sum() for g in grams[len(texts):]]


def brute(texts, scored, depth):
    """PPM with method C and exclusion, symbol by symbol."""
    def symbols(t):
        return [ppm.END] * depth + list(odd.lowered(t).encode()) + [ppm.END]
    seen = collections.defaultdict(collections.Counter)
    for t in texts:
        s = symbols(t)
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                seen[tuple(s[i - d:i])][s[i]] += 1
    total, s = 0.0, symbols(scored)
    for i in range(depth, len(s)):
        excluded = set()
        for d in range(depth, -1, -1):
            counts = {k: n for k, n in seen.get(tuple(s[i - d:i]), {}).items() if k not in excluded}
            if not counts:
                continue
            norm = sum(counts.values()) + len(counts)
            if s[i] in counts:
                total += math.log10(counts[s[i]] / norm)
                break
            total += math.log10(len(counts) / norm)
            excluded |= set(counts)
        else:
            total -= math.log10(ppm.SYMBOLS - len(excluded))
    return total


def test_equals_symbol_by_symbol_ppm():
    texts = ["abracadabra", "the cat sat on the mat", "Abba", "", "ünï"]
    scored = ["abra", "the dog", "", "zzz", "Über CATS"]
    for depth in (1, 2, 4, 5):
        for text, got in zip(scored, scores(texts, scored, depth), strict=True):
            assert abs(got - brute(texts, text, depth)) < 1e-6


def test_costs_after_a_context_are_a_distribution():
    texts = ["abracadabra", "the cat sat on the mat"]
    low = ppm.Low(trained(texts, 2))
    context = ppm.grams_of(*ppm.symbols_of(pa.array(["the c"])), 3)[4] >> ppm.BITS << ppm.BITS
    seen = [ppm.grams_of(*ppm.symbols_of(pa.array([t])), 3) for t in texts]
    every = np.unique(np.concatenate([*seen, context | np.arange(ppm.SYMBOLS)]))
    n = np.array([sum((g == x).sum() for g in seen) for x in every])
    cost = ppm.gram_costs(low, every, n, 3)[every >> ppm.BITS << ppm.BITS == context]
    assert len(cost) == ppm.SYMBOLS and abs((10.0 ** cost).sum() - 1) < 1e-9


def test_blocks_are_dealt_to_different_partitions(spark):
    from pyspark.sql import functions as F
    names = ppm.block_names(spark.range(1), 23)
    rows = spark.range(0, 230).withColumn("block", F.get(F.lit(names).cast("array<bigint>"),
                                                         (F.col("id") % 23).cast("int")))
    dealt = rows.repartition(23, "block").groupBy(F.spark_partition_id()).agg(F.countDistinct("block")).collect()
    assert len(dealt) == 23 and all(r[1] == 1 for r in dealt)


def test_scores_of_odd_documents(spark):
    rows = odd.rows()
    count = collections.Counter()
    for r in rows:
        if zlib.crc32(str(r[0]).encode() if r[0] is not None else b"") % 7 != 2:
            count.update([*odd.words(odd.lowered(r[1])), ""])
    n, v = sum(count.values()), len(count)
    want = []
    for r in rows:
        words = [*odd.words(odd.lowered(r[1])), ""]
        held = zlib.crc32(str(r[0]).encode() if r[0] is not None else b"") % 7 == 2
        want.append((r[0], held, len(words), sum(count[w] > 0 for w in words), n,
                     round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words), 6)))
    for block_bytes in (1000, 1 << 24):
        out = ppm.score(odd.frame(spark), block_bytes=block_bytes, depth=3)
        got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
               for r in out.collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
        assert all(r.score < 0 and math.isfinite(r.score) for r in out.collect())


def test_without_training_rows(spark):
    assert ppm.score(odd.empty(spark)).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    df = spark.createDataFrame([(held, "abc")], "doc_id int, text string")
    row = ppm.score(df).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 2, 0, 0)
    assert abs(row.score + 4 * math.log10(257)) < 1e-4 and row.base_score == 0


def test_every_context_of_the_corpus_counts(spark):
    # contexts far under 1/131072 of the training bytes, in a longer order than the low trie's
    def training(i):
        return zlib.crc32(str(i).encode()) % 7 != 2
    texts = ["many words " * 60_000, "Ελληνικά και ქართული", "abracadabra", "Über alles", ""]
    rows = list(zip([i for i in range(100) if training(i)], texts, strict=False))
    held = list(zip([i for i in range(100) if not training(i)],
                    ["και ქართ", "abra words", "zzz"], strict=False))
    df = spark.createDataFrame(rows + held, "doc_id int, text string").repartition(3)
    counted = [t if len(t) < 1000 else "many words " * 60 for t in texts]
    want = {i: brute(counted, t, ppm.DEPTH) for i, t in held}
    small = spark.createDataFrame(list(zip(dict(rows), counted, strict=True)) + held,
                                  "doc_id int, text string").repartition(3)
    for block_bytes in (50, 1 << 24):
        got = {r.doc_id: r.score for r in ppm.score(small, block_bytes=block_bytes).collect()}
        assert all(abs(got[i] - want[i]) < 1e-3 for i in want)
    got = {r.doc_id: r.score for r in ppm.score(df).collect()}
    for i, t in rows[1:4]:  # rare texts of the training part stay known
        assert got[i] / len(t.encode()) > -0.5
