import collections
import random

import numpy as np

from strata.llm import ngram_quality as q

from . import odd


def base(text):
    w = odd.words(text)
    lines = [x for x in (text or "").split("\n") if odd.words(x)]
    seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j + k for j in range(len(w) - 2) if seen[tuple(w[j:j + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_base_counts_equal_brute_force(spark):
    extra = [(60, "a # b * c\na # b * c\n\na # b * c x"), (61, "a b " * 40), (62, "<p> | % & $ é")]
    got = q.quality(odd.frame(spark, extra))
    found = odd.plain(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed")
    assert found == sorted(((r[0], *base(r[1])) for r in odd.rows(extra)), key=repr)
    assert all(not r.kept for r in got.where("base_failed or entropy is null").collect())
    assert q.quality(odd.empty(spark)).collect() == []


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    counts = np.zeros(q.CLASSES ** q.ORDER, np.int64)
    np.add.at(counts, rng.zipf(1.3, 200_000) * 7919 % len(counts), 1)
    table = q.Model(counts).table().reshape(-1, q.CLASSES)
    assert np.abs((2.0 ** table.astype(float)).sum(axis=1) - 1).max() < 1e-4


def test_discounts_follow_the_counts_of_counts():
    counts = np.repeat([1, 2, 3, 4, 9], [400, 200, 120, 80, 50])
    y = 400 / 800
    assert np.allclose(q._discounts(counts), [0, 1 - 2 * y * 200 / 400, 2 - 3 * y * 120 / 200,
                                              3 - 4 * y * 80 / 120])


def test_odd_text_falls_out_of_its_language_band(spark):
    rng = random.Random(5)

    def text(letters):
        return " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(80))
    rows = [(i, text("etaoin"), "en") for i in range(200)]
    rows += [(500 + i, text("qzxjkvwp0123456789#"), "en") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = {r.doc_id for r in q.quality(df).where("kept").collect()}
    assert kept == set(range(200))


def test_copies_of_junk_do_not_widen_the_band(spark):
    rng = random.Random(7)

    def text(letters):
        return " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(80))
    junk = text("qzxjkvwp0123456789#")
    rows = [(i, text("etaoin"), "en") for i in range(200)]
    rows += [(500 + i, junk, "en") for i in range(100)]  # a third of all rows
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = {r.doc_id for r in q.quality(df).where("kept").collect()}
    assert kept == set(range(200))


def test_partitioned_model_equals_the_dense_one(spark):
    rng, letters = random.Random(11), [chr(c) for c in range(0x430, 0x430 + q.CLASSES - 1)]
    texts = ["".join(rng.choices(letters, weights=range(1, q.CLASSES), k=400)) for _ in range(60)]
    symbol = {x: i for i, x in enumerate(["\n", *letters])}  # a line end stands before a text
    counts = np.zeros(q.CLASSES ** q.ORDER, np.int64)
    codes = []
    for t in ["\n", *texts]:
        padded = [0] * (q.ORDER - 1) + [symbol[x] for x in t]
        codes.append([int(np.polyval(padded[i:i + q.ORDER], q.CLASSES)) for i in range(len(t))])
        np.add.at(counts, codes[-1], 1)
    table = q.Model(counts).table()
    df = spark.createDataFrame(list(enumerate(["\n", *texts])), "doc_id bigint, text string") \
        .selectExpr("doc_id", "text", "'x' AS lang")
    found = {r.id: r.entropy for r in q.document_statistics(df.repartition(3), order=q.ORDER).collect()}
    assert all(abs(found[i] + np.mean(table[c])) < 1e-4 for i, c in enumerate(codes))


def test_characters_are_not_folded(spark):
    rng = random.Random(13)

    def text(letters):
        return " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(80))
    # junk of characters whose bytes fell into the same classes: eight code points further, capitals
    for good, odd_ones in (("абвгде", "ийклмн"), ("ETAOIN", "QZXJKV"), ("012345", "678966")):
        rows = [(i, text(good), "x") for i in range(200)] + [(500 + i, text(odd_ones), "x") for i in range(2)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
        assert {r.doc_id for r in q.quality(df).where("kept").collect()} == set(range(200))
