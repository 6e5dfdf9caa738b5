import random

from strata.llm import toxicity

from . import odd

BAD = ["idiot", "moron", "worthless", "pathetic", "disgusting"]


def corpus(n, seed):
    rng = random.Random(seed)
    parts = ["th", "er", "on", "an", "ing", "ea", "st", "re", "ou", "ly"]
    out = []
    for i in range(n):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(60)]
        if i % 4 == 0:
            for _ in range(5):
                words[rng.randrange(60)] = rng.choice(BAD)
        out.append((i, " ".join(words), int(i % 4 == 0)))
    return out


def test_held_out_accuracy():
    rows = corpus(400, 1)
    model = toxicity.train([t.encode() for _, t, y in rows if y], [t.encode() for _, t, y in rows if not y])
    fresh = corpus(200, 2)
    scores = model.scores([t.encode() for _, t, _ in fresh], {})
    assert sum((s >= 0.7) == bool(y) for s, (_, _, y) in zip(scores, fresh, strict=True)) >= 190
    assert not any(s >= 0.7 and not y for s, (_, _, y) in zip(scores, fresh, strict=True))


def test_odd_documents_and_labels(spark):
    rows = corpus(120, 3)
    df = odd.frame(spark, [(1000 + i, t) for i, t, _ in rows])
    marks = [(1000 + i, y, 0) for i, _, y in rows] + [(None, 1, 0), (1000, None, 1), (1000, 1, 1), (5, 0, 0)]
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int, quality int")
    got = toxicity.score(df, toxicity.fit(df, labels, sample=50)).collect()
    assert len(got) == len(odd.rows()) + 120 and all(0 <= r.score <= 1 for r in got)
    empties = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(empties) == 1


def test_without_labels_nothing_is_toxic(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.fit(odd.frame(spark), none)
    assert all(r.score < 0.1 for r in toxicity.score(odd.frame(spark), model).collect())
    assert toxicity.score(odd.empty(spark), model).collect() == []


def test_parts_of_many_words_in_each_language():
    # no toxic word repeats: a part begins ever new words, and stands in ordinary ones now and then
    tongues = [("réeux", "a é on tion que ch pa è re ux"), ("achlich", "sch ein ung ß ver ö te ie ha ch"),
               ("bomente", "os ado ción ra mi te ez ñ lo me")]

    def texts(n, seed):
        rng = random.Random(seed)
        out = []
        for i in range(n):
            part, tails = tongues[i % 3]
            tails = tails.split()

            def tail(least):
                return "".join(rng.choice(tails) for _ in range(rng.randint(least, 4)))
            words = [tail(1) for _ in range(200)]
            bad = i % 5 == 0
            for _ in range(6 if bad else rng.randint(0, 1)):
                words[rng.randrange(200)] = part + tail(2)
            out.append((" ".join(words).encode(), bad))
        return out
    rows = texts(600, 1)
    model = toxicity.train([t for t, y in rows if y], [t for t, y in rows if not y])
    fresh = texts(300, 2)
    marked = model.scores([t for t, _ in fresh], {}) >= 0.7
    for tongue in range(3):
        own = [(m, y) for m, (_, y) in list(zip(marked, fresh, strict=True))[tongue::3]]
        assert sum(m for m, y in own if y) >= 17 and sum(m for m, y in own if not y) <= 2
