import re

from pyspark.sql import functions as F

from strata.llm import pii

from . import odd

FORMS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4)
                    for i, d in enumerate(map(int, reversed(digits))))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base(text):
    return sorted((m.start(), o, m.end(), kind) for o, (kind, form) in enumerate(FORMS)
                  for m in re.finditer(form, text or "") if valid(kind, m.group()))


TRICKY = ["a@b.c_d@e.f g..h@x-y.zz- a@b a@b..c", "1.2.3.4.5.6.7.8 999.1.2.3.4.5.6.7 0255.0.0.1 1.1.1.1",
          "é𝄞 4539 5787 6362 1486 and 4539-5787-6362-1486-1 4539  5787", "+1 (017) 555-7713.+44 20 7946 0958)",
          "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2", "+" * 50 + "1" * 5000, "a" * 5000 + "@",
          "49927398716 79927398713 00000000000000 000000000000000000000"]


def test_base_spans_equal_brute_force(spark):
    extra = [(50 + i, t) for i, t in enumerate(TRICKY)]
    got = pii.find_personal_data(odd.frame(spark, extra))
    found = sorted(((r.doc_id, [(s.start, s.order, s.stop, s.kind) for s in r.spans if s.kind != "other"])
                    for r in got.collect()), key=repr)
    assert found == sorted(((r[0], base(r[1])) for r in odd.rows(extra)), key=repr)
    assert pii.find_personal_data(odd.empty(spark)).collect() == []


def test_cues_discover_unseen_identifiers_and_leave_clean_texts(spark):
    texts = [f"please write to Mail: user{i}@host{i}.org about it" for i in range(6)]
    texts += ["please write to Mail: bob77_at_corp about it", "we met in 1999 at 5pm", "call 112 now"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = {r.doc_id: [(s.kind, s.start, s.stop) for s in r.spans]
           for r in pii.find_personal_data(df).collect()}
    assert out[6] == [("other", 22, 35)] and out[7] == [] and out[8] == []
    assert out[0] == [("email", 22, 37)]
    clean = {r.doc_id: r.text for r in pii.without_personal_data(df).collect()}
    assert clean[0] == "please write to Mail: <email> about it"
    assert clean[6] == "please write to Mail: <other> about it" and clean[7] == texts[7]


def test_redaction_keeps_columns_and_follows_the_length(spark):
    out = pii.without_personal_data(odd.frame(spark))
    assert out.columns == odd.frame(spark).columns and out.count() == len(odd.rows())
    row = out.where("doc_id = 13").first()
    assert "<email>" in row.text and "<ip>" in row.text and "10.0.0.256" in row.text
    assert row.n_chars == len(row.text)
    assert pii.without_personal_data(odd.empty(spark)).collect() == []


def test_running_results_of_any_length(spark):
    import itertools
    sizes = [0, 1, 2, 3, 4, 7, 16, 17, 63, 64, 65, 300]
    rows = [(n, [(k * 7919) % 31 - 15 for k in range(n)]) for n in sizes]
    df = spark.createDataFrame(rows, "n int, v array<int>")
    for piece in (2, 4, 64, 256):
        got = df.select("n", pii._running(F.col("v"), F.lit(0), lambda x, y: x + y, piece).alias("s"),
                        pii._running(F.col("v"), F.lit(-99), F.greatest, piece).alias("m")).collect()
        for r in got:
            v = dict(rows)[r.n]
            assert r.s == list(itertools.accumulate(v))
            assert r.m == list(itertools.accumulate(v, max))


def test_many_matches_in_one_text(spark):
    import random
    rng = random.Random(6)
    words = ["a.b@c.de", "10.0.0.%d", "x%d", "é𝄞", "(017)", "+49 30 12345678", "4539578763621486", "%d"]
    text = " ".join(w % rng.randrange(400) if "%" in w else w
                    for w in (rng.choice(words) for _ in range(3000)))
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    spans = pii.find_personal_data(df).first().spans
    assert [(s.start, s.order, s.stop, s.kind) for s in spans if s.kind != "other"] == base(text)
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at:s.start], f"<{s.kind}>"]
        at = max(at, s.stop)
    assert pii.without_personal_data(df).first().text == "".join(out) + text[at:]


def test_columns_named_like_its_own(spark):
    df = spark.createDataFrame([(1, "to a@b.cd now", "x", "y", 13)],
                               "doc_id int, text string, __spans string, __key string, n_chars int")
    out = pii.without_personal_data(df)
    assert out.columns == df.columns and tuple(out.first()) == (1, "to <email> now", "x", "y", 14)
