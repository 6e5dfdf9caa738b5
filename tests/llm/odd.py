"""Odd documents for every operator, and brute-force helpers."""

import random
import re

COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, id string, key string, "
           "score double, text_key string, block bigint, spans string, n bigint, words string")


def rows(extra=()):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    long_text = " ".join(rng.choice(vocabulary) for _ in range(12_000))
    base = " ".join(rng.choice(vocabulary) for _ in range(80))
    near = base.split()
    near[40] = "other"
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, "x" * 60_000), (5, long_text),
        (6, base), (7, base), (7, base), (8, " ".join(near)), (9, base.upper()),
        (10, "Ünïcode é𝄞 ▁ words\x00 here　too and so on"), (11, "one"), (12, "one two"),
        (13, "mail a.b@c-d.org, 10.0.0.256 10.0.0.25 +1 (017) 555-7713 4539578763621486 end"),
        (14, "the same line\nthe same line\n\nthe same line again and again and again and again"),
        (15, "run " * 90), (16, "run " * 70 + "stop"), (None, "a text without an id, " + base[:200]),
        (None, None), (17, "  two  spaces   and more "), *extra]
    return [(i, t, lang, "src", None if t is None else len(t), "id", "key", 0.5, "k", 3, "s", 4, "w")
            for k, (i, t) in enumerate(texts) for lang in [[None, "en", "fr"][k % 3]]]


def frame(spark, extra=()):
    return spark.createDataFrame(rows(extra), COLUMNS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
