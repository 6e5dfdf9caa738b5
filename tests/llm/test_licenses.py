import re

from strata.llm import licenses

from . import odd

MIT = licenses.NOTICES[0].text
APACHE = licenses.NOTICES[1].text


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", odd.lowered(text))


def base(text):
    w = words(text)
    found = []
    for t in licenses.PHRASES:
        p = words(t.text)
        found += [(i, t.label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return sorted(i for i, _ in found), sorted({label for _, label in found})


def filler(n, prefix):
    return " ".join(f"{prefix}{i}" for i in range(n))


NOTICE_ROWS = [
    (100, filler(300, "a") + " " + MIT + " " + filler(200, "b")),
    # words left out, added and changed
    (101, filler(40, "c") + " Permission is hereby granted free of charge to any person obtaining copy of this "
          "nice software and associated documents files the Software to deal in the Software without any "
          "restriction " + filler(9, "d")),
    (102, "Permission is hereby granted to nobody. " + filler(30, "e")),
    (103, APACHE + "\n" + filler(500, "f") + "\n" + APACHE + " " + MIT),
    (104, "released UNDER the MIT-license, under the\nMIT license; Apache License, Version 2.0; CC BY-NC 4"),
    (105, "under the mit licenses; the mit license; cc by n c"),
    (106, "to deal in the Software without restriction " * 400),
    (None, MIT), (None, MIT),
]


def test_base_places_equal_brute_force(spark):
    found = licenses.scan(odd.frame(spark, NOTICE_ROWS))
    got = odd.plain(found, "doc_id", "n_words", "places", "base")
    want = sorted(((r[0], len(words(r[1])), *base(r[1])) for r in odd.rows(NOTICE_ROWS)), key=repr)
    assert got == want


def test_notices_are_found_and_verified(spark):
    by_id = {}
    for r in licenses.scan(odd.frame(spark, NOTICE_ROWS)).collect():
        by_id.setdefault(r.doc_id, []).append(r)
        assert set(r.base) <= set(r.labels) and 0 <= r.score <= 1
    whole = by_id[100][0]
    assert whole.labels == ["mit"] and whole.base == [] and whole.score == 1.0
    assert [(s.start, s.stop) for s in whole.spans] == [(300, 300 + len(words(MIT)))]
    changed = by_id[101][0]
    assert changed.labels == ["mit"] and 0.7 <= changed.score < 1.0 and changed.spans[0].start >= 40
    assert by_id[102][0].labels == [] and by_id[102][0].score < 0.7
    twice = by_id[103][0]
    assert [s.label for s in twice.spans] == ["apache-2", "apache-2", "mit"]
    assert by_id[106][0].labels == [] and by_id[105][0].labels == []
    assert by_id[104][0].labels == ["apache-2", "cc-by-nc", "mit"] and by_id[104][0].score == 1.0
    nameless = [r for r in by_id[None] if r.labels == ["mit"]]
    assert len(nameless) == 2 and sum(len(v) for v in by_id.values()) == len(odd.rows(NOTICE_ROWS))


def test_shuffled_templates_give_the_same(spark, monkeypatch):
    docs = odd.frame(spark, NOTICE_ROWS)
    columns = ("doc_id", "places", "labels", "score", "spans")
    small = odd.plain(licenses.scan(docs), *columns)
    monkeypatch.setattr(licenses, "BROADCAST_WORDS", 0)
    assert odd.plain(licenses.scan(docs), *columns) == small


def test_empty_tables_and_templates(spark):
    assert licenses.scan(odd.empty(spark)).collect() == []
    none = licenses.scan(odd.frame(spark), notices=[], phrases=[licenses.Template("short", "of the", True)])
    rows = none.collect()
    assert len(rows) == len(odd.rows()) and all(r.labels == [] and r.score == 0 for r in rows)
