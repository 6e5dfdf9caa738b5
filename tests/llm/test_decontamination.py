import re

from strata.llm import decontamination

from . import odd


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", odd.lowered(text))


def brute(docs, items):
    out = []
    for i, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, t in items:
            b = words(t)
            n = min(10, len(b))
            grams = {tuple(b[k:k + n]) for k in range(len(b) - n + 1)} if b else set()
            for p in range(len(w) - n + 1):
                if grams and tuple(w[p:p + n]) in grams:
                    hit.update(range(p, p + n))
                    found.add(item)
        names = sorted(str(f) for f in found if f is not None)
        out.append((i, len(w), len(hit), names, bool(hit)))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    docs = odd.rows()
    long_words = docs[4][1].split()
    items = [(1, " ".join(long_words[100:130])), (2, " ".join(long_words[11_980:])), (3, "ONE, two!"),
             (4, "run"), (5, None), (6, "..."), (None, " ".join(long_words[500:512])),
             (7, " ".join(long_words[100:112])), (8, "the same line the same"), (9, "nowhere at all")]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    found = decontamination.find_contamination(odd.frame(spark), benchmark)
    got = odd.plain(found, "doc_id", "n_words", "n_hit", "items", "contaminated")
    assert got == brute([(r[0], r[1]) for r in docs], items)
    assert all(r.n_items == len(r["items"]) for r in found.collect())
    kept = decontamination.drop_contaminated(odd.frame(spark), benchmark)
    assert kept.columns == odd.frame(spark).columns
    clean = [g[0] for g in got if not g[4]]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id int, text string")
    assert decontamination.find_contamination(odd.empty(spark), none).collect() == []
    got = decontamination.find_contamination(odd.frame(spark), none)
    assert got.where("contaminated or n_hit > 0").count() == 0 and got.count() == len(odd.rows())
