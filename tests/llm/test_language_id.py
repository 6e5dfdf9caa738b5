import random

from pyspark.sql import functions as F

from strata.llm import language_id

from . import odd

SYLLABLES = {"en": ["th", "er", "on", "an", "ing"], "fr": ["eau", "é", "oi", "ment", "que"]}


def corpus(n=120):
    rng = random.Random(4)
    out = []
    for i in range(n):
        lang = ["en", "fr"][i % 2]
        text = " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(25))
        out.append((1000 + i, text, lang))
    return out


def test_learned_languages_are_found(spark):
    df = spark.createDataFrame(corpus(), "doc_id bigint, text string, lang string").repartition(3)
    model = language_id.fit(df, sample=20)
    assert model.languages == ["en", "fr"] and model.temperature > 0
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(df, model).collect()}
    assert all(got[i][0] == lang and 0.5 <= got[i][1] <= 1 for i, _, lang in corpus())


def test_odd_documents(spark):
    df = odd.frame(spark, [(i, t) for i, t, _ in corpus(20)])
    model = language_id.fit(df)
    got = language_id.predict(df, model)
    assert got.count() == len(odd.rows()) + 20
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in got.where("doc_id is not null").collect()}
    assert all(by_id[i] == ("und", 0.0) for i in (1, 2, 3))
    assert all(p in ("en", "fr", "und") and 0 <= s <= 1 for p, s in by_id.values())
    kept = language_id.keep_known(df, model)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} & {1, 2, 3} == set()
    assert {i for i, _, _ in corpus(20)} <= {r.doc_id for r in kept.collect()}


def test_without_rows_or_languages(spark):
    assert language_id.fit(odd.empty(spark)) is None
    df = odd.frame(spark).withColumn("lang", F.lit(None).cast("string"))
    assert language_id.fit(df) is None
    assert {r.lang_pred for r in language_id.predict(df, None).collect()} == {"und"}
    assert language_id.predict(odd.empty(spark), None).collect() == []
    one = df.withColumn("lang", F.lit("xx"))
    got = language_id.predict(one, language_id.fit(one))
    assert {r.lang_pred for r in got.collect()} == {"xx", "und"}
    # without a model a corpus is not lost
    kept = {r.doc_id for r in language_id.keep_known(df, None).collect()}
    assert {4, 5, 6, 11} <= kept and not kept & {1, 2, 3}
    assert language_id.keep_known(odd.empty(spark), None).collect() == []
