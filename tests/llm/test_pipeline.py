import hashlib

import sentencepiece

import corpus_pipeline
from strata.llm.queries import queries, tokenizer_path

from . import odd
from .test_decontamination import brute as contamination
from .test_parity_join import brute as groups
from .test_pii import base


def redacted(text):
    out, at = "", 0
    for start, _, stop, kind in base(text):
        if start >= at:
            out += text[at:start] + f"<{kind}>"
        at = max(at, stop)
    return out + text[at:]


def test_run_equals_the_stages_by_brute_force(spark, sf_small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    left = [(i, t) for i, t in docs.items() if t and any(c.isalpha() for c in t)]
    left = [(i, docs[i]) for i, _, group in groups(left, 80, 5) if i == group]
    left = [(r[0], docs[r[0]]) for r in contamination(left, items) if not r[4]]
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    want = []
    for i, text in left:
        ids = library.encode(redacted(text))
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()))
    got = odd.plain(corpus_pipeline.run(spark, sf_small), "doc_id", "n_tokens", "ids_sha256")
    assert got == sorted(want, key=repr)
    assert 0 < len(got) < len(docs)


def test_stages_take_odd_and_empty_tables(spark, sf_small):
    for df in (odd.frame(spark), odd.empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, sf_small)
            assert out.columns == df.columns
            assert out.count() <= df.count()
        out = corpus_pipeline.STAGES[-1][1](spark, df, sf_small)
        assert out.count() == df.count() and out.columns[0] == "doc_id"


def test_every_operator_is_registered():
    names = list(queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
