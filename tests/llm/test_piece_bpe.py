import hashlib
import random

import sentencepiece

from strata.llm import piece_bpe
from strata.llm.queries import tokenizer_path

from . import odd

PATH = tokenizer_path("piece_bpe_32k.model")


def test_equals_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = odd.plain(piece_bpe.encode_decode(odd.frame(spark), PATH),
                    "doc_id", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")
    want = []
    for r in odd.rows():
        ids = library.encode(r[1] or "")
        text = library.decode(ids)
        want.append((r[0], len(ids), ids, text,
                     hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert piece_bpe.encode_decode(odd.empty(spark), PATH, full=False).collect() == []


def test_random_units_and_runs_equal_the_library():
    library, encoder = sentencepiece.SentencePieceProcessor(model_file=PATH), piece_bpe.Encoder(PATH)
    rng = random.Random(1)
    texts = ["".join(rng.choice("abtheinr  \n▁é𝄞0. ") for _ in range(rng.randint(0, 60)))
             for _ in range(800)]
    texts += [" " * 300 + "then" + " " * 41, "a" * 999, "the" * 500, "<s> </s> <0x0A>"]
    split = [encoder.units(t.encode()) for t in texts]
    encoder.learn(split)
    for text, units in zip(texts, split, strict=True):
        assert b",".join([encoder.joined[u] for u in units]).decode() == \
            ",".join(map(str, library.encode(text)))


def test_decode_of_any_ids_equals_the_library():
    library, vocabulary = sentencepiece.SentencePieceProcessor(model_file=PATH), piece_bpe.Vocabulary(PATH)
    rng = random.Random(2)
    for _ in range(500):
        ids = [rng.randint(3, 600) for _ in range(rng.randint(0, 12))]
        assert vocabulary.decode(ids).decode() == library.decode(ids)
