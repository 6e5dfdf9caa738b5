"""A corpus made ready for training: language identification, near duplicates, benchmark
decontamination, personal data, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns the
documents that go on, all but the last with the columns of ``docs``. What a stage returns is
written as Parquet and read again before the next; ``run`` does so in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontamination, language_id, parity_join, pii, piece_bpe
from strata.llm.common import materialise, read_table
from strata.llm.queries import tokenizer_path

# near duplicates: word shingles of five, similarity of 0.8 or more
SHINGLE, PERCENT = 5, 80


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised (operator 6); the model learns from ``docs``."""
    return language_id.keep_known(docs, language_id.fit(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (operator 10): the least doc_id."""
    return parity_join.keep_one(docs, percent=PERCENT, shingle=SHINGLE)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark (operator 9)."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind (operator 3); n_chars follows."""
    return pii.without_personal_data(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens (operator 8): doc_id, n_tokens, ids and the digests of ids and of
    the text they decode to."""
    return piece_bpe.encode_decode(docs, tokenizer_path("piece_bpe_32k.model")).drop("decoded")


STAGES = [
    ("language identification", known_languages),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", uncontaminated),
    ("personal data", redacted),
    ("SentencePiece", tokens),
]

# models, sketches and merges are not SQL: the pipeline is tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-").lower())
    return docs
