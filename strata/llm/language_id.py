"""Language identification (operator 6): sparse multinomial logistic regression on TF-IDF
character n-grams, trained with FTRL-proximal and elastic-net penalties, then calibrated
with a temperature.

Characters are lower-cased letters (all others count as a space); their 1-, 2- and 3-grams
are hashed to ``DIMS`` features. Document frequencies come from all documents that may be
learned from, counted in tasks and summed by Spark. The classifier itself is fitted on at
most ``SAMPLE`` documents of each language, those with the smallest seeded hashes of their
ids; one in five of them sets the temperature. Scoring is one pass over the texts: each
character adds the weights of the n-grams it ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (
    cell_batch,
    chunks,
    earlier,
    frugal,
    give_back,
    row_sums,
    summed_cells,
    text_buffers,
    training_rows,
)

DIMS = 1 << 16
ORDERS = 3
SAMPLE = 600
EPOCHS = 4
# FTRL-proximal: learning rate, smoothing, L1 and L2 penalties
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
SCALE = 20.0
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: its symbol (lower-case letter, else a space), and if it is a letter."""
    symbol = np.full(0x110000, 32, np.uint32)
    letter = np.zeros(0x110000, bool)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            symbol[i], letter[i] = (ord(low) if len(low) == 1 else i), True
    return symbol, letter


def features(column) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each order, the feature of the n-gram that ends at each character of the column;
    the characters' offsets by row; the letters of each row."""
    data, offsets = text_buffers(column)
    symbol, letter = _characters()
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    offsets = begins[offsets]
    letters = row_sums(letter[points], offsets).astype(np.int64)
    symbols = symbol[points]
    out, code = [], symbols * np.uint32(0x9E3779B1)
    for k in range(ORDERS):
        if k:
            code = code ^ (earlier(symbols, offsets, k, 32) * np.uint32(0x85EBCA6B + 2 * k * 0x1F35))
            code = code * np.uint32(0xC2B2AE35)
        mixed = code ^ (code >> np.uint32(15))
        out.append(((mixed * np.uint32(0x27D4EB2F + 2 * k)) >> np.uint32(16)).astype(np.int32))
    return out, offsets, letters


def document_frequencies(rows: DataFrame) -> np.ndarray:
    """The rows (column text) that hold each feature; the last cell counts the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DIMS + 1, np.int64)
        seen = np.zeros(DIMS, bool)
        for part in chunks(batches, "text"):
            grams, offsets, _ = features(part.column("text"))
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                for g in grams:
                    seen[g[a:b]] = True
                df[:-1] += seen
                seen[:] = False
            df[-1] += part.num_rows
        yield cell_batch(df)

    return summed_cells(rows.select("text").mapInArrow(run, "cell bigint, n bigint"), DIMS + 1)


def _sample(rows: DataFrame, size: int) -> DataFrame:
    """At most ``size`` rows of each language, those with the least hashes of their ids. Rows
    are thinned by the language's count first, so that no language is sorted as a whole."""
    n = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    draw = F.xxhash64(F.lit(11), "id", "text")
    share = (draw.cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    # one row a language: the model itself holds weights for each of them on the driver
    thin = rows.join(F.broadcast(n), "lang").where(share * F.col("n") <= 2.0 * size) \
        .withColumn("draw", draw)
    return thin.selectExpr("*", "row_number() over (partition by lang order by draw) as place") \
        .where(F.col("place") <= size).select("lang", "text", "draw")


def _collect_features(sample: DataFrame) -> tuple[list[str], list[np.ndarray], list[np.ndarray]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            grams, offsets, _ = features(part.column("text"))
            dims, values = [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                d, n = np.unique(np.concatenate([g[a:b] for g in grams]), return_counts=True)
                dims.append(d.astype(np.int32))
                values.append((n / max(1, b - a)).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), part.column("draw"), pa.array(dims, pa.list_(pa.int32())),
                 pa.array(values, pa.list_(pa.float32()))], ["lang", "draw", "dims", "tf"])

    rows = sample.mapInArrow(run, "lang string, draw bigint, dims array<int>, tf array<float>") \
        .toArrow().sort_by([("draw", "ascending"), ("lang", "ascending")])
    return (rows["lang"].to_pylist(), [np.array(x.values) for x in rows["dims"]],
            [np.array(x.values) for x in rows["tf"]])


def fit_ftrl(labels: np.ndarray, dims: list[np.ndarray], values: list[np.ndarray],
             classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights [DIMS, classes] and biases, by per-coordinate FTRL-proximal."""
    z = np.zeros((DIMS + 1, classes))
    n = np.zeros((DIMS + 1, classes))

    def weights(at):
        free = np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0)
        return -free / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    order = np.random.default_rng(5)
    bias = np.array([DIMS])
    for _ in range(EPOCHS):
        for i in order.permutation(len(labels)):
            at = np.concatenate([dims[i], bias])
            x = np.concatenate([values[i], [1.0]])[:, None]
            w = weights(at)
            logits = (w * x).sum(0)
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            g = x * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(DIMS + 1))
    return w[:-1].astype(np.float32), w[-1]


class Model:
    """Languages, one weight per feature and language (IDF included), biases, temperature."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray,
                 temperature: float):
        self.languages, self.weights, self.bias = languages, weights, bias
        self.temperature = temperature

    def logits(self, column) -> tuple[np.ndarray, np.ndarray]:
        grams, offsets, letters = features(column)
        total = np.zeros((len(offsets) - 1, len(self.languages)))
        for k, language_weights in enumerate(self.weights.T):
            value = language_weights[grams[0]]
            for g in grams[1:]:
                value += language_weights[g]
            total[:, k] = row_sums(value, offsets)
        return total / np.maximum(np.diff(offsets), 1)[:, None] + self.bias, letters


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", sample: int = SAMPLE) -> Model | None:
    """A model learned from the rows with a language whose id is not held out (crc32 of the id
    as text, 1 modulo 3); None without such rows."""
    rows = docs.where(docs[lang_col].isNotNull() & training_rows(id_col, 3, 1)).select(
        docs[id_col].alias("id"), docs[lang_col].alias("lang"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"))
    df = document_frequencies(rows)
    if df[-1] == 0:
        return None
    idf = np.log((1.0 + df[-1]) / (1.0 + df[:-1])) + 1.0
    langs, dims, tf = _collect_features(_sample(rows, sample))
    languages = sorted(set(langs))
    label = np.array([languages.index(x) for x in langs])
    values = [SCALE * t * idf[d] for d, t in zip(dims, tf, strict=True)]
    held = np.arange(len(label)) % 5 == 0
    learn = np.flatnonzero(~held) if (~held).any() else np.arange(len(label))
    weights, bias = fit_ftrl(label[learn], [dims[i] for i in learn], [values[i] for i in learn],
                             len(languages))
    # the temperature with the least log loss on the rows kept aside
    logits = np.array([(weights[dims[i]] * values[i][:, None]).sum(0) + bias
                       for i in np.flatnonzero(held)])
    grid = np.exp(np.linspace(np.log(0.5), np.log(20), 121))
    loss = [-np.log(_softmax(logits / t)[np.arange(len(logits)), label[held]] + 1e-12).mean()
            for t in grid]
    return Model(languages, (weights * (SCALE * idf)[:, None]).astype(np.float32), bias,
                 float(grid[int(np.argmin(loss))]))


def keep_known(docs: DataFrame, model: Model | None, text_col: str = "text",
               least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is known with a score of
    ``least`` or more (a null text's is not). Only texts go to the Python workers, and a yes or no
    comes back. Without a model, which no row had a language to learn from, texts with a letter
    stay."""
    if model is None:
        return docs.where(F.coalesce(docs[text_col], F.lit("")).rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def known(column: pa.Array) -> pa.Array:
        out = []
        for part in chunks(iter([pa.RecordBatch.from_arrays([column], ["text"])]), "text"):
            _, score = _scored(shared.value, part.column("text"))
            out.append(score >= least)
        give_back()
        return pa.array(np.concatenate(out) if out else np.zeros(0, bool))

    known.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return docs.where(F.arrow_udf(known, "boolean")(F.coalesce(docs[text_col], F.lit(""))))


def _scored(model: Model, column) -> tuple[list[str], np.ndarray]:
    """The language of each text and its score (``und`` and 0 without a letter)."""
    logits, letters = model.logits(column)
    p = _softmax(logits / model.temperature)
    best, known = p.argmax(axis=1), letters > 0
    score = np.where(known, p[np.arange(len(p)), best], 0.0)
    lang = [model.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
    return lang, score


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Every row of ``docs``: id, lang_pred, score (the calibrated probability of lang_pred).
    Null texts and texts without a letter are ``und`` with score 0, as is every text without a
    model. Ties go to the first language by name. Repeated rows stay; other columns are not
    read."""
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            lang, score = _scored(shared.value, part.column("text")) if shared.value else \
                ([UNKNOWN] * part.num_rows, np.zeros(part.num_rows))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(lang, pa.string()), pa.array(score)],
                [id_col, "lang_pred", "score"])

    return source.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
