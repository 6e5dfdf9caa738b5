"""Toxicity by compression distance (operator 4): two zstandard dictionaries, one trained on
toxic and one on ordinary text, compared by the compressed lengths of a text's windows.

A window is a word (ASCII-lower-cased, without outer ASCII punctuation). A word is written with eight
bytes for each byte, hashed from it and the ``BEFORE`` before it in the word, so that a literal is
dear and a match in a dictionary is cheap whatever the letters' own statistics. The gain of a
window is its length under the ordinary dictionary minus that under the toxic one.

Training uses a bounded sample of labelled rows: the texts of at most ``SAMPLE`` ids of each
label, those with the smallest seeded hashes. On one half word parts are compared by the share of
toxic and of ordinary texts that hold them at a rate of ``RATE`` or more, so that a part which
ordinary words have now and then tells too, in any language. The words of toxic texts with a
telling part make the toxic dictionary, words of ordinary texts without one the ordinary; for
``ROUNDS`` rounds those with a gain of ``LOW`` or more are added to the ordinary one again.
On the other half a logistic regression calibrates the numbers of windows above each of
``LEVELS`` to a score. Scoring is one pass over all texts; a task compresses each different
word once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import chunks, texts, training_rows

SAMPLE = 2000
SAMPLE_BYTES = 50_000  # longer texts are not sampled for training (they are scored)
ROUNDS = 2
LOW = 8
LEVELS = (8, 12, 16, 20, 24, 28, 32, 40)
TOXIC_BYTES, ORDINARY_BYTES = 112_640, 112_640
PART = range(4, 7)  # bytes of a word part, with a mark at the word's beginning and end
BEFORE = 4  # bytes of the word that a byte's code depends on, besides itself
RATE = 0.008  # a text holds a part that so many of its words have
MORE, SURE = 4.0, 5.0  # a telling part: so many times the share of ordinary texts, standard errors
ZSTD_LEVEL = 3
PUNCTUATION = bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
# different words a task remembers; beyond it the memory starts anew (the result is the same)
STORE = 400_000


def written(words: list[bytes]) -> list[bytes]:
    """Each word with eight bytes for every byte, from it and the ``BEFORE`` before it."""
    flat = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
    length = np.array([len(w) for w in words], np.int64)
    cut = np.concatenate([[0], np.cumsum(length)])
    place = np.arange(len(flat)) - np.repeat(cut[:-1], length)
    code = flat.copy()
    for k in range(1, BEFORE + 1):
        code[k:] += np.where(place[k:] >= k, flat[:-k], np.uint64(0)) * np.uint64(257 ** k)
    code *= np.uint64(0x9E3779B97F4A7C15)
    code ^= code >> np.uint64(29)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    code ^= code >> np.uint64(32)
    raw, at = code.tobytes(), (cut * 8).tolist()
    return [raw[a:b] for a, b in zip(at, at[1:], strict=False)]


def words_of(text: bytes) -> list[bytes]:
    return [w for w in (t.strip(PUNCTUATION) for t in text.lower().split()) if w]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A dictionary trained on the samples; the samples themselves if they are too few to train."""
    order = np.random.default_rng(3).permutation(len(samples))
    samples = [samples[i] for i in order]
    try:
        return zstandard.train_dictionary(size, samples, d=8, k=64).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _parts(word: bytes) -> set[bytes]:
    marked = b" " + word + b" "
    return {marked[i:i + n] for n in PART for i in range(len(marked) - n + 1)}


def telling(bad: list[list[bytes]], good: list[list[bytes]]) -> set[bytes]:
    """The word parts that a greater share of toxic texts holds than of ordinary ones, at ``RATE``
    of a text's words or more: such a part may stand in ordinary words too, more rarely."""
    holding = []
    for docs in (bad, good):
        count: Counter = Counter()
        for words in docs:
            having = Counter(p for w, n in Counter(words).items() for p in _parts(w) for _ in range(n))
            count.update(p for p, n in having.items() if n >= RATE * len(words))
        holding.append(count)
    in_bad, in_good = holding
    n_bad, n_good = max(1, len(bad)), max(1, len(good))
    out = set()
    for part, n in in_bad.items():
        share = (n + in_good[part]) / (n_bad + n_good)
        error = (n_bad * share * (1 - share) * n_good / (n_bad + n_good)) ** 0.5
        if n - n_bad * share > SURE * error and n * n_good > MORE * in_good[part] * n_bad:
            out.add(part)
    return out


class Distance:
    """Compressed lengths under the two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.parts = (toxic, ordinary)
        self.toxic, self.ordinary = _compressor(toxic), _compressor(ordinary)

    def __reduce__(self):
        return Distance, self.parts

    def gains(self, words: list[bytes]) -> list[int]:
        """Gain of each word; 0 where it is certainly below LOW (the toxic length is within LOW
        of the longest possible)."""
        toxic, ordinary = self.toxic.compress, self.ordinary.compress
        out = []
        for w in written(words):
            n = len(toxic(w))
            out.append(len(ordinary(w)) - n if len(w) + 12 - n >= LOW else 0)
        return out


def _compressor(dictionary: bytes):
    options = {"level": ZSTD_LEVEL, "write_content_size": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(**options)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), **options)


def _features(gains: np.ndarray) -> list[float]:
    """Windows above each level, as logarithms of their number and their share."""
    counts = [int((gains >= level).sum()) for level in LEVELS]
    share = [c / max(1, len(gains)) for c in counts]
    return [*np.log1p(counts), *(10 * np.sqrt(share))]


class Model:
    def __init__(self, distance: Distance, weights: np.ndarray):
        self.distance, self.weights = distance, weights

    def scores(self, docs: list[bytes], memory: dict[bytes, int]) -> np.ndarray:
        split = [t.lower().split() for t in docs]
        if len(memory) > STORE:
            memory.clear()
        new = list({w for words in split for w in words if w not in memory})
        memory.update(zip(new, self.distance.gains([w.strip(PUNCTUATION) for w in new]),
                          strict=True))
        x = np.array([_features(np.array([memory[w] for w in words])) for words in split])
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[1:] + self.weights[0], -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0) -> np.ndarray:
    """Weights (bias first) of an L2-penalised logistic regression, by Newton steps; both
    labels weigh the same."""
    x = np.hstack([np.ones((len(x), 1)), x])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    penalty = l2 * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty,
                               x.T @ (weight * (p - y)) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(toxic: list[bytes], ordinary: list[bytes]) -> Model:
    halves = [([words_of(t) for t in docs[::2]], [words_of(t) for t in docs[1::2]])
              for docs in (toxic, ordinary)]
    (bad, bad_rest), (good, good_rest) = halves

    in_bad = Counter(w for words in bad for w in set(words))
    in_good = Counter(w for words in good for w in set(words))
    parts = telling(bad, good)
    told = {w for w in in_bad.keys() | in_good.keys() if not parts.isdisjoint(_parts(w))}
    common = written([w for w, n in in_good.items() if w not in told for _ in range(min(n, 50))])
    distance = Distance(_dictionary(written([w for w, n in in_bad.items() if w in told
                                             for _ in range(n)]), TOXIC_BYTES),
                        _dictionary(common, ORDINARY_BYTES))
    for _ in range(ROUNDS):
        names = [w for w in in_good if w not in told]
        gain = dict(zip(names, distance.gains(names), strict=True))
        wrong = written([w for w in names if gain[w] >= LOW for _ in range(in_good[w])])
        distance = Distance(distance.parts[0], _dictionary(wrong + common, ORDINARY_BYTES))
    rest = bad_rest + good_rest
    names = list({w for words in rest for w in words})
    gain = dict(zip(names, distance.gains(names), strict=True))
    x = np.array([_features(np.array([gain[w] for w in words])) for words in rest])
    y = np.array([1] * len(bad_rest) + [0] * len(good_rest))
    if len(set(y.tolist())) < 2:  # too few labels to calibrate: nothing is toxic
        return Model(distance, np.array([-10.0] + [0.0] * 2 * len(LEVELS)))
    return Model(distance, _logistic(x, y))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from the labelled rows whose id is not held out (crc32 of the id as text, 1
    modulo 3): of each label those with the smallest hashes of their ids, each text once. An
    id with both labels counts as toxic."""
    marked = labels.where(training_rows(id_col, 3, 1) & F.col(label_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic"))
    chosen = None
    for label in (1, 0):
        best = marked.where(F.col("toxic") == label).orderBy(F.xxhash64(F.lit(5), "id"), "id") \
            .limit(sample)
        chosen = best if chosen is None else chosen.union(best)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")) \
        .where(F.octet_length("text") <= SAMPLE_BYTES) \
        .join(F.broadcast(chosen), "id")  # 2 * sample ids at most
    once = rows.groupBy("toxic", F.xxhash64("text").alias("draw")).agg(F.first("text").alias("text"))
    texts_of = {1: [], 0: []}
    for r in once.orderBy("draw", "toxic").limit(2 * sample).collect():
        texts_of[r["toxic"]].append(r["text"].encode())
    found = [texts_of[1], texts_of[0]]
    return train(*found)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Every row of ``docs``: id and score (0 to 1, higher: more likely toxic). Null and empty
    texts have no window above any level and get the score of that; repeated rows stay; other
    columns are not read."""
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((model.distance.parts, model.weights))
    schema = f"`{id_col}` {source.schema['id'].dataType.simpleString()}, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, weights = shared.value
        model, memory = Model(Distance(*parts), weights), {}
        for part in chunks(batches, "text"):
            p = model.scores(texts(part.column("text")), memory)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(p, pa.float64())],
                                             [id_col, "score"])

    return source.mapInArrow(run, schema)
