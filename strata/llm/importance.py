"""Target-distribution importance resampling (operator 13).

Features of a text are its runs of one to ``ORDER`` words, hashed to buckets by the crc32 of
their bytes. Two bags of buckets, one of all documents and one of the target table, give each
bucket a gain (the logarithm of how much more the target uses it); a document's weight is the
sum of gains over its features, a Gumbel draw made from its id is added, and the documents with
the highest scores are drawn, which samples without replacement in proportion to exp(weight).

A batch's texts are joined with sentinels, bytes that no UTF-8 text holds; one regex pass finds
the words and the sentinels of the whole batch. A document's offsets among the words are where
the sentinels stood; a search in them gives every word's document, and runs whose first and
last words lie in different documents are masked before buckets are counted. The crc32 of a run
is put together from the crc32 of its words (crc32 is linear over bits), for all runs at once.

Two passes over the texts: counts (a task sends a row for each bucket it met, whose sums are
``BUCKETS`` numbers) and weights. Documents are ranked by range partitions of (score, id).
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cell_batch, chunks, materialise, summed_cells, texts

ORDER = 3
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = 42
# text that is searched at once; a longer text is cut between words, runs go across the cuts
PIECE_BYTES = 2 << 20

SENTINEL = b"\n\xff\n"
MARK = SENTINEL.strip()
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


# --- crc32 of joined strings --------------------------------------------------------------

def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by its values for each byte (4 x 256), on every crc."""
    out = tables[0][crc & 255]
    for i in range(1, 4):
        out = out ^ tables[i][(crc >> np.uint32(8 * i)) & 255]
    return out


def _byte_tables() -> np.ndarray:
    """The map of a crc by one zero byte after it."""
    whole = 0xFFFFFFFF
    step = np.array([zlib.crc32(b"\0", b ^ whole) ^ whole for b in range(256)], np.uint32)
    bits = np.arange(256, dtype=np.uint32)
    shifted = [bits << np.uint32(8 * i) for i in range(4)]
    return np.stack([(x >> np.uint32(8)) ^ step[x & 255] for x in shifted])


@lru_cache(maxsize=4096)
def _shift_tables(length: int) -> np.ndarray:
    """The map of a crc by ``length`` zero bytes after it (by halving, so long words are cheap)."""
    if length == 1:
        return _byte_tables()
    half = _shift_tables(length // 2)
    both = np.stack([_apply(half, t) for t in half])
    return np.stack([_apply(_shift_tables(1), t) for t in both]) if length % 2 else both


def _shifts(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tables of all different lengths, flat, and where each length's tables start."""
    distinct, at = np.unique(lengths, return_inverse=True)
    return np.concatenate([_shift_tables(int(n)).ravel() for n in distinct]), at * 1024


def _appended(crc: np.ndarray, tables: np.ndarray, at: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """crc32 of each first string with its tail appended; ``at``: the tables of the tail's length."""
    out = tail.copy()
    for i in range(4):
        out ^= tables[at + (i * 256 + ((crc >> np.uint32(8 * i)) & np.uint32(255)).astype(np.int64))]
    return out


# --- features of a batch ------------------------------------------------------------------

def _pieces(joined: bytes, size: int) -> Iterator[bytes]:
    start = 0
    while len(joined) - start > size:
        gap = GAP.search(joined, start + size)
        if not gap:
            break
        yield joined[start:gap.start()]
        start = gap.start()
    yield joined[start:] if start else joined


def features(rows: list[bytes], buckets: int = BUCKETS, order: int = ORDER,
             size: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(run length, document, bucket) for the runs of the texts, as arrays: documents are
    places in ``rows``, and a run appears once for each time it stands in a text."""
    before, carried = 0, []
    for piece in _pieces(SENTINEL.join(rows).lower(), size):
        found = carried + WORD.findall(piece)
        numbers: dict[bytes, int] = {MARK: 0}
        code = np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int64, len(found))
        marks = np.flatnonzero(code == 0)
        code = code[code > 0]
        offsets = marks - np.arange(len(marks))
        doc = np.searchsorted(offsets, np.arange(len(code)), "right")
        new = np.arange(len(code)) >= len(carried)  # carried words were counted before
        vocabulary = list(numbers)
        alone = np.array([zlib.crc32(w) for w in vocabulary], np.uint32)
        space = zlib.crc32(b" ")
        after = np.array([zlib.crc32(w, space) for w in vocabulary], np.uint32)[code]
        tables, at = _shifts(np.array([len(w) + 1 for w in vocabulary]))
        at = at[code]
        crc = alone[code]
        yield 1, before + doc[new], (crc[new] % np.uint32(buckets)).astype(np.int64)
        for n in range(2, order + 1):
            if len(code) < n:
                break
            # crc[i]: the run of n - 1 words that ends at word i + n - 2
            crc = _appended(crc[:-1], tables, at[n - 1:], after[n - 1:])
            inside = (doc[:len(code) - n + 1] == doc[n - 1:]) & new[n - 1:]
            yield n, before + doc[n - 1:][inside], (crc[inside] % np.uint32(buckets)).astype(np.int64)
        last = int(offsets[-1]) if len(offsets) else 0
        before += len(marks)
        carried = [vocabulary[c] for c in code[last:][-(order - 1):]] if order > 1 else []


def bucket_counts(table: DataFrame, text_col: str, buckets: int = BUCKETS,
                  order: int = ORDER) -> np.ndarray:
    """How often the features of all texts fall into each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in chunks(batches, "text"):
            for _, _, bucket in features(texts(batch.column("text")), buckets, order):
                total += np.bincount(bucket, minlength=buckets)
        yield cell_batch(total)

    counted = table.select(table[text_col].alias("text")).mapInArrow(run, "cell bigint, n bigint")
    return summed_cells(counted, buckets)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of (target share) / (source share)) of each bucket, one added to all."""
    s_all, t_all, k = float(source.sum()), float(target.sum()), float(len(source))
    return np.array([math.floor(1000 * math.log(((t + 1.0) * (s_all + k)) / ((s + 1.0) * (t_all + k))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str,
          order: int = ORDER) -> DataFrame:
    """id, n_words, n_features and weight of every document (null text: 0, 0 and 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            rows = batch.num_rows
            n = np.zeros((2, rows), np.int64)
            weight = np.zeros(rows, np.int64)
            for length, doc, bucket in features(texts(batch.column("text")), len(gain), order):
                count = np.bincount(doc, minlength=rows)
                n[0] += count * (length == 1)
                n[1] += count
                weight += np.bincount(doc, weights=gain[bucket], minlength=rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *map(pa.array, (n[0], n[1], weight))],
                ["id", "n_words", "n_features", "weight"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words bigint, n_features bigint, weight bigint")


def gumbel(key: Column, seed: int = SEED) -> Column:
    """floor(-1000 * ln(-ln(u))), u from the first 32 bits of sha256 of ``seed:key`` (null: empty)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with rank 1, 2, 3... in that order. Rows are cut into ranges of the order, which
    are sorted each on its own and written; a range's first rank follows from the row counts of
    the ranges before it (a row each)."""
    cut = rows.repartitionByRange(*order).sortWithinPartitions(*order) \
        .withColumn("__part", F.spark_partition_id()) \
        .withColumn("__at", F.monotonically_increasing_id())
    cut = materialise(cut, "score-ranges")
    sizes = cut.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__least"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", "__least", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    # a row for each shuffle partition
    return cut.join(F.broadcast(starts), "__part").withColumn(
        "rank", F.col("__before") + F.col("__at") - F.col("__least") + 1) \
        .drop("__part", "__at", "__n", "__least", "__before")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS,
             seed: int = SEED, buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """Every document with its weight towards ``target`` and its place in the sample.

    Returns id (named ``id_col``), n_words, n_features, weight, score, rank. Of the documents
    with at least ``min_words`` words, ``percent`` percent (rounded down) are drawn: those with
    the highest scores, ties to the smaller id (a null id is the smallest; rows alike in both
    stand in the order of one written table). Others have no rank. Null and empty texts have no
    features and weight 0; an empty target gives gains by the source alone; repeated rows each
    count; other columns are not read.
    """
    gain = gains(bucket_counts(docs, text_col, buckets, order),
                 bucket_counts(target, target_text_col, buckets, order))
    weighed = weigh(docs, gain, id_col, text_col, order)
    scored = weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)) \
        .withColumn("place", F.monotonically_increasing_id())
    scored = materialise(scored, "weighed")
    eligible = scored.where(F.col("n_words") >= min_words)
    drawn = eligible.count() * percent // 100
    placed = ranked(eligible, [F.col("score").desc(), F.col("id").asc(), F.col("place").asc()])
    columns = [F.col("id").alias(id_col), "n_words", "n_features", "weight", "score"]
    return placed.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")) \
        .unionAll(scored.where(F.col("n_words") < min_words)
                  .select(*columns, F.lit(None).cast("bigint").alias("rank")))
