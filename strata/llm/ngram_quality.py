"""Quality rules (operator 5): a modified Kneser-Ney n-gram model of the corpus, and bands of
perplexity by language outside which a document is rejected.

The model is over characters as they are, of order ``ORDER``, and grows with the corpus. Tasks count
the n-grams of a block of texts by 64-bit hashes; Spark sums them, and estimates every order by
grouping and joining the n-grams on their contexts and suffixes. The result, a table of hashes and
bits, stays partitioned. A block gets the rows of its own n-grams, which it sorts, and looks every
character's n-gram up in them. The texts go to their blocks once, packed and compressed.

Bands: the quartiles of the entropies (bits a character; perplexity is its power of two) of the different
texts in each language, so that copies of a text do not move them, widened by ``SPREAD`` times their
distance (``LEAST`` bits at least).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import (
    chunks,
    earlier,
    frugal,
    materialise,
    mix,
    row_sums,
    spread,
    text_buffers,
    texts,
    word_hashes,
)

ORDER = 4  # characters of an n-gram
BLOCK_BYTES = 32 << 20  # text of a block
PIECE_BYTES = 4 << 20  # text packed at once
CLASSES = 48  # symbols of the dense ``Model``
SPREAD = 3.0
LEAST = 0.05
SYMBOLS = b"#*$%&|<>"


START = 10  # before a text's first character: as after a line end
WIDTH = 4  # bytes of a character in an n-gram


def _characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every character as the number of its UTF-8 bytes, and the rows' offsets in characters."""
    first = (data & 0xC0) != 0x80
    first[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    at = np.flatnonzero(first)
    lengths = np.diff(np.append(at, len(data)))
    out = data[at].astype(np.uint32)
    for k in range(1, WIDTH):
        more = np.flatnonzero(lengths > k)
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out, np.searchsorted(at, offsets)


def _window(symbols: np.ndarray, offsets: np.ndarray, order: int) -> list[np.ndarray]:
    """The characters of the n-gram that ends at each, oldest first."""
    return [earlier(symbols, offsets, k, START) for k in range(order - 1, 0, -1)] + [symbols]


# an odd random number for each character of an n-gram
_FACTORS = mix(np.arange(1, 33, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _hashes(window: list[np.ndarray]) -> np.ndarray:
    """64-bit hashes of n-grams."""
    out = np.zeros(len(window[-1]), np.uint64)
    for symbols, factor in zip(window, _FACTORS, strict=False):
        out += symbols * factor
    return mix(out).view(np.int64)


def _finder(keys: np.ndarray):
    """A function that finds the places of hashes, all of them held, in the sorted different
    hashes ``keys``: from the first key with the same leading bits on."""
    bits = max(1, len(keys).bit_length())
    leading = lambda hashes: (hashes >> (64 - bits)) + (1 << (bits - 1))
    start = np.searchsorted(leading(keys), np.arange(1 << bits))

    def find(wanted: np.ndarray) -> np.ndarray:
        at = start[leading(wanted)]
        left = np.flatnonzero(keys[at] != wanted)
        while len(left):
            at[left] += 1
            left = left[keys[at[left]] != wanted[left]]
        return at
    return find


def _different(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different hashes in order, a place of each, and how many there are of each."""
    order = np.argsort(hashes)
    hashes = hashes[order]
    start = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[:len(hashes)])
    return hashes[start], order[start], np.diff(np.append(start, len(hashes)))


def packed(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """The rows of ``docs`` in pieces (block, piece): an Arrow stream with their id, lang, text and a
    hash of the text (copy). A block is up to ``BLOCK_BYTES`` of text of one task."""
    source = docs.select(docs[id_col].alias("id"), docs[lang_col].alias("lang"),
                         docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("copy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, options = 0, BLOCK_BYTES, pa.ipc.IpcWriteOptions(
            compression=pa.Codec("zstd", compression_level=9))
        for part in chunks(batches, "text", PIECE_BYTES):
            if held >= BLOCK_BYTES:
                block, held = uuid.uuid4().int >> 65, 0
            held += len(text_buffers(part.column("text"))[0])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=options) as writer:
                writer.write_batch(part)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()),
                                              pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                             ["block", "piece"])

    return materialise(source.mapInArrow(frugal(run), "block bigint, piece binary"), "pieces")


def _unpacked(pieces) -> Iterator[pa.RecordBatch]:
    for piece in pieces:
        yield from pa.ipc.open_stream(piece.as_buffer())


def block_ngrams(pieces: DataFrame, order: int = ORDER, grams: bool = True) -> DataFrame:
    """The different n-grams of every block: their characters and counts (gram, n) or, without
    ``grams``, their hashes (block, hash). A block that two tasks read gives them twice."""
    def merged(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        keys, counts, gram = (np.concatenate(x) for x in zip(*found, strict=True))
        if not grams:
            keys = np.unique(keys)
            return keys, counts[:0], gram[:0]
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
        return keys[start], np.add.reduceat(counts, start) if len(start) else counts, gram[order[start]]

    def rows(block: int, found: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        keys, counts, gram = merged(found)
        for a in range(0, len(keys), 1 << 16):
            part = slice(a, a + (1 << 16))
            n = len(keys[part])
            if grams:
                ends = pa.py_buffer((np.arange(n + 1) * WIDTH * order).astype(np.int32))
                joined = pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(gram[part].tobytes())])
                yield pa.RecordBatch.from_pydict({"gram": joined, "n": pa.array(counts[part])})
            else:
                yield pa.RecordBatch.from_pydict({"block": pa.array(np.full(n, block)),
                                                  "hash": pa.array(keys[part])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, found = None, []
        for batch in batches:
            for at, piece in zip(batch.column("block").to_pylist(), batch.column("piece"), strict=True):
                if found and at != block:
                    yield from rows(block, found)
                    found = []
                block = at
                for part in chunks(_unpacked([piece]), "text"):
                    window = _window(*_characters(*text_buffers(part.column("text"))), order)
                    hashes = _hashes(window)
                    if grams:
                        keys, at_each, n = _different(hashes)
                        found.append((keys, n, np.stack([w[at_each] for w in window], axis=1)))
                    else:
                        found.append((np.unique(hashes), np.zeros(0, np.int64), np.zeros((0, order), np.uint32)))
                if len(found) > 8:
                    found = [merged(found)]
        if found:
            yield from rows(block, found)

    return pieces.mapInArrow(frugal(run), "gram binary, n bigint" if grams else "block bigint, hash bigint")


def _count_levels(counted: DataFrame, order: int) -> dict[int, DataFrame]:
    """For every order the different n-grams (gram) and their counts (n): below the highest order,
    the number of different characters seen before them."""
    levels = {order: materialise(counted, f"grams-{order}")}
    for k in range(order - 1, 0, -1):
        shorter = levels[k + 1].groupBy(F.substring("gram", WIDTH + 1, WIDTH * k).alias("gram")) \
            .agg(F.count(F.lit(1)).alias("n"))
        levels[k] = materialise(shorter, f"grams-{k}")
    return levels


def estimate(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """Modified Kneser-Ney over the n-grams (gram, n) of the highest order: their hashes and bits
    (-log2 of the last character's probability after the others), of all orders interpolated."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = np.frombuffer(b"".join(batch.column("gram").to_pylist()), np.uint32).reshape(-1, order)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_hashes(list(symbols.T))), batch.column("bits")], ["hash", "bits"])

    lower = None
    for k, level in sorted(_count_levels(counted, order).items()):
        of = level.agg(F.count(F.lit(1)), F.sum("n"), *[F.count_if(F.col("n") == c) for c in (1, 2, 3, 4)]).first()
        if not of[0]:
            break
        _, d1, d2, d3 = (float(d) for d in _discounts_of(*of[2:]))
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        level = level.withColumn("off", discount)
        if lower is None:
            off = level.agg(F.sum("off")).first()[0]
            level = level.withColumns({"total": F.lit(of[1]), "left": F.lit(off / of[1]),
                                       "shorter": F.lit(1.0 / of[0])})
        else:
            level = level.withColumns({"context": F.substring("gram", 1, WIDTH * (k - 1)),
                                       "suffix": F.substring("gram", WIDTH + 1, WIDTH * (k - 1))})
            alike = Window.partitionBy("context")  # as many rows as characters follow it
            level = level.withColumns({"total": F.sum("n").over(alike),
                                       "left": F.sum("off").over(alike) / F.sum("n").over(alike)})
            level = level.drop("context", "off").join(
                lower.select(F.col("gram").alias("suffix"), F.col("p").alias("shorter")), "suffix")
        p = (F.col("n") - discount) / F.col("total") + F.col("left") * F.col("shorter")
        lower = level.select("gram", p.alias("p"))
    if lower is None:  # no n-grams
        lower = counted.select("gram", F.lit(1.0).alias("p"))
    return lower.select("gram", (-F.log2("p")).cast("float").alias("bits")) \
        .mapInArrow(hashed, "hash bigint, bits float")


def _discounts(counts: np.ndarray) -> np.ndarray:
    """The three discounts of modified Kneser-Ney from the counts of counts; where a corpus
    has no n-grams seen once or twice, half a count."""
    return _discounts_of(*(np.count_nonzero(counts == k) for k in (1, 2, 3, 4)))


def _discounts_of(*counts_of_counts: int) -> np.ndarray:
    """The same from the number of n-grams seen once, twice, three and four times."""
    n1, n2, n3, n4 = (float(n) for n in counts_of_counts)
    if not (n1 and n2):
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    three = 3 - 4 * y * n4 / n3 if n3 else 3 * y
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, three]
    return np.array([0.0, *[min(max(d, 0.1), k) for d, k in zip(found, (0.9, 1.9, 2.9), strict=True)]])


def _hash(order: int, codes: np.ndarray) -> np.ndarray:
    return mix(codes.astype(np.uint64) + np.uint64(order << 40))


class Model:
    """The same estimate from a dense table of counts over ``CLASSES`` symbols, which ``estimate`` is
    compared with. Sorted hash arrays: ``grams`` (hash, log2 probability) and ``backoffs`` (hash of a
    context, log2 of the weight left to the shorter context)."""

    def __init__(self, counts: np.ndarray):
        grams, backoffs = [], []
        lower = np.full(1, 1.0 / CLASSES)  # order 0: the same for every class
        tables = [counts.reshape(-1, CLASSES)]
        for _ in range(ORDER - 1):
            # continuation counts: the different symbols seen before the shorter n-gram
            wide = tables[0].reshape(CLASSES, -1)
            tables.insert(0, (wide > 0).sum(axis=0).reshape(-1, CLASSES))
        for order, table in enumerate(tables, 1):
            discount = _discounts(table)
            total = table.sum(axis=1).astype(np.float64)
            off = discount[np.minimum(table, 3)]
            left = np.where(total > 0, off.sum(axis=1) / np.maximum(total, 1), 1.0)
            shorter = np.resize(lower, table.shape) if order == 1 else \
                np.tile(lower, (len(table) // len(lower), 1))
            p = (table - off) / np.maximum(total, 1)[:, None] + left[:, None] * shorter
            del off, shorter
            seen = np.flatnonzero(table)
            grams.append((_hash(order, seen), np.log2(p.ravel()[seen]).astype(np.float32)))
            context = np.flatnonzero(total)
            backoffs.append((_hash(order, context), np.log2(left[context]).astype(np.float32)))
            lower = p
        self.grams, self.backoffs = [_sorted(*x) for x in grams], [_sorted(*x) for x in backoffs]

    def table(self) -> np.ndarray:
        """log2 probability of every ORDER-gram, by binary search in the arrays."""
        value = np.full(CLASSES, -np.log2(CLASSES), np.float32)
        for order in range(1, ORDER + 1):
            contexts = CLASSES ** (order - 1)
            left = _find(*self.backoffs[order - 1], _hash(order, np.arange(contexts)), 0.0)
            if order > 1:
                value = np.tile(value, CLASSES)
            value = value + np.repeat(left, CLASSES)
            for a in range(0, len(value), 1 << 18):
                b = min(a + (1 << 18), len(value))
                seen = _find(*self.grams[order - 1], _hash(order, np.arange(a, b)), np.nan)
                value[a:b] = np.where(np.isnan(seen), value[a:b], seen)
        return value


def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.argsort(keys)
    return keys[at], values[at]


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if len(keys) == 0:
        return np.full(len(wanted), missing, np.float32)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], np.float32(missing)).astype(np.float32)


_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IN_WORD = np.ones(256, bool)  # bytes that begin a character of a word
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
_IN_WORD[0x80:0xC0] = False


def _repeated_words(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words of each row inside a window of 3 words that the row holds twice or more."""
    rows, places = spread(counts)
    out = np.zeros(len(counts), np.int64)
    starts = np.flatnonzero(places < (counts - 2)[rows]) if len(words) >= 3 else np.zeros(0, int)
    if len(starts) == 0:
        return out
    key = mix(words[starts] * np.uint64(3) + mix(words[starts + 1] + np.uint64(5))
              + mix(words[starts + 2] * np.uint64(7)) * np.uint64(11)
              + rows[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words) + 2, bool)
    for k in range(3):
        covered[starts[twice] + k] = True
    return np.bincount(rows, covered[:len(words)], minlength=len(counts)).astype(np.int64)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        lang_col: str = "lang", order: int = ORDER) -> DataFrame:
    """Every row of ``docs``: id, lang, a hash of its text (copy), the base counts and its entropy
    (bits a character; null for an empty text) under the model of all of them."""
    pieces = packed(docs, id_col, text_col, lang_col)
    counted = block_ngrams(pieces, order).groupBy("gram").agg(F.sum("n").alias("n"))
    wanted = block_ngrams(pieces, order, grams=False)
    found = wanted.join(estimate(counted, order), "hash").select("block", "hash", "bits")
    types = dict(docs.dtypes)
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = f"id {types[id_col]}, lang {types[lang_col]}, copy bigint, " + \
        ", ".join(f"{n} bigint" for n in numbers) + ", entropy double"

    def run(block: pa.Table, model: pa.Table) -> pa.Table:
        keys, at = np.unique(model.column("hash").to_numpy(), return_index=True)
        find, bits = _finder(keys), model.column("bits").to_numpy()[at]
        out = []
        for part in chunks(_unpacked(block.column("piece")), "text"):
            data, offsets = text_buffers(part.column("text"))
            symbols, places = _characters(data, offsets)
            grams = _hashes(_window(symbols, places, order))
            total = row_sums(bits[find(grams)], places)
            (words,), n_words = word_hashes(data, offsets)
            dup = []
            for t in texts(part.column("text")):
                lines = [x for x in t.split(b"\n") if x.strip()] if b"\n" in t else []
                dup.append(len(lines) - len(set(lines)))
            length = np.diff(places)
            out.append(pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("lang"), part.column("copy"), pa.array(n_words),
                 pa.array(row_sums(_IN_WORD[data], offsets).astype(np.int64)),
                 pa.array(row_sums(_IS_SYMBOL[data], offsets).astype(np.int64)),
                 pa.array(dup, pa.int64()), pa.array(_repeated_words(words, n_words)),
                 pa.array(total / np.maximum(length, 1), mask=length == 0)],
                ["id", "lang", "copy", *numbers, "entropy"]))
        return pa.Table.from_batches(out)

    return pieces.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(frugal(run), schema)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang", spread_factor: float = SPREAD) -> DataFrame:
    """Every row of ``docs`` with its verdict.

    Returns id (named ``id_col``), n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed (fewer than 50 words, or over half of them repeated), entropy,
    perplexity, kept. Null and empty texts have no words and fail the base rules. Bands are
    set per language from the different texts that pass the base rules; null languages share a band.
    Repeated rows stay and count; other columns are not read.
    """
    stats = materialise(document_statistics(docs, id_col, text_col, lang_col), "quality")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = stats.withColumn("base_failed", failed) \
        .withColumn("band", F.coalesce(F.col("lang").cast("string"), F.lit("")))
    different = stats.where(~F.col("base_failed")).groupBy("band", "copy") \
        .agg(F.first("entropy").alias("entropy"))
    bands = different.groupBy("band").agg(
        F.percentile_approx("entropy", [0.25, 0.75], 10_000).alias("q"))
    margin = F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(LEAST)) * F.lit(spread_factor)
    bands = bands.select("band", (F.col("q")[0] - margin).alias("least"),
                         (F.col("q")[1] + margin).alias("most"))
    inside = F.col("entropy").between(F.col("least"), F.col("most"))
    return stats.join(F.broadcast(bands), "band", "left").select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "entropy", F.pow(F.lit(2.0), "entropy").alias("perplexity"),
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"))
