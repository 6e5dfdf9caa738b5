"""Helpers shared by the operators: Arrow text access, word hashing, model counts.

Words are ``[^\\x20\\x09-\\x0D]+`` in every operator that says "words": exactly what
``bytes.split()`` gives on UTF-8.
"""

from __future__ import annotations

import ctypes
import functools
import inspect
import uuid
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shared_dir

# the largest piece of text handled at once inside a task
CHUNK_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh_name(name: str, taken: Collection[str]) -> str:
    """``name``, or with underscores added if a column has it already (in any case)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def give_back() -> None:
    """Hand freed memory back to the system. A Python worker lives on between tasks and stages, and
    keeps what the allocators hold; several wait beside those at work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def frugal(task):
    """The Arrow task (a generator of batches, or a function of tables), giving back its memory
    when it ends."""
    if inspect.isgeneratorfunction(task):
        @functools.wraps(task)
        def run(*args):
            try:
                yield from task(*args)
            finally:
                give_back()
    else:
        @functools.wraps(task)
        def run(*args):
            try:
                return task(*args)
            finally:
                give_back()
    run.__signature__ = inspect.signature(task)
    return run


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost
    executors, and keeps column pruning for what reads it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def training_rows(id_col: str, modulus: int, held: int):
    """True for the rows a model may learn from: crc32 of the id as text, not ``held`` modulo
    ``modulus``. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) \
        % F.lit(modulus) != F.lit(held)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column as one array, and the offsets of its rows
    (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    offset_type = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, offset_type)[column.offset:column.offset + len(column) + 1] \
        .astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text_col: str,
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of text (a longer text stands alone)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = text_buffers(batch.column(text_col))
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            upto = max(upto, at + 1)
            yield batch.slice(at, upto - at)
            at = upto


def texts(column) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8 (null: empty)."""
    data, offsets = text_buffers(column)
    raw = data.tobytes()
    cut = offsets.tolist()
    return [raw[a:b] for a, b in zip(cut, cut[1:], strict=False)]


# --- hashing ------------------------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal in, equal out; near values end far apart."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _stream(n: int, seed: int) -> np.ndarray:
    """n pseudo-random odd numbers; number i depends on i and the seed only."""
    i = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(i + np.uint64(seed * 0x632BE59BD9B4E019 % 2**64)) | np.uint64(1)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray, seeds: tuple[int, ...] = (1,),
                separators: np.ndarray = _SPACE) -> tuple[list[np.ndarray], np.ndarray]:
    """A 64-bit hash per word and seed, of all words of all rows in order, and the words per
    row. A word ends at a separator byte or the row's end. The hash is a sum of products of
    random numbers for each byte and place, so it does not depend on where the word stands."""
    rows = len(offsets) - 1
    if len(data) == 0:
        return [np.zeros(0, np.uint64) for _ in seeds], np.zeros(rows, np.int64)
    inside = ~separators[data]
    first = inside.copy()
    first[1:] &= separators[data[:-1]]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    starts = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(starts, offsets))
    if len(starts) == 0:
        return [np.zeros(0, np.uint64) for _ in seeds], counts
    at = np.flatnonzero(inside)
    places = np.searchsorted(at, starts)
    lengths = np.diff(np.append(places, len(at)))
    where = np.arange(len(at)) - np.repeat(places, lengths)
    symbols = data[at]
    out = []
    for seed in seeds:
        by_byte = _stream(256, 2 * seed)
        by_place = _stream(int(lengths.max()), 2 * seed + 1)
        value = by_byte[symbols] * (by_place[where] ^ (by_byte[symbols] >> np.uint64(7)))
        out.append(mix(np.add.reduceat(value, places) + lengths.astype(np.uint64)))
    return out, counts


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows holding ``counts`` items each: the row of every item, and its place in it."""
    rows = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    return rows, np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


# --- n-grams over symbols -----------------------------------------------------------------

def earlier(symbols: np.ndarray, offsets: np.ndarray, k: int, pad: int) -> np.ndarray:
    """The symbol k places before each, within its row; ``pad`` before a row's start."""
    out = np.empty_like(symbols)
    if k >= len(symbols):
        out[:] = pad
        return out
    out[:k] = pad
    out[k:] = symbols[:-k]
    starts, stops = offsets[:-1], offsets[1:]
    for j in range(k):
        at = starts + j
        out[at[at < stops]] = pad
    return out


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each row (0 for an empty row); values may have columns."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0, dtype=np.float64)
    return out


def summed_cells(counted: DataFrame, cells: int) -> np.ndarray:
    """The table (cell, n), summed over the tasks that counted it, as one dense array. At most
    ``cells`` rows reach the driver."""
    out = np.zeros(cells, np.int64)
    table = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out[table["cell"].to_numpy()] = table["n"].to_numpy()
    return out


def cell_batch(counts: np.ndarray) -> pa.RecordBatch:
    """The non-zero cells of a task's counts as rows (cell, n)."""
    at = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()),
                                       pa.array(counts[at].astype(np.int64))], ["cell", "n"])
