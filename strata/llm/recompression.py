"""Substring deduplication by recompression (operator 2): each word covered by a window of
``WINDOW`` words whose word sequence also starts earlier is removed.

Naming rounds. The words of a text are symbols (64-bit hashes). A round replaces every maximal
run of equal symbols by a symbol for (symbol, length), then every pair whose left symbol
falls into one half of the alphabet and right symbol into the other (by a bit of a seeded hash)
by a symbol for the pair. A name is a hash of what it stands for, so all tasks give equal runs
and pairs the same name without a dictionary. Whether two neighbours are joined depends on them
alone; so equal substrings get the same symbols except near their ends, and how far in that
reaches can be told from the window itself.

1. Reveal: each window takes, among the triples of neighbouring symbols in its certain interior
   after ``ROUNDS`` rounds, the one with the least name (windows without three such symbols take a
   name of the last interior they have). Equal windows take the same name. Every block of
   documents sends its different names; names that stand at two places are repeated.
2. Verify: for windows with a repeated name only, a block sends the first place of each different
   word sequence as two independent 64-bit hashes, with the document's id; of equal ones all but
   the earliest are marked. Later places in the same block are marked by the block itself.
3. Blocks remove the words that marked windows cover.

Names and hashes travel as arrays, a row for each block and bucket of hashes. A frequent window
has one entry in a block, so no bucket grows with the copies of a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import mix, spread, text_buffers, texts, word_hashes

WINDOW = 20
ROUNDS = 2
BLOCK_BYTES = 16 << 20
PIECE_BYTES = 2 << 20
NAMES, PLACES, RANGES = 0, 1, 2
MESSAGE = "bucket bigint, block bigint, kind int, payload binary"


def _u(x: int) -> np.uint64:
    return np.uint64(x % 2**64)


_A, _B, _C = _u(0x9E3779B97F4A7C15), _u(0xC2B2AE3D27D4EB4F), _u(0x165667B19E3779F9)


class Level:
    """Symbols of a piece of text: name, first word and row of each; ``at[w]`` is the symbol that
    holds word w."""

    def __init__(self, name: np.ndarray, start: np.ndarray, row: np.ndarray, words: int):
        self.name, self.start, self.row, self.words = name, start, row, words
        first = np.zeros(words + 1, np.int32)
        first[start] = 1
        self.at = np.cumsum(first, dtype=np.int32) - 1
        self.stop = np.append(start[1:], words).astype(np.int32)

    def joined(self, begins: np.ndarray, name: np.ndarray) -> Level:
        return Level(name, self.start[begins], self.row[begins], self.words)


def _runs(level: Level, low: np.ndarray, high: np.ndarray):
    """Runs of equal symbols become one symbol; a window's outermost runs are not certain, as
    they may go on outside."""
    same = (level.name[1:] == level.name[:-1]) & (level.row[1:] == level.row[:-1])
    begins = np.flatnonzero(np.append(True, ~same))
    count = np.diff(np.append(begins, len(level.name)))
    name = level.name[begins]
    name = np.where(count > 1, mix(name * _A + count.astype(np.uint64) * _B), name)
    new = level.joined(begins, name)
    return new, np.minimum(new.stop[new.at[low]], high), np.maximum(new.start[new.at[high - 1]], low)


def _pairs(level: Level, low: np.ndarray, high: np.ndarray, seed: int):
    """Pairs (left half, right half) become one symbol; an outermost symbol that could be joined
    to one outside is not certain. Empty interiors stay empty."""
    right = mix(level.name + _u(seed * 0x5851F42D4C957F2D)) >> np.uint64(63) == 1
    pair = np.append(~right[:-1] & right[1:] & (level.row[1:] == level.row[:-1]), False)
    begins = np.flatnonzero(np.append(True, ~pair[:-1]))
    name = level.name[begins]
    follows = np.append(level.name[1:], _u(0))[begins]
    name = np.where(pair[begins], mix(name * _B + follows * _C + _u(seed)), name)
    first, last = level.at[low], level.at[np.maximum(high - 1, 0)]
    full = low < high
    new_low = np.where(full & right[first], level.stop[first], low)
    new_high = np.where(full & ~right[last], level.start[last], high)
    return level.joined(begins, name), new_low, new_high


def _range_min(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least value in [begin, end) for ranges of 1 to WINDOW values."""
    out = np.empty(len(begin), values.dtype)
    length = end - begin
    table, width = values, 1
    while width <= WINDOW:
        mine = (length >= width) & (length < 2 * width)
        out[mine] = np.minimum(table[begin[mine]], table[end[mine] - width])
        if len(table) > width:
            table = np.minimum(table[:-width], table[width:])
        else:
            table = table[:0]
        width *= 2
        if len(table) == 0:
            break
    return out


def window_names(words: np.ndarray, counts: np.ndarray, window: int = WINDOW,
                 rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of all windows, the name each takes, and the names standing anywhere in the
    piece (one entry a place)."""
    row, place = spread(counts)
    begin = np.flatnonzero(place <= (counts - window)[row]).astype(np.int32)
    if len(begin) == 0:
        return begin, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    level = Level(words, np.arange(len(words), dtype=np.int32), row, len(words))
    low, high = begin, begin + np.int32(window)
    name = np.zeros(len(begin), np.uint64)
    live = np.arange(len(begin))
    others = []
    for r in range(2 * rounds):
        new, new_low, new_high = _runs(level, low, high) if r % 2 == 0 else \
            _pairs(level, low, high, r)
        ended = new_low >= new_high
        if ended.any():
            a, b = level.at[low[ended]], level.at[high[ended] - 1]
            own = mix(level.name[a] * _A + level.name[b] * _B + (b - a).astype(np.uint64) * _C
                      + _u(r + 1))
            name[live[ended]] = own
            others.append(own[np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
        level, low, high, live = new, new_low[~ended], new_high[~ended], live[~ended]
    n = level.name
    triple = mix(n[:-2] * _A + n[1:-1] * _B + n[2:] * _C) if len(n) > 2 else n[:0]
    a, b = level.at[low], level.at[high - 1] + 1
    few = b - a < 3
    name[live[~few]] = _range_min(triple, a[~few], b[~few] - 2)
    own = mix(n[a[few]] * _C + n[b[few] - 1] * _A + (b - a)[few].astype(np.uint64))
    name[live[few]] = own
    if few.any():
        a, b = a[few], b[few]
        others.append(own[np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
    return begin, name, np.concatenate([triple, *others])


class Block:
    """The rows of a block in order of id (null first), then text hash."""

    def __init__(self, table: pa.Table):
        ids = table["id"].fill_null(-2**63).to_numpy()
        self.order = np.lexsort((table["text_hash"].to_numpy(), ids))
        self.ids, self.table = ids[self.order], table.take(pa.array(self.order)) \
            if len(ids) else table

    def pieces(self) -> Iterator[tuple[pa.Array, int]]:
        """Texts of consecutive rows, and the first of the rows."""
        column = self.table["text"].combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
        _, offsets = text_buffers(column)
        at = 0
        while at < len(column):
            upto = max(int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, "right")) - 1, at + 1)
            yield column.slice(at, upto - at), at
            at = upto


def _message(bucket, block, kind, payload) -> pa.Table:
    return pa.table({"bucket": pa.array(bucket, pa.int64()), "block": pa.array(block, pa.int64()),
                     "kind": pa.array(kind, pa.int32()), "payload": pa.array(payload, pa.binary())})


def _bucket_cuts(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys by bucket (the high bits), and the cuts between buckets."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _block_names(table: pa.Table, buckets: int) -> pa.Table:
    """Round 1 of a block: its different names, and which stand at two places in it."""
    chosen, everywhere = [], []
    for column, _ in Block(table).pieces():
        (words,), counts = word_hashes(*text_buffers(column))
        _, name, names = window_names(words, counts)
        chosen.append(np.unique(name))
        everywhere.append(names)
    chosen = np.unique(np.concatenate([np.zeros(0, np.uint64), *chosen]))
    every, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *everywhere]), return_counts=True)
    twice = np.zeros(0, bool) if len(chosen) == 0 else n[np.searchsorted(every, chosen)] > 1
    _, cuts = _bucket_cuts(chosen, buckets)  # sorted names are in order of buckets
    block = table["block"][0].as_py()
    rows = [(b, chosen[i:j].tobytes() + np.packbits(twice[i:j]).tobytes())
            for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if j > i]
    return _message([b for b, _ in rows], [block] * len(rows), [NAMES] * len(rows),
                    [p for _, p in rows])


def _shared_names(table: pa.Table) -> pa.Table:
    """Of one bucket: for each block, its names that are repeated."""
    lists, flags = [], []
    for payload in table["payload"].to_pylist():
        n = (len(payload) * 8) // 65  # n names of 8 bytes and n bits, filled up to a byte
        while 8 * n + (n + 7) // 8 < len(payload):
            n += 1
        lists.append(np.frombuffer(payload, np.uint64, n))
        flags.append(np.unpackbits(np.frombuffer(payload, np.uint8, offset=8 * n))[:n] > 0)
    names, where, n = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    repeated = n > 1
    repeated[where[np.concatenate(flags)]] = True
    cuts = np.cumsum([0, *map(len, lists)])
    payload = [x[repeated[where[a:b]]].tobytes()
               for x, a, b in zip(lists, cuts[:-1], cuts[1:], strict=True)]
    return _message(table["bucket"].to_pylist(), table["block"].to_pylist(),
                    [NAMES] * len(payload), payload)


def _sequence_hash(words: np.ndarray, at: np.ndarray, seed: int) -> np.ndarray:
    factors = mix(np.arange(1, WINDOW + 1, dtype=np.uint64) * _A + _u(seed)) | np.uint64(1)
    out = np.zeros(len(at), np.uint64)
    for k in range(WINDOW):
        out += words[at + k] * factors[k]
    return mix(out)


def _ranges(starts: np.ndarray, lengths: np.ndarray | int = WINDOW) -> np.ndarray:
    """Sorted window starts (of ``lengths`` words) as disjoint ranges, pairs of int32."""
    stops = np.maximum.accumulate(starts + lengths) if len(starts) else starts
    new = np.flatnonzero(np.append(True, starts[1:] > stops[:-1])) if len(starts) else starts
    ends = np.append(new[1:], len(starts)) - 1 if len(starts) else starts
    return np.stack([starts[new], stops[ends]], axis=1).astype(np.int32)


def _block_places(table: pa.Table, names: pa.Table, buckets: int) -> pa.Table:
    """Round 2 of a block: the first place of each different window with a repeated name; later
    places are ranges to remove."""
    wanted = np.sort(np.concatenate([np.zeros(0, np.uint64), *[
        np.frombuffer(p, np.uint64) for p in names["payload"].to_pylist()]]))
    rows = Block(table)
    starts, first, second, owner, done = [], [], [], [], 0
    for column, row in rows.pieces():
        (words, other), counts = word_hashes(*text_buffers(column), seeds=(1, 2))
        begin, name, _ = window_names(words, counts)
        if len(begin) and len(wanted):
            change = np.append(True, name[1:] != name[:-1])
            runs = name[change]
            hit = wanted[np.minimum(np.searchsorted(wanted, runs), len(wanted) - 1)] == runs
            begin = begin[hit[np.cumsum(change) - 1]]
            starts.append(begin.astype(np.int64) + done)
            first.append(_sequence_hash(words, begin, 1))
            second.append(_sequence_hash(other, begin, 2))
            owner.append(rows.ids[row + spread(counts)[0][begin]])
        done += len(words)
    if not starts:
        return _message([], [], [], [])
    start, one, two, ids = (np.concatenate(x) for x in (starts, first, second, owner))
    order = np.lexsort((start, two, one))
    new = np.append(True, (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]]))
    keep = np.sort(order[new])
    block = table["block"][0].as_py()
    later = _ranges(np.sort(start[order[~new]]))
    start, one, two, ids = (x[keep] for x in (start, one, two, ids))
    order, cuts = _bucket_cuts(one, buckets)
    out = [(block % buckets, RANGES, later.tobytes())] if len(later) else []
    for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if j > i:
            at = order[i:j]
            out.append((b, PLACES, start[at].astype(np.int32).tobytes() + ids[at].tobytes()
                        + one[at].tobytes() + two[at].tobytes()))
    return _message([b for b, _, _ in out], [block] * len(out), [k for _, k, _ in out],
                    [p for _, _, p in out])


def _later_places(table: pa.Table) -> pa.Table:
    """Of one bucket: for each block, the places whose window starts earlier elsewhere."""
    out, mine = [], []
    for block, kind, payload in zip(table["block"].to_pylist(), table["kind"].to_pylist(),
                                    table["payload"].to_pylist(), strict=True):
        if kind == RANGES:
            out.append((block, kind, payload))
        else:
            mine.append((block, payload))
    if mine:
        sizes = [len(p) // 28 for _, p in mine]
        field = [np.concatenate([np.frombuffer(p, kind, n, at * n) for (_, p), n in
                                 zip(mine, sizes, strict=True)])
                 for kind, at in ((np.int32, 0), (np.int64, 4), (np.uint64, 12), (np.uint64, 20))]
        start, ids, one, two = field
        block = np.repeat([b for b, _ in mine], sizes)
        order = np.lexsort((start, block, ids, two, one))
        later = np.append(False, (one[order[1:]] == one[order[:-1]])
                          & (two[order[1:]] == two[order[:-1]]))
        marked = np.zeros(len(start), bool)
        marked[order[later]] = True
        cuts = np.cumsum([0, *sizes])
        for (b, _), i, j in zip(mine, cuts[:-1], cuts[1:], strict=True):
            if marked[i:j].any():
                out.append((b, PLACES, start[i:j][marked[i:j]].tobytes()))
    bucket = table["bucket"][0].as_py()
    return _message([bucket] * len(out), [b for b, _, _ in out], [k for _, k, _ in out],
                    [p for _, _, p in out])


def _removed(table: pa.Table, marks: pa.Table, full: bool) -> pa.Table:
    """Round 3 of a block: its rows without the words that marked windows cover."""
    rows = Block(table)
    ranges = [np.frombuffer(p, np.int32).reshape(-1, 2) if k == RANGES else
              _ranges(np.sort(np.frombuffer(p, np.int32)))
              for k, p in zip(marks["kind"].to_pylist(), marks["payload"].to_pylist(), strict=True)]
    ranges = np.concatenate([np.zeros((0, 2), np.int32), *ranges])
    n_words, n_removed, sha, kept_text, done = [], [], [], [], 0
    depth = None
    split_all = []
    for column, _ in rows.pieces():
        split_all.extend(t.split() for t in texts(column))
    total = sum(map(len, split_all))
    depth = np.zeros(total + 1, np.int32)
    np.add.at(depth, ranges[:, 0], 1)
    np.add.at(depth, ranges[:, 1], -1)
    gone = np.cumsum(depth)[:-1] > 0
    for words in split_all:
        mask = gone[done:done + len(words)]
        done += len(words)
        removed = int(mask.sum())
        if removed:
            words = [w for w, g in zip(words, mask.tolist(), strict=True) if not g]
        text = b" ".join(words)
        n_words.append(len(words) + removed)
        n_removed.append(removed)
        sha.append(hashlib.sha256(text).hexdigest())
        if full:
            kept_text.append(text.decode())
    out = {"id": rows.table["id"], "n_words": pa.array(n_words, pa.int64()),
           "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string())}
    if full:
        out["kept"] = pa.array(kept_text, pa.string())
    return pa.table(out)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES, full: bool = True) -> DataFrame:
    """Every row of ``docs`` without the words of windows that start earlier (in a row with a
    smaller id, or further left in the row).

    Returns id (named ``id_col``), n_words, n_removed, kept_sha256 and, with ``full``, kept (the
    words left, joined by a space). Ids are integers; null ids come first. Null and empty texts
    have no words. Rows with the same id count as one after the other, in a fixed order of
    their texts; other columns are not read.
    """
    rows = docs.select(docs[id_col].cast("bigint").alias("id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text")) \
        .withColumn("text_hash", F.xxhash64("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("id", "text_hash"), F.lit(blocks))) \
        .repartition(blocks, "block")

    def names_of(table: pa.Table) -> pa.Table:
        return _block_names(table, blocks)

    def places_of(left: pa.Table, right: pa.Table) -> pa.Table:
        return _block_places(left, right, blocks) if left.num_rows else _message([], [], [], [])

    def removed(left: pa.Table, right: pa.Table) -> pa.Table:
        return _removed(left, right, full)

    by_block = blocked.groupBy("block")
    names = by_block.applyInArrow(names_of, MESSAGE).groupBy("bucket") \
        .applyInArrow(_shared_names, MESSAGE)
    places = by_block.cogroup(names.groupBy("block")).applyInArrow(places_of, MESSAGE)
    marks = places.groupBy("bucket").applyInArrow(_later_places, MESSAGE)
    out = by_block.cogroup(marks.groupBy("block")).applyInArrow(
        removed, "id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
        + (", kept string" if full else ""))
    return out.withColumnRenamed("id", id_col)
