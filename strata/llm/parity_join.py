"""N-gram Jaccard join by parity sketches (operator 10).

A document's set is its different word shingles. Two sets of together s shingles have a Jaccard
similarity of ``percent`` / 100 or more just if at most s * (100 - percent) / (100 + percent)
shingles are in one of them only.

* Sketch: each shingle flips one bit of a long bit vector, so the Hamming distance of two
  sketches is at most the number of shingles in one set only.
* Size bands: sets that can be linked lie in the same band or in neighbouring ones. For a band
  and the next, D is the largest difference a linked pair can have; the vector is cut into
  D + 1 + E segments, so a linked pair has E + 1 equal segments (pigeonhole), and one with shingles
  in it unless both sets have more than E empty segments. Empty segments are therefore sent only
  for sets with more than E of them. A segment of 2**20 bits is sent as the XOR of a random
  number for each bit set, which equal segments share.
* Join: the sets of an equal segment are all put beside the least of them (its centre), one row a
  set and centre, however many segments they share. Sets that meet at a centre are compared by
  sketches of a few bits a shingle, folded to the same length; those whose Hamming distance is too
  large are no candidates. A spanning forest of the others goes on. (If one task holds over ``HOT``
  sets of a segment, it sends on only the least; the others go to the next step unfiltered.)
* Verify: sets of a candidate component meet in tiles of bounded size (every pair in some tile) and
  are compared exactly; a tile returns a spanning forest of the links it has found. Components of
  these forests are those of all links. Centres with many sets are cut into tiles, too.

Equal sets count once: copies of a text are one set throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (LOWER, chunks, fresh_name, frugal, materialise, mix, spread,
                               text_buffers, word_hashes)
from strata.llm.components import components

SHINGLE = 3
PERCENT = 90
BUCKET_BYTES = 16 << 20
SEGMENT_BITS = 20
TILE = 4096
# keys gathered by a task before it sends them, and sets of one key that it sends one by one
FLUSH = 1_000_000
HOT = 50_000
# bits of a set's own sketch for each shingle, at least, and its least length
SKETCH_BITS, SKETCH_LEAST = 4, 256
# bits of the filter that keeps other rows out of exact joins (8 MB)
FILTER_BITS = 1 << 26
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(column, size: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text (a shorter text is one shingle)."""
    data, offsets = text_buffers(column)
    (words,), counts = word_hashes(LOWER[data], offsets)
    n = len(words)
    code = np.zeros(n, np.uint64)
    for k in range(size):
        code[:n - k] = mix(code[:n - k] * _A + words[k:] + np.uint64(k + 1))
    row, place = spread(counts)
    whole = np.flatnonzero(place <= (counts - size)[row])
    cuts = np.searchsorted(row[whole], np.arange(len(counts) + 1))
    code, out = code[whole], []
    ends = np.concatenate([[0], np.cumsum(counts)])
    for i, c in enumerate(counts.tolist()):
        if c >= size:
            out.append(np.unique(code[cuts[i]:cuts[i + 1]]))
        elif c:
            value = np.array([c], np.uint64)
            for at in range(ends[i], ends[i + 1]):
                value = mix(value * _B + words[at:at + 1])
            out.append(value)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


@lru_cache(maxsize=4)
def bands(percent: int) -> tuple[list[int], list[int], list[int]]:
    """First size of each band; segments for a band together with the next, and how many of them
    may be empty in a set (E; more are rare in sets of these sizes)."""
    first = [1]
    while first[-1] < 1 << 31:
        first.append(first[-1] * 100 // percent + 1)
    segments, empty = [], []
    for least, after in zip(first[:-1], first[1:], strict=True):
        small = after - 1
        large = small * 100 // percent
        need = (small + large) * (100 - percent) // (100 + percent) + 1
        spare = 0
        for _ in range(30 if need > 1 else 0):
            some = (need + spare) * math.exp(-least / (need + spare))
            wanted = math.ceil(some + 3 * math.sqrt(some))
            if wanted <= spare or wanted > need:
                break
            spare = wanted
        segments.append(need + spare)
        empty.append(spare)
    return first, segments, empty


def segment_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """A key for each segment of the sketches of a set: for its band and for the band before."""
    first, segments, empty = bands(percent)
    band = int(np.searchsorted(first, len(shingles), "right")) - 1
    bit = mix(shingles ^ _B) & np.uint64((1 << SEGMENT_BITS) - 1)
    number = mix(bit + _A)
    high = shingles >> np.uint64(32)
    out = []
    for b in (band, band - 1) if band else (band,):
        count = segments[b]
        segment = (high * np.uint64(count)) >> np.uint64(32)  # ascending, as the shingles are
        parity = np.zeros(count, np.uint64)
        begins = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        parity[segment[begins].astype(np.int64)] = np.bitwise_xor.reduceat(number, begins)
        place = np.arange(count, dtype=np.uint64) + np.uint64(b << 32)
        keys = mix(parity + mix(place + _A))
        full = np.zeros(count, bool)
        full[segment[begins].astype(np.int64)] = True
        out.append(keys[full])
        if count - full.sum() > empty[b]:
            out.append(mix(place[~full] + _B))
    return np.concatenate(out)


def own_sketch(shingles: np.ndarray) -> bytes:
    """The parity sketch of a set for comparing it with others: a power of two of bits."""
    bits = SKETCH_LEAST
    while bits < SKETCH_BITS * len(shingles):
        bits *= 2
    at = (mix(shingles + _B) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1, bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, longer ones folded (XOR of halves, which is the sketch
    with half the bits) to the length of the shortest."""
    length = min(map(len, sketches))
    out = np.empty((len(sketches), length // 8), np.uint64)
    for i, s in enumerate(sketches):
        row = np.frombuffer(s, np.uint64)
        out[i] = np.bitwise_xor.reduce(row.reshape(-1, length // 8), axis=0)
    return out


def _print(shingles: np.ndarray) -> bytes:
    """A 128-bit fingerprint of a set."""
    return np.array([mix(shingles).sum(dtype=np.uint64),
                     mix(shingles ^ _A).sum(dtype=np.uint64)]).tobytes()


def _stars(keys: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys with the least set of each; links from the others to it."""
    order = np.lexsort((sets, keys))
    keys, sets = keys[order], sets[order]
    begins = np.append(True, keys[1:] != keys[:-1])
    least = sets[np.flatnonzero(begins)[np.cumsum(begins) - 1]]
    other = least != sets
    links = np.unique(np.stack([sets[other], least[other]], axis=1), axis=0)
    return keys[begins], sets[begins], links


_FIELDS = ["id", "text_key", "n", "print", "sketch", "bucket", "payload"]


def _mapped(id_type: pa.DataType, rows: dict) -> pa.RecordBatch:
    n = max(len(v) for v in rows.values())
    types = [id_type, pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, t) if f not in rows else
         rows[f].cast(t) if isinstance(rows[f], pa.Array) else pa.array(rows[f], t)
         for f, t in zip(_FIELDS, types, strict=True)], _FIELDS)


def _sketched(batches, buckets: int, percent: int, size: int) -> Iterator[pa.RecordBatch]:
    """A row for each document; for each bucket the keys and their sets."""
    keys, sets, held, seen = [], [], 0, 0
    id_type = None
    for part in chunks(batches, "text"):
        id_type = part.column("id").type
        numbers, prints, sketches = [], [], []
        for s in shingle_sets(part.column("text"), size):
            numbers.append(len(s))
            prints.append(_print(s) if len(s) else None)
            sketches.append(own_sketch(s) if len(s) else None)
            if len(s):
                k = segment_keys(s, percent)
                keys.append(k)
                sets.append(np.full(len(k), np.frombuffer(prints[-1], np.int64)[0]))
                held += len(k)
        where = (np.arange(part.num_rows) + seen) % buckets
        seen += part.num_rows
        yield _mapped(id_type, {"id": part.column("id"), "text_key": part.column("text_key"),
                                "n": numbers, "print": prints, "sketch": sketches, "bucket": where})
        if held >= FLUSH:
            yield _sent(id_type, keys, sets, buckets)
            keys, sets, held = [], [], 0
    if held:
        yield _sent(id_type, keys, sets, buckets)


def _sent(id_type, keys, sets, buckets: int) -> pa.RecordBatch:
    key, least = np.concatenate(keys), np.concatenate(sets)
    order = np.lexsort((least, key))
    key, least = key[order], least[order]
    new = np.append(True, (key[1:] != key[:-1]) | (least[1:] != least[:-1]))
    key, least = key[new], least[new]  # a copy of a set adds nothing
    begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(begins, len(key)))
    hot = np.repeat(size > HOT, size)
    hot[begins] = False
    links = _stars(key[np.repeat(size > HOT, size)], least[np.repeat(size > HOT, size)])[2] \
        if hot.any() else np.zeros((0, 2), np.int64)
    hot_keys = np.unique(key[hot])
    key, least = key[~hot], least[~hot]
    bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))  # keys are sorted
    numbers, payload = [], []
    for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if j > i:
            numbers.append(b)
            payload.append(b"K" + key[i:j].tobytes() + least[i:j].tobytes())
            mine = hot_keys[np.isin(hot_keys, key[i:j])]
            if len(mine):
                numbers.append(b)
                payload.append(b"H" + mine.tobytes())
    if len(links):
        numbers.append(int(key[0] % np.uint64(buckets)))
        payload.append(b"L" + links.tobytes())
    return _mapped(id_type, {"bucket": numbers, "payload": payload})


@frugal
def _met(table: pa.Table) -> pa.Table:
    """Of one bucket: its documents as they came; each set with the centre of a key (a, b);
    links that are not to be filtered (kept)."""
    payload = table["payload"]
    docs = table.filter(pa.compute.is_null(payload)).select(["id", "text_key", "n", "print", "sketch"])
    links, kept, keys, sets, hot = np.zeros((0, 2), np.int64), [], [], [], []
    for sent in payload.drop_null():
        p = sent.as_py()
        if p[:1] == b"L":
            kept.append(np.frombuffer(p, np.int64, offset=1).reshape(-1, 2))
        elif p[:1] == b"H":
            hot.append(np.frombuffer(p, np.uint64, offset=1))
        else:
            n = (len(p) - 1) // 16
            keys.append(np.frombuffer(p, np.uint64, n, 1))
            sets.append(np.frombuffer(p, np.int64, n, 1 + 8 * n))
    if keys:
        key, least = np.concatenate(keys), np.concatenate(sets)
        if hot:  # its other sets are not here to be compared: all of them stay linked
            among = np.isin(key, np.concatenate(hot))
            kept.append(_stars(key[among], least[among])[2])
            key, least = key[~among], least[~among]
        links = _stars(key, least)[2] if len(key) else links
    plain, none = len(links), docs.num_rows
    links = np.concatenate([links, *kept])
    count = len(links)

    def column(name: str) -> pa.ChunkedArray:
        have = docs[name]
        return pa.chunked_array([*have.chunks, pa.nulls(count, have.type)], have.type)

    def linked(values: np.ndarray, kind: pa.DataType) -> pa.ChunkedArray:
        return pa.chunked_array([pa.nulls(none, kind), pa.array(values, kind)], kind)

    return pa.table({**{c: column(c) for c in ("id", "text_key", "n", "print", "sketch")},
                     "kept": linked(np.arange(count) >= plain, pa.bool_()),
                     "a": linked(links[:, 0], pa.int64()), "b": linked(links[:, 1], pa.int64())})


def _near(table: pa.Table, percent: int) -> pa.Table:
    """Of one tile or several centres: a spanning forest, for each centre, of the pairs whose
    sketches are near enough for a link."""
    centre = table["centre"].to_numpy()
    order = np.argsort(centre, kind="stable")
    node, size = table["node"].to_numpy()[order], table["n"].to_numpy()[order]
    sketches = table["sketch"].to_pylist()
    cuts = np.flatnonzero(np.append(True, centre[order][1:] != centre[order][:-1]))
    found: list[tuple[int, int]] = []
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True):
        words = folded([sketches[i] for i in order[a:b].tolist()])
        names, n = node[a:b], size[a:b]
        left = np.arange(b - a)
        while len(left) > 1:
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                x = queue.pop()
                apart = np.bitwise_count(words[left] ^ words[x]).sum(axis=1, dtype=np.int64)
                near = apart * (100 + percent) <= (n[left] + n[x]) * (100 - percent)
                queue.extend(left[near].tolist())
                found.extend((int(names[x]), y) for y in names[left[near]].tolist())
                left = left[~near]
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()),
                     "b": pa.array([y for _, y in found], pa.int64())})


def _candidates(met: DataFrame, percent: int, tile: int, buckets: int) -> DataFrame:
    """Edges (a, b) between sets that may be linked, such that every linked pair is connected."""
    edges = met.where("not kept").select("a", "b").distinct()
    members = edges.select(F.col("b").alias("centre"), F.col("a").alias("node")) \
        .union(edges.select("b", "b").distinct())
    sets = met.where("print is not null").withColumn("node", _first_number("print")) \
        .groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    tiles = members.groupBy("centre").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles"))
    members = members.join(tiles, "centre").join(sets, "node")
    mine = F.pmod(F.xxhash64("node"), F.col("tiles"))
    members = members.withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    large = F.col("tiles") > 1
    members = members.select(
        "centre", "node", "n", "sketch", large.alias("large"),
        # small centres are worked on many at a time
        F.when(large, F.col("centre")).otherwise(
            F.pmod(F.xxhash64("centre"), F.lit(4 * buckets))).alias("place"),
        F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"))

    @frugal
    def near(table: pa.Table) -> pa.Table:
        return _near(table, percent)

    return members.groupBy("large", "place", "x", "y").applyInArrow(near, "a bigint, b bigint") \
        .union(met.where("kept").select("a", "b"))


def _forest(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets: breadth first, comparing a set with all
    that are not reached yet by counting its shingles in theirs."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    member = np.zeros(int(flat.max()) + 1, bool)
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    own = [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    left = np.arange(len(sets))
    tokens, begins = flat, cuts[:-1]
    reached = np.zeros(len(sets), bool)
    out = []
    for seed in range(len(sets)):
        if reached[seed]:
            continue
        reached[seed] = True
        queue = [seed]
        while queue:
            x = queue.pop()
            open_ = ~reached[left]
            if 2 * open_.sum() < len(left):  # forget those that have been reached
                left = left[open_]
                if len(left) == 0:
                    return out
                tokens = np.concatenate([own[i] for i in left.tolist()])
                begins = np.concatenate([[0], np.cumsum(sizes[left])[:-1]])
                open_ = np.ones(len(left), bool)
            member[own[x]] = True
            shared = np.add.reduceat(member[tokens], begins, dtype=np.int64)
            member[own[x]] = False
            union = sizes[x] + sizes[left] - shared
            for y in left[open_ & (100 * shared >= percent * union)].tolist():
                reached[y] = True
                queue.append(y)
                out.append((x, y))
    return out


def _classes(docs: DataFrame, id_col: str, text_col: str, percent: int, shingle: int,
             bucket_bytes: int, tile: int) -> DataFrame:
    """Every row's id, text_key, number of shingles (n) and class: equal in rows that links
    connect, null without shingles."""
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("id"), text.alias("text"),
                       F.unhex(F.md5(text.cast("binary"))).alias("text_key"))
    id_type = rows.schema["id"].dataType.simpleString()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))

    @frugal
    def sketched(batches):
        yield from _sketched(batches, buckets, percent, shingle)

    shape = f"id {id_type}, text_key binary, n bigint, print binary, sketch binary"
    met = rows.mapInArrow(sketched, shape + ", bucket bigint, payload binary") \
        .groupBy("bucket").applyInArrow(_met, shape + ", kept boolean, a bigint, b bigint")
    met = materialise(met, "parity-join")
    every = met.where("n is not null").select("id", "text_key", "n", "print")
    near = components(_candidates(met, percent, tile, buckets))

    # one text of each set in a candidate component of two sets or more
    sets = every.where("print is not null").groupBy("print").agg(F.min("text_key").alias("text_key"))
    sets = sets.withColumn("node", _first_number("print")).join(near, "node")
    tiles = sets.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles"))
    sets = sets.join(tiles, "root").select("text_key", "root", "tiles", "print")
    found = _probably_in(rows, sets, ["text_key"])[0].groupBy("text_key") \
        .agg(F.first("text").alias("text")).join(sets, "text_key")

    @frugal
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            made = shingle_sets(part.column("text"), shingle)
            yield part.select(["root", "tiles", "print"]).append_column(
                "shingles", pa.array([s.tobytes() for s in made], pa.binary()))

    found = found.select("root", "tiles", "print", "text").mapInArrow(
        placed, "root bigint, tiles int, print binary, shingles binary")
    mine = F.pmod(F.xxhash64("print"), F.col("tiles"))
    found = found.withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    found = found.withColumn("x", F.least("mine", "other")).withColumn("y", F.greatest("mine", "other"))

    @frugal
    def linked(table: pa.Table) -> pa.Table:
        names = table["print"].to_pylist()
        order = sorted(range(len(names)), key=names.__getitem__)
        made = [np.frombuffer(table["shingles"][i].as_py(), np.uint64) for i in order]
        pairs = _forest(made, percent)
        return pa.table({"a": pa.array([names[order[x]] for x, _ in pairs], pa.binary()),
                         "b": pa.array([names[order[y]] for _, y in pairs], pa.binary())})

    links = found.groupBy("root", "x", "y").applyInArrow(linked, "a binary, b binary")
    groups = components(links)
    return every.join(groups, every["print"] == groups["node"], "left").select(
        "id", "text_key", "n", F.coalesce("root", "print").alias("class"))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   percent: int = PERCENT, shingle: int = SHINGLE,
                   bucket_bytes: int = BUCKET_BYTES, tile: int = TILE) -> DataFrame:
    """Every row of ``docs`` with its component under links of Jaccard similarity ``percent`` or more.

    Returns id (named ``id_col``), n_shingles, component_id: the least id of all rows that links
    lead to. Null and empty texts have no shingles and are linked with nothing, so their component
    is their own id. Null ids are passed over for the least id. Repeated rows stay and share a
    component; other columns are not read.
    """
    every = _classes(docs, id_col, text_col, percent, shingle, bucket_bytes, tile)
    least = every.where("class is not null").groupBy("class").agg(F.min("id").alias("component"))
    return every.join(least, "class", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component"))
        .alias("component_id"))


def _probably_in(rows: DataFrame, wanted: DataFrame,
                 keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose keys may be among the ``wanted`` (all that are, and few
    others), and those whose keys are not. The filter is a bit for each hash of a wanted key, of
    ``FILTER_BITS`` bits however many keys there are; what it lets through is joined exactly."""
    place = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    words = wanted.select(place.alias("place")).groupBy(
        F.floor(F.col("place") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def among(place: pd.Series) -> pd.Series:
        at = place.to_numpy().astype(np.uint64)
        word = shared.value[(at // np.uint64(64)).astype(np.int64)]
        return pd.Series((word >> (at % np.uint64(64))) & np.uint64(1) == 1)

    return rows.where(among(place)), rows.where(~among(place))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             percent: int = PERCENT, shingle: int = SHINGLE,
             bucket_bytes: int = BUCKET_BYTES, tile: int = TILE) -> DataFrame:
    """The rows of ``docs``, with all their columns, without the others of their group: the row
    with the least id stays (null last; then by text), once if it is repeated. Rows
    without shingles stay, once each if they are repeated."""
    key = fresh_name("__text_key", docs.columns)
    every = _classes(docs, id_col, text_col, percent, shingle, bucket_bytes, tile)
    best = every.where("class is not null").groupBy("class").agg(F.min(F.struct(
        F.col("id").isNull().alias("none"), "id", "text_key")).alias("k")) \
        .select(F.col("k.id").alias("best_id"), F.col("k.text_key").alias("best_key"))
    best = best.union(every.where("class is null").select("id", "text_key").distinct())
    keyed = docs.withColumn(key, F.unhex(F.md5(F.coalesce(docs[text_col], F.lit("")).cast("binary"))))
    # most rows are alone in their group and not repeated: only the others are shuffled
    each = every.groupBy("class", "id", "text_key").agg(F.count(F.lit(1)).alias("rows"))
    grouped = each.where("class is not null").groupBy("class").agg(
        F.sum("rows").alias("members")).where("members > 1")
    others = each.join(grouped, "class").select("id", "text_key").union(
        each.where("class is null and rows > 1").select("id", "text_key"))
    maybe, alone = _probably_in(
        keyed, others.select(F.col("id").alias(id_col), F.col("text_key").alias(key)), [id_col, key])
    kept = maybe.join(best, maybe[id_col].eqNullSafe(best["best_id"])
                      & (maybe[key] == best["best_key"]), "left_semi")
    return kept.dropDuplicates([id_col, key]).select(*docs.columns) \
        .unionByName(alone.select(*docs.columns))


def _first_number(column: str):
    """The first 8 bytes of a binary column as the signed little-endian number they are."""
    swapped = F.concat(*[F.substring(column, i, 1) for i in range(8, 0, -1)])
    return F.conv(F.hex(swapped), 16, -10).cast("bigint")
