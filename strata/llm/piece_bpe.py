"""SentencePiece encoding and decoding with a given BPE model (operator 8).

A text is the model's identity normalisation: a space in front, every space written as the
mark U+2581. No piece of the vocabulary has the mark after another character, so no merge
crosses from a word to the next mark and each unit ``marks + following characters`` can be
encoded alone. Units repeat, so a task encodes each distinct unit of a chunk once, all of
them together:

* symbols of all units stand in flat numpy arrays (symbol, unit), with the rank of the
  pair that each symbol forms with the next;
* a round takes the least rank of each unit (a segmented minimum) and merges, from the
  left, all its occurrences at once; arrays are compacted and only pairs beside a merge
  are ranked again; units without a pair leave; rounds go on until none is left;
* merging all occurrences at once equals the library's one-by-one order if no pair formed
  with the new piece ranks before it. The few pieces for which the vocabulary breaks this
  (and those with tied scores) are merged one occurrence a round, the leftmost. Units that
  still have pairs after ``ROUNDS`` rounds (a very long run) go through the same order with
  a priority queue.

Characters without a piece become their bytes' pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import chunks, frugal, texts

MARK = "▁"
NONE = np.int32(2**31 - 1)
ROUNDS = 200
# distinct units kept by a task; beyond it the store starts anew (the result is the same)
STORE = 100_000
_UNITS = re.compile(rb" *[^ ]+| +")


class Vocabulary:
    """Pieces, scores and merge table of a model file (read with the library)."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.size = size
        surface = [sp.id_to_piece(i) for i in range(size)]
        plain = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)) for i in range(size)]
        if any(MARK in p.lstrip(MARK) for p, ok in zip(surface, plain, strict=True) if ok):
            raise ValueError("a piece has the space mark after another character")
        scores = np.array([sp.get_score(i) for i in range(size)])
        # rank 0 is merged first; equal scores share a rank
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        ids = {p: i for i, (p, ok) in enumerate(zip(surface, plain, strict=True)) if ok}
        self.byte_id = np.full(256, sp.unk_id(), np.int32)
        self.raw: list[bytes] = []
        for i, p in enumerate(surface):
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.raw.append(bytes([int(p[3:5], 16)]))
            else:
                self.raw.append(p.replace(MARK, " ").encode() if plain[i] else b"")
        self.symbol = np.arange(0x110000, dtype=np.int32) + size  # a character without a piece
        for p, i in ids.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        keys, merged = [], []
        for p, i in ids.items():
            for k in range(1, len(p)):
                a, b = ids.get(p[:k]), ids.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a * size + b)
                    merged.append(i)
        order = np.argsort(keys)
        self.keys = np.append(np.array(keys, np.int64)[order], np.int64(2**62))
        self.merged = np.append(np.array(merged, np.int32)[order], np.int32(0))
        self.rank = rank
        ranks = rank[self.merged[:-1]]
        alone = np.bincount(rank[list(ids.values())], minlength=rank.max() + 1) > 1
        self.single = alone[rank]  # merge one occurrence a round
        for part in (self.keys[:-1] // size, self.keys[:-1] % size):
            self.single[part[ranks <= rank[part]]] = True

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE: no piece) and merged piece of pairs of symbols."""
        key = left.astype(np.int64) * self.size + right
        key[(left >= self.size) | (right >= self.size)] = -1
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        piece = np.where(hit, self.merged[at], 0)
        return np.where(hit, self.rank[piece], NONE), piece

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """Ids of each unit (its spaces already marked)."""
        lengths = np.array([len(u) for u in units], np.int64)
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        done: list[list[int]] = [[] for _ in units]
        sym, unit = self.symbol[points], np.repeat(np.arange(len(units)), lengths)
        rank = np.full(len(sym), NONE, np.int32)
        piece = np.zeros(len(sym), np.int32)
        todo = np.arange(len(sym) - 1) if len(sym) else np.zeros(0, np.int64)
        for _ in range(ROUNDS):
            if len(sym) == 0:
                return done
            todo = todo[unit[todo] == unit[np.minimum(todo + 1, len(unit) - 1)]]
            rank[todo], piece[todo] = self.pairs(sym[todo], sym[todo + 1])
            starts = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(sym)))
            ready = least == NONE
            if ready.any():
                self._put(done, unit[starts[ready]], sym, starts[ready], sizes[ready])
            live = np.repeat(~ready, sizes)
            each = np.repeat(least, sizes)
            chosen = (rank == each) & live
            # overlapping occurrences (a a a): every second one from the left
            at = np.flatnonzero(chosen)
            if len(at) == 0:
                return done
            new_run = np.append(True, (at[1:] != at[:-1] + 1) | (unit[at[1:]] != unit[at[:-1]]))
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            take = (np.arange(len(at)) - run_start) % 2 == 0
            # pieces merged one at a time: the first of its unit only
            first = np.append(True, unit[at[1:]] != unit[at[:-1]])
            lead = piece[at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]]
            take &= first | ~self.single[lead]
            at = at[take]
            sym[at] = piece[at]
            gone = np.zeros(len(sym), bool)
            gone[at + 1] = True
            keep = live & ~gone
            place = np.cumsum(keep) - 1
            merged_at = place[at]
            rank[at] = NONE
            before = merged_at - 1
            sym, unit, rank, piece = sym[keep], unit[keep], rank[keep], piece[keep]
            before = before[before >= 0]
            rank[before] = np.where(unit[before] == unit[np.minimum(before + 1, len(unit) - 1)],
                                    NONE, rank[before])
            todo = np.unique(np.concatenate([before, merged_at]))
            todo = todo[todo < len(sym) - 1]
        starts = np.flatnonzero(np.append(True, unit[1:] != unit[:-1])) if len(sym) else []
        for a, b in zip(starts, [*starts[1:], len(sym)], strict=False):
            left = self._queue(sym[a:b].tolist())
            self._put(done, unit[a:a + 1], np.array(left, np.int32), np.array([0]),
                      np.array([len(left)]))
        return done

    def _queue(self, symbols: list[int]) -> list[int]:
        """The same merges on one unit, one by one, best rank then leftmost first."""
        after = [*range(1, len(symbols)), -1]
        before = list(range(-1, len(symbols) - 1))
        heap: list = []
        size, table = self.size, self._table()

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and symbols[a] < size and symbols[b] < size:
                p = table.get(symbols[a] * size + symbols[b])
                if p is not None:
                    heapq.heappush(heap, (int(self.rank[p]), a, b, symbols[a], symbols[b], p))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, x, y, p = heapq.heappop(heap)
            if symbols[a] != x or symbols[b] != y or after[a] != b:
                continue
            symbols[a], symbols[b] = p, -1
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [s for s in symbols if s >= 0]

    def _table(self) -> dict[int, int]:
        if not hasattr(self, "_lookup"):
            self._lookup = dict(zip(self.keys[:-1].tolist(), self.merged[:-1].tolist(),
                                    strict=True))
        return self._lookup

    def _put(self, done, units, sym, starts, sizes) -> None:
        rows = np.repeat(starts - np.append(0, np.cumsum(sizes)[:-1]), sizes)
        flat = sym[rows + np.arange(len(rows))]
        plain = flat.tolist()
        has_unknown = np.add.reduceat(flat >= self.size, np.append(0, np.cumsum(sizes)[:-1])) > 0
        at = 0
        for u, n, odd in zip(units.tolist(), sizes.tolist(), has_unknown.tolist(), strict=True):
            ids = plain[at:at + n]
            at += n
            if odd:
                ids = [x for i in ids for x in
                       ([i] if i < self.size
                        else self.byte_id[list(chr(i - self.size).encode())].tolist())]
            done[u] = ids

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 text of ids: marks become spaces, the first mark goes, bytes that are not
        UTF-8 become U+FFFD one by one."""
        raw = b"".join([self.raw[i] for i in ids])
        if ids and ids[0] not in self.byte_id and raw[:1] == b" ":
            raw = raw[1:]
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            out = []
            while raw:
                try:
                    out.append(raw.decode())
                    break
                except UnicodeDecodeError as e:
                    out.append(raw[:e.start].decode() + "�")
                    raw = raw[e.start + 1:]
            return "".join(out).encode()


class Encoder:
    """Units of a task, encoded once each."""

    def __init__(self, model_path: str):
        self.vocabulary = Vocabulary(model_path)
        self.joined: dict[bytes, bytes] = {}
        self.decoded: dict[bytes, bytes] = {}

    def units(self, text: bytes) -> list[bytes]:
        """Each unit without its first space."""
        if not text:
            return []
        if b"\xe2\x96\x81" in text:
            text = text.replace(b"\xe2\x96\x81", b" ")
        if b"  " in text or text[:1] == b" " or text[-1:] == b" ":
            return [u[1:] for u in _UNITS.findall(b" " + text)]
        return text.split(b" ")

    def learn(self, docs: list[list[bytes]]) -> None:
        if len(self.joined) > STORE:
            self.joined, self.decoded = {}, {}
        new = list({u for units in docs for u in units if u not in self.joined})
        marked = [MARK + u.decode().replace(" ", MARK) for u in new]
        raw = self.vocabulary.raw
        for u, ids in zip(new, self.vocabulary.encode_units(marked), strict=True):
            self.joined[u] = ",".join(map(str, ids)).encode()
            self.decoded[u] = b"".join([raw[i] for i in ids])


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                  text_col: str = "text", full: bool = True) -> DataFrame:
    """Every row of ``docs`` with its tokens, encoded and decoded without begin or end ids.

    Returns ``id_col``, n_tokens, ids_sha256 (of the decimal ids joined by commas),
    decoded_sha256, and with ``full`` also ids (array<int>) and decoded (the text).
    Null and empty texts have no ids and decode to the empty text; repeated rows stay;
    other columns of ``docs`` are not read, whatever their names. ``model_path`` must be
    readable on every executor (part of its image, as the libraries are).
    """
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if full else ""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_path)
        for part in chunks(batches, "text"):
            split = [encoder.units(t) for t in texts(part.column("text"))]
            encoder.learn(split)
            n, sha, dec, ids, plain = [], [], [], [], []
            for units in split:
                joined = b",".join([encoder.joined[u] for u in units])
                text = b"".join([encoder.decoded[u] for u in units])[1:]
                n.append(joined.count(b",") + 1 if joined else 0)
                sha.append(hashlib.sha256(joined).hexdigest())
                dec.append(hashlib.sha256(text).hexdigest())
                if full:
                    ids.append(np.fromstring(joined, np.int32, sep=",") if joined else [])
                    plain.append(text.decode())
            columns = [part.column("id"), pa.array(n, pa.int64()), pa.array(sha), pa.array(dec)]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if full:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(plain, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(run, schema)
