"""Language-model scoring by prediction by partial matching (operator 1).

The model is every context of up to ``DEPTH`` bytes that the training part of the corpus holds, with
the symbols seen after it, so it grows with the corpus; no context is left out. Contexts of up to
``LOW`` bytes (at most 257 + 257**2) are a trie that every task holds. The longer ones are a
Spark table: a block of documents sends each different gram (a context of DEPTH bytes and the
symbol after it) once, with its count in training rows, to the part that owns the LOW + 1 bytes
next to the symbol. All longer contexts that end in these bytes meet there, so the part sums the
counts, works out the cost of every gram, and sends each block the costs of its own grams. No task
holds the model.

A symbol is a byte of the lower-cased (A-Z) text, or the end of the text. Its probability is that
of PPM with escape method C and symbol exclusion: in the longest context of the trie, a symbol
seen n times in N, among T different ones, has n / (N + T); the escape, T / (N + T), leads to the
context one byte shorter, in which symbols of the longer one are left out of N and T; below the
empty context all remaining symbols are alike. The symbols of a context are among those of each
shorter one, so the cost needs, of each context, only N, T, and E: the count its symbols have
after the context one byte shorter.

Blocks are named so that each is a task of its own.

The base counts of words travel by blocks of documents: a block sends each different word once,
and gets back the words' counts in the training part; no task holds the vocabulary.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (
    LOWER,
    chunks,
    earlier,
    frugal,
    give_back,
    materialise,
    mix,
    row_sums,
    summed_cells,
    text_buffers,
    texts,
    training_rows,
)

DEPTH = 5
LOW = 2
BITS = 9  # of a symbol in a gram's number; DEPTH + 1 symbols have at most 63 bits
SYMBOLS = 257  # 256 bytes and the end
END = 256
BLOCK_BYTES = 16 << 20
DEAD, ROOT = 0, 1


def symbols_of(column) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all rows, each row closed by END, and their offsets."""
    data, offsets = text_buffers(column)
    rows = len(offsets) - 1
    out = np.full(len(data) + rows, END, np.int32)
    out[np.arange(len(data)) + np.repeat(np.arange(rows), np.diff(offsets))] = LOWER[data]
    return out, offsets + np.arange(rows + 1)


class Trie:
    """Nodes by depth. ``child[node, byte]`` is the node of the context one byte longer (to the
    left), or DEAD; counts[d] holds the symbols seen after the nodes of depth d. Before its
    first byte a text has END."""

    def __init__(self):
        self.child = np.full((2, SYMBOLS), DEAD, np.int32)
        self.parent = [np.zeros(1, np.int32)]
        self.first = [ROOT]  # the first node of each depth
        self.counts: list[np.ndarray] = []

    def nodes(self, symbols: np.ndarray, offsets: np.ndarray, depth: int) -> np.ndarray:
        """The node of the ``depth`` symbols before each symbol, or DEAD."""
        node = np.full(len(symbols), ROOT, np.int32)
        flat = self.child.ravel()
        for k in range(1, depth + 1):
            node = flat[node * np.int32(SYMBOLS) + earlier(symbols, offsets, k, END)]
        return node

    def grow(self, parents: np.ndarray, added: np.ndarray) -> None:
        """Add the contexts ``added[i]`` + context of ``parents[i]`` as the next depth."""
        begin = len(self.child)
        self.first.append(begin)
        self.parent.append(parents.astype(np.int32))
        self.child = np.vstack([self.child, np.full((len(parents), SYMBOLS), DEAD, np.int32)])
        self.child[parents, added] = begin + np.arange(len(parents))

    def size(self, depth: int) -> int:
        return (self.first + [len(self.child)])[depth + 1] - self.first[depth]


def count_level(trie: Trie, depth: int, batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """After the nodes of ``depth``: the symbols seen, and (in the second half of the cells) the
    bytes that stand before the context; the cells that occur, in order, and how often."""
    begin, half = trie.first[depth], trie.size(depth) * SYMBOLS
    cells, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for part in chunks(batches, "text"):
        symbols, offsets = symbols_of(part.column("text"))
        node = trie.nodes(symbols, offsets, depth) - begin
        ok = node >= 0
        base = node[ok].astype(np.int64) * SYMBOLS
        before = earlier(symbols, offsets, depth + 1, END)[ok]
        found, times = np.unique(np.concatenate([base + symbols[ok], base + before + half]),
                                 return_counts=True)
        cells, n = summed(np.concatenate([cells, found]), np.concatenate([n, times]))
    return cells, n


def learn(trie: Trie, depth: int, counted: np.ndarray, last: bool, share: float) -> None:
    """Put the summed counts of a level into the trie and grow the next."""
    half = len(counted) // 2
    symbols = counted[:half].reshape(-1, SYMBOLS).copy()
    if depth == 1:
        trie.counts.append(symbols.sum(axis=0, keepdims=True))
    trie.counts.append(symbols)
    if not last:
        before = counted[half:].reshape(-1, SYMBOLS)
        at, added = np.nonzero(before >= max(1.0, share * trie.counts[0].sum()))
        trie.grow(at + trie.first[depth], added)


def fit(rows: DataFrame, depth: int = LOW, share: float = 0.0) -> Trie:
    """The trie of all texts of ``rows`` (column text), of ``depth`` bytes at least 1; a context
    is a node if it makes up at least ``share`` of the symbols (0: if it occurs)."""
    trie = Trie()
    trie.grow(np.full(SYMBOLS, ROOT), np.arange(SYMBOLS))
    for d in range(1, depth + 1):
        counted = summed_cells(_counted(rows, trie, d), 2 * trie.size(d) * SYMBOLS)
        learn(trie, d, counted, d == depth, share)
        if d < depth and trie.size(d + 1) == 0:
            break
    return trie


def _counted(rows: DataFrame, trie: Trie, depth: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(trie)

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, n = count_level(shared.value, depth, batches)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n)], ["cell", "n"])

    return rows.select("text").mapInArrow(run, "cell bigint, n bigint")


def grams_of(symbols: np.ndarray, offsets: np.ndarray, depth: int) -> np.ndarray:
    """For each symbol the number of its gram: the ``depth`` symbols before it, the nearest first,
    and the symbol."""
    out = np.zeros(len(symbols), np.int64)
    for k in range(1, depth + 1):
        out = (out << BITS) | earlier(symbols, offsets, k, END)
    return (out << BITS) | symbols


def summed(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different grams in order, and the sum of the counts of each."""
    order = np.argsort(grams, kind="stable")
    grams = grams[order]
    first = np.flatnonzero(np.diff(grams, prepend=-1))
    return grams[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


class GramCounts:
    """The different grams of a block with their occurrences in training rows."""

    def __init__(self):
        self.pieces, self.waiting, self.most = [], 0, 1 << 20

    def add(self, grams: np.ndarray, train: np.ndarray) -> None:
        known, n = np.unique(grams[train], return_counts=True)
        asked = np.unique(grams[~train])
        self.pieces += [(known, n), (asked, np.zeros(len(asked), np.int64))]
        self.waiting += len(known) + len(asked)
        if self.waiting > self.most:
            self.pieces = [self.result()]
            self.waiting = len(self.pieces[0][0])
            self.most = self.waiting + (1 << 20)

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        return summed(*(np.concatenate(x) for x in zip(*self.pieces, strict=True)))


def _packed(numbers: np.ndarray) -> bytes:
    """64-bit numbers with their bytes of equal weight side by side, which Spark's compression
    shortens."""
    return numbers.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view(np.int64).ravel()


def _pack_grams(grams: np.ndarray) -> bytes:
    return _packed(np.diff(grams, prepend=0))


def _unpack_grams(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(raw))


def _block_grams(depth: int, parts: int):
    """(block, part, grams, n): the different grams of each block, by the parts that own them."""
    rest = BITS * (depth - min(depth, LOW + 1) + 1)

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, GramCounts] = {}
        for piece in chunks(batches, "text"):
            symbols, offsets = symbols_of(piece.column("text"))
            grams = grams_of(symbols, offsets, depth)
            train = piece.column("train").to_numpy(zero_copy_only=False).astype(bool)
            block = piece.column("block").to_numpy(zero_copy_only=False)
            lengths = np.diff(offsets)
            for b in np.unique(block).tolist():
                here = np.repeat(block == b, lengths)
                seen.setdefault(b, GramCounts()).add(grams[here], np.repeat(train, lengths)[here])
        for b in list(seen):
            grams, n = seen.pop(b).result()
            part = (mix((grams >> rest).astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cut = np.flatnonzero(np.diff(part[order], prepend=-1)).tolist()
            for i, j in zip(cut, [*cut[1:], len(order)], strict=True):
                at = order[i:j]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int64()), pa.array([int(part[at[0]])], pa.int64()),
                     pa.array([_pack_grams(grams[at])], pa.binary()),
                     pa.array([_packed(n[at])], pa.binary())], ["block", "part", "grams", "n"])

    return run


class Low:
    """The trie's counts as the costs of grams need them."""

    def __init__(self, trie: Trie):
        self.child, self.first, self.counts = trie.child, trie.first, trie.counts
        self.total = [c.sum(axis=1) for c in trie.counts]
        self.kinds = [(c > 0).sum(axis=1) for c in trie.counts]
        self.shorter = [np.zeros(1, np.int64)]
        for d in range(1, len(trie.counts)):
            above = trie.counts[d - 1][trie.parent[d] - trie.first[d - 1]]
            self.shorter.append(np.where(trie.counts[d] > 0, above, 0).sum(axis=1))

    def depth(self, d: int, grams: np.ndarray, depth: int) -> list[np.ndarray]:
        """Of the contexts of ``d`` bytes: n of the symbol, N, T and E."""
        if d >= len(self.counts):
            return [np.zeros(len(grams), np.int64)] * 4
        node = np.full(len(grams), ROOT, np.int64)
        for k in range(d):
            node = self.child[node, (grams >> (BITS * (depth - k))) & (2**BITS - 1)]
        at = node - self.first[d]
        known, at = node != DEAD, np.maximum(at, 0)
        return [np.where(known, x, 0) for x in
                (self.counts[d][at, grams & (2**BITS - 1)], self.total[d][at], self.kinds[d][at],
                 self.shorter[d][at])]


def gram_costs(low: Low, grams: np.ndarray, n: np.ndarray, depth: int) -> np.ndarray:
    """log10 probability of each of the different ``grams`` seen ``n`` times; with any of them
    there must be all others whose context has the same LOW + 1 nearest bytes."""
    symbol = grams & (2**BITS - 1)
    found = [low.depth(d, grams, depth) for d in range(min(depth, LOW) + 1)]
    for d in range(len(found), depth + 1):
        key, first, of = np.unique(grams >> (BITS * (depth - d + 1)) << BITS | symbol,
                                   return_index=True, return_inverse=True)
        count = np.bincount(of, n, len(key)).astype(np.int64)
        context = np.cumsum(np.diff(key >> BITS, prepend=-1) != 0) - 1
        above = np.where(count > 0, found[d - 1][0][first], 0)
        total, kinds, shorter = (np.bincount(context, x).astype(np.int64)
                                 for x in (count, count > 0, above))
        at = context[of]
        found.append([count[of], total[at], kinds[at], shorter[at]])
    cost = np.zeros(len(grams))
    searching = np.ones(len(grams), bool)
    left_out, spent = 0, 0  # of the context one byte longer: its T and E
    for own, total, kinds, shorter in reversed(found):
        more = kinds - left_out
        norm = np.log10(np.maximum(total - spent + more, 1))
        here = searching & (own > 0)
        cost[here] += (np.log10(np.maximum(own, 1)) - norm)[here]
        searching &= ~here
        escape = searching & (more > 0)
        cost[escape] += (np.log10(np.maximum(more, 1)) - norm)[escape]
        left_out, spent = kinds, shorter
    return np.where(searching, cost - np.log10(np.maximum(SYMBOLS - left_out, 1)), cost)


def _answer(low: Low, depth: int, asked: pa.Table) -> pa.Table:
    """The costs of the grams that the blocks sent to a part."""
    sent = [_unpack_grams(g) for g in asked["grams"].to_pylist()]
    grams, n = summed(np.concatenate(sent),
                      np.concatenate([_unpacked(x) for x in asked["n"].to_pylist()]))
    cost = gram_costs(low, grams, n, depth).astype(np.float32)
    return pa.table({
        "block": asked["block"], "grams": asked["grams"],
        "costs": pa.array([cost[np.searchsorted(grams, g)].tobytes() for g in sent], pa.binary())})


def _tokens(text: bytes) -> list[bytes]:
    """Words, and the end, which no word equals."""
    return [*text.lower().split(), b""]


@frugal
def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, word, n): each word of each block once, with its occurrences in training rows."""
    seen: dict[int, Counter] = {}
    for part in chunks(batches, "text"):
        for block, train, text in zip(part.column("block").to_pylist(),
                                      part.column("train").to_pylist(),
                                      texts(part.column("text")), strict=True):
            words = seen.setdefault(block, Counter())
            if train:
                words.update(_tokens(text))
            else:
                words.update(dict.fromkeys(_tokens(text), 0))
    for block, words in seen.items():
        names = list(words)
        for a in range(0, len(names), 100_000):
            some = names[a:a + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(some), pa.int64()), pa.array(some, pa.binary()),
                 pa.array([words[w] for w in some], pa.int64())], ["block", "word", "n"])


def gram_scores(docs: pa.Table, costs: pa.Table, depth: int) -> np.ndarray:
    """The score of every row, given the costs of the block's grams."""
    if docs.num_rows == 0:
        return np.zeros(0)
    grams = np.concatenate([_unpack_grams(g.as_py()) for g in costs["grams"]])
    order = np.argsort(grams)
    grams = grams[order]
    cost = np.concatenate([np.frombuffer(c.as_py(), np.float32) for c in costs["costs"]])[order]
    del order
    out = []
    for part in chunks(iter(docs.to_batches()), "text"):
        symbols, offsets = symbols_of(part.column("text"))
        asked, of = np.unique(grams_of(symbols, offsets, depth), return_inverse=True)
        out.append(row_sums(cost[np.searchsorted(grams, asked)][of], offsets))
    return np.concatenate(out)


def word_scores(docs: pa.Table, count: dict[bytes, int]) -> list[np.ndarray]:
    """Of every row: tokens, known tokens, and the sum of log10(count + 1)."""
    out = []
    for part in chunks(iter(docs.to_batches()), "text"):
        split = [_tokens(t) for t in texts(part.column("text"))]
        n_tokens = np.array([len(w) for w in split], np.int64)
        c = np.array([count[w] for words in split for w in words], np.int64)
        offsets = np.concatenate([[0], np.cumsum(n_tokens)])
        out.append((n_tokens, row_sums(c > 0, offsets).astype(np.int64),
                    row_sums(np.log10(c + 1.0), offsets)))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else \
        [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def block_scores(depth: int):
    """Scores the rows of a block, given the counts of its words and the costs of its grams."""
    @frugal
    def run(docs: pa.Table, facts: pa.Table) -> pa.Table:
        is_word = pc.is_valid(facts["word"])
        words = facts.filter(is_word)
        n_tokens, n_known, log_counts = word_scores(
            docs, dict(zip(words["word"].to_pylist(), words["total"].to_pylist(), strict=True)))
        rows = docs.num_rows
        tokens, kinds = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        if rows:  # what the block adds to the corpus totals, on its first row
            tokens[0] = np.sum(words["n"].to_numpy())
            kinds[0] = np.sum(words["first"].to_numpy(zero_copy_only=False)
                              & (words["total"].to_numpy() > 0))
        del words
        give_back()
        return pa.table({
            "id": docs["id"], "train": docs["train"], "n_tokens": n_tokens, "n_known": n_known,
            "log_counts": log_counts,
            "score": gram_scores(docs, facts.filter(pc.invert(is_word)), depth),
            "block_tokens": tokens, "block_kinds": kinds})

    return run


def block_names(rows: DataFrame, blocks: int) -> list[int]:
    """``blocks`` numbers that Spark's hash partitioning puts into as many different partitions, so
    that no task is dealt two blocks (or none)."""
    found: dict[int, int] = {}
    upto = 0
    while len(found) < blocks:
        begin, upto = upto, 2 * upto + 16 * blocks
        part = F.pmod(F.hash("id"), F.lit(blocks))
        for r in rows.sparkSession.range(begin, upto).groupBy(part.alias("part")).agg(
                F.min("id").alias("name")).collect():
            found.setdefault(r.part, r.name)
    return [found[p] for p in range(blocks)]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row of ``docs`` with its scores, learned from the rows whose id is not held out
    (crc32 of the id as text, 2 modulo 7).

    Returns id (named ``id_col``), held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10 probability of the text under the contexts of up to ``depth`` bytes, 1 to 6). Null
    and empty texts are one end token; null ids count as the empty text; repeated rows stay and
    count; without training rows all symbols are alike; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"),
                       training_rows(id_col, 7, 2).alias("train"))
    low = spark.sparkContext.broadcast(Low(fit(rows.where("train"), min(depth, LOW))))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    names = F.lit(block_names(rows, blocks)).cast("array<bigint>")
    place = F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int")
    blocked = rows.withColumn("block", F.get(names, place)).repartition(blocks, "block")
    # each word stands in a block once, so a frequent word has one row a block here
    words = blocked.mapInArrow(_block_words, "block bigint, word binary, n bigint").selectExpr(
        "block", "word", "n",
        """sum(n) over (partition by word order by block
           rows between unbounded preceding and unbounded following) as total""",
        "row_number() over (partition by word order by block) = 1 as first")

    @frugal
    def answer(asked: pa.Table) -> pa.Table:
        return _answer(low.value, depth, asked)

    costs = blocked.mapInArrow(_block_grams(depth, 2 * blocks),
                               "block bigint, part bigint, grams binary, n binary") \
        .groupBy("part").applyInArrow(answer, "block bigint, grams binary, costs binary")
    facts = words.unionByName(costs, allowMissingColumns=True)
    id_type = rows.schema["id"].dataType.simpleString()
    scored = blocked.groupBy("block").cogroup(facts.groupBy("block")).applyInArrow(
        block_scores(depth), f"id {id_type}, train boolean, n_tokens bigint, n_known bigint, log_counts double, "
        "score double, block_tokens bigint, block_kinds bigint")
    scored = materialise(scored, "lm-scores")
    sums = scored.agg(F.sum("block_tokens"), F.sum("block_kinds")).first()
    tokens, kinds = int(sums[0] or 0), int(sums[1] or 0)
    return scored.select(
        F.col("id").alias(id_col), (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.lit(float(np.log10(tokens + kinds + 1))))
        .alias("base_score"), "score")
