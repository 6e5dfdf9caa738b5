"""Benchmark decontamination by winnowing (operator 9, DataFrame functions only).

Words: A-Z lower-cased, then runs of ASCII letters, digits and non-ASCII characters. A
window is ``SPAN`` consecutive words of a benchmark item, or a whole shorter item.

1. Fingerprints: a text's ``GRAM``-word hashes, of which the least in every sliding window of
   ``SPAN - GRAM + 1`` is kept. Two texts that share a span of SPAN words keep the same
   fingerprint for it, so joining the fingerprints of documents and items finds every text
   with a hit (and some without). Whole shorter items are matched by hashes of their length.
   All hashes are combined from neighbours by doubling, so each costs a few array passes.
2. Extension: in the texts found, every window is compared with the items' windows by two
   independent 64-bit hashes; the words they cover are the hits.

Texts are worked on once however many documents carry them. Of the corpus only fingerprints
travel, and the texts that share one with the benchmark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise

SPAN = 10
GRAM = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text (null: none)."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, SEPARATORS, -1), "")


def _neighbours(a: Column, b: Column, shift: int, combine) -> Column:
    """combine(a[i], b[i + shift]) for every i for which both exist."""
    n = F.greatest(F.least(F.size(a), F.size(b) - shift), F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(shift + 1), n), combine)


def _with_grams(df: DataFrame, base: str, lengths: list[int], prefix: str) -> DataFrame:
    """Columns prefix1, prefix2, prefix4, ... and prefix{L} for L in ``lengths``: hashes of L
    consecutive words, each from two shorter ones. A column each, so none is computed twice."""
    have = {1: base}
    for length in sorted(lengths):
        done = 0
        power = 1
        parts = []
        while power <= length:
            if power not in have:
                half = have[power // 2]
                name = f"{prefix}{power}"
                df = df.withColumn(name, _neighbours(F.col(half), F.col(half), power // 2,
                                                     lambda x, y: F.xxhash64(x, y)))
                have[power] = name
            power *= 2
        for p in sorted((p for p in have if p & (p - 1) == 0), reverse=True):
            if done + p <= length and length & p:
                parts.append((p, done))
                done += p
        name, at = have[parts[0][0]], parts[0][0]
        for p, shift in parts[1:]:
            reach = f"{prefix}{at + p}"
            if at + p not in have:
                df = df.withColumn(reach, _neighbours(F.col(name), F.col(have[p]), shift,
                                                      lambda x, y: F.xxhash64(x, y)))
                have[at + p] = reach
            name, at = have[at + p], at + p
    return df


def _tagged(hashes: Column, length: int) -> Column:
    return F.transform(hashes, lambda h: F.xxhash64(F.lit(length), h))


def _placed(a: Column, b: Column, length: int) -> Column:
    return F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x, i: F.struct(
        i.alias("place"), F.lit(length).alias("length"), x["a"].alias("a"), x["b"].alias("b")))


def _with_fingerprints(df: DataFrame, short: list[int]) -> DataFrame:
    """Column fps: the distinct fingerprints of column words, for spans of SPAN words and for
    whole items of the lengths in ``short``."""
    df = df.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
    df = _with_grams(df, "h1", [*short, GRAM], "h")
    kept, width, name = f"h{GRAM}", 1, f"h{GRAM}"
    goal = SPAN - GRAM + 1
    while width < goal:
        step = min(width, goal - width)
        name = f"least{width + step}"
        df = df.withColumn(name, _neighbours(F.col(kept), F.col(kept), step,
                                             lambda x, y: F.least(x, y)))
        kept, width = name, width + step
    sets = [F.array_distinct(F.col(kept))]
    sets += [_tagged(F.array_distinct(F.col(f"h{n}")), n) for n in short]
    return df.withColumn("fps", F.concat(*sets) if len(sets) > 1 else sets[0])


def _exploded(df: DataFrame, keep: list[str], array: Column, name: str) -> DataFrame:
    """One row per element. Plain ``explode`` would let Spark filter by the array's size below
    the projections that build it, with each of their expressions copied into the next; the
    outer form and a filter on its output avoid that."""
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def _windows(df: DataFrame, keep: list[str], lengths: list[int]) -> DataFrame:
    """One row per window: ``keep``, place, length and its two hashes."""
    df = df.withColumn("a1", F.transform("words", lambda w: F.xxhash64(w))) \
        .withColumn("b1", F.transform("words", lambda w: F.xxhash64(F.lit(77), w)))
    df = _with_grams(_with_grams(df, "a1", lengths, "a"), "b1", lengths, "b")
    each = [_placed(F.col(f"a{n}"), F.col(f"b{n}"), n) for n in lengths]
    windows = F.concat(*each) if len(each) > 1 else each[0]
    return _exploded(df, keep, windows, "w").select(*keep, "w.*")


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its benchmark hits.

    Returns id (named ``id_col``), key (16 bytes, of the text), n_words, n_hit, n_items, items (sorted item ids as text),
    hits (array of struct<place, stop>: the word ranges of hit windows), contaminated.
    Null and empty texts have no words; null item ids are not listed, but their windows count
    as hits; equal items all count; repeated rows stay; other columns are not read.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             words_of(F.col(item_text_col)).alias("words")) \
        .where(F.size("words") > 0)
    # lengths of items below SPAN: nine numbers at most
    short = sorted(r[0] for r in items.where(F.size("words") < SPAN)
                   .select(F.size("words")).distinct().collect())
    item_windows = _windows(items, ["item", "words"], [*short, SPAN]).where(
        F.col("length") == F.least(F.size("words"), F.lit(SPAN))) \
        .groupBy("length", "a", "b").agg(F.collect_set("item").alias("items"))
    item_fps = _with_fingerprints(items, short)
    item_fps = _exploded(item_fps, [], F.col("fps"), "fp").distinct()

    text = F.coalesce(F.col("text"), F.lit(""))
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")) \
        .withColumn("key", F.unhex(F.md5(text.cast("binary"))))
    prints = _with_fingerprints(source.withColumn("words", words_of(F.col("text"))), short) \
        .select("id", "key", F.size("words").cast("bigint").alias("n_words"), "fps")
    prints = materialise(prints, "winnowed")
    found = prints.select("key", F.explode("fps").alias("fp")) \
        .join(item_fps, "fp", "left_semi").select("key").distinct()
    found = materialise(found, "winnow-hits")

    once = source.join(found, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    doc_windows = _windows(once.withColumn("words", words_of(F.col("text"))), ["key"],
                           [*short, SPAN])
    hit = doc_windows.join(item_windows, ["length", "a", "b"]).groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct(F.col("place"),
                                            (F.col("place") + F.col("length")).alias("stop"))))
        .alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    covered = F.expr("""aggregate(hits, named_struct('upto', 0, 'n', 0),
        (s, x) -> named_struct('upto', greatest(s.upto, x.stop),
                               'n', s.n + greatest(x.stop - greatest(s.upto, x.place), 0)), s -> s.n)""")
    hit = hit.select("key", "hits", "items", covered.cast("bigint").alias("n_hit"))
    out = prints.select("id", "key", "n_words").join(hit, "key", "left")
    none = F.array().cast("array<string>")
    return out.select(
        F.col("id").alias(id_col), "key", "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("bigint").alias("n_items"),
        F.coalesce("items", none).alias("items"), F.col("hits"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def text_key(text: Column) -> Column:
    """The key that find_contamination gives a text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                      **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text has no benchmark hit."""
    found = find_contamination(docs, benchmark, text_col=text_col, **options)
    bad = found.where("contaminated").select(F.col("key").alias("bad_key")).distinct()
    return docs.join(bad, text_key(docs[text_col]) == bad["bad_key"], "left_anti")
