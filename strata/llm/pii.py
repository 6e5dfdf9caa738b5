"""Personal data by bootstrapped contextual extraction (operator 3, DataFrame functions only).

Seeds are the matches of four fixed forms (email, ip, card, phone). Each seed, and every other
token with a digit or ``@``, is an instance; the token before it is its cue, a lexical
pattern. The graph of cues and instances is scored in rounds:

* a cue's score is the confidence-weighted number of its instances over all occurrences of
  the cue in the corpus, and it counts only with ``SUPPORT`` different confident instances;
* a token that is no seed gets the mean score of its cues, weighted by occurrences;
* cues with a score of ``ACCEPT`` or more mark the tokens after them as personal data of
  kind ``other``, seen before or not.

The corpus is read twice: for seeds and candidates (few per text), and for cue frequencies
(combined before the shuffle). The graph holds counts per cue and token, not occurrences.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh_name, materialise

KINDS = ("email", "ip", "card", "phone", "other")
# Fixed forms. Possessive quantifiers and the look-behinds change no match (a match that could
# begin inside a run of the first class also begins at the run's start, or where the match
# before ended: \G); they keep the search linear on long runs. The card form is the longest
# chain of digits with single separators, of 14 to 19 digits.
FORMS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
CANDIDATE = r"(?<!\S)\S*[0-9@]\S*"
SUPPORT = 3
ACCEPT = 0.5
ROUNDS = 3
# elements of an array that are worked on at once, and code points of a text
PIECE, CUT = 256, 512


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also if a function inside uses it often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _appended(values: Column, zero: Column, combine) -> Column:
    """The running results of ``combine`` over a short array (each is appended to a copy)."""
    return F.aggregate(values, F.array().cast("array<int>"), lambda done, v: F.concat(
        done, F.array(combine(F.coalesce(F.get(done, F.size(done) - 1), zero), v))))


def _running(values: Column, zero: Column, combine, piece: int = PIECE) -> Column:
    """The running results of an associative ``combine`` over an array of int: pieces of ``piece``
    elements each alone, then every piece combined with the result of all before it. Appending
    copies, so an array of n takes n * piece + (n / piece)**2 steps, not n**2: in proportion to n
    up to some millions of elements."""
    def cut(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), F.lit(piece))
        return F.transform(starts, lambda i: _appended(F.slice(v, i + 1, F.lit(piece)), zero, combine))

    def joined(parts: Column) -> Column:
        whole = _appended(F.transform(parts, lambda p: F.element_at(p, -1)), zero, combine)
        return F.flatten(F.zip_with(parts, F.concat(F.array(zero), F.slice(
            whole, F.lit(1), F.size(whole) - 1)), lambda part, before: F.transform(
                part, lambda v: combine(before, v))))

    return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(
        _let(_let(values, cut), joined))


def _located(text: Column, form: str, present: Column) -> Column:
    """array<struct<start, stop, value, gap>> of the leftmost non-overlapping matches, in code
    points; gap is the text between the match before and this one."""
    kind = "array<struct<start:int,stop:int,value:string,gap:string>>"

    def placed(pairs: Column) -> Column:
        lengths = F.transform(pairs, lambda p: F.length(p["gap"]) + F.length(p["value"]))
        ends = _running(lengths, F.lit(0), lambda x, y: x + y)
        return F.zip_with(pairs, ends, lambda p, end: F.struct(
            (end - F.length(p["value"])).alias("start"), end.alias("stop"),
            p["value"].alias("value"), p["gap"].alias("gap")))

    values = F.regexp_extract_all(text, F.lit(form), F.lit(0))
    pairs = _let(values, lambda found: F.zip_with(
        F.slice(F.split(text, form, -1), F.lit(1), F.size(found)), found,
        lambda g, v: F.struct(g.alias("gap"), v.alias("value"))))
    return F.when(present, _let(pairs, placed)).otherwise(F.array().cast(kind))


def _luhn(digits: Column) -> Column:
    """The Luhn check of a string of digits."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))
    weighted = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).when(
        d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(weighted, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return {"email": F.lit(True),
            "ip": value.rlike(rf"\A{BYTE}(?:\.{BYTE}){{3}}\z"),
            "card": _luhn(digits),
            "phone": F.length(digits).between(10, 15)}[kind]


def _seeds(text: Column, has_digit: Column) -> Column:
    """array<struct<start, order, stop, kind>> of the valid matches of all forms."""
    present = {"email": text.contains("@"), "ip": has_digit & text.contains("."),
               "card": has_digit, "phone": text.contains("+")}
    each = []
    for order, (kind, form) in enumerate(FORMS.items()):
        each.append(_spans(_located(text, form, present[kind]), kind, order))
    return reduce(F.concat, each)


def _spans(matches: Column, kind: str, order: int) -> Column:
    good = F.filter(matches, lambda m: _valid(kind, m["value"]))
    return F.transform(good, lambda m: F.struct(
        m["start"].alias("start"), F.lit(order).alias("order"), m["stop"].alias("stop"),
        F.lit(kind).alias("kind")))


def _candidates(text: Column, present: Column, seeds: Column) -> Column:
    """array<struct<start, type, stop, cue, token, seed>>: tokens with a digit or @ and their cues;
    seed: the token overlaps one. Tokens and seeds are put in one order, in which the furthest end
    of the seeds before a token, and the nearest start of those after it, are running results."""
    def one(m: Column) -> Column:
        before = F.rtrim(F.translate(m["gap"], "\n\r\t\f", "    "))
        return F.struct(m["start"].alias("start"), F.lit(1).alias("type"), m["stop"].alias("stop"),
                        F.substring_index(before, " ", -1).alias("cue"), m["value"].alias("token"))

    def mark(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), F.lit(0).alias("type"), s["stop"].alias("stop"),
                        F.lit("").alias("cue"), F.lit("").alias("token"))

    def flagged(events: Column) -> Column:
        never = F.lit(-(2 ** 31 - 1))
        ends = F.transform(events, lambda e: F.when(e["type"] == 0, e["stop"]).otherwise(0))
        begins = F.transform(F.reverse(events), lambda e: F.when(e["type"] == 0, -e["start"]).otherwise(never))
        all_of = F.arrays_zip(events.alias("e"), _running(ends, F.lit(0), F.greatest).alias("b"),
                              F.reverse(_running(begins, never, F.greatest)).alias("a"))
        return F.transform(F.filter(all_of, lambda x: x["e"]["cue"] != ""), lambda x: x["e"].withField(
            "seed", (x["b"] > x["e"]["start"]) | (-x["a"] < x["e"]["stop"])))

    events = F.concat(F.transform(_located(text, CANDIDATE, present), one), F.transform(seeds, mark))
    return _let(F.array_sort(events), flagged)


def _accepted_cues(found: DataFrame, words: DataFrame) -> DataFrame:
    """Cues (column cue) whose instances are personal data, by iterative scoring."""
    edges = found.groupBy("cue", "token").agg(
        F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n"))
    hopeful = edges.groupBy("cue").agg(F.max("seed").alias("any")).where("any").select("cue")
    totals = words.groupBy("cue").agg(F.count(F.lit(1)).alias("total")) \
        .join(hopeful, "cue", "left_semi")
    edges = materialise(edges.join(totals, "cue"), "pii-graph")
    scores = edges.select("cue", "token", "n", "total", "seed",
                          F.col("seed").cast("double").alias("conf"))
    cues = None
    for _ in range(ROUNDS):
        cues = materialise(scores.groupBy("cue").agg(
            (F.sum(F.col("n") * F.col("conf")) / F.max("total")).alias("score"),
            F.count_if(F.col("conf") >= ACCEPT).alias("support"))
            .where(F.col("support") >= SUPPORT).select("cue", "score"), "pii-cues")
        means = edges.where(~F.col("seed")).join(cues, "cue", "left").groupBy("token").agg(
            (F.sum(F.col("n") * F.coalesce("score", F.lit(0.0))) / F.sum("n")).alias("mean"))
        scores = edges.join(means, "token", "left").select(
            "cue", "token", "n", "total", "seed",
            F.when(F.col("seed"), 1.0).otherwise(F.coalesce("mean", F.lit(0.0))).alias("conf"))
    return cues.where(F.col("score") >= ACCEPT).select("cue")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its personal data.

    Returns id (named ``id_col``), key (16 bytes, of the text), spans: array of struct<start,
    order, stop, kind> sorted by start, then kind (email, ip, card, phone, other), positions
    in code points. Spans of different kinds may overlap. Null and empty texts have none;
    repeated rows and copies get the same spans; other columns are not read.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    source = docs.select(docs[id_col].alias("id"), text.alias("text"))
    digit = F.col("text").rlike("[0-9]")
    both = _let(_seeds(F.col("text"), digit), lambda seeds: F.struct(
        seeds.alias("seeds"), _candidates(F.col("text"), digit | F.col("text").contains("@"), seeds)
        .alias("candidates")))
    read = source.select("id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("key"),
                         both.alias("found")).select("id", "key", "found.*")
    read = materialise(read, "pii-seeds")
    found = read.select("key", F.explode("candidates").alias("c")).select(
        "key", "c.cue", "c.token", "c.seed", "c.start", "c.stop").where(~F.col("cue").rlike("[0-9@]"))
    words = source.select(F.explode(F.split("text", r"[ \n\r\t\f]+")).alias("cue")) \
        .where(F.col("cue") != "")
    cues = _accepted_cues(found, words)
    more = found.where(~F.col("seed")).join(cues, "cue").groupBy("key").agg(F.collect_set(F.struct(
        F.col("start"), F.lit(KINDS.index("other")).alias("order"), F.col("stop"),
        F.lit("other").alias("kind"))).alias("more"))
    return read.join(more, "key", "left").select(
        F.col("id").alias(id_col), "key",
        F.array_sort(F.when(F.col("more").isNull(), F.col("seeds"))
                     .otherwise(F.concat("seeds", "more"))).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:stop`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span written as its kind in angle brackets; of overlapping spans the
    first stands for the part it covers. The text is cut into pieces once, and each part between
    spans is taken from the pieces it lies in, so that long texts with many spans take time in
    proportion to both."""
    def part(pieces: Column, start: Column, stop: Column) -> Column:
        first = F.floor(start / CUT).cast("int")
        count = F.floor((stop - 1) / CUT).cast("int") - first + 1
        there = F.array_join(F.slice(pieces, first + 1, count), "")
        return F.when(stop > start, there.substr(start - first * CUT + 1, stop - start)).otherwise(F.lit(""))

    def written(pieces: Column, upto: Column) -> Column:
        def one(span: Column, i: Column) -> Column:
            at = F.coalesce(F.get(upto, i - 1), F.lit(0))
            mark = F.when(span["start"] >= at, F.concat(F.lit("<"), span["kind"], F.lit(">")))
            return F.concat(part(pieces, at, span["start"]), F.coalesce(mark, F.lit("")))
        rest = part(pieces, F.element_at(upto, -1), F.length(text))
        return F.concat(F.array_join(F.transform(spans, one), ""), rest)

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    stops = _running(F.transform(spans, lambda s: s["stop"]), F.lit(0), F.greatest)
    return F.when(F.size(spans) == 0, text).otherwise(
        _let(cut, lambda pieces: _let(stops, lambda upto: written(pieces, upto))))


def without_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          length_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs``, with all their columns; personal data is redacted, and the text's
    length in ``length_col`` (if there is such a column) follows."""
    key_name, spans_name = (fresh_name(n, docs.columns) for n in ("__key", "__spans"))
    found = find_personal_data(docs, id_col, text_col).where(F.size("spans") > 0) \
        .groupBy(F.col("key").alias(key_name)).agg(F.first("spans").alias(spans_name))
    key = F.unhex(F.md5(F.coalesce(docs[text_col], F.lit("")).cast("binary")))
    spans = F.col(spans_name)
    out = docs.join(found, key == found[key_name], "left").withColumn(
        text_col, F.when(spans.isNull(), F.col(text_col)).otherwise(redact(F.col(text_col), spans)))
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.when(spans.isNull(), F.col(length_col))
                             .otherwise(F.length(text_col).cast(docs.schema[length_col].dataType)))
    return out.select(*docs.columns)
