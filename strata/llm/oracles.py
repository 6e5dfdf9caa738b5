"""DuckDB SQL for the rows of op11, op12 and op13."""

from __future__ import annotations

from strata.llm import licenses

WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op11_sql() -> str:
    known = [*licenses.PHRASES, *licenses.NOTICES]
    values = ",\n    ".join(f"({i}, {_quoted(t.label)}, {t.whole}, {_quoted(t.text)})"
                            for i, t in enumerate(known))
    gram = licenses.GRAM
    return f"""
WITH t AS (
  SELECT template, label, whole, {WORDS} AS w
  FROM (VALUES {values}) AS v(template, label, whole, text)),
tq AS (SELECT template, q, array_to_string(w[q + 1 : q + {gram}], ' ') AS g
  FROM (SELECT template, w, unnest(range(0, len(w) - {gram - 1})) AS q FROM t)),
d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
dp AS (SELECT r, p, array_to_string(w[p + 1 : p + {gram}], ' ') AS g
  FROM (SELECT r, w, unnest(range(0, len(w) - {gram - 1})) AS p FROM d WHERE len(w) >= {gram})),
votes AS (
  SELECT r, template, p - q AS diagonal, min(p) AS a, max(p) AS b, list(q) AS qs
  FROM dp JOIN tq USING (g) GROUP BY ALL),
exact AS (
  SELECT r, count(*) AS n, min(diagonal) AS a, max(diagonal) AS b,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, list(DISTINCT label) AS each
  FROM votes JOIN t USING (template) WHERE whole AND len(qs) = len(w) - {gram - 1} GROUP BY r),
opened AS (
  SELECT votes.*, CASE WHEN diagonal - lag(diagonal) OVER (along) <= {licenses.SLACK}
      AND a - max(b) OVER (PARTITION BY r, template ORDER BY diagonal, a
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {licenses.REACH} THEN 0 ELSE 1 END AS opens
  FROM votes JOIN t USING (template) WHERE NOT whole
  WINDOW along AS (PARTITION BY r, template ORDER BY diagonal, a)),
islands AS (
  SELECT *, sum(opens) OVER (PARTITION BY r, template ORDER BY diagonal, a) AS island FROM opened),
ends AS (
  SELECT r, template, island, max(b) + {gram} - min(a) AS length FROM islands GROUP BY ALL),
covered AS (
  SELECT r, template, island, count(DISTINCT word) AS n
  FROM (SELECT r, template, island, unnest(range(q, q + {gram})) AS word
        FROM (SELECT r, template, island, unnest(qs) AS q FROM islands)) GROUP BY ALL),
near AS (
  SELECT r, max(n / len(w)) AS best,
    list(DISTINCT label) FILTER (WHERE n / len(w) >= {licenses.SHARE} AND length <= 2 * len(w)) AS each
  FROM ends JOIN covered USING (r, template, island) JOIN t USING (template) GROUP BY r)
SELECT doc_id, len(d.w)::BIGINT AS n_words, coalesce(exact.n, 0)::BIGINT AS n_base,
  exact.a::BIGINT AS first_word, exact.b::BIGINT AS last_word, coalesce(exact.labels, '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(exact.each, []), coalesce(near.each, [])))),
    ',') AS labels,
  (CASE WHEN exact.n > 0 THEN 1 ELSE coalesce(near.best, 0) END)::DOUBLE AS score
FROM d LEFT JOIN exact USING (r) LEFT JOIN near USING (r)
"""


def op12_sql(clusters: int = 40, rounds: int = 5, dims: int = 64) -> str:
    steps = [f"""
kept AS (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {dims}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v
  FROM kept QUALIFY c < {clusters})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, vec_id, kept.v AS v, c,
    list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
  FROM kept, c{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (
  SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS v
  FROM (SELECT c, j, sum(x)::BIGINT AS s, count(*) AS n
        FROM (SELECT c, unnest(v) AS x, unnest(range({dims})) AS j FROM a{i}) GROUP BY c, j) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c{i}.c AS c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))""")
    return "WITH " + ",".join(steps) + f"""
SELECT vec_id, c::INTEGER AS cluster, d AS distance,
  (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)
"""


# crc32 by half bytes, least first; the list is the checksum's fixed table of 16 entries
CRC32 = """xor(4294967295, list_reduce(list_transform(range(2 * octet_length(encode(f))),
    lambda i: instr('123456789ABCDEF', hex(encode(f))[xor(i, 1) + 1])::BIGINT),
    lambda c, n: xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444,
      1303535960, 1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920,
      2262029012, 2685067896, 3183342108][(xor(c, n) & 15) + 1]), 4294967295::BIGINT))"""

OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
i AS (SELECT {WORDS} AS w FROM benchmark),
df AS (
  SELECT r, array_to_string(w[p : p + n - 1], ' ') AS f
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM d, (VALUES (1), (2), (3)) AS v(n) WHERE len(w) >= n)),
tf AS (
  SELECT array_to_string(w[p : p + n - 1], ' ') AS f
  FROM (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM i, (VALUES (1), (2), (3)) AS v(n) WHERE len(w) >= n)),
hashed AS MATERIALIZED (
  SELECT f, ({CRC32}) % 10000 AS bucket
  FROM (SELECT f FROM df UNION SELECT f FROM tf)),
s AS (SELECT bucket, count(*) AS n FROM df JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM tf JOIN hashed USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * (ss + 10000)::DOUBLE)
    / ((coalesce(s.n, 0) + 1)::DOUBLE * (tt + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT DISTINCT bucket FROM hashed) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket),
    (SELECT coalesce(sum(n), 0) AS ss FROM s), (SELECT coalesce(sum(n), 0) AS tt FROM t)),
weights AS (
  SELECT r, count(*) AS n, sum(gain) AS weight
  FROM df JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT doc_id, len(w) >= 20 AS eligible, coalesce(n, 0)::BIGINT AS n_features,
    coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM (SELECT *, ('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d)
    LEFT JOIN weights USING (r)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id) AS k,
    count(*) OVER (PARTITION BY eligible) AS n FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN eligible AND k <= 5 * n // 100 THEN k::BIGINT END AS rank
FROM placed
"""
