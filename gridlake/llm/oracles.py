"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from .licences import KNOWN

#: \x20 and \x09 to \x0D, in the regular expressions of DuckDB.
BLANK = r"[\x20\x09-\x0D]+"

OP7 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, list_filter(regexp_split_to_array(text, '{BLANK}'), lambda x: x <> '') AS w,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM docs),
windows AS (
  SELECT r, i, list_aggregate(w[i:i+4], 'string_agg', ' ') AS k FROM words, unnest(range(1, len(w) - 3)) AS t(i)),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + d) AS n FROM repeated, range(0, 5) AS s(d) GROUP BY r),
counts AS (
  SELECT d.r, doc_id, text, len(w)::BIGINT AS n_words, len(regexp_replace(text, '{BLANK}', '', 'g'))::BIGINT AS word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM docs d JOIN words USING (r) LEFT JOIN covered c USING (r)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         len(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) AS letters, len(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS capitals FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (
         n_symbols > 0.1 * n_words
         OR coalesce(capitals / nullif(letters, 0), 0) > 0.3
         OR coalesce(n_dup_lines / nullif(n_lines, 0), 0) > 0.3
         OR coalesce(letters / nullif(word_chars, 0), 0) < 0.6
         OR coalesce(word_chars / nullif(n_words, 0), 0) > 20.0) AS kept
FROM judged
"""

OP10 = r"""
WITH texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id::VARCHAR AS id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), item_id::VARCHAR, coalesce(text, '') FROM benchmark),
words AS (
  SELECT side, r, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
item_windows AS (
  SELECT DISTINCT id AS item, least(len(w), 10) AS size, list_aggregate(w[i:i + least(len(w), 10) - 1], 'string_agg', ' ') AS k
  FROM words, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS t(i) WHERE side = 'b'),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT r, i, size, list_aggregate(w[i:i + size - 1], 'string_agg', ' ') AS k
  FROM words, sizes, unnest(range(1, greatest(len(w) - size, -1) + 2)) AS t(i) WHERE side = 'd'),
found AS (SELECT r, i, d.size, item FROM doc_windows d JOIN item_windows USING (size, k)),
hit AS (SELECT r, count(DISTINCT i + s) AS n FROM (SELECT DISTINCT r, i, size FROM found), unnest(range(0, size)) AS t(s) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
       sha256(coalesce(i.names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) d JOIN (SELECT * FROM words WHERE side = 'd') USING (r)
LEFT JOIN hit h USING (r) LEFT JOIN items i USING (r)
"""


def _canonical(text: str) -> str:
    """The canonical lines of a text, spelled out for this engine."""
    out = rf"regexp_replace(lower({text}), '(?m)^[^\p{{L}}\p{{N}}\n(©]*(?:copyright|\(c\)|©|all rights reserved)[^\n]*$', '', 'g')"
    swaps = [
        ("licenc", "licens"),
        (r"\bsub-licens", "sublicens"),
        (r"\borganisation", "organization"),
        (r"\bauthoris", "authoriz"),
        (r"\bfavour", "favor"),
        (r"\bnon-?commercial\b", "noncommercial"),
        (r"\bper cent\b", "percent"),
        (r"\bcopyright owner", "copyright holder"),
        (r"\bhttps://", "http://"),
    ]
    for found, kept in swaps:
        out = f"regexp_replace({out}, '{found}', '{kept}', 'g')"
    out = rf"regexp_replace({out}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    out = f"regexp_replace({out}, '(?m)^ | $', '', 'g')"
    return rf"regexp_replace({out}, '^\n+|\n+$', '', 'g')"


_quoted = ", ".join("('{}', '{}')".format(a, b.replace("'", "''").replace("\n", "' || chr(10) || '")) for a, b in KNOWN)

OP2 = rf"""
WITH known_texts(licence, text) AS (VALUES {_quoted}),
known AS (SELECT min(licence) AS licence, k FROM (SELECT licence, regexp_replace({_canonical("text")}, '\n+', ' ', 'g') AS k FROM known_texts) WHERE k <> '' GROUP BY k),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_canonical("coalesce(text, '')")} AS text FROM documents),
cut AS (SELECT *, regexp_split_to_array(text, '\n\n+') AS blocks, string_split(text, chr(10)) AS lines FROM docs),
units AS (
  SELECT r, 'text' AS unit, regexp_replace(text, '\n+', ' ', 'g') AS k FROM cut
  UNION ALL SELECT r, 'block', regexp_replace(unnest(blocks), '\n+', ' ', 'g') FROM cut WHERE len(blocks) > 1
  UNION ALL SELECT r, 'line', unnest(lines) FROM cut WHERE len(lines) > 1),
per AS (
  SELECT r, max(licence) FILTER (WHERE unit = 'text') AS whole_licence,
         string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences, count(*) AS n_matches FROM units JOIN known USING (k) GROUP BY r)
SELECT doc_id, whole_licence, coalesce(licences, '') AS licences, coalesce(n_matches, 0)::BIGINT AS n_matches
FROM docs LEFT JOIN per USING (r)
"""

def _round(i: int) -> str:
    """All distances of a round, and the entries after it."""
    return f"""
a{i} AS (SELECT r, p, min(d * 64 + k) AS best FROM (
  SELECT r, q.p, k, list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM parts q JOIN b{i} ON q.p = b{i}.p) GROUP BY r, p),
m{i} AS (SELECT p, k, list(m ORDER BY j) AS e FROM (
  SELECT q.p, best % 64 AS k, j, floor(sum(x[j])::DOUBLE / count(*))::BIGINT AS m FROM parts q JOIN a{i} USING (r, p), unnest(range(1, len(x) + 1)) AS t(j) GROUP BY 1, 2, 3) GROUP BY p, k),
b{i + 1} AS (SELECT p, k, coalesce(m{i}.e, b{i}.e) AS e FROM b{i} LEFT JOIN m{i} USING (p, k))"""


OP11 = f"""
WITH sound AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
kept AS (SELECT * FROM sound WHERE len(v) = (SELECT len(v) FROM sound WHERE len(v) % 16 = 0 ORDER BY r LIMIT 1)),
parts AS (SELECT r, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x FROM kept, range(16) AS t(p)),
b0 AS (SELECT p, dense_rank() OVER (ORDER BY r) - 1 AS k, x AS e FROM parts WHERE r IN (SELECT r FROM kept ORDER BY r LIMIT 64)),
{",".join(_round(i) for i in range(2))},
{_round(2).split("m2 AS")[0].rstrip().rstrip(",")},
coded AS (SELECT r, string_agg(format('{{:02x}}', best % 64), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error FROM a2 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, k)) FROM b2) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""

ORACLE_SQL = {"op2_licence_digests": OP2, "op7_quality_cascade": OP7, "op10_suffix_decontamination": OP10, "op11_vector_codes": OP11}
