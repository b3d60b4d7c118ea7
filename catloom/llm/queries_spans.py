"""Queries of licence scans, vector codes and collocations, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catloom.llm import licenses
from catloom.llm.common import LOWER, UPPER, table
from catloom.llm.registry import query

PHRASES = (
    licenses.Template("mit", "under the mit license"),
    licenses.Template("apache-2", "apache license version 2"),
    licenses.Template("cc-by-nc", "cc by nc"),
)


def _template_values() -> str:
    rows = []
    for i, t in enumerate((*PHRASES, *licenses.NOTICES)):
        words = t.text.split()
        telling = [n for n, w in enumerate(words) if w in t.telling.split()]
        rows.append(f"({i}, '{t.label}', {words}, {telling}::BIGINT[], {i < len(PHRASES)})")
    return ", ".join(rows)


LICENSE_SQL = f"""
WITH templates(template, label, tw, telling, whole) AS (VALUES {_template_values()}),
words AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
places AS (SELECT r, w, unnest(range(len(w) - 2)) AS p FROM words WHERE len(w) > 2),
grams AS (SELECT r, p, array_to_string(w[p + 1 : p + 3], ' ') AS gram FROM places),
known AS (SELECT *, array_to_string(tw[t + 1 : t + 3], ' ') AS gram FROM (SELECT *, unnest(range(len(tw) - 2)) AS t FROM templates)),
hits AS (SELECT DISTINCT r, template, p - t AS d, t FROM grams JOIN known USING (gram)),
diagonals AS (SELECT DISTINCT r, template, d FROM hits),
covered AS (SELECT a.r, a.template, a.d, array_agg(DISTINCT b.t + o) AS c FROM diagonals a JOIN templates USING (template)
  JOIN hits b ON a.r = b.r AND a.template = b.template AND b.d >= a.d AND b.d <= a.d + CASE WHEN whole THEN 0 ELSE {licenses.NEAR} END,
  (VALUES (0), (1), (2)) AS offsets(o) GROUP BY ALL),
spans AS (SELECT r, d, label, whole, len(c) / len(tw) AS share,
    CASE WHEN whole THEN len(c) = len(tw) ELSE len(c) / len(tw) >= {licenses.COVER} AND list_has_all(c, telling) END AS accepted
  FROM covered JOIN templates USING (template)),
found AS (SELECT r, count(*) FILTER (whole AND accepted) AS n_base, min(d) FILTER (whole AND accepted) AS first_word,
    max(d) FILTER (whole AND accepted) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole AND accepted) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (accepted) AS labels, max(share) AS score FROM spans GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM words LEFT JOIN found USING (r)
"""


def _round_sql(n: int) -> str:
    """Codebooks after one more round, from ``book{n}`` to ``book{n + 1}``."""
    return f"""
near{n} AS (SELECT r, p, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM (SELECT r, p, e,
    list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM cut JOIN book{n} USING (p)) GROUP BY r, p),
sums{n} AS (SELECT p, e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m FROM near{n} JOIN cut USING (r, p), range(1, 5) AS s(i) GROUP BY ALL),
moved{n} AS (SELECT p, e, list(m ORDER BY i) AS c FROM sums{n} GROUP BY ALL),
book{n + 1} AS (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{n} b LEFT JOIN moved{n} m USING (p, e)),"""


CODES_SQL = f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (SELECT r, p, v[4 * p + 1 : 4 * p + 4] AS x FROM kept, range(16) AS s(p)),
book0 AS (SELECT p, r AS e, x AS c FROM cut WHERE r < 64),{_round_sql(0)}{_round_sql(1)}{_round_sql(2)}
coded AS (SELECT vec_id, label, r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near2 JOIN kept USING (r) GROUP BY ALL)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256 FROM coded
"""

PHRASE_SQL = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, range(1, 5) AS s(m)),
grams AS (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS a FROM starts GROUP BY ALL HAVING count(*) >= 30),
parts AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE m > 1),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM parts),
scores AS (SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, CAST(2000000::HUGEINT * c.a // (x.a + y.a) AS BIGINT) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : k], ' ')
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1 :], ' ')),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scores),
sizes AS (SELECT *, unnest(range(2, m)) AS size FROM parts WHERE m > 2),
inner_at AS (SELECT *, unnest(range(1, m - size + 2)) AS i FROM sizes),
inside AS (SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, max(a) AS most FROM inner_at GROUP BY ALL),
kept AS (SELECT l.* FROM lowest l LEFT JOIN inside i ON i.lang = l.lang AND i.phrase = l.phrase
  WHERE place = 1 AND (most IS NULL OR 100 * most < 80 * l.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op11_license_diagonals", LICENSE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), PHRASES)


@query("op12_slice_intersect_codes", CODES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catloom.llm.codes import compressed_with_errors

    return compressed_with_errors(table(spark, sf_dir, "embeddings"))


@query("op13_dynamic_itemset_phrases", PHRASE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catloom.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))
