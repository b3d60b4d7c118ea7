"""The queries over the given tables: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catloom.llm.common import table
from catloom.llm.registry import query

WORD_SQL = "len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))"

MIX_SQL = f"""
WITH sizes AS (SELECT doc_id, source, CAST({WORD_SQL} AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight FROM sources),
levels AS (SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) - CAST(coalesce(sum(2 * source_size) OVER (
      ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / CAST(sum(weight) OVER (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM weighed),
aims AS (SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), max(level) OVER () * weight) AS target FROM levels),
expected AS (SELECT d.*, a.source_size, a.target,
    CASE WHEN a.source_size > 0 THEN CAST(floor(a.target / a.source_size * 16777216 + 0.5::DOUBLE) AS BIGINT) ELSE 0 END AS e
  FROM sizes d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source),
ends AS (SELECT *, CAST(sum(e) OVER (PARTITION BY source ORDER BY size NULLS FIRST, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS BIGINT)
    + CAST('0x' || substr(md5('mix' || coalesce(source, chr(0))), 1, 6) AS BIGINT) AS z FROM expected)
SELECT doc_id, size, source_size, target, ((z >> 24) - ((z - e) >> 24)) * size AS taken FROM ends
"""

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

URL_SQL = """
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (SELECT page_id, host, path, h || p AS rule, v,
    row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h || p) DESC) AS place
  FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM fits WHERE place = 1
"""


@query("op4_systematic_mix", MIX_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catloom.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_bloom_cascade", URL_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catloom.llm.urls import judge_urls

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from catloom.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from catloom.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op1_hierarchical_language")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catloom.llm.common import remainder
    from catloom.llm.language import identify, train

    docs = table(spark, sf_dir, "documents")
    fold = remainder(F.col("doc_id"), 3)
    model = train(docs.where(fold != 1))
    found = identify(docs, model)
    return found.select("doc_id", (fold == 1).alias("held_out"), "lang_pred", "score")


@query("op8_nb_svm_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catloom.llm.common import remainder
    from catloom.llm.quality_model import score, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = remainder(F.col("doc_id"), 4)
    model = train(docs, table(spark, sf_dir, "labels").where(fold != 2))
    return score(docs, model).select("doc_id", (fold == 2).alias("held_out"), "score", "predicted")


@query("op2_mcd_outliers")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catloom.llm.outliers import judge

    return judge(table(spark, sf_dir, "documents"))


@query("op3_rotated_one_bit_neighbours")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catloom.llm.neighbours import build_index, search

    index = build_index(table(spark, sf_dir, "embeddings"))
    queries = index.where("vec_id % 20 = 0").select("vec_id", "embedding", "size")
    return search(index, queries)


JACCARD_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
"""


@query("op9_token_group_jaccard", JACCARD_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catloom.llm.jaccard import link_components

    return link_components(table(spark, sf_dir, "documents"))


@query("op6_hmm_likelihood")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catloom.llm.common import remainder
    from catloom.llm.hmm import score_documents

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs.withColumn("held_out", remainder(F.col("doc_id"), 7) == 2))
