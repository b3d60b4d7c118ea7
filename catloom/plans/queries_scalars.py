"""Queries of the Column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catloom.functions import identity as I
from catloom.functions import text as X
from catloom.functions import times as M
from catloom.functions import variants as V
from catloom.operators.enrich import query_kind
from catloom.operators.lineage import read_header
from catloom.plans.registry import CTX, query
from catloom.plans.views import rows, table, view, with_ctes
from catloom.sources.landing import query_text


def _unq(c: str) -> str:
    return (
        f"CASE WHEN length({c}) >= 2 AND left({c}, 1) = right({c}, 1) AND left({c}, 1) IN ('\"', '`') "
        f"THEN substring({c}, 2, length({c}) - 2) ELSE {c} END"
    )


@query("root_key", """
SELECT p_partkey AS id, CASE WHEN p_size % 25 IN (0, 3) THEN 'root' ELSE CAST(p_size % 25 AS VARCHAR) END AS key
FROM part""")
def _(spark, sf):
    owner = F.col("p_size") % 25
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), I.root_key(F.nullif(owner, F.lit(3))).alias("key")
    )


@query("nested_path", with_ctes("""
SELECT id, coalesce(json_extract_string(raw, '$.details.dbname'), 'none') AS dbname,
       json_extract_string(raw, '$.details.schema') AS schema_name
FROM v_databases""", "v_databases"))
def _(spark, sf):
    raw = V.parse(F.col("raw"))
    return view(spark, sf, "v_databases").select(
        "id", V.path(raw, "$.details.dbname", "none").alias("dbname"), V.path(raw, "$.details.schema").alias("schema_name")
    )


@query("engine_lookup", with_ctes("""
SELECT id, CASE WHEN engine = 'bigquery-cloud-sdk' THEN 'bigquery' ELSE engine END AS engine
FROM v_databases""", "v_databases"))
def _(spark, sf):
    return view(spark, sf, "v_databases").select("id", I.engine_name(F.col("engine")).alias("engine"))


@query("unquote_ident", with_ctes(f"""
SELECT question_id, obj_id, {_unq("name")} AS name, {_unq("schema_name")} AS schema_name
FROM v_dbobjs""", "v_dbobjs"))
def _(spark, sf):
    return view(spark, sf, "v_dbobjs").select(
        "question_id", "obj_id",
        X.unquote_ident(F.col("name")).alias("name"), X.unquote_ident(F.col("schema_name")).alias("schema_name"),
    )


_DIALECT = "CASE id % 4 WHEN 0 THEN concat('db', engine) WHEN 1 THEN concat('DB', upper(engine)) WHEN 2 THEN engine ELSE '' END"


@query("vendor_normalise", with_ctes(f"""
SELECT id, coalesce(nullif(lower(regexp_replace({_DIALECT}, '^db', '', 'i')), ''), 'generic') AS vendor
FROM v_databases""", "v_databases"))
def _(spark, sf):
    return view(spark, sf, "v_databases").select("id", X.vendor_name(F.expr(_DIALECT), "generic").alias("vendor"))


@query("last_segment", """
SELECT p_partkey AS id, CAST(p_partkey AS VARCHAR) AS from_qn, p_name AS from_name FROM part""")
def _(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        X.last_segment(I.qn("question", CTX.connection_qn, F.col("p_partkey"))).alias("from_qn"),
        X.last_segment(F.col("p_name")).alias("from_name"),
    )


_DOTTED = """CASE l_linenumber % 4 WHEN 0 THEN concat('RAW.PUBLIC.T', CAST(l_suppkey AS STRING))
  WHEN 1 THEN concat('"PUBLIC".`T', CAST(l_suppkey AS STRING), '`') WHEN 2 THEN concat('T', CAST(l_suppkey AS STRING))
  ELSE concat('A."B".C.D', CAST(l_suppkey AS STRING)) END"""


@query("dotted_name", """
SELECT l_orderkey, l_linenumber,
  CASE l_linenumber % 4 WHEN 0 THEN 'RAW' WHEN 3 THEN 'A' ELSE '' END AS database,
  CASE l_linenumber % 4 WHEN 0 THEN 'PUBLIC' WHEN 1 THEN 'PUBLIC' WHEN 3 THEN 'B' ELSE '' END AS schema_name,
  concat(CASE WHEN l_linenumber % 4 = 3 THEN 'C.D' ELSE 'T' END, CAST(l_suppkey AS VARCHAR)) AS table_name
FROM lineitem""")
def _(spark, sf):
    name = X.dotted_name(F.expr(_DOTTED))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", name["database"].alias("database"),
        name["schema"].alias("schema_name"), name["table_name"].alias("table_name"),
    )


@query("truncate_name", """
SELECT doc_id, CASE WHEN length(text) > 10000 THEN concat(left(text, 9999), '…') ELSE text END AS name FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.truncate_name(F.col("text")).alias("name"))


@query("content_hash", with_ctes("""
SELECT question_id, left(md5(concat(question_id, '|', query)), 12) AS process_hash,
       left(md5(concat(question_id, '|', query, '|column')), 12) AS column_hash
FROM v_question_queries""", "v_question_queries"))
def _(spark, sf):
    parts = (F.col("question_id"), F.col("query"))
    return view(spark, sf, "v_question_queries").select(
        "question_id",
        I.content_hash(*parts).alias("process_hash"),
        I.content_hash(*parts, F.lit("column")).alias("column_hash"),
    )


@query("compact_components", with_ctes(f"""
SELECT question_id, obj_id, concat('{{"databaseName":"WH",',
  CASE WHEN schema_name = '' THEN '' ELSE '"schemaName":"PUBLIC",' END, '"tableName":"', {_unq("name")}, '"}}') AS components
FROM v_dbobjs""", "v_dbobjs"))
def _(spark, sf):
    parts = I.compact_components(
        connectorType=F.lit(""), databaseName=F.col("database"),
        schemaName=X.unquote_ident(F.col("schema_name")), tableName=X.unquote_ident(F.col("name")),
    )
    return view(spark, sf, "v_dbobjs").select("question_id", "obj_id", F.to_json(parts).alias("components"))


@query("upstream_path", with_ctes(f"""
SELECT question_id, obj_id, concat('WH/', CASE WHEN schema_name = '' THEN '' ELSE 'PUBLIC/' END, {_unq("name")}) AS path
FROM v_dbobjs""", "v_dbobjs"))
def _(spark, sf):
    path = X.upstream_path(F.col("database"), X.unquote_ident(F.col("schema_name")), X.unquote_ident(F.col("name")))
    return view(spark, sf, "v_dbobjs").select("question_id", "obj_id", path.alias("path"))


@query("qualified_names", """
SELECT p_partkey AS id, concat('default/bi/1/collections/', p_partkey) AS collection,
  concat('default/bi/1/dashboards/', p_partkey) AS dashboard, concat('default/bi/1/questions/', p_partkey) AS question,
  concat('default/bi/1/questions_dashboards/', p_partkey) AS bi_process,
  concat('default/bi/1/question_tables/', p_partkey, '/', left(md5(p_name), 12)) AS process,
  concat('default/bi/1/question_columns/', p_partkey, '/', left(md5(p_name), 12)) AS column_process
FROM part""")
def _(spark, sf):
    ident, digest = F.col("p_partkey"), I.content_hash(F.col("p_name"))
    plain = ("collection", "dashboard", "question", "bi_process")
    return table(spark, sf, "part").select(
        ident.alias("id"),
        *[I.qn(k, CTX.connection_qn, ident).alias(k) for k in plain],
        *[I.qn(k, CTX.connection_qn, ident, digest).alias(k) for k in ("process", "column_process")],
    )


@query("source_urls", """
SELECT p_partkey AS id, concat('https://bi.example.com/collection/', p_partkey) AS collection,
  concat('https://bi.example.com/browse/', p_partkey) AS database,
  concat('/dashboard/', p_partkey) AS dashboard, concat('https://bi.example.com/question/', p_partkey) AS question
FROM part""")
def _(spark, sf):
    ident = F.col("p_partkey")
    return table(spark, sf, "part").select(
        ident.alias("id"),
        *[I.source_url("" if k == "dashboard" else CTX.host, k, ident).alias(k) for k in I.PAGES],
    )


_ISO = """CASE event_id % 7 WHEN 0 THEN CAST(ts AS STRING) WHEN 1 THEN concat(replace(CAST(ts AS STRING), ' ', 'T'), 'Z')
  WHEN 2 THEN concat(replace(CAST(ts AS STRING), ' ', 'T'), '+02:00') WHEN 3 THEN substring(CAST(ts AS STRING), 1, 10)
  WHEN 4 THEN 'last week' WHEN 5 THEN '' ELSE concat(replace(CAST(ts AS STRING), ' ', 'T'), '-0530') END"""


@query("iso_millis", """
SELECT event_id, CAST(CASE event_id % 7 WHEN 3 THEN epoch_us(date_trunc('day', ts)) // 1000
  WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 2 THEN epoch_us(ts) // 1000 - 7200000
  WHEN 6 THEN epoch_us(ts) // 1000 + 19800000 ELSE epoch_us(ts) // 1000 END AS BIGINT) AS ms FROM events""")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", M.iso_millis(F.expr(_ISO)).alias("ms"))


@query("iso_millis_strict", """
SELECT event_id, CAST(CASE event_id % 7 WHEN 1 THEN epoch_us(ts) // 1000 WHEN 2 THEN epoch_us(ts) // 1000 - 7200000
  WHEN 6 THEN epoch_us(ts) // 1000 + 19800000 END AS BIGINT) AS ms FROM events""")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", M.iso_millis_strict(F.expr(_ISO)).alias("ms"))


@query("strip_html", """
SELECT page_id, replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'),
  '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&') AS text FROM pages""")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.strip_html(F.col("html")).alias("text"))


@query("serialize_complex", """
SELECT event_id, event_type, concat('{"user":', user_id, ',"kind":"', event_type, '"}') AS pair,
       concat('[', user_id, ',', event_id, ']') AS ids, replace(props, ' ', '') AS props FROM events""")
def _(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id", "event_type",
        F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("kind")).alias("pair"),
        F.array("user_id", "event_id").alias("ids"),
        V.parse(F.col("props")).alias("props"),
    )
    return V.serialize_complex(df)


@query("query_kind", with_ctes("""
SELECT id, coalesce(json_extract_string(dataset_query, '$.type'),
  CASE json_extract_string(dataset_query, '$.stages[0]."lib/type"')
    WHEN 'mbql.stage/native' THEN 'native' WHEN 'mbql.stage/mbql' THEN 'query' ELSE '' END) AS kind
FROM v_questions""", "v_questions"))
def _(spark, sf):
    return view(spark, sf, "v_questions").select("id", query_kind(V.parse(F.col("dataset_query"))).alias("kind"))


_BODY = """CASE p_partkey % 5 WHEN 0 THEN concat('{"query":"SELECT ', p_name, '"}') WHEN 1 THEN '{"query":{"a":1}}'
  WHEN 2 THEN '{"query":null}' WHEN 3 THEN '{"query":7}' ELSE '{}' END"""


@query("query_text_coerce", """
SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN concat('SELECT ', p_name) ELSE '' END AS query FROM part""")
def _(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), query_text(V.parse(F.expr(_BODY))).alias("query")
    )


# First, second and third candidate by row: unusable ones of every kind come first.
_CANDIDATES = """concat('{"parsedData":', CASE p_partkey % 7 WHEN 0 THEN '{"tag":"a"}' WHEN 1 THEN '"not json"'
    WHEN 2 THEN '[1]' WHEN 3 THEN '{}' WHEN 4 THEN 'null' WHEN 5 THEN concat('"{', chr(92), '"tag', chr(92), '":', chr(92), '"t', chr(92), '"}"') ELSE '5' END,
  ',"gudusoft":', CASE WHEN p_partkey % 2 = 0 THEN '{"tag":"b"}' ELSE '""' END, ',"PARSED_DATA":{"tag":"c"}}')"""


@query("first_payload", """
SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN 'a' WHEN p_partkey % 7 = 5 THEN 't'
  WHEN p_partkey % 2 = 0 THEN 'b' ELSE 'c' END AS tag FROM part""")
def _(spark, sf):
    from catloom.operators.lineage import PAYLOADS

    payload = V.first_payload(V.parse(F.expr(_CANDIDATES)), PAYLOADS)
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), V.at(F.try_element_at(payload, F.lit("tag")), "$").alias("tag")
    )


@query("parsed_record_header", """
SELECT l_orderkey AS n, CASE WHEN l_suppkey % 20 = 0 THEN '' ELSE concat('default/bi/1/questions/', l_partkey) END AS question_qn,
  CASE WHEN l_orderkey % 3 = 1 THEN '' ELSE concat('Q ', l_partkey) END AS question_name,
  concat('SELECT ', l_suppkey, ' FROM t', l_orderkey) AS sql
FROM lineitem""")
def _(spark, sf):
    header = read_header(F.col("raw"))
    return rows(spark, sf, "l_parsed").select(F.col("seq.row").alias("n"), *[c.alias(n) for n, c in header.items()])


@query("record_overlay", with_ctes("""
SELECT id, concat('{"name":"', name, '","engine":"', engine, '","schema":"main"}') AS record
FROM v_databases""", "v_databases"))
def _(spark, sf):
    base = F.create_map(F.lit("engine"), F.lit("old"), F.lit("name"), F.col("name"))
    over = F.create_map(F.lit("engine"), F.col("engine"), F.lit("schema"), F.lit("main"))
    return view(spark, sf, "v_databases").select("id", F.to_json(V.overlay(base, over)).alias("record"))
