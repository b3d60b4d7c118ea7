"""Catalog-shaped views over the test tables, one SQL text for Spark and DuckDB.

``v_*`` are flat. ``l_*`` hold landed JSON text in ``value`` (or ``body``) with a
number ``n`` that orders the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catloom.functions import variants as V
from catloom.functions.binding import bind
from catloom.functions.ordering import seq_from_number
from catloom.session import spread

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "pages",
)

_ENGINE = """CASE s_suppkey % 7 WHEN 0 THEN 'snowflake' WHEN 1 THEN 'bigquery-cloud-sdk'
  WHEN 2 THEN 'bigquery' WHEN 3 THEN 'postgres' WHEN 4 THEN 'h2'
  WHEN 5 THEN 'mysql' ELSE 'redshift' END"""

_DATASET_QUERY = """CASE p_partkey % 4 WHEN 0 THEN '{"type":"native"}' WHEN 1 THEN '{"type":"query"}'
  WHEN 2 THEN '{"stages":[{"lib/type":"mbql.stage/native"}]}'
  ELSE '{"stages":[{"lib/type":"mbql.stage/mbql"}]}' END"""

_DATABASE_ID = "CASE WHEN p_partkey % 13 = 0 THEN -1 ELSE p_partkey % 10 END"


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


# A parsed record per line: objects, relationships and header by line number.
_OBJECTS = f"""CASE WHEN l_linenumber = 5
  THEN '[{{"id":3,"name":"cte_x","type":"cte","database":"X","schema":"Y"}}]'
  ELSE concat(
    '[{{"id":1,"name":"`SUPP_', {_text("l_suppkey")}, '`","type":"TABLE","database":"WH","schema":"',
    CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE concat(chr(92), '"PUBLIC', chr(92), '"') END, '"}},',
    '{{"id":"1","tableName":"part_', {_text("l_partkey")}, '","objectType":"view","db":"DB2","vendor_name":"mysql"}},',
    '{{"id":3,"name":"cte_x","type":"cte","database":"X","schema":"Y"}},7',
    CASE WHEN l_linenumber = 7 THEN ',{{"id":1,"name":"late","type":"table","database":"","schema":""}}]' ELSE ']' END)
  END"""

_RELATIONSHIPS = f"""CASE WHEN l_linenumber = 6 THEN '[]' WHEN l_linenumber % 2 = 1 THEN concat(
    '[{{"sources":[{{"column":"', chr(92), '"C', {_text("l_linenumber")}, chr(92), '"","parentId":1,"parentName":"A.B.C"}},',
    '{{"column":"c2","parentId":"1"}},{{"name":"c3","parentId":99,"parentName":"RAW.PUBLIC.T', {_text("l_suppkey")}, '"}},',
    '{{"column":"c2","parentId":"1"}},{{"column":"","parentId":1}},{{"column":"c4","parentId":3}}],',
    '"source":{{"column":"hidden"}}}}]')
  ELSE '[{{"source":{{"column":"sc","table":"`st`","schema":"ss","database":"sd","vendor_name":"h2"}},"from":{{"name":"fc","tableName":"ft","db":"fd"}}}}]'
  END"""

VIEWS = {
    "v_collections": """
SELECT CASE WHEN n_nationkey = 0 THEN 'root' ELSE CAST(n_nationkey AS STRING) END AS id,
       n_name AS name, lower(n_name) AS slug,
       CASE WHEN n_regionkey = 4 THEN n_nationkey END AS personal_owner_id
FROM nation""",
    "v_dashboards": """
SELECT o.o_orderkey AS id, concat('Dashboard ', CAST(o.o_orderkey AS STRING)) AS name,
       nullif(c.c_nationkey, 0) AS collection_id, o.o_orderdate AS created_at
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "v_dashcards": """
SELECT l_orderkey AS dashboard_id, l_linenumber AS slot,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_partkey END AS card_id
FROM lineitem""",
    "v_databases": f"""
SELECT s_suppkey AS id, s_name AS name, {_ENGINE} AS engine,
       CASE s_suppkey % 5 WHEN 0 THEN '{{"details":{{"dbname":"wh","schema":"analytics"}}}}'
            WHEN 1 THEN '{{"details":{{"db":"sample"}}}}' WHEN 2 THEN '{{"details":{{"host":"x"}}}}'
            WHEN 3 THEN '{{"details":null}}' ELSE '{{}}' END AS raw,
       CASE WHEN s_suppkey % 9 = 0 THEN 'none' ELSE 'write' END AS native_permissions
FROM supplier""",
    "v_questions": f"""
SELECT p_partkey AS id, p_name AS name, nullif(p_size % 25, 0) AS collection_id,
       {_DATABASE_ID} AS database_id, {_DATASET_QUERY} AS dataset_query
FROM part""",
    "v_question_queries": """
SELECT p_partkey AS question_id, concat('SELECT * FROM ', replace(p_name, ' ', '_')) AS query
FROM part WHERE p_partkey % 11 <> 0""",
    "v_dbobjs": """
SELECT l_partkey AS question_id, l_orderkey * 10 + l_linenumber AS obj_id,
       CASE l_linenumber % 3 WHEN 0 THEN concat('"SUPP_', CAST(l_suppkey AS STRING), '"')
            WHEN 1 THEN concat('`supp_', CAST(l_suppkey AS STRING), '`')
            ELSE concat('supp_', CAST(l_suppkey AS STRING)) END AS name,
       CASE l_returnflag WHEN 'N' THEN 'cte' WHEN 'A' THEN 'table' ELSE 'VIEW' END AS type,
       'WH' AS database,
       CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE '"PUBLIC"' END AS schema_name
FROM lineitem""",
    "v_catalog": """
SELECT 'Table' AS type_name, concat('default/wh/', CAST(s_suppkey AS STRING)) AS qualified_name,
       'WH' AS database_name, 'PUBLIC' AS schema_name, concat('SUPP_', CAST(s_suppkey AS STRING)) AS table_name
FROM supplier WHERE s_suppkey % 3 <> 0
UNION ALL
SELECT 'View', concat('default/wh/v', CAST(s_suppkey AS STRING)), 'WH',
       CASE WHEN s_suppkey % 2 = 0 THEN 'PUBLIC' ELSE 'OTHER' END, concat('supp_', CAST(s_suppkey AS STRING))
FROM supplier
UNION ALL
SELECT 'Schema', 'default/wh/PUBLIC', 'WH', 'PUBLIC', 'supp_1' FROM region WHERE r_regionkey = 0""",
    "l_collections": f"""
SELECT concat('{{"id":', CASE WHEN n_nationkey = 0 THEN '"root"' ELSE {_text("n_nationkey")} END,
         ',"name":"', n_name, '","slug":"', lower(n_name), '","color":',
         CASE WHEN n_regionkey = 1 THEN '"#509EE3"' ELSE 'null' END, ',"personal_owner_id":',
         CASE WHEN n_regionkey = 4 THEN {_text("n_nationkey")} ELSE 'null' END, '}}') AS value, n_nationkey AS n
FROM nation""",
    "l_dashboards": f"""
SELECT concat('{{"id":', {_text("o_orderkey")}, ',"name":"Dashboard ', {_text("o_orderkey")}, '","collection_id":',
         CASE WHEN o_custkey % 27 = 0 THEN 'null' ELSE {_text("o_custkey % 27")} END, '}}') AS value, o_orderkey AS n
FROM orders""",
    # Details: three card slots, of which one is a text card and one may lack its card.
    "l_dashboard_details": f"""
SELECT {_text("o_orderkey")} AS record_id, '/api/dashboard' AS endpoint,
       CASE WHEN o_orderkey % 17 = 0 THEN 404 ELSE 200 END AS http_status,
       concat('{{"id":', {_text("o_orderkey")}, ',"name":"Dashboard ', {_text("o_orderkey")}, '","collection_id":',
         CASE WHEN o_custkey % 27 = 0 THEN 'null' ELSE {_text("o_custkey % 27")} END,
         ',"created_at":"2024-01-0', {_text("o_orderkey % 9 + 1")}, 'T10:00:00.5Z","updated_at":null,"last_edit_info_user":',
         CASE WHEN o_orderkey % 5 = 0 THEN '""' ELSE '"ann"' END,
         CASE WHEN o_orderkey % 3 = 1 THEN ',"ordered_cards":' ELSE ',"dashcards":' END,
         '[{{"card_id":', {_text("o_custkey")}, ',"card":{{"id":', {_text("o_custkey")}, '}}}},{{"card_id":null,"card":{{"name":"text"}}}},',
         '{{"card_id":', {_text("o_custkey % 100")}, ',"card":',
         CASE WHEN o_orderkey % 2 = 0 THEN 'null' ELSE concat('{{"id":', {_text("o_custkey % 100")}, '}}') END, '}}]',
         CASE WHEN o_orderkey % 3 = 2 THEN ',"ordered_cards":[{{"card_id":1,"card":{{"id":1}}}}]}}' ELSE '}}' END) AS body,
       o_orderkey AS n
FROM orders""",
    "l_questions": f"""
SELECT concat('{{"id":', {_text("p_partkey")}, ',"name":"', p_name, '","description":"', p_brand, '","collection_id":',
         CASE WHEN p_size % 27 = 0 THEN 'null' ELSE {_text("p_size % 27")} END,
         ',"database_id":', {_text(_DATABASE_ID)}, ',"creator_id":', {_text("p_size % 3")},
         ',"dataset_query":', {_DATASET_QUERY}, '}}') AS value, p_partkey AS n
FROM part""",
    "l_question_queries": f"""
SELECT {_text("p_partkey")} AS record_id, '/api/dataset/native' AS endpoint,
       CASE WHEN p_partkey % 11 = 0 THEN 500 ELSE 200 END AS http_status,
       CASE p_partkey % 11 WHEN 1 THEN '{{"query":""}}' WHEN 2 THEN 'oops' WHEN 3 THEN '{{"query":{{"a":1}}}}'
         ELSE concat('{{"query":"SELECT * FROM ', replace(p_name, ' ', '_'), '","params":[1]}}') END AS body,
       p_partkey AS n
FROM part""",
    "l_databases": f"""
SELECT concat('{{"id":', {_text("s_suppkey")}, ',"name":"', s_name, '","engine":"', {_ENGINE}, '","native_permissions":',
         CASE WHEN s_suppkey % 9 = 0 THEN 'null' ELSE '"write"' END,
         CASE s_suppkey % 5 WHEN 0 THEN ',"details":{{"dbname":"wh","schema":"analytics"}}}}'
              WHEN 1 THEN ',"details":{{"db":"sample"}}}}' WHEN 2 THEN ',"details":{{"host":"x"}}}}'
              WHEN 3 THEN ',"details":null}}' ELSE '}}' END) AS value, s_suppkey AS n
FROM supplier""",
    "l_events": """
SELECT event_id AS n, '/api/collection' AS endpoint, CAST(event_id AS STRING) AS record_id,
       CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS http_status,
       CASE event_id % 3 WHEN 0 THEN concat('[', props, ']')
            WHEN 1 THEN concat('{"data":[', props, ',', props, ']}') ELSE '{"other_key":1}' END AS body
FROM events""",
    # One parsed-SQL record per line item, in the three generations of the format.
    "l_parsed": f"""
SELECT n, CASE g WHEN 0 THEN concat('{{"sql":"', sql, '","gudusoft":', payload, ',"extra":{{"attributes":{{"qualifiedName":"', qn, '","name":"', title, '"}}}}}}')
         WHEN 1 THEN concat('{{"sql":"', sql, '","parsedData":"not json","gudusoft":', payload, ',"extra":{{"attributes":{{"qualifiedName":"', qn, '"}}}}}}')
         ELSE concat('{{"SQL":"', sql, '","QUERY_ID":"', qn, '","QUESTION_NAME":"', title, '","PARSED_DATA":"',
                replace(replace(payload, chr(92), concat(chr(92), chr(92))), '"', concat(chr(92), '"')), '"}}') END AS value
FROM (
  SELECT l_orderkey AS n, l_orderkey % 3 AS g,
         concat('SELECT ', {_text("l_suppkey")}, ' FROM t', {_text("l_orderkey")}) AS sql,
         CASE WHEN l_suppkey % 20 = 0 THEN '' ELSE concat('default/bi/1/questions/', {_text("l_partkey")}) END AS qn,
         concat('Q ', {_text("l_partkey")}) AS title,
         concat('{{"dbvendor":"', CASE l_linenumber % 3 WHEN 0 THEN 'dbSnowflake' WHEN 1 THEN '' ELSE 'postgres' END,
                '","dbobjs":', {_OBJECTS}, ',"relationships":', {_RELATIONSHIPS}, '}}') AS payload
  FROM lineitem) t""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for base in TABLES:
        if f" {base}" in VIEWS[name]:
            df = table(spark, sf_dir, base)
            # Landed text is parsed next, which is work for every core.
            (spread(df) if name.startswith("l_") else df).createOrReplaceTempView(base)
    return spark.sql(VIEWS[name])


def rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Landed view as parsed ``(raw, seq)``."""
    lines = view(spark, sf_dir, name).select("value", seq_from_number(F.col("n")).alias("seq"))
    return bind(lines, raw=V.parse(F.col("value"))).select("raw", "seq")


def responses(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Landed view as ``(endpoint, record_id, http_status, body, seq)``."""
    return view(spark, sf_dir, name).select(
        "endpoint", "record_id", "http_status", "body", seq_from_number(F.col("n")).alias("seq")
    )


def pages(
    spark: SparkSession, sf_dir: str, name: str, endpoint: str, envelope: str | None = None, failing: bool = True
) -> DataFrame:
    """Landed view as list responses of up to 100 records, last number first; one more response failed."""
    lines = view(spark, sf_dir, name).groupBy(F.floor(F.col("n") / 100).alias("page"))
    newest_first = F.reverse(F.array_sort(F.collect_list(F.struct("n", "value"))))
    body = F.concat(F.lit("["), F.array_join(F.transform(newest_first, lambda r: r["value"]), ","), F.lit("]"))
    if envelope:
        body = F.concat(F.lit(f'{{"{envelope}":'), body, F.lit("}"))
    place = seq_from_number(-F.col("page")).alias("seq")
    path, nobody = F.lit(endpoint).alias("endpoint"), F.lit(None).cast("string").alias("record_id")
    landed = lines.agg(body.alias("body")).select(path, nobody, F.lit(200).alias("http_status"), "body", place)
    if not failing:
        return landed
    lost = spark.range(1).select(
        path, nobody, F.lit(503).alias("http_status"), F.lit(None).cast("string").alias("body"), seq_from_number(F.col("id")).alias("seq")
    )
    return landed.unionByName(lost)


def with_ctes(body: str, *names: str, **extra: str) -> str:
    """DuckDB text: views (and further named queries) in front of ``body``."""
    parts = [f"{n} AS ({VIEWS[n]})" for n in names] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
