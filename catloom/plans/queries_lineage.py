"""Queries of lineage and reference resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from catloom.functions.text import unquote_ident
from catloom.operators import lineage as G
from catloom.operators import resolve as R
from catloom.operators.quality import stage_totals
from catloom.plans.pipeline import run_lineage
from catloom.plans.queries_scalars import _unq
from catloom.plans.registry import CTX, query
from catloom.plans.views import rows, table, view, with_ctes
from catloom.session import shared_folder
from catloom.sources.sinks import FILE_LINES, write_lineage
from catloom.streaming.lineage_stream import read_stream, stream_lineage

# The expected rows, from the line items the records were made of.
_RECORDS = """SELECT row_number() OVER () AS rec, l_partkey AS qid, l_suppkey AS s, l_linenumber AS n,
  concat('SELECT ', l_suppkey, ' FROM t', l_orderkey) AS sql,
  CASE WHEN l_orderkey % 3 = 1 THEN concat('default/bi/1/questions/', l_partkey) ELSE concat('Q ', l_partkey) END AS title,
  CASE l_linenumber % 3 WHEN 0 THEN 'snowflake' WHEN 1 THEN '' ELSE 'postgres' END AS vendor,
  CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE 'PUBLIC' END AS sch
  FROM lineitem WHERE l_suppkey % 20 <> 0"""
_TABLES = """SELECT rec, qid, sql, n, 1 AS pos, vendor AS vendor_name, 'WH' AS db, sch, concat('SUPP_', s) AS tab FROM r WHERE n <> 5
  UNION ALL SELECT rec, qid, sql, n, 2, 'mysql', 'DB2', '', concat('part_', qid) FROM r WHERE n <> 5
  UNION ALL SELECT rec, qid, sql, n, 3, vendor, '', '', 'late' FROM r WHERE n = 7"""
# In records of line 5 only the object with id 3 exists; in those of line 7 the
# second object of id 1 wins.
_COLUMNS = """SELECT rec, qid, sql, n, 1 AS pos, vendor AS vendor_name,
    CASE n WHEN 5 THEN 'A' WHEN 7 THEN '' ELSE 'WH' END AS db, CASE n WHEN 5 THEN 'B' WHEN 7 THEN '' ELSE sch END AS sch,
    CASE n WHEN 5 THEN 'C' WHEN 7 THEN 'late' ELSE concat('SUPP_', s) END AS tab, concat('C', n) AS col FROM r WHERE n % 2 = 1
  UNION ALL SELECT rec, qid, sql, n, 2, CASE n WHEN 5 THEN vendor ELSE 'mysql' END, CASE n WHEN 5 THEN '' ELSE 'DB2' END, '',
    CASE n WHEN 5 THEN '' ELSE concat('part_', qid) END, 'c2' FROM r WHERE n % 2 = 1
  UNION ALL SELECT rec, qid, sql, n, 3, vendor, 'RAW', 'PUBLIC', concat('T', s), 'c3' FROM r WHERE n % 2 = 1
  UNION ALL SELECT rec, qid, sql, n, 4, vendor, 'X', 'Y', 'cte_x', 'c4' FROM r WHERE n % 2 = 1
  UNION ALL SELECT rec, qid, sql, n, 1, 'h2', 'sd', 'ss', 'st', 'sc' FROM r WHERE n % 2 = 0 AND n <> 6
  UNION ALL SELECT rec, qid, sql, n, 2, vendor, 'fd', '', 'ft', 'fc' FROM r WHERE n % 2 = 0 AND n <> 6"""
_CTES = {"r": _RECORDS, "t": _TABLES, "c": _COLUMNS}


def _sql(body: str, *views: str, **extra: str) -> str:
    return with_ctes(body, *views, **_CTES, **extra)


def _parsed(spark, sf):
    return G.parse_records(rows(spark, sf, "l_parsed"))


_PATH = "array_to_string(list_filter([{}], lambda x: x <> ''), '/')"
_TPATH = _PATH.format("db, sch, tab")
_CPATH = _PATH.format("db, sch, tab, col")


def _components(pairs: str) -> str:
    return f"concat('{{', array_to_string(list_filter([{pairs}], lambda x: NOT x LIKE '%:\"\"'), ','), '}}')"


_PAIRS = """concat('"connectorType":"', vendor_name, '"'), concat('"databaseName":"', db, '"'),
  concat('"schemaName":"', sch, '"'), concat('"tableName":"', tab, '"')"""
_TCOMP = _components(_PAIRS)
_CCOMP = _components(_PAIRS + """, concat('"columnName":"', col, '"')""")


@query("lineage_tables", _sql("SELECT CAST(qid AS VARCHAR) AS question_id, sql, vendor_name, db, sch, tab FROM t"))
def _(spark, sf):
    parsed = G.parse_records(rows(spark, sf, "l_parsed"), with_columns=False)
    refs = parsed.select("question_id", "sql", F.explode("tables").alias("t"))
    return refs.select(
        "question_id", "sql", "t.vendor_name", F.col("t.database").alias("db"), F.col("t.schema").alias("sch"), F.col("t.table_name").alias("tab")
    )


@query("lineage_columns", _sql("SELECT CAST(qid AS VARCHAR) AS question_id, sql, pos - 1 AS pos, vendor_name, db, sch, tab, col FROM c"))
def _(spark, sf):
    refs = G.columns_once(_parsed(spark, sf)).select("question_id", "sql", F.posexplode("columns").alias("pos", "c"))
    return refs.select(
        "question_id", "sql", "pos", "c.vendor_name", F.col("c.database").alias("db"), F.col("c.schema").alias("sch"),
        F.col("c.table_name").alias("tab"), F.col("c.column_name").alias("col"),
    )


def _flat_ref(ref):
    identity = ref["attributes"]["refIdentity"]
    return [
        ref["typeName"].alias("kind"),
        ref["attributes"]["name"].alias("name"),
        identity["fallbackQualifiedName"].alias("path"),
        F.to_json(identity["components"]).alias("components"),
        F.array_join(identity["matchTypeNames"], ",").alias("types"),
    ]


@query("lineage_table_refs", _sql(f"""
SELECT CAST(qid AS VARCHAR) AS question_id, 'Table' AS kind, tab AS name, {_TPATH} AS path, {_TCOMP} AS components, 'Table,View' AS types FROM t"""))
def _(spark, sf):
    refs = _parsed(spark, sf).select("question_id", F.explode("tables").alias("t"))
    refs = refs.select("question_id", G.table_ref(F.col("t"), CTX).alias("ref"))
    return refs.select("question_id", *_flat_ref(F.col("ref")))


@query("lineage_column_refs", _sql(f"""
SELECT CAST(qid AS VARCHAR) AS question_id, 'Column' AS kind, col AS name, {_CPATH} AS path, {_CCOMP} AS components, 'Column' AS types FROM c"""))
def _(spark, sf):
    refs = G.columns_once(_parsed(spark, sf)).select("question_id", F.explode("columns").alias("c"))
    refs = refs.select("question_id", G.column_ref(F.col("c"), CTX).alias("ref"))
    return refs.select("question_id", *_flat_ref(F.col("ref")))


_HASH = "left(md5(concat(qid, '|', sql)), 12)"
_CHASH = "left(md5(concat(qid, '|', sql, '|column')), 12)"
_PQN = f"concat('default/bi/1/question_tables/', qid, '/', {_HASH})"
_CQN = f"concat('default/bi/1/question_columns/', qid, '/', {_CHASH})"
_TLIST = f"SELECT rec, string_agg({_TPATH}, ',' ORDER BY pos) AS inputs, count(*) AS n_inputs FROM t GROUP BY rec"
_CLIST = f"SELECT rec, string_agg({_CPATH}, ',' ORDER BY pos) AS inputs, count(*) AS n_inputs FROM c WHERE n <> 5 GROUP BY rec"


def _flat_process(df, *extra):
    a = F.col("attributes")
    return df.select(
        a["qualifiedName"].alias("qualified_name"), a["name"].alias("name"), a["sql"].alias("sql"),
        F.array_join(a["inputs"]["attributes"]["qualifiedName"], ",").alias("inputs"),
        F.size(a["inputs"]).cast("bigint").alias("n_inputs"),
        a["outputs"][0]["uniqueAttributes"]["qualifiedName"].alias("output"), *extra,
    )


@query("lineage_process", _sql(f"""
SELECT {_PQN} AS qualified_name, title AS name, sql, inputs, n_inputs, concat('default/bi/1/questions/', qid) AS output
FROM r JOIN l ON l.rec = r.rec""", l=_TLIST))
def _(spark, sf):
    return _flat_process(G.processes(_parsed(spark, sf), CTX))


@query("lineage_column_process", _sql(f"""
SELECT {_CQN} AS qualified_name, title AS name, sql, inputs, n_inputs, concat('default/bi/1/questions/', qid) AS output, {_PQN} AS process
FROM r JOIN l ON l.rec = r.rec""", l=_CLIST))
def _(spark, sf):
    parent = F.col("attributes")["process"]["uniqueAttributes"]["qualifiedName"].alias("process")
    return _flat_process(G.column_processes(_parsed(spark, sf), CTX), parent)


def _json_ref(kind: str, name: str, path: str, comp: str, types: str) -> str:
    return f"""concat('{{"typeName":"{kind}","attributes":{{"name":"', {name}, '","qualifiedName":"', {path},
  '","refIdentity":{{"components":', {comp}, ',"matchTypeNames":{types},"fallbackQualifiedName":"', {path},
  '","fallbackTypeName":"{kind}","noMatchAction":"drop","lookupResultHandling":"pick_first"}}}}}}')"""


def _json_record(kind: str, qn: str, extra: str) -> str:
    return f"""concat('{{"typeName":"{kind}","status":"ACTIVE","attributes":{{"name":"', title, '","qualifiedName":"', {qn},
  '","connectorName":"bi","connectionName":"BI","connectionQualifiedName":"default/bi/1","tenantId":"default","sql":"', sql, '",', {extra},
  '"inputs":[', refs, '],"outputs":[{{"typeName":"BiQuestion","uniqueAttributes":{{"qualifiedName":"default/bi/1/questions/', qid,
  '"}}}}],"refNestedLookupFields":["inputs","outputs"],"refNoNestedMatchAction":"keep"}}}}')"""


_PARENT = f"""'"process":{{"typeName":"Process","uniqueAttributes":{{"qualifiedName":"', {_PQN}, '"}}}},'"""
_JOB = f"""
SELECT 'PROCESS' AS type_dir, {_PQN} AS qualified_name, {_json_record("Process", _PQN, "''")} AS json
FROM r JOIN (SELECT rec, string_agg({_json_ref("Table", "tab", _TPATH, _TCOMP, '["Table","View"]')}, ',' ORDER BY pos) AS refs FROM t GROUP BY rec) l ON l.rec = r.rec
UNION ALL SELECT 'COLUMNPROCESS', {_CQN}, {_json_record("ColumnProcess", _CQN, _PARENT)}
FROM r JOIN (SELECT rec, string_agg({_json_ref("Column", "col", _CPATH, _CCOMP, '["Column"]')}, ',' ORDER BY pos) AS refs FROM c WHERE n <> 5 GROUP BY rec) l ON l.rec = r.rec"""


@query("lineage_job", _sql(_JOB))
def _(spark, sf):
    return G.lineage_lines(rows(spark, sf, "l_parsed"), CTX)


@query("lineage_sink", _sql(f"SELECT type_dir, json FROM ({_JOB}) j"))
def _(spark, sf):
    stage = write_lineage(*run_lineage(rows(spark, sf, "l_parsed"), CTX), shared_folder(spark, "lineage"))
    out = [
        spark.read.text(f"{stage.folder}/{kind}").select(F.lit(kind).alias("type_dir"), F.col("value").alias("json"))
        for kind in ("PROCESS", "COLUMNPROCESS")
    ]
    return out[0].unionByName(out[1])


# Counted by the one write of both sets.
@query("lineage_write_totals", _sql(f"SELECT type_dir, count(*) AS n FROM ({_JOB}) j GROUP BY type_dir"))
def _(spark, sf):
    stage = write_lineage(*run_lineage(rows(spark, sf, "l_parsed"), CTX), shared_folder(spark, "lineage"))
    counted = [("PROCESS", stage.processes), ("COLUMNPROCESS", stage.column_processes)]
    return spark.createDataFrame(counted, "type_dir string, n long")


# The stream takes every landed file in one run; its rows are the batch job's.
@query("stream_lineage", _sql(_JOB))
def _(spark, sf):
    root = shared_folder(spark, "stream")
    lines = view(spark, sf, "l_parsed").select("value")
    lines.write.options(compression="gzip", maxRecordsPerFile=FILE_LINES).text(f"{root}/landed")
    stream_lineage(spark, f"{root}/landed", f"{root}/sink", f"{root}/log", CTX, pattern="*.txt.gz").awaitTermination()
    return read_stream(spark, f"{root}/sink")[0]


# Event lines of which some are broken and some blank, landed in several files and taken in several batches.
@query("stream_rejects", """
SELECT 'not-json ' || CAST(event_id AS VARCHAR) AS value, count(*) AS n FROM events WHERE event_id % 50 = 0 GROUP BY 1""")
def _(spark, sf):
    root = shared_folder(spark, "stream")
    line = F.expr("CASE event_id % 50 WHEN 0 THEN concat('not-json ', event_id) WHEN 1 THEN '   ' ELSE props END")
    table(spark, sf, "events").repartition(4, "event_id").select(line.alias("value")).write.text(f"{root}/landed")
    stream_lineage(spark, f"{root}/landed", f"{root}/sink", f"{root}/log", CTX, max_files=1, pattern="*.txt").awaitTermination()
    return read_stream(spark, f"{root}/sink")[1].groupBy("value").agg(F.count("*").alias("n"))


@query("lineage_totals", _sql("SELECT 'lineage' AS stage, CAST((SELECT count(DISTINCT rec) FROM t) + (SELECT count(DISTINCT rec) FROM c WHERE n <> 5) AS BIGINT) AS n"))
def _(spark, sf):
    return stage_totals(lineage=list(run_lineage(rows(spark, sf, "l_parsed"), CTX)))


# --- references against a catalog ---------------------------------------------


def _catalog(spark, sf):
    return view(spark, sf, "v_catalog").select(
        "type_name", "qualified_name", F.lit(None).cast("string").alias("connectorType"),
        F.col("database_name").alias("databaseName"), F.col("schema_name").alias("schemaName"),
        F.col("table_name").alias("tableName"), F.lit(None).cast("string").alias("columnName"),
    )


@query("resolve_refs", with_ctes(f"""
SELECT question_id, obj_id, k.qualified_name AS resolved_qn, arg_min(c.type_name, c.qualified_name) AS resolved_type
FROM (SELECT row_number() OVER () AS i, question_id, obj_id, {_unq("name")} AS tab, {_unq("schema_name")} AS sch
      FROM v_dbobjs WHERE lower(type) IN ('table', 'view')) d
JOIN (SELECT table_name, schema_name, min(qualified_name) AS qualified_name FROM (
        SELECT table_name, schema_name, qualified_name FROM v_catalog WHERE type_name IN ('Table', 'View')
        UNION ALL SELECT table_name, '', qualified_name FROM v_catalog WHERE type_name IN ('Table', 'View')) u
      GROUP BY 1, 2) k ON k.table_name = d.tab AND k.schema_name = d.sch
JOIN v_catalog c ON c.qualified_name = k.qualified_name
GROUP BY i, question_id, obj_id, k.qualified_name""", "v_dbobjs", "v_catalog"))
def _(spark, sf):
    refs = (
        view(spark, sf, "v_dbobjs")
        .filter(F.lower("type").isin(*G.TABLE_TYPES))
        .select(
            "question_id", "obj_id", F.lit("Table").alias("kind"), F.col("database").alias("databaseName"),
            unquote_ident(F.col("schema_name")).alias("schemaName"), unquote_ident(F.col("name")).alias("tableName"),
        )
    )
    return R.match_refs(refs, _catalog(spark, sf)).select("question_id", "obj_id", "resolved_qn", "resolved_type")


# Columns of a catalog that names connectors, by references of which some give the connector and some no table.
_CATALOG_COLUMNS = " UNION ALL ".join(f"""SELECT 'Column' AS type_name, concat('default/wh/', CAST(s_suppkey AS STRING), '/{k}') AS qualified_name,
  CASE s_suppkey % 3 WHEN 0 THEN 'snowflake' WHEN 1 THEN 'postgres' ELSE 'mysql' END AS connectorType, 'WH' AS databaseName,
  CASE WHEN s_suppkey % 5 = 0 THEN 'OTHER' ELSE 'PUBLIC' END AS schemaName, concat('SUPP_', CAST(s_suppkey % 50 AS STRING)) AS tableName,
  'C{k}' AS columnName FROM supplier""" for k in range(5))
_COLUMN_REFS = """SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN 'snowflake' WHEN 1 THEN '' ELSE 'postgres' END AS connectorType,
  'WH' AS databaseName, CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE 'PUBLIC' END AS schemaName,
  CASE WHEN l_linenumber = 7 THEN '' ELSE concat('SUPP_', CAST(l_suppkey % 60 AS STRING)) END AS tableName,
  concat('C', CAST(l_partkey % 6 AS STRING)) AS columnName FROM lineitem"""


@query("resolve_columns", f"""
WITH refs AS (SELECT *, row_number() OVER () AS i FROM ({_COLUMN_REFS}) l), columns AS ({_CATALOG_COLUMNS}),
asked AS (SELECT DISTINCT connectorType, databaseName, schemaName, tableName, columnName FROM refs),
found AS (SELECT r.connectorType, r.databaseName, r.schemaName, r.tableName, r.columnName, min(c.qualified_name) AS resolved_qn
  FROM asked r JOIN columns c ON c.columnName = r.columnName AND c.databaseName = r.databaseName
    AND (r.connectorType = '' OR c.connectorType = r.connectorType) AND (r.schemaName = '' OR c.schemaName = r.schemaName)
    AND (r.tableName = '' OR c.tableName = r.tableName) GROUP BY ALL)
SELECT l_orderkey, l_linenumber, resolved_qn FROM refs JOIN found USING (connectorType, databaseName, schemaName, tableName, columnName)""")
def _(spark, sf):
    for name in ("supplier", "lineitem"):
        table(spark, sf, name).createOrReplaceTempView(name)
    refs = spark.sql(_COLUMN_REFS).withColumn("kind", F.lit("Column"))
    return R.match_refs(refs, spark.sql(_CATALOG_COLUMNS)).select("l_orderkey", "l_linenumber", "resolved_qn")


# Only references without a vendor can match a catalog that names no connector;
# of the rest the process stays, with no inputs.
@query("resolve_lineage", _sql(f"""
SELECT {_PQN} AS qualified_name, CAST(coalesce(m.n, 0) AS BIGINT) AS n_inputs, coalesce(m.inputs, '') AS inputs
FROM (SELECT DISTINCT rec FROM t) p JOIN r ON r.rec = p.rec LEFT JOIN (
  SELECT rec, count(*) AS n, string_agg(q, ',' ORDER BY pos) AS inputs FROM (
    SELECT t.rec, t.pos, min(k.qualified_name) AS q FROM t JOIN v_catalog k ON k.type_name IN ('Table', 'View')
      AND t.vendor_name = '' AND k.table_name = t.tab AND (t.db = '' OR t.db = k.database_name) AND (t.sch = '' OR t.sch = k.schema_name)
    GROUP BY t.rec, t.pos) x GROUP BY rec) m ON m.rec = p.rec""", "v_catalog"))
def _(spark, sf):
    found, _ = run_lineage(rows(spark, sf, "l_parsed"), CTX, catalog=_catalog(spark, sf))
    a = F.col("attributes")
    return found.select(
        a["qualifiedName"].alias("qualified_name"),
        F.size(a["inputs"]).cast("bigint").alias("n_inputs"),
        F.array_join(a["inputs"]["uniqueAttributes"]["qualifiedName"], ",").alias("inputs"),
    )
