"""Queries of enrichment, entities and the whole metadata job."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.context import WireNames
from catloom.functions import variants as V
from catloom.functions.binding import bind
from catloom.functions.ordering import seq_from_number, with_slot
from catloom.operators import enrich as E
from catloom.operators import entities as N
from catloom.plans.incremental import run_incremental
from catloom.plans.pipeline import Catalog, Landed, run_metadata
from catloom.plans.queries_select import _IN, SELECTION
from catloom.plans.registry import CTX, query
from catloom.plans.views import pages, responses, rows, table, view, with_ctes
from catloom.session import shared_folder
from catloom.sources.sinks import write_entities


def landed(spark, sf) -> Landed:
    return Landed(
        collections=rows(spark, sf, "l_collections"),
        dashboards=rows(spark, sf, "l_dashboards"),
        questions=rows(spark, sf, "l_questions"),
        databases=rows(spark, sf, "l_databases"),
        dashboard_details=responses(spark, sf, "l_dashboard_details"),
        question_queries=responses(spark, sf, "l_question_queries"),
    )


def catalog(spark, sf) -> Catalog:
    return run_metadata(landed(spark, sf), SELECTION, CTX)


# --- card lists over the flat views -----------------------------------------


def _slots(spark, sf, width: int = 65536):
    cards = view(spark, sf, "v_dashcards").filter(F.col("card_id") != 0)
    return cards.select(
        F.col("card_id").cast("string").alias("card_id"),
        F.col("dashboard_id"),
        with_slot(seq_from_number(F.col("dashboard_id"), width), F.col("slot")).alias("seq"),
    )


_LISTS = """SELECT CAST(card_id AS VARCHAR) AS card_id, count(*) AS n,
  string_agg(CAST(dashboard_id AS VARCHAR), ',' ORDER BY dashboard_id, slot) AS dashboards
FROM v_dashcards WHERE card_id <> 0 GROUP BY card_id"""


@query("card_dashboards", with_ctes(_LISTS, "v_dashcards"))
def _(spark, sf):
    lists = E.card_dashboards(_slots(spark, sf))
    return lists.select("card_id", F.size("dashboard_ids").cast("bigint").alias("n"), F.array_join("dashboard_ids", ",").alias("dashboards"))


# The lists of each input slice, for every question.
@query("card_dashboards_split", with_ctes("""
SELECT CAST(card_id AS VARCHAR) AS card_id, dashboard_id // 4096 AS block,
  string_agg(CAST(dashboard_id AS VARCHAR), ',' ORDER BY dashboard_id, slot) AS dashboards
FROM v_dashcards WHERE card_id <> 0 GROUP BY 1, 2""", "v_dashcards"))
def _(spark, sf):
    lists = E.card_dashboards(_slots(spark, sf, width=4096), sliced=True)
    return lists.select("card_id", F.col("part.block").alias("block"), F.array_join("dashboard_ids", ",").alias("dashboards"))


@query("question_dashboards", with_ctes("""
SELECT CAST(q.id AS VARCHAR) AS id, CAST(coalesce(n, 0) AS BIGINT) AS dashboard_count, coalesce(dashboards, '') AS dashboards
FROM v_questions q LEFT JOIN lists l ON CAST(q.id AS VARCHAR) = l.card_id""", "v_questions", "v_dashcards", lists=_LISTS))
def _(spark, sf):
    slots = _slots(spark, sf)
    questions = view(spark, sf, "v_questions").select(F.col("id").cast("string").alias("id"))
    counted = E.with_dashboard_count(questions, slots)
    return E.attach_dashboards(counted, E.card_dashboards(slots)).select(
        "id", F.col("dashboard_count").cast("bigint").alias("dashboard_count"), F.array_join("dashboard_ids", ",").alias("dashboards")
    )


@query("bi_process", with_ctes("""
SELECT q.name, CAST(q.id AS VARCHAR) AS question_id, concat('default/bi/1/questions/', q.id) AS input, l.n AS n_outputs,
  'default/bi/1/dashboards/' || replace(l.dashboards, ',', ',default/bi/1/dashboards/') AS outputs
FROM v_questions q JOIN lists l ON CAST(q.id AS VARCHAR) = l.card_id""", "v_questions", "v_dashcards", lists=_LISTS))
def _(spark, sf):
    questions = view(spark, sf, "v_questions").select(F.col("id").cast("string").alias("id"), "name")
    found = E.edges(questions, E.card_dashboards(_slots(spark, sf)), CTX)
    return found.select(
        "name",
        "question_id",
        F.col("inputs")[0]["uniqueAttributes"]["qualifiedName"].alias("input"),
        F.size("outputs").cast("bigint").alias("n_outputs"),
        F.array_join(F.col("outputs.uniqueAttributes.qualifiedName"), ",").alias("outputs"),
    )


@query("project_edges", with_ctes("""
SELECT q.name, CAST(q.id AS VARCHAR) AS question_id, l.dashboards
FROM v_questions q JOIN lists l ON CAST(q.id AS VARCHAR) = l.card_id""", "v_questions", "v_dashcards", lists=_LISTS))
def _(spark, sf):
    questions = view(spark, sf, "v_questions").select(F.col("id").cast("string").alias("id"), "name")
    found = N.project_edges(E.edges(questions, E.card_dashboards(_slots(spark, sf)), CTX))
    return found.select("name", "question_id", F.array_join("dashboard_ids", ",").alias("dashboards"))


_CARDS = """CASE l_linenumber % 4 WHEN 0 THEN '{"id":1,"dashcards":[{},{}],"ordered_cards":[{}]}'
  WHEN 1 THEN '{"id":1,"dashcards":null,"ordered_cards":[{"card_id":1},{},{}]}'
  WHEN 2 THEN '{"id":1,"dashcards":[],"ordered_cards":[{}]}' ELSE '{"id":1}' END"""


@query("cards_count", """
SELECT l_orderkey AS n, CASE l_linenumber % 4 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 0 END AS cards_count FROM lineitem""")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select(
        V.parse(F.expr(_CARDS)).alias("raw"), seq_from_number(F.col("l_orderkey")).alias("seq")
    )
    return E.typed_dashboards(df).select(F.col("seq.row").alias("n"), "cards_count")


# --- the metadata job ---------------------------------------------------------

_JOB = {
    "acc": f"SELECT id, name FROM v_collections WHERE {_IN}",
    "dash": """SELECT o_orderkey, o_custkey, a.id AS cid, a.name AS cname FROM orders
  JOIN acc a ON a.id = CASE WHEN o_custkey % 27 = 0 THEN 'root' ELSE CAST(o_custkey % 27 AS VARCHAR) END
  WHERE o_orderkey % 17 <> 0""",
    "slots": """SELECT o_orderkey AS d, o_custkey AS card, 0 AS slot FROM dash WHERE o_custkey <> 0
  UNION ALL SELECT o_orderkey, o_custkey % 100, 2 FROM dash WHERE o_orderkey % 2 = 1 AND o_custkey % 100 <> 0""",
    "base": """SELECT p_partkey AS id, p_name AS name, p_brand, p_size, a.id AS cid, a.name AS cname,
  CASE WHEN p_partkey % 2 = 0 THEN 'native' ELSE 'query' END AS kind, s.s_suppkey, s.s_name, b.engine,
  p_partkey % 2 = 1 OR s.s_suppkey % 5 <> 4 AS ctx,
  s.s_suppkey IS NOT NULL AND p_partkey % 11 > 2 AS known
  FROM part JOIN acc a ON a.id = CASE WHEN p_size % 27 = 0 THEN 'root' ELSE CAST(p_size % 27 AS VARCHAR) END
  LEFT JOIN supplier s ON s.s_suppkey = CASE WHEN p_partkey % 13 = 0 THEN -1 ELSE p_partkey % 10 END
  LEFT JOIN v_databases b ON b.id = s.s_suppkey""",
    "quest": """SELECT CAST(b.id AS VARCHAR) AS id, name, p_brand AS description, nullif(p_size % 3, 0) AS creator, cid, cname, kind,
  CASE WHEN ctx AND b.id % 11 <> 3 THEN concat('SELECT * FROM ', replace(name, ' ', '_')) ELSE '' END AS query,
  CASE WHEN NOT ctx THEN '' ELSE CASE s_suppkey % 5 WHEN 0 THEN 'wh' WHEN 1 THEN 'sample' ELSE s_name END END AS db,
  CASE WHEN ctx AND s_suppkey % 5 = 0 THEN 'analytics' ELSE '' END AS sch,
  CASE WHEN NOT ctx THEN '' WHEN engine = 'bigquery-cloud-sdk' THEN 'bigquery' ELSE engine END AS eng,
  coalesce(k.n, 0) AS dashboards
  FROM base b LEFT JOIN (SELECT card, count(*) AS n FROM slots GROUP BY card) k ON k.card = b.id WHERE known""",
    "edges": """SELECT q.id, q.name, s.d, s.slot FROM quest q JOIN slots s ON CAST(s.card AS VARCHAR) = q.id""",
}


def _job_sql(body: str) -> str:
    return with_ctes(body, "v_collections", "v_databases", **_JOB)


_SYNC = (
    '"connectorName":"bi","connectionName":"BI","connectionQualifiedName":"default/bi/1",'
    '"lastSyncWorkflowName":"wf","lastSyncRun":"run-1","lastSyncRunAt":1700000000000,"tenantId":"default"'
)
_LINK = """',"biCollectionQualifiedName":"default/bi/1/collections/', cid, '","biCollectionName":"', cname, '",'"""
_RELATION = """'},"relationshipAttributes":{"biCollection":{"typeName":"BiCollection","uniqueAttributes":{"qualifiedName":"default/bi/1/collections/', cid, '"}}}}'"""
_CREATED = "1704067200000 + (o_orderkey % 9) * 86400000 + 36000500"


def _ref(type_name: str, expr: str) -> str:
    return f"""'{{"typeName":"{type_name}","uniqueAttributes":{{"qualifiedName":"', {expr}, '"}}}}'"""


_COLLECTION_SQL = f"""
SELECT 'BICOLLECTION' AS type_dir, concat('default/bi/1/collections/', c.id) AS qualified_name,
  concat('{{"typeName":"BiCollection","status":"ACTIVE","attributes":{{"name":"', c.name, '","qualifiedName":"default/bi/1/collections/', c.id,
    '","sourceURL":"https://bi.example.com/collection/', c.id, '","biSlug":"', c.slug, '",',
    CASE WHEN n.n_regionkey = 1 THEN '"biColor":"#509EE3",' ELSE '' END,
    '"biIsPersonalCollection":', CASE WHEN c.personal_owner_id IS NULL THEN 'false' ELSE 'true' END, ',{_SYNC}}}}}') AS json
FROM v_collections c JOIN nation n ON n.n_name = c.name WHERE c.{_IN}"""
_DASHBOARD_SQL = f"""
SELECT 'BIDASHBOARD' AS type_dir, concat('default/bi/1/dashboards/', o_orderkey) AS qualified_name,
  concat('{{"typeName":"BiDashboard","status":"ACTIVE","attributes":{{"name":"Dashboard ', o_orderkey, '","qualifiedName":"default/bi/1/dashboards/', o_orderkey,
    '","sourceURL":"https://bi.example.com/dashboard/', o_orderkey, '","sourceCreatedAt":', {_CREATED},
    CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE ',"sourceUpdatedBy":"ann"' END, ',"biQuestionCount":3', {_LINK}, '{_SYNC}', {_RELATION}) AS json
FROM dash"""
_QUESTION_SQL = f"""
SELECT 'BIQUESTION' AS type_dir, concat('default/bi/1/questions/', id) AS qualified_name,
  concat('{{"typeName":"BiQuestion","status":"ACTIVE","attributes":{{"name":"', name, '","qualifiedName":"default/bi/1/questions/', id,
    '","description":"', description, '","sourceURL":"https://bi.example.com/question/', id, '","biQuery":"', query, '","biQueryType":"', kind, '"',
    CASE WHEN creator IS NULL THEN '' ELSE concat(',"sourceCreatedBy":"', creator, '"') END, ',"biDashboardCount":', dashboards, {_LINK}, '{_SYNC}',
    ',"biSourceDatabaseName":"', db, '","biSourceSchemaName":"', sch, '"',
    CASE WHEN eng = '' THEN '' ELSE concat(',"biSourceEngine":"', eng, '"') END, {_RELATION}) AS json
FROM quest"""
_EDGE_SQL = f"""
SELECT 'BIPROCESS' AS type_dir, concat('default/bi/1/questions_dashboards/', id) AS qualified_name,
  concat('{{"typeName":"BIProcess","status":"ACTIVE","attributes":{{"name":"', name, '","qualifiedName":"default/bi/1/questions_dashboards/', id,
    '",{_SYNC},"inputs":[', {_ref("BiQuestion", "'default/bi/1/questions/', id")}, '],"outputs":[',
    string_agg(concat({_ref("BiDashboard", "'default/bi/1/dashboards/', d")}), ',' ORDER BY d, slot), ']}}}}') AS json
FROM edges GROUP BY id, name"""
_ALL_SQL = f"{_COLLECTION_SQL} UNION ALL {_DASHBOARD_SQL} UNION ALL {_QUESTION_SQL} UNION ALL {_EDGE_SQL}"


@query("enrich_dashboards", _job_sql("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, cid AS collection_id, cname AS collection_name FROM dash"""))
def _(spark, sf):
    return catalog(spark, sf).dashboards.select("id", "collection_id", "collection_name")


@query("enrich_questions", _job_sql("""
SELECT id, name, cid AS collection_id, cname AS collection_name, kind AS query_type, query,
  db AS database_name, sch AS schema_name, eng AS engine FROM quest"""))
def _(spark, sf):
    return catalog(spark, sf).question_context.select(
        "id", "name", "collection_id", "collection_name", "query_type", "query", "database_name", "schema_name", "engine"
    )


@query("rejected_questions", _job_sql("SELECT CAST(id AS VARCHAR) AS id, name FROM base WHERE NOT known"))
def _(spark, sf):
    return catalog(spark, sf).rejected


@query("project_collections", _job_sql(f"""
SELECT c.id, c.name, c.slug, CASE WHEN n.n_regionkey = 1 THEN '#509EE3' END AS color,
  concat('https://bi.example.com/collection/', c.id) AS source_url, c.personal_owner_id IS NOT NULL AS is_personal
FROM v_collections c JOIN nation n ON n.n_name = c.name WHERE c.{_IN}"""))
def _(spark, sf):
    return N.project_collections(catalog(spark, sf).collections).drop("description", "namespace")


@query("project_dashboards", _job_sql(f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, concat('Dashboard ', o_orderkey) AS name, 3 AS cards_count, cid AS collection_id,
  cname AS collection_name, CAST({_CREATED} AS BIGINT) AS created_ms, CASE WHEN o_orderkey % 5 <> 0 THEN 'ann' END AS updated_by FROM dash"""))
def _(spark, sf):
    return N.project_dashboards(catalog(spark, sf).dashboards).select(
        "id", "name", "cards_count", "collection_id", "collection_name", "created_ms", "updated_by"
    )


@query("project_questions", _job_sql("""
SELECT id, name, description, query_text AS query, CAST(dashboards AS BIGINT) AS dashboard_count, CAST(creator AS VARCHAR) AS created_by
FROM (SELECT *, query AS query_text FROM quest) q"""))
def _(spark, sf):
    return N.project_questions(catalog(spark, sf).questions).select(
        "id", "name", "description", "query", F.col("dashboard_count").cast("bigint").alias("dashboard_count"), "created_by"
    )


@query("entity_collections", _job_sql(_COLLECTION_SQL))
def _(spark, sf):
    return N.entity_collections(catalog(spark, sf).collections, CTX)


@query("entity_dashboards", _job_sql(_DASHBOARD_SQL))
def _(spark, sf):
    return N.entity_dashboards(catalog(spark, sf).dashboards, CTX)


@query("entity_questions", _job_sql(_QUESTION_SQL))
def _(spark, sf):
    return N.entity_questions(catalog(spark, sf).questions, CTX)


@query("entity_bi_process", _job_sql(_EDGE_SQL))
def _(spark, sf):
    return N.entity_bi_process(catalog(spark, sf).edges, CTX)


@query("all_entities", _job_sql(_ALL_SQL))
def _(spark, sf):
    return catalog(spark, sf).entities


@query("all_entities_staged", _job_sql(_ALL_SQL))
def _(spark, sf):
    return run_metadata(landed(spark, sf), SELECTION, CTX, stage_root=shared_folder(spark, "stage")).entities


def landed_lists(spark, sf) -> Landed:
    return Landed.from_responses(
        pages(spark, sf, "l_collections", "/api/collection"),
        pages(spark, sf, "l_dashboards", "/api/dashboard"),
        pages(spark, sf, "l_questions", "/api/card"),
        pages(spark, sf, "l_databases", "/api/database", envelope="data"),
        responses(spark, sf, "l_dashboard_details"),
        responses(spark, sf, "l_question_queries"),
    )


# Dashboards arrive in lists, last id first, and edges keep that order.
@query("all_entities_landed", _job_sql(_ALL_SQL.replace("ORDER BY d, slot", "ORDER BY d DESC, slot")))
def _(spark, sf):
    return run_metadata(landed_lists(spark, sf), SELECTION, CTX, stage_root=shared_folder(spark, "stage")).entities


@query("landed_residuals", _job_sql("""
SELECT unnest(['collections', 'dashboards', 'questions', 'databases']) || '_fetch_failed' AS category, CAST(1 AS BIGINT) AS n
UNION ALL SELECT 'dashboard_detail_fetch_failed', count(*) FROM orders
  JOIN acc a ON a.id = CASE WHEN o_custkey % 27 = 0 THEN 'root' ELSE CAST(o_custkey % 27 AS VARCHAR) END WHERE o_orderkey % 17 = 0 AND o_orderkey <> 0
UNION ALL SELECT CASE WHEN p_partkey % 11 = 0 THEN 'question_query_fetch_failed' ELSE 'question_query_fetch_errored' END, count(*) FROM part
  JOIN acc a ON a.id = CASE WHEN p_size % 27 = 0 THEN 'root' ELSE CAST(p_size % 27 AS VARCHAR) END WHERE p_partkey % 11 IN (0, 2) GROUP BY 1"""))
def _(spark, sf):
    lost = run_metadata(landed_lists(spark, sf), SELECTION, CTX, stage_root=shared_folder(spark, "stage")).residuals
    return lost.groupBy("category").agg(F.count("*").alias("n"))


@query("entity_sink_counts", _job_sql(f"SELECT type_dir, count(*) AS n FROM ({_ALL_SQL}) e GROUP BY type_dir"))
def _(spark, sf):
    counts = write_entities(catalog(spark, sf).entities, shared_folder(spark, "entities"), CTX.names.entity_types)
    return spark.createDataFrame([(d, n) for d, n in counts.items() if n], "type_dir string, n long")


# Every line of every type, from the folders by type.
@query("entity_sink_lines", _job_sql(f"SELECT type_dir, json FROM ({_ALL_SQL}) e"))
def _(spark, sf):
    root = shared_folder(spark, "entities")
    write_entities(catalog(spark, sf).entities, root, CTX.names.entity_types, exact_layout=True)
    lines = [
        spark.read.text(f"{root}/transformed/{d.upper()}/chunk=0").select(F.lit(d.upper()).alias("type_dir"), F.col("value").alias("json"))
        for d in CTX.names.entity_types
    ]
    return reduce(DataFrame.unionByName, lines)


# Totals as the stage writes of one run counted them.
@query("run_totals", _job_sql(f"""
SELECT 'filter' AS stage, CAST((SELECT count(*) FROM v_collections WHERE {_IN}) + (SELECT count(*) FROM supplier)
  + (SELECT count(*) FROM orders JOIN acc a ON a.id = CASE WHEN o_custkey % 27 = 0 THEN 'root' ELSE CAST(o_custkey % 27 AS VARCHAR) END)
  + (SELECT count(*) FROM part JOIN acc a ON a.id = CASE WHEN p_size % 27 = 0 THEN 'root' ELSE CAST(p_size % 27 AS VARCHAR) END) AS BIGINT) AS n
UNION ALL SELECT 'enrich', count(*) FROM ({_ALL_SQL}) e"""))
def _(spark, sf):
    out = catalog(spark, sf)
    write_entities(out.entities, shared_folder(spark, "entities"), CTX.names.entity_types)
    return spark.createDataFrame(list(out.totals.items()), "stage string, n long")


# Between two landed states questions come (id % 10 = 4), go (3) and get another description (id % 7 = 0).
@query("metadata_changes", _job_sql("""
SELECT 'BIQUESTION' AS type_dir, concat('default/bi/1/questions/', id) AS qualified_name,
  CASE CAST(id AS BIGINT) % 10 WHEN 4 THEN 'added' WHEN 3 THEN 'removed' ELSE 'changed' END AS status,
  CASE WHEN CAST(id AS BIGINT) % 10 = 3 THEN NULL WHEN CAST(id AS BIGINT) % 7 = 0 THEN concat('new ', description) ELSE description END AS description
FROM quest WHERE CAST(id AS BIGINT) % 10 IN (3, 4) OR CAST(id AS BIGINT) % 7 = 0
UNION ALL SELECT DISTINCT 'BIPROCESS', concat('default/bi/1/questions_dashboards/', id),
  CASE CAST(id AS BIGINT) % 10 WHEN 4 THEN 'added' ELSE 'removed' END, NULL FROM edges WHERE CAST(id AS BIGINT) % 10 IN (3, 4)"""))
def _(spark, sf):
    given, lines = landed(spark, sf), view(spark, sf, "l_questions")
    renamed = F.replace(F.col("value"), F.lit('"description":"'), F.lit('"description":"new '))
    value = F.when(F.col("n") % 7 == 0, renamed).otherwise(F.col("value"))

    def entities(questions):
        raw = bind(questions.select("value", seq_from_number(F.col("n")).alias("seq")), raw=V.parse(F.col("value")))
        return run_metadata(replace(given, questions=raw.select("raw", "seq")), SELECTION, CTX).entities

    root = shared_folder(spark, "runs")
    run_incremental(entities(lines.filter("n % 10 <> 4")), root, "first")
    found = run_incremental(entities(lines.filter("n % 10 <> 3").withColumn("value", value)), root, "second", before="first")
    return found.select("type_dir", "qualified_name", "status", F.get_json_object("json", "$.attributes.description").alias("description"))


@query("entity_dispatch", _job_sql(f"SELECT * FROM ({_QUESTION_SQL}) q"))
def _(spark, sf):
    questions = catalog(spark, sf).questions
    return N.map_entities(questions, "BIQUESTION", CTX).unionByName(N.map_entities(questions, "SOMETHINGELSE", CTX))


@query("sync_stamp", """
SELECT p_partkey AS id, 'bi' AS "connectorName", 'BI' AS "connectionName", 'default/bi/1' AS "connectionQualifiedName",
  'wf' AS "lastSyncWorkflowName", 'run-1' AS "lastSyncRun", CAST(1700000000000 AS BIGINT) AS "lastSyncRunAt", 'default' AS "tenantId"
FROM part""")
def _(spark, sf):
    return N.sync_stamp(table(spark, sf, "part").select(F.col("p_partkey").alias("id")), CTX)


# Relations vanish with the last of them; null attributes are left out.
@query("entity_envelope", """
SELECT 'XYZQUESTION' AS type_dir, concat('q/', p_partkey) AS qualified_name,
  concat('{"typeName":"XyzQuestion","status":"ACTIVE","attributes":{"qualifiedName":"q/', p_partkey, '"',
    CASE WHEN p_size % 2 = 0 THEN concat(',"size":', p_size) ELSE '' END, '}',
    CASE WHEN p_size % 3 = 0 THEN concat(',"relationshipAttributes":{"up":"', p_size, '"}') ELSE '' END, '}') AS json
FROM part""")
def _(spark, sf):
    size = F.col("p_size")
    return N.envelope(
        table(spark, sf, "part"),
        WireNames(product="xyz").question,
        {
            "qualifiedName": F.concat(F.lit("q/"), F.col("p_partkey").cast("string")),
            "size": F.when(size % 2 == 0, size),
        },
        {"up": F.when(size % 3 == 0, size.cast("string")), "down": F.lit(None).cast("string")},
    )
