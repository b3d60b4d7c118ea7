"""Queries of sources, selection and readiness."""

from __future__ import annotations

from pyspark.sql import functions as F

from catloom.functions import variants as V
from catloom.functions.ordering import last_wins, seq_from_number
from catloom.operators import enrich as E
from catloom.operators import quality as Q
from catloom.operators import selection as S
from catloom.operators.lineage import identified, read_header
from catloom.plans.pipeline import run_preflight
from catloom.plans.registry import query
from catloom.plans.views import pages, responses, rows, table, view, with_ctes
from catloom.session import shared_folder
from catloom.sources import landing as L
from catloom.sources.ndjson import parse_lines, read_ndjson, read_ndjson_tree, write_ndjson

SELECTION = S.Selection.parse(include={str(i): {} for i in [*range(1, 15), "root"]}, exclude='{"3": {}, "9": {}}')
_IN = "id IN ('root','1','2','4','5','6','7','8','10','11','12','13','14')"

_LINE = "CASE event_id % 50 WHEN 0 THEN 'not-json' WHEN 1 THEN '   ' ELSE props END"


def _event_lines(spark, sf):
    return table(spark, sf, "events").select(
        F.expr(_LINE).alias("value"), seq_from_number(F.col("event_id")).alias("seq")
    )


@query("ndjson_scan", """
SELECT event_id AS n, event_id % 50 <> 0 AS parsed, CASE WHEN event_id % 50 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k
FROM events WHERE event_id % 50 <> 1""")
def _(spark, sf):
    good, bad = parse_lines(_event_lines(spark, sf))
    n = F.col("seq.row").alias("n")
    return good.select(n, F.lit(True).alias("parsed"), V.at(F.col("raw"), "$.k", "bigint").alias("k")).unionByName(
        bad.select(n, F.lit(False).alias("parsed"), F.lit(None).cast("bigint").alias("k"))
    )


@query("ndjson_roundtrip", """
SELECT replace(props, ' ', '') AS record, count(*) AS n FROM events WHERE event_id % 50 > 1 GROUP BY 1""")
def _(spark, sf):
    path = shared_folder(spark, "ndjson")
    write_ndjson(parse_lines(_event_lines(spark, sf))[0], path)
    return read_ndjson(spark, path)[0].groupBy(F.to_json("raw").alias("record")).agg(F.count("*").alias("n"))


@query("ndjson_tree_scan", """
SELECT replace(props, ' ', '') AS record, true AS parsed, count(*) AS n FROM events WHERE event_id % 50 > 1 GROUP BY 1
UNION ALL SELECT 'not-json', false, count(*) FROM events WHERE event_id % 50 = 0""")
def _(spark, sf):
    root = shared_folder(spark, "tree")
    lines = table(spark, sf, "events").select("event_type", F.expr(_LINE).alias("value"))
    lines.write.partitionBy("event_type").text(root)
    good, bad = read_ndjson_tree(spark, root, pattern="*.txt")
    both = good.select(F.to_json("raw").alias("record"), F.lit(True).alias("parsed")).unionByName(
        bad.select(F.col("value").alias("record"), F.lit(False).alias("parsed"))
    )
    return both.groupBy("record", "parsed").agg(F.count("*").alias("n"))


@query("unwrap_array", """
SELECT event_id AS n, 0 AS item, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events WHERE event_type <> 'error' AND event_id % 3 = 0""")
def _(spark, sf):
    got, _ = L.unwrap_responses(responses(spark, sf, "l_events"), "collection")
    return got.select(F.col("seq.row").alias("n"), F.col("seq.item").alias("item"), V.at(F.col("raw"), "$.k", "bigint").alias("k"))


@query("unwrap_envelope", """
SELECT event_id AS n, i AS item, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events, (VALUES (0), (1)) t(i) WHERE event_type <> 'error' AND event_id % 3 < 2 AND i <= event_id % 3""")
def _(spark, sf):
    got, _ = L.unwrap_responses(responses(spark, sf, "l_events"), "database", envelope="data")
    return got.select(F.col("seq.row").alias("n"), F.col("seq.item").alias("item"), V.at(F.col("raw"), "$.k", "bigint").alias("k"))


@query("detail_worklist", """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_size AS size FROM part WHERE p_partkey <> 0 AND p_size % 4 <> 0""")
def _(spark, sf):
    df = table(spark, sf, "part").select(
        F.when(F.col("p_size") % 4 != 0, F.col("p_partkey").cast("string")).alias("id"), F.col("p_size").alias("size")
    )
    return L.detail_worklist(df)


_MAYBE_QUERY = "CASE p_partkey % 5 WHEN 0 THEN '{}' WHEN 1 THEN 'null' WHEN 2 THEN NULL ELSE '{\"type\":\"native\"}' END"


@query("query_worklist", """
SELECT p_partkey AS id FROM part WHERE p_partkey % 5 > 2 AND p_size % 7 <> 0""")
def _(spark, sf):
    df = table(spark, sf, "part").select(
        F.when(F.col("p_size") % 7 != 0, F.col("p_partkey")).alias("id"), V.parse(F.expr(_MAYBE_QUERY)).alias("dataset_query")
    )
    return L.query_worklist(df).select("id")


@query("hydrate_detail", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, concat('Dashboard ', o_orderkey) AS name FROM orders WHERE o_orderkey % 17 <> 0""")
def _(spark, sf):
    summaries = E.typed_summaries(rows(spark, sf, "l_dashboards"))
    got, _ = L.hydrate(summaries, responses(spark, sf, "l_dashboard_details"), "dashboard")
    return got.select("id", V.at(F.col("raw"), "$.name").alias("name"))


@query("hydrate_queries", """
SELECT CAST(p_partkey AS VARCHAR) AS question_id,
  CASE WHEN p_partkey % 11 = 3 THEN '' ELSE concat('SELECT * FROM ', replace(p_name, ' ', '_')) END AS query,
  CASE WHEN p_partkey % 11 = 3 THEN NULL ELSE '[1]' END AS params
FROM part WHERE p_partkey % 11 > 2""")
def _(spark, sf):
    questions = E.typed_questions(rows(spark, sf, "l_questions"))
    got, _ = L.hydrate_queries(questions, responses(spark, sf, "l_question_queries"))
    return got.drop("seq")


@query("residual_split", """
SELECT 'collections_fetch_failed' AS category, '/api/collection' AS endpoint, CAST(event_id AS VARCHAR) AS record_id, 500 AS http_status
FROM events WHERE event_type = 'error'
UNION ALL SELECT 'dashboard_detail_fetch_failed', '/api/dashboard', CAST(o_orderkey AS VARCHAR), 404 FROM orders WHERE o_orderkey % 17 = 0 AND o_orderkey <> 0
UNION ALL SELECT CASE WHEN p_partkey % 11 = 0 THEN 'question_query_fetch_failed' ELSE 'question_query_fetch_errored' END,
  '/api/dataset/native', CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 11 = 0 THEN 500 END
FROM part WHERE p_partkey % 11 IN (0, 2)""")
def _(spark, sf):
    _, lists = L.unwrap_responses(responses(spark, sf, "l_events"), "collection")
    summaries = E.typed_summaries(rows(spark, sf, "l_dashboards"))
    _, details = L.hydrate(summaries, responses(spark, sf, "l_dashboard_details"), "dashboard")
    questions = E.typed_questions(rows(spark, sf, "l_questions"))
    _, queries = L.hydrate_queries(questions, responses(spark, sf, "l_question_queries"))
    return lists.unionByName(details).unionByName(queries).drop("timestamp", "length")


# Pages of up to 1500 elements of 28,000 characters, and one of 21 million, which no parser call holds.
_PAGE, _PAD, _LONG = 1500, 28000, 21000000


@query("oversize_lists", f"""
SELECT 'dashboard' AS kind, c_custkey AS id, CAST({_PAD} AS BIGINT) AS size FROM customer
UNION ALL SELECT 'oversize', NULL, CAST(length('{{"id":' || CAST(-(p) AS VARCHAR) || ',"pad":""}}') + {_LONG} AS BIGINT)
FROM (SELECT DISTINCT c_custkey // {_PAGE} AS p FROM customer) pages""")
def _(spark, sf):
    page = F.expr(f"c_custkey DIV {_PAGE}")
    # Texts are made behind the shuffle, of the rows: the driver would fold a constant one of that length into the plan.
    # The shuffle's size tells nothing of the pages', so their number of tasks is fixed.
    dealt = table(spark, sf, "customer").select("c_custkey", page.alias("page")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "page")
    lists = dealt.groupBy("page").agg(F.collect_list(F.struct("c_custkey")).alias("ids"))
    pad = F.repeat(F.lit("x"), F.least(F.lit(_LONG), _LONG + F.size("ids")))

    def element(ident, pad):
        return F.concat(F.lit('{"id":'), F.coalesce(ident.cast("string"), F.lit("null")), F.lit(',"pad":"'), pad, F.lit('"}'))

    elements = F.transform("ids", lambda x: element(x["c_custkey"], F.repeat(F.lit("x"), F.lit(_PAD))))
    body = F.concat(F.lit('{"data":['), F.concat_ws(",", elements), F.lit(","), element(-F.col("page"), pad), F.lit("]}"))
    landed = lists.select(
        F.lit("/api/dashboard").alias("endpoint"), F.lit(None).cast("string").alias("record_id"),
        F.lit(200).alias("http_status"), body.alias("body"), seq_from_number(F.col("page")).alias("seq"),
    )
    got, lost = L.unwrap_responses(landed, "dashboard", envelope="data")
    listed = got.select(F.lit("dashboard").alias("kind"), V.at(F.col("raw"), "$.id", "long").alias("id"), F.length(V.at(F.col("raw"), "$.pad")).cast("long").alias("size"))
    return listed.union(lost.select("category", F.lit(None).cast("long"), "length"))


# Every page is longer than the bound given here, so each is cut before it is parsed.
@query("cut_lists", """
SELECT o_orderkey AS id, concat('Dashboard ', CAST(o_orderkey AS VARCHAR)) AS name, nullif(o_custkey % 27, 0) AS collection_id FROM orders
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def _(spark, sf):
    def read(name: str, envelope: str | None):
        landed = pages(spark, sf, name, "/api", envelope, failing=False)
        raw, _ = L.unwrap_responses(landed, "dashboard", envelope, holds=64)
        return raw.select(*[V.at(F.col("raw"), f"$.{k}", t).alias(k) for k, t in (("id", "long"), ("name", "string"), ("collection_id", "long"))])

    return read("l_dashboards", None).union(read("l_databases", "data"))


@query("last_wins", """
SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority
FROM orders GROUP BY o_custkey""")
def _(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", seq_from_number(F.col("o_orderkey")).alias("seq")
    )
    return last_wins(df, "o_custkey").drop("seq")


@query("filter_collections", with_ctes(f"SELECT * FROM v_collections WHERE {_IN}", "v_collections"))
def _(spark, sf):
    return S.filter_collections(view(spark, sf, "v_collections"), SELECTION)


@query("accepted_ids", with_ctes(f"SELECT DISTINCT id FROM v_collections WHERE {_IN}", "v_collections"))
def _(spark, sf):
    return S.accepted_ids(S.filter_collections(view(spark, sf, "v_collections"), SELECTION))


@query("databases_passthrough", with_ctes("SELECT * FROM v_databases", "v_databases"))
def _(spark, sf):
    return S.databases(view(spark, sf, "v_databases"))


@query("non_personal_collections", with_ctes("""
SELECT id AS value, name AS title, 'collection' AS node_type FROM v_collections
WHERE personal_owner_id IS NULL OR personal_owner_id = 0""", "v_collections"))
def _(spark, sf):
    return S.non_personal(view(spark, sf, "v_collections"))


def _accepted(spark, sf):
    return S.accepted_ids(S.filter_collections(view(spark, sf, "v_collections"), SELECTION))


_KEY = "coalesce(CAST(collection_id AS VARCHAR), 'root')"


@query("cascade_dashboards", with_ctes(f"""
SELECT id, name, collection_id FROM v_dashboards WHERE {_KEY} IN (SELECT id FROM v_collections WHERE {_IN})""",
    "v_dashboards", "v_collections"))
def _(spark, sf):
    return S.cascade(view(spark, sf, "v_dashboards"), _accepted(spark, sf)).drop("created_at")


@query("cascade_questions", with_ctes(f"""
SELECT id, name, collection_id FROM v_questions WHERE {_KEY} IN (SELECT id FROM v_collections WHERE {_IN})""",
    "v_questions", "v_collections"))
def _(spark, sf):
    return S.cascade(view(spark, sf, "v_questions"), _accepted(spark, sf)).select("id", "name", "collection_id")


@query("cascade_keeps_all_when_empty", with_ctes("SELECT id, collection_id FROM v_dashboards", "v_dashboards"))
def _(spark, sf):
    nothing = S.filter_collections(view(spark, sf, "v_collections"), S.Selection.parse(include={"none": {}}))
    return S.cascade(view(spark, sf, "v_dashboards"), S.accepted_ids(nothing), empty_means_all=True).select("id", "collection_id")


@query("identified_records", """
SELECT concat('default/bi/1/questions/', l_partkey) AS question_qn, count(*) AS n FROM lineitem WHERE l_suppkey % 20 <> 0 GROUP BY 1""")
def _(spark, sf):
    header = read_header(F.col("raw"))
    records = rows(spark, sf, "l_parsed").select(header["question_qn"].alias("question_qn"))
    return identified(records).groupBy("question_qn").agg(F.count("*").alias("n"))


_PICK = S.Selection.parse(include={str(i): {} for i in [*range(0, 20), "root", "None"]}, exclude={"3": {}})
_PICKED = "IN ('root','None','0','1','2','4','5','6','7','8','9','10','11','12','13','14','15','16','17','18','19')"
_ITEM_COUNT = f"""SELECT count(*) FROM {{}} WHERE coalesce(CAST(collection_id AS VARCHAR), 'None') {_PICKED}
  AND coalesce(CAST(collection_id AS VARCHAR), 'None') NOT IN (SELECT id FROM v_collections WHERE personal_owner_id IS NOT NULL)"""
_COUNTS = f"""
SELECT 'collections' AS name, count(*) AS n FROM v_collections WHERE personal_owner_id IS NULL AND id {_PICKED}
UNION ALL SELECT 'permissions', count(*) FROM v_databases WHERE native_permissions <> 'write'
UNION ALL SELECT 'dashboards', ({_ITEM_COUNT.format("v_dashboards")})
UNION ALL SELECT 'questions', ({_ITEM_COUNT.format("v_questions")})"""
_PREFLIGHT_VIEWS = ("v_collections", "v_dashboards", "v_questions", "v_databases")


def _counts(spark, sf):
    return Q.preflight_counts(
        view(spark, sf, "v_collections"), view(spark, sf, "v_dashboards"),
        view(spark, sf, "v_questions"), view(spark, sf, "v_databases"), _PICK,
    )


for _name in ("collections", "dashboards", "questions"):

    def _one(spark, sf, name=_name):
        return _counts(spark, sf).filter(F.col("name") == name)

    query(f"preflight_{_name}", with_ctes(f"SELECT * FROM ({_COUNTS}) c WHERE name = '{_name}'", *_PREFLIGHT_VIEWS))(_one)


@query("native_permissions", with_ctes("SELECT name FROM v_databases WHERE native_permissions <> 'write'", "v_databases"))
def _(spark, sf):
    return Q.missing_native_permission(view(spark, sf, "v_databases"))


# Passing means: the list landed, whatever it counts, and no permission missing.
@query("readiness", with_ctes(f"""
SELECT CASE WHEN p > 0 THEN 'NOT_READY' ELSE 'READY' END AS status, true AS collections_ok, p = 0 AS permissions_ok,
  CASE WHEN p = 0 THEN true END AS dashboards_ok, CASE WHEN p = 0 THEN true END AS questions_ok
FROM (SELECT n AS p FROM ({_COUNTS}) x WHERE name = 'permissions') y""",
    *_PREFLIGHT_VIEWS))
def _(spark, sf):
    passed = (F.col("name") != "permissions") | (F.col("n") == 0)
    return Q.readiness(_counts(spark, sf).select("name", passed.alias("passed")))


# From list responses. One response of the questions failed, so they have no count.
_LANDED_KEYS = f"""coalesce(CAST(nullif(o_custkey % 27, 0) AS VARCHAR), 'None')"""


@query("preflight_landed", with_ctes(f"""
SELECT name, CASE WHEN name <> 'questions' THEN n END AS n, name <> 'questions' AND (name <> 'permissions' OR n = 0) AS passed
FROM (SELECT name, n FROM ({_COUNTS}) x WHERE name <> 'dashboards'
  UNION ALL SELECT 'dashboards', count(*) FROM orders WHERE {_LANDED_KEYS} {_PICKED}
    AND {_LANDED_KEYS} NOT IN (SELECT id FROM v_collections WHERE personal_owner_id IS NOT NULL)) y""", *_PREFLIGHT_VIEWS))
def _(spark, sf):
    return run_preflight(
        pages(spark, sf, "l_collections", "/api/collection", failing=False),
        pages(spark, sf, "l_dashboards", "/api/dashboard", failing=False),
        pages(spark, sf, "l_questions", "/api/card"),
        pages(spark, sf, "l_databases", "/api/database", envelope="data", failing=False),
        _PICK,
    )[0]


@query("stage_totals", with_ctes(f"""
SELECT 'filter' AS stage, CAST((SELECT count(*) FROM v_collections WHERE {_IN}) + (SELECT count(*) FROM v_databases)
  + (SELECT count(*) FROM v_dashboards WHERE {_KEY} IN (SELECT id FROM v_collections WHERE {_IN}))
  + (SELECT count(*) FROM v_questions WHERE {_KEY} IN (SELECT id FROM v_collections WHERE {_IN})) AS BIGINT) AS n
UNION ALL SELECT 'extract', CAST((SELECT count(*) FROM v_collections) + (SELECT count(*) FROM v_databases)
  + (SELECT count(*) FROM v_dashboards) + (SELECT count(*) FROM v_questions) AS BIGINT)""", *_PREFLIGHT_VIEWS))
def _(spark, sf):
    c, d, q, b = (view(spark, sf, n) for n in _PREFLIGHT_VIEWS)
    kept = S.filter_collections(c, SELECTION)
    ids = S.accepted_ids(kept)
    return Q.stage_totals(extract=[c, d, q, b], filter=[kept, S.cascade(d, ids), S.cascade(q, ids), S.databases(b)])
