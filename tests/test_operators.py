import dataclasses
import hashlib
import json
import random
import re
import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from catloom import RunContext, WireNames
from catloom.functions import variants as V
from catloom.functions.ordering import last_wins, seq_from_number, with_slot
from catloom.operators import enrich as E
from catloom.operators import entities as N
from catloom.operators import lineage as G
from catloom.operators import quality as Q
from catloom.operators import resolve as R
from catloom.operators import selection as S
from catloom.plans.incremental import run_incremental
from catloom.plans.pipeline import Landed, run_metadata, run_preflight, with_connection
from catloom.session import configure
from catloom.sources import landing as L

CTX = RunContext(connection_qn="c", connection_name="n", host="h", run_at_ms=1)


def raw_rows(spark, *records):
    configure(spark)
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "n int, value string")
    return df.select(V.parse(F.col("value")).alias("raw"), seq_from_number(F.col("n")).alias("seq"))


def responses(spark, *rows):
    df = spark.createDataFrame(
        [(i, "/e", str(k), 200, json.dumps(b)) for i, (k, b) in enumerate(rows)],
        "n int, endpoint string, record_id string, http_status int, body string",
    )
    return df.select("endpoint", "record_id", "http_status", "body", seq_from_number(F.col("n")).alias("seq"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- selection ----------------------------------------------------------------


@pytest.mark.parametrize("value, keys", [
    (None, []), ("", []), ("  ", []), ("[object Object]", []), ("not json", []), ({1: {}, "a": {}}, ["1", "a"]),
    ('{"5":{}}', ["5"]),
])
def test_selection_argument(value, keys):
    assert sorted(S.selection_keys(value)) == keys


def test_selection_that_is_no_object():
    with pytest.raises(ValueError):
        S.selection_keys("[1]")
    assert S.selection_keys("[1]", strict=False) == frozenset()


def test_selection_settings_take_either_spelling_and_the_first_that_names_ids():
    sel = S.Selection.from_settings({"include-collections": ""}, {"exclude_collections": '{"2": {}}'})
    assert sel == S.Selection(frozenset(), frozenset({"2"}))
    assert S.Selection.from_settings({"include-collections": {"1": {}}}, {"include_collections": {"2": {}}}).include == {"1"}


@pytest.mark.parametrize("include, exclude, kept", [
    ({}, {}, ["1", "2", "root"]), ({"1": {}}, {}, ["1"]), ({}, {"root": {}}, ["1", "2"]), ({"1": {}, "2": {}}, {"1": {}}, ["2"]),
])
def test_collections_exclude_beats_include(spark, include, exclude, kept):
    df = spark.createDataFrame([("root",), ("1",), ("2",)], "id string")
    assert sorted(r.id for r in S.filter_collections(df, S.Selection.parse(include, exclude)).collect()) == kept


def test_cascade_is_a_semi_join_and_null_is_root(spark):
    items = spark.createDataFrame([(1, None), (2, 0), (3, 5), (4, 6)], "id int, collection_id int")
    accepted = spark.createDataFrame([("root",), ("5",)], "id string")
    kept = S.cascade(items, accepted)
    assert sorted(r.id for r in kept.collect()) == [1, 2, 3]
    assert "LeftSemi" in plan(kept)
    none = accepted.limit(0)
    assert S.cascade(items, none).count() == 0
    assert S.cascade(items, none, empty_means_all=True).count() == 4
    assert S.cascade(items, accepted, empty_means_all=True).count() == 3


# --- enrichment ---------------------------------------------------------------


def test_last_record_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)], "k string, n int, v string")
    rows = last_wins(df.withColumn("seq", seq_from_number(F.col("n"))), "k").select("k", "v").collect()
    assert sorted(map(tuple, rows)) == [("a", "z"), ("b", None)]


def test_query_kind_over_formats(spark):
    cases = {
        '{"type":"native"}': "native", '{"type":"query"}': "query", '{"type":"","stages":[{"lib/type":"mbql.stage/native"}]}': "native",
        '{"stages":[{"lib/type":"mbql.stage/mbql"}]}': "query", '{"stages":[]}': "", "{}": "", '{"stages":[{"lib/type":"other"}]}': "",
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    rows = df.select("i", E.query_kind(V.parse(F.col("t"))).alias("k")).orderBy("i").collect()
    assert [r.k for r in rows] == list(cases.values())


def landed(spark):
    card = {"card_id": 7, "card": {"id": 7}}
    return Landed(
        collections=raw_rows(spark, {"id": "root", "name": "Our"}, {"id": 1, "name": "One", "personal_owner_id": 0}, {"id": 2, "name": "Two"}),
        dashboards=raw_rows(spark, {"id": 10, "collection_id": None}, {"id": 11, "collection_id": 1}, {"id": 12, "collection_id": 2}),
        questions=raw_rows(
            spark,
            {"id": 7, "name": "Q7", "collection_id": 1, "database_id": 1, "dataset_query": {"type": "native"}},
            {"id": 8, "name": "Q8", "collection_id": 1, "database_id": 2, "dataset_query": {"type": "native"}},
            {"id": 9, "name": "Q9", "collection_id": 1, "database_id": 3, "dataset_query": {"type": "query"}},
        ),
        databases=raw_rows(spark, {"id": 1, "name": "D1", "engine": "h2", "details": None}, {"id": 2, "name": "D2", "engine": "mysql"}),
        dashboard_details=responses(
            spark,
            (10, {"id": 10, "name": "A", "dashcards": [card, {"card_id": None}, card, {"card_id": 8, "card": None}], "ordered_cards": [card]}),
            (11, {"id": 11, "name": "B", "collection_id": 1, "ordered_cards": [card]}),
            (12, {"id": 12, "name": "C", "collection_id": 2, "dashcards": [card]}),
        ),
        question_queries=responses(spark, (7, {"query": "SELECT 1"}), (8, {"query": "SELECT 2"}), (9, {"query": "SELECT 3"})),
    )


def test_metadata_job(spark, tmp_path):
    sel = S.Selection.parse(exclude={"2": {}})
    out = run_metadata(landed(spark), sel, CTX)
    assert {(r.id, r.cards_count) for r in out.dashboards.collect()} == {("10", 4), ("11", 1)}
    got = {r.id: (r.query, r.database_name, r.engine, r.dashboard_count) for r in out.questions.collect()}
    # The native question on a database without details has no context.
    assert got == {"7": ("SELECT 1", "D1", "h2", 3), "8": ("", "", "", 0)}
    assert [(r.id, r.name) for r in out.rejected.collect()] == [("9", "Q9")]
    (edge,) = out.edges.collect()
    assert [o.uniqueAttributes.qualifiedName for o in edge.outputs] == ["c/dashboards/10", "c/dashboards/10", "c/dashboards/11"]
    entities = sorted(tuple(r) for r in out.entities.collect())
    assert len(entities) == 2 + 2 + 2 + 1
    staged = run_metadata(landed(spark), sel, CTX, stage_root=str(tmp_path))
    assert sorted(tuple(r) for r in staged.entities.collect()) == entities


def test_stages_are_written_once_and_only_if_asked_for(spark, tmp_path, monkeypatch):
    given = landed(spark)
    names = [f.name for f in dataclasses.fields(given) if f.name != "lost"]
    for name in names:
        getattr(given, name).write.parquet(f"{tmp_path}/{name}.in")
    stored = Landed(**{name: spark.read.parquet(f"{tmp_path}/{name}.in") for name in names})
    written, write = {}, DataFrameWriter.parquet

    def spy(self, path, *args, **kwargs):
        assert path.rsplit("/", 1)[1] not in written
        written[path.rsplit("/", 1)[1]] = self._df._jdf.queryExecution().executedPlan().toString()
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    length = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    out = run_metadata(stored, S.Selection(), CTX, stage_root=str(tmp_path / "run"))
    assert not written and out.totals == {}
    assert out.question_context.count() and out.rejected.count() >= 0
    assert set(written) == {"collections", "wanted_questions", "databases", "question_context"}
    assert not any("dashboard_details.in" in p for p in written.values())
    for part in (out.entities, out.collections, out.dashboards, out.questions, out.edges, out.rejected, out.residuals):
        assert ".in" not in plan(part)
        part.collect()
    spark.conf.set("spark.sql.maxMetadataStringLength", length)
    for name in names:
        assert 1 <= sum(p.count(f"/{name}.in") for p in written.values()) <= 2, name
    assert out.totals == {
        "filter": sum(len(spark.read.parquet(f"{tmp_path}/run/processed/{n}").collect()) for n in ("collections", "summaries", "wanted_questions", "databases")),
        "enrich": sum(x.count() for x in (out.collections, out.dashboards, out.questions, out.edges)),
    }
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    assert out.totals and len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before


def test_a_run_emits_what_changed_since_the_one_before(spark, tmp_path):
    def entities(*rows):
        return spark.createDataFrame([("Q", *r) for r in rows], "type_dir string, qualified_name string, json string")

    def run(name, before, *rows):
        found = run_incremental(entities(*rows), str(tmp_path), name, before).collect()
        return sorted((r.qualified_name, r.status, r.json) for r in found)

    first = [("a", "1"), ("b", "1"), ("c", "1"), ("c", "2"), ("c", "2")]
    kept = "1" if hashlib.sha256(b"1").hexdigest() > hashlib.sha256(b"2").hexdigest() else "2"
    assert run("r1", None, *first) == [("a", "added", "1"), ("b", "added", "1"), ("c", "added", kept)]
    assert run("r2", "r1", *reversed(first)) == []
    second = [("a", "1"), ("b", "9"), ("d", "1")]
    for _ in range(2):  # repeated, it emits the same
        assert run("r3", "r2", *second) == [("b", "changed", "9"), ("c", "removed", None), ("d", "added", "1")]
    assert run("r4", "r3") == [("a", "removed", None), ("b", "removed", None), ("d", "removed", None)]
    with pytest.raises(ValueError):
        run("r4", "r4")


def test_a_hot_card_has_one_whole_list_from_bounded_slices(spark):
    """A third of all slots belong to one card; no slice holds more than its stretch of the input."""
    n = 30000
    slots = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))).alias("card_id"),
        F.col("id").alias("dashboard_id"),
        with_slot(seq_from_number(F.col("id")), F.lit(0)).alias("seq"),
    )
    lists = {r.card_id: r.dashboard_ids for r in E.card_dashboards(slots).collect()}
    assert [int(d) for d in lists["hot"]] == list(range(0, n, 3))
    assert sum(map(len, lists.values())) == n
    parts = E.card_dashboards(slots, sliced=True).where("card_id = 'hot'").collect()
    assert len(parts) == 8 and max(len(r.dashboard_ids) for r in parts) <= 1366


def test_dashboards_of_one_landed_list_keep_its_order(spark):
    """Card 7 stands twice on dashboards 20 and 10, which landed in one list in that order."""
    cards = '"dashcards":[{"card_id":7,"card":{"id":7}},{"card_id":7,"card":{"id":7}}]'
    body = f'[{{"id":20,{cards}}},{{"id":10,{cards}}}]'
    got, lost = L.unwrap_responses(landed_rows(spark, [("/api/dashboard", None, 200, body, 1)]), "dashboard")
    lists = E.card_dashboards(E.card_slots(E.typed_dashboards(got))).collect()
    assert [(r.card_id, r.dashboard_ids) for r in lists] == [("7", ["20", "20", "10", "10"])]
    assert lost.count() == 0


@pytest.mark.parametrize("envelope", [None, "data"])
def test_every_reader_takes_unwrapped_rows(spark, envelope):
    body = '[{"id":1,"name":"a"},{"id":2,"name":"b"}]'
    body = f'{{"data":{body}}}' if envelope else body
    got, _ = L.unwrap_responses(landed_rows(spark, [("/api", None, 200, body, 5)]), "database", envelope=envelope)
    for read in (E.typed_collections, E.typed_summaries, E.typed_dashboards, E.typed_questions, E.typed_databases):
        rows = read(got).select("id", "seq.row", "seq.item").orderBy("id").collect()
        assert [tuple(r) for r in rows] == [("1", 5, 0), ("2", 5, 1)]


def test_preflight_tells_missing_null_and_lost(spark):
    sel = S.Selection.parse(exclude={"None": {}})
    good = landed_rows(spark, [("/api", None, 200, "[]", 1)])
    boards = landed_rows(spark, [("/api", None, 200, '[{"id":1},{"id":2,"collection_id":null},{"id":3,"collection_id":4}]', 1)])
    lost = landed_rows(spark, [("/api", None, 500, None, 1)])
    checks, verdict = run_preflight(good, boards, lost, good, sel)
    found = {r.name: (r.n, r.passed) for r in checks.collect()}
    assert found == {"collections": (0, True), "permissions": (0, True), "dashboards": (2, True), "questions": (None, False)}
    assert verdict.first().status == "PARTIAL"
    assert run_preflight(lost, boards, good, good, sel)[1].first().status == "NOT_READY"


def landed_rows(spark, rows):
    df = spark.createDataFrame(rows, "endpoint string, record_id string, http_status int, body string, n long")
    return df.select("endpoint", "record_id", "http_status", "body", seq_from_number(F.col("n")).alias("seq"))


# --- entities -----------------------------------------------------------------


def test_wire_names_follow_the_product_token(spark):
    ctx = RunContext(connection_qn="c", names=WireNames(product="acme", lookup="my"))
    out = run_metadata(landed(spark), S.Selection(), ctx)
    found = {r.type_dir: json.loads(r.json) for r in out.entities.collect()}
    assert set(found) == {"ACMECOLLECTION", "ACMEDASHBOARD", "ACMEQUESTION", "BIPROCESS"}
    question = found["ACMEQUESTION"]
    assert question["typeName"] == "AcmeQuestion" and "acmeDashboardCount" in question["attributes"]
    assert list(question["relationshipAttributes"]) == ["acmeCollection"]
    edge = found["BIPROCESS"]
    assert "relationshipAttributes" not in edge and {"inputs", "outputs"} <= set(edge["attributes"])


def test_dispatch(spark):
    df = spark.createDataFrame([("1",)], "id string")
    assert N.map_entities(df, "Other", CTX).count() == 0
    with pytest.raises(ValueError):
        N.map_entities(df, " ", CTX)


def test_connection_fallbacks():
    ctx = with_connection(RunContext(), {"attributes": {"qualifiedName": "q"}})
    assert (ctx.connection_qn, ctx.connection_name) == ("q", "bi")
    assert with_connection(RunContext(connection_qn="own"), {"attributes": {"qualifiedName": "q", "name": "N"}}).connection_qn == "own"


# --- readiness ----------------------------------------------------------------


@pytest.mark.parametrize("flags, verdict, reported", [
    ((True, True, True, True), "READY", (True, True, True, True)),
    ((True, True, False, True), "PARTIAL", (True, True, False, True)),
    ((True, False, True, True), "NOT_READY", (True, False, None, None)),
    ((False, True, True, True), "NOT_READY", (False, None, None, None)),
])
def test_readiness_tiers(spark, flags, verdict, reported):
    names = ("collections", "permissions", "dashboards", "questions")
    row = Q.readiness(spark.createDataFrame(list(zip(names, flags)), "name string, passed boolean")).first()
    assert tuple(row) == (verdict, *reported)


def test_readiness_keys_differ_from_scope_keys(spark):
    none = spark.createDataFrame([], "id string, personal_owner_id int")
    items = spark.createDataFrame([(None,), ("1",)], "collection_id string")
    assert Q.countable_items(items, none, S.Selection.parse(exclude={"root": {}})).count() == 2
    assert Q.countable_items(items, none, S.Selection.parse(exclude={"None": {}})).count() == 1


# --- lineage ------------------------------------------------------------------


def refs(spark, payload, vendor="", **record):
    base = {"sql": "s", "extra": {"attributes": {"qualifiedName": "c/questions/1"}}, "gudusoft": payload}
    row = G.parse_records(raw_rows(spark, {**base, **record}), vendor).first()
    return [tuple(t) for t in row.tables], [tuple(c) for c in row["columns"]]


def test_table_refs(spark):
    tables, _ = refs(spark, {"dbvendor": "dbH2", "dbobjs": [
        {"name": '"a"', "type": "TABLE", "db": "", "database": "`d`", "schema": '"s"'}, {"tableName": "b", "objectType": "view", "vendorName": "v"},
        {"name": "c", "type": "cte"}, {"name": '""'}, {"name": 0, "tableName": "e"}, "text", None, {"name": "0"}, {"name": "a"}, {"name": "a"}]})
    assert tables == [("h2", "d", "s", "a"), ("v", "", "", "b"), ("h2", "", "", "e"), ("h2", "", "", "0"), ("h2", "", "", "a"), ("h2", "", "", "a")]


def test_column_refs(spark):
    objects = [{"id": 1, "name": "one", "database": "d"}, {"id": "1", "name": "text", "type": "cte"}, {"id": 1, "name": "late"}, {"id": None, "name": "n"}]
    _, columns = refs(spark, {"dbobjs": objects, "relationships": [
        {"sources": [{"column": '"x"', "parentId": 1}, {"name": "y", "parentId": "1"}, {"column": "z", "parentId": 9, "parentName": 'A."B".C.D'},
                     {"column": "w", "parentName": "S.T"}, {"column": '"x"', "parentId": 1}, {"column": 0, "name": "0"}, 5],
         "source": {"column": "hidden"}},
        {"source": {"column": "p", "table": "t", "schema": "s", "db": "d", "vendor_name": "v"}, "from": {"name": "q", "tableName": "u", "database": "e"}},
        {"sources": {}, "source": {"column": "kept"}}, {"sources": []}, None]}, vendor="dv")
    assert columns == [
        ("dv", "", "", "late", "x"), ("dv", "", "", "text", "y"), ("dv", "A", "B", "C.D", "z"), ("dv", "", "S", "T", "w"), ("dv", "", "", "", "0"),
        ("v", "d", "s", "t", "p"), ("dv", "e", "", "u", "q"), ("dv", "", "", "", "kept")]


def test_parents_and_repeats_of_long_lists(spark):
    """Against a plain dictionary, with ids of both kinds, missing ones and repeats."""
    rng = random.Random(2)
    ids = [rng.choice([i, str(i), None, -i, f"x{i}", i + 0.25]) for i in range(700)] + [5, "5", 5]
    objects = [{"id": i, "name": f"t{n}"} for n, i in enumerate(ids)]
    wanted = [{"column": f"c{rng.randrange(3)}", "parentId": rng.choice([*ids, 10**6, "none"])} for _ in range(3000)]
    last = {json.dumps(o["id"]): o["name"] for o in objects if o["id"] is not None}
    want = list(dict.fromkeys(("", "", "", last.get(json.dumps(w["parentId"]), ""), w["column"]) for w in wanted))
    _, columns = refs(spark, {"dbobjs": objects, "relationships": [{"sources": wanted[:1000]}, {"sources": wanted[1000:]}]})
    assert columns == want
    assert refs(spark, {"relationships": [{"sources": wanted[:50]}]})[1] == [("", "", "", "", c) for c in dict.fromkeys(w["column"] for w in wanted[:50])]


def test_lineage_time_grows_with_the_ends(spark):
    def seconds(n):
        objects = [{"id": i, "name": f"t{i}"} for i in range(n // 2)]
        ends = [{"column": f"c{i}", "parentId": i % (n // 2)} for i in range(n)]
        rows = raw_rows(spark, {"QUERY_ID": "q/1", "gudusoft": {"dbobjs": objects, "relationships": [{"sources": ends}]}})
        lines, times = G.lineage_lines(rows, CTX).select(F.sum(F.length("json"))), []
        for _ in range(3):
            start = time.perf_counter()
            assert lines.collect()[0][0] > n
            times.append(time.perf_counter() - start)
        return min(times)

    seconds(8000)
    assert seconds(16000) <= 2.2 * seconds(8000) + 0.2


def test_lineage_leaves_out_unread_columns_and_generators_interpret_nothing(spark):
    rows = raw_rows(spark, {"QUERY_ID": "q/1", "gudusoft": {"dbobjs": [{"id": 1, "name": "t"}], "relationships": [{"sources": [{"column": "c", "parentId": 1}]}]}})
    parsed = G.parse_records(rows)
    assert "relationships" in plan(parsed) and "relationships" not in plan(parsed.select("tables"))
    assert "relationships" not in plan(G.processes(parsed, CTX))
    for df in (G.lineage_lines(rows, CTX), G.column_processes(parsed, CTX)):
        generators = [line for line in plan(df).splitlines() if "Generate inline" in line]
        assert generators and not any("lambda" in line for line in generators)


def test_lists_of_the_wrong_kind_count_as_empty(spark):
    assert refs(spark, {"dbobjs": {"name": "x"}, "relationships": "none"}) == ([], [])
    assert refs(spark, [], parsedData="{", PARSED_DATA='{"dbobjs":[{"name":"t"}]}')[0] == [("", "", "", "t")]


def test_records_without_question_or_tables_make_no_process(spark):
    rows = raw_rows(
        spark,
        {"gudusoft": {"dbobjs": [{"name": "t"}]}},
        {"QUERY_ID": "a/7", "gudusoft": {"relationships": [{"source": {"column": "c"}}]}},
        {"QUERY_ID": "a/8", "SQL": "S", "gudusoft": {"dbobjs": [{"name": "t"}], "relationships": [{"source": {"column": "c"}}]}},
    )
    processes, columns = G.lineage(rows, CTX)
    (p,), (c,) = processes.collect(), columns.collect()
    assert p.attributes.name == "a/8" and p.attributes.qualifiedName.startswith("c/question_tables/8/")
    assert c.attributes.process.uniqueAttributes.qualifiedName == p.attributes.qualifiedName
    both = {r.type_dir: json.loads(r.json) for r in G.lineage_lines(rows, CTX).collect()}
    assert both["PROCESS"]["attributes"]["qualifiedName"] == p.attributes.qualifiedName
    assert both["PROCESS"]["attributes"]["inputs"][0]["attributes"]["refIdentity"]["components"] == {"tableName": "t"}


def test_lineage_is_one_stage_without_python(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}\n")
    from catloom.sources.ndjson import read_ndjson_tree

    text = plan(G.lineage_lines(read_ndjson_tree(spark, str(tmp_path))[0], CTX))
    assert "Exchange" not in text and "Python" not in text


# --- references ---------------------------------------------------------------


def test_the_index_holds_what_is_asked(spark, monkeypatch):
    names = ("connectorType", "databaseName", "schemaName", "tableName", "columnName")
    catalog = spark.createDataFrame(
        [("Table", "q/t", None, "d", "s", "t", None), ("Column", "q/t/c", "pg", "d", "s", "t", "c"), ("Column", "q/a/c", "my", "d", "s", "t", "c"),
         ("Column", "q/t/e", "pg", "d", "s", "t", "e"), ("View", "q/other", "pg", "d", "s", "other", None)],
        "type_name string, qualified_name string, " + ", ".join(f"{n} string" for n in names),
    )
    asked = [("Column", "pg", "", "", "t", "c"), ("Column", "", "d", "", "", "c"), ("Column", "pg", "", "", "t", "e"), ("Column", "", "", "", "t", "")]
    refs = spark.createDataFrame([(i, *r) for i, r in enumerate(asked)], "i int, kind string, " + ", ".join(f"{n} string" for n in names))
    built, index = [], R.catalog_index
    monkeypatch.setattr(R, "catalog_index", lambda catalog, kind, masks: built.append((kind, sorted(masks), catalog.count())) or index(catalog, kind, masks))
    found = {(r.i, r.resolved_qn) for r in R.match_refs(refs, catalog).collect()}
    assert found == {(0, "q/t/c"), (1, "q/a/c"), (2, "q/t/e")}
    assert built == [("Column", [0b01100, 0b10110], 3)]
    assert R.match_refs(refs.limit(0), catalog).count() == 0
    text = plan(index(catalog, "Column", [0b01100, 0b10110]))
    assert text.count("Expand") >= 1 and re.search(r"Expand \[\[[^\]]*\], \[[^\]]*\]\]", text)

CATALOG = "type_name string, qualified_name string, connectorType string, databaseName string, schemaName string, tableName string, columnName string"


def test_references_resolve_by_given_components(spark):
    catalog = spark.createDataFrame([
        ("Table", "q2", "h2", "d", "s", "t", None), ("View", "q1", "h2", "d", "other", "t", None), ("Schema", "q0", "h2", "d", "s", "t", None),
        ("Table", "q3", "h2", "d", None, "bare", None), ("Column", "k1", "h2", "d", "s", "t", "c"), ("Column", "k2", "h2", "d", "s", "u", "c"),
    ], CATALOG)
    objects = [{"name": "t"}, {"name": "t", "schema": "s"}, {"name": "T"}, {"name": "bare", "schema": "s"}, {"name": "bare", "db": "d"}, {"name": "t", "vendor_name": "pg"}]
    rels = [{"source": {"column": "c", "table": "u"}}, {"source": {"column": "c"}}, {"source": {"column": "x"}}]
    rows = raw_rows(spark, *[{"QUERY_ID": f"a/{i}", "SQL": "S", "gudusoft": {"dbobjs": objects, "relationships": rels}} for i in range(5)],
                    {"QUERY_ID": "a/9", "SQL": "S", "gudusoft": {"dbobjs": [{"name": "nowhere"}]}})
    processes, columns = G.lineage(rows, CTX)

    def names(df):
        return {r.attributes.qualifiedName.split("/")[2]: [(i.typeName, i.uniqueAttributes.qualifiedName) for i in r.attributes.inputs] for r in df.collect()}

    got = names(R.resolve_refs(processes, catalog, CTX))
    assert got == {**{str(i): [("View", "q1"), ("Table", "q2"), ("Table", "q3")] for i in range(5)}, "9": []}
    assert names(R.resolve_refs(columns, catalog, CTX)) == {str(i): [("Column", "k2"), ("Column", "k1")] for i in range(5)}
