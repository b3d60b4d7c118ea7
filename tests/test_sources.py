import json
import random
import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from catloom import RunContext
from catloom.functions import variants as V
from catloom.functions.ordering import seq_from_number
from catloom.operators.lineage import lineage_lines
from catloom.sources import bodies
from catloom.sources import landing as L
from catloom.sources.ndjson import read_ndjson, read_ndjson_tree, write_ndjson
from catloom.sources.sinks import write_by_type, write_entities, write_lineage
from catloom.streaming.lineage_stream import read_stream, stream_lineage

CTX = RunContext(connection_qn="c", connection_name="n")


def put(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def record(n):
    return json.dumps({
        "sql": f"SELECT {n}", "extra": {"attributes": {"qualifiedName": f"c/questions/{n}"}},
        "gudusoft": {"dbobjs": [{"id": 1, "name": f"t{n}", "type": "table"}],
                     "relationships": [{"sources": [{"column": "a", "parentId": 1}]}]},
    })


def test_missing_path_has_no_rows(spark, tmp_path):
    good, bad = read_ndjson(spark, str(tmp_path / "none"))
    assert good.count() == 0 and bad.count() == 0


def test_bad_lines_are_kept_apart_and_blank_ones_dropped(spark, tmp_path):
    put(str(tmp_path / "a.json"), '{"a":1}', "", "   ", "oops", '{"a":null}')
    good, bad = read_ndjson(spark, str(tmp_path / "a.json"))
    assert sorted(r[0] for r in good.select(F.to_json("raw")).collect()) == ['{"a":1}', '{"a":null}']
    assert [r.value for r in bad.collect()] == ["oops"]


def test_tree_takes_json_files_at_any_depth_in_path_order(spark, tmp_path):
    put(str(tmp_path / "b" / "1.json"), '{"n":3}')
    put(str(tmp_path / "a" / "x" / "2.json"), '{"n":1}', '{"n":2}')
    put(str(tmp_path / "a" / "skip.txt"), '{"n":9}')
    good, _ = read_ndjson_tree(spark, str(tmp_path))
    assert [r[0] for r in good.orderBy("seq").select(V.at(F.col("raw"), "$.n")).collect()] == ["1", "2", "3"]
    one, _ = read_ndjson_tree(spark, str(tmp_path / "b" / "1.json"))
    assert one.count() == 1


def test_round_trip_keeps_nulls(spark, tmp_path):
    put(str(tmp_path / "in.json"), '{"a":null,"b":[1,{"c":"é"}]}')
    good, _ = read_ndjson(spark, str(tmp_path / "in.json"))
    write_ndjson(good, str(tmp_path / "out"))
    again, _ = read_ndjson(spark, str(tmp_path / "out"))
    assert [r[0] for r in again.select(F.to_json("raw")).collect()] == ['{"a":null,"b":[1,{"c":"é"}]}']


def responses(spark, *rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, endpoint string, record_id string, http_status string, body string")
    return df.select("endpoint", "record_id", "http_status", "body", seq_from_number(F.col("n")).alias("seq"))


def test_hydrate_turns_each_failure_into_a_residual(spark):
    summaries = spark.createDataFrame([("1", 1), ("2", 2), ("3", 3), ("4", 4), ("0", 5), (None, 6)], "id string, n int").select(
        "id", seq_from_number(F.col("n")).alias("seq"))
    landed = responses(spark, ("/d", "1", "500", "x"), ("/d", "1", "200", '{"id":1}'), ("/d", "2", "404", "{}"),
                       ("/d", "3", "No response", None))
    rows, lost = L.hydrate(summaries, landed, "dashboard")
    assert [r.id for r in rows.collect()] == ["1"]
    assert {(r.record_id, r.http_status) for r in lost.collect()} == {("2", 404), ("3", None), ("4", None)}


def test_cut_lists_agree_with_a_json_reader(monkeypatch):
    rng = random.Random(1)

    def value(depth=0):
        kind = rng.random()
        if depth > 3 or kind < 0.4:
            return rng.choice([1, -2.5e3, None, True, 'a"b\\', "[,]{}:", '\\\\"', "é ", "", {}, [], "\n\t"])
        if kind < 0.7:
            return [value(depth + 1) for _ in range(rng.randrange(4))]
        return {rng.choice(["data", 'a"', "b\\", "c,"]): value(depth + 1) for _ in range(rng.randrange(4))}

    for window in (1, 3, 1 << 20):
        monkeypatch.setattr(bodies, "WINDOW", window)
        for _ in range(600):
            text = rng.choice(["", " ", "\n"]) + json.dumps(value(), indent=rng.choice([None, 1])) + rng.choice(["", "  "])
            if rng.random() < 0.3:
                i = rng.randrange(len(text))
                text = text[:i] + rng.choice('[]{},:"\\x ') + text[i + rng.randrange(2) :]
            try:
                want = json.loads(text)
            except ValueError:
                assert bodies.cut_list(text.encode(), "data") is None
                continue
            if isinstance(want, dict):
                want = want.get("data")
            got = [json.loads(text[a:b]) for a, b in bodies.cut_list(text.encode(), "data")]
            assert got == (want if isinstance(want, list) else [])
    assert bodies.cut_list(b"") is None and bodies.cut_list(b"[NaN]") is None


def test_long_lists_give_the_same_rows_as_short_ones(spark):
    landed = responses(
        spark, ("/c", None, "200", '[{"id":1}, null,"a,]",[2]]'), ("/c", None, "200", '{"x":[0],"data":[3.50 ,4]}'), ("/c", None, "200", "[1,2"),
        ("/c", "9", "500", "[5]"), ("/c", None, "200", "[]"), ("/c", None, "200", None), ("/c", None, "200", '{"data":5}'),
    )

    def found(holds):
        rows, lost = L.unwrap_responses(landed, "collection", "data", holds)
        texts = rows.select(F.to_json("raw").alias("t"), "seq").orderBy("seq").collect()
        return [(r.t, r.seq.row, r.seq.item) for r in texts], sorted((r.category, r.http_status, r.length) for r in lost.collect())

    assert found(0) == found(1000)
    assert [t for t, _, _ in found(0)[0]] == ['{"id":1}', "null", '"a,]"', "[2]", "3.5", "4"]


def test_what_the_parser_cannot_hold_is_oversize(spark):
    long = F.concat(F.lit('{"id":1,"text":"'), F.repeat(F.lit("x"), F.lit(40_000_000)), F.lit('"}'))
    landed = responses(spark, ("/d", "1", "200", ""), ("/d", "2", "200", "{"), ("/d", "3", "500", "")).withColumn(
        "body", F.when(F.col("record_id") == "2", F.col("body")).otherwise(long))
    wanted = landed.select(F.col("record_id").alias("id"), F.lit("{}").alias("q"), "seq")
    _, lost = L.hydrate(wanted, landed, "dashboard")
    assert {(r.record_id, r.category, r.length) for r in lost.collect()} == {
        ("1", "oversize", 40_000_018), ("2", "dashboard_detail_fetch_failed", None), ("3", "dashboard_detail_fetch_failed", None)}
    questions = landed.select(F.col("record_id").alias("id"), F.parse_json(F.lit('{"a":1}')).alias("dataset_query"), "seq")
    _, lost = L.hydrate_queries(questions, landed)
    assert {(r.record_id, r.category, r.length) for r in lost.collect()} == {
        ("1", "oversize", 40_000_018), ("2", "question_query_fetch_errored", None), ("3", "question_query_fetch_failed", None)}
    lists = landed.limit(1).withColumn("body", F.concat(F.lit("[1,"), long, F.lit(",2]")))
    rows, lost = L.unwrap_responses(lists, "dashboard")
    assert rows.count() == 2 and [(r.category, r.length, r.endpoint) for r in lost.collect()] == [("oversize", 40_000_018, "/d")]


def test_long_texts_are_not_part_of_the_plan(spark, tmp_path):
    import __spark_entry__ as entry

    spark.range(3).select(F.when(F.col("id") > 0, F.col("id")).alias("c_custkey")).write.parquet(str(tmp_path / "customer.parquet"))
    pages = entry.queries()["oversize_lists"](spark, str(tmp_path))
    assert len(pages._jdf.queryExecution().optimizedPlan().toString()) < 4_000_000
    text = b' {"data" : [ {"id": 1} , [] ] , "x": [ ] } '
    assert [text[a:b].strip() for a, b in bodies.cut_list(memoryview(text), "data")] == [b'{"id": 1}', b"[]"]


def test_residuals_append(spark, tmp_path):
    rows = L.residuals(responses(spark, ("/d", "1", "500", "x")), "dashboards_fetch_failed")
    for _ in range(2):
        L.append_residuals(rows, str(tmp_path / "residual"))
    assert spark.read.json(str(tmp_path / "residual")).count() == 2


@pytest.mark.parametrize("exact", [False, True])
def test_entity_sink_skips_empty_types(spark, tmp_path, exact):
    df = spark.createDataFrame([("A", "a/1", "{}"), ("A", "a/2", "{}")], "type_dir string, qualified_name string, json string")
    counts = write_entities(df, str(tmp_path), ("a", "b"), chunk=3, exact_layout=exact)
    assert counts == {"A": 2, "B": 0}
    base = tmp_path / "transformed"
    folder = base / "A" / "chunk=3" if exact else base / "chunk=3" / "type_dir=A"
    assert spark.read.text(str(folder)).count() == 2
    assert not (base / "B").exists() and not (base / "chunk=3" / "type_dir=B").exists()


def test_lineage_sink_makes_both_folders(spark, tmp_path):
    none = spark.createDataFrame([], "typeName string")
    stage = write_lineage(none, none, str(tmp_path))
    assert (stage.processes, stage.column_processes) == (0, 0)
    assert os.path.exists(f"{stage.folder}/PROCESS/_SUCCESS") and os.path.exists(f"{stage.folder}/COLUMNPROCESS/_SUCCESS")
    assert spark.read.text(f"{stage.folder}/PROCESS").count() == 0


def test_lineage_takes_little_disk(spark, tmp_path):
    from catloom.plans.pipeline import run_lineage

    rows = spark.createDataFrame([(record(i),) for i in range(2000)], "value string").select(V.parse(F.col("value")).alias("raw"))
    stage = write_lineage(*run_lineage(rows, CTX, stage_root=str(tmp_path)), str(tmp_path))
    assert (stage.processes, stage.column_processes) == (2000, 2000)
    kept = list((tmp_path / "lineage-stage").rglob("part-*"))
    lines = spark.read.text([f"{stage.folder}/{kind}" for kind in ("PROCESS", "COLUMNPROCESS")])
    assert all(p.name.endswith(".txt.gz") for p in kept) and lines.distinct().count() == 4000
    length = lines.agg(F.sum(F.length("value"))).first()[0]
    assert sum(p.stat().st_size for p in kept) < length / 10
    hashed = [c for c in spark.read.parquet(str(tmp_path / "processed/parsed")).columns if c.endswith("_qn")]
    assert hashed == []


def test_a_repeated_write_replaces_the_tree(spark, tmp_path):
    def lines(*rows):
        return spark.createDataFrame(list(rows), "type_dir string, value string")

    folders, base = {"A": "A/chunk=0", "B": "B/chunk=0"}, str(tmp_path / "out")
    assert write_by_type(lines(("A", "1"), ("B", "2"), ("C", "3")), base, folders) == {"A": 1, "B": 1}
    broken = lines(("A", "x")).withColumn("value", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        write_by_type(broken, base, folders)
    assert spark.read.text(f"{base}/A/chunk=0").first().value == "1" and sorted(os.listdir(base)) == ["A", "B"]
    assert write_by_type(lines(("A", "4"), ("A", "5")), base, folders) == {"A": 2, "B": 0}
    assert {r.value for r in spark.read.text(f"{base}/A/chunk=0").collect()} == {"4", "5"}
    assert not os.path.exists(f"{base}/B/chunk=0") and not os.path.exists(f"{base}/C")


def test_stream_equals_batch_and_takes_each_file_once(spark, tmp_path):
    src, sink, log = (str(tmp_path / d) for d in ("src", "sink", "log"))
    put(f"{src}/day1/a.json", record(1), "oops", "  ", record(2))

    def run():
        stream_lineage(spark, src, sink, log, CTX).awaitTermination()
        good, bad = read_stream(spark, sink)
        rejected = sorted((r.value, os.path.basename(r.file)) for r in bad.collect())
        return sorted(tuple(r) for r in good.collect()), rejected

    def batch():
        good, bad = read_ndjson_tree(spark, src)
        rows = lineage_lines(good, CTX).select("type_dir", "qualified_name", "json")
        files = bad.select("value", "seq.source").collect()
        return sorted(tuple(r) for r in rows.collect()), sorted((r.value, os.path.basename(r.source)) for r in files)

    assert run() == batch() and len(batch()[0]) == 4 and batch()[1] == [("oops", "a.json")]
    assert run() == batch()
    put(f"{src}/day2/b.json", record(3), "{", "oops")
    assert run() == batch() and len(batch()[0]) == 6 and len(batch()[1]) == 3


def test_a_batch_that_fails_replaces_itself(spark, tmp_path, monkeypatch):
    src, sink, log = (str(tmp_path / d) for d in ("src", "sink", "log"))
    put(f"{src}/a.json", record(1), "oops")
    write = DataFrameWriter.parquet

    def run(fail=None):
        def parquet(self, path, *args, **kwargs):
            write(self, path, *args, **kwargs)
            if fail and path.endswith(fail):
                raise RuntimeError("lost after the write")

        monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
        stream_lineage(spark, src, sink, log, CTX).awaitTermination()

    with pytest.raises(Exception, match="lost after the write"):
        run(fail="batch=0")
    run()
    good, bad = read_stream(spark, sink)
    assert good.count() == 2 and [r.value for r in bad.collect()] == ["oops"]
    put(f"{src}/b.json", record(2), "{")
    with pytest.raises(Exception, match="lost after the write"):
        run(fail="batch=1")
    run()
    good, bad = read_stream(spark, sink)
    assert good.count() == 4 and sorted(r.value for r in bad.collect()) == ["oops", "{"]


def test_one_file_of_any_name_and_lines_of_tabs(spark, tmp_path):
    from catloom.sources.ndjson import read_ndjson_tree

    (tmp_path / "recs.ndjson").write_text('{"a": 1}\n\t\t\n{"a": 2}\nbad\n')
    rows, rejected = read_ndjson_tree(spark, str(tmp_path / "recs.ndjson"))
    assert rows.count() == 2 and [r.value for r in rejected.collect()] == ["bad"]
    folder = tmp_path / "deep.json"
    folder.mkdir()
    (folder / "x.json").write_text('{"a": 1}\n')
    (folder / "y.txt").write_text('{"a": 1}\n')
    assert read_ndjson_tree(spark, str(folder))[0].count() == 1


def test_payload_text_may_start_with_white_space(spark):
    from catloom.functions import variants as V

    df = spark.createDataFrame([('{"P": "\\n\\t{\\"k\\": 1}"}',), ('{"P": "no {"}',)], "v string")
    got = df.select(V.first_payload(V.parse("v"), ("P",)).alias("m")).collect()
    assert got[0].m is not None and got[1].m is None
