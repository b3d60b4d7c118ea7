"""One key holds a third of the rows: its partition must be split, not waited for."""

import pytest
from pyspark.sql import functions as F

from catloom import RunContext
from catloom.functions.ordering import seq_from_number
from catloom.functions import variants as V
from catloom.functions.binding import bind
from catloom.operators import enrich as E
from catloom.operators import lineage as G
from catloom.operators import resolve as R
from catloom.operators import selection as S
from catloom.session import configure
from catloom.sources import landing as L

ROWS = 60000
CTX = RunContext(connection_qn="c")


@pytest.fixture(autouse=True)
def small_thresholds(spark):
    """No broadcasts, and partitions count as hot from a few kilobytes on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot(spark, modulus=1000):
    """Ids 0 to ROWS with a key that is 7 for a third of them; many map tasks."""
    key = F.when(F.col("n") % 3 == 0, F.lit(7)).otherwise(F.col("n") % modulus)
    return spark.range(0, ROWS, 1, 16).withColumnRenamed("id", "n").withColumn("key", key.cast("string"))


def keys(spark, modulus=1000):
    df = spark.range(0, modulus, 1, 4).withColumnRenamed("id", "n")
    return df.select(F.col("n").cast("string").alias("id"), F.concat(F.lit("name"), "n").alias("name"), seq_from_number(F.col("n")).alias("seq"))


def runs_split(df, rows):
    assert df.collect().__len__() == rows
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    assert "skew=true" in final, final


def test_cascade(spark):
    items = hot(spark).select("n", F.col("key").alias("collection_id"))
    scope = keys(spark).filter("id between 1 and 899")
    kept = items.filter(F.col("collection_id").cast("int").between(1, 899)).count()
    runs_split(S.cascade(items, S.accepted_ids(scope)), kept)


def test_with_collection(spark):
    items = hot(spark).select("n", F.when(F.col("key") == "0", "1").otherwise(F.col("key")).alias("collection_id"))
    runs_split(E.with_collection(items, keys(spark)), ROWS)


def test_copies_of_a_question(spark):
    questions = hot(spark).select(F.col("key").alias("id"), "n")
    slots = hot(spark, 50).select(F.col("key").alias("card_id"), "n")
    runs_split(E.with_dashboard_count(questions, slots), ROWS)


def test_slots_of_a_hot_card(spark):
    slots = hot(spark).select(
        F.col("key").alias("card_id"), F.col("n").alias("dashboard_id"), seq_from_number(F.col("n"), width=1000).alias("seq")
    )
    lists = {r.card_id: r.dashboard_ids for r in E.card_dashboards(slots).collect()}
    assert [int(d) for d in lists["7"]] == [r.n for r in slots.where("card_id = '7'").orderBy("dashboard_id").select(F.col("dashboard_id").alias("n")).collect()]
    assert sum(map(len, lists.values())) == ROWS


def test_references_to_a_hot_table(spark):
    refs = hot(spark).select("n", F.lit("Table").alias("kind"), F.col("key").alias("tableName"))
    catalog = keys(spark).select(
        F.lit("Table").alias("type_name"), F.concat(F.lit("q"), "id").alias("qualified_name"), F.lit("h2").alias("connectorType"),
        F.lit("d").alias("databaseName"), F.lit("s").alias("schemaName"), F.col("id").alias("tableName"), F.lit(None).cast("string").alias("columnName"),
    )
    runs_split(R.match_refs(refs, catalog), ROWS)


def test_copies_of_a_summary(spark):
    summaries = hot(spark).filter("key <> '0'").select(F.col("key").alias("id"), seq_from_number(F.col("n")).alias("seq"))
    landed = keys(spark).select(
        F.lit("/d").alias("endpoint"), F.col("id").alias("record_id"), F.lit(200).alias("http_status"), F.lit("{}").alias("body"), "seq"
    )
    runs_split(L.hydrate(summaries, landed, "dashboard")[0], summaries.count())


def test_copies_of_a_record(spark):
    configure(spark)
    value = F.format_string('{"QUERY_ID":"q/%s","SQL":"s","gudusoft":{"dbobjs":[{"name":"%s"}]}}', "key", "key")
    parsed = bind(hot(spark), raw=V.parse(value)).select("raw")
    catalog = keys(spark).select(
        F.lit("Table").alias("type_name"), F.concat(F.lit("q"), "id").alias("qualified_name"), F.col("id").alias("tableName"),
        *[F.lit(None).cast("string").alias(k) for k in ("connectorType", "databaseName", "schemaName", "columnName")],
    )
    found = R.resolve_refs(G.lineage(parsed, CTX)[0], catalog, CTX)
    assert found.filter(F.size("attributes.inputs") == 1).count() == ROWS
    runs_split(found.select("attributes.qualifiedName", F.size("attributes.inputs")), ROWS)
