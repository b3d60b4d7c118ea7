"""Typed rows from landed records, joined into enriched dashboards and questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.context import RunContext
from catloom.functions import variants as V
from catloom.functions.binding import bind
from catloom.functions.identity import ROOT, engine_name, qn, root_key, source_url
from catloom.functions.ordering import for_join, last_wins, slice_of, with_slot
from catloom.functions.times import variant_millis

# Stage kinds of the newer query format.
STAGE_KINDS = {"mbql.stage/native": "native", "mbql.stage/mbql": "query"}


_CARDS = "array<struct<card_id:string,card:struct<id:string>>>"
_HISTORY = (
    "certificate_status:string,certificate_status_message:string,created_at:variant,updated_at:variant,"
    "last_edit_info_user:string"
)


def _read(landed: DataFrame, fields: str) -> DataFrame:
    """Fields of the records, taken in one pass over each, as the struct ``f``."""
    return bind(landed, f=V.at(F.col("raw"), "$", f"struct<{fields}>"))


def _given(name: str) -> Column:
    return V.given_text(F.col(f"f.{name}"), V.json_text(F.col("raw"), f"$.{name}"))


def _plain(*names: str) -> list[Column]:
    return [F.col(f"f.{n}").alias(n) for n in names]


def _name() -> Column:
    return F.coalesce(_given("name"), F.lit("")).alias("name")


def _history() -> list[Column]:
    return [
        *_plain("certificate_status", "certificate_status_message"),
        variant_millis(F.col("f.created_at")).alias("created_ms"),
        variant_millis(F.col("f.updated_at")).alias("updated_ms"),
        _given("last_edit_info_user").alias("updated_by"),
    ]


def typed_collections(landed: DataFrame, host: str = "") -> DataFrame:
    rows = _read(
        landed,
        "id:string,name:string,description:string,slug:string,color:string,namespace:string,personal_owner_id:string",
    )
    ident = F.coalesce(_given("id"), F.lit(ROOT))
    return rows.select(
        ident.alias("id"),
        _name(),
        *_plain("description", "slug", "color", "namespace", "personal_owner_id"),
        F.col("f.personal_owner_id").isNotNull().alias("is_personal"),
        source_url(host, "collection", ident).alias("source_url"),
        "seq",
    )


def typed_summaries(landed: DataFrame) -> DataFrame:
    """Dashboard summaries: what the cascade and the detail lookup need."""
    return _read(landed, "id:string,collection_id:string").select(
        *_plain("id"), _given("collection_id").alias("collection_id"), "seq"
    )


def typed_dashboards(landed: DataFrame, host: str = "") -> DataFrame:
    """Dashboard details. Newer card lists win over older ones; every slot counts,
    text cards too."""
    rows = _read(
        landed,
        f"id:string,name:string,description:string,collection_id:string,dashcards:{_CARDS},ordered_cards:{_CARDS},{_HISTORY}",
    )
    cards = F.coalesce("f.dashcards", "f.ordered_cards")
    raw = F.col("raw")

    def linked(card: Column, slot: Column) -> Column:
        source = F.get(F.coalesce(V.elements(raw, "$.dashcards"), V.elements(raw, "$.ordered_cards")), slot)
        is_question = V.given_text(card["card_id"], V.json_text(source, "$.card_id")).isNotNull()
        return F.struct(slot.alias("slot"), F.when(is_question, card["card"]["id"]).alias("card_id"))

    return rows.select(
        *_plain("id"),
        _name(),
        *_plain("description"),
        _given("collection_id").alias("collection_id"),
        source_url(host, "dashboard", F.col("f.id")).alias("source_url"),
        F.coalesce(F.size(cards), F.lit(0)).alias("cards_count"),
        F.filter(F.transform(cards, linked), lambda c: c["card_id"].isNotNull()).alias("cards"),
        *_history(),
        "seq",
    )


def typed_questions(landed: DataFrame, host: str = "") -> DataFrame:
    rows = _read(
        landed,
        "id:string,name:string,description:string,collection_id:string,database_id:string,dataset_query:variant,"
        f"creator_id:string,{_HISTORY}",
    )
    return rows.select(
        *_plain("id"),
        _name(),
        *_plain("description", "database_id", "dataset_query"),
        _given("collection_id").alias("collection_id"),
        source_url(host, "question", F.col("f.id")).alias("source_url"),
        _given("creator_id").alias("created_by"),
        *_history(),
        "seq",
    )


def typed_databases(landed: DataFrame, host: str = "") -> DataFrame:
    """Databases with the names their questions default to."""
    rows = _read(landed, "id:string,name:string,engine:string,details:variant,native_permissions:string")
    details = F.col("f.details")
    default_database = F.coalesce(V.given(details, "$.dbname", "$.db"), F.col("f.name"), F.lit(""))
    return rows.select(
        *_plain("id", "name", "engine"),
        # A details key counts even if its value is null.
        details.isNotNull().alias("has_details"),
        default_database.alias("default_database"),
        V.given_or_blank(details, "$.schema").alias("default_schema"),
        *_plain("native_permissions"),
        source_url(host, "database", F.col("f.id")).alias("source_url"),
        "seq",
    )


def query_kind(dataset_query: Column) -> Column:
    """``native``, ``query`` or what the older format says; empty if unknown."""
    stage = V.at(dataset_query, "$.stages[0]['lib/type']")
    newer = F.lit("")
    for name, kind in STAGE_KINDS.items():
        newer = F.when(stage == name, F.lit(kind)).otherwise(newer)
    return F.coalesce(V.given(dataset_query, "$.type"), newer)


def with_collection(df: DataFrame, collections: DataFrame) -> DataFrame:
    """Attach the collection's id and name; rows outside the scope drop.

    Spark broadcasts the collections while they are small and otherwise shuffles,
    where adaptive execution splits a collection that holds most rows.
    """
    side = last_wins(collections.select("id", "name", "seq"), "id").select(
        F.col("id").alias("_cid"), F.col("name").alias("collection_name")
    )
    keyed = df.withColumn("_key", root_key(F.col("collection_id"))).drop("collection_id")
    return keyed.join(side, F.col("_key") == F.col("_cid")).withColumn("collection_id", F.col("_cid")).drop("_key", "_cid")


def query_context(questions: DataFrame, queries: DataFrame, databases: DataFrame) -> DataFrame:
    """All questions with resolved SQL, kind, database, schema and engine.

    ``known`` is false for questions without a resolved query or a known database. The
    context stays empty for native queries on databases that landed without details.
    """
    q = last_wins(queries.select("question_id", "query", "seq"), "question_id").select(
        F.col("question_id").cast("string").alias("_qid"), F.col("query").alias("_sql")
    )
    d = last_wins(
        databases.select("id", "engine", "has_details", "default_database", "default_schema", "seq"), "id"
    ).select(
        F.col("id").cast("string").alias("_did"), "engine", "has_details", "default_database", "default_schema"
    )
    joined = questions.join(q, F.col("id") == F.col("_qid"), "left").join(
        d, F.col("database_id") == F.col("_did"), "left"
    )
    kind = query_kind(F.col("dataset_query"))
    open_context = (kind != "native") | F.col("has_details")

    def filled(c: Column) -> Column:
        return F.when(open_context, F.coalesce(c, F.lit(""))).otherwise(F.lit(""))

    return joined.select(
        *[c for c in questions.columns if c not in ("dataset_query", "database_id")],
        kind.alias("query_type"),
        filled(F.col("_sql")).alias("query"),
        filled(F.col("default_database")).alias("database_name"),
        filled(F.col("default_schema")).alias("schema_name"),
        filled(engine_name(F.col("engine"))).alias("engine"),
        (F.col("_qid").isNotNull() & F.col("_did").isNotNull()).alias("known"),
    )


def with_query_context(
    questions: DataFrame, queries: DataFrame, databases: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The known questions with their context, and ``id`` and ``name`` of the others."""
    context = query_context(questions, queries, databases)
    return context.filter("known").drop("known"), context.filter("NOT known").select("id", "name")


def card_slots(dashboards: DataFrame) -> DataFrame:
    """One row per question card, ``(card_id, dashboard_id, seq)``, in slot order."""
    return dashboards.select("id", "seq", F.explode("cards").alias("_card")).select(
        F.col("_card.card_id").alias("card_id"),
        F.col("id").alias("dashboard_id"),
        with_slot(F.col("seq"), F.col("_card.slot").cast("int")).alias("seq"),
    )


def card_counts(slots: DataFrame) -> DataFrame:
    """Slots per question. Counting combines before the shuffle."""
    return slots.groupBy("card_id", for_join("card_id")).agg(F.count("*").alias("dashboard_count")).drop("_half")


def card_dashboards(slots: DataFrame, sliced: bool = False) -> DataFrame:
    """Dashboards of each question in arrival order, ``(card_id, dashboard_ids)``.

    Slots are sorted per question and slice of the input, so a hot question's sorting
    is spread over tasks; then its lists are laid end to end, in order. One record per
    question holds its whole list, whatever the length. ``sliced`` returns the
    lists before that, ``(card_id, part, dashboard_ids)``, for every question.
    """
    listed = F.array_sort(F.collect_list(F.struct("seq", F.col("dashboard_id").cast("string").alias("dashboard_id"))))
    pieces = slots.groupBy("card_id", slice_of(F.col("seq")).alias("part")).agg(
        F.transform(listed, lambda x: x["dashboard_id"]).alias("dashboard_ids")
    )
    if sliced:
        return pieces
    in_order = F.array_sort(F.collect_list(F.struct("part", "dashboard_ids")))
    whole = F.flatten(F.transform(in_order, lambda x: x["dashboard_ids"])).alias("dashboard_ids")
    return pieces.groupBy("card_id", for_join("card_id")).agg(whole).drop("_half")


def with_dashboard_count(questions: DataFrame, slots: DataFrame) -> DataFrame:
    """Number of slots a question fills; a card twice on a dashboard counts twice."""
    counts = card_counts(slots).withColumnRenamed("card_id", "_card")
    return (
        questions.join(counts, F.col("id") == F.col("_card"), "left")
        .drop("_card")
        .withColumn("dashboard_count", F.coalesce("dashboard_count", F.lit(0)).cast("int"))
    )


def attach_dashboards(questions: DataFrame, lists: DataFrame) -> DataFrame:
    """Questions with ``dashboard_ids``; without a dashboard, an empty list."""
    return (
        questions.join(lists, F.col("id") == F.col("card_id"), "left")
        .drop("card_id")
        .withColumn("dashboard_ids", F.coalesce("dashboard_ids", F.array().cast("array<string>")))
    )


def reference(type_name: str, qualified_name: Column) -> Column:
    return F.struct(
        F.lit(type_name).alias("typeName"),
        F.struct(qualified_name.alias("qualifiedName")).alias("uniqueAttributes"),
    )


def edges(questions: DataFrame, lists: DataFrame, ctx: RunContext) -> DataFrame:
    """Question-to-dashboard edge records for questions on at least one dashboard.

    The join is on finished lists: copies of a question each meet its list, not
    every slot.
    """
    return (
        questions.select("id", "name")
        .join(lists, F.col("id") == F.col("card_id"))
        .select(
            F.coalesce("name", F.lit("")).alias("name"),
            F.col("id").alias("question_id"),
            F.array(reference(ctx.names.question, qn("question", ctx.connection_qn, F.col("id")))).alias("inputs"),
            F.transform(
                "dashboard_ids",
                lambda d: reference(ctx.names.dashboard, qn("dashboard", ctx.connection_qn, d)),
            ).alias("outputs"),
        )
    )
