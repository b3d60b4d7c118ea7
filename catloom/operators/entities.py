"""Enriched rows to catalog entities as ``(type_dir, qualified_name, json)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.context import RunContext
from catloom.functions.identity import qn
from catloom.functions.text import last_segment
from catloom.operators.enrich import reference


def sync_columns(ctx: RunContext) -> dict[str, Column]:
    """Stamp every entity carries: its connection and the run that wrote it."""
    return {
        "connectorName": F.lit(ctx.connector_name),
        "connectionName": F.lit(ctx.connection_name),
        "connectionQualifiedName": F.lit(ctx.connection_qn),
        "lastSyncWorkflowName": F.lit(ctx.workflow_id),
        "lastSyncRun": F.lit(ctx.run_id),
        "lastSyncRunAt": F.lit(ctx.run_at_ms).cast("bigint"),
        "tenantId": F.lit(ctx.tenant_id),
    }


def sync_stamp(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.withColumns(sync_columns(ctx))


def project_collections(df: DataFrame) -> DataFrame:
    return df.select(
        "id", F.coalesce("name", F.lit("")).alias("name"), "description", "slug", "color", "namespace",
        "source_url", F.col("personal_owner_id").isNotNull().alias("is_personal"),
    )


def project_dashboards(df: DataFrame) -> DataFrame:
    return df.select(
        "id", F.coalesce("name", F.lit("")).alias("name"), "description", "source_url",
        F.coalesce(F.col("cards_count").cast("int"), F.lit(0)).alias("cards_count"),
        "collection_id", "collection_name", "certificate_status", "certificate_status_message",
        "created_ms", "updated_ms", F.nullif("updated_by", F.lit("")).alias("updated_by"),
    )


def creator(c: Column) -> Column:
    """Creator id as text; 0 and empty mean nobody."""
    return F.nullif(F.nullif(c.cast("string"), F.lit("0")), F.lit(""))


def project_questions(df: DataFrame) -> DataFrame:
    return df.select(
        "id", F.coalesce("name", F.lit("")).alias("name"), "description", "source_url",
        "query", "query_type", "database_name", "schema_name", "engine",
        "collection_id", "collection_name", "dashboard_count",
        "certificate_status", "certificate_status_message", "created_ms", "updated_ms",
        creator(F.col("created_by")).alias("created_by"), F.nullif("updated_by", F.lit("")).alias("updated_by"),
    )


def project_edges(df: DataFrame) -> DataFrame:
    """Edge rows with the dashboards' ids as text, taken from their references."""
    found = F.filter("outputs", lambda r: F.coalesce(r["uniqueAttributes"]["qualifiedName"], F.lit("")) != "")
    return df.select(
        F.coalesce("name", F.lit("")).alias("name"),
        "question_id",
        F.transform(found, lambda r: last_segment(r["uniqueAttributes"]["qualifiedName"])).alias("dashboard_ids"),
    )


def envelope(
    df: DataFrame, type_name: str, attributes: dict[str, Column], relations: dict[str, Column] | None = None
) -> DataFrame:
    """Wire form of an entity. Null attributes are left out, and so is the
    relations block when every relation is null."""
    parts = [
        F.lit(type_name).alias("typeName"),
        F.lit("ACTIVE").alias("status"),
        F.struct(*[c.alias(n) for n, c in attributes.items()]).alias("attributes"),
    ]
    if relations:
        present = reduce(lambda a, b: a | b, [c.isNotNull() for c in relations.values()])
        block = F.struct(*[c.alias(n) for n, c in relations.items()])
        parts.append(F.when(present, block).alias("relationshipAttributes"))
    return df.select(
        F.lit(type_name.upper()).alias("type_dir"),
        attributes["qualifiedName"].alias("qualified_name"),
        F.to_json(F.struct(*parts)).alias("json"),
    )


def _collection_link(ctx: RunContext) -> tuple[dict[str, Column], dict[str, Column]]:
    known = F.col("collection_id").isNotNull()
    link = qn("collection", ctx.connection_qn, F.col("collection_id"))
    attributes = {
        ctx.names.attr("CollectionQualifiedName"): F.when(known, link),
        ctx.names.attr("CollectionName"): F.when(known, F.col("collection_name")),
    }
    return attributes, {ctx.names.attr("Collection"): F.when(known, reference(ctx.names.collection, link))}


def _history() -> dict[str, Column]:
    return {
        "certificateStatus": F.col("certificate_status"),
        "certificateStatusMessage": F.col("certificate_status_message"),
        "sourceCreatedAt": F.col("created_ms"),
        "sourceUpdatedAt": F.col("updated_ms"),
        "sourceUpdatedBy": F.col("updated_by"),
    }


def entity_collections(df: DataFrame, ctx: RunContext) -> DataFrame:
    n = ctx.names
    attributes = {
        "name": F.col("name"),
        "qualifiedName": qn("collection", ctx.connection_qn, F.col("id")),
        "description": F.col("description"),
        "sourceURL": F.col("source_url"),
        n.attr("Slug"): F.col("slug"),
        n.attr("Color"): F.col("color"),
        n.attr("Namespace"): F.col("namespace"),
        n.attr("IsPersonalCollection"): F.col("is_personal"),
        **sync_columns(ctx),
    }
    return envelope(project_collections(df), n.collection, attributes)


def entity_dashboards(df: DataFrame, ctx: RunContext) -> DataFrame:
    link, relation = _collection_link(ctx)
    attributes = {
        "name": F.col("name"),
        "qualifiedName": qn("dashboard", ctx.connection_qn, F.col("id")),
        "description": F.col("description"),
        "sourceURL": F.col("source_url"),
        **_history(),
        ctx.names.attr("QuestionCount"): F.col("cards_count"),
        **link,
        **sync_columns(ctx),
    }
    return envelope(project_dashboards(df), ctx.names.dashboard, attributes, relation)


def entity_questions(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Questions carry the number of their dashboards, never relations to them."""
    n = ctx.names
    link, relation = _collection_link(ctx)
    attributes = {
        "name": F.col("name"),
        "qualifiedName": qn("question", ctx.connection_qn, F.col("id")),
        "description": F.col("description"),
        "sourceURL": F.col("source_url"),
        n.attr("Query"): F.col("query"),
        n.attr("QueryType"): F.col("query_type"),
        **_history(),
        "sourceCreatedBy": F.col("created_by"),
        n.attr("DashboardCount"): F.col("dashboard_count"),
        **link,
        **sync_columns(ctx),
        n.attr("SourceDatabaseName"): F.col("database_name"),
        n.attr("SourceSchemaName"): F.col("schema_name"),
        n.attr("SourceEngine"): F.nullif("engine", F.lit("")),
    }
    return envelope(project_questions(df), n.question, attributes, relation)


def entity_bi_process(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Edge entities, one per question; inputs and outputs travel as attributes only."""
    n = ctx.names
    attributes = {
        "name": F.col("name"),
        "qualifiedName": qn("bi_process", ctx.connection_qn, F.col("question_id")),
        **sync_columns(ctx),
        "inputs": F.array(reference(n.question, qn("question", ctx.connection_qn, F.col("question_id")))),
        "outputs": F.transform("dashboard_ids", lambda d: reference(n.dashboard, qn("dashboard", ctx.connection_qn, d))),
    }
    return envelope(project_edges(df), n.bi_process, attributes)


def map_entities(df: DataFrame, type_name: str, ctx: RunContext) -> DataFrame:
    """Mapper by type name, in any case. An unknown type gives no rows; a blank
    one is an error."""
    if not (type_name or "").strip():
        raise ValueError("an entity type is required")
    n = ctx.names
    mappers = {
        n.collection: entity_collections,
        n.dashboard: entity_dashboards,
        n.question: entity_questions,
        n.bi_process: entity_bi_process,
    }
    by_dir = {name.upper(): mapper for name, mapper in mappers.items()}
    mapper = by_dir.get(type_name.upper())
    if mapper is None:
        empty = df.limit(0)
        return empty.select(*[F.lit("").alias(c) for c in ("type_dir", "qualified_name", "json")])
    return mapper(df, ctx)


def all_entities(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
