"""Parsed-SQL records to table- and column-level lineage, one narrow stage.

Each record holds its own objects and relationships, so everything here works
inside the row: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.context import RunContext
from catloom.functions import variants as V
from catloom.functions.binding import bind
from catloom.functions.identity import content_hash, qn
from catloom.functions.text import (
    dotted_name, last_segment, truncate_name, unquote_ident, upstream_path, vendor_name,
)
from catloom.operators.enrich import reference

# Names under which generations of the parser store their result.
PAYLOADS = ("parsedData", "gudusoft", "PARSED_DATA")

# Object types that are tables. An object without a type is one too.
TABLE_TYPES = ("table", "view")

# Entity types a reference may resolve to.
MATCH_TYPES = {"Table": ("Table", "View"), "Column": ("Column",)}

#: Elements of a list that are compared pairwise.
FEW = 16

#: Fields that tell a table.
TABLE_PARTS = ("vendor_name", "database", "schema", "table_name")

# Components of a reference's identity, in order.
COMPONENTS = {
    "connectorType": "vendor_name",
    "databaseName": "database",
    "schemaName": "schema",
    "tableName": "table_name",
    "columnName": "column_name",
}


def read_header(raw: Column) -> dict[str, Column]:
    """Identity, display name and SQL of a record of any generation."""
    return {
        "question_qn": V.given_or_blank(raw, "$.extra.attributes.qualifiedName", "$.QUERY_ID"),
        "question_name": V.given_or_blank(raw, "$.extra.attributes.name", "$.QUESTION_NAME"),
        "sql": V.given_or_blank(raw, "$.sql", "$.SQL"),
    }


OBJECT_KEYS = ("name", "tableName", "type", "objectType", "db", "database", "schema", "vendor_name", "vendorName")
END_KEYS = (
    "column", "name", "db", "database", "schema", "table", "tableName",
    "vendor_name", "vendorName", "parentName",
)


def _struct_of(kind: str, *keys: str) -> str:
    return f"struct<`id`:variant,`parentId`:variant,{','.join(f'`{k}`:{kind}' for k in keys)}>"


def _relationships_of(kind: str) -> str:
    end = _struct_of(kind, *END_KEYS)
    return f"array<struct<`sources`:array<{end}>,`source`:{end},`from`:{end}>>"


def _pick(texts: Column, values: Callable[[], Column], *keys: str) -> Column:
    """First of the keys with a value, else empty.

    ``texts`` holds the fields as text. ``values`` gives them as VARIANT; that
    is evaluated only where a text leaves doubt.
    """
    return F.coalesce(*[V.given_text(texts[k], F.to_json(values()[k])) for k in keys], F.lit(""))


def _json_id(c: Column) -> Column:
    """Id as JSON text, so that 1 and "1" differ; null ids match nothing."""
    return F.nullif(F.to_json(c), F.lit("null"))


def _table(vendor: Column, database: Column, schema: Column, table: Column) -> Column:
    return F.struct(
        vendor.alias("vendor_name"),
        unquote_ident(database).alias("database"),
        unquote_ident(schema).alias("schema"),
        unquote_ident(table).alias("table_name"),
    )


def typed_objects(dbobjs: Column, vendor: Column) -> Column:
    """Parsed objects (VARIANT list) as ``(id, type, t)``; ``t`` holds the vendor, which
    falls back to the record's, and the name parts without quotes.

    Elements that are not objects stay as entries without a name.
    """

    def typed(o: Column, i: Column) -> Column:
        def values() -> Column:
            return F.get(V.at(dbobjs, "$", f"array<{_struct_of('variant', *OBJECT_KEYS)}>"), i)

        own = F.nullif(_pick(o, values, "vendor_name", "vendorName"), F.lit(""))
        t = _table(F.coalesce(own, vendor), _pick(o, values, "db", "database"), _pick(o, values, "schema"), _pick(o, values, "name", "tableName"))
        return F.struct(_json_id(o["id"]).alias("id"), F.lower(_pick(o, values, "type", "objectType")).alias("type"), t.alias("t"))

    texts = V.at(dbobjs, "$", f"array<{_struct_of('string', *OBJECT_KEYS)}>")
    return F.coalesce(F.transform(texts, typed), F.array())


def table_refs(objects: Column) -> Column:
    """Tables and views among the typed objects; other kinds and nameless ones
    drop, repeats stay."""
    kept = F.filter(objects, lambda o: (o["t"]["table_name"] != "") & ((o["type"] == "") | o["type"].isin(*TABLE_TYPES)))
    return F.transform(kept, lambda o: o["t"])


def named_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once; like any column it is left out where nothing reads it."""
    return F.get(F.transform(F.array(value), use), 0)


def objects_by_id(objects: Column) -> Column:
    """The objects that have an id as ``(id, place, t)``, sorted by id, then place."""
    placed = F.transform(objects, lambda o, i: F.struct(o["id"].alias("id"), i.alias("place"), o["t"].alias("t")))
    return F.sort_array(F.filter(placed, lambda x: x["id"].isNotNull()))


def search_steps(objects: Column) -> Column:
    """Powers of two up to the length of a list, the greatest first."""
    bits = F.length(F.bin(F.size(objects)))
    return F.slice(F.array(*[F.lit(1 << k) for k in range(30, -1, -1)]), 32 - bits, bits)


def object_index(objects: Column) -> Column:
    """What ``last_with_id`` looks ids up in: the ids of a few objects, the last first, or all objects by id."""
    few = F.size(objects) <= FEW
    return F.struct(
        F.when(few, F.reverse(F.transform(objects, lambda o: o["id"]))).alias("ids"),
        F.when(~few, objects_by_id(objects)).alias("by_id"),
        F.when(~few, search_steps(objects)).alias("steps"),
    )


def last_with_id(objects: Column, index: Column, key: Column) -> Column:
    """Names ``t`` of the last object of that id; null if none has it.

    A few ids are looked through, more are found by binary search.
    """

    def search(key: Column) -> Column:
        def advance(at: Column, step: Column) -> Column:
            return F.when(F.get(index["by_id"], at + step - 1)["id"] <= key, at + step).otherwise(at)

        found = F.get(index["by_id"], F.aggregate(index["steps"], F.lit(0), advance) - 1)
        return named_once(found, lambda x: F.when(x["id"] == key, x["t"]))

    # Place 0, of an id that is not there, is past the end of the list.
    looked = F.get(objects, F.size(objects) - F.array_position(index["ids"], key).cast("int"))["t"]
    return F.when(index["ids"].isNotNull(), looked).otherwise(named_once(key, search))


def distinct_in_order(values: Column) -> Column:
    """The first of equal elements of a list, in order.

    Spark's own function compares all pairs of structs, which is quick for a few. In
    longer lists equal elements meet by a sort.
    """
    placed = F.transform(values, lambda x, i: F.struct(x.alias("x"), i.alias("place")))

    def firsts(by_value: Column) -> Column:
        first = F.filter(by_value, lambda x, i: (i == 0) | ~F.get(by_value, i - 1)["x"].eqNullSafe(x["x"]))
        return F.transform(first, lambda x: F.struct(x["place"].alias("place"), x["x"].alias("x")))

    long = F.transform(F.sort_array(named_once(F.sort_array(placed), firsts)), lambda x: x["x"])
    return F.when(F.size(values) <= FEW, F.array_distinct(values)).otherwise(long)


def column_refs(relationships: Column, objects: Column, index: Column, vendor: Column) -> Column:
    """Source columns of all relationships (VARIANT list) in order of appearance, repeats included.

    A ``sources`` list hides the single ``source`` and ``from``; without it both of these
    count. The parent of a listed source may be of any kind. Without one, the dotted
    parent name tells the table; the single ends carry the table themselves.
    """

    def picker(v: Column, value: Callable[[Column], Column], at: Column) -> Callable[..., Column]:
        def values() -> Column:
            return value(F.get(V.at(relationships, "$", _relationships_of("variant")), at))

        return lambda *keys: _pick(v, values, *keys)

    def ref(t: Column, pick: Callable[..., Column]) -> Column:
        return F.struct(t.alias("t"), unquote_ident(pick("column", "name")).alias("column_name"))

    def listed(s: Column, i: Column, r: Column) -> Column:
        pick = picker(s, lambda rel: F.get(rel["sources"], i), r)

        def told(d: Column) -> Column:
            return F.struct(vendor.alias("vendor_name"), *[d[k].alias(k) for k in ("database", "schema", "table_name")])

        parent = last_with_id(objects, index, _json_id(s["parentId"]))
        return ref(F.coalesce(parent, named_once(dotted_name(pick("parentName")), told)), pick)

    def single(rel: Column, key: str, r: Column) -> Column:
        pick = picker(rel[key], lambda value: value[key], r)
        own = F.coalesce(F.nullif(pick("vendor_name", "vendorName"), F.lit("")), vendor)
        return ref(_table(own, pick("db", "database"), pick("schema"), pick("table", "tableName")), pick)

    def ends(rel: Column, r: Column) -> Column:
        return F.coalesce(F.transform(rel["sources"], lambda s, i: listed(s, i, r)), F.array(single(rel, "source", r), single(rel, "from", r)))

    found = F.flatten(F.transform(V.at(relationships, "$", _relationships_of("string")), ends))
    refs = F.transform(
        F.filter(found, lambda x: x["column_name"] != ""),
        lambda x: F.struct(*[x["t"][k].alias(k) for k in TABLE_PARTS], x["column_name"].alias("column_name")),
    )
    return F.coalesce(refs, F.array())


def identified(records: DataFrame) -> DataFrame:
    return records.filter(F.col("question_qn") != "")


def parse_records(landed: DataFrame, default_vendor: str = "", with_columns: bool = True) -> DataFrame:
    """Parsed-SQL records ``(raw, ...)`` to header, source tables and source columns.

    The vendor of an object wins over the dialect of the record, which wins over
    ``default_vendor``. A record that names no question drops. The columns are not
    worked out where nothing reads them; ``columns_once`` is for what reads them twice.
    """
    raw = F.col("raw")
    head = identified(bind(landed.select("raw"), **read_header(raw)))
    body = bind(head, _payload=V.first_payload(raw, PAYLOADS))

    def part(key: str) -> Column:
        return F.try_element_at("_payload", F.lit(key))

    vendor, objects = F.col("vendor"), F.col("_objects")
    read = bind(body.drop("raw"), vendor=vendor_name(V.given_or_blank(part("dbvendor"), "$"), default_vendor))
    read = bind(read, _objects=typed_objects(part("dbobjs"), vendor))
    read = bind(read, tables=table_refs(objects))
    refs = ["tables"]
    if with_columns:
        found = named_once(object_index(objects), lambda index: column_refs(part("relationships"), objects, index, vendor))
        refs.append(named_once(found, distinct_in_order).alias("columns"))
    return read.select(
        "question_qn",
        last_segment(F.col("question_qn")).alias("question_id"),
        V.first_filled("question_name", "question_qn").alias("question_name"),
        "sql",
        "vendor",
        *refs,
    )


def columns_once(parsed: DataFrame) -> DataFrame:
    """The records of ``parse_records`` with their columns worked out, for operators that read them more than once."""
    return bind(parsed, columns=F.col("columns"))


def upstream_ref(ref: Column, kind: str, ctx: RunContext) -> Column:
    """Reference to a table or column elsewhere, with the identity a catalog
    resolver looks up. An edge that finds nothing is dropped by the resolver."""
    parts = [p for p in COMPONENTS.values() if kind == "Column" or p != "column_name"]
    path = upstream_path(*[ref[p] for p in parts if p != "vendor_name"])
    name = ref["column_name" if kind == "Column" else "table_name"]
    identity = F.struct(
        # Empty components become null, which the JSON leaves out.
        F.struct(*[F.nullif(ref[p], F.lit("")).alias(k) for k, p in COMPONENTS.items() if p in parts]).alias("components"),
        F.array(*[F.lit(t) for t in MATCH_TYPES[kind]]).alias("matchTypeNames"),
        path.alias("fallbackQualifiedName"),
        F.lit(kind).alias("fallbackTypeName"),
        F.lit("drop").alias("noMatchAction"),
        F.lit("pick_first").alias("lookupResultHandling"),
    )
    return F.struct(
        F.lit(kind).alias("typeName"),
        F.struct(
            name.alias("name"), path.alias("qualifiedName"), identity.alias(ctx.names.lookup_attr("Identity"))
        ).alias("attributes"),
    )


def table_ref(ref: Column, ctx: RunContext) -> Column:
    return upstream_ref(ref, "Table", ctx)


def column_ref(ref: Column, ctx: RunContext) -> Column:
    return upstream_ref(ref, "Column", ctx)


def with_process_names(parsed: DataFrame, ctx: RunContext) -> DataFrame:
    """Qualified names of the process and of the column process, hashed once."""
    ident = F.col("question_id")
    parts = (ident, F.col("sql"))
    return bind(
        parsed,
        process_qn=qn("process", ctx.connection_qn, ident, content_hash(*parts)),
        column_process_qn=qn("column_process", ctx.connection_qn, ident, content_hash(*parts, F.lit("column"))),
    )


def _record(kind: str, fallback: str, qualified_name: Column, inputs: Column, ctx: RunContext, **extra: Column) -> list[Column]:
    ident = F.col("question_id")
    shown = F.coalesce(F.nullif("question_name", F.lit("")), F.format_string(fallback, ident))
    attributes = {
        "name": truncate_name(shown),
        "qualifiedName": qualified_name,
        "connectorName": F.lit(ctx.connector_name),
        "connectionName": F.lit(ctx.connection_name),
        "connectionQualifiedName": F.lit(ctx.connection_qn),
        "tenantId": F.lit(ctx.tenant_id),
        "sql": F.col("sql"),
        **extra,
        "inputs": inputs,
        "outputs": F.array(reference(ctx.names.question, qn("question", ctx.connection_qn, ident))),
        ctx.names.lookup_attr("NestedLookupFields"): F.array(F.lit("inputs"), F.lit("outputs")),
        ctx.names.lookup_attr("NoNestedMatchAction"): F.lit("keep"),
    }
    return [
        F.lit(kind).alias("typeName"),
        F.lit("ACTIVE").alias("status"),
        F.struct(*[c.alias(n) for n, c in attributes.items()]).alias("attributes"),
    ]


def process_record(ctx: RunContext) -> list[Column]:
    inputs = F.transform("tables", lambda t: table_ref(t, ctx))
    return _record("Process", "Question %s", F.col("process_qn"), inputs, ctx)


def column_process_record(ctx: RunContext) -> list[Column]:
    """Column process below its process, which it names by qualified name."""
    inputs = F.transform("columns", lambda c: column_ref(c, ctx))
    parent = reference("Process", F.col("process_qn"))
    return _record("ColumnProcess", "Question %s columns", F.col("column_process_qn"), inputs, ctx, process=parent)


def processes(parsed: DataFrame, ctx: RunContext) -> DataFrame:
    """Processes of the records with source tables."""
    return with_process_names(parsed.filter(F.size("tables") > 0), ctx).select(*process_record(ctx))


def column_processes(parsed: DataFrame, ctx: RunContext) -> DataFrame:
    """Column processes of the records that also have a process."""
    listed = columns_once(parsed.filter(F.size("tables") > 0)).filter(F.size("columns") > 0)
    return with_process_names(listed, ctx).select(*column_process_record(ctx))


def parsed_sources(landed: DataFrame, default_vendor: str = "") -> DataFrame:
    """The records with source tables: what both record sets are made of, and no more."""
    parsed = columns_once(parse_records(landed, default_vendor).filter(F.size("tables") > 0))
    return parsed.select("question_id", "question_name", "sql", "tables", "columns")


def parsed_processes(landed: DataFrame, ctx: RunContext, default_vendor: str = "") -> DataFrame:
    """The records with source tables, parsed and named."""
    return with_process_names(parsed_sources(landed, default_vendor), ctx)


def column_records(named: DataFrame, ctx: RunContext) -> DataFrame:
    """Column processes of ``parsed_processes``."""
    return named.filter(F.size("columns") > 0).select(*column_process_record(ctx))


def lineage(landed: DataFrame, ctx: RunContext, default_vendor: str = "") -> tuple[DataFrame, DataFrame]:
    return (
        processes(parse_records(landed, default_vendor, with_columns=False), ctx),
        column_processes(parse_records(landed, default_vendor), ctx),
    )


def lineage_lines(landed: DataFrame, ctx: RunContext, default_vendor: str = "") -> DataFrame:
    """Both record sets in one pass, as ``(type_dir, qualified_name, json)``."""
    parsed = parsed_processes(landed, ctx, default_vendor)

    def line(kind: str, qualified_name: Column, json: Column) -> Column:
        return F.struct(F.lit(kind).alias("type_dir"), qualified_name.alias("qualified_name"), json.alias("json"))

    column_json = F.to_json(F.struct(*column_process_record(ctx)))
    # Lines are made in a projection, which is generated code; the generator would interpret them.
    lines = parsed.select(
        line("PROCESS", F.col("process_qn"), F.to_json(F.struct(*process_record(ctx)))).alias("_process"),
        line("COLUMNPROCESS", F.col("column_process_qn"), F.when(F.size("columns") > 0, column_json)).alias("_columns"),
    )
    return lines.select(F.inline(F.array("_process", "_columns"))).filter(F.col("json").isNotNull())
