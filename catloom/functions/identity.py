"""Keys, qualified names, hashes and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROOT = "root"

# Path segment of each kind of qualified name.
SEGMENTS = {
    "collection": "collections",
    "dashboard": "dashboards",
    "question": "questions",
    "bi_process": "questions_dashboards",
    "process": "question_tables",
    "column_process": "question_columns",
}

# Path segment of each kind of page on the BI server.
PAGES = {
    "collection": "collection",
    "database": "browse",
    "dashboard": "dashboard",
    "question": "question",
}

# Engine names that differ from the catalog's.
ENGINES = {"bigquery-cloud-sdk": "bigquery"}


def _col(c: Column | str) -> Column:
    return c if isinstance(c, Column) else F.lit(c)


def root_key(c: Column) -> Column:
    """Collection id as text; null, 0 and empty mean the root collection."""
    return F.coalesce(F.nullif(F.nullif(c.cast("string"), F.lit("0")), F.lit("")), F.lit(ROOT))


def qn(kind: str, connection_qn: Column | str, *parts: Column) -> Column:
    """Qualified name: connection, segment of the kind, id and (for lineage) hash."""
    return F.concat_ws("/", _col(connection_qn), F.lit(SEGMENTS[kind]), *[p.cast("string") for p in parts])


def source_url(host: Column | str, kind: str, ident: Column) -> Column:
    return F.concat(_col(host), F.lit(f"/{PAGES[kind]}/"), ident.cast("string"))


def content_hash(*parts: Column) -> Column:
    """First 12 hex digits of the md5 of the parts joined by ``|``."""
    return F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 12)


def compact_components(**parts: Column) -> Column:
    """Map of the parts without null and empty values."""
    pairs = [x for name, c in parts.items() for x in (F.lit(name), c)]
    return F.map_filter(F.create_map(*pairs), lambda _, value: F.coalesce(value != "", F.lit(False)))


def engine_name(c: Column) -> Column:
    """Catalog name of an engine; unknown engines pass through."""
    out = c
    for engine, name in ENGINES.items():
        out = F.when(c == engine, F.lit(name)).otherwise(out)
    return out
