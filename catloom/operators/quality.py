"""Readiness counts before a run, and totals after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.functions import variants as V
from catloom.operators.selection import Selection, keep_selected


def _plain_key(c: Column) -> Column:
    """Readiness checks compare the id as written: null is the text ``None``,
    and the root collection has no special key."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def landed_key(raw: Column, name: str) -> Column:
    """An id of a landed record as readiness compares it: null is ``None``, a missing key is empty."""
    field = f"$.{name}"
    return F.when(V.has_key(raw, field), _plain_key(V.at(raw, field))).otherwise(F.lit(""))


def countable_collections(collections: DataFrame, sel: Selection) -> DataFrame:
    shared = collections.filter(F.col("personal_owner_id").isNull())
    return keep_selected(shared, _plain_key(F.col("id")), sel)


def countable_items(items: DataFrame, collections: DataFrame, sel: Selection) -> DataFrame:
    """Dashboards or questions outside personal and excluded collections."""
    key = _plain_key(F.col("collection_id"))
    kept = keep_selected(items, key, sel)
    personal = (
        collections.filter(F.col("personal_owner_id").isNotNull())
        .select(_plain_key(F.col("id")).alias("_personal"))
    )
    return kept.join(personal, key == F.col("_personal"), "left_anti")


def _total(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")


def missing_native_permission(databases: DataFrame) -> DataFrame:
    """Names (or ids) of the databases without the right to run native queries."""
    permission = F.col("native_permissions")
    return databases.filter(permission.isNull() | (permission != "write")).select(
        F.coalesce("name", F.col("id").cast("string")).alias("name")
    )


def preflight_counts(
    collections: DataFrame, dashboards: DataFrame, questions: DataFrame, databases: DataFrame, sel: Selection
) -> DataFrame:
    """One ``(name, n)`` row per check; for permissions ``n`` is what is missing."""
    parts = (
        _total(countable_collections(collections, sel), "collections"),
        _total(missing_native_permission(databases), "permissions"),
        _total(countable_items(dashboards, collections, sel), "dashboards"),
        _total(countable_items(questions, collections, sel), "questions"),
    )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def readiness(checks: DataFrame) -> DataFrame:
    """Verdict over ``(name, passed)``. Collections, then permissions block the
    run; dashboards and questions only lower the verdict. Checks after a block
    are not reported."""

    def passed(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("name") == name, F.col("passed"))), F.lit(False))

    one = checks.agg(*[passed(n).alias(n) for n in ("collections", "permissions", "dashboards", "questions")])
    blocked = ~F.col("collections") | ~F.col("permissions")
    return one.select(
        F.when(blocked, F.lit("NOT_READY"))
        .when(~F.col("dashboards") | ~F.col("questions"), F.lit("PARTIAL"))
        .otherwise(F.lit("READY"))
        .alias("status"),
        F.col("collections").alias("collections_ok"),
        F.when(F.col("collections"), F.col("permissions")).alias("permissions_ok"),
        F.when(~blocked, F.col("dashboards")).alias("dashboards_ok"),
        F.when(~blocked, F.col("questions")).alias("questions_ok"),
    )


def stage_totals(**stages: DataFrame | list[DataFrame]) -> DataFrame:
    """Rows per stage; a stage of several sets counts their sum."""
    out = None
    for stage, frames in stages.items():
        for df in frames if isinstance(frames, list) else [frames]:
            part = _total(df, stage)
            out = part if out is None else out.unionByName(part)
    return out.groupBy(F.col("name").alias("stage")).agg(F.sum("n").alias("n"))
