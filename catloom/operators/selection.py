"""Which collections are in scope, and what follows from that."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.functions.identity import root_key
from catloom.functions.ordering import for_join


def selection_keys(value: Any, strict: bool = True) -> frozenset[str]:
    """Ids named by one selection argument: an object, JSON text, or nothing.

    Text that is not JSON selects nothing. JSON that is not an object is an
    error, unless ``strict`` is off (readiness checks).
    """
    if isinstance(value, str):
        try:
            value = json.loads(value) if value.strip() else {}
        except json.JSONDecodeError:
            value = {}
    if not value and not isinstance(value, dict):
        value = {}
    if not isinstance(value, dict):
        if strict:
            raise ValueError("a selection must be an object of ids")
        value = {}
    return frozenset(str(k) for k in value)


@dataclass(frozen=True)
class Selection:
    """Included and excluded collection ids. No included ids means all."""

    include: frozenset[str] = field(default_factory=frozenset)
    exclude: frozenset[str] = field(default_factory=frozenset)

    @classmethod
    def parse(cls, include: Any = None, exclude: Any = None) -> "Selection":
        return cls(selection_keys(include), selection_keys(exclude))

    @classmethod
    def from_settings(cls, *sources: dict | None) -> "Selection":
        """From the first settings object that names any id, either spelling."""
        for source in sources:
            if not source:
                continue
            found = [
                selection_keys(source.get(f"{side}-collections", source.get(f"{side}_collections", {})), strict=False)
                for side in ("include", "exclude")
            ]
            if any(found):
                return cls(*found)
        return cls()


def keep_selected(df: DataFrame, key: Column, sel: Selection) -> DataFrame:
    """Rows whose key passes; excluding wins over including.

    The keys are literals of a set test, so no join is needed for them.
    """
    if sel.exclude:
        df = df.filter(~key.isin(*sorted(sel.exclude)))
    if sel.include:
        df = df.filter(key.isin(*sorted(sel.include)))
    return df


def filter_collections(collections: DataFrame, sel: Selection, ident: str = "id") -> DataFrame:
    return keep_selected(collections, root_key(F.col(ident)), sel)


def accepted_ids(collections: DataFrame, ident: str = "id") -> DataFrame:
    """Distinct root keys of the collections in scope."""
    ids = collections.select(root_key(F.col(ident)).alias("id"))
    return ids.select("id", for_join("id")).distinct().select("id")


def cascade(df: DataFrame, accepted: DataFrame, empty_means_all: bool = False, ident: str = "collection_id") -> DataFrame:
    """Dashboards or questions whose collection is accepted.

    ``empty_means_all`` keeps every row when nothing is accepted. Emptiness is a
    scalar subquery of the same plan, not a driver-side count.
    """
    key = root_key(F.col(ident))
    ids = accepted.select(F.col("id").alias("_accepted"))
    if not empty_means_all:
        return df.join(ids, key == F.col("_accepted"), "left_semi")
    nothing = ids.agg((F.count("*") == 0).alias("none")).scalar()
    marked = df.join(ids.distinct(), key == F.col("_accepted"), "left")
    return marked.filter(F.col("_accepted").isNotNull() | nothing).drop("_accepted")


def databases(df: DataFrame) -> DataFrame:
    """Databases are in scope whatever the selection."""
    return df


def non_personal(collections: DataFrame) -> DataFrame:
    """Picker nodes. An owner of 0 counts as none here."""
    owner = F.col("personal_owner_id")
    return collections.filter(owner.isNull() | (owner == 0)).select(
        F.col("id").cast("string").alias("value"),
        F.coalesce("name", F.lit("")).alias("title"),
        F.lit("collection").alias("node_type"),
    )
