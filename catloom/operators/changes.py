"""What a metadata run changed since the run before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.functions.ordering import for_join

KEY = ["type_dir", "qualified_name"]


def snapshot(entities: DataFrame) -> DataFrame:
    """``(type_dir, qualified_name, content)``: a hash of each entity's record.

    Several records of one name count as the one with the greatest hash; the grouping
    combines before the shuffle, so a name on many rows stays one.
    """
    content = F.sha2("json", 256)
    return entities.groupBy(*KEY, for_join("qualified_name")).agg(F.max(content).alias("content")).drop("_half")


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two snapshots compared by one full outer join: ``(type_dir, qualified_name, content, status)``.

    ``status`` is added, changed, removed or unchanged; ``content`` is the new one, null
    for what was removed.
    """
    old = before.select(*[F.col(k).alias(f"_{k}") for k in KEY], F.col("content").alias("_content"))
    same = (F.col("type_dir") == F.col("_type_dir")) & (F.col("qualified_name") == F.col("_qualified_name"))
    status = (
        F.when(F.col("_content").isNull(), "added")
        .when(F.col("content").isNull(), "removed")
        .when(F.col("content") == F.col("_content"), "unchanged")
        .otherwise("changed")
    )
    joined = after.join(old, same, "full_outer")
    return joined.select(*[F.coalesce(k, f"_{k}").alias(k) for k in KEY], "content", status.alias("status"))


def with_records(changed: DataFrame, entities: DataFrame) -> DataFrame:
    """The record of everything that was added or changed; what was removed has none, what is unchanged drops."""
    given = entities.select(*KEY, "json", F.sha2("json", 256).alias("content")).dropDuplicates([*KEY, "content"])
    moved = changed.filter(F.col("status") != "unchanged")
    return moved.join(given, [*KEY, "content"], "left").select(*KEY, "status", "json")
