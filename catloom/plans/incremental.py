"""Metadata runs that emit only what changed since the run before."""

from __future__ import annotations

from pyspark.sql import DataFrame

from catloom.operators import changes as C
from catloom.plans.stages import Stages

_SNAPSHOT = "type_dir string, qualified_name string, content string"


def run_incremental(entities: DataFrame, root: str, run: str, before: str | None = None) -> DataFrame:
    """Added, changed and removed entities, ``(type_dir, qualified_name, status, json)``.

    The snapshot of each run is kept below ``root``; ``before`` names the run to compare
    with, none for the first. A run that is repeated replaces its own snapshot, so it
    emits the same again.
    """
    if before == run:
        raise ValueError("a run has to be compared with another one")
    spark = entities.sparkSession

    def of(name: str) -> str:
        return f"{root.rstrip('/')}/{name}/processed/snapshot"

    old = spark.read.schema(_SNAPSHOT).parquet(of(before)) if before else spark.createDataFrame([], _SNAPSHOT)
    stages = Stages(
        spark,
        f"{root.rstrip('/')}/{run}",
        {
            "entities": lambda: entities.select("type_dir", "qualified_name", "json"),
            "snapshot": lambda: C.snapshot(stages["entities"]),
            "changes": lambda: C.with_records(C.changes(old, stages["snapshot"]), stages["entities"]),
        },
    )
    return stages["changes"]
