"""Compute an expensive column once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later operators read but never repeat.

    Spark copies a column's expression into every filter it pushes below it, and
    once more for each element when the filter loops over an array. Parsing JSON
    twice, or per element, is what that means here. A generator of one row is a
    boundary such copies do not cross; it stays inside the generated code.
    """
    kept = [c for c in df.columns if c not in columns]
    # Worked out in a projection of its own: inside the generator it would be interpreted.
    bound = df.select(*kept, F.struct(*[c.alias(n) for n, c in columns.items()]).alias("_bound"))
    return bound.select(*kept, F.inline(F.array("_bound")))
