"""Arrival order as a column.

Spark rows have no order, yet "last one wins" and "in order of appearance" need
one. ``seq`` is a struct (source, block, row, item): the file, the start of its
split, the row within it and the place inside a landed array (null outside one).
Card slots add a fifth field, ``slot``. It compares field by field, and
``slice_of`` cuts it into stretches of bounded length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 65536
SLICE_ROWS = 4096


def seq_from_file() -> Column:
    """For rows of a text scan. Splits depend on the files alone, so it repeats."""
    return F.struct(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.lit(None).cast("int").alias("item"),
    )


def seq_from_number(c: Column, width: int = BLOCK_ROWS, source: str = "") -> Column:
    """For tables that carry an ordering number."""
    n = c.cast("bigint")
    return F.struct(
        F.lit(source).alias("source"),
        F.floor(n / F.lit(width)).cast("bigint").alias("block"),
        n.alias("row"),
        F.lit(None).cast("int").alias("item"),
    )


def with_slot(seq: Column, slot: Column) -> Column:
    """Places inside one record, in order after the record's own place."""
    return F.struct(*[seq[f].alias(f) for f in ("source", "block", "row", "item")], slot.alias("slot"))


def slice_of(seq: Column) -> Column:
    """A stretch of at most ``SLICE_ROWS`` records. Stretches compare as their records do.

    Rows of a source either all hold one record or are all landed lists. The
    first are cut by row; a list is cut by item.
    """
    row, item = seq["row"], seq["item"]
    return F.struct(
        seq["source"].alias("source"),
        seq["block"].alias("block"),
        F.when(item.isNull(), row - F.pmod(row, F.lit(SLICE_ROWS))).otherwise(row).alias("row"),
        F.floor(item / SLICE_ROWS).alias("item"),
    )


def for_join(key: str) -> Column:
    """Second grouping column, decided by the key, for groups that join by the key.

    Adaptive execution splits a hot partition of the other side only if both
    sides of the join come straight from a shuffle. Groups by the key alone
    would be joined where they are; with this column they get their own shuffle,
    unless Spark finds them small enough to broadcast.
    """
    return F.pmod(F.xxhash64(key), F.lit(2)).alias("_half")


def last_wins(df: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Latest row per key. ``max_by`` combines before the shuffle, so a key with
    many copies sends one row per task."""
    rest = [c for c in df.columns if c != key]
    return (
        df.groupBy(key, for_join(key))
        .agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_last"))
        .select(F.col(key), *[F.col("_last")[c].alias(c) for c in rest])
    )
