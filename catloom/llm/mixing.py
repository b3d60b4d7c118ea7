"""Mixing sources to target weights by systematic sampling.

Each document has a number of expected copies: its source's target over its
source's size. Within a source the documents stand in order of size; expected
copies are summed along that order, shifted by one random offset, and a document
is emitted once for each whole number its stretch of the sum crosses. In size
order a source's words come as near its target as its documents allow.

Sums are whole numbers of 2**-24 copies, so that they do not depend on how rows
are grouped into tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catloom.llm.common import keep, word_count

SCALE = 1 << 24
CYCLE = (3, 1, 2)
SHARE = 1.5
MOST = 2


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target: one row per source, null being a source of its own.

    Sources in code-point order, null last, weigh ``CYCLE`` in turn and share
    ``SHARE`` of all sizes by weight. No target passes ``MOST`` times its source's
    size; the excess is shared again by weight until none does. In order of
    (cap / weight) that has a closed form: were the first i sources at their caps,
    the others would get level_i = rest / remaining weight each per unit of weight;
    the highest level_i is the true one. Windows without a partition see one row
    per source, never documents.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in CYCLE]), (place % len(CYCLE) + 1).cast("int"))
    weighed = by_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * MOST)
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto, everything = order.rowsBetween(W.unboundedPreceding, 0), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    capped = F.sum("cap").over(upto) - F.col("cap")
    heavy = F.sum("weight").over(W.partitionBy()) - F.sum("weight").over(upto) + F.col("weight")
    level = (F.lit(SHARE) * F.sum("source_size").over(W.partitionBy()) - capped) / heavy
    levelled = weighed.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return levelled.select(
        "source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target")
    )


def systematic_copies(rows: DataFrame, group: str, expected: str, order: list[str], seed: str) -> DataFrame:
    """Add ``copies`` to ``rows``: how often systematic sampling emits each.

    ``expected`` counts 2**-24 copies (long). Rows are dealt in ranges of
    (group, order), so a hot group spans many tasks: each range sums its own rows,
    and the sums of the ranges before it are added. Reruns agree, as order and
    offset (from ``seed`` and the group's name) are fixed; rows equal in every
    ordering column may swap.
    """
    names = rows.columns
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    dealt = keep(dealt.withColumn("_at", F.monotonically_increasing_id()), "systematic").withColumn("_range", F.shiftright("_at", 33))
    before = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sums = dealt.groupBy(group, "_range").agg(F.sum(expected).alias("_sum"))
    starts = sums.select(
        F.col(group).alias("_group"), F.col("_range").alias("_of"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start")
    )
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col(group), F.lit("\0"))).cast("binary")), 1, 6), 16, 10).cast("long")
    within = W.partitionBy(group, "_range").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    placed = dealt.withColumn("_end", F.sum(expected).over(within))
    placed = placed.join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
    end = F.col("_start") + F.col("_end") + offset
    crossed = F.floor(F.shiftright(end, 24)) - F.floor(F.shiftright(end - F.col(expected), 24))
    return placed.select(*names, crossed.alias("copies"))


def mix(docs: DataFrame, seed: str = "mix", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source, source_size, target, copies, taken of every document, then its columns ``carry``.

    ``carry`` is of other names than these; it comes last in the order of the documents.

    Size is the number of words, 0 for null or blank text; such documents, and
    sources of size 0, have target share 0 words whatever their copies. A null
    source is a source; null ids sort first. Repeated rows each count. No row
    gives no rows.
    """
    sizes = keep(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *carry), "mix-sizes")
    aims = targets(sizes).withColumnRenamed("source", "_source")
    joined = sizes.join(aims, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = joined.withColumn("_expected", F.floor(share * SCALE + F.lit(0.5)).cast("long"))
    taken = systematic_copies(rows, "source", "_expected", ["size", "doc_id", *carry], seed)
    words = (F.col("copies") * F.col("size")).alias("taken")
    return taken.select("doc_id", "size", "source", "source_size", "target", "copies", words, *carry)
