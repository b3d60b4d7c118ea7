"""Vector code compression with slice-and-intersect bitmasks.

Vectors become integers and are cut into equal consecutive parts; a part is replaced by
the index of the nearest of at most 64 entries of its position's codebook. To find it
exactly, each coordinate of the entries is sorted and carries prefix masks: the set of
the first i entries as bits of one uint64. The distance to a guessed entry is the
initial radius. It selects a range of each sorted coordinate, whose entries are the
difference of two prefix masks; their intersection over all coordinates holds every
entry that can be as near as the guess, and only those are measured.

All arithmetic is in integers, so codes do not depend on partitions.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.llm.common import keep

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256


class Slices:
    """The entries of one codebook, at most 64, for exact nearest search."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        bits = np.bitwise_or.accumulate(np.uint64(1) << self.order.astype(np.uint64), axis=0)
        self.prefix = np.vstack([np.zeros((1, entries.shape[1]), np.uint64), bits])

    def _squared(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return np.square(x - self.entries[entry]).sum(axis=1)

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """Mask of the entries within the distance of a first guess, for each row of ``x``."""
        at = np.minimum(np.searchsorted(self.sorted[:, 0], x[:, 0]), len(self.entries) - 1)
        # One more than the root, as its float may be rounded; more candidates do no harm.
        reach = np.sqrt(self._squared(x, self.order[at, 0])).astype(np.int64) + 1
        masks = np.full(len(x), ~np.uint64(0))
        for j in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, j], x[:, j] - reach, "left")
            high = np.searchsorted(self.sorted[:, j], x[:, j] + reach, "right")
            masks &= self.prefix[high, j] & ~self.prefix[low, j]
        return masks

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row, ties to the lower, and its squared distance."""
        found, best = np.zeros(len(x), np.int64), np.full(len(x), np.iinfo(np.int64).max)
        rows, left = np.arange(len(x)), self.candidates(x)
        while len(rows):
            lowest = left & (~left + np.uint64(1))
            entry = np.frexp(lowest.astype(np.float64))[1] - 1
            squared = self._squared(x[rows], entry)
            better = squared < best[rows]
            found[rows[better]], best[rows[better]] = entry[better], squared[better]
            left = left ^ lowest
            rows, left = rows[left != 0], left[left != 0]
        return found, best


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding (of doubles) of the rows that take part.

    A vector takes part if it is not null, holds no null and nothing non-finite.
    """
    x = F.col("embedding").cast("array<double>")
    fits = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.select("vec_id", "label", x.alias("embedding")).where(F.col("embedding").isNotNull() & fits)


def _integers(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as integers: rows, parts, components.

    A component so large that squared distances would pass 64 bits counts as the
    greatest that does not.
    """
    bound = math.isqrt((1 << 61) // dims)
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE)
    return np.clip(x, -bound, bound).astype(np.int64).reshape(-1, PARTS, dims // PARTS)


def _assign(x: np.ndarray, books: list[Slices]) -> tuple[np.ndarray, np.ndarray]:
    """Entry of each part, and the squared distances summed over parts."""
    codes, error = np.empty(x.shape[:2], np.int64), np.zeros(len(x), np.int64)
    for p, book in enumerate(books):
        codes[:, p], squared = book.nearest(x[:, p])
        error += squared
    return codes, error


def _moved(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry replaced by the floored mean of its parts; unused entries stay."""
    dims = books.shape[0] * books.shape[2]
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def tally(batches):
        slices = [Slices(b) for b in shared.value]
        sums, counts = np.zeros(shared.value.shape, np.int64), np.zeros(shared.value.shape[:2], np.int64)
        for batch in batches:
            x = _integers(batch.column(0), dims)
            codes, _ = _assign(x, slices)
            for p in range(PARTS):
                np.add.at(sums[p], codes[:, p], x[:, p])
                counts[p] += np.bincount(codes[:, p], minlength=counts.shape[1])
        part, entry = np.nonzero(counts)
        columns = [pa.array(part), pa.array(entry), pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

    rows = vectors.select("embedding").mapInArrow(tally, "part long, entry long, n long, sums array<long>")
    each = rows.select("part", "entry", "n", F.posexplode("sums").alias("at", "sum"))
    # At most one row for each component of each entry.
    totals = each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(20,0)")).alias("sum"))
    moved = books.copy()
    for r in totals.collect():
        moved[r.part, r.entry, r.at] = int(r["sum"]) // r.n
    shared.destroy()
    return moved


def first_books(vectors: DataFrame) -> np.ndarray | None:
    """Codebooks of the parts of the vectors with the smallest ids; null ids come last.

    Of rows with one id the smaller vector comes first. None if no vector is left.
    """
    seeds = vectors.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(ENTRIES).select("embedding").toArrow()
    if not seeds.num_rows:
        return None
    dims = len(seeds.column(0)[0])
    return _integers(seeds.column(0).combine_chunks(), dims).transpose(1, 0, 2).copy()


def compress(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code, error of every usable row, and the final codebooks.

    ``code`` has two hex digits a part. Repeated rows are each coded. All vectors must
    have one length, a multiple of 16; those of another than the smallest id's take no
    part, like null vectors and those with null or non-finite components. With fewer
    than 64 vectors the codebooks are smaller; without any there are no rows.
    """
    given = usable(vectors).where((F.size("embedding") > 0) & (F.size("embedding") % PARTS == 0))
    shortest = given.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(1).select(F.size("embedding").alias("n")).collect()
    rows = given.where(F.size("embedding") == (shortest[0].n if shortest else 0))
    books = first_books(rows)
    schema = "vec_id long, label int, code string, error long"
    if books is None:
        return vectors.sparkSession.createDataFrame([], schema), np.zeros((PARTS, 0, 0), np.int64)
    for _ in range(ROUNDS):
        books = _moved(rows, books)
    dims = books.shape[0] * books.shape[2]
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def code(batches):
        slices = [Slices(b) for b in shared.value]
        for batch in batches:
            codes, error = _assign(_integers(batch.column(2), dims), slices)
            texts = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"],
            )

    typed = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), "embedding")
    return typed.mapInArrow(code, schema), books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compressed_with_errors(vectors: DataFrame) -> DataFrame:
    """The codes of ``compress`` with the error summed over equal labels (null labels together).

    A sum that passes 64 bits is null. Labels join their sums by equality, so a label on
    a third of the rows is one row on the right, and its left side can be split.
    """
    codes, books = compress(vectors)
    codes = keep(codes, "codes")
    total = F.sum(F.col("error").cast("decimal(20,0)")).try_cast("long")
    labels = codes.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    joined = codes.join(labels, codes.label.eqNullSafe(labels._label), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
