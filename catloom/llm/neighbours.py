"""Approximate nearest neighbours with randomly rotated one-bit codes.

Every vector is scaled to length 1, rotated by a fixed random rotation and stored as
the signs of its coordinates, packed into 64-bit words, with two scalars: its length,
and how well the code aligns with it. From those, and a query's coordinates rounded
to a few bits, the inner product is estimated by counting common bits; the alignment
bounds the error of the estimate. Short vectors are padded with zeros before the
rotation, as more bits tighten the bound. In a block of codes, the vectors of the highest
estimates are scored exactly, and then all whose upper bound reaches the k-th best
of those scores. Every block of the index meets every block of queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from catloom.llm.common import keep

#: Rows of the index and of the queries in one task, about.
BLOCK, QUERIES = 8192, 2048
#: Bits of a code at least.
WIDE = 256
#: Bits of a rounded query coordinate.
BITS = 6
#: So many times the vectors asked for are scored exactly before the bound is set.
LIKELY = 4
#: Estimates held at a time.
HELD = 1 << 19
#: Standard deviations that the error bound spans.
SPAN = 2.5


def rotation(size: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix for ``size`` coordinates, padded to whole words and ``WIDE`` at least."""
    wide = max(-(-size // 64) * 64, WIDE)
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((wide, wide)))
    return (q * np.sign(np.diag(r)))[:size]


def packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1).view(np.uint64)


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of code, lengths and alignments of the rows of ``x`` (none of them zero)."""
    largest = np.abs(x).max(axis=1, keepdims=True)  # so that squares stay finite
    length = np.sqrt(((x / largest) ** 2).sum(axis=1)) * largest[:, 0]
    turned = (x / length[:, None]) @ rotation_of(x.shape[1])
    return packed(turned > 0), length, np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])


def estimates(codes: np.ndarray, align: np.ndarray, ones: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of rotated queries of length 1 with all codes, and their error bounds, both by query and code."""
    wide = turned.shape[1]
    low = turned.min(axis=1, keepdims=True)
    step = np.maximum((turned.max(axis=1, keepdims=True) - low) / ((1 << BITS) - 1), 1e-300)
    levels = np.rint((turned - low) / step).astype(np.uint8)
    common = np.zeros((len(turned), len(codes)), np.uint16 if wide << BITS < 1 << 16 else np.uint32)
    for j in range(BITS - 1, -1, -1):
        common <<= 1
        plane = packed((levels >> j) & 1)
        for word in range(plane.shape[1]):
            common += np.bitwise_count(plane[:, word, None] & codes[:, word])
    # The sum of a query's coordinates where a code has a one, twice, less the sum of all.
    dot = (common * (2 * step) + (2 * low * ones - low * wide - step * levels.sum(axis=1, keepdims=True, dtype=np.int64))) / np.sqrt(wide)
    # Variances of what a code leaves out, and of rounding, which is even within a step.
    spread = np.maximum(1 - align**2, 0) / (wide - 1) + step**2 / 12
    return dot / align, SPAN * np.sqrt(spread) / align


def nearest(x: np.ndarray, codes: np.ndarray, length: np.ndarray, align: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int):
    """For each query in turn, rows of the k largest exact inner products found, without rows of its own id, and those; ties to the smaller id."""
    size = np.abs(queries).max(axis=1, keepdims=True)
    norm = np.sqrt(((queries / size) ** 2).sum(axis=1, keepdims=True)) * size
    turned = (queries / norm) @ rotation_of(queries.shape[1])
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    slices = max(1, HELD // len(codes))
    for first in range(0, len(queries), slices):
        cosine, error = estimates(codes, align, ones, turned[first : first + slices])
        middle, high = length * cosine, length * (cosine + error)
        for at, query in enumerate(queries[first : first + slices]):
            others = np.flatnonzero(ids != own[first + at])
            if len(others) > k:
                guess = middle[at, others]
                likely = others[np.argpartition(guess, -min(LIKELY * k, len(guess)))[-LIKELY * k :]]
                least = np.partition(exact(x[likely], query), -k)[-k] / norm[first + at, 0]
                others = np.union1d(others[high[at, others] >= least - 1e-9 * abs(least)], likely)
            scores = exact(x[others], query)
            best = np.lexsort((ids[others], -scores))[:k]
            yield others[best], scores[best]


def exact(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Row by row, so that equal vectors score equally wherever they stand."""
    return (x * query).sum(axis=1)


_rotations: dict[int, np.ndarray] = {}


def rotation_of(size: int) -> np.ndarray:
    if size not in _rotations:
        _rotations[size] = rotation(size)
    return _rotations[size]


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """vec_id, embedding (double), size: rows with an id and a finite vector that is not zero."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(id_column).isNotNull() & F.coalesce(fine, F.lit(False))).select(
        F.col(id_column).cast("long").alias("vec_id"), v.alias("embedding"), F.size(v).alias("size")
    )


def build_index(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, embedding, size, code, length, align of every usable row."""

    def codes(batches):
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                code, length, align = encode(_matrix(pa.chunked_array([part.column(1)]), int(size)))
                code = pa.array([c.tobytes() for c in code], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, code, pa.array(length), pa.array(align)],
                    names=["vec_id", "embedding", "size", "code", "length", "align"],
                )

    schema = "vec_id long, embedding array<double>, size int, code binary, length double, align double"
    return keep(usable(vectors, id_column, vector).mapInArrow(codes, schema), "index")


def search(index: DataFrame, queries: DataFrame, k: int = 20, block: int = BLOCK, per_task: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k largest inner products found in the index.

    ``queries``: vec_id, embedding, size, as ``usable`` gives them. A query's own id is
    no candidate; vectors of another size are none. Equal query rows count once.
    Repeated rows of the index are candidates each. No usable rows give no result.
    """
    counts = {r.size: r["count"] for r in index.groupBy("size").count().collect()}
    asked = queries.dropDuplicates(["vec_id", "embedding"])
    askers = max(1, -(-asked.count() // per_task))
    blocks = F.lit(1)
    for size, n in counts.items():
        blocks = F.when(F.col("size") == size, F.lit(-(-n // block))).otherwise(blocks)
    left = index.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), blocks.cast("long"))).withColumn(
        "asker", F.explode(F.sequence(F.lit(0), F.lit(askers - 1)))
    )
    right = asked.withColumn("asker", F.pmod(F.xxhash64("embedding", "vec_id"), F.lit(askers)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), (blocks - 1).cast("long")))
    )

    def meet(rows: pa.Table, asking: pa.Table) -> pa.Table:
        out = {"query_id": [], "query_key": [], "vec_id": [], "score": []}
        if rows.num_rows and asking.num_rows:
            size = rows.column("size")[0].as_py()
            x, q = _matrix(rows.column("embedding"), size), _matrix(asking.column("embedding"), size)
            codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint64).reshape(len(x), -1)
            length, align = rows.column("length").to_numpy(), rows.column("align").to_numpy()
            ids = rows.column("vec_id").to_numpy()
            own = asking.column("vec_id").to_numpy()
            for asker, key, (at, scores) in zip(own.tolist(), asking.column("key").to_pylist(), nearest(x, codes, length, align, ids, q, own, k)):
                out["query_id"] += [asker] * len(at)
                out["query_key"] += [key] * len(at)
                out["vec_id"] += ids[at].tolist()
                out["score"] += scores.tolist()
        return pa.table({c: pa.array(v, pa.float64() if c == "score" else pa.int64()) for c, v in out.items()})

    keys = ("size", "block", "asker")
    found = (
        left.groupBy(*keys)
        .cogroup(right.withColumn("key", F.xxhash64("embedding")).groupBy(*keys))
        .applyInArrow(meet, "query_id long, query_key long, vec_id long, score double")
    )
    order = W.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
