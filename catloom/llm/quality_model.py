"""Quality classifier: naive Bayes support vectors over text n-grams.

Indicators of hashed n-grams (three to five characters across words, single words
and pairs) are scaled by the log ratio of their smoothed shares in the two classes;
a linear hinge-loss machine is fitted to the scaled rows by dual coordinate descent.
Fitted on the driver from at most ``PER_CLASS`` labelled texts of each class.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catloom.llm.common import keep
from catloom.llm.linear import dual_descent, platt, sigmoid

PER_CLASS = 2000
SIZE = 1 << 17
THRESHOLD = 0.7
#: Weight of the machine's own weights against their mean size.
BETA = 0.25


def features(text: bytes | None) -> np.ndarray:
    """Distinct hashed n-grams of a whole text, A-Z lower-cased, white space collapsed."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    a = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint64)
    grams = []
    for n in (3, 4, 5):
        if len(a) >= n:
            x = a[: len(a) - n + 1]
            for i in range(1, n):
                x = (x << np.uint64(8)) | a[i : len(a) - n + 1 + i]
            grams.append(x + np.uint64(n << 56))
    blank = np.flatnonzero(a == 32)
    # A word's number: a sum over its bytes by place, taken between its blanks.
    place = np.arange(len(a)) - np.repeat(blank, np.diff(np.append(blank, len(a))))
    power = np.power(np.uint64(0x9E3779B97F4A7C15), place.astype(np.uint64))
    word = np.add.reduceat(a * power, blank)[:-1]
    grams += [word ^ np.uint64(0x2545F4914F6CDD1D), word[:-1] * np.uint64(0xD6E8FEB86659FD93) + word[1:]]
    x = np.concatenate(grams)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    seen = np.zeros(SIZE, bool)
    seen[x >> np.uint64(64 - SIZE.bit_length() + 1)] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    ratio: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def score(self, at: np.ndarray) -> float:
        """How likely label 1 is, from a text's features."""
        r = self.ratio[at]
        norm = np.sqrt(r @ r) or 1.0
        return float(sigmoid(self.slope * (self.weights[at] @ r / norm + self.weights[-1]) + self.offset))


class Scaled:
    """The rows of a sample by number: features, and their ratios scaled to length 1, worked out when asked for."""

    def __init__(self, sample: list[np.ndarray], use: np.ndarray, ratio: np.ndarray):
        self.sample, self.use, self.ratio = sample, use, ratio

    def __len__(self) -> int:
        return len(self.use)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        at = self.sample[self.use[i]]
        r = self.ratio[at]
        return at, r / (np.sqrt(r @ r) or 1.0)


def fit(sample: list[np.ndarray], good: np.ndarray, odds: float = 1.0, beta: float = BETA) -> Model:
    """``odds``: how much likelier label 1 is among all rows than in the sample.

    Without both classes every score is the share of label 1 (0.5 without rows).
    """
    if good.all() or not good.any():
        share = good.mean() if len(good) else 0.5
        return Model(np.zeros(SIZE), np.zeros(SIZE + 1), 1.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    fold = np.arange(len(sample)) % 5 == 0  # margins of unseen rows set the probabilities
    if not (0 < good[fold].sum() < fold.sum() and 0 < good[~fold].sum() < (~fold).sum()):
        fold = np.zeros(len(sample), bool)

    def machine(use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = np.ones((2, SIZE))
        for i in use:
            counts[int(good[i])][sample[i]] += 1
        share = counts / counts.sum(1, keepdims=True)
        ratio = np.log(share[1] / share[0])
        signs = np.where(good[use], 1.0, -1.0)
        cost = len(use) / (2.0 * np.array([(signs == s).sum() for s in signs]))
        w = dual_descent(Scaled(sample, use, ratio), signs, SIZE, cost)
        w[:-1] = (1 - beta) * np.abs(w[:-1]).mean() + beta * w[:-1]
        return ratio, w

    def margins(model, use):
        m = Model(*model, 1.0, 0.0)
        p = np.array([m.score(sample[i]) for i in use])
        return np.log(p / (1 - p))

    if fold.any():
        model = machine(np.flatnonzero(~fold))
        held = np.flatnonzero(fold)
    else:
        model = machine(np.arange(len(sample)))
        held = np.arange(len(sample))
    slope, offset = platt(margins(model, held), good[held])
    return Model(*model, slope, offset + float(np.log(odds)))


def sample_ids(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[list, dict[int, int]]:
    """(doc_id, text hash, quality) of the examples, and how many there are to draw from in each class.

    Distinct documents of distinct texts; of each class those with the ``per_class``
    smallest hashes, exactly. Only ids and hashes are joined and moved, and an id or a
    text that is repeated counts once, however many rows have it.
    """
    given = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("t")).distinct()
    known = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    known = keep(given.join(known, "doc_id"), "labelled")
    counts = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    chosen = []
    for q in sorted(counts):
        order = (F.xxhash64("doc_id", "t"), "doc_id", "t")
        chosen += known.where(F.col("quality") == q).orderBy(*order).limit(per_class).select("doc_id", "t", "quality").collect()
    return [tuple(r) for r in chosen], counts


def unpacked(x: bytes) -> np.ndarray:
    """Features from the flags of all or the numbers of a few."""
    return np.flatnonzero(np.unpackbits(np.frombuffer(x, np.uint8))).astype(np.uint32) if len(x) == SIZE // 8 else np.frombuffer(x, "<u4")


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fit on the texts of ``docs`` whose id ``labels`` calls 0 or 1 in quality; other rows are no examples.

    At most ``per_class`` texts of each class reach the driver; each has at most ``SIZE``
    bits, however long it is. Texts are read by the chosen ids and never joined before.
    """
    chosen, counts = sample_ids(docs.select("doc_id", "text"), labels, per_class)

    def bits(batches):
        for batch in batches:
            for q, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                at = features(text.as_py())
                flags = np.zeros(SIZE, bool)
                flags[at] = True
                packed = np.packbits(flags).tobytes() if len(at) * 32 > SIZE else at.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([q.as_py()], pa.int32()), pa.array([packed], pa.binary())], names=["q", "x"])

    sample, good = [], np.zeros(0, bool)
    if chosen:
        ids = F.broadcast(docs.sparkSession.createDataFrame(chosen, "doc_id long, t long, q int"))  # 2 * per_class rows at most
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("t"))
        # A repeated row is one example; it is dropped before it moves.
        once = texts.join(ids, ["doc_id", "t"]).groupBy("doc_id", "t", "q").agg(F.first("text").alias("text"))
        rows = once.select("q", "text").mapInArrow(bits, "q int, x binary").toArrow().sort_by([("q", "ascending"), ("x", "ascending")])
        good = np.array(rows.column("q").to_pylist(), int) == 1
        sample = [unpacked(x.as_py()) for x in rows.column("x")]
        del rows
    odds = (counts[1] / good.sum()) / (counts[0] / (~good).sum()) if 0 < good.sum() < len(good) else 1.0
    return fit(sample, good, odds)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs``, then score (0 to 1) and predicted (1 from ``threshold`` on).

    Null, empty and blank texts have no features and get the model's constant.
    Columns of those two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    at = names.index(text)

    def run(batches):
        for batch in batches:
            found = [shared.value.score(features(t.as_py())) for t in batch.column(at).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64()), pa.array([int(s >= threshold) for s in found], pa.int32())],
                names=[*names, "score", "predicted"],
            )

    extra = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return docs.select(*names).mapInArrow(run, T.StructType([docs.schema[c] for c in names] + extra))

