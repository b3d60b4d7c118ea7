"""Language identification: the family first, then machines between its languages.

Texts become counts of hashed letter n-grams over their sum. One-versus-rest linear
support vector machines choose the language family; within it a machine for each
pair of its languages votes. All are fitted on the driver from a bounded sample of
labelled rows (``PER_LANGUAGE`` of each, about, chosen by a hash of the id).
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catloom.llm.linear import dual_descent, sigmoid

PER_LANGUAGE = 400
SIZE = 1 << 15
UNKNOWN = "und"

# Language codes by family; a code that is not here is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt ug uz",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "semitic": "am ar he mt",
    "sinitic": "yue zh",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

#: A-Z lower-cased, other ASCII characters blank, bytes of other characters as they are.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def ngrams(text: bytes) -> np.ndarray:
    """Hashed n-grams of one to three bytes over the whole text, words set apart by one blank."""
    a = np.frombuffer(b" " + b" ".join(text.translate(_LETTERS).split()) + b" ", np.uint8).astype(np.uint32)
    two = (a[:-1] << np.uint32(8)) | a[1:]
    three = (two[:-1] << np.uint32(8)) | a[2:]
    shift = np.uint32(32 - SIZE.bit_length() + 1)
    return np.concatenate([a, (two * np.uint32(2654435761)) >> shift, ((three * np.uint32(2246822519)) ^ np.uint32(0x5BD1E995)) >> shift])


@dataclass
class Model:
    families: list[str]
    members: list[list[str]]
    #: Columns: one machine per family, then the pairs of each family in order.
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, text: bytes | None) -> tuple[str, float]:
        if not text or not self.families or not has_letter(text.decode("utf-8", "replace")):
            return UNKNOWN, 0.0
        at = ngrams(text)
        margins = self.weights[at].sum(0, dtype=np.float64) / len(at) + self.bias
        n = len(self.families)
        chances = sigmoid(2 * margins[:n])
        family = int(margins[:n].argmax())
        score = float(chances[family] / chances.sum())
        names = self.members[family]
        start = n + sum(len(m) * (len(m) - 1) // 2 for m in self.members[:family])
        votes, sums = np.zeros(len(names)), np.zeros(len(names))
        sure = np.ones(len(names))
        for m, (i, j) in zip(margins[start:], itertools.combinations(range(len(names)), 2)):
            votes[i if m > 0 else j] += 1
            sums[i] += m
            sums[j] -= m
            sure[i] = min(sure[i], sigmoid(2 * m))
            sure[j] = min(sure[j], sigmoid(-2 * m))
        best = max(range(len(names)), key=lambda k: (votes[k], sums[k]))
        return names[best], score * float(sure[best])


def fit(sample: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """``sample``: language, n-gram indexes, their counts. Without rows the model knows no language."""
    languages = sorted({lang for lang, _, _ in sample})
    families = sorted({FAMILY_OF.get(x, x) for x in languages})
    members = [[x for x in languages if FAMILY_OF.get(x, x) == f] for f in families]
    rows = [(at, counts / counts.sum()) for _, at, counts in sample]
    scale = 1 / np.mean([np.sqrt(v @ v) for _, v in rows]) if rows else 1.0
    rows = [(at, v * scale) for at, v in rows]
    of = np.array([lang for lang, _, _ in sample], dtype=object)
    kin = np.array([FAMILY_OF.get(x, x) for x in of], dtype=object)
    machines = []

    def machine(among: np.ndarray, first: np.ndarray):
        use = np.flatnonzero(among)
        signs = np.where(first[use], 1.0, -1.0)
        share = np.array([(signs == s).sum() for s in signs])  # both sides weigh the same
        cost = 10.0 * len(signs) / (2.0 * share)
        machines.append(dual_descent([rows[i] for i in use], signs, SIZE, cost))

    for f in families:
        if len(families) > 1:
            machine(np.ones(len(rows), bool), kin == f)
        else:
            machines.append(np.append(np.zeros(SIZE), 1.0))
    for names in members:
        for a, b in itertools.combinations(names, 2):
            machine((of == a) | (of == b), of == a)
    w = np.array(machines).T if machines else np.zeros((SIZE + 1, 0))
    return Model(families, members, (w[:-1] * scale).astype(np.float32), w[-1])


def _counted(batches):
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            if has_letter(text.decode("utf-8", "replace")):
                at, counts = np.unique(ngrams(text), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([at.astype("<u2").tobytes()], pa.binary()), pa.array([counts.astype("<f4").tobytes()], pa.binary())],
                    names=["lang", "at", "counts"],
                )


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on rows with doc_id, text, lang; rows with a null among them are no examples.

    The sample that reaches the driver has about ``per_language`` rows of each
    language, each with at most ``SIZE`` numbers, however long its text.
    """
    known = labelled.where("doc_id is not null and lang is not null")
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return fit([])
    rate = F.lit(0.0)
    for lang, n in counts.items():
        rate = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / n))).otherwise(rate)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.where((draw < rate) & F.col("text").isNotNull()).select("lang", "text")
    rows = chosen.mapInArrow(_counted, "lang string, at binary, counts binary").collect()
    rows.sort(key=lambda r: (r.lang, bytes(r.at), bytes(r.counts)))
    return fit([(r.lang, np.frombuffer(r.at, "<u2"), np.frombuffer(r.counts, "<f4").astype(float)) for r in rows])


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row.

    ``und`` and 0 for null or empty texts, texts without a letter, and a model that
    knows no language. Repeated and null ids keep their rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size per language pair

    def predict(batches):
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_column].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).mapInArrow(predict, schema)
