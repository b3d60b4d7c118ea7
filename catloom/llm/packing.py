"""Best-fit packing of tokenised documents into sequences.

Documents become pieces of at most ``CAPACITY`` tokens. Pieces are dealt over
partitions of bounded size in an order fixed by their contents, and each partition
packs online: a piece goes into the open sequence it fills best, found in a bitset
with one bit per amount of free space. A fixed number of sequences is open; when
one more is needed, the fullest closes.
"""

from __future__ import annotations

import functools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catloom.llm.common import keep

CAPACITY = 4096
OPEN = 2048
#: Pieces in one packing task, about.
PER_TASK = 200_000
END = (1).to_bytes(4, "little")
#: Words kept with their ids before those not met since the last such turn are forgotten, which costs time only.
MEMORY = 600_000

#: Latin letters, then marks: two pre-tokens, whose ids do not depend on each other.
_PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([.,;:!?#*$%&]*)")


class WordIds:
    """Token ids of texts, as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never joins across it, so a text's ids are
    those of its words; a word goes through the tokenizer when it is new or forgotten.
    """

    def __init__(self, path: str):
        # Spark runs a task per core; the tokenizer's own threads only get in their way.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ids: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}  # the words met before ``ids`` was begun anew
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True

    def _learn(self, words: set[bytes]) -> None:
        plain, other, parts = set(), set(), []
        for word in words:
            m = _PLAIN.fullmatch(word)
            if not m:
                other.add(word)
            elif not m[2]:
                plain.add(word)
            else:
                parts.append((word, m[1], m[2]))
                plain.add(m[1])
                other.add(m[2])
        plain = list(plain.difference(self.ids))
        for at in range(0, len(plain), 2000):
            self._learn_plain(plain[at : at + 2000])
        other = list(other.difference(self.ids))
        texts = [p.decode("utf-8", "replace") for p in other]
        for part, encoded in zip(other, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            self.ids[part] = np.array(encoded.ids, "<u4").tobytes()
        for word, letters, marks in parts:
            self.ids[word] = self.ids[letters] + self.ids[marks]

    def _learn_plain(self, words: list[bytes]) -> None:
        """Words of letters alone, in one call: each ends where a piece ends a word."""
        text = b" ".join(words).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(ends) != len(words):
            raise ValueError("the vocabulary does not mark the ends of words")
        data = ids.tobytes()
        self.ids.update(zip(words, map(data.__getitem__, map(slice, [0, *ends[:-1].tolist()], ends.tolist()))))

    def __call__(self, texts: list[bytes | None]) -> list[bytes]:
        # The added tokens are told by case; other words may be lower-cased first.
        split = [[] if t is None else (t if b"<|" in t else t.lower()).split() for t in texts]
        if len(self.ids) > MEMORY:
            self.older, self.ids = self.ids, {}
        new = set().union(*split).difference(self.ids)
        unmet = new.difference(self.older)
        met = new.difference(unmet)
        self.ids.update(zip(met, map(self.older.__getitem__, met)))
        if unmet:
            self._learn(unmet)
        get = self.ids.__getitem__
        return [b"".join(map(get, words)) for words in split]


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per Python worker, which serves many tasks."""
    return WordIds(path)


def cut(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids then 1, cut at every ``capacity``.

    A null or blank text is the single id 1. Repeated and null ids keep their rows.
    """
    size = 4 * capacity

    def pieces(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                ids = word_ids(path)(batch.column(1).cast(pa.binary()).to_pylist())
                out = [
                    (row, piece, start // 4, len(part) // 4, zlib.crc32(part))
                    for row, tokens in enumerate(ids)
                    for tokens in (tokens + END,)
                    for piece, start in enumerate(range(0, len(tokens), size))
                    for part in (tokens[start : start + size],)
                ]
                row, piece, start, length, crc = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    key = docs.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", key),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).mapInArrow(pieces, schema)


class Packer:
    """Online best-fit over a bounded number of open sequences."""

    def __init__(self, capacity: int = CAPACITY, most: int = OPEN):
        self.capacity, self.most = capacity, most
        self.bits = 0  # bit f: some open sequence has f tokens free
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """Sequence (numbered from 0) and offset of a piece of that length."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            sequence = self._take(free)
        else:
            if self.open == self.most:  # the fullest has the least space
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, sequence = self.capacity, self.made
            self.made += 1
        if left := free - length:
            self.by_free[left].append(sequence)
            self.bits |= 1 << left
            self.open += 1
        return sequence, self.capacity - free

    def _take(self, free: int) -> int:
        sequence = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits ^= 1 << free
        self.open -= 1
        return sequence


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, most: int = OPEN, per_task: int = PER_TASK) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with lengths of 1 to ``capacity``.

    Rows are dealt by a hash of all their columns, so equal rows meet in one task and
    may swap places; reruns agree. Columns of those two names are replaced.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = keep(pieces.select(*columns), "pieces")
    tasks = max(1, -(-pieces.count() // per_task))
    dealt = pieces.withColumn("_at", F.xxhash64(*columns)).repartition(tasks, "_at").sortWithinPartitions("_at", *columns).drop("_at")

    def place(batches):
        packer, first = Packer(capacity, most), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [packer.place(n) for n in batch.column(length).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([first + s for s, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                names=[*columns, "sequence_id", "offset"],
            )

    extra = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    return dealt.mapInArrow(place, T.StructType([*dealt.schema.fields, *extra]))


def pack_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs`` (doc_id, text).

    No row of ``docs`` gives no piece.
    """
    return pack(cut(docs, path))
