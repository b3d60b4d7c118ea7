"""Greedy word-piece lengths by a linear longest-match automaton.

The vocabulary is a trie. A node that the next character cannot leave has a failure
link: to the node of what is left after popping the longest pieces off its string,
with their number precomputed. So a word is read once, character by character, and
its pieces are counted without being built or sought again.
"""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Marks the start of a word, as the vocabulary writes it.
START = "▁"
#: Words kept with their counts; beyond it the memory is emptied, which costs time only.
MEMORY = 1_000_000


def piece_vocabulary(path: str) -> list[str]:
    """The ordinary pieces of a sentence-piece model: no control, unknown or byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not any(f(i) for f in special)]


class Automaton:
    """Longest-match-first piece counts over strings.

    A character that starts no piece counts as many pieces as it has UTF-8 bytes.
    """

    def __init__(self, pieces: list[str]):
        self.next: list[dict[str, int]] = [{}]
        is_piece = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    is_piece.append(False)
                node = self.next[node][c]
            is_piece[node] = node > 0
        self.fail, self.popped = [0] * len(self.next), [0] * len(self.next)
        level = [0]
        while level:  # by length, so that links point to finished nodes
            below = []
            for parent in level:
                for c, node in self.next[parent].items():
                    below.append(node)
                    if is_piece[node]:
                        self.popped[node] = 1
                    else:
                        popped, left = self._step(self.fail[parent], c) if parent else (len(c.encode()), 0)
                        self.popped[node], self.fail[node] = self.popped[parent] + popped, left
            level = below

    def _step(self, node: int, c: str) -> tuple[int, int]:
        """Pieces popped, and the node after, when ``c`` follows the string of ``node``."""
        popped = 0
        while c not in self.next[node]:
            if not node:
                return popped + len(c.encode()), 0
            popped += self.popped[node]
            node = self.fail[node]
        return popped, self.next[node][c]

    def count(self, text: str) -> int:
        total = node = 0
        for c in text:
            popped, node = self._step(node, c)
            total += popped
        while node:
            total += self.popped[node]
            node = self.fail[node]
        return total


class WordCounts(dict):
    """Pieces of a word (UTF-8), counted when first asked for."""

    def __init__(self, path: str):
        self.automaton = Automaton(piece_vocabulary(path))

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMORY:
            self.clear()
        self[word] = n = self.automaton.count(START + word.decode("utf-8", "replace"))
        return n


@functools.lru_cache(maxsize=2)
def word_counts(path: str) -> WordCounts:
    return WordCounts(path)


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens (long) of every row: the pieces of all its words.

    Words are runs of anything but ASCII white space; each is marked at its start and
    matched greedily against the vocabulary at ``path``. Null and blank texts have 0
    of both. Repeated and null ids keep their rows; other columns are not read.
    """

    def count(batches):
        for batch in batches:
            counts = word_counts(path)
            texts = batch.column(1).cast(pa.binary())
            words, tokens = [], []
            for value in texts:
                split = (value.as_py() or b"").split()
                words.append(len(split))
                tokens.append(sum(map(counts.__getitem__, split)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_words", "n_tokens"]
            )

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_column].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).mapInArrow(count, schema)
