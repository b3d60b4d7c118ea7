"""Packing and token counts against the libraries and brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from catloom.llm.packing import CAPACITY, Packer, cut, pack, pack_documents
from catloom.llm.token_counts import START, Automaton, piece_vocabulary, token_counts

BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", "  \n\t ", "Hello, WORLD! it's 3.14", "a<|endoftext|>B <|EndOfText|>", "Été, ǅ İstanbul  x y \x1cz é",
    "word " * 9000, "x" * 20000, "same", "same", "你好世界 \U0001f600", "ab.c,, d..!? ×÷ it.'s café.",
]


def rows(spark):
    return spark.createDataFrame([(i, t, "own", "own") for i, t in enumerate(TEXTS)] + [(None, "no id", None, None)], "doc_id long, text string, length string, piece string")


def test_pieces_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    got = {(r.doc_id, r.piece): r for r in cut(rows(spark), BPE).collect()}
    n = 0
    for doc, text in [*enumerate(TEXTS), (None, "no id")]:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), CAPACITY)):
            part = ids[start : start + CAPACITY]
            r = got[doc, piece]
            assert (r.start, r.length, r.ids_crc32) == (start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
            n += 1
    assert n == len(got)


def test_pieces_of_the_table(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ids = {r.doc_id: t.encode(r.text or "", add_special_tokens=False).ids + [1] for r in docs.collect()}
    got = pack_documents(docs, BPE).collect()
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
    assert all(r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) for r in got)


def test_word_memory_is_bounded_and_keeps_words_in_use(monkeypatch):
    from catloom.llm import packing

    monkeypatch.setattr(packing, "MEMORY", 100)
    words, learned = packing.WordIds(BPE), []
    learn = words._learn
    monkeypatch.setattr(words, "_learn", lambda new: (learned.extend(new), learn(new)))
    for i in range(50):
        text = "often Met, " + " ".join(f"w{i}x{j}" for j in range(60))
        ids = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert words([text.encode(), None]) == [np.array(ids, "<u4").tobytes(), b""]
        assert len(words.ids) + len(words.older) <= 2 * (100 + 70)
    assert learned.count(b"often") == learned.count(b"met,") == 1


@pytest.mark.parametrize("most", [1, 3, 10**6])
def test_packer_is_best_fit(most):
    rng, packer, spaces, used = random.Random(1), Packer(100, most), [], {}
    for _ in range(2000):
        n = rng.randint(1, 100)
        sequence, offset = packer.place(n)
        assert used.get(sequence, 0) == offset
        used[sequence] = offset + n
        free = min((f for f in spaces if f >= n), default=None)
        if free is not None:
            spaces.remove(free)
        elif len(spaces) == most:
            spaces.remove(min(spaces))
        free = free or 100
        assert offset == 100 - free
        if free > n:
            spaces.append(free - n)
        assert sorted(spaces) == sorted(f for f, open_ in enumerate(packer.by_free) for _ in open_)


def test_sequences_have_no_gap_and_little_waste(spark):
    from collections import defaultdict

    rng = random.Random(2)
    pieces = spark.createDataFrame([(i, min(4096, int(rng.expovariate(1 / 500)) + 1), "x") for i in range(5000)], "doc_id long, length long, offset string")
    got = pack(pieces, per_task=2000).collect()
    assert sorted(map(tuple, pack(pieces, per_task=2000).collect())) == sorted(map(tuple, got))
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by) <= sum(r.length for r in got) / 4096 + 6
    assert pack(pieces.limit(0)).count() == 0


def greedy(pieces, text):
    n = 0
    while text:
        size = next((k for k in range(len(text), 0, -1) if text[:k] in pieces), 0)
        n += 1 if size else len(text[0].encode())
        text = text[size or 1 :]
    return n


def test_automaton_equals_greedy_search():
    rng = random.Random(3)
    for _ in range(300):
        pieces = {"".join(rng.choices("abcé", k=rng.randint(1, 5))) for _ in range(rng.randint(0, 12))}
        automaton = Automaton(sorted(pieces))
        for _ in range(20):
            text = "".join(rng.choices("abcé你", k=rng.randint(0, 14)))
            assert automaton.count(text) == greedy(pieces, text), (pieces, text)


def test_token_counts(spark):
    pieces = set(piece_vocabulary(PIECES))
    docs = rows(spark).withColumnRenamed("piece", "n_tokens").union(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id + 1000", "substr(text, 1, 900)", "lang", "source"))
    for r, d in zip(token_counts(docs, PIECES).collect(), docs.collect()):
        words = (d.text or "").encode().split()
        known = {w: greedy(pieces, START + w.decode()) for w in set(words)} if len(d.text or "") < 10000 else None
        assert (r.doc_id, r.n_words) == (d.doc_id, len(words))
        if known is not None:
            assert r.n_tokens == sum(known[w] for w in words)
    assert token_counts(docs.limit(0), PIECES).count() == 0
