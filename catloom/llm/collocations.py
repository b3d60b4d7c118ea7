"""Phrase collocation mining by dynamic itemset counting.

The corpus is dealt into shards that are scanned in a cycle. Single words are counted
from the first scan on. A longer phrase is activated as soon as both phrases one word
shorter (without its last word, without its first) have reached the threshold in what
was scanned so far; it is counted from the next shard until it has completed one full
cycle. So phrases of several lengths are counted in one scan, and what is rare is never
counted beyond its words. Scans end when no active phrase is left.

When a phrase reached the threshold is kept as the number of the next scan, in a table
of fixed size addressed by the phrase's hash, which every task gets. Phrases that share
a place there share the smaller number. A longer phrase built on one of them is activated
no earlier than the phrase itself was, before which its occurrences would not be seen; so
sharing at most activates some too early: they are counted for a whole cycle all the
same, and judged by their exact count.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catloom.llm.common import LOWER, UPPER, keep, release

SHARDS, LENGTHS, THRESHOLD = 3, 4, 30
#: Places of the table for each length; more phrases than that make it coarser, not wrong.
SLOTS = 1 << 23
#: Bytes of text counted together in a task, and counts passed on at once; both bound its memory.
BLOCK, PASSED = 8_000_000, 100_000
NEVER = 255
TOP = 2000
#: Parts that a language's candidates are ranked in before the ranking of the best of each.
SALTS = 32

# Letters A-Z fold, what ends a piece becomes a line feed and a tab a space.
_FOLD = bytes.maketrans(UPPER.encode() + b".,;:!?\n\x0b\x0c\r\t", LOWER.encode() + b"\n" * 10 + b" ")


def normal_text(text: bytes) -> bytes:
    """A-Z folded, words parted by spaces, and each piece ended by a line feed that is a word of its own."""
    return (text.translate(_FOLD) + b"\n").replace(b"\n", b" \n ")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


def tagged(length, since, slot):
    """Length, first scan and place of a phrase in one number."""
    return (slot << 16) | (since << 8) | length


#: What a tag holds, in SQL.
LENGTH, SINCE, SLOT = "CAST(tag & 255 AS INT)", "CAST((tag >> 8) & 255 AS INT)", "CAST(tag >> 16 AS INT)"


def active_counts(lang: bytes, texts: pa.Array, since: list[np.ndarray], scan: int, shards: int):
    """(length, keys, since, slots, n) of the active phrases of a block of normal texts.

    ``since[length - 1]`` is the table of that length: at the slot of a phrase the first
    scan that may build on it. Keys are language, tab, words.
    """
    place = np.uint64(len(since[0]) - 1)
    tokens = pc.split_pattern(texts, b" ").flatten().dictionary_encode()
    words, a = tokens.dictionary, tokens.indices.to_numpy()
    first = pc.binary_join_element_wise(pa.scalar(lang), words, b"\t")
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, first.to_pylist()), np.uint64, len(words))
    end, blank = (pc.index(words, mark).as_py() for mark in (b"\n", b""))
    a = a[a != blank]
    is_word = np.ones(len(words), bool)
    is_word[[i for i in (end, blank) if i >= 0]] = False
    if scan < shards:
        n = np.bincount(a, minlength=len(words))
        seen = np.flatnonzero(is_word & (n > 0))
        yield 1, first.take(pa.array(seen)), np.zeros(len(seen), np.int64), (hashes[seen] & place).astype(np.int64), n[seen]
    # At each place: the number of the phrase that starts there, and when it reached the threshold.
    phrase, ready = a, np.where(is_word, since[0][hashes & place], NEVER)[a]
    parts, hashed = np.arange(len(words))[:, None], hashes
    for length in range(2, LENGTHS + 1):
        both = np.maximum(ready[:-1], ready[1:])
        at = np.flatnonzero(both <= scan)
        numbers, distinct = pd.factorize(phrase[at].astype(np.int64) * len(words) + a[at + length - 1])
        if not len(distinct):
            return
        left, last = np.divmod(distinct, len(words))
        parts = np.column_stack([parts[left], last])
        hashed = _mixed(hashed[left] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[last])
        slots = (hashed & place).astype(np.int64)
        begun = np.empty(len(distinct), np.int64)
        begun[numbers] = both[at]
        active = np.flatnonzero(scan < begun + shards)
        if len(active):
            n = np.bincount(numbers, minlength=len(distinct))[active]
            chosen = [first.take(pa.array(parts[active, 0])), *[words.take(pa.array(parts[active, i])) for i in range(1, length)]]
            yield length, pc.binary_join_element_wise(*chosen, b" "), begun[active], slots[active], n
        if length < LENGTHS:
            phrase, ready = np.zeros(len(both), np.int64), np.full(len(both), NEVER, np.uint8)
            phrase[at], ready[at] = numbers, np.maximum(since[length - 1][slots], begun.astype(np.uint8))[numbers]


def _normal(docs: DataFrame) -> DataFrame:
    """lang, text (both binary, normal) of the texts that are not empty."""

    def fold(batches):
        for batch in batches:
            texts = pa.array(map(normal_text, batch.column(1).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["lang", "text"])

    lang = F.coalesce("lang", F.lit("und")).cast("binary").alias("lang")
    return docs.where("text <> ''").select(lang, F.col("text").cast("binary").alias("text")).mapInArrow(fold, "lang binary, text binary")


def _scan(shard: DataFrame, shared, scan: int, shards: int) -> DataFrame:
    """key, tag, n: counts of one scan by block, not yet summed."""

    def count(batches):
        held, size = {}, 0

        def flush():
            for lang, texts in held.items():
                for length, keys, begun, slots, n in active_counts(lang, pa.array(texts, pa.binary()), shared.value, scan, shards):
                    tags = pa.array(tagged(length, begun, slots), pa.int64())
                    whole = pa.RecordBatch.from_arrays([keys, tags, pa.array(n, pa.int64())], names=["key", "tag", "n"])
                    for i in range(0, len(n), PASSED):
                        yield whole.slice(i, PASSED)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size >= BLOCK:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    rows = shard.select("lang", "text").mapInArrow(count, "key binary, tag long, n long")
    return rows.withColumn("key", F.col("key").cast("string"))


def _mark(table: np.ndarray, reached: DataFrame, scan: int) -> bool:
    """Enter the next scan at the unset ones of those slots; at most one row for 32 places comes back."""
    words = reached.groupBy(F.shiftright("slot", 5).alias("word")).agg(F.expr("bit_or(shiftleft(1, slot % 32))").alias("bits"))
    found = words.toArrow()
    bits = found.column("bits").to_numpy().astype(np.int32).view(np.uint32)
    word, place = np.nonzero((bits[:, None] >> np.arange(32, dtype=np.uint32)) & 1)
    slots = found.column("word").to_numpy()[word].astype(np.int64) * 32 + place
    new = slots[table[slots] == NEVER]
    table[new] = scan + 1
    return len(new) > 0


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, shards: int = SHARDS, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """lang, length, phrase, n of every phrase that occurs so often; and lang, n of all its words.

    Occurrences are counted within pieces, overlaps included, over all rows: repeated
    rows count again, null and empty texts hold nothing, a null language is ``und``.
    ``slots``, a power of two of at least 32, sizes the tables; results do not hang on it.
    """
    dealt = _normal(docs).withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int"))
    dealt = keep(dealt, "phrase-shards", "shard")
    since = [np.full(slots, NEVER, np.uint8) for _ in range(LENGTHS - 1)]
    starts = [{0}, *(set() for _ in range(LENGTHS - 1))]  # by length: scans from which some phrase is counted
    frequent, pending, words, scan = [], None, None, 0
    while any(first + shards > scan for length in starts for first in length):
        shared = docs.sparkSession.sparkContext.broadcast(since)
        found = _scan(dealt.where(F.col("shard") == scan % shards), shared, scan, shards)
        if pending is not None:
            open_ = pending.where(F.expr(SINCE) + shards > scan)
            found = found.unionByName(open_)
        # The key decides the tag, so any of its values is the value.
        before, pending = pending, keep(found.groupBy("key").agg(F.min("tag").alias("tag"), F.sum("n").alias("n")), "phrase-counts")
        shared.destroy()
        if before is not None:
            release(before)
        if scan == shards - 1:
            lang = F.expr("substr(key, 1, length(key) - length(substring_index(key, '\\t', -1)) - 1)")
            words = keep(pending.where(f"{LENGTH} = 1").groupBy(lang.alias("lang")).agg(F.sum("n").alias("n")), "phrase-words")
        often = pending.where(F.col("n") >= threshold).selectExpr("key", f"{LENGTH} AS length", f"{SINCE} AS since", f"{SLOT} AS slot", "n")
        frequent.append(keep(often.where(F.col("since") + shards == scan + 1).select("key", "length", "n"), "phrases"))
        for length in range(1, LENGTHS):
            # A phrase begins when both parts are ready, or when one began that a shared place made ready before.
            begins = {first for shorter in starts[:length] for first in shorter if first >= min(starts[length - 1], default=NEVER)}
            if any(first <= scan < first + shards for first in begins):
                if _mark(since[length - 1], often.where(F.col("length") == length), scan):
                    starts[length].add(scan + 1)
        scan += 1
    release(pending)
    release(dealt)
    phrase = F.substring_index("key", "\t", -1)
    lang = F.expr("substr(key, 1, length(key) - length(substring_index(key, '\\t', -1)) - 1)")
    whole = frequent[0]
    for part in frequent[1:]:
        whole = whole.union(part)
    return whole.select(lang.alias("lang"), "length", phrase.alias("phrase"), "n"), words


def scored(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of each phrase of two or more words that no longer one stands for.

    ``phrases``: lang, length, phrase, n, with every part of a phrase it holds.
    """
    exact = "decimal(38,0)"
    longer = phrases.where("length > 1").withColumn("words", F.split("phrase", " "))
    cuts = longer.select("lang", "length", "phrase", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    sides = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("length") - F.col("k")), " ").alias("right"),
    )
    counts = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    l = counts.toDF("lang", "left", "l")  # noqa: E741
    r = counts.toDF("lang", "right", "r")
    cut = sides.join(l, ["lang", "left"]).join(r, ["lang", "right"])
    score = F.expr(f"(CAST(a AS {exact}) * 2000000) div (CAST(l AS {exact}) + r)")
    lowest = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    # Each phrase of three or more words tells its shorter parts how often it occurs.
    parts = longer.where("length > 2").select(
        "lang",
        "n",
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, length - 1), m -> transform(sequence(1, length - m + 1),"
                " i -> array_join(slice(words, i, m), ' '))))"
            )
        ).alias("phrase"),
    )
    inside = parts.groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    kept = lowest.join(inside, ["lang", "phrase"], "left").where(
        F.expr(f"most IS NULL OR CAST(most AS {exact}) * 100 < CAST(a AS {exact}) * 80")
    )
    return kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))


def collocations(docs: DataFrame, top: int = TOP, threshold: int = THRESHOLD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first phrases.

    By score, then occurrences, descending, then by the bytes of the phrase. The best of
    each part of a language's candidates are ranked first, so that none has to be sorted whole.
    """
    phrases, words = frequent_phrases(docs, threshold)
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    part = scored(keep(phrases, "phrases-all")).withColumn("_part", salt)
    best = part.withColumn("_place", F.row_number().over(W.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_place") <= top)
    ranked = best.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
