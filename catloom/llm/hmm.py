"""Hidden Markov language model over words.

States emit words; every training word has emissions of its own. Baum-Welch: each task
runs the scaled forward and backward recursions over its blocks of texts and sums
expected counts, Spark adds them by word into a table, and the next round gives each
block the rows of its own words. Only how states start and move is sent to all tasks.
The first model leans the plain frequencies at random, by a fixed seed; every training
document takes part in each round, and the rounds end when the likelihood settles. A
text is scored by the exact scaled forward recursion.

A word's count in a state has one share more, as in the plain frequencies, and the
states' shares of a word never seen are its plain one.

Words are dealt into buckets by a hash. A bucket numbers its words once (slots); after
that only packed numbers travel between blocks and buckets: a word's count, and its
shares by state in half precision. The states' sums are those of the rounded shares, so
that emissions still add up to one. Emissions are kept as multiples of a word's plain
frequency.

Documents run side by side in lanes: a step of the recursion serves one word of each.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.llm.common import keep, release

STATES = 8
#: A block is full with so many words emitted, or so many different ones known in it.
EMITTED, KNOWN = 4_000_000, 1 << 19
#: Rounds end when the log likelihood a word (natural) grows by less.
SETTLED = 0.001
#: How strongly emissions lean to the plain frequencies.
LEAN = 500.0
#: Buckets of words: so many at least, and one for so many words of blocks.
BUCKETS, DEALT = 32, 1 << 20
#: Steps between two scalings, steps for which emissions are looked up at once, lanes at most.
SCALED, AHEAD, LANES = 4, 16, 512
#: The bucket of what is not counted by word.
REST = -1


def count_words(texts: DataFrame) -> DataFrame:
    """token (binary, empty for the end of a text), n of the column ``text``."""
    blocks = encode(texts.select(F.lit(0).alias("doc_id"), F.lit(False).alias("held_out"), "text"))
    return number_words(blocks).where("block IS NULL").select(F.explode(F.arrays_zip("tokens", "counts")).alias("w")).groupBy("w.tokens").agg(F.sum("w.counts").alias("n")).withColumnRenamed("tokens", "token")


def _packed(values: np.ndarray) -> bytes:
    """Numbers, compressed: all first bytes, then all second ones."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, size: int) -> np.ndarray:
    planes = pa.decompress(data, size * 4, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view(np.int32).ravel()


def encode(docs: DataFrame) -> DataFrame:
    """Blocks of texts: block, held_out, doc_ids, sizes, ids (packed places in tokens, text after text), tokens (the block's
    different ones, most frequent first), counts (of the tokens), known (how many tokens)."""

    def run(batches):
        blocks, made = {}, TaskContext.get().partitionId() << 33

        def out(held):
            nonlocal made
            number, doc_ids, sizes, ids = blocks.pop(held)
            made += 1
            ids = np.frombuffer(ids, np.int32)
            counts = np.bincount(ids, minlength=len(number))
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([made], pa.int64()), pa.array([held], pa.bool_()), pa.array([doc_ids], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int32())), pa.array([_packed(rank[ids])], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), pa.array(list(number), pa.binary()).take(pa.array(order))),
                    pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), pa.array(counts[order], pa.int64())),
                    pa.array([len(order)], pa.int64()),
                ],
                names=["block", "held_out", "doc_ids", "sizes", "ids", "tokens", "counts", "known"],
            )

        for batch in batches:
            for doc_id, held, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
                if held not in blocks:
                    blocks[held] = defaultdict(count().__next__), [], [], array("i")
                number, doc_ids, sizes, ids = blocks[held]
                words = (value.as_py() or b"").lower().split()
                words.append(b"")
                ids.extend(map(number.__getitem__, words))
                doc_ids.append(doc_id)
                sizes.append(len(words))
                if len(ids) >= EMITTED or len(number) >= KNOWN:
                    yield out(held)
        for held in list(blocks):
            yield out(held)

    encoded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text").mapInArrow(
        run, "block long, held_out boolean, doc_ids array<long>, sizes array<int>, ids binary, tokens array<binary>, counts array<long>, known long"
    )
    return keep(encoded, "encoded", compression="zstd")


def _first_shares(tokens: list[bytes]) -> np.ndarray:
    """Shares of 0.5 to 1.5 before they add up to one, by word and state, from a hash."""
    at = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))[:, None] * np.uint64(STATES) + np.arange(1, STATES + 1, dtype=np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        at = at * np.uint64(0x9E3779B97F4A7C15)
        at = (at ^ (at >> np.uint64(shift))) * np.uint64(factor)
    shares = 0.5 + (at >> np.uint64(44)) / float(1 << 20)
    return (shares / shares.sum(axis=1, keepdims=True)).astype(np.float16)


def _shares(data: bytes) -> np.ndarray:
    """By word and state, adding up to one (or zero)."""
    shares = np.frombuffer(data, np.float16).reshape(-1, STATES).astype(np.float64)
    whole = shares @ np.ones(STATES)
    whole[whole == 0] = 1
    shares /= whole[:, None]
    return shares


def number_words(encoded: DataFrame) -> DataFrame:
    """Where the blocks' words stand in buckets, and what the buckets hold at first.

    Rows with a block: bucket, block, held_out, places (in the block's tokens) and slots.
    One row without for each bucket: tokens and counts (of training) by slot, and the
    first shares and sums as ``train`` has them. Bytes are 32-bit numbers.
    """
    pairs = encoded.agg(F.sum("known")).first()[0] or 0
    buckets = max(BUCKETS, -(-pairs // DEALT))

    def deal(batches):
        for batch in batches:
            for block, held, tokens, counts in zip(*[batch.column(c) for c in ("block", "held_out", "tokens", "counts")]):
                tokens, counts = tokens.values, counts.values.to_numpy()
                to = np.fromiter(map(zlib.crc32, tokens.to_pylist()), np.uint32, len(tokens)) % np.uint32(buckets)
                order = np.argsort(to, kind="stable").astype(np.int32)
                found, first = np.unique(to[order], return_index=True)
                ends = pa.array([*first, len(order)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found, pa.int32()), pa.array([block.as_py()] * len(found), pa.int64()), pa.array([held.as_py()] * len(found), pa.bool_()),
                        pa.array([x.tobytes() for x in np.split(order, first[1:])], pa.binary()),
                        pa.ListArray.from_arrays(ends, tokens.take(pa.array(order))), pa.ListArray.from_arrays(ends, pa.array(counts[order])),
                    ],
                    names=["bucket", "block", "held_out", "places", "tokens", "counts"],
                )

    def number(key, rows):
        rows = rows.sort_by("held_out")  # so that training words have the first slots
        lists, held = rows.column("tokens").combine_chunks(), rows.column("held_out").to_numpy()
        words = lists.flatten().dictionary_encode()
        sizes = lists.value_lengths().to_numpy()
        slots, counts = words.indices.to_numpy(), rows.column("counts").combine_chunks().flatten().to_numpy()
        counts = np.bincount(slots, np.where(np.repeat(held, sizes), 0, counts), len(words.dictionary)).astype(np.int64)
        tokens, counts = words.dictionary[: (counts > 0).sum()], counts[counts > 0]
        shares = _first_shares(tokens.to_pylist())
        one = pa.array([key[0].as_py()] * (len(rows) + 1), pa.int32())
        blank = [None] * len(rows)
        return pa.table(
            [
                one, pa.array([*rows.column("block").to_pylist(), None], pa.int64()), pa.array([*held.tolist(), None], pa.bool_()),
                pa.array([*rows.column("places").to_pylist(), None], pa.binary()),
                pa.array([*[x.astype(np.int32).tobytes() for x in np.split(slots, np.cumsum(sizes)[:-1])], None], pa.binary()),
                pa.array([*blank, tokens.to_pylist()], pa.list_(pa.binary())), pa.array([*blank, counts], pa.list_(pa.int64())),
                *[pa.array([*blank, x], kind) for x, kind in zip(_sums(counts, shares), (pa.binary(), pa.binary(), pa.list_(pa.float64())))],
            ],
            names=["bucket", "block", "held_out", "places", "slots", "tokens", "counts", "n", "shares", "sums"],
        )

    dealt = encoded.select("block", "held_out", "tokens", "counts").mapInArrow(
        deal, "bucket int, block long, held_out boolean, places binary, tokens array<binary>, counts array<long>"
    )
    numbered = dealt.groupBy("bucket").applyInArrow(
        number,
        "bucket int, block long, held_out boolean, places binary, slots binary, tokens array<binary>, counts array<long>, n binary, shares binary, sums array<double>",
    )
    return keep(numbered, "hmm-words", compression="zstd")


def _sums(counts: np.ndarray, shares: np.ndarray):
    """What a bucket's row holds: n, shares, and the states' sums of them."""
    data = shares.tobytes()
    return counts.astype(np.int64).tobytes(), data, counts @ _shares(data)


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # by number of the word, then state


def lanes(texts: list[np.ndarray]):
    """Numbers by step and lane (-1: none), the lanes in which a text or the rest starts by step, and each text's (lane, first step, length)."""
    longest, total = max(map(len, texts)), sum(map(len, texts))
    ends = np.zeros(max(1, min(LANES, total // longest)), int)
    places = []
    for text in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        lane = int(ends.argmin())
        places.append((text, lane, int(ends[lane])))
        ends[lane] += len(texts[text])
    ids, starts = np.full((ends.max(), len(ends)), -1, np.int32), defaultdict(list)
    for text, lane, at in places:
        ids[at : at + len(texts[text]), lane] = texts[text]
        starts[at].append(lane)
    for lane, end in enumerate(ends.tolist()):
        starts[end].append(lane)
    return ids, starts, places


def forward(model: Model, ids: np.ndarray, starts: dict[int, list[int]], everything: bool):
    """Scales by step and lane, one where nothing is scaled; with ``everything`` also scaled forward values and emissions.

    Lanes are scaled at the end of a text and every few steps. Numbers are of the kind of the model's emissions.
    """
    steps, width = ids.shape
    kind, states = model.emit.dtype, len(model.start)
    emit = np.vstack([model.emit, np.ones((1, states), kind)])  # -1 is the last row
    ids = np.where(ids < 0, len(model.emit), ids)
    start, move, ones = model.start.astype(kind), model.move.astype(kind), np.ones(states, kind)
    scales = np.ones((steps, width))
    alphas = np.empty((steps if everything else 2, width, states), kind)
    a = np.tile(start, (width, 1))
    for t in range(steps):
        if t % AHEAD == 0:
            emits = emit.take(ids[t : t + AHEAD], axis=0)
        now = alphas[t if everything else t & 1]
        np.matmul(a, move, out=now)
        if t in starts:
            now[starts[t]] = start
        now *= emits[t % AHEAD]
        if t % SCALED == SCALED - 1 or t == steps - 1:
            scales[t] = s = now @ ones
            now /= s[:, None]
        elif t + 1 in starts:
            ended = starts[t + 1]
            scales[t, ended] = s = now[ended] @ ones
            now[ended] /= s[:, None]
        a = now
    return scales, alphas, emit


def expected(model: Model, texts: list[np.ndarray]):
    """Log likelihood (natural), and expected counts: starts, moves, emissions by number."""
    ids, starts, _ = lanes(texts)
    scales, alphas, emit = forward(model, ids, starts, True)
    (steps, width, states), words = alphas.shape, len(emit) - 1
    kind = emit.dtype
    emit[words] = 0  # nothing comes back from where no text is
    ids = np.where(ids < 0, words, ids)
    back = np.ascontiguousarray(model.move.T.astype(kind))
    moves, begun = np.zeros((states, states)), np.zeros(states)
    # Two states at once, as a complex number, are added in one go.
    sums = np.zeros((words + 1) * states + states % 2)
    beta, betas = np.ones((width, states), kind), np.empty((AHEAD, width, states), kind)
    for first in reversed(range(0, steps, AHEAD)):
        part = slice(first, min(first + AHEAD, steps))
        b = emit.take(ids[part], axis=0)
        for t in reversed(range(part.start, part.stop)):
            if t + 1 in starts:
                beta[starts[t + 1]] = 1
            now = b[t - first]
            betas[t - first] = beta
            now *= beta
            if t % SCALED == SCALED - 1 or t == steps - 1:
                now /= scales[t][:, None].astype(kind)
            elif t + 1 in starts:
                now[starts[t + 1]] /= scales[t, starts[t + 1], None].astype(kind)
            np.matmul(now, back, out=beta)
            if t in starts:
                now[starts[t]] = 0  # not moved to from the text before
        skip = int(first == 0)
        moves += alphas[first - 1 + skip : part.stop - 1].reshape(-1, states).T @ b[skip:].reshape(-1, states)
        alphas[part] *= betas[: part.stop - first]
        gammas = alphas[part].reshape(-1, states).astype(np.float64)
        at = ids[part].ravel().astype(np.intp) * states
        if states % 2 == 0:
            pairs, two = sums.view(np.complex128), gammas.view(np.complex128)
            for k in range(states // 2):
                np.add.at(pairs, at // 2 + k, two[:, k])
        else:
            for k in range(states):
                np.add.at(sums, at + k, gammas[:, k])
    for t, begin in starts.items():
        if t < steps:
            begun += alphas[t, [x for x in begin if ids[t, x] < words]].sum(axis=0, dtype=np.float64)
    numbers = np.flatnonzero(np.bincount(ids.ravel(), minlength=words)[:words])
    return float(np.log(scales).sum()), begun, moves * model.move, numbers, sums[: words * states].reshape(words, states)[numbers]


def first_moves(states: int) -> tuple[np.ndarray, np.ndarray]:
    """States start alike and last."""
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return np.full(states, 1 / states), move


def emissions(words: pa.Table, sums: np.ndarray, total: int, distinct: int, states: int):
    """Of a block's words, by their numbers: the words' counts, logs (10) of plain frequencies, and how many times these the states emit them."""
    places, n, shares = (words.column(c).to_pylist() for c in ("places", "n", "shares"))
    places = np.frombuffer(b"".join(places), np.int32)
    order = np.argsort(places)
    n = np.frombuffer(b"".join(n), np.int64)[order]
    shares = _shares(b"".join(shares))[order, :states]
    all_shares, one = float(total + distinct + 1), sums[:states] / max(total, 1)
    plain = (n + 1) / all_shares
    # (n * shares + one + LEAN * plain) / ((one * all_shares + LEAN) * plain), in place
    shares *= n[:, None]
    shares += one
    shares /= plain[:, None]
    shares += LEAN
    shares /= one * all_shares + LEAN
    return n, np.log10(plain), shares


def give(uses: DataFrame, soft: DataFrame) -> DataFrame:
    """The rows of each block's words: of (the block), bucket, places, slots, n, shares."""

    def run(uses: pa.Table, soft: pa.Table) -> pa.Table:
        slots = [np.frombuffer(x, np.int32) for x in uses.column("slots").to_pylist()]
        size = 1 + max((int(x.max()) for x in slots), default=0)
        n, shares = np.zeros(size, np.int64), np.zeros((size, STATES), np.float16)
        for counted, shared in zip(soft.column("n").to_pylist(), soft.column("shares").to_pylist()):
            counted = np.frombuffer(counted, np.int64)[:size]
            n[: len(counted)] = counted
            shares[: len(counted)] = np.frombuffer(shared, np.float16).reshape(-1, STATES)[:size]
        return pa.table(
            [
                uses.column("block"), uses.column("bucket"), uses.column("places"), uses.column("slots"),
                pa.array([n[x].tobytes() for x in slots], pa.binary()), pa.array([shares[x].tobytes() for x in slots], pa.binary()),
            ],
            names=["of", "bucket", "places", "slots", "n", "shares"],
        )

    uses = uses.select("bucket", "block", "places", "slots")
    given = uses.groupBy("bucket").cogroup(soft.select("bucket", "n", "shares").groupBy("bucket"))
    return given.applyInArrow(run, "of long, bucket int, places binary, slots binary, n binary, shares binary")


def _texts(blocks: pa.Table) -> list[np.ndarray]:
    """The numbers of each text of one block."""
    sizes = blocks.column("sizes").combine_chunks().values.to_numpy()
    return np.split(_unpacked(blocks.column("ids")[0].as_py(), int(sizes.sum())), np.cumsum(sizes)[:-1])


def _add(key, rows):
    """One bucket's counts of all blocks, as the next round takes them."""
    if key[0].as_py() == REST:
        n, shares, sums = None, None, np.sum(rows.column("sums").to_pylist(), axis=0)
    else:
        slots, counts, shares = (rows.column(c).to_pylist() for c in ("slots", "n", "shares"))
        slots, counts = np.frombuffer(b"".join(slots), np.int32), np.frombuffer(b"".join(counts), np.int64)
        shares = _shares(b"".join(shares)) * counts[:, None]
        soft = np.column_stack([np.bincount(slots, shares[:, k]) for k in range(STATES)])
        n = np.bincount(slots, counts).astype(np.int64)
        n, shares, sums = _sums(n, (soft / np.maximum(n, 1)[:, None]).astype(np.float16))
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([n], pa.binary()), pa.array([shares], pa.binary()), pa.array([sums], pa.list_(pa.float64()))], names=["bucket", "n", "shares", "sums"])


def _state_sums(soft: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The states' sums over all words, and what is not counted by word."""
    rows = soft.select("bucket", "sums").collect()
    return sum((np.array(r.sums) for r in rows if r.bucket != REST), np.zeros(STATES)), next((np.array(r.sums) for r in rows if r.bucket == REST), None)


def fit(encoded: DataFrame, numbered: DataFrame, total: int, distinct: int):
    """How states start and move, the table of the words' shares by bucket (n, shares, sums), and the states' sums.

    Fits to the rows that are not held out, all of them in each round. What reaches the
    driver each round is a few numbers for each bucket and state.
    """
    soft = numbered.where("block IS NULL").select("bucket", "n", "shares", "sums")
    uses = numbered.where("NOT held_out")
    blocks = encoded.where("NOT held_out").select("block", "sizes", "ids").groupBy("block")
    (start, move), before = first_moves(STATES), -math.inf
    (whole, _), kept = _state_sums(soft), None
    while total:

        def run(block: pa.Table, words: pa.Table) -> pa.Table:
            texts = _texts(block)
            # The table is written before start, move and whole change.
            n, _, emit = emissions(words, whole, total, distinct, STATES)
            likely, starts, moves, numbers, sums = expected(Model(start, move, emit.astype(np.float32)), texts)
            shares = np.zeros((len(n), STATES), np.float16)
            shares[numbers] = sums / sums.sum(axis=1, keepdims=True)
            counts = np.bincount(np.concatenate(texts), minlength=len(n)).astype(np.int64)
            places = [np.frombuffer(x, np.int32) for x in words.column("places").to_pylist()]
            # Starts, moves and the log likelihood go to a bucket of their own.
            rest = np.concatenate([starts, moves.ravel(), [likely]])
            return pa.table(
                [
                    pa.array([*words.column("bucket").to_pylist(), REST], pa.int32()), pa.array([*words.column("slots").to_pylist(), None], pa.binary()),
                    pa.array([*[counts[x].tobytes() for x in places], None], pa.binary()), pa.array([*[shares[x].tobytes() for x in places], None], pa.binary()),
                    pa.array([*[None] * len(places), rest], pa.list_(pa.float64())),
                ],
                names=["bucket", "slots", "n", "shares", "sums"],
            )

        counted = blocks.cogroup(give(uses, soft).groupBy("of")).applyInArrow(run, "bucket int, slots binary, n binary, shares binary, sums array<double>")
        soft = keep(counted.groupBy("bucket").applyInArrow(_add, "bucket int, n binary, shares binary, sums array<double>"), "hmm-round", compression="zstd")
        if kept is not None:
            release(kept)
        kept = soft
        whole, rest = _state_sums(soft)
        soft = soft.where(F.col("bucket") != REST)
        starts, moves = rest[:STATES] + 1, rest[STATES:-1].reshape(STATES, STATES) + 1
        start, move = starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True)
        likely = rest[-1] / total
        if likely - before < SETTLED:
            break
        before = likely
    return start, move, soft, whole


def train(encoded: DataFrame, counts: DataFrame, total: int, distinct: int):
    """How states start and move, and the expected counts of the words of ``counts`` (token, n, c by state)."""
    numbered = number_words(encoded)
    start, move, soft, _ = fit(encoded, numbered, total, distinct)

    def run(words: pa.Table, soft: pa.Table) -> pa.Table:
        tokens = words.column("tokens").combine_chunks().flatten()
        n = np.frombuffer(soft.column("n")[0].as_py(), np.int64) if len(soft) else np.zeros(0)
        found = _shares(soft.column("shares")[0].as_py()) * n[:, None] if len(soft) else np.zeros((0, STATES))
        return pa.table([tokens, *[pa.array(c) for c in found.T]], names=["token", *[f"c{k}" for k in range(STATES)]])

    words = numbered.where("block IS NULL").select("bucket", "tokens").groupBy("bucket").cogroup(soft.select("bucket", "n", "shares").groupBy("bucket"))
    return start, move, counts.join(words.applyInArrow(run, "token binary, " + ", ".join(f"c{k} double" for k in range(STATES))), "token")


def score_documents(docs: DataFrame) -> DataFrame:
    """Learn from the rows of ``docs`` (doc_id, text, held_out) not held out, score all.

    Gives doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Null and
    blank texts are the end alone. Repeated rows and ids stay. With nothing to learn
    from, every score is that of a uniform model of one word: 0.
    """
    encoded = encode(docs)
    numbered = number_words(encoded)
    sizes = numbered.where("block IS NULL").select(F.size("counts").alias("size"), F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    total, distinct = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    start, move, soft, whole = fit(encoded, numbered, total, distinct)
    if not total:
        start, move = first_moves(1)

    def run(block: pa.Table, words: pa.Table) -> pa.Table:
        texts = _texts(block)
        n, logs, emit = emissions(words, whole, total, distinct, len(start))
        ids, starts, places = lanes(texts)
        scales, _, _ = forward(Model(start, move, emit), ids, starts, False)
        sums = np.vstack([np.zeros(scales.shape[1]), np.cumsum(np.log10(scales), axis=0)])
        base = np.array([logs[t].sum() for t in texts])
        likely = base.copy()
        for text, lane, at in places:
            likely[text] += sums[at + len(texts[text]), lane] - sums[at, lane]
        known = n > 0
        doc_ids = block.column("doc_ids").combine_chunks().values
        return pa.table(
            [
                doc_ids, pa.array(block.column("held_out").to_pylist() * len(texts), pa.bool_()),
                pa.array([len(t) for t in texts], pa.int64()), pa.array([known[t].sum() for t in texts], pa.int64()),
                pa.array([total] * len(texts), pa.int64()), pa.array(base), pa.array(likely),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    given = give(numbered.where("block IS NOT NULL"), soft).groupBy("of")
    return encoded.select("block", "held_out", "doc_ids", "sizes", "ids").groupBy("block").cogroup(given).applyInArrow(run, schema)
