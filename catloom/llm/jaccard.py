"""N-gram Jaccard join with a token-group matrix.

Two documents link when their sets of five-word shingles overlap by three quarters of
their union. Equal word sequences are one text. Texts that share a min-hash are held
against the one among them with the smallest share of rare tokens (of copies with
edits of their own the one they all come close to), and what links so forms a group of similar texts
(cut into blocks of bounded size). The matrix has a row for each group and each token
of its texts' prefixes: under one order of all tokens (by a sketch of how many texts have them, the commonest last), two texts
that link share a token among the first seventh of the smaller and the first quarter
of the larger, and l tokens if both are l - 1 longer. The matrix holds the shorter
prefixes, and a text asks with its longer one for what is no larger than itself. So a
passage that many texts share gets into the matrix only for texts it makes up almost
whole, which link and are one group. A text is a query to each other group it shares
enough such tokens with.
There the group's token union bounds the overlap of the query with any member, and
only groups whose bound reaches three quarters of the query are opened and compared
text by text.

Links within a group are not sought: they cannot change its component. Tokens are
64-bit hashes of shingles.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.llm.common import keep, release
from catloom.llm.graph import components

WORDS = 5
SLOTS = 8
#: Texts in a block of a group, and queries to a block in one task, about.
MEMBERS, ASKERS = 64, 1000
#: Prefixes are longer by a token for each so many, and then share one more (in the matrix, for rare tokens only).
STEP = 20
#: Slots a text shares with the head of the slot before they are compared.
ALIKE = 3
#: Counters of tokens by the leading bits of their hash, and those in a row of a task's counts.
COUNTERS, SPAN = 1 << 20, 1 << 11
#: Documents counted in one task, and tokens held until they are added up, about.
TOGETHER, HELD = 8192, 1_000_000
#: Sizes within this factor share a band; a little above 4/3, the most that links.
BAND = 1.34
#: Bits in the map of documents whose sets a step needs.
MARKS = 1 << 24
#: Bits in the map of tokens that two groups have.
TOKEN_MARKS = 1 << 26
#: Rows of a batch worked on at once.
SLICE = 500
#: Words kept with their hashes; beyond it the memory is emptied, which costs time only.
MEMORY = 1 << 18

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)
_SEEDS = np.random.default_rng(5).integers(1, 1 << 63, SLOTS, dtype=np.uint64) | np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMORY:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes]) -> np.ndarray:
    """Hashes of the distinct five-word shingles, sorted; fewer words are one shingle."""
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    if len(h) >= WORDS:
        n = len(h) - WORDS + 1
        x = sum(h[i : n + i] * f for i, f in enumerate(_FACTORS))
    elif len(h):
        x = (h * _FACTORS[: len(h)]).sum(keepdims=True) + np.uint64(len(h))
    else:
        return h
    return np.unique(mixed(x))


def least_overlap(n: int) -> int:
    """Fewest tokens that a set of n shares with any it links to."""
    return (3 * n + 3) // 4


def prefixes(n: int, rare: int) -> tuple[int, int, int]:
    """Leading tokens that a set of n, of which so many are rare, asks with, those it has in
    the matrix, and how many of the latter any larger set that it links to asks with.

    Sets of a and b that link share o >= 3 (a + b) / 7 tokens, of which the l-th stands
    among the first a - o + l of the one and b - o + l of the other. For the larger, o is
    at least 3/4 of its size, for the smaller 6/7.
    """
    asks = n - least_overlap(n) + 1 + n // STEP
    alone = n - (6 * n + 6) // 7 + 1
    more = min(n // STEP, max(0, rare - alone))
    return asks, alone + more, 1 + more


def links(common: int, a: int, b: int) -> bool:
    return 100 * common >= 75 * (a + b - common)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two sorted arrays."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _words(value) -> list[bytes]:
    return (value.as_py() or b"").lower().split()


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def _frequencies(docs: DataFrame, n_docs: int) -> np.ndarray:
    """In how many texts the tokens of each slot stand: a sketch of fixed size, over all documents.

    Only the order of tokens hangs on it. A task counts what it reads, repeated texts
    once, and passes on its counters in spans that are summed as they arrive.
    """

    def count(batches):
        counters, held, size, seen = np.zeros(COUNTERS, np.int64), [], 0, set()
        for batch in batches:
            for value in batch.column(0).cast(pa.binary()):
                words = _words(value)
                if (key := hash(tuple(words))) in seen:
                    continue
                seen.add(key)
                held.append(_slots(shingles(words)))
                size += len(held[-1])
                if size >= HELD:
                    counters += np.bincount(np.concatenate(held), minlength=COUNTERS)
                    held, size = [], 0
            if len(seen) > MEMORY:
                seen.clear()
        if held:
            counters += np.bincount(np.concatenate(held), minlength=COUNTERS)
        # A task's counter ends at 65535, which such a slot has passed in any case.
        packed = np.minimum(counters, 65535).astype("<u2").reshape(-1, SPAN)
        for at in range(0, len(packed), 256):
            part = packed[at : at + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(at, at + len(part)), pa.int32()), pa.array([x.tobytes() for x in part], pa.binary())], names=["span", "counts"]
            )

    def total(batches):
        sums = {}
        for batch in batches:
            for span, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(counts.as_buffer(), "<u2")
                sums[span] = sums[span] + x if span in sums else x.astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums, pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["span", "counts"]
        )

    counted = docs.select("text").coalesce(max(1, -(-n_docs // TOGETHER))).mapInArrow(count, "span int, counts binary")
    found = counted.repartition("span").mapInArrow(total, "span int, counts binary").toArrow()  # COUNTERS numbers
    out = np.zeros((COUNTERS // SPAN, SPAN), np.int64)
    for span, counts in zip(found.column(0).to_pylist(), found.column(1)):
        out[span] = np.frombuffer(counts.as_buffer(), np.int64)
    return np.minimum(out.ravel(), np.iinfo(np.int32).max).astype(np.int32)


def _describe(docs: DataFrame, frequencies: np.ndarray) -> DataFrame:
    """doc_id, n_shingles, print (of the words), mins, prefix, listed, need, own of every document.

    The first ``listed`` tokens of ``prefix`` go into the matrix; a larger text that links has ``need`` of them.
    ``own``: tokens of few texts among a thousand of it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequencies)  # of fixed size
    load = float(frequencies.mean())
    usual = load + 4 * load**0.5 + 3  # what tokens of few texts find in their slot

    def describe(batches):
        frequencies = shared.value
        for batch in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
            rows = []
            for value in batch.column(1).cast(pa.binary()):
                words = _words(value)
                x = shingles(words)
                if not len(x):
                    rows.append((0, None, None, None, None, None, None))
                    continue
                mins = [int(mixed(x * seed).min().view(np.int64)) for seed in _SEEDS]
                # One order of all tokens: the rarest slots first, then by hash.
                often = frequencies[_slots(x)]
                rare = int((often <= usual).sum())
                asks, listed, need = prefixes(len(x), rare)
                prefix = x[np.argsort(often, kind="stable")[:asks]]
                print_ = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
                rows.append((len(x), print_, mins, prefix.view(np.int64), listed, need, 1000 * rare // len(x)))
            n, prints, mins, prefix, listed, need, own = zip(*rows) if rows else ((), (), (), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()),
                    pa.array(mins, pa.list_(pa.int64())), pa.array(prefix, pa.list_(pa.int64())),
                    pa.array(listed, pa.int64()), pa.array(need, pa.int64()), pa.array(own, pa.int64()),
                ],
                names=["doc_id", "n_shingles", "print", "mins", "prefix", "listed", "need", "own"],
            )

    schema = "doc_id long, n_shingles long, print binary, mins array<long>, prefix array<long>, listed long, need long, own long"
    return docs.select("doc_id", "text").mapInArrow(describe, schema)


def _bitmap(places: DataFrame, size: int) -> np.ndarray:
    """A bitmap of ``size`` bits with those in the only column of ``places`` set."""
    words = places.toDF("at").groupBy(F.shiftright("at", 5).cast("int").alias("word")).agg(
        F.expr("bit_or(shiftleft(1, cast(at % 32 AS int)))").alias("bits")
    )
    found = words.toArrow()  # at most size / 32 rows of two numbers
    out = np.zeros(size // 32, np.int32)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out


def _marked(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 5] >> (at & 31).astype(np.int32)) & 1 == 1


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, tokens of at least the documents whose id is in ``ids`` (doc_id).

    A bitmap of their hashes passes few others, so that no text has to be shuffled;
    whoever joins the sets drops those.
    """
    marks = docs.sparkSession.sparkContext.broadcast(_bitmap(ids.select(F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))), MARKS))

    def tokens(batches):
        for batch in batches:
            marked = batch.filter(pa.array(_marked(marks.value, batch.column(2).to_numpy())))
            for at in range(0, marked.num_rows, SLICE):
                part = marked.slice(at, SLICE)
                sets = [shingles(_words(v)).view(np.int64) for v in part.column(1).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "tokens"])

    at = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS)).alias("at")
    return docs.where("doc_id is not null").select("doc_id", "text", at).mapInArrow(tokens, "doc_id long, tokens array<long>")


def _unsigned(scalar) -> np.ndarray:
    return scalar.values.to_numpy().view(np.uint64)


def _star_links(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b: texts that link to the head of those they share a min-hash with: the least of its own, then the smallest id.

    ``texts``: doc_id, mins, own.
    """
    slots = texts.select("doc_id", "own", F.posexplode("mins").alias("slot", "least"))
    first = F.min(F.struct("own", "doc_id"))["doc_id"].alias("head")
    heads = slots.groupBy("slot", "least").agg(first, F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("low", "high")
    shared = slots.join(heads, ["slot", "least"]).where("doc_id <> head").groupBy("doc_id", "head").agg(F.count("*").alias("slots"))
    pairs = keep(shared.where(F.col("slots") >= ALIKE).select("doc_id", "head"), "pairs")
    sets = keep(_sets(docs, pairs.select("doc_id").union(pairs.select("head")).distinct()), "sets")
    met = pairs.join(sets, "doc_id").join(sets.toDF("head", "head_tokens"), "head").select("doc_id", "head", "tokens", "head_tokens")

    def verify(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                found = []
                for a, b in zip(batch.column(2), batch.column(3)):
                    a, b = _unsigned(a), _unsigned(b)
                    found.append(links(overlap(a, b), len(a), len(b)))
                yield batch.select([0, 1]).filter(pa.array(found, pa.bool_()))

    stars = keep(met.mapInArrow(verify, "doc_id long, head long").toDF("a", "b"), "stars")
    release(sets)
    return stars


def _prefix_tokens(batch, chosen: np.ndarray):
    """token, listed, doc_id of every prefix token of the chosen rows of a batch (doc_id, listed, prefix, ...)."""
    rows = batch.filter(pa.array(chosen))
    prefix = rows.column(2)
    sizes = prefix.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    tokens = prefix.flatten().to_numpy()
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return tokens, place < np.repeat(rows.column(1).to_numpy(), sizes), np.repeat(rows.column(0).to_numpy(), sizes)


def _shared_tokens(copies: DataFrame, texts: DataFrame) -> DataFrame:
    """token, listed, doc_id of the prefix tokens that two of ``texts`` (doc_id) have, one of them in the matrix; and of a few others.

    ``copies`` (doc_id, listed, prefix) holds them among others. No prefix is
    shuffled: a bitmap of the ids passes the texts, tokens are counted and combined
    before they move, and a bitmap of those found picks their rows where they are.
    What either passes by mistake is dropped by later joins.
    """
    context = copies.sparkSession.sparkContext
    place = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))
    wanted = context.broadcast(_bitmap(texts.select(place), MARKS))
    rows = copies.select("doc_id", "listed", "prefix", place)

    def parts(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                yield part, _marked(wanted.value, part.column(3).to_numpy())

    def count(batches):
        for part, chosen in parts(batches):
            tokens, listed, _ = _prefix_tokens(part, chosen)
            # One number: how many have the token, and above 32 bits how many list it.
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(1 + (listed.astype(np.int64) << 32))], names=["token", "n"])

    counted = rows.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    several = counted.where((F.col("n") % (1 << 32) > 1) & (F.col("n") > 1 << 32))
    # Tokens are hashes: their last bits are their places.
    shared = context.broadcast(_bitmap(several.select(F.pmod("token", F.lit(TOKEN_MARKS))), TOKEN_MARKS))

    def pick(batches):
        for part, chosen in parts(batches):
            tokens, listed, doc = _prefix_tokens(part, chosen)
            use = _marked(shared.value, tokens & (TOKEN_MARKS - 1))
            yield pa.RecordBatch.from_arrays([pa.array(tokens[use]), pa.array(listed[use]), pa.array(doc[use])], names=["token", "listed", "doc_id"])

    return rows.mapInArrow(pick, "token long, listed boolean, doc_id long")


def _group_links(docs: DataFrame, copies: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b: a link between texts of different groups, at least one for any two blocks that have one.

    ``texts``: doc_id, n_shingles, need, grp; ``copies`` has their prefixes.
    """
    blocks = texts.groupBy("grp").agg(F.ceil(F.count("*") / MEMBERS).alias("blocks")).where("blocks > 1")
    block = F.pmod(F.xxhash64("doc_id"), F.coalesce(F.col("blocks"), F.lit(1)))
    band = F.floor(F.log("n_shingles") / math.log(BAND)).alias("band")  # linked sizes are in one band or in neighbours
    placed = texts.join(blocks, "grp", "left").select("doc_id", F.col("n_shingles").alias("n"), "need", "grp", block.alias("block"), band)
    placed = keep(placed.distinct(), "blocks")
    picked = keep(_shared_tokens(copies, placed.select("doc_id")).join(placed, "doc_id"), "picked-tokens")
    # Only tokens that two groups have, one in the matrix, matter.
    among = picked.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high"), F.max("listed").alias("any"))
    among = keep(among.where("low < high and any").select("token"), "two-groups")
    rows = keep(picked.join(among, "token"), "shared-tokens")
    release(picked)
    matrix = rows.where("listed").groupBy("token", "band", "grp", "block").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("need").alias("need")
    )
    matrix = keep(matrix, "matrix")
    groups = matrix.groupBy("token", "band", "grp").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    # A text links to smaller ones of its own band or of the one below.
    asking = rows.select("token", "doc_id", "n", F.col("grp").alias("own"), F.explode(F.array("band", F.col("band") - 1)).alias("band"))
    # The larger text asks; of two of one size, that of the larger group does.
    smaller = (F.col("least") < F.col("n")) | ((F.col("least") == F.col("n")) & (F.col("own") > F.col("grp")))
    fits = smaller & (4 * F.col("most") >= 3 * F.col("n"))
    # Groups first: no text meets the blocks of its own group.
    met = asking.join(groups, ["token", "band"]).where((F.col("own") != F.col("grp")) & fits).drop("least", "most")
    met = met.join(matrix, ["token", "band", "grp"]).where(fits).groupBy("doc_id", "n", "grp", "block").agg(
        F.count("*").alias("shared"), F.min("need").alias("need")
    )
    asked = keep(met.where("shared >= need").select("doc_id", "grp", "block").distinct(), "asked")
    release(rows)
    release(matrix)
    salts = asked.groupBy("grp", "block").agg(F.ceil(F.count("*") / ASKERS).alias("salts"))
    members = placed.select("doc_id", "grp", "block").join(salts, ["grp", "block"])
    sets = keep(_sets(docs, asked.select("doc_id").union(members.select("doc_id")).distinct()), "sets")
    left = members.join(sets, "doc_id").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    right = asked.join(salts, ["grp", "block"]).join(sets, "doc_id").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")))

    def open_groups(group: pa.Table, queries: pa.Table) -> pa.Table:
        a, b = [], []
        if group.num_rows and queries.num_rows:
            ids, sets = group.column("doc_id").to_pylist(), [_unsigned(s) for s in group.column("tokens")]
            union = np.unique(np.concatenate(sets))
            for doc, tokens in zip(queries.column("doc_id").to_pylist(), queries.column("tokens")):
                x = _unsigned(tokens)
                if overlap(x, union) < least_overlap(len(x)):
                    continue
                for other, y in zip(ids, sets):
                    if 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)) and links(overlap(x, y), len(x), len(y)):
                        a.append(doc)
                        b.append(other)
                        break
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    keys, cols = ["grp", "block", "salt"], ["grp", "block", "salt", "doc_id", "tokens"]
    right = right.select(*[F.col(c).alias(c) for c in cols])  # columns of its own, not those of ``left``
    opened = left.select(*cols).groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(open_groups, "a long, b long")
    between = keep(opened, "between")
    release(sets)
    return between


def link_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable by links, itself included. Null
    and blank texts have no shingle and link with nothing. Repeated rows are copies
    of one text, each with its own row; rows of one id with several texts are one
    document, which links where any of them does. Rows without id take no part in
    links: their component is null.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = keep(_describe(docs, _frequencies(docs, docs.count())), "described")
    copies = described.where("doc_id is not null and n_shingles > 0")
    heads = keep(copies.groupBy("print").agg(F.min("doc_id").alias("head")), "heads")
    same = keep(copies.select("doc_id", "print").distinct().join(heads, "print").select("doc_id", "head"), "copies")
    texts = keep(same.where("doc_id = head").select("doc_id").distinct(), "texts")
    described_texts = copies.join(texts, "doc_id", "left_semi")
    stars = _star_links(docs, described_texts.select("doc_id", "mins", "own"))
    groups = components(stars)
    grouped = described_texts.join(groups, described_texts.doc_id == groups.node, "left").select(
        "doc_id", "n_shingles", "need", F.coalesce("component", "doc_id").alias("grp")
    )
    between = _group_links(docs, copies.select("doc_id", "listed", "prefix"), grouped)
    found = components(same.toDF("a", "b").union(stars).union(between))
    out = described.select("doc_id", "n_shingles").join(found, described.doc_id == found.node, "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
