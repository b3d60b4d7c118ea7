"""URL filters: membership in a rule list through a Bloom filter cascade.

A cascade holds a set of listed keys exactly with respect to a known universe of
keys. Level 1 is a Bloom filter of the listed keys; level 2 one of the universe's
keys that level 1 takes by mistake; level 3 one of the listed keys that level 2
takes by mistake, and so on until a level makes no mistake. A key of the universe
is listed if the first level that does not hold it is an even one. Testing is an
expression over byte literals: the pages are never joined with the list.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.llm.common import ascii_lower, keep

#: A level is a literal in the plan; longer lists are refused, never cut.
MAX_LISTED = 1_000_000


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    hashes: int
    data: bytes

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(i)), F.lit(self.bits)) for i in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        data, test = F.lit(self.data), F.lit(True)
        for at in self.positions(key):
            byte = F.conv(F.hex(F.substring(data, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
            test = test & (F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1)
        return test


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Whether the key is listed; exact for keys of the universe it was built over."""
        listed = F.lit(False)
        for level in reversed(self.levels):
            listed = level.holds(key) & ~listed
        return listed


def _level(keys: DataFrame, number: int, n: int, wrong: float) -> Level:
    """A Bloom filter of ``n`` distinct keys (column ``key``) with about that rate of false positives."""
    bits = max(64, math.ceil(n * math.log2(1 / wrong) / math.log(2)))
    bits += -bits % 8
    shape = Level(number, bits, max(1, round(math.log(2) * bits / n)) if n * 16 > bits else 8, b"")
    rows = (
        keys.select(F.explode(F.array(*shape.positions(F.col("key")))).alias("at"))
        .groupBy(F.floor(F.col("at") / 8).alias("byte"))
        .agg(F.bit_or(F.expr("shiftleft(1, cast(at % 8 AS int))")).alias("value"))
        .collect()  # at most bits / 8 rows, bounded by MAX_LISTED
    )
    data = bytearray(bits // 8)
    for row in rows:
        data[row.byte] = row.value
    return Level(number, bits, shape.hashes, bytes(data))


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Encode ``listed`` (column ``key``) so that it is told from all of ``universe`` (same column).

    Null keys take no part; repeated keys count once; an empty list gives a cascade
    that holds nothing. The universe is read twice: to size level 1, and to find its
    false positives. All later levels work on those alone, about as many as the list.
    """
    listed = keep(listed.where("key is not null").select("key").distinct(), "cascade-listed")
    n = listed.count()
    if n > MAX_LISTED:
        raise ValueError(f"{n} listed keys; a cascade takes at most {MAX_LISTED}")
    if n == 0:
        return Cascade(())
    size = universe.agg(F.approx_count_distinct("key")).first()[0]
    # A rate that leaves about as many false positives as there are listed keys.
    first = _level(listed, 1, n, min(0.5, n / (math.sqrt(2) * max(size, 1))))
    other = keep(
        universe.where(first.holds(F.col("key"))).select("key").distinct().join(listed, "key", "left_anti"), "cascade-other"
    )
    levels, inside, outside = [first], listed, other
    while count := outside.count():
        levels.append(level := _level(outside, len(levels) + 1, count, 0.5))
        inside, outside = outside, inside.where(level.holds(F.col("key")))
        if len(levels) % 6 == 0:
            outside = keep(outside, "cascade-rest")
    return Cascade(tuple(levels))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every key that could be a rule for this url: each host suffix with each path prefix of those lengths."""
    labels = F.split(host, "\\.")
    suffixes = F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    )
    prefixes = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]) if lengths else F.array().cast("array<string>")
    return F.flatten(
        F.transform(suffixes, lambda s: F.transform(F.filter(prefixes, lambda p: p.isNotNull()), lambda p: F.concat(s, p)))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to ``pages``; columns of those names are replaced.

    ``rules``: host, path (starts with ``/``), verdict ``allow`` or ``block``. A rule
    fits its host and all subdomains if the path starts with its own; the longest
    that fits decides (by length of host and path, then of the host). No rule that
    fits means the url is not listed: ``allow``, rule null. Null urls and urls
    without ``://`` have empty parts and fit nothing. Rules with a null or empty
    host, or a path without leading slash, fit nothing. A rule listed twice counts
    once; if once as allow and once as block, it blocks.
    """
    rules = rules.where("host <> '' and startswith(path, '/')").select(
        F.concat(ascii_lower(F.col("host")), F.col("path")).alias("key"), F.length("path").alias("n"), "verdict"
    )
    rules = keep(rules.groupBy("key", "n").agg(F.max(F.col("verdict") == "block").alias("block")), "url-rules")
    # Path lengths are few: paths are short, whatever the length of the list.
    lengths = sorted(r.n for r in rules.select("n").distinct().collect())
    host, path = url_parts(F.col(url))
    parts = pages.select(
        *[F.col(c) for c in pages.columns if c not in ("host", "path", "rule", "verdict")], host.alias("host"), path.alias("path")
    )
    keys = candidate_keys(F.col("host"), F.col("path"), lengths)
    universe = parts.select(F.explode(keys).alias("key"))
    listed = build_cascade(rules.select("key"), universe)
    # Which listed keys block: again a cascade, over the listed keys alone.
    blocks = build_cascade(rules.where("block").select("key"), rules.select("key"))
    fits = F.filter(keys, lambda k: listed.contains(k))
    longest = F.array_max(
        F.transform(fits, lambda k: F.struct(F.length(k).alias("n"), F.instr(k, "/").alias("at"), k.alias("key")))
    )
    judged = parts.withColumn("rule", longest["key"])
    return judged.withColumn(
        "verdict", F.when(F.col("rule").isNotNull() & blocks.contains(F.col("rule")), "block").otherwise("allow")
    )
