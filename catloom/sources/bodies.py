"""Landed bodies that are too large for the JSON parser, cut into the elements of their list.

The parser holds no document beyond 128 MiB and no text beyond 20 million characters, so
a large list would be lost whole. Brackets and commas outside strings tell where its
elements end; each element then meets the parser on its own.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that the parser holds whatever they say; longer bodies are cut.
PARSER_HOLDS = 16 * 1024 * 1024
#: Bytes looked at together, and of elements passed on together.
WINDOW = 1 << 20

_SPACE = b" \t\n\r"
_STRUCTURAL = np.zeros(256, bool)
_STRUCTURAL[list(b"[]{},:")] = True
_DEEPER = np.zeros(256, np.int64)
_DEEPER[list(b"[{")], _DEEPER[list(b"]}")] = 1, -1


def _structure(body: np.ndarray, at: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and bytes of the brackets, commas and colons outside strings, from ``at`` on."""
    in_string, slashes = 0, 0
    for start in range(at, len(body), WINDOW):
        b = body[start : start + WINDOW]
        quotes = np.flatnonzero(b == ord('"'))
        plain = np.maximum.accumulate(np.where(b == ord("\\"), -1, np.arange(len(b))))
        # A quote is escaped after an odd run of backslashes, which may begin in the window before.
        before = np.where(quotes > 0, plain[quotes - 1], -1)
        run = quotes - 1 - before + np.where(before < 0, slashes, 0)
        quotes = quotes[run % 2 == 0]
        slashes = len(b) - 1 - plain[-1] + (slashes if plain[-1] < 0 else 0)
        places = np.flatnonzero(_STRUCTURAL[b])
        places = places[(np.searchsorted(quotes, places) + in_string) % 2 == 0]
        in_string = (in_string + len(quotes)) % 2
        yield places + start, b[places]


def _parts(body: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, int] | None:
    """Places and bytes of the commas and colons of the list or object at ``at`` itself, and where it ends."""
    depth, found = 0, []
    for places, marks in _structure(body, at):
        depths = depth + np.cumsum(_DEEPER[marks])
        depth = int(depths[-1]) if len(depths) else depth
        ends = np.flatnonzero(depths == 0)
        own = (depths == 1) & (_DEEPER[marks] == 0)
        if len(ends):
            own[ends[0] :] = False
        found.append((places[own], marks[own]))
        if len(ends):
            closing = int(places[ends[0]])
            if bytes([body[at], body[closing]]) not in (b"[]", b"{}"):
                return None
            return np.concatenate([p for p, _ in found]), np.concatenate([m for _, m in found]), closing
    return None


def _first(body: bytes | memoryview, at: int, end: int) -> int:
    """Place of the first byte from ``at`` on that is no white space; a slice would copy a long body."""
    while at < end and body[at] in _SPACE:
        at += 1
    return at


def _refuse(word: str):
    raise ValueError(word)


def _valid(text: bytes | memoryview) -> bool:
    try:
        json.loads(bytes(text), parse_constant=_refuse, parse_int=len, parse_float=len)
        return True
    except (ValueError, RecursionError):
        return False


def _elements(body: bytes | memoryview, array: np.ndarray, at: int) -> tuple[list[tuple[int, int]], int] | None:
    """Start and end of each element of the list at ``at``, and the place after the list."""
    found = _parts(array, at)
    if found is None or (found[1] != ord(",")).any():
        return None
    edges = [at, *found[0].tolist(), found[2]]
    spans = [(a + 1, b) for a, b in zip(edges, edges[1:])]
    if len(spans) == 1 and _first(body, *spans[0]) == spans[0][1]:
        spans = []
    return spans, found[2] + 1


def cut_list(body: bytes | memoryview, envelope: str | None = None) -> list[tuple[int, int]] | None:
    """Start and end of each element of a JSON list, or of the list below a key of an object.

    Any other JSON has no elements; None if the body is not JSON. The last of repeated
    keys counts.
    """
    array = np.frombuffer(body, np.uint8)
    at = _first(body, 0, len(body))
    opening = body[at : at + 1]
    if opening == b"[":
        found = _elements(body, array, at)
        if found is None or _first(body, found[1], len(body)) < len(body):
            return None
        return found[0] if all(_valid(body[a:b]) for a, b in found[0]) else None
    if opening != b"{":
        return [] if _valid(body) else None
    found = _parts(array, at)
    if found is None or _first(body, found[2] + 1, len(body)) < len(body):
        return None
    places, marks, closing = found
    colons, commas = places[marks == ord(":")].tolist(), places[marks == ord(",")].tolist()
    starts, ends = [at, *commas], [*commas, closing]
    if not colons and not commas and _first(body, at + 1, closing) == closing:
        return []
    if len(colons) != len(starts) or any(not a < c < b for a, c, b in zip(starts, colons, ends)):
        return None
    inner: list[tuple[int, int]] = []
    for start, colon, end in zip(starts, colons, ends):
        key = bytes(body[start + 1 : colon]).strip(_SPACE)
        if not key.startswith(b'"') or not _valid(key):
            return None
        value = _first(body, colon + 1, end)
        if body[value : value + 1] != b"[":
            if not _valid(body[value:end]):
                return None
            spans = []
        else:
            listed = _elements(body, array, value)
            if listed is None or _first(body, listed[1], end) < end or not all(_valid(body[a:b]) for a, b in listed[0]):
                return None
            spans = listed[0]
        if json.loads(key) == envelope:
            inner = spans
    return inner


def cut_bodies(landed: DataFrame, envelope: str | None = None) -> DataFrame:
    """The rows of ``landed`` once for each element of the list in ``body``.

    Instead of the body come ``item`` (its number from 0), ``text`` and ``length`` in
    bytes. A body that is not JSON gives one row without item and text.
    """
    others = [c for c in landed.columns if c != "body"]
    added = ["item", "text", "length"]

    def passed(kept, i, rows):
        number, text, length = zip(*rows)
        columns = [pa.array(number, pa.int32()), pa.array(text, pa.binary()).cast(pa.string()), pa.array(length, pa.int64())]
        repeated = kept.take(pa.array([i] * len(rows)))
        return pa.RecordBatch.from_arrays([*repeated.columns, *columns], names=[*others, *added])

    def cut(batches):
        for batch in batches:
            bodies, kept = batch.column(len(others)), batch.select(list(range(len(others))))
            for i in range(batch.num_rows):
                body = memoryview(bodies[i].as_buffer())
                spans = cut_list(body, envelope)
                rows, size = [], 0
                for number, (a, b) in enumerate(spans or []):
                    rows.append((number, bytes(body[a:b]).strip(_SPACE), b - a))
                    size += b - a
                    if size >= WINDOW:  # passed on at once, or the body would be held twice
                        yield passed(kept, i, rows)
                        rows, size = [], 0
                if spans is None:
                    rows = [(None, None, len(body))]
                if rows:
                    yield passed(kept, i, rows)

    schema = landed.select(*others).schema.add("item", T.IntegerType()).add("text", T.StringType()).add("length", T.LongType())
    return landed.select(*others, F.col("body").cast("binary").alias("body")).mapInArrow(cut, schema)
