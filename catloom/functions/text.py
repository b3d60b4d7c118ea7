"""Text expressions: identifiers, names, markup."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_LIMIT = 10000


def unquote_ident(c: Column) -> Column:
    """Strip one layer of double quotes or backticks when both ends carry it."""
    return F.regexp_replace(c, '(?s)^(["`])(.*)\\1\\z', "$2")


def dotted_name(c: Column) -> Column:
    """``db.schema.table`` to a struct; shorter names fill from the right.

    The split comes first and the quotes go afterwards, so a dot inside quotes
    still separates.
    """

    def named(parts: Column) -> Column:
        n = F.size(parts)
        blank = F.lit("")
        db = F.when(n >= 3, F.get(parts, 0)).otherwise(blank)
        schema = F.when(n >= 3, F.get(parts, 1)).when(n == 2, F.get(parts, 0)).otherwise(blank)
        table = F.when(n >= 3, F.array_join(F.slice(parts, 3, n), ".")).otherwise(F.get(parts, n - 1))
        return F.struct(
            unquote_ident(db).alias("database"),
            unquote_ident(schema).alias("schema"),
            unquote_ident(table).alias("table_name"),
        )

    parts = F.split(F.coalesce(c, F.lit("")), "\\.", -1)
    # The one-element transform names the parts, so they are split only once.
    return F.get(F.transform(F.array(parts), named), 0)


def vendor_name(c: Column, default: Column | str = "") -> Column:
    """Dialect token: drop a leading ``db`` in any case, then lowercase."""
    default = F.lit(default) if isinstance(default, str) else default
    bare = F.lower(F.regexp_replace(c, "(?i)^db", ""))
    return F.coalesce(F.nullif(bare, F.lit("")), default)


def last_segment(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def truncate_name(c: Column, limit: int = NAME_LIMIT) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 1), F.lit("…"))).otherwise(c)


def upstream_path(*parts: Column) -> Column:
    """Join the non-empty parts with ``/``."""
    return F.concat_ws("/", *[F.nullif(p, F.lit("")) for p in parts])


# Fixed values of HTML5: what can be a reference, and what the numbers of a C1 control stand for.
REFERENCE = "&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)"
C1 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"
REPLACEMENT = "\ufffd"


def _table(names: dict[str, str]) -> Column:
    """A constant map; Spark searches it from the front, so it is split by first letter."""
    by_letter: dict[str, dict[str, str]] = {}
    for name, value in names.items():
        by_letter.setdefault(name[0], {})[name] = value
    return F.from_json(F.lit(json.dumps(by_letter, ensure_ascii=False)), "map<string,map<string,string>>")


def _look_up(table: Column, name: Column) -> Column:
    return F.element_at(F.element_at(table, F.substring(name, 1, 1)), name)


def code_point(n: Column) -> Column:
    """The character of a code point; the leading mark tells the decoder its byte order."""
    return F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(n.cast("long")), 8, "0"))), "UTF-32")


def _numbered(ref: Column) -> Column:
    """What ``#65``, ``#65;`` or ``#x41;`` stands for."""
    digits = F.regexp_extract(ref, "^#[xX]?0*([0-9a-fA-F]*)", 1)
    sixteen = F.lower(F.substring(ref, 2, 1)) == "x"
    # Digits beyond those of the last code point, U+10FFFF, are not converted.
    fits = F.length(digits) <= F.when(sixteen, 6).otherwise(7)
    read = F.when(sixteen, F.conv(digits, 16, 10)).otherwise(digits)
    number = F.when(digits == "", 0).when(fits, read.cast("int")).otherwise(0x110000)

    def character(n: Column) -> Column:
        dropped = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n % 0x10000 >= 0xFFFE)
        return (
            F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), REPLACEMENT)
            .when(n.between(0x80, 0x9F), F.substring(F.lit(C1), n - 0x7F, F.lit(1)))
            .when(dropped, "")
            .otherwise(code_point(n))
        )

    return F.get(F.transform(F.array(number), character), 0)


def decode_references(c: Column) -> Column:
    """HTML5 character references decoded once, from left to right.

    A name needs no semicolon if the standard lists it without one; then the longest
    such start counts. What is no reference stays as it is. Texts without ``&`` are
    returned untouched; the table is constant, so that nothing leaves the JVM.
    """
    bare = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
    whole, short = _table(html5), _table({name: html5[name] for name in bare})
    starts = f"^(?:{'|'.join(bare)})"

    def named(ref: Column) -> Column:
        start = F.regexp_extract(ref, starts, 0)
        from_start = F.when(start != "", F.concat(_look_up(short, start), F.substring(ref, F.length(start) + 1, F.length(ref))))
        return F.coalesce(F.when(F.endswith(ref, F.lit(";")), _look_up(whole, ref)), from_start, F.concat(F.lit("&"), ref))

    def decoded(text: Column) -> Column:
        refs = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1))
        values = F.transform(refs, lambda ref: F.when(F.startswith(ref, F.lit("#")), _numbered(ref)).otherwise(named(ref)))
        between = F.split(text, REFERENCE, -1)
        return F.array_join(F.zip_with(between, F.concat(values, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")

    return F.when(~F.contains(c, F.lit("&")), c).otherwise(F.get(F.transform(F.array(c), decoded), 0))


def strip_html(c: Column) -> Column:
    """Remove tags, then decode character references once."""
    return decode_references(F.regexp_replace(c, "<[^>]+>", ""))
