"""ISO-8601 text to epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catloom.functions import variants as V

# The shapes of ISO-8601 that are accepted. The numbered group after
# the first two digits holds the separator, which must then repeat.
_DATE = "([0-9]{4})-([0-9]{2})-([0-9]{2})|([0-9]{4})([0-9]{2})([0-9]{2})|([0-9]{4})(-?)W([0-9]{2})(?:\\8([1-7]))?"
_CLOCK = "([0-9]{2})(?:(:?)([0-9]{2})(?:\\12([0-9]{2})(?:[.,]([0-9]+))?)?)?"
_ZONE = "([+-])([0-9]{2})(?:(:?)([0-9]{2})(?:\\18([0-9]{2})(?:[.,]([0-9]+))?)?)?"
LENIENT = f"^(?:{_DATE})(?:.{_CLOCK}(?:{_ZONE})?)?$"
STRICT = (
    "^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})T([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})(?:\\.([0-9]{1,6}))?"
    "(?:Z|([+-])([0-9]{2})(:?)([0-5][0-9])(?:\\10([0-5][0-9])(?:\\.([0-9]{1,6}))?)?)?$"
)

# Calendar dates alone or with a whole clock, which the built-in casts read once the
# separators are theirs. The strict grammar holds those of the second shape.
_CALENDAR = "^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:.[0-9]{2}:[0-9]{2}:[0-9]{2}(?:[.,][0-9]+)?(?:Z|[+-][0-9]{2}(?::?[0-9]{2})?)?)?$"
_COMMON = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\\.[0-9]{1,6})?(?:Z|[+-][0-9]{2}:[0-9]{2})?$"

# Both shapes rewritten to: date | year | week | weekday | h | m | s | fraction |
# zone sign | h | m | s | fraction.
_LENIENT_PARTS = "$1$4-$2$5-$3$6|$7|$9|$10|$11|$13|$14|$15|$16|$17|$19|$20|$21"
_STRICT_PARTS = "$1-$2-$3||||$4|$5|$6|$7|$8|$9|$11|$12|$13"

_DAY_US = 86400000000


def _int(digits: Column, default: int = 0) -> Column:
    """Digits to a number; an empty group is the default. A failed cast would cost an exception."""
    return F.when(digits != "", digits.cast("bigint")).otherwise(F.lit(default).cast("bigint"))


def _micros(fraction: Column) -> Column:
    """Fraction digits to microseconds, cutting what is finer."""
    return F.rpad(F.substring(fraction, 1, 6), 6, "0").cast("bigint")


def _week_day(year: Column, week: Column, weekday: Column) -> Column:
    """Day of an ISO week: week 1 holds 4 January, and a week belongs to the year
    of its Thursday."""
    jan4 = F.concat(year, F.lit("-01-04")).try_cast("date")
    thursday = F.date_add(jan4, (3 - F.weekday(jan4) + 7 * (_int(week) - 1)).cast("int"))
    day = F.date_add(thursday, (_int(weekday, 1) - 4).cast("int"))
    return F.when(F.year(thursday) == _int(year), day)


def _from_parts(p: Column) -> Column:
    calendar = F.when(~p[0].startswith("0000") & (p[0] != "--"), p[0].try_cast("date"))
    day = F.coalesce(calendar, _week_day(p[1], p[2], p[3]))
    hour, minute, second = _int(p[4]), _int(p[5]), _int(p[6])
    clock = (hour * 3600 + minute * 60 + second) * 1000000 + _micros(p[7])
    shift = (_int(p[9]) * 3600 + _int(p[10]) * 60 + _int(p[11])) * 1000000 + _micros(p[12])
    total = F.unix_date(day).cast("bigint") * _DAY_US + clock - F.when(p[8] == "-", -shift).otherwise(shift)
    ok = (hour < 24) & (minute < 60) & (second < 60) & (shift < _DAY_US)
    # Whole division rounds toward zero on both sides of 1970.
    return F.when(ok, _whole_millis(total))


def _millis(c: Column, shape: str, parts: str) -> Column:
    fields = F.split(F.regexp_replace(c, F.lit(shape), F.lit(parts)), "\\|", -1)
    # The one-element transform names the fields, so they are split only once.
    return F.when(c.rlike(shape), F.get(F.transform(F.array(fields), _from_parts), 0))


def _whole_millis(micros: Column) -> Column:
    return F.call_function("div", micros, F.lit(1000).cast("bigint"))


def _calendar(c: Column) -> Column:
    """What ``_CALENDAR`` holds, by the built-in casts; null where they do not read it."""
    day = F.unix_date(c.try_cast("date")).cast("bigint") * _DAY_US
    moment = F.concat(F.substring(c, 1, 10), F.lit("T"), F.replace(F.substring(c, 12, 1 << 30), F.lit(","), F.lit(".")))
    read = F.when(F.length(c) == 10, day).otherwise(F.unix_micros(moment.try_cast("timestamp")))
    return _whole_millis(F.when(c.rlike(_CALENDAR) & ~c.startswith("0000"), read))


def iso_millis(c: Column) -> Column:
    """Lenient ISO text to epoch ms; text without a zone is UTC, bad text is null.

    Takes dates alone, compact and week dates, any one separator before the
    clock, and shortened clocks.
    """
    return F.coalesce(_calendar(c), _millis(F.replace(c, F.lit("Z"), F.lit("+00:00")), LENIENT, _LENIENT_PARTS))


def iso_millis_strict(c: Column) -> Column:
    """Four layouts only: date ``T`` clock, each with or without fraction and zone."""
    common = F.when(c.rlike(_COMMON) & ~c.startswith("0000"), F.unix_micros(c.try_cast("timestamp")))
    return F.coalesce(_whole_millis(common), _millis(c, STRICT, _STRICT_PARTS))


def variant_millis(v: Column) -> Column:
    """Epoch ms of a value that is ISO text, or already a number (cut to a whole)."""
    text = F.to_json(v)
    number = F.coalesce(V.at(v, "$", "bigint"), V.at(v, "$", "double").cast("bigint"))
    return (
        F.when(text.startswith('"'), iso_millis(V.at(v, "$")))
        .when(text == "true", F.lit(1).cast("bigint"))
        .when(text == "false", F.lit(0).cast("bigint"))
        .when(text.rlike("^-?[0-9]"), number)
    )
