"""Reading VARIANT values with the tolerance landed JSON needs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text of the values that count as nothing; all but the empty text are also the
# text of a string that does count.
NOTHING = ("", "0", "0.0", "-0.0", "false", "[]", "{}")


def parse(text: Column) -> Column:
    """JSON text to VARIANT; null where the text is not JSON."""
    return F.try_parse_json(text)


def at(v: Column, path: str, kind: str = "string") -> Column:
    """Value at a JSON path; null if absent, JSON null, or of another kind."""
    return F.try_variant_get(v, path, kind)


def path(v: Column, json_path: str, default: str | None = None) -> Column:
    """Text at a nested path with a default for absent, null and non-object parents."""
    found = at(v, json_path)
    return found if default is None else F.coalesce(found, F.lit(default))


def has_key(v: Column, json_path: str) -> Column:
    """True if the key exists, also when its value is JSON null."""
    return at(v, json_path, "variant").isNotNull()


def json_text(v: Column, json_path: str = "$") -> Column:
    """Compact JSON of a field. Unlike text, ``1`` and ``"1"`` stay apart."""
    return F.to_json(at(v, json_path, "variant"))


def given_text(text: Column, json: Column) -> Column:
    """``text`` of a value unless the value counts as nothing.

    Its ``json`` is evaluated only for the few texts that leave doubt, thus not
    for null: null AND json would have to look.
    """
    doubt = F.coalesce(text != "", F.lit(False))
    return F.when(~text.isin(*NOTHING), text).when(doubt & json.startswith('"'), text)


def given(v: Column, *json_paths: str) -> Column:
    """Text of the first path with a value; null if none has.

    Null, false, zero and empty texts, lists and objects are no values.
    """
    return F.coalesce(*[given_text(at(v, p), json_text(v, p)) for p in json_paths])


def is_given(v: Column, json_path: str) -> Column:
    return given(v, json_path).isNotNull()


def given_or_blank(v: Column, *json_paths: str) -> Column:
    return F.coalesce(given(v, *json_paths), F.lit(""))


def first_filled(*cols: Column | str) -> Column:
    """First of the text columns that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cols])


def elements(v: Column, json_path: str = "$") -> Column:
    """A JSON array as array<variant>; null if the value is not an array."""
    return at(v, json_path, "array<variant>")


def fields(v: Column, json_path: str = "$") -> Column:
    """A JSON object as map<string,variant>; null if the value is not an object."""
    return at(v, json_path, "map<string,variant>")


def _if_holds(value: Column, test) -> Column:
    """``value`` where the test holds, else null, evaluating ``value`` once."""
    return F.get(F.filter(F.array(value), test), 0)


def first_payload(raw: Column, keys: tuple[str, ...]) -> Column:
    """First of ``keys`` holding a non-empty object, given directly or as JSON text."""

    def usable(candidate: Column) -> Column:
        return _if_holds(candidate, lambda m: F.size(m) > 0)

    tries = []
    for key in keys:
        tries.append(usable(fields(raw, f"$.{key}")))
        # Only text that opens an object is worth a parse.
        text = _if_holds(at(raw, f"$.{key}"), lambda t: t.rlike("^\\s*\\{"))
        tries.append(usable(fields(parse(text))))
    return F.coalesce(*tries)


def serialize_complex(df, *keep: str):
    """Struct, array, map and VARIANT columns become compact JSON text; scalars stay."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if f.name in keep or kind not in ("struct", "array", "map", "variant"):
            out.append(F.col(f"`{f.name}`"))
            continue
        text = F.to_json(F.col(f"`{f.name}`"))
        if kind == "variant":
            # A VARIANT may hold a scalar, which stays as it is.
            text = F.when(
                text.rlike("^[\\[{]"), text
            ).otherwise(F.try_variant_get(F.col(f"`{f.name}`"), "$", "string"))
        out.append(text.alias(f.name))
    return df.select(*out)


def overlay(base: Column, over: Column) -> Column:
    """Map of both; for keys in both, ``over`` wins."""
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(over), k)), over)
