"""JSON documents as VARIANT: strict parsing and field types."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Ends the object that ``is_whole_json`` puts a text in; drawn anew in every process, so no text holds it.
_END = uuid.uuid4().hex


def is_whole_json(text: Column) -> Column:
    """Whether the text is exactly one JSON value; false for null.

    A JSON parser stops after the first value, so ``{"a":1} rest`` would pass. The text is therefore put inside an
    object, before a second name that no text can know: the object has exactly these two names when the text is one value and
    did not close the object itself. The test only skims the tokens.
    """
    keys = F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit(f',"{_END}":0}}')))
    return F.coalesce(keys == F.array(F.lit("v"), F.lit(_END)), F.lit(False))


def is_json_object(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^\s*\{"), F.lit(False)) & is_whole_json(text)


def whole_variant(text: Column) -> Column:
    """The text as VARIANT when it is exactly one JSON value, else null. Texts that repeat a name in an object have no VARIANT."""
    return F.when(is_whole_json(text), F.try_parse_json(text))


def object_variant(text: Column) -> Column:
    """A text that is exactly one JSON object as VARIANT.

    Where the event itself repeats a name the last value counts, as JSON parsers have it. An event that repeats a name
    further in has no VARIANT, but is a JSON object all the same.
    """
    fields = F.map_entries(F.from_json(text, "map<string,variant>"))
    last = F.filter(fields, lambda e, i: ~F.exists(F.slice(fields, i + 2, F.greatest(F.size(fields), F.lit(0))), lambda x: x["key"] == e["key"]))
    return F.coalesce(F.try_parse_json(text), F.to_variant_object(F.map_from_entries(last)))


def event_variant(text: Column) -> Column:
    """The text as VARIANT when it is exactly one JSON object (``object_variant``), else null."""
    return F.when(is_json_object(text), object_variant(text))


def type_code(node: Column) -> Column:
    """First three letters of Spark's name of a VARIANT's type; SQL NULL when the field is absent.

    The full name of a container spells out everything inside it, its start is all the checks need.
    """
    return F.substring(F.schema_of_variant(node), 1, 3)


# fixed values: type codes of the JSON types
CODES = {"string": ["STR"], "boolean": ["BOO"], "integer": ["BIG"], "number": ["BIG", "DEC", "DOU", "FLO"],
         "object": ["OBJ"], "array": ["ARR"], "null": ["VOI"]}


def json_type(code: Column) -> Column:
    """Name of a type code: a whole number is ``integer``, any other number ``number``."""
    name = F.when(code == "BIG", "integer")
    for kind in ("string", "boolean", "number", "object", "array", "null"):
        name = name.when(code.isin(*CODES[kind]), kind)
    return F.when(code.isNotNull(), name.otherwise("other"))


def stringify_nested(df: DataFrame) -> DataFrame:
    """Struct, array, map and VARIANT columns as JSON text, everything else unchanged."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return df.select(*[
        F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
