"""Contract checks on events: every violated rule of every event, as an array of codes.

Codes are ``missing:path``, ``type:path``, ``enum:path``, ``minimum:path``, ``min_items:path`` and, on request,
``bad_timestamp:path``, in the order of the contract; ``type:$`` is no JSON object, ``unparsable:$`` one that repeats a name
in a nested object. An event is parsed once, into a VARIANT: it keeps the JSON types, and an explicit null differs from an
absent field. Landing keeps that VARIANT in the raw rows, so contract, rules and drift read fields of it and parse nothing
(``open_event``). ``open_text`` parses JSON text first, ``open_row`` is for typed columns without their whole event.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import documents as D
from ..schemas import CONTRACTS, NESTED_COLUMNS, Field

LENIENT, STRICT = "lenient", "strict"
SEPARATOR = ";"


@dataclass
class Opened:
    """A frame with the parts of its events in helper columns."""
    df: DataFrame
    helpers: dict[str, str]
    names: list[str]

    def part(self, path: str, part: str) -> Column:
        """``type``, ``number`` or ``text`` of a field; ``size`` and ``elements`` of an array."""
        return F.col(f"{self.helpers[path]}_{part}")

    def close(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.names)


def _fields(contract: str | Sequence[Field]) -> list[Field]:
    return CONTRACTS[contract] if isinstance(contract, str) else list(contract)


def _children(fields: Sequence[Field], parent: Field) -> list[Field]:
    start = f"{parent.path}[]." if parent.kind == "array" else f"{parent.path}."
    return [f for f in fields if f.path.startswith(start)]


def _leaf(path: str) -> str:
    return path.rsplit(".", 1)[-1]


def _is_typed(fields: Sequence[Field], f: Field) -> bool:
    """Required containers have their fields checked one by one."""
    return f.required and bool(_children(fields, f))


def _container_schema(fields: Sequence[Field], f: Field) -> str:
    inner = ",".join(f"`{_leaf(c.path)}`:variant" for c in _children(fields, f))
    return f"array<struct<{inner}>>" if f.kind == "array" else f"struct<{inner}>"


def _type(node: str) -> str:
    return f"substring(schema_of_variant({node}), 1, 3)"


def _get(node: str, path: str, kind: str = "variant") -> str:
    return f"try_variant_get({node}, '$.{path}', '{kind}')" if path else f"try_variant_get({node}, '$', '{kind}')"


def open_event(df: DataFrame, event: str, contract: str | Sequence[Field], is_object: Column | None = None) -> Opened:
    """Reads the fields of a contract from a VARIANT column; ``is_object`` tells the rows that are a JSON object."""
    fields = [f for f in _fields(contract) if "[]." not in f.path]
    helpers = {f.path: f"_c{i}" for i, f in enumerate(fields)}
    columns: dict[str, str] = {}
    for f in fields:
        prefix = helpers[f.path]
        node = _get(f"`{event}`", f.path)
        if f.kind == "array":
            elements = _get(f"`{event}`", f.path, "array<variant>")
            columns |= {f"{prefix}_type": f"CASE WHEN {elements} IS NOT NULL THEN 'ARR' ELSE {_type(node)} END", f"{prefix}_elements": elements,
                        f"{prefix}_size": f"size({elements})"}
            continue
        columns[f"{prefix}_type"] = _type(node)
        if f.kind in ("integer", "number"):
            columns[f"{prefix}_number"] = _get(f"`{event}`", f.path, "double")
        if f.kind == "string":
            columns[f"{prefix}_text"] = _get(f"`{event}`", f.path, "string")
    marked = df.withColumns({"_is_object": F.col(event).isNotNull() if is_object is None else is_object, "_is_parsed": F.col(event).isNotNull()})
    staged = marked.selectExpr("*", *[f"{sql} AS {name}" for name, sql in columns.items()])
    return Opened(staged, helpers, [*columns, "_is_object", "_is_parsed"])


def open_text(df: DataFrame, text: str, contract: str | Sequence[Field]) -> Opened:
    """Reads the fields of a contract from a column of JSON text."""
    parsed = df.withColumn("_event", D.event_variant(F.col(text)))
    # an object without a VARIANT repeats a name further in; only such texts are looked at again
    opened = open_event(parsed, "_event", contract, F.when(F.col("_event").isNotNull(), F.lit(True)).otherwise(D.is_json_object(F.col(text))))
    opened.names.append("_event")
    return opened


def _leaf_parts(node: str, f: Field, prefix: str) -> dict[str, str]:
    """SQL of the helper columns of one field inside a nested column."""
    parts = {f"{prefix}_type": _type(node)}
    if f.kind in ("integer", "number"):
        parts[f"{prefix}_number"] = _get(node, "", "double")
    if f.kind == "string":
        parts[f"{prefix}_text"] = _get(node, "", "string")
    return parts


# type codes of Spark's column types
COLUMN_CODES = {"string": "STR", "boolean": "BOO", "integer": "BIG", "long": "BIG", "double": "DOU"}


def open_row(df: DataFrame, source: str) -> Opened:
    """Reads the fields of a source's contract from typed raw or bronze columns, for rows that come without their whole event.

    Plain columns have their type already; a null is an absent field. Nested parts are JSON text: text that is no JSON
    stays a string, so the contract reports a wrong type.
    """
    fields = _fields(source)
    nested = [f for f in fields if f.path in NESTED_COLUMNS[source] and f.path in df.columns]
    staged = {"_is_object": F.lit(True), "_is_parsed": F.lit(True)}
    for f in nested:
        text = F.col(f"`{f.path}`")
        staged[f"_n_{f.path}"] = (F.from_json(text, _container_schema(fields, f)) if f.kind == "object" and _is_typed(fields, f)
                                  else F.try_parse_json(text))
        staged[f"_whole_{f.path}"] = D.is_whole_json(text)
    parsed = df.withColumns(staged)
    plain = [f for f in fields if "[]." not in f.path]
    helpers = {f.path: f"_c{i}" for i, f in enumerate(plain)}
    columns: dict[str, str] = {}
    for f in plain:
        prefix = helpers[f.path]
        if "." in f.path:
            parent = next(p for p in plain if p.path == f.path.split(".")[0])
            owner, leaf = f"_n_{parent.path}" if parent in nested else "CAST(NULL AS VARIANT)", _leaf(f.path)
            typed = _is_typed(fields, parent) and parent in nested
            columns |= _leaf_parts(f"{owner}.`{leaf}`" if typed else _get(owner, leaf), f, prefix)
            continue
        column = f"`{f.path}`" if f.path in df.columns else "CAST(NULL AS STRING)"
        if f in nested:
            code = (f"CASE WHEN {column} IS NULL THEN NULL WHEN NOT _whole_{f.path} THEN 'STR' "
                    f"WHEN startswith(ltrim({column}), '{{') THEN 'OBJ' WHEN startswith(ltrim({column}), '[') THEN 'ARR' "
                    f"WHEN trim({column}) = 'null' THEN 'VOI' ELSE 'STR' END")
        elif f.path in df.columns:
            known = COLUMN_CODES.get(df.schema[f.path].dataType.typeName(), "DEC")
            code = f"CASE WHEN {column} IS NOT NULL THEN '{known}' END"
        else:
            code = column
        columns[f"{prefix}_type"] = code
        if f.kind in ("integer", "number"):
            columns[f"{prefix}_number"] = f"try_cast({column} AS DOUBLE)"
        if f.kind == "string":
            columns[f"{prefix}_text"] = f"CAST({column} AS STRING)"
        if f.kind == "array":
            columns[f"{prefix}_elements"] = _get(f"_n_{f.path}", "", "array<variant>") if f in nested else "CAST(NULL AS ARRAY<VARIANT>)"
            columns[f"{prefix}_size"] = f"json_array_length({column})"
    opened = parsed.selectExpr("*", *[f"{sql} AS {name}" for name, sql in columns.items()])
    return Opened(opened, helpers, [*columns, *staged])


def _quoted(values: Sequence[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _fits(f: Field, type_: str, number: str) -> str:
    if f.kind == "integer":  # 1.0 is an integer, 1.5, true and "1" are not
        return f"({type_} = 'BIG' OR ({type_} IN ('DEC', 'DOU', 'FLO') AND {number} % 1 = 0))"
    return f"{type_} IN ({_quoted(D.CODES[f.kind])})"


def _absent(f: Field, type_: str, mode: str) -> str:
    """lenient: an explicit null counts as absent; strict: as a value of the wrong type, unless the field is nullable."""
    return f"({type_} IS NULL OR {type_} = 'VOI')" if mode == LENIENT or f.nullable else f"{type_} IS NULL"


def _codes(f: Field, prefix: str, mode: str, check_formats: bool, tag: str, inside: str = "") -> list[str]:
    """SQL of the violations of one field; each is a code or null. ``inside`` is a further condition on all of them."""
    type_, number, text = f"{prefix}_type", f"{prefix}_number", f"{prefix}_text"
    absent = _absent(f, type_, mode)
    fits = f"coalesce({_fits(f, type_, number)}, false)"

    def violated(rule: str, broken: str) -> str:
        return f"CASE WHEN {inside}{broken} THEN '{tag}{rule}:{f.path}' END"

    out = []
    if f.required:
        out.append(violated("missing", f"{type_} IS NULL" if mode == STRICT else absent))
    out.append(violated("type", f"NOT {absent} AND NOT {fits}"))
    if f.allowed:
        out.append(violated("enum", f"{fits} AND {text} NOT IN ({_quoted(f.allowed)})"))
    if f.minimum is not None:
        out.append(violated("minimum", f"{type_} IN ({_quoted(D.CODES['number'])}) AND {number} < {f.minimum}"))
    if f.instant and check_formats:
        out.append(violated("bad_timestamp", f"{fits} AND try_to_timestamp({text}) IS NULL"))
    return out


def contract_text(opened: Opened, contract: str | Sequence[Field], mode: str = LENIENT, check_formats: bool = False,
                  tag: str = "") -> Column:
    """All violations of a row joined by ``SEPARATOR``, empty text when there are none; ``tag`` precedes every code."""
    if mode not in (LENIENT, STRICT):
        raise ValueError(f"mode is {LENIENT!r} or {STRICT!r}, not {mode!r}")
    fields = _fields(contract)
    found: list[str] = []
    for f in fields:
        if "[]." in f.path:
            continue
        prefix = opened.helpers[f.path]
        # fields of an object are only checked where there is an object
        inside = f"{opened.helpers[f.path.split('.')[0]]}_type = 'OBJ' AND " if "." in f.path else ""
        found += _codes(f, prefix, mode, check_formats, tag, inside)
        if f.min_items is not None:
            found.append(f"CASE WHEN {prefix}_type = 'ARR' AND {prefix}_size < {f.min_items} THEN '{tag}min_items:{f.path}' END")
        if f.kind == "array" and _is_typed(fields, f):
            text = _element_text(f"{prefix}_elements", f, _children(fields, f), mode, check_formats, tag)
            found.append(f"CASE WHEN {prefix}_type = 'ARR' THEN {text} END")
    listed = f"concat_ws('{SEPARATOR}', {', '.join(found)})"
    return F.expr(f"CASE WHEN NOT _is_object THEN '{tag}type:$' WHEN NOT _is_parsed THEN '{tag}unparsable:$' ELSE {listed} END")


def _element_text(elements: str, parent: Field, children: Sequence[Field], mode: str, check_formats: bool, tag: str) -> str:
    """SQL of the distinct violations over all elements of an array, null when every element is fine.

    The codes are only put together for arrays with a bad element; most events stop at the ``exists``. An array with an
    element that is no object has that one violation.
    """
    sure = next((c for c in children if c.required), children[0])
    # a field that is there tells an object; only elements without it have their type looked up
    shape = [f"CASE WHEN {_get('e', _leaf(sure.path))} IS NULL THEN coalesce({_type('e')} <> 'OBJ', true) ELSE false END AS gone"]
    good, codes = [], []
    for i, child in enumerate(children):
        value, type_, number = _get("e", _leaf(child.path)), f"s.f{i}_type", f"s.f{i}_number"
        shape.append(f"{_type(value)} AS f{i}_type")
        if child.minimum is not None or child.kind == "integer":
            shape.append(f"{_get('e', _leaf(child.path), 'double')} AS f{i}_number")
        ok = _fits(child, type_, number)
        if child.minimum is not None:
            ok = f"({ok} AND {number} >= {child.minimum})"
        if not child.required:
            ok = f"({_absent(child, type_, mode)} OR {ok})"
        good.append(f"coalesce({ok}, false)")
        codes += _codes(child, f"s.f{i}", mode, check_formats, tag)
    wrong = f"'{tag}type:{parent.path}[]'"
    shapes = f"transform({elements}, e -> struct({', '.join(shape)}))"
    listed = f"transform({shapes}, s -> concat_ws('{SEPARATOR}', {', '.join(codes)}))"
    joined = f"array_join(filter({listed}, t -> t <> ''), '{SEPARATOR}')"
    distinct = f"array_join(array_distinct(split({joined}, '{SEPARATOR}')), '{SEPARATOR}')"
    # one pass over the elements tells the fine arrays
    return (f"CASE WHEN {elements} IS NULL THEN {wrong} WHEN exists({shapes}, s -> s.gone OR NOT ({' AND '.join(good)})) "
            f"THEN CASE WHEN exists({shapes}, s -> s.gone) THEN {wrong} ELSE {distinct} END END")


def as_array(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, SEPARATOR))


def check_contract(df: DataFrame, text: str, contract: str | Sequence[Field], mode: str = LENIENT,
                   check_formats: bool = False, out: str = "violations") -> DataFrame:
    """Adds the violation codes of a column of JSON text; empty when the event fulfils the contract."""
    opened = open_text(df, text, contract)
    violated = contract_text(opened, contract, mode, check_formats)
    return opened.close(opened.df.withColumn("_violated", violated).withColumn(out, as_array(F.col("_violated"))).drop("_violated"))
