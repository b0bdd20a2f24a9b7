"""Contracts as schema documents (inventory L6): a JSON Schema document becomes one projection of what breaks it.

The document is compiled against the types of the columns, so a check is a narrow pass without a shuffle: structs and maps are objects,
arrays are walked with their index in the path, references stay inside the document.

Defined results: a null is an absent property (`required` where the document asks for it and does not allow null); a null element of an array
or a null value of a map breaks `type` unless null is allowed. A property without a column is always absent. Dates and timestamps are strings.
Bounds, patterns and lengths judge values of their own type only. Empty arrays, maps and tables break nothing. Repeated rows are judged
each. A keyword that is not compiled here raises, so nothing goes unchecked in silence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOUND = "array<struct<path:string,rule:string>>"
ANNOTATIONS = {"$schema", "$id", "$defs", "$comment", "title", "description", "default", "examples"}
KEYWORDS = {"$ref", "type", "const", "enum", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "pattern", "minLength", "maxLength"}
KEYWORDS |= {"required", "properties", "additionalProperties", "items", "minItems", "maxItems"}


def check_schema(df: DataFrame, document: dict, definition: str | None = None, id_col: str | None = None) -> DataFrame:
    """(id, path, rule) for each value of df that breaks the document, or its definition of that name.

    The id is the first column unless named; it is a property only if the document names it.
    """
    id_col = id_col or df.columns[0]
    schema = document if definition is None else document["$defs"][definition]
    named = set(schema.get("properties", {})) | set(schema.get("required", []))
    kept = [f for f in df.schema if f.name != id_col or f.name in named]
    row = F.struct(*[_column(f.name) for f in kept]) if kept else F.struct(F.lit(1).alias("none"))
    found = _judge(row, T.StructType(kept), schema, F.lit(""), document, ())
    return df.select(_column(id_col).alias("id"), F.explode(found).alias("found")).select("id", "found.path", "found.rule")


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _none() -> Column:
    return F.array().cast(FOUND)


def _breaks(bad: Column, path: Column, rule: str) -> Column:
    return F.when(bad, F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule")))).otherwise(_none())


def _kind(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.StructType, T.MapType)):
        return "object"
    if isinstance(dtype, T.ArrayType):
        return "array"
    if isinstance(dtype, T.NumericType):
        return "number"
    return "boolean" if isinstance(dtype, T.BooleanType) else "string"


def _types(schema) -> list[str]:
    given = schema.get("type", []) if isinstance(schema, dict) else []
    return [given] if isinstance(given, str) else list(given)


def _target(ref: str, document: dict):
    if not ref.startswith("#"):
        raise ValueError(f"reference {ref} leaves the document")
    at = document
    for part in ref.lstrip("#").strip("/").split("/"):
        at = at[part.replace("~1", "/").replace("~0", "~")] if part else at
    return at


def _nullable(schema, document: dict, seen: tuple = ()) -> bool:
    """Whether the schema names null among its types."""
    if isinstance(schema, dict) and "$ref" in schema and schema["$ref"] not in seen:
        return _nullable(_target(schema["$ref"], document), document, (*seen, schema["$ref"]))
    return "null" in _types(schema)


def _wrong_type(value: Column, dtype: T.DataType, types: list[str]) -> Column:
    kind = _kind(dtype)
    if kind in types:
        return F.lit(False)
    if kind == "number" and "integer" in types:
        return F.lit(False) if isinstance(dtype, T.IntegralType) else value != F.floor(value)
    return F.lit(True)


def _differs(value: Column, dtype: T.DataType, given) -> Column:
    """Whether the value is not the given scalar; one of another type always differs."""
    if isinstance(given, (dict, list)):
        raise ValueError("const and enum hold scalars only")
    kind = "boolean" if isinstance(given, bool) else "number" if isinstance(given, (int, float)) else "string"
    if given is None or kind != _kind(dtype):
        return F.lit(True)
    return (value.cast("string") if kind == "string" else value) != F.lit(given)


def _whole(pattern: str) -> str:
    """The pattern with its last $ as the end of the text, not of its last line."""
    return pattern[:-1] + r"\z" if pattern.endswith("$") and not pattern.endswith("\\$") else pattern


def _scalar_rules(value: Column, dtype: T.DataType, schema: dict) -> dict[str, Column]:
    """The condition under which each keyword about one value is broken."""
    out = {}
    if schema.get("type"):
        out["type"] = _wrong_type(value, dtype, _types(schema))
    if "const" in schema:
        out["const"] = _differs(value, dtype, schema["const"])
    if "enum" in schema:
        out["enum"] = F.forall(F.array(*[_differs(value, dtype, x) for x in schema["enum"]]), lambda x: x) if schema["enum"] else F.lit(True)
    if _kind(dtype) == "number":
        bounds = {"minimum": value.__lt__, "maximum": value.__gt__, "exclusiveMinimum": value.__le__, "exclusiveMaximum": value.__ge__}
        out |= {k: beyond(schema[k]) for k, beyond in bounds.items() if k in schema}
    if _kind(dtype) == "string":
        text = value.cast("string")
        if "pattern" in schema:
            out["pattern"] = ~text.rlike(_whole(schema["pattern"]))
        if "minLength" in schema:
            out["minLength"] = F.length(text) < schema["minLength"]
        if "maxLength" in schema:
            out["maxLength"] = F.length(text) > schema["maxLength"]
    if _kind(dtype) == "array":
        if "minItems" in schema:
            out["minItems"] = F.size(value) < schema["minItems"]
        if "maxItems" in schema:
            out["maxItems"] = F.size(value) > schema["maxItems"]
    return out


def _judge(value: Column, dtype: T.DataType, schema, path: Column, document: dict, seen: tuple) -> Column:
    """What a value that isn't null breaks."""
    if isinstance(schema, bool):
        return _none() if schema else _breaks(F.lit(True), path, "false")
    unknown = set(schema) - KEYWORDS - ANNOTATIONS
    if unknown:
        raise ValueError(f"keywords not compiled: {', '.join(sorted(unknown))}")
    found = [_breaks(bad, path, rule) for rule, bad in _scalar_rules(value, dtype, schema).items()]
    if "$ref" in schema:
        if schema["$ref"] in seen:
            raise ValueError(f"reference {schema['$ref']} holds itself")
        found.append(_judge(value, dtype, _target(schema["$ref"], document), path, document, (*seen, schema["$ref"])))
    if isinstance(dtype, T.StructType):
        found += _struct_rules(value, dtype, schema, path, document)
    elif isinstance(dtype, T.MapType):
        found += _map_rules(value, dtype, schema, path, document)
    elif isinstance(dtype, T.ArrayType) and "items" in schema:
        each = F.transform(value, lambda x, i: _inner(x, dtype.elementType, schema["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), document))
        found.append(F.flatten(each))
    return F.concat(*found) if found else _none()


def _inner(value: Column, dtype: T.DataType, schema, path: Column, document: dict) -> Column:
    """The same for an element or a map's value, where a null is a value."""
    null = _none() if schema is True or _nullable(schema, document) or (isinstance(schema, dict) and not schema.get("type") and "$ref" not in schema) else _breaks(F.lit(True), path, "type")
    return F.when(value.isNull(), null).otherwise(_judge(value, dtype, schema, path, document, ()))


def _below(path: Column, name: Column) -> Column:
    return F.when(path == "", name).otherwise(F.concat(path, F.lit("."), name))


def _struct_rules(value: Column, dtype: T.StructType, schema: dict, path: Column, document: dict) -> list[Column]:
    given, required, rest = schema.get("properties", {}), schema.get("required", []), schema.get("additionalProperties", True)
    here = {f.name: f.dataType for f in dtype}
    found = []
    for name in required:
        if not _nullable(given.get(name, {}), document):
            found.append(_breaks(value.getField(name).isNull() if name in here else F.lit(True), _below(path, F.lit(name)), "required"))
    for name, inner in here.items():
        want = given.get(name, rest)
        if want is not True:
            v = value.getField(name)
            found.append(F.when(v.isNull(), _none()).otherwise(_judge(v, inner, want, _below(path, F.lit(name)), document, ())))
    return found


def _map_rules(value: Column, dtype: T.MapType, schema: dict, path: Column, document: dict) -> list[Column]:
    """Keys are the properties; those that the document doesn't name are judged in one pass over the entries."""
    given, rest = schema.get("properties", {}), schema.get("additionalProperties", True)
    found = []
    for name in dict.fromkeys([*schema.get("required", []), *given]):
        v, at = F.element_at(value, name), _below(path, F.lit(name))
        if name in schema.get("required", []) and not _nullable(given.get(name, {}), document):
            found.append(_breaks(v.isNull(), at, "required"))
        if name in given:
            found.append(F.when(v.isNull(), _none()).otherwise(_judge(v, dtype.valueType, given[name], at, document, ())))
    if rest is not True:
        others = F.map_entries(value)
        if given:
            others = F.filter(others, lambda e: ~e["key"].cast("string").isin(*given))
        found.append(F.flatten(F.transform(others, lambda e: _inner(e["value"], dtype.valueType, rest, _below(path, e["key"].cast("string")), document))))
    return found
