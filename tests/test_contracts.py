"""Schema documents against a plain walk over the same records, and their defined results."""

import random
import re

import pytest

from dossier.operators.contracts import check_schema

DOCUMENT = {
    "$schema": "https://json-schema.org/draft/2020-12/schema",
    "title": "bundle",
    "$defs": {
        "evidence": {
            "type": "object",
            "required": ["evidence_id", "page", "note"],
            "properties": {"evidence_id": {"type": "string", "minLength": 2}, "page": {"type": "integer", "minimum": 1}, "note": {"type": ["string", "null"]}},
            "additionalProperties": True,
        },
        "candidate": {
            "type": "object",
            "required": ["company.id", "status", "gone", "evidence"],
            "properties": {
                "company.id": {"type": "string", "pattern": "^\\d{6}$"},
                "status": {"const": "AUTO_CANDIDATE"},
                "kind": {"enum": ["A", "B"]},
                "counts": {"type": "object", "required": ["x"], "additionalProperties": {"type": "integer", "minimum": 1}},
                "dates": {"type": "object", "additionalProperties": {"type": "array", "items": {"type": "string"}}},
                "evidence": {"type": "array", "minItems": 1, "items": {"$ref": "#/$defs/evidence"}},
                "score": {"type": "integer", "maximum": 9, "exclusiveMinimum": 0},
            },
        },
    },
}
TYPES = """id long, `company.id` string, status string, kind string, counts map<string,int>, dates map<string,array<string>>,
  evidence array<struct<evidence_id:string,page:int,note:string,more:int>>, score double"""


def walked(value, schema, path):
    """The same rules over Python values, null properties absent."""
    if "$ref" in schema:
        yield from walked(value, DOCUMENT["$defs"][schema["$ref"].split("/")[-1]], path)
        return
    types = schema.get("type", [])
    types = [types] if isinstance(types, str) else types
    kinds = {"object": dict, "array": list, "string": str, "null": type(None)}
    whole = isinstance(value, (int, float)) and value == int(value)
    if types and not any(isinstance(value, kinds[t]) if t in kinds else whole for t in types):
        yield path, "type"
        if value is None:
            return
    if "const" in schema and value != schema["const"]:
        yield path, "const"
    if "enum" in schema and value not in schema["enum"]:
        yield path, "enum"
    if isinstance(value, (int, float)):
        for rule, bad in [("minimum", lambda m: value < m), ("maximum", lambda m: value > m), ("exclusiveMinimum", lambda m: value <= m)]:
            if rule in schema and bad(schema[rule]):
                yield path, rule
    if isinstance(value, str):
        if "pattern" in schema and not re.search(schema["pattern"].replace("$", r"\Z"), value):
            yield path, "pattern"
        if len(value) < schema.get("minLength", 0):
            yield path, "minLength"
    if isinstance(value, list):
        if len(value) < schema.get("minItems", 0):
            yield path, "minItems"
        for i, x in enumerate(value):
            yield from walked(x, schema.get("items", {}), f"{path}[{i}]")
    if isinstance(value, dict):
        given, rest = schema.get("properties", {}), schema.get("additionalProperties", True)
        dot = path + "." if path else ""
        for k in schema.get("required", []):
            if value.get(k) is None and "null" not in given.get(k, {}).get("type", []):
                yield dot + k, "required"
        for k, x in value.items():
            want = given.get(k, rest)
            if isinstance(want, dict) and (x is not None or k not in given):
                yield from walked(x, want, dot + k)


def record(rnd, i):
    some = lambda *xs: rnd.choice([None, *xs])
    evidence = [None if rnd.random() < 0.1 else (some("e", "e1", ""), some(0, 1, 7), some("n"), some(1)) for _ in range(rnd.randrange(4))]
    dates = {k: None if rnd.random() < 0.2 else [some("2001-01", "") for _ in range(rnd.randrange(3))] for k in rnd.sample(["r", "s", "t"], rnd.randrange(4))}
    counts = {k: some(0, 1, 5) for k in rnd.sample(["x", "y"], rnd.randrange(3))}
    return i, some("000001", "00001", "000001\n"), some("AUTO_CANDIDATE", "DRAFT", ""), some("A", "C"), some(counts), some(dates), some(evidence), some(0.0, 1.5, 3.0, 10.0)


def test_schema_equals_a_plain_walk(spark):
    rnd = random.Random(5)
    rows = [record(rnd, i) for i in range(400)]
    rows += rows[:5]
    got = sorted(tuple(r) for r in check_schema(spark.createDataFrame(rows, TYPES), DOCUMENT, "candidate").collect())
    names = ["company.id", "status", "kind", "counts", "dates", "evidence", "score"]
    want = []
    for i, *values in rows:
        r = dict(zip(names, values, strict=True))
        r["evidence"] = r["evidence"] and [e and dict(zip(["evidence_id", "page", "note", "more"], e, strict=True)) for e in r["evidence"]]
        want += [(i, *x) for x in walked({k: v for k, v in r.items() if v is not None}, DOCUMENT["$defs"]["candidate"], "")]
    assert got == sorted(want)
    assert {r for _, _, r in got} == {"required", "type", "const", "enum", "minimum", "maximum", "exclusiveMinimum", "pattern", "minLength", "minItems"}


def test_schema_odd_tables(spark):
    empty = spark.createDataFrame([], TYPES)
    assert check_schema(empty, DOCUMENT, "candidate").count() == 0
    only = spark.createDataFrame([(1, "a"), (None, None)], "id long, path string")
    assert check_schema(only, {"required": ["id"], "properties": {"id": {}}, "additionalProperties": False}).collect() == [(1, "path", "false"), (None, "id", "required")]
    assert check_schema(only, {"properties": {"path": {"type": "number"}}}).collect() == [(1, "path", "type")]
    assert check_schema(only.select("id"), {"type": "object"}).count() == 0
    with pytest.raises(ValueError, match="not compiled: anyOf"):
        check_schema(only, {"properties": {"path": {"anyOf": []}}})
    with pytest.raises(ValueError, match="holds itself"):
        check_schema(only, {"$defs": {"a": {"$ref": "#/$defs/a"}}, "properties": {"path": {"$ref": "#/$defs/a"}}})


def test_schema_is_one_pass(spark):
    plan = check_schema(spark.createDataFrame([record(random.Random(1), 1)], TYPES), DOCUMENT, "candidate")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
