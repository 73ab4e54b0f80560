"""Compiled schema rules against a validator written from the specification."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from harmlens.operators import json_schema as js
from harmlens.plans import REGISTRY
from harmlens.workspace import scratch_path

DDL = """name string, age int, score double, ok boolean, day date, tags array<string>, sizes array<int>,
  home struct<street: string, zip: string, geo: struct<lat: double, lon: double>>, extra map<string, int>,
  children array<struct<name: string, age: int>>"""

DOCUMENT = {
    "type": "object", "required": ["name", "home", "missing"],
    "properties": {
        "name": {"type": "string", "pattern": "^[a-zé]+$", "minLength": 2, "maxLength": 5, "not": {"const": "bob"}},
        "age": {"type": ["integer", "null"], "minimum": 18, "exclusiveMaximum": 65, "multipleOf": 2},
        "score": {"type": "integer"},
        "ok": {"enum": [True, "yes"]},
        "day": {"type": "string", "pattern": "^20"},
        "tags": {"type": "array", "minItems": 1, "maxItems": 3, "uniqueItems": True, "items": {"$ref": "#/$defs/tag"}},
        "sizes": {"contains": {"minimum": 10}, "items": {"anyOf": [{"maximum": 5}, {"minimum": 10}]}},
        "home": {
            "required": ["zip"], "minProperties": 2, "dependentRequired": {"street": ["geo"]},
            "properties": {"zip": {"type": "integer"}, "geo": {"properties": {"lat": {"exclusiveMinimum": -90, "maximum": 90}}, "additionalProperties": False}},
        },
        "extra": {"properties": {"a": {"minimum": 0}}, "additionalProperties": {"maximum": 3}, "required": ["a"], "maxProperties": 2},
        "children": {"items": {"$ref": "#/$defs/child"}},
    },
    "oneOf": [{"required": ["age"]}, {"required": ["score"]}],
    "if": {"properties": {"ok": {"const": True}}, "required": ["ok"]}, "then": {"required": ["day"]}, "else": {"properties": {"age": {"maximum": 40}}},
    "$defs": {"tag": {"type": "string", "enum": ["x", "y", "zz"]}, "child": {"allOf": [{"required": ["name"]}, {"properties": {"age": {"maximum": 17}}}]}},
}


def broken(schema, value, path="$"):
    """(path, rule) of every violation of a JSON value in which null members count as absent."""
    if schema is True or value is None:
        return []
    if schema is False:
        return [(path, "false")]
    out = []
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    kinds = {"string": isinstance(value, str), "number": number, "integer": number and value == int(value), "boolean": isinstance(value, bool),
             "array": isinstance(value, list), "object": isinstance(value, dict), "null": False}
    same = lambda c: isinstance(c, bool) == isinstance(value, bool) and isinstance(c, str) == isinstance(value, str) and c == value
    held = {k: v for k, v in value.items() if v is not None} if isinstance(value, dict) else {}
    for k, asked in schema.items():
        fails = None
        if k == "$ref":
            out += broken(DOCUMENT["$defs"][asked.rsplit("/", 1)[1]], value, path)
        elif k == "type":
            fails = not any(kinds[n] for n in ([asked] if isinstance(asked, str) else asked))
        elif k == "enum":
            fails = not any(map(same, asked))
        elif k == "const":
            fails = not same(asked)
        elif k == "not":
            fails = not broken(asked, value)
        elif k == "allOf":
            out += [v for one in asked for v in broken(one, value, path)]
        elif k in ("anyOf", "oneOf"):
            n = sum(not broken(one, value) for one in asked)
            fails = n == 0 if k == "anyOf" else n != 1
        elif k == "if":
            out += broken(schema.get("then" if not broken(asked, value) else "else", True), value, path)
        elif kinds["string"] and k in ("pattern", "minLength", "maxLength"):
            fails = {"pattern": lambda: not re.search(asked, value), "minLength": lambda: len(value) < asked, "maxLength": lambda: len(value) > asked}[k]()
        elif number and k in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf"):
            fails = {"minimum": lambda: value < asked, "maximum": lambda: value > asked, "exclusiveMinimum": lambda: value <= asked,
                     "exclusiveMaximum": lambda: value >= asked, "multipleOf": lambda: value % asked != 0}[k]()
        elif kinds["object"]:
            if k == "required":
                out += [(f"{path}.{n}", "required") for n in asked if n not in held]
            elif k == "properties":
                out += [v for n, s in asked.items() for v in broken(s, held.get(n), f"{path}.{n}")]
            elif k == "additionalProperties":
                others = [n for n in sorted(held) if n not in schema.get("properties", {})]
                out += [v for n in others for v in ([(f"{path}.{n}", k)] if asked is False else broken(asked, held[n], f"{path}.{n}"))]
            elif k == "dependentRequired":
                out += [(f"{path}.{n}", "required") for first, names in asked.items() if first in held for n in names if n not in held]
            elif k in ("minProperties", "maxProperties"):
                fails = len(held) < asked if k == "minProperties" else len(held) > asked
        elif kinds["array"]:
            if k == "items":
                out += [v for i, one in enumerate(value) for v in broken(asked, one, f"{path}[{i}]")]
            elif k in ("minItems", "maxItems"):
                fails = len(value) < asked if k == "minItems" else len(value) > asked
            elif k == "uniqueItems":
                fails = len({json.dumps(v) for v in value}) < len(value)
            elif k == "contains":
                fails = not any(v is not None and not broken(asked, v) for v in value)
        if fails:
            out.append((path, k))
    return out


def record(r):
    maybe = lambda make: None if r.random() < 0.25 else make()
    some = lambda make, most=4: [maybe(make) for _ in range(r.randint(0, most))]
    geo = lambda: {"lat": maybe(lambda: r.choice([-90.0, 0.5, 90.0, 91.0])), "lon": maybe(lambda: 1.0)}
    return {
        "name": maybe(lambda: r.choice(["bob", "zoé", "é", "Anna", "longername", "ab"])), "age": maybe(lambda: r.choice([17, 18, 40, 64, 65, 33])),
        "score": maybe(lambda: r.choice([1.0, 2.5])), "ok": maybe(lambda: r.random() < 0.5), "day": maybe(lambda: r.choice(["2024-01-02", "1999-01-01"])),
        "tags": maybe(lambda: some(lambda: r.choice(["x", "y", "zz", "bad"]))), "sizes": maybe(lambda: some(lambda: r.randint(0, 12))),
        "home": maybe(lambda: {"street": maybe(lambda: "s"), "zip": maybe(lambda: "123"), "geo": maybe(geo)}),
        "extra": maybe(lambda: {k: maybe(lambda: r.randint(-1, 5)) for k in r.sample("abcd", r.randint(0, 3))}),
        "children": maybe(lambda: some(lambda: {"name": maybe(lambda: "n"), "age": maybe(lambda: r.randint(10, 20))}, 2)),
    }


def test_rules_equal_the_specification(spark):
    r = random.Random(2)
    records = [record(r) for _ in range(600)]
    rows = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(records)], "id int, j string")
    typed = rows.select("id", F.from_json("j", DDL).alias("r")).select("id", "r.*")
    columns = [c for c in typed.columns if c != "id"]
    found = js.validate_schema(typed, DOCUMENT, columns).select("id", "errors", "valid").collect()
    for row in found:
        want = broken(DOCUMENT, records[row.id])
        assert sorted((e.path, e.rule) for e in row.errors) == sorted(want), records[row.id]
        assert row.valid == (not want)
    listed = js.error_rows(typed, DOCUMENT, "id", columns).collect()
    assert len(listed) == sum(len(row.errors) for row in found)
    rules = {e.rule for row in found for e in row.errors}
    assert rules >= set("type pattern minLength maxLength not minimum exclusiveMaximum multipleOf enum minItems maxItems uniqueItems contains anyOf oneOf "
                        "required minProperties exclusiveMinimum maximum additionalProperties".split())


def test_a_document_is_read_from_a_file(spark):
    path = scratch_path(spark, "schema")
    spark.createDataFrame([(json.dumps(js.unified_schema(), indent=1),)], "value string").coalesce(1).write.text(path)
    assert js.load_schema(spark, path) == js.unified_schema()


def test_no_rules_no_violations_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    assert [r.valid for r in js.validate_schema(rows, {}).collect()] == [True, True]
    assert js.error_rows(rows.limit(0), DOCUMENT, "id").collect() == []
    assert [(r.path, r.rule) for r in js.error_rows(rows.limit(1), {"properties": {"name": False}}, "id").collect()] == [("$.name", "false")]


@pytest.mark.parametrize("document", [{"unevaluatedProperties": False}, {"type": "text"}, {"$ref": "other.json#/x"}, {"$ref": "#"}, {"enum": [[1]]}])
def test_what_is_not_supported_is_refused(spark, document):
    with pytest.raises(ValueError):
        js.validate_schema(spark.createDataFrame([(1,)], "id int"), document)


def test_recursive_definitions_end_with_the_type(spark):
    tree = {"$ref": "#/$defs/node", "$defs": {"node": {"required": ["v"], "properties": {"next": {"$ref": "#/$defs/node"}}}}}
    rows = spark.createDataFrame([((1, (None, (3,))),)], "r struct<v: int, next: struct<v: int, next: struct<v: int>>>").select("r.*")
    assert [(r.path, r.rule) for r in js.error_rows(rows.withColumn("k", F.lit(1)), tree, "k", ["v", "next"]).collect()] == [("$.next.v", "required")]


def test_validation_is_one_projection(spark, sf_dir):
    plan = REGISTRY["h16_validate_schema"].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SortMergeJoin" not in plan
