"""Validation against a JSON Schema document, compiled to column expressions.

A document is compiled once, against the type of the column it describes, into one expression that lists every violation
of a record with its path and rule. Nested objects become struct fields or map values, lists become array transforms, so a
batch of records is validated in one projection, with no row leaving the JVM.

Columns can't tell a null from an absent value: both count as absent, so ``required`` asks for a value and every other
rule passes over nulls. What a type settles is decided while compiling: where a column has another type than the schema
asks for, each value is a violation, and a field that the type lacks is absent in every record. Texts are counted in code
points; ``pattern`` finds a match anywhere, as Java regular expressions do. Dates and timestamps are texts. Keywords that
only describe are passed over; a keyword that is not supported raises ``ValueError`` instead of being ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keywords of the specification that state no rule.
DESCRIPTIVE = frozenset(
    "$schema $id $anchor $comment $defs definitions title description default examples deprecated readOnly writeOnly format "
    "contentEncoding contentMediaType then else".split())
ERRORS = "array<struct<path: string, rule: string>>"


def load_schema(spark: SparkSession, path: str) -> dict:
    """The document of a file in any store that Spark reads; one document, of a schema's size."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def unified_schema() -> dict:
    """The library's own document, for unified risk records."""
    return json.loads((resources.files("harmlens.functions") / "unified_risk.schema.json").read_text(encoding="utf-8"))


def _nothing() -> Column:
    return F.array().cast(ERRORS)


def _together(parts: list[Column]) -> Column:
    return parts[0] if len(parts) == 1 else F.concat(_nothing(), *parts)


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _is_object(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.MapType))


@dataclass(frozen=True)
class Value:
    """A value of a record: its column, its type and its path, a column too since lists number their items."""

    column: Column
    kind: T.DataType
    path: Column

    def field(self, name: str) -> Value | None:
        """A member of an object; None where the type has none of that name."""
        path = F.concat(self.path, F.lit(f".{name}"))
        if isinstance(self.kind, T.MapType):
            return Value(F.try_element_at(self.column, F.lit(name)), self.kind.valueType, path)
        if isinstance(self.kind, T.StructType) and name in self.kind.names:
            return Value(self.column.getField(name), self.kind[name].dataType, path)
        return None

    def has_type(self, name: str) -> Column | bool:
        """Whether the value, which is not null, is of a type of the specification; mostly settled by the column's type."""
        k = self.kind
        if name == "integer" and isinstance(k, (T.DoubleType, T.FloatType, T.DecimalType)):
            return self.column == F.floor(self.column)
        static = {"string": _is_text(k), "number": _is_number(k), "integer": isinstance(k, T.IntegralType), "boolean": isinstance(k, T.BooleanType),
                  "array": isinstance(k, T.ArrayType), "object": _is_object(k), "null": False}
        if name not in static:
            raise ValueError(f"unknown type {name!r}")
        return static[name]

    def equals(self, constant: object) -> Column:
        """Whether the value, which is not null, is the constant; a constant of another type is not."""
        k = self.kind
        if isinstance(constant, bool):
            return self.column == F.lit(constant) if isinstance(k, T.BooleanType) else F.lit(False)
        if isinstance(constant, (int, float)):
            return self.column == F.lit(constant) if _is_number(k) else F.lit(False)
        if isinstance(constant, str):
            return self.column.cast("string") == F.lit(constant) if _is_text(k) else F.lit(False)
        if constant is None:
            return F.lit(False)
        raise ValueError("constants can be texts, numbers and booleans")


class Compiler:
    """Rules of one document."""

    def __init__(self, document: dict):
        self.document = document

    def resolve(self, reference: str) -> dict | bool:
        if not reference.startswith("#"):
            raise ValueError(f"only references into the document are supported: {reference}")
        at: object = self.document
        for part in filter(None, reference[1:].split("/")):
            part = part.replace("~1", "/").replace("~0", "~")
            at = at[int(part)] if isinstance(at, list) else at[part]
        return at

    def violations(self, schema: dict | bool, value: Value, following: tuple[str, ...] = ()) -> list[Column]:
        """Arrays of violations, each null-safe and empty where the value keeps the rule."""
        if isinstance(schema, bool):
            return [] if schema else [self.when(F.lit(True), value, "false")]
        out: list[Column] = []
        for keyword, asked in schema.items():
            if keyword in DESCRIPTIVE:
                continue
            if keyword == "$ref":
                if asked in following:
                    raise ValueError(f"reference to itself: {asked}")
                out += self.violations(self.resolve(asked), value, (*following, asked))
                continue
            rule = getattr(self, f"_{keyword}", None)
            if rule is None:
                raise ValueError(f"keyword {keyword!r} is not supported")
            out += rule(asked, value, schema)
        return out

    @staticmethod
    def when(broken: Column, value: Value, rule: str, path: Column | None = None) -> Column:
        """One violation where ``broken`` holds for a value that is there."""
        found = F.array(F.struct((value.path if path is None else path).alias("path"), F.lit(rule).alias("rule")))
        return F.when(value.column.isNotNull() & F.coalesce(broken, F.lit(False)), found).otherwise(_nothing())

    def keeps(self, schema: dict | bool, value: Value) -> Column:
        """Whether a value has no violation."""
        parts = self.violations(schema, value)
        return F.size(F.concat(*parts)) == 0 if parts else F.lit(True)

    # rules for any value

    def _type(self, asked, value, _schema):
        names = [asked] if isinstance(asked, str) else asked
        known = [value.has_type(name) for name in names]
        if any(fit is True for fit in known):
            return []
        fits = F.lit(False)
        for fit in known:
            fits = fits | fit
        return [self.when(~fits, value, "type")]

    def _enum(self, asked, value, _schema):
        fits = F.lit(False)
        for constant in asked:
            fits = fits | value.equals(constant)
        return [self.when(~fits, value, "enum")]

    def _const(self, asked, value, _schema):
        return [self.when(~value.equals(asked), value, "const")]

    def _allOf(self, asked, value, _schema):
        return [part for one in asked for part in self.violations(one, value)]

    def _count_kept(self, asked, value) -> Column:
        total = F.lit(0)
        for one in asked:
            total = total + self.keeps(one, value).cast("int")
        return total

    def _anyOf(self, asked, value, _schema):
        return [self.when(self._count_kept(asked, value) == 0, value, "anyOf")]

    def _oneOf(self, asked, value, _schema):
        return [self.when(self._count_kept(asked, value) != 1, value, "oneOf")]

    def _not(self, asked, value, _schema):
        return [self.when(self.keeps(asked, value), value, "not")]

    def _if(self, asked, value, schema):
        holds = self.keeps(asked, value)
        out = []
        for branch, wanted in (("then", holds), ("else", ~holds)):
            if branch in schema:
                out += [F.when(wanted, part).otherwise(_nothing()) for part in self.violations(schema[branch], value)]
        return out

    # rules for texts

    def _text(self, value, rule, broken: Callable[[Column], Column]):
        return [self.when(broken(value.column.cast("string")), value, rule)] if _is_text(value.kind) else []

    def _pattern(self, asked, value, _schema):
        return self._text(value, "pattern", lambda c: ~c.rlike(asked))

    def _minLength(self, asked, value, _schema):
        return self._text(value, "minLength", lambda c: F.char_length(c) < asked)

    def _maxLength(self, asked, value, _schema):
        return self._text(value, "maxLength", lambda c: F.char_length(c) > asked)

    # rules for numbers

    def _number(self, value, rule, broken: Callable[[Column], Column]):
        return [self.when(broken(value.column), value, rule)] if _is_number(value.kind) else []

    def _minimum(self, asked, value, _schema):
        return self._number(value, "minimum", lambda c: c < F.lit(asked))

    def _maximum(self, asked, value, _schema):
        return self._number(value, "maximum", lambda c: c > F.lit(asked))

    def _exclusiveMinimum(self, asked, value, _schema):
        return self._number(value, "exclusiveMinimum", lambda c: c <= F.lit(asked))

    def _exclusiveMaximum(self, asked, value, _schema):
        return self._number(value, "exclusiveMaximum", lambda c: c >= F.lit(asked))

    def _multipleOf(self, asked, value, _schema):
        return self._number(value, "multipleOf", lambda c: c % F.lit(asked) != 0)

    # rules for objects

    def _required(self, asked, value, _schema):
        out = []
        for name in asked if _is_object(value.kind) else ():
            member = value.field(name)
            lacks = member.column.isNull() if member else F.lit(True)
            out.append(self.when(lacks, value, "required", F.concat(value.path, F.lit(f".{name}"))))
        return out

    def _properties(self, asked, value, _schema):
        members = [(value.field(name), schema) for name, schema in asked.items()] if _is_object(value.kind) else []
        return [part for member, schema in members if member for part in self.violations(schema, member)]

    def _additionalProperties(self, asked, value, schema):
        if asked is True or not _is_object(value.kind):
            return []
        named = list(schema.get("properties", {}))
        rule = (lambda member: [self.when(F.lit(True), member, "additionalProperties")]) if asked is False else (lambda member: self.violations(asked, member))
        if isinstance(value.kind, T.StructType):
            return [part for name in value.kind.names if name not in named for part in rule(value.field(name))]

        def of_key(key: Column) -> Column:
            member = Value(value.column[key], value.kind.valueType, F.concat(value.path, F.lit("."), key))
            return _together(rule(member))

        others = F.filter(F.array_sort(F.map_keys(value.column)), lambda k: ~k.isin(named)) if named else F.array_sort(F.map_keys(value.column))
        return [F.coalesce(F.flatten(F.transform(others, of_key)), _nothing())]

    def _dependentRequired(self, asked, value, schema):
        out = []
        for name, names in asked.items() if _is_object(value.kind) else ():
            if member := value.field(name):
                out += [F.when(member.column.isNotNull(), part).otherwise(_nothing()) for part in self._required(names, value, schema)]
        return out

    def _size(self, value, rule, broken: Callable[[Column], Column]):
        if not _is_object(value.kind):
            return []
        if isinstance(value.kind, T.MapType):
            held = F.size(F.filter(F.map_values(value.column), lambda v: v.isNotNull()))
        else:
            held = F.lit(0)
            for name in value.kind.names:
                held = held + value.column.getField(name).isNotNull().cast("int")
        return [self.when(broken(held), value, rule)]

    def _minProperties(self, asked, value, _schema):
        return self._size(value, "minProperties", lambda n: n < asked)

    def _maxProperties(self, asked, value, _schema):
        return self._size(value, "maxProperties", lambda n: n > asked)

    # rules for lists

    def _list(self, value, rule, broken: Callable[[Column], Column]):
        return [self.when(broken(value.column), value, rule)] if isinstance(value.kind, T.ArrayType) else []

    def _items(self, asked, value, _schema):
        if not isinstance(value.kind, T.ArrayType):
            return []

        def of_item(item: Column, at: Column) -> Column:
            one = Value(item, value.kind.elementType, F.concat(value.path, F.lit("["), at.cast("string"), F.lit("]")))
            return _together(self.violations(asked, one))

        return [F.coalesce(F.flatten(F.transform(value.column, of_item)), _nothing())]

    def _minItems(self, asked, value, _schema):
        return self._list(value, "minItems", lambda c: F.size(c) < asked)

    def _maxItems(self, asked, value, _schema):
        return self._list(value, "maxItems", lambda c: F.size(c) > asked)

    def _uniqueItems(self, asked, value, _schema):
        return self._list(value, "uniqueItems", lambda c: F.size(F.array_distinct(c)) < F.size(c)) if asked else []

    def _contains(self, asked, value, _schema):
        if not isinstance(value.kind, T.ArrayType):
            return []
        fits = lambda item: item.isNotNull() & self.keeps(asked, Value(item, value.kind.elementType, value.path))
        return [self.when(~F.exists(value.column, fits), value, "contains")]


def violations(df: DataFrame, document: dict, columns: list[str] | None = None) -> Column:
    """Violations (path, rule) of each row, taken as an object of ``columns``, in the order of the document's keywords."""
    held = columns or df.columns
    record = F.struct(*[F.col(c) for c in held])
    value = Value(record, T.StructType([df.schema[c] for c in held]), F.lit("$"))
    return F.concat(_nothing(), *Compiler(document).violations(document, value))


def validate_schema(df: DataFrame, document: dict, columns: list[str] | None = None) -> DataFrame:
    """``df`` with ``errors`` (path, rule) and ``valid``."""
    return df.withColumn("errors", violations(df, document, columns)).withColumn("valid", F.size("errors") == 0)


def error_rows(df: DataFrame, document: dict, key: str, columns: list[str] | None = None) -> DataFrame:
    """One row (key, path, rule) for each violation."""
    listed = df.select(key, violations(df, document, columns).alias("errors"))  # a column first: as a generator's own input the list comes out empty
    # outer: otherwise the optimizer asks for filled lists below, which forms every list twice
    return listed.select(key, F.inline_outer("errors")).filter(F.col("rule").isNotNull())
