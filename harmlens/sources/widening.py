"""Merging Parquet files whose column types differ.

Spark's own ``mergeSchema`` joins files that lack columns, and stops where two files hold one column with two
types. Here files are dealt to groups that Spark can merge, each group is read with its own schema, and its
columns are cast to the least type that holds the values of all groups without loss.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmlens.operators.windows import concat

WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
DIGITS = dict(zip(WHOLE, (3, 5, 10, 19), strict=True))
# a double holds every 32-bit integer, a float every 16-bit one
FRACTION = {T.FloatType(): WHOLE[:2], T.DoubleType(): (*WHOLE[:3], T.FloatType())}
NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
CONFLICTS = "column string, type string, files bigint, merged_type string"
UNREADABLE = "path string, length bigint, reason string"


@dataclass(frozen=True)
class Merged:
    """All rows, the columns that had several types, and the files that are no Parquet files."""

    rows: DataFrame
    conflicts: DataFrame
    unreadable: DataFrame


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both without loss; text where there is no other.

    Integers widen among themselves and into decimals, 32-bit and smaller ones into doubles; a 64-bit integer and a
    double meet as text. Structs widen field by field, arrays and maps by their values.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _wider_fields(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, wider(a.valueType, b.valueType))
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    for one, other in ((a, b), (b, a)):
        if other in FRACTION.get(one, ()):
            return one
        if one == T.FloatType() and other == T.IntegerType():
            return T.DoubleType()
        if isinstance(one, T.DecimalType) and (other in DIGITS or isinstance(other, T.DecimalType)):
            precision, scale = (DIGITS[other], 0) if other in DIGITS else (other.precision, other.scale)
            scale, ahead = max(one.scale, scale), max(one.precision - one.scale, precision - scale)
            return T.DecimalType(ahead + scale, scale) if ahead + scale <= 38 else T.StringType()
        if (one, other) == (T.TimestampNTZType(), T.DateType()):
            return one
    return T.StringType()


def _wider_fields(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of both by name, as Spark compares names: without regard to case, spelt as met first."""
    theirs = {f.name.lower(): f for f in b}
    mine = {f.name.lower() for f in a}
    kept = [T.StructField(f.name, wider(f.dataType, theirs[f.name.lower()].dataType) if f.name.lower() in theirs else f.dataType) for f in a]
    return T.StructType(kept + [T.StructField(f.name, f.dataType) for f in b if f.name.lower() not in mine])


def widened(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` as the wider type. Nested values become JSON text where the wider type is text, bytes base 64."""
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        held = {f.name.lower(): f for f in have}
        fields = [(widened(value.getField(held[f.name.lower()].name), held[f.name.lower()].dataType, f.dataType) if f.name.lower() in held
                   else F.lit(None).cast(f.dataType)).alias(f.name) for f in want]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda v: widened(v, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        return F.transform_values(value, lambda _, v: widened(v, have.valueType, want.valueType))
    if isinstance(want, T.StringType) and isinstance(have, NESTED):
        return F.to_json(value)
    if isinstance(want, T.StringType) and isinstance(have, T.BinaryType):
        return F.base64(value)
    return value.cast(want)


def merge_widened(spark: SparkSession, root: str) -> Merged:
    """All Parquet files under ``root`` by column name, whatever types they give a column.

    Footers are read by Spark's schema merge, in parallel. A set of files that it can't merge is halved, in order of
    writing, so files of one writer stay together and the number of jobs grows with the changes of schema along that
    order. The driver holds the list of files, as Spark does for any folder; no rows, no file contents. Values of folder
    names keep their spelling where groups disagree on their type. Files that are no Parquet files are listed and
    skipped; no readable file gives an empty frame without columns. Hidden files (``_`` and ``.``) and files of no bytes are
    passed over.
    """
    listed = _files(spark, root)
    bad = _unreadable(spark, root, listed)
    held = listed.join(spark.createDataFrame(bad, UNREADABLE).select("path"), "path", "left_anti") if bad else listed
    paths = [r.path for r in held.orderBy("modificationTime", "path").select("path").collect()]
    groups = _groups(spark, root, paths)
    empty = spark.createDataFrame([], T.StructType([]))
    if not groups:
        return Merged(empty, spark.createDataFrame([], CONFLICTS), spark.createDataFrame(bad, UNREADABLE))
    whole = reduce(wider, [schema for schema, _ in groups])
    rows = concat(*[_read(spark, root, schema, files, whole) for schema, files in groups])
    return Merged(rows.select(*[_named(f.name) for f in whole]), spark.createDataFrame(_conflicts(groups, whole), CONFLICTS),
                  spark.createDataFrame(bad, UNREADABLE))


def _named(column: str) -> Column:
    return F.col(f"`{column.replace('`', '``')}`")


def _files(spark: SparkSession, root: str) -> DataFrame:
    """Path, size and time of every file; no contents are read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(
        "path", "length", "modificationTime", F.col("_metadata.file_path").alias("uri"))


def _unreadable(spark: SparkSession, root: str, files: DataFrame) -> list[tuple[str, int, str]]:
    """Files without a readable footer.

    One scan of footers finds the files that hold rows; only the others, empty or unreadable, are tried one by one.
    """
    holding = spark.read.schema("__none string").option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).parquet(root).select(
        F.col("_metadata.file_path").alias("uri")).distinct()
    tried = [(r.path, r.length, _failure(spark, r.path)) for r in files.join(holding, "uri", "left_anti").orderBy("path").collect()]
    return [t for t in tried if t[2]]


def _failure(spark: SparkSession, path: str) -> str | None:
    try:
        spark.read.option("ignoreCorruptFiles", False).parquet(path)
    except (Py4JJavaError, PySparkException) as failure:
        for reason in ("CANNOT_READ_FILE_FOOTER", "UNABLE_TO_INFER_SCHEMA"):
            if reason in str(failure):
                return reason
        raise
    return None


def _groups(spark: SparkSession, root: str, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Sets of files that Spark can merge, with their schemas; sets of one schema become one."""
    found: dict[str, tuple[T.StructType, list[str]]] = {}
    todo = [list(paths)] if paths else []
    while todo:
        some = todo.pop()
        try:
            schema = spark.read.option("basePath", root).option("mergeSchema", True).parquet(*some).schema
        except (Py4JJavaError, PySparkException) as failure:
            if "CANNOT_MERGE_SCHEMAS" not in str(failure) or len(some) == 1:
                raise
            todo += [some[len(some) // 2:], some[:len(some) // 2]]
            continue
        found.setdefault(schema.json(), (schema, []))[1].extend(some)
    return list(found.values())


def _read(spark: SparkSession, root: str, schema: T.StructType, files: list[str], whole: T.StructType) -> DataFrame:
    """One group, cast to the merged types. A folder value is read as its merged type at once, from its spelling."""
    merged = {f.name.lower(): f for f in whole}
    folders = {part.partition("=")[0].lower() for part in unquote(files[0].rpartition("/")[0]).split("/") if "=" in part}
    own = T.StructType([T.StructField(f.name, merged[f.name.lower()].dataType if f.name.lower() in folders else f.dataType) for f in schema])
    held = spark.read.schema(own).option("basePath", root).parquet(*files)
    return held.select(*[widened(_named(f.name), f.dataType, merged[f.name.lower()].dataType).alias(merged[f.name.lower()].name) for f in own])


def _conflicts(groups: list[tuple[T.StructType, list[str]]], whole: T.StructType) -> list[tuple[str, str, int, str]]:
    """Every type of each column that has several, with the number of files in groups that give it."""
    out = []
    for column in whole:
        counts: dict[str, int] = {}
        for schema, files in groups:
            for f in schema:
                if f.name.lower() == column.name.lower():
                    counts[f.dataType.simpleString()] = counts.get(f.dataType.simpleString(), 0) + len(files)
        if len(counts) > 1:
            out += [(column.name, kind, n, column.dataType.simpleString()) for kind, n in sorted(counts.items())]
    return out
