"""Merging files whose column types differ."""

from functools import reduce
from itertools import permutations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmlens.sources.widening import merge_widened, wider

KINDS = [T.ByteType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(5, 2), T.DecimalType(38, 0),
         T.StringType(), T.BooleanType(), T.DateType(), T.TimestampNTZType(), T.NullType()]


def save(spark, folder, ddl, rows):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(str(folder))


def test_order_of_types_has_no_effect():
    for some in permutations(KINDS, 3):
        assert reduce(wider, some) == reduce(wider, sorted(some, key=str)), some


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("int", "double", "double"), ("bigint", "double", "string"), ("smallint", "float", "float"),
    ("int", "float", "double"), ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(38,0)", "decimal(5,2)", "string"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("boolean", "int", "string"), ("array<int>", "array<bigint>", "array<bigint>"), ("struct<a:int>", "struct<A:bigint,b:int>", "struct<a:bigint,b:int>"),
    ("struct<a:int>", "int", "string"), ("map<string,int>", "map<string,double>", "map<string,double>")])
def test_wider(spark, a, b, want):
    kind = lambda ddl: T.DataType.fromDDL(ddl)
    assert wider(kind(a), kind(b)).simpleString() == want == wider(kind(b), kind(a)).simpleString().replace("A:", "a:")


def test_values_types_and_reports(spark, tmp_path):
    save(spark, tmp_path / "run=007", "k string, n int, w int, s struct<a:int>", [("a", 1, 2, (3,)), ("b", None, None, None)])
    save(spark, tmp_path / "run=007", "k string, n bigint, w bigint, only string", [("c", 2**62 + 1, 2**40, "x")])
    save(spark, tmp_path / "run=x", "k string, n double, s struct<a:bigint,b:string>", [("d", 0.1, (2**40, "y"))])
    save(spark, tmp_path / "run=x", "k string, n string, w int", [("e", "many", 7)])
    save(spark, tmp_path / "run=x", "k string, n string, w int", [("f", None, 8)])
    (tmp_path / "run=x" / "part-bad.parquet").write_bytes(b"PAR1 not really PAR1")
    (tmp_path / "run=x" / "part-zero.parquet").write_bytes(b"")  # passed over, as Spark does
    merged = merge_widened(spark, str(tmp_path))
    assert {f.name: f.dataType.simpleString() for f in merged.rows.schema} == {
        "k": "string", "n": "string", "w": "bigint", "s": "struct<a:bigint,b:string>", "only": "string", "run": "string"}
    got = {r.k: (r.n, r.w, r.s and tuple(r.s), r.only, r.run) for r in merged.rows.collect()}
    assert got == {"a": ("1", 2, (3, None), None, "007"), "b": (None, None, None, None, "007"), "c": (str(2**62 + 1), 2**40, None, "x", "007"),
                   "d": ("0.1", None, (2**40, "y"), None, "x"), "e": ("many", 7, None, None, "x"), "f": (None, 8, None, None, "x")}
    named = [(r.column, r.type, r.merged_type) for r in merged.conflicts.collect()]
    assert {("n", t, "string") for t in ("int", "bigint", "double", "string")} < set(named)
    assert {("w", t, "bigint") for t in ("int", "bigint")} < set(named) and not [n for n in named if n[0] in ("k", "only")]
    assert sum(r.files for r in merged.conflicts.filter("column = 'n'").collect()) == 5
    assert {r.path.rpartition("/")[2] for r in merged.unreadable.collect()} == {"part-bad.parquet"}


def test_empty_files_are_not_unreadable(spark, tmp_path):
    save(spark, tmp_path / "a", "k string, n int", [])
    save(spark, tmp_path / "b", "k string, n string", [("x", "y")])
    merged = merge_widened(spark, str(tmp_path))
    assert [tuple(r) for r in merged.rows.collect()] == [("x", "y")] and merged.unreadable.isEmpty()
    assert merged.conflicts.count() == 2


def test_nothing_readable(spark, tmp_path):
    (tmp_path / "bad.parquet").write_bytes(b"no")
    merged = merge_widened(spark, str(tmp_path))
    assert merged.rows.columns == [] and merged.rows.isEmpty() and merged.unreadable.count() == 1


def test_jobs_grow_with_the_changes_of_schema(spark, tmp_path):
    """Twenty files by two writers, one after the other: a handful of merges, and two reads."""
    spark.range(40).select(F.col("id").cast("int").alias("n")).repartition(10).write.parquet(str(tmp_path / "a"))
    spark.range(40).select(F.col("id").cast("string").alias("n")).repartition(10).write.parquet(str(tmp_path / "b"))
    merged = merge_widened(spark, str(tmp_path))
    assert sorted(r.n for r in merged.rows.collect()) == sorted(2 * [str(i) for i in range(40)])
    assert merged.rows._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
