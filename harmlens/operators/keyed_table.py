"""Stored tables that an upsert rewrites only where it touches them.

A table is a Parquet folder dealt by a hash of its key: ``of=<slots>/slot=<n>``. An upsert finds the slots of its new
rows, reads those alone by partition pruning, and replaces those alone. What it will write is stored first, in the
shared scratch folder, so that a job that dies while it replaces them can be finished from there; running the upsert
anew instead would add to running totals twice. One upsert at a time writes to a table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmlens.functions.exprs import row_count
from harmlens.workspace import scratch_path

OF, SLOT = "of", "slot"
Merge = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class KeyedTable:
    """Where a table lies and how it is dealt. Keys are unique or null, of types that hash (not maps or VARIANT)."""

    path: str
    keys: tuple[str, ...]
    schema: T.StructType
    slots: int = 64


@dataclass(frozen=True)
class Staged:
    """Whole new contents of some slots of a table."""

    path: str
    table: KeyedTable
    slots: tuple[int, ...]


def create(df: DataFrame, path: str, keys: tuple[str, ...], slots: int = 64) -> KeyedTable:
    """Store ``df`` as a keyed table, in place of what is there."""
    table = KeyedTable(path, keys, df.schema, slots)
    _dealt(df, table).write.mode("overwrite").partitionBy(OF, SLOT).parquet(path)
    return table


def read(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """All rows, without the columns that deal them."""
    return _stored(spark, table).drop(OF, SLOT)


def stage(table: KeyedTable, new: DataFrame, merge: Merge) -> Staged:
    """Read the slots that ``new`` touches, merge, and store the result; the table itself is not changed yet.

    ``merge(old, new)`` is an upsert by the table's keys that returns its columns, such as ``warehouse.upsert`` with its
    values bound. ``new`` is stored once before it is read twice. The driver gets the numbers of touched slots.
    """
    spark = new.sparkSession
    place = scratch_path(spark, "upsert")
    _dealt(new, table).write.parquet(f"{place}/new")
    given = spark.read.parquet(f"{place}/new")
    touched = tuple(sorted(r[0] for r in given.select(SLOT).distinct().collect()))
    old = _stored(spark, table)
    if not old.filter(F.col(OF) != table.slots).isEmpty():
        raise ValueError(f"{table.path} is dealt to another number of slots than {table.slots}")
    merged = merge(old.filter(F.col(SLOT).isin(*touched)).drop(OF, SLOT), given.drop(OF, SLOT))
    _dealt(merged, table, touched).write.partitionBy(OF, SLOT).parquet(f"{place}/merged")
    return Staged(f"{place}/merged", table, touched)


def land(spark: SparkSession, staged: Staged) -> None:
    """Replace the staged slots of the table; landing again gives the same table."""
    if staged.slots:
        spark.read.parquet(staged.path).hint("rebalance", F.col(SLOT)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(OF, SLOT).parquet(staged.table.path)


def upsert_stored(table: KeyedTable, new: DataFrame, merge: Merge) -> DataFrame:
    """Stage and land; one row with the numbers of touched slots and of rewritten rows. No new rows change nothing."""
    spark = new.sparkSession
    staged = stage(table, new, merge)
    land(spark, staged)
    if not staged.slots:
        return spark.createDataFrame([(0, 0)], "slots int, rows bigint")
    return spark.read.parquet(staged.path).agg(F.lit(len(staged.slots)).alias("slots"), row_count().alias("rows"))


def _stored(spark: SparkSession, table: KeyedTable) -> DataFrame:
    # nullable throughout, so that an empty table, which has no files, reads as well
    whole = T.StructType([T.StructField(f.name, f.dataType) for f in table.schema]).add(OF, T.IntegerType()).add(SLOT, T.IntegerType())
    return spark.read.schema(whole).parquet(table.path)


def _dealt(df: DataFrame, table: KeyedTable, among: tuple[int, ...] | None = None) -> DataFrame:
    """Rows with their slot; a slot has one writer, unless AQE splits a large one.

    A row whose key holds a null matches nothing, so it may lie anywhere: its whole content deals it to one of the slots
    ``among``, or of all, and many such rows don't fill one slot. An upsert names the slots that it rewrites: what a row
    holds changes in the merge, and a slot that is not rewritten whole must get no row.
    """
    null = F.lit(False)
    for k in table.keys:
        null = null | F.col(k).isNull()
    places = F.sequence(F.lit(0), F.lit(table.slots - 1)) if among is None else F.array(*map(F.lit, among)).cast("array<int>")
    anywhere = F.get(places, F.pmod(F.xxhash64(*df.columns), F.size(places)).cast("int"))
    slot = F.when(null, anywhere).otherwise(F.pmod(F.xxhash64(*table.keys), F.lit(table.slots)).cast("int"))
    return df.withColumns({OF: F.lit(table.slots), SLOT: slot}).hint("rebalance", F.col(SLOT))
