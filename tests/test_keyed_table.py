"""Upserts that rewrite only the slots they touch."""

from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from harmlens.operators import keyed_table as kt
from harmlens.operators import warehouse as wh

ROW = "k string, n bigint, note string"


def rows(spark, *values):
    return spark.createDataFrame(list(values), ROW)


def files(path) -> dict[str, int]:
    return {str(p): p.stat().st_size for p in Path(path).rglob("*.parquet")}


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def merge(old, new):
    return wh.upsert(old, new, ["k"], on_create={"n": F.col("n.n"), "note": F.lit("created")}, on_match={"n": F.col("o.n") + F.col("n.n")})


def test_only_touched_slots_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("n"), F.lit("old").alias("note"))
    table = kt.create(old, path, ("k",))
    before = files(path)
    new = rows(spark, ("7", 100, None), ("x", 1, None), ("8", None, None))
    want = listed(merge(old, new))
    said = kt.upsert_stored(table, new, merge).first()
    after = files(path)
    assert listed(kt.read(spark, table)) == want and 1 <= said.slots <= 3
    kept = before.keys() & after.keys()
    assert len({Path(p).parent for p in kept}) == 64 - said.slots and len({Path(p).parent for p in after.keys() - kept}) == said.slots
    assert sum(after[p] for p in after.keys() - kept) < sum(after.values()) * (said.slots + 1) / 64
    assert said.rows < 5000 * (said.slots + 1) / 64


def test_null_keys_never_match_and_are_spread(spark, tmp_path):
    path = str(tmp_path / "t")
    table = kt.create(spark.range(2000).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("n"), F.lit("old").alias("note")), path, ("k",))
    assert len({Path(p).parent for p in files(path)}) == 64
    kt.upsert_stored(table, rows(spark, (None, 5, None), (None, 6, None)), merge)
    got = kt.read(spark, table)
    assert got.count() == 2002 and got.filter("note = 'created'").count() == 2 and got.filter("k is not null").isEmpty()


def test_landing_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    table = kt.create(rows(spark, ("a", 1, "old"), ("b", 2, "old")), path, ("k",))
    staged = kt.stage(table, rows(spark, ("a", 10, None)), merge)
    assert listed(kt.read(spark, table)) == [("a", 1, "old"), ("b", 2, "old")]
    for _ in range(2):
        kt.land(spark, staged)
        assert listed(kt.read(spark, table)) == [("a", 11, "old"), ("b", 2, "old")]


def test_nothing_new_and_nothing_old(spark, tmp_path):
    path = str(tmp_path / "t")
    table = kt.create(rows(spark, ("a", 1, "old")), path, ("k",))
    before = files(path)
    assert tuple(kt.upsert_stored(table, rows(spark), merge).first()) == (0, 0) and files(path) == before


def test_another_number_of_slots_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    table = kt.create(rows(spark, ("a", 1, "old")), path, ("k",), slots=8)
    with pytest.raises(ValueError, match="slots"):
        kt.upsert_stored(replace(table, slots=16), rows(spark, ("a", 1, None)), merge)


def test_source_totals_by_slots(spark, tmp_path):
    """Two runs of T01 equal the join over the whole table."""
    path = str(tmp_path / "t")
    runs = lambda *v: spark.createDataFrame(list(v), "source_key string, source_name string, jurisdiction string, rows bigint, status string, error_message string")
    first, second = runs(("a", "A", "X", 5, "ok", None)), runs(("a", "A", "X", 7, "ok", None), ("b", "B", "Y", 1, "failed", "e"))
    day = lambda d: datetime(2024, 1, d)
    table = kt.create(wh.empty_status(spark), path, ("source_key",))
    whole = wh.empty_status(spark)
    for d, new in ((1, first), (2, second)):
        kt.upsert_stored(table, new, lambda o, n, d=d: wh.update_sources(o, n, day(d)))
        whole = wh.update_sources(whole, new, day(d))
    assert listed(kt.read(spark, table).select(*whole.columns)) == listed(whole)
