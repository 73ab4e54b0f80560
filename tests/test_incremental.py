"""Statistics merged from batches against statistics of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from harmlens.operators import aggregates as agg
from harmlens.operators import incremental as inc
from harmlens.workspace import scratch_path

DDL = "source string, jurisdiction string, year int, incident_type string, industry_code string, days_lost double"


def incidents(r, n, codes):
    maybe = lambda x: None if r.random() < 0.08 else x
    return [(maybe(r.choice("AB")), maybe(r.choice(["USA", "Quebec"])), maybe(r.randint(2010, 2014)), maybe(r.choice(["fatal", "illness"])),
             maybe(r.choice(codes)), maybe(float(r.randint(0, 9)))) for _ in range(n)]


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def same(spark, root, everything):
    assert rows(inc.global_stats(spark, root)) == rows(agg.global_stats(everything))
    assert rows(inc.dashboard_summary(spark, root)) == rows(agg.dashboard_summary(everything))
    assert rows(inc.yearly_stats(spark, root)) == rows(agg.yearly_stats(everything))
    assert rows(inc.health_check(spark, root)) == rows(agg.health_check(everything))
    assert rows(inc.jurisdiction_summary(spark, root)) == rows(agg.jurisdiction_summary(everything))


def test_batches_equal_one_scan_and_old_batches_are_not_read(spark):
    r, base = random.Random(1), scratch_path(spark, "batches")
    codes = [f"code{k}" for k in range(70_000)]  # more than one bitmap of ids
    batches = [incidents(r, n, codes[low:high]) for n, low, high in ((900, 0, 60), (700, 30, 70_000), (800, 0, 300))]
    root = f"{base}/state"
    for k, batch in enumerate(batches):
        spark.createDataFrame(batch, DDL).write.parquet(f"{base}/raw/{k}")
        inc.apply_batch(spark.read.parquet(f"{base}/raw/{k}"), root, f"b{k}")
        files = inc._read(spark, root, "sums", inc.SUMS).inputFiles()
        assert all("/state/" in f for f in files)
    everything = spark.createDataFrame([row for batch in batches for row in batch], DDL)
    same(spark, root, everything)
    read = [f for f in inc.global_stats(spark, root).inputFiles() if "/raw/" in f]
    assert read == []
    inc.apply_batch(spark.read.parquet(f"{base}/raw/2"), root, "b2")  # again
    same(spark, root, everything)
    inc.compacted(spark, root, f"{base}/small")
    same(spark, f"{base}/small", everything)
    ids = inc._read(spark, root, "codes", inc.CODES)
    assert ids.count() == ids.select("id").distinct().count() == ids.select("code").distinct().count()
    inc.apply_batch(everything.limit(50), f"{base}/small", "next")
    same(spark, f"{base}/small", everything.unionByName(everything.limit(50)))


def test_state_grows_with_groups_not_rows(spark):
    root = scratch_path(spark, "small")
    big = spark.range(200_000).select(F.lit("A").alias("source"), F.lit("USA").alias("jurisdiction"), F.lit(2020).alias("year"), F.lit("fatal").alias("incident_type"),
                                      (F.col("id") % 40).cast("string").alias("industry_code"), F.lit(1.0).alias("days_lost"))
    inc.apply_batch(big, root, "1")
    assert inc._read(spark, root, "sums", inc.SUMS).count() == 1
    assert inc._read(spark, root, "bits", inc.BITS).count() == 1
    assert inc.global_stats(spark, root).first().industries_affected == 40


@pytest.mark.parametrize("statistic", [inc.global_stats, inc.dashboard_summary, inc.yearly_stats, inc.jurisdiction_summary])
def test_no_batches_and_empty_batches(spark, statistic):
    root = scratch_path(spark, "none")
    assert statistic(spark, root).collect() == []
    inc.apply_batch(spark.createDataFrame([], DDL), root, "empty")
    assert statistic(spark, root).collect() == []
    assert inc.health_check(spark, root).first().total_incidents == 0
