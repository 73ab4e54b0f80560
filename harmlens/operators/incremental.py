"""Incident statistics kept up to date by batch (A16-A19, A21, A23 without a rescan).

Each ingest batch is reduced once to mergeable state in folders of its own: sums, counts and extremes by jurisdiction, source,
year and type, and for the distinct industries of a group one exact bitmap over the ids of a code dictionary. Statistics are
merged from all batches' state; the incidents themselves are never read again. A batch that is repeated replaces its state,
and gives codes the same ids, as long as no later batch has been applied.

The state's size follows the number of groups, not of incidents. ``compacted`` merges the batches of a root into another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harmlens.functions.exprs import row_count
from harmlens.workspace import cut_lineage

GROUP = ("jurisdiction", "year", "incident_type")
SUMS = "jurisdiction string, year int, incident_type string, source string, n bigint, days double, with_days bigint"
BITS = "jurisdiction string, year int, incident_type string, bucket bigint, bits binary"
CODES = "code string, id bigint"
SPREAD = 64  # dictionary ids are dealt out in so many independent sequences


def _read(spark: SparkSession, root: str, part: str, ddl: str, other_than: str | None = None) -> DataFrame:
    """A part of the state, of all batches or of all but one; empty where there is none."""
    path = f"{root.rstrip('/')}/{part}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], ddl)
    held = spark.read.schema(f"{ddl}, batch string").parquet(path)
    return (held if other_than is None else held.filter(F.col("batch") != other_than)).drop("batch")


def _write(df: DataFrame, root: str, part: str, batch: str) -> None:
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{part}/batch={batch}")


def _new_codes(known: DataFrame, codes: DataFrame) -> DataFrame:
    """Ids for the codes that are not known: each code's sequence goes on after its largest id."""
    part = F.pmod(F.xxhash64("code"), F.lit(SPREAD))
    last = known.groupBy(F.pmod("id", F.lit(SPREAD)).alias("part")).agg(F.max("id").alias("last"))
    new = codes.join(known.select("code"), "code", "left_anti").withColumn("part", part)
    place = F.row_number().over(Window.partitionBy("part").orderBy("code"))
    return new.join(last, "part", "left").select("code", (F.coalesce("last", F.col("part") - SPREAD) + place * SPREAD).alias("id"))


def apply_batch(incidents: DataFrame, root: str, batch: str) -> None:
    """Reduce one batch of incidents to its state; only the batch and the dictionary are read."""
    spark = incidents.sparkSession
    cells = cut_lineage(incidents.groupBy(*GROUP, "source", F.col("industry_code").alias("code")).agg(
        row_count().alias("n"), F.sum("days_lost").cast("double").alias("days"), F.count("days_lost").alias("with_days")))
    sums = cells.groupBy(*GROUP, "source").agg(F.sum("n").alias("n"), F.sum("days").alias("days"), F.sum("with_days").alias("with_days"))
    known = _read(spark, root, "codes", CODES, other_than=batch)
    codes = cells.filter("code is not null").select("code").distinct()
    added = cut_lineage(_new_codes(known, codes))
    ids = cells.filter("code is not null").select(*GROUP, "code").distinct().join(known.unionByName(added), "code")
    bits = ids.groupBy(*GROUP, F.expr("bitmap_bucket_number(id)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(id))").alias("bits"))
    _write(bits, root, "bits", batch)
    _write(sums, root, "sums", batch)
    _write(added, root, "codes", batch)


def compacted(spark: SparkSession, root: str, into: str, batch: str = "merged") -> None:
    """The state of all batches of ``root`` as one batch of another root."""
    sums = _read(spark, root, "sums", SUMS).groupBy(*GROUP, "source").agg(*[F.sum(c).alias(c) for c in ("n", "days", "with_days")])
    bits = _read(spark, root, "bits", BITS).groupBy(*GROUP, "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    for part, df in (("sums", sums), ("bits", bits), ("codes", _read(spark, root, "codes", CODES))):
        _write(df, into, part, batch)


def _fatal(count: Column) -> Column:
    return F.sum(F.when(F.col("incident_type") == "fatal", count).otherwise(0))


def global_stats(spark: SparkSession, root: str) -> DataFrame:
    """A16 from the state."""
    bits = _read(spark, root, "bits", BITS).groupBy(*GROUP, "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    industries = bits.groupBy(*GROUP).agg(F.sum(F.expr("bitmap_count(bits)")).alias("industries"))
    sums = _read(spark, root, "sums", SUMS).groupBy(*GROUP).agg(
        F.sum("n").alias("incident_count"), _fatal(F.col("n")).alias("fatalities"), F.try_divide(F.sum("days"), F.sum("with_days")).alias("avg_days_lost"))
    # a part of the key may be null; groups are small, and AQE broadcasts them
    same = [sums[c].eqNullSafe(industries[c]) for c in GROUP]
    return sums.join(industries, same, "left").select(
        *[sums[c] for c in GROUP], "incident_count", "fatalities", "avg_days_lost", F.coalesce("industries", F.lit(0)).cast("bigint").alias("industries_affected"))


def dashboard_summary(spark: SparkSession, root: str) -> DataFrame:
    """A17 from the state."""
    return _read(spark, root, "sums", SUMS).groupBy("jurisdiction").agg(
        F.sum("n").alias("total_incidents"), _fatal(F.col("n")).alias("total_fatalities"), F.count_distinct("year").alias("years_covered"),
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count_distinct("source").alias("data_sources"))


def yearly_stats(spark: SparkSession, root: str) -> DataFrame:
    """A18 from the state."""
    return _read(spark, root, "sums", SUMS).groupBy("jurisdiction", "year").agg(
        F.sum("n").alias("incidents"), _fatal(F.col("n")).alias("fatalities"), F.round(F.try_divide(F.sum("days"), F.sum("with_days")), 1).alias("avg_days_lost"))


def health_check(spark: SparkSession, root: str) -> DataFrame:
    """A19 from the state."""
    return _read(spark, root, "sums", SUMS).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_incidents"), F.count_distinct("jurisdiction").alias("jurisdictions"),
        F.count_distinct("source").alias("sources"), F.make_date(F.min("year"), F.lit(1), F.lit(1)).alias("oldest_incident"),
        F.make_date(F.max("year"), F.lit(12), F.lit(31)).alias("newest_incident"))


def jurisdiction_summary(spark: SparkSession, root: str) -> DataFrame:
    """A21 from the state."""
    return _read(spark, root, "sums", SUMS).groupBy("jurisdiction").agg(
        F.sum("n").alias("incidents"), F.count_distinct("year").alias("years"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def coverage(spark: SparkSession, root: str, quebec: str = "Quebec", usa: str = "USA", europe: str = "EU27") -> DataFrame:
    """A23 from the state: incidents of three jurisdictions, their sum, and the years that Quebec covers."""
    of = lambda name: F.coalesce(F.sum(F.when(F.col("jurisdiction") == name, F.col("n"))), F.lit(0))
    counts = _read(spark, root, "sums", SUMS).agg(
        of(quebec).alias("qc"), of(usa).alias("usa"), of(europe).alias("eu27"),
        F.array_sort(F.collect_set(F.when(F.col("jurisdiction") == quebec, F.col("year")))).alias("years_covered"))
    return counts.withColumn("total_incidents", F.col("qc") + F.col("usa") + F.col("eu27"))
