"""Records of mixed sources as VARIANT values (S07, H11): nested values and numbers are kept as they came."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Reasons of lines that hold no record.
NOT_JSON, NOT_OBJECT = "not JSON", "not an object"


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """One row per filled line: ``record`` (VARIANT), or ``reason`` and the ``line`` itself; blank and null lines are none.

    A line that repeats a field, or is larger than a VARIANT may be, counts as not JSON.
    """
    filled = lines.filter(F.trim(line) != "").select(F.col(line).alias("line"), F.try_parse_json(line).alias("record"))
    whole = F.schema_of_variant("record").startswith("OBJECT")
    reason = F.when(F.col("record").isNull(), NOT_JSON).when(~whole, NOT_OBJECT)
    return filled.withColumn("reason", reason).select(
        F.when(F.col("reason").isNull(), F.col("record")).alias("record"), "reason", F.when(F.col("reason").isNotNull(), F.col("line")).alias("line"))


def land_variants(spark: SparkSession, source: str, target: str) -> None:
    """Text files of JSON lines into Parquet: parsed once, records and rejected lines in folders of their own."""
    parsed = parse_lines(spark.read.text(source)).withColumn("lane", F.when(F.col("reason").isNull(), "records").otherwise("rejected"))
    parsed.write.mode("overwrite").option("compression", "zstd").partitionBy("lane").parquet(target)


def landed_records(spark: SparkSession, target: str) -> DataFrame:
    """The records of ``land_variants``."""
    return spark.read.parquet(target).filter("lane = 'records'").select("record")


def landed_rejects(spark: SparkSession, target: str) -> DataFrame:
    """Its lines without a record, with the reason."""
    return spark.read.parquet(target).filter("lane = 'rejected'").select("reason", "line")
