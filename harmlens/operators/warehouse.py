"""Warehouse state: upserts, batch log, uniqueness, seeds.

Plain Parquet has no row updates, so an upsert reads the old table and gives the
new one; the caller writes it to a new path and never in place.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harmlens.functions import dims
from harmlens.functions.exprs import row_count
from harmlens.operators.windows import order_nulls_last
from harmlens.schemas import BATCH_LOG, SOURCE_STATUS, struct
from harmlens.workspace import cut_lineage


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], on_create: dict[str, Column], on_match: dict[str, Column]) -> DataFrame:
    """Full outer join of old and new rows by key.

    ``on_create`` and ``on_match`` give column values from ``o.*`` and ``n.*``;
    columns they leave out keep the old value on a match and are NULL on a create.
    ``new`` holds at most one row per key.
    """
    o, n = old.alias("o"), new.withColumn("__new", F.lit(True)).alias("n")
    joined = o.withColumn("__old", F.lit(True)).alias("o").join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full")
    is_new, is_old = F.col("n.__new").isNotNull(), F.col("o.__old").isNotNull()
    out = []
    for c in old.columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c))
            continue
        kept = F.col(f"o.{c}")
        matched = on_match.get(c, kept)
        created = on_create.get(c, F.lit(None))
        out.append(F.when(is_new & is_old, matched).when(is_new, created).otherwise(kept).alias(c))
    return joined.select(*out)


def update_sources(status: DataFrame, runs: DataFrame, as_of: datetime) -> DataFrame:
    """Add each run's rows to the running totals. A first run leaves
    ``total_rows`` at 0; only later runs add to it."""
    n = lambda c: F.col(f"n.{c}")
    now = F.lit(as_of).cast("timestamp")
    common = {"source_name": n("source_name"), "jurisdiction": n("jurisdiction"), "last_ingestion": now, "status": n("status"),
              "error_message": n("error_message"), "updated_at": now}
    return upsert(status, runs, ["source_key"],
                  on_create={**common, "rows_ingested": n("rows"), "total_rows": F.lit(0).cast("bigint")},
                  on_match={**common, "rows_ingested": F.col("o.rows_ingested") + n("rows"), "total_rows": F.col("o.total_rows") + n("rows")})


def empty_status(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], struct(SOURCE_STATUS))


def source_status(status: DataFrame) -> DataFrame:
    """Latest ingestion first, never-ingested sources last."""
    return order_nulls_last(status.select("source_key", "source_name", "jurisdiction", "last_ingestion", "rows_ingested", "total_rows", "status"),
                            "last_ingestion")


def batch_row(spark: SparkSession, batch: str, rows: int, as_of: datetime) -> DataFrame:
    """The log row of one batch, to be appended."""
    return spark.createDataFrame([(batch, as_of, as_of, "success", rows)], struct(BATCH_LOG))


def batch_log(loaded: DataFrame, batch: str, as_of: datetime) -> DataFrame:
    """T02 from the loaded rows themselves: one log row per batch id."""
    now = F.lit(as_of).cast("timestamp")
    return loaded.groupBy(F.col(batch).alias("batch_id")).agg(row_count().alias("total_rows_ingested")).select(
        "batch_id", now.alias("started_at"), now.alias("completed_at"), F.lit("success").alias("status"), "total_rows_ingested")


def unique_rows(df: DataFrame, keys: Sequence[str], existing: DataFrame | None = None) -> DataFrame:
    """One row per key, the smallest by its remaining columns, and none already stored.

    Equal rows are counted first, by hash; only distinct rows meet the minimum, so a
    key holding a third of all rows neither sorts nor gathers them.
    """
    rest = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*df.columns).agg(row_count().alias("copies"))
    best = counted.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__best"), F.sum("copies").alias("copies"))
    out = best.select(*keys, "__best.*", "copies")
    return out if existing is None else out.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def rejected_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that lost, each distinct row once with how many copies were turned away.

    The input is read once: equal rows are counted by hash and stored, and the
    minimum and the join only meet distinct rows; AQE splits the join where one
    key still dominates.
    """
    rest = [c for c in df.columns if c not in keys]
    counted = cut_lineage(df.groupBy(*df.columns).agg(row_count().alias("copies"))).select(*keys, F.struct(*rest).alias("__row"), "copies")
    best = counted.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min("__row").alias("__best"))
    joined = counted.join(best, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    left = F.col("copies") - F.when(F.col("__row") == F.col("__best"), 1).otherwise(0)
    return joined.select(*keys, "__row.*", left.alias("rejected")).filter(F.col("rejected") > 0)


def seed_missing(table: DataFrame, seed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add seed rows whose key is not there yet; existing rows stay as they are."""
    return table.unionByName(seed.join(table.select(*keys).distinct(), list(keys), "left_anti"), allowMissingColumns=True)


def industry_mapping(spark: SparkSession) -> DataFrame:
    """The industry crosswalk with each sector's typical hazards as an array."""
    hazards = dims.frame(spark, dims.SECTOR_RISK).groupBy(F.col("sector").alias("__s")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("risk_ord", "risk_type"))), lambda r: r["risk_type"]).alias("typical_hazards"))
    codes = dims.frame(spark, dims.SECTOR_CROSSWALK)
    return codes.join(F.broadcast(hazards), F.col("scian") == F.col("__s"), "left").select(
        F.col("naics").alias("naics_code"), F.col("nace").alias("nace_code"), F.col("scian").alias("scian_code"),
        F.col("name_en").alias("industry_name_en"), F.col("name_fr").alias("industry_name_fr"), "typical_hazards")
