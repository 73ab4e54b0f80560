"""Incremental ingest, unique ingest and spike alerts as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from harmlens.functions.exprs import change_pct, row_count
from harmlens.workspace import cut_lineage


def ingest_new_files(spark: SparkSession, landing: str, schema: StructType, bronze: str, checkpoint: str, glob: str = "*.parquet") -> None:
    """Read only the files not seen before, stamp them with the batch, and append.

    Each batch owns its folder, so a batch repeated after a failure replaces its
    own output and nothing is stored twice.
    """
    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(landing)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{bronze.rstrip('/')}/ingestion_batch={batch_id}")

    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(store).start()
    query.awaitTermination()


@dataclass(frozen=True)
class Run:
    """What one run of a stateful stream did: rows it stored, rows too late to be looked at, and the most rows its state held."""

    stored: int
    late: int
    state: int


def _run(query: StreamingQuery) -> Run:
    query.awaitTermination()
    operators = [o for p in query.recentProgress for o in p["stateOperators"]]
    return Run(0, sum(o["numRowsDroppedByWatermark"] for o in operators), max((o["numRowsTotal"] for o in operators), default=0))


def ingest_unique(spark: SparkSession, landing: str, schema: StructType, stored: str, checkpoint: str, keys: Sequence[str], at: str,
                  lateness: str = "2 days", glob: str = "*.parquet", **options: str) -> Run:
    """``ingest_new_files`` that stores a record once, however many files deliver it and in whatever run.

    A record is known by its keys for as long as its copies may come, which is ``lateness`` behind the newest event time
    seen; the state holds those keys only and goes on from the checkpoint after a restart. Each batch owns its folder.
    Rows older than that are neither compared nor stored here: their number is returned, and ``admit_late`` stores the
    ones that were new. Rows without an event time are late.
    """
    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", True).options(**options).parquet(landing)
    timed = stream.withColumn("__at", F.coalesce(F.col(at).cast("timestamp"), F.timestamp_seconds(F.lit(0)))).withWatermark("__at", lateness)
    rows = 0

    def store(batch: DataFrame, batch_id: int) -> None:
        nonlocal rows
        path = f"{stored.rstrip('/')}/ingestion_batch={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        rows += spark.read.parquet(path).count()  # a count of file footers

    unique = timed.dropDuplicatesWithinWatermark(list(keys)).drop("__at")
    writer = unique.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    run = _run(writer.foreachBatch(store).start())
    return Run(rows, run.late, run.state)


def admit_late(spark: SparkSession, landing: str, schema: StructType, stored: str, keys: Sequence[str], label: str, glob: str = "*.parquet") -> int:
    """Store the landed rows whose keys were never stored, one row a key; the number of rows.

    One pass over the landing and the stored keys, for runs that reported late rows. ``label`` names the folder, so that
    a repeated call with the same label replaces its own output.
    """
    path = f"{stored.rstrip('/')}/ingestion_batch=late-{label}"
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    landed = spark.read.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", True).parquet(landing)
    known = spark.read.schema(schema).parquet(stored).select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    rest = [c for c in landed.columns if c not in keys]
    new = landed.join(known, same, "left_anti").groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row")).select(*keys, "__row.*")
    held = cut_lineage(new.select(*landed.columns))  # the folder that is written is among those that are read
    held.write.mode("overwrite").parquet(path)
    return held.count()


def windowed_counts(events: DataFrame, key: str, at: str = "ts", width: str = "1 day", lateness: str = "2 days") -> DataFrame:
    """Rows per tumbling window and key; the watermark bounds the state that is kept."""
    timed = events.withColumn(at, F.col(at).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark(at, lateness)
    return timed.groupBy(F.window(at, width).alias("w"), F.col(key).alias("cle")).agg(row_count().alias("n"))


def spikes(counts: DataFrame, warn: float = 15, critical: float = 30) -> DataFrame:
    """Each window against the one before it, per key. ``counts`` has one row per window and key."""
    window = Window.partitionBy("cle").orderBy("debut")
    rows = counts.select("cle", F.col("w.start").alias("debut"), "n").withColumn("previous", F.lag("n").over(window))
    change = change_pct(F.col("n"), F.col("previous"))
    return rows.filter(F.col("previous").isNotNull()).withColumn("change_pct", F.round(change, 2)).withColumn(
        "level", F.when(F.col("change_pct") > critical, "CRITICAL").when(F.col("change_pct") > warn, "WARNING").otherwise("NORMAL"))


def stream_spikes(events: DataFrame, key: str, out: str, checkpoint: str, lateness: str = "2 days") -> StreamingQuery:
    """X02 on a stream: each batch stores the windows it changed, in a folder of its own.

    In update mode the state holds only windows that the watermark leaves open, and a batch that is
    repeated after a failure replaces its own folder. ``read_spikes`` compares the latest counts.
    """
    counts = windowed_counts(events, key, lateness=lateness)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")

    query = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(store).start()
    query.awaitTermination()
    return query


def read_spikes(spark: SparkSession, out: str, **limits: float) -> DataFrame:
    """The stored windows, each with its last count, against the window before."""
    stored = spark.read.parquet(out)
    return spikes(stored.groupBy("cle", "w").agg(F.max_by("n", "batch").alias("n")), **limits)


def _judged(rows: DataFrame, warn: float, critical: float) -> DataFrame:
    """Rows (cle, debut, n, previous) whose change is an alert."""
    change = change_pct(F.col("n"), F.col("previous"))
    level = F.when(change > critical, "CRITICAL").when(change > warn, "WARNING")
    judged = rows.select("cle", "debut", "n", "previous", F.round(change, 2).alias("change_pct"), level.alias("level"))
    return judged.filter(F.col("level").isNotNull())


def day_pairs(counts: DataFrame) -> DataFrame:
    """Each day (cle, debut) that has rows, or whose day before has, with its count and that of the day before; an empty day counts 0.

    Every day's count falls into two overlapping windows of two days, as their second day and as their first.
    """
    days = counts.select("cle", "n", F.col("w.start").alias("day"), F.window(F.window_time("w"), "2 days", "1 day").alias("pair"))
    pairs = days.groupBy("pair", "cle").agg(F.sum("n").alias("both"), F.max("day").alias("day"), F.max_by("n", "day").alias("last"))
    begin = F.col("pair.start") + F.expr("INTERVAL 1 DAY")
    n = F.when(F.col("day") == begin, F.col("last")).otherwise(F.lit(0).cast("bigint"))
    return pairs.select("cle", begin.alias("debut"), n.alias("n"), (F.col("both") - n).alias("previous"))


def stream_alerts(events: DataFrame, key: str, out: str, checkpoint: str, at: str = "ts", lateness: str = "2 days", warn: float = 15,
                  critical: float = 30) -> Run:
    """Alerts while events arrive: each is stored once, when the watermark has closed its two days.

    Two chained aggregations in append mode: counts of a day, then windows of two days over their event time. The state
    holds the days and pairs of days that the watermark leaves open, for each key; what is closed is emitted and
    forgotten, and nothing that was stored is read again. Late rows are dropped, and counted in the result.
    """
    alerts = _judged(day_pairs(windowed_counts(events, key, at, "1 day", lateness)), warn, critical)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")

    writer = alerts.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return _run(writer.foreachBatch(store).start())


def batch_alerts(events: DataFrame, key: str, at: str = "ts", warn: float = 15, critical: float = 30) -> DataFrame:
    """X02 over a whole table: the alerts of all its days."""
    return _judged(day_pairs(windowed_counts(events, key, at)), warn, critical)
