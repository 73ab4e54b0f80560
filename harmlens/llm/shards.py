"""Sharding by extendible hashing, in DataFrame functions only.

The directory is indexed by the leading bits of a row's hash; several entries may point to one bucket. A
bucket splits on its next bit while it is over the byte limit, so a shard is the shortest prefix whose rows
fit. Sums for all prefix lengths come from one pass over the directory; the directory's depth follows from the
total size, and buckets still too large at that depth go on alone with more bits.

The first 32 bits hash id and text. The next 31 hash the row's position in the input, so that any number of
equal rows spreads over shards too. A single row larger than the limit is a shard of its own. Null ids and
texts count as empty strings. Every row gets one shard; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmlens.workspace import cut_lineage

BITS = 63


@dataclass(frozen=True)
class Settings:
    limit_bytes: int = 4 << 20
    spare_bits: int = 4  # directory depth beyond the average bucket's
    step_bits: int = 16  # further bits per round for buckets that are still too large


def hashed(docs: DataFrame) -> DataFrame:
    """doc_id, bytes and hash bits of each row, most significant first."""
    text = F.coalesce("text", F.lit(""))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    content = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("bigint")
    place = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 33)
    return docs.select("doc_id", F.octet_length(text).cast("bigint").alias("bytes"), (F.shiftleft(content, 31) + place).alias("h"))


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned(F.col("h"), BITS - depth)


def _directory(rows: DataFrame, low: int, depth: int, limit: int) -> DataFrame:
    """The bucket of each directory entry: depth, node, rows and bytes; null where none fits yet.

    Prefixes up to length ``low`` are known to be too large.
    """
    entries = rows.groupBy(_prefix(depth).alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    entries = cut_lineage(entries)
    paths = entries.withColumn("depth", F.explode(F.sequence(F.lit(low + 1), F.lit(depth)))).withColumn(
        "node", F.expr(f"shiftrightunsigned(prefix, {depth} - depth)")
    )
    nodes = paths.groupBy("depth", "node").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    fits = nodes.filter((F.col("bytes") <= limit) | (F.col("rows") == 1) | (F.lit(depth) == BITS) & (F.col("depth") == depth))
    first = paths.select("prefix", "depth", "node").join(fits, ["depth", "node"]).groupBy("prefix").agg(
        F.min(F.struct("depth", "node", "bytes", "rows")).alias("b")
    )
    return entries.select("prefix").join(first, "prefix", "left").select("prefix", "b.*")


def sharded(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, bytes, shard (its prefix as bits), depth, shard_rows and shard_bytes."""
    rows = cut_lineage(hashed(docs))
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    depth = min(BITS, max(0, math.ceil(math.log2(max(1.0, total / settings.limit_bytes)))) + settings.spare_bits)
    low, parts = -1, []
    while True:
        directory = cut_lineage(_directory(rows, low, depth, settings.limit_bytes))
        placed = rows.withColumn("prefix", _prefix(depth)).join(directory.withColumnRenamed("bytes", "shard_bytes"), "prefix")
        bits = F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.conv("node", 10, 2), F.col("depth"), "0"))
        parts.append(placed.filter("depth is not null").select("doc_id", "bytes", bits.alias("shard"), "depth", F.col("rows").alias("shard_rows"), "shard_bytes"))
        if directory.filter("depth is null").isEmpty():
            return reduce(DataFrame.unionByName, parts)
        rows = cut_lineage(placed.filter("depth is null").select("doc_id", "bytes", "h"))
        low, depth = depth, min(BITS, depth + settings.step_bits)
