"""Folds and bounded training samples from the ``labels`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id) % folds


def is_fold(doc_id: str, folds: int, which: int) -> Column:
    return F.coalesce(fold(doc_id, folds) == which, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, target: str, folds: int, held: int, per_class: int, max_bytes: int) -> list[tuple[str, int]]:
    """Whole labelled texts of each class, never from the held-out fold, by hash order of the id.

    At most ``per_class`` of a class, and ``max_bytes`` in all of them: the bounds make the collected list independent of
    the table sizes. A text that would go beyond the bytes, or alone takes a tenth of them, is left out; no text is cut.
    Null labels are skipped; a document with several labels takes the larger, an id with several texts the largest.
    """
    usable = labels.select(F.col("doc_id").alias("id"), F.col(target).alias("y")).filter(
        "id is not null and y in (0, 1)"
    )
    usable = usable.filter(~is_fold("id", folds, held)).groupBy("id").agg(F.max("y").alias("y"))
    order = F.xxhash64("id")
    picked = None
    for value in (0, 1):
        some = usable.filter(F.col("y") == value).orderBy(order, "id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    whole = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("t")).filter(F.octet_length("t") <= max_bytes // 10)
    found = whole.join(F.broadcast(picked), "id").groupBy("id", "y").agg(F.max("t").alias("t"))  # 2 * per_class rows at most
    so_far = F.sum(F.octet_length("t")).over(Window.partitionBy("y").orderBy(order, "id").rowsBetween(Window.unboundedPreceding, 0))
    kept = found.withColumn("bytes", so_far).filter(F.col("bytes") <= max_bytes).select("id", "y", "t").collect()
    return [(r["t"], int(r["y"])) for r in sorted(kept, key=lambda r: r["id"])]
