"""Shared scratch space and lineage cuts.

Both use the folder named by ``spark.checkpoint.dir``, which every executor can
reach, so that a lost executor never takes the only copy of a result with it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_SCRATCH: dict[str, list[str]] = {}  # by application
#: Spark's estimate for a frame of unknown size.
UNKNOWN_SIZE = 2**63 - 1


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a private one only in local mode."""
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="harmlens-")
    spark.conf.set(CHECKPOINT_SETTING, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses; ``clear_scratch`` removes it."""
    path = f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders of this application, at the end of a job; the number of folders that were there.

    Checkpoints go with ``spark.cleaner.referenceTracking.cleanCheckpoints``, once nothing refers to them.
    """
    removed = 0
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        removed += place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return removed


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` reliably, so that loops grow neither the plan nor the estimate of its size.

    Spark estimates a join by the product of its sides, and a checkpoint keeps that number: in a loop of joins its digits
    double with every pass, until the number alone fills the driver. What is beyond any size is stated as unknown.
    """
    spark = df.sparkSession
    root = shared_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    cut = df.checkpoint(eager=True)
    plan = cut._jdf.queryExecution().logical()
    if plan.stats().sizeInBytes() <= UNKNOWN_SIZE:
        return cut
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(plan.rdd(), plan.schema(), False), spark)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` read back from compressed Parquet in the shared folder: for large frames, whose checkpoint is many times the size."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
