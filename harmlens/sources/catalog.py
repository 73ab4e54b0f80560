"""Source registry: selection and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harmlens.functions import dims

# Key words that override the type, in test order, then types.
KEY_ROUTES = (("osha", "osha"), ("bls", "bls"), ("eurostat", "eurostat"), ("ilostat", "ilostat"), ("dares", "dares"))
TYPE_ROUTES = (("kaggle", "kaggle"), ("api", "osha"), ("sdmx", "eurostat"), ("file", "dares"))


def registered(spark: SparkSession) -> DataFrame:
    return dims.frame(spark, dims.SOURCE)


def run_order(sources: DataFrame, max_priority: int) -> DataFrame:
    """Enabled sources up to a priority, by priority and then registration order."""
    return sources.filter(F.col("enabled") & (F.col("priority") <= max_priority)).orderBy("priority", "ord")


def connector(key: Column, kind: Column) -> Column:
    """Key words first, then the source type. The rule sends some sources to an
    unrelated connector; it is kept as data, and production routes by an explicit column."""
    low = F.lower(key)
    out = F
    for word, name in KEY_ROUTES:
        out = out.when(low.contains(word), F.lit(name))
    for name, route in TYPE_ROUTES:
        out = out.when(kind == name, F.lit(route))
    return out.otherwise("base")
