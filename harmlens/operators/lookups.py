"""Code lookups: exact, with fallback keys, and by shared prefix."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmlens.functions import dims
from harmlens.functions.dims import Dimension

KeyRule = Callable[[Column], Column]


def lookup(
    df: DataFrame,
    dim: Dimension,
    key: str,
    *,
    default: dict[str, object],
    fallbacks: Sequence[KeyRule] = (),
    dim_key: str = "code",
    prefix: str = "",
) -> DataFrame:
    """Left lookup of ``key`` in a literal dimension.

    The exact key is tried first, then each fallback key in turn; rows that
    match nothing get ``default``. Every attempt is a broadcast hash join on a
    literal relation, so the fact side never shuffles.
    """
    spark = df.sparkSession
    rules: list[KeyRule] = [lambda c: c, *fallbacks]
    attributes = [c for c in dim.columns if c != dim_key]
    out = df
    for i, rule in enumerate(rules):
        side = dims.frame(spark, dim).select(
            F.col(dim_key).alias(f"__k{i}"), F.struct(*attributes).alias(f"__hit{i}")
        )
        out = out.join(F.broadcast(side), rule(F.col(key)) == F.col(f"__k{i}"), "left").drop(f"__k{i}")
    hit = F.coalesce(*[F.col(f"__hit{i}") for i in range(len(rules))])
    found = [
        F.coalesce(hit[a], F.lit(default[a]) if a in default else F.lit(None)).alias(prefix + a)
        for a in attributes
    ]
    return out.select(*df.columns, *found)


def prefix_lookup(df: DataFrame, dim: Dimension, key: str, *, default: dict[str, Column], prefix: str = "") -> DataFrame:
    """First dimension row that shares a prefix with ``key``, either way round.

    An exact match wins; otherwise the row with the lowest ``ord`` whose code
    starts with the key or is a prefix of it. Both directions are turned into
    equality joins: the codes' own prefixes are listed on the literal side, and
    the key is cut to each code length on the fact side.
    """
    spark = df.sparkSession
    codes = dims.frame(spark, dim)
    lengths = sorted({len(row[dim.columns.index("code")]) for row in dim.rows})
    attributes = [c for c in dim.columns if c not in ("code", "ord")]

    exact = codes.select(F.col("code").alias("__e"), F.col("ord").alias("__exact"))
    starts = (
        codes.select("ord", F.explode(F.transform(F.sequence(F.lit(0), F.length("code")),
                                                  lambda n: F.substring(F.col("code"), F.lit(1), n))).alias("__p"))
        .groupBy("__p").agg(F.min("ord").alias("__starts"))
    )
    out = df.join(F.broadcast(exact), F.col(key) == F.col("__e"), "left")
    out = out.join(F.broadcast(starts), F.col(key) == F.col("__p"), "left")
    cuts = []
    for n in lengths:
        side = codes.filter(F.length("code") == n).select(F.col("code").alias(f"__c{n}"), F.col("ord").alias(f"__cut{n}"))
        out = out.join(F.broadcast(side), F.substring(F.col(key), 1, n) == F.col(f"__c{n}"), "left")
        cuts.append(F.col(f"__cut{n}"))
    first = F.coalesce(F.col("__exact"), F.least(F.col("__starts"), *cuts))
    rows = codes.select(F.col("ord").alias("__ord"), F.struct(*attributes).alias("__row"))
    out = out.withColumn("__first", first).join(F.broadcast(rows), F.col("__first") == F.col("__ord"), "left")
    found = [
        F.when(F.col("__row").isNotNull(), F.col("__row")[a])
        .otherwise(default.get(a, F.lit(None))).alias(prefix + a)
        for a in attributes
    ]
    return out.select(*df.columns, *found)


# Rows used when a code is unknown.
UNKNOWN_HAZARD = {"hazard_code": "AUTRE-99", "domain": "AUTRE", "label_fr": "Non classé", "label_en": "Unclassified"}
UNKNOWN_NATURE = {"nature_code": "NAT-99", "label_fr": "Non spécifié", "label_en": "Unspecified"}
UNKNOWN_PART = {"part_code": "BP-99", "label_fr": "Non spécifié", "label_en": "Unspecified"}


def _cut_if_longer(length: int, suffix: str = "") -> KeyRule:
    """The first ``length`` characters plus ``suffix``, for longer codes only."""
    return lambda c: F.when(F.length(c) > length, F.concat(F.substring(c, 1, length), F.lit(suffix)))


def osha_event(df: DataFrame, key: str = "event_type", prefix: str = "event_") -> DataFrame:
    """Exact code, then its two-digit parent."""
    return lookup(df, dims.OSHA_EVENT, key, default=UNKNOWN_HAZARD, fallbacks=[_cut_if_longer(2)], prefix=prefix)


def osha_nature(df: DataFrame, key: str = "nature", prefix: str = "nature_") -> DataFrame:
    """Exact code, then the first two digits followed by 1."""
    return lookup(df, dims.OSHA_NATURE, key, default=UNKNOWN_NATURE, fallbacks=[_cut_if_longer(2, "1")], prefix=prefix)


def osha_bodypart(df: DataFrame, key: str = "body_part", prefix: str = "part_") -> DataFrame:
    """Exact code, then its first digit."""
    return lookup(df, dims.OSHA_BODYPART, key, default=UNKNOWN_PART, fallbacks=[_cut_if_longer(1)], prefix=prefix)


def esaw_deviation(df: DataFrame, key: str = "deviation", prefix: str = "hazard_") -> DataFrame:
    """Exact code only."""
    return lookup(df, dims.ESAW_DEVIATION, key, default=UNKNOWN_HAZARD, prefix=prefix)


def cnesst_genre(df: DataFrame, key: str = "genre_accident", prefix: str = "hazard_") -> DataFrame:
    """Exact code only."""
    return lookup(df, dims.CNESST_GENRE, key, default=UNKNOWN_HAZARD, prefix=prefix)


def industry(df: DataFrame, key: str = "naics_code", prefix: str = "industry_") -> DataFrame:
    """Exact code, empty strings when unknown."""
    return lookup(df, dims.INDUSTRY, key, default={"nace": "", "isic": "", "label": ""}, prefix=prefix)


def unified_exact(df: DataFrame, source: str, key: str, prefix: str = "hazard_") -> DataFrame:
    """The stand-alone conversion, which never falls back to a parent code."""
    dim = {"osha": dims.OSHA_EVENT, "esaw": dims.ESAW_DEVIATION, "cnesst": dims.CNESST_GENRE}[source]
    return lookup(df, dim, key, default=UNKNOWN_HAZARD, prefix=prefix)


def sector_crosswalk(df: DataFrame, key: str = "scian", prefix: str = "sector_") -> DataFrame:
    """Exact sector, else the first one sharing a prefix, else UNKNOWN.

    An empty key is a prefix of every code and so takes the first row.
    """
    code = F.col(key)
    default = {"scian": code, "naics": code, "nace": F.lit("UNKNOWN"),
               "name_fr": F.lit("Non classé"), "name_en": F.lit("Unclassified"), "name_de": F.lit(None).cast("string")}
    return prefix_lookup(df, dims.SECTOR_CROSSWALK, key, default=default, prefix=prefix)


def _type_crosswalk(df: DataFrame, dim: Dimension, key: str, prefix: str) -> DataFrame:
    default = {"cnesst_name": "", "osha_code": "UNK", "osha_name": "", "esaw_code": "UNK", "esaw_name": ""}
    out = lookup(df, dim, key, default=default, prefix=prefix)
    return out.withColumn(prefix + "cnesst_code", F.coalesce(F.col(prefix + "cnesst_code"), F.col(key)))


def injury_crosswalk(df: DataFrame, key: str = "nature_lesion", prefix: str = "injury_") -> DataFrame:
    """H19, injury types."""
    return _type_crosswalk(df, dims.INJURY_CROSSWALK, key, prefix)


def cause_crosswalk(df: DataFrame, key: str = "genre_accident", prefix: str = "cause_") -> DataFrame:
    """H19, accident causes."""
    return _type_crosswalk(df, dims.CAUSE_CROSSWALK, key, prefix)
