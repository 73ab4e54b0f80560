"""A14 and A15 as SQL table functions, for one sector or, with ``LATERAL``, for many at once.

    SELECT p.* FROM wanted w, LATERAL get_sector_risk_profile(w.sector) p

A function's body filters a view that holds every sector, so ``LATERAL`` becomes an equality join with one
aggregate: the sectors asked for never cost a pass each. A sector or indicator that does not occur gives no row;
``LEFT JOIN LATERAL`` keeps it with nulls. A null sector matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harmlens.functions.exprs import BENCHMARK_FLAGS, FLAGS, flag_count, percent, row_count
from harmlens.operators.aggregates import ABOVE, BELOW, VOLUME_STEPS, WITHIN, volume_level

PROFILE_FUNCTION, COMPARE_FUNCTION = "get_sector_risk_profile", "compare_to_provincial_avg"
TOP = {"nature_lesion": "top_nature", "siege_lesion": "top_siege", "agent_causal_lesion": "top_agent"}

def _over_all(measure: str) -> Column:
    """A total beside each sector; one row per sector reaches this window, never the input's rows."""
    return F.sum(measure).over(Window.partitionBy())


def sector_profiles(lesions: DataFrame, steps=VOLUME_STEPS) -> DataFrame:
    """A14 for all sectors from one scan: counts, shares and the most frequent value of three columns.

    Values are counted before sectors, so a sector with a third of all rows is combined map-side. Every row
    stands once under each column: the first column's counts are the sector's. Ties go to the smallest value, null first.
    """
    first = next(iter(TOP))
    values = F.inline(F.array(*[F.struct(F.lit(c).alias("colonne"), F.col(c).alias("valeur")) for c in TOP]))
    measures = {"n": row_count(), "tms": flag_count("tms"), "psy": flag_count("psy")}
    cells = lesions.select("secteur_scian", FLAGS["tms"], FLAGS["psy"], values).groupBy("secteur_scian", "colonne", "valeur").agg(
        *[measure.alias(name) for name, measure in measures.items()])
    rank = F.struct((-F.col("n")).alias("rank"), "valeur")
    sectors = cells.groupBy("secteur_scian").agg(
        *[F.sum(F.when(F.col("colonne") == first, F.col(name))).alias(name) for name in measures],
        *[F.min(F.when(F.col("colonne") == column, rank))["valeur"].alias(label) for column, label in TOP.items()])
    return sectors.withColumn("total", _over_all("n")).select(
        F.col("secteur_scian").alias("secteur"), F.col("n").alias("total_lesions"), percent("n", "total").alias("pct_total"),
        percent("tms", "n").alias("risk_tms"), percent("psy", "n").alias("risk_psy"), volume_level(F.col("n"), steps).alias("risk_level"),
        *TOP.values())


def provincial_comparison(lesions: DataFrame) -> DataFrame:
    """A15 for all sectors and indicators from one scan; status at 20 % either side of the whole."""
    counted = lesions.groupBy("secteur_scian").agg(row_count().alias("n"), *[flag_count(f).alias(f) for f in BENCHMARK_FLAGS])
    whole = counted.withColumns({f"all_{c}": _over_all(c) for c in ("n", *BENCHMARK_FLAGS)})
    rates = F.inline(F.array(*[F.struct(F.lit(f.upper()).alias("indicateur"), percent(f, "n").alias("taux_secteur"),
                                        percent(f"all_{f}", "all_n").alias("taux_provincial")) for f in BENCHMARK_FLAGS]))
    rate, province = F.col("taux_secteur"), F.col("taux_provincial")
    return whole.select(F.col("secteur_scian").alias("secteur"), rates).select(
        "*", F.round(rate - province, 2).alias("ecart"),
        F.when(rate > province * 1.2, ABOVE).when(rate < province * 0.8, BELOW).otherwise(WITHIN).alias("statut"))


def register_functions(lesions: DataFrame, steps=VOLUME_STEPS, prefix: str = "") -> None:
    """Make both functions callable from SQL in the session of ``lesions``; registered again, they read the new frame."""
    spark = lesions.sparkSession
    sector_profiles(lesions, steps).createOrReplaceTempView(f"{prefix}sector_profiles")
    provincial_comparison(lesions).createOrReplaceTempView(f"{prefix}provincial_comparison")
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{PROFILE_FUNCTION}(p_secteur STRING)
RETURNS TABLE (secteur STRING, total_lesions BIGINT, pct_total DOUBLE, risk_tms DOUBLE, risk_psy DOUBLE, risk_level STRING,
  top_nature STRING, top_siege STRING, top_agent STRING)
RETURN SELECT secteur, total_lesions, pct_total, risk_tms, risk_psy, risk_level, top_nature, top_siege, top_agent
  FROM {prefix}sector_profiles WHERE secteur = p_secteur""")
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{COMPARE_FUNCTION}(p_secteur STRING, p_indicateur STRING)
RETURNS TABLE (secteur STRING, taux_secteur DOUBLE, taux_provincial DOUBLE, ecart DOUBLE, statut STRING)
RETURN SELECT secteur, taux_secteur, taux_provincial, ecart, statut
  FROM {prefix}provincial_comparison WHERE secteur = p_secteur AND indicateur = p_indicateur""")
