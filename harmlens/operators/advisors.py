"""Severity bands, projections, remedies, audits and positioning per sector code."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harmlens.functions import dims
from harmlens.functions.exprs import at_most, present, ratio, row_count, truncate
from harmlens.operators.aggregates import sector_severity
from harmlens.operators.windows import first_k

# Sectors counted as hazardous by nature, and the price of one incident.
HAZARDOUS_SECTORS = ("23", "21", "221122")
INCIDENT_COST, INCIDENTS_PER_YEAR = 50000, 10


def case_totals(cnesst: DataFrame) -> DataFrame:
    return cnesst.groupBy(F.col("scian").alias("sector")).agg(
        F.coalesce(F.sum("nombre_lesions"), F.lit(0)).alias("cases"), F.coalesce(F.sum("jours_perdus"), F.lit(0)).alias("days"))


def compare_jurisdictions(cnesst: DataFrame, osha: DataFrame) -> DataFrame:
    """Both sides summed per sector, matched through the crosswalk; a side without rows is 0."""
    spark = cnesst.sparkSession
    cross = F.broadcast(dims.frame(spark, dims.SCIAN_NAICS).withColumnRenamed("scian", "__scian"))
    own = case_totals(cnesst).join(cross, F.col("sector") == F.col("__scian"), "left").select(
        "sector", F.coalesce("naics", "sector").alias("naics"), F.col("cases").alias("qc_cases"), F.col("days").alias("qc_days"))
    us = osha.groupBy(F.col("naics").alias("__naics")).agg(
        F.sum("total_cases").alias("us_cases"), F.sum("total_deaths").alias("us_deaths"), F.sum("days_away").alias("us_days"))
    joined = own.join(us, F.col("naics") == F.col("__naics"), "full")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    sides = joined.select(F.coalesce("sector", "__naics").alias("sector"),
                          *[zero(c) for c in ("qc_cases", "qc_days", "us_cases", "us_deaths", "us_days")])
    return sides.withColumn("ratio_usa_qc", ratio(F.col("us_cases"), F.greatest(F.lit(1), F.col("qc_cases"))))


def severity_risk(totals: DataFrame) -> DataFrame:
    """level and score by volume or days per case, with the factors behind them."""
    cases = F.col("cases")
    rows = totals.withColumn("sev", F.col("days") / F.greatest(F.lit(1), cases))
    sev = F.col("sev")
    bands = (("CRITICAL", (cases > 50000) | (sev > 8), 90 + at_most(sev, 10)),
             ("HIGH", (cases > 20000) | (sev > 6), 70 + at_most(sev * 2, 20)),
             ("MEDIUM", (cases > 5000) | (sev > 4), 40 + at_most(sev * 3, 30)))
    level = score = F
    for name, hit, value in bands:
        level, score = level.when(hit, F.lit(name)), score.when(hit, value)
    factors = present(F.when(sev > 6, "High severity per incident"), F.when(cases > 10000, "High incident volume"),
                      F.when(F.col("sector").isin(*HAZARDOUS_SECTORS), "Inherently hazardous industry"))
    return rows.select("sector", "cases", "days", level.otherwise("LOW").alias("risk_level"),
                       F.round(score.otherwise(10 + at_most(sev * 4, 30)), 2).alias("score"),
                       F.when(F.size(factors) > 0, factors).otherwise(F.array(F.lit("Standard risk profile"))).alias("factors"))


def patterns(totals: DataFrame) -> DataFrame:
    """severity flag and dominant risk per sector."""
    return totals.select("sector", "cases", "days",
                         ((F.col("cases") > 0) & (F.col("days") > F.col("cases") * 7)).alias("high_severity"),
                         F.when(F.col("cases") > 10000, "TMS").otherwise("Chutes").alias("dominant_risk"))


def row_anomalies(cnesst: DataFrame, threshold: float = 15) -> DataFrame:
    """case rows with more than ``threshold`` days per case."""
    return cnesst.filter(F.try_divide("jours_perdus", "nombre_lesions") > threshold)


def first_anomalies(cnesst: DataFrame, order: list[str], k: int = 5, threshold: float = 15) -> DataFrame:
    """The first k anomalous rows in a stated order."""
    return first_k(row_anomalies(cnesst, threshold), order, k)


def projection(pair: DataFrame) -> DataFrame:
    """six months ahead from the two latest values of a series."""
    change = (F.col("recent") - F.col("previous")) / F.greatest(F.lit(1), F.col("previous")) * 100
    return pair.withColumn("__c", change).select(
        *pair.columns, F.when(F.col("__c") > 5, "increasing").when(F.col("__c") < -5, "decreasing").otherwise("stable").alias("trend"),
        F.round("__c", 2).alias("change_pct"), truncate(F.col("recent") * (1 + F.col("__c") / 200)).alias("projected_cases_6m"))


def sector_risks(sectors: DataFrame) -> DataFrame:
    """Each sector's dominant risks, the default pair for sectors without their own."""
    spark = sectors.sparkSession
    listed = dims.frame(spark, dims.SECTOR_RISK).groupBy(F.col("sector").alias("__sector")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("risk_ord", "risk_type"))), lambda r: r["risk_type"]).alias("risks"))
    default = F.array(*[F.lit(r) for r in dims.DEFAULT_SECTOR_RISKS])
    matched = sectors.join(F.broadcast(listed), F.col("sector") == F.col("__sector"), "left")
    return matched.select("sector", F.posexplode(F.coalesce("risks", default)).alias("risk_ord", "risk_type"))


def remedies(sectors: DataFrame) -> DataFrame:
    """Every solution for each sector's risks, ranked by return on investment."""
    solutions = dims.frame(sectors.sparkSession, dims.SOLUTION).withColumnRenamed("risk_type", "__risk")
    gain = F.col("efficacite") * INCIDENTS_PER_YEAR * INCIDENT_COST
    rows = sector_risks(sectors).join(F.broadcast(solutions), F.col("risk_type") == F.col("__risk")).withColumn(
        "roi", truncate((gain - F.col("cout")) / F.greatest(F.lit(1), F.col("cout")) * 100))
    window = Window.partitionBy("sector").orderBy(F.col("roi").desc(), "risk_ord", "ord")
    return rows.select("sector", "risk_ord", "ord", "risk_type", "id", "solution", "efficacite", "cout", "roi",
                       F.row_number().over(window).alias("rank"))


def remedy_plan(ranked: DataFrame, k: int = 5, lead: int = 3) -> DataFrame:
    """The top k solutions, their cost, and the mean efficacy of the leading ones."""
    top = ranked.filter(F.col("rank") <= k)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "id", "roi")))
    return top.groupBy("sector").agg(
        F.transform(ordered, lambda s: s["id"]).alias("solutions"), F.max(F.when(F.col("rank") == 1, F.col("roi"))).alias("best_roi"),
        F.sum("cout").alias("total_investment"),
        F.round(F.sum(F.when(F.col("rank") <= lead, F.col("efficacite"))) / lead * 100, 1).alias("expected_reduction"))


def applicable_regulations(sectors: DataFrame) -> DataFrame:
    """Regulations listing the sector or '*', as an equality join on two keys per sector."""
    rules = dims.frame(sectors.sparkSession, dims.REGULATION).withColumnRenamed("sector", "__for")
    keyed = sectors.select("sector", F.explode(F.array(F.col("sector"), F.lit("*"))).alias("__key"))
    return keyed.join(F.broadcast(rules), F.col("__key") == F.col("__for")).select("sector", "source", "code", "titre").distinct()


def audit(sectors: DataFrame, statuses: DataFrame) -> DataFrame:
    """compliance score per sector; ``statuses(sector, code, status)`` is an input, unlisted means compliant."""
    open_items = statuses.filter(F.col("status") == "A VERIFIER").select(
        F.col("sector").alias("__s"), F.col("code").alias("__c")).distinct()
    checked = applicable_regulations(sectors).join(open_items, (F.col("sector") == F.col("__s")) & (F.col("code") == F.col("__c")), "left")
    scored = checked.groupBy("sector").agg(row_count().alias("regulations_checked"), F.count("__c").alias("non_conformites"))
    kept = F.col("regulations_checked") - F.col("non_conformites")
    return scored.withColumn("score_conformite", ratio(kept, F.greatest(F.lit(1), F.col("regulations_checked")), 100, 1))


def positioning(cnesst: DataFrame) -> DataFrame:
    """F32: percentile band and rank text from the mean of the rows' days per case."""
    g = F.col("gravite_moyenne")
    rows = sector_severity(cnesst).withColumn("percentile", F.when(g < 4, 75).when(g < 6, 50).when(g < 8, 30).otherwise(15))
    p = F.col("percentile")
    return rows.select(F.col("scian").alias("sector"), "gravite_moyenne", "percentile",
                       F.when(p > 50, F.format_string("Top %d%%", 100 - p)).otherwise(F.format_string("Bottom %d%%", p)).alias("rank"))


def peer_rank(severity: DataFrame) -> DataFrame:
    """The share of peer sectors that do worse.

    ``severity`` holds one row per code of the sector classification, a bounded
    list, which is what makes the single ordered window affordable.
    """
    window = Window.orderBy(F.col("gravite_moyenne").desc())
    return severity.select("scian", "gravite_moyenne", F.round(F.percent_rank().over(window) * 100, 1).alias("better_than_pct"))


def advice_board(cnesst: DataFrame, statuses: DataFrame) -> DataFrame:
    """the first recommendation of each of the five analyses, per sector."""
    totals = case_totals(cnesst)
    risk = severity_risk(totals)
    sectors = totals.select("sector")
    plan = remedies(sectors).filter("rank = 1")
    row = lambda df, name, text: df.select("sector", F.lit(name).alias("analyse"), text.alias("recommandation"))
    flagged = patterns(totals).filter("high_severity")
    parts = [
        row(flagged, "analyse", F.concat(F.lit("ALERTE: Gravite elevee detectee dans secteur "), F.col("sector"))),
        row(risk.filter(F.col("risk_level") != "LOW"), "prediction",
            F.when(F.col("risk_level") == "CRITICAL", "ACTION IMMEDIATE: Audit de securite requis")
            .when(F.col("risk_level") == "HIGH", "Planifier revue des procedures dans 60 jours").otherwise("Maintenir surveillance standard")),
        row(plan, "recommandation", F.concat(F.lit("Top solution: "), "solution", F.lit(" (ROI: "), F.col("roi").cast("string"), F.lit("%)"))),
        row(audit(sectors, statuses), "conformite",
            F.when(F.col("non_conformites") > 0, F.concat(F.lit("ATTENTION: "), F.col("non_conformites").cast("string"), F.lit(" element(s) a verifier")))
            .when(F.col("score_conformite") < 80, "Score critique - plan d'action immediat requis")
            .otherwise("Maintenir veille reglementaire trimestrielle")),
        row(positioning(cnesst), "benchmarking",
            F.when(F.col("percentile") > 75, "Performance superieure a 75% des secteurs")
            .when(F.col("percentile") < 25, "Performance dans le quartile inferieur").otherwise("Performance dans la moyenne sectorielle")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def sector_digest(cnesst: DataFrame, osha: DataFrame) -> DataFrame:
    """each sector's record count, comparison and prediction, beside the combined total."""
    combined = osha.agg(F.coalesce(F.sum("total_cases"), F.lit(0))).scalar() + cnesst.agg(F.coalesce(F.sum("nombre_lesions"), F.lit(0))).scalar()
    counts = cnesst.groupBy(F.col("scian").alias("sector")).agg(row_count().alias("records"))
    compared = compare_jurisdictions(cnesst, osha).select("sector", "ratio_usa_qc")
    predicted = severity_risk(case_totals(cnesst)).select("sector", "risk_level", "score")
    return counts.join(compared, "sector").join(predicted, "sector").withColumn("combined_incidents", combined)
