"""Forecasts, cross-tabs, anomalies, costs and demographics per sector."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harmlens.functions.exprs import change_pct, percent, present, ratio, row_count, truncate
from harmlens.operators.aggregates import counts_by
from harmlens.operators.enrichment import DOWN, UP, YEARLY_FLAGS, join_sector, sector_sums
from harmlens.operators.windows import share_of_total, top_n_by, yoy
from harmlens.workspace import cut_lineage

# Cost tariffs.
COST_TMS, COST_PSY, COST_OTHER = 12000, 25000, 8500
DAYS_PER_LESION, COST_PER_DAY, YEARS_COVERED = 45, 350, 7
# Forecast advice by total change.
ADVICE = (
    (20, "⚠️ ALERTE: Secteur en forte croissance de risque. Audit complet recommandé."),
    (10, "⚡ ATTENTION: Tendance à la hausse. Renforcer les mesures préventives."),
)
ADVICE_DOWN = "✅ POSITIF: Amélioration continue. Maintenir les bonnes pratiques."
ADVICE_FLAT = "➡️ STABLE: Surveiller les indicateurs. Prévention continue."


def fit_lines(years: DataFrame, key: str = "secteur_scian", year: str = "annee", n: str = "n") -> DataFrame:
    """Least-squares line through each key's yearly counts, from integer sums.

    The sums combine map-side, and integers make the slope the same in any order.
    """
    x, y = F.col(year).cast("bigint"), F.col(n).cast("bigint")
    sums = years.groupBy(key).agg(
        row_count().alias("k"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * y).alias("sxy"),
        F.sum(x * x).alias("sxx"), F.max(year).alias("last_year"), F.min_by(n, year).alias("first_n"),
        F.max_by(n, year).alias("last_n"))
    slope = (F.col("k") * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.col("k") * F.col("sxx") - F.col("sx") * F.col("sx"))
    return sums.filter(F.col("k") >= 3).withColumn("slope", slope).withColumn(
        "intercept", (F.col("sy") - F.col("slope") * F.col("sx")) / F.col("k"))


def forecast(years: DataFrame, years_ahead: int = 2) -> DataFrame:
    """predicted counts for the coming years; keys with under three years have none."""
    change = change_pct(F.col("last_n"), F.col("first_n"))
    lines = fit_lines(years).withColumn("__change", change)
    ahead = lines.withColumn("annee", F.explode(F.sequence(F.col("last_year") + 1, F.col("last_year") + years_ahead)))
    advice = F.when(F.col("__change") > ADVICE[0][0], ADVICE[0][1]).when(F.col("__change") > ADVICE[1][0], ADVICE[1][1]).when(
        F.col("__change") < -10, ADVICE_DOWN).otherwise(ADVICE_FLAT)
    return ahead.select(
        "secteur_scian", "annee",
        F.greatest(F.lit(0).cast("bigint"), truncate(F.col("slope") * F.col("annee") + F.col("intercept"))).alias("prediction"),
        F.when(F.col("slope") > 0, UP).otherwise(DOWN).alias("direction"),
        F.round("slope", 1).alias("pente_annuelle"), F.round("__change", 1).alias("variation_totale_pct"),
        F.when(F.col("k") >= 5, "MOYENNE").otherwise("FAIBLE").alias("confiance"), advice.alias("recommandation"))


COHORT = ["secteur_scian", "groupe_age", "sexe_pers_phys"]


def cohorts(lesions: DataFrame) -> DataFrame:
    """Counts per (sector, age group, sex): small, and enough for every demographic table.

    The tables below checkpoint it and read it several times.
    """
    return counts_by(lesions, COHORT, ["tms", "psy"])


def cross_tabs(lesions: DataFrame, k: int = 10) -> DataFrame:
    """age by TMS rate, sex by PSY rate and the top agent-site pairs, stacked."""
    pairs = counts_by(lesions, ["secteur_scian", "agent_causal_lesion", "siege_lesion"]).withColumn(
        "pair", F.struct("agent_causal_lesion", "siege_lesion"))
    top = top_n_by(pairs, ["secteur_scian"], "pair", k)
    return rate_tabs(cut_lineage(cohorts(lesions))).unionByName(top.select(
        "secteur_scian", F.lit("agent_siege").alias("tableau"), F.col("agent_causal_lesion").alias("a"),
        F.col("siege_lesion").alias("b"), F.col("n").alias("total"), F.lit(None).cast("double").alias("taux")))


def rate_tabs(cohort: DataFrame) -> DataFrame:
    age = cohort.groupBy("secteur_scian", F.col("groupe_age").alias("a")).agg(F.sum("n").alias("n"), F.sum("tms").alias("hits"))
    sex = cohort.groupBy("secteur_scian", F.col("sexe_pers_phys").alias("a")).agg(F.sum("n").alias("n"), F.sum("psy").alias("hits"))

    def rated(df, kind):
        return df.select("secteur_scian", F.lit(kind).alias("tableau"), "a", F.lit(None).cast("string").alias("b"),
                         F.col("n").alias("total"), percent("hits", "n").alias("taux"))

    return rated(age, "age_tms").unionByName(rated(sex, "sexe_psy"))


def cross_tab_insights(tabs: DataFrame) -> DataFrame:
    """the age group with the highest TMS rate, and each sex above 5 % PSY."""
    age = tabs.filter(F.col("tableau") == "age_tms").groupBy("secteur_scian").agg(
        F.min(F.struct((-F.col("taux")).alias("rank"), "a", "taux")).alias("best"))
    first = age.select("secteur_scian", F.lit("AGE_TMS").alias("type"), F.concat(
        F.lit("Groupe d'âge le plus touché par TMS: "), F.col("best.a"), F.lit(" ("), F.col("best.taux").cast("string"),
        F.lit("%)")).alias("finding"), F.lit("Cibler les formations ergonomiques sur ce groupe").alias("action"))
    sex = tabs.filter((F.col("tableau") == "sexe_psy") & (F.col("taux") > 5)).select(
        "secteur_scian", F.lit("SEXE_PSY").alias("type"),
        F.concat(F.col("a"), F.lit(": "), F.col("taux").cast("string"), F.lit("% de lésions psychologiques")).alias("finding"),
        F.lit("Programme de soutien psychologique recommandé").alias("action"))
    return first.unionByName(sex)


def anomalies(years: DataFrame, beyond: float = 30) -> DataFrame:
    """yearly change per sector; beyond 30 % either way is an anomaly with a presumed cause."""
    changes = yoy(years.select("secteur_scian", "annee", "n"), ["secteur_scian"], "annee", "n")
    strange = F.abs("variation_pct") > beyond
    return changes.filter(F.col("previous").isNotNull()).select(
        "secteur_scian", "annee", F.col("n").alias("total"), "variation_pct", strange.alias("anomalie"),
        F.when(strange, F.when(F.col("annee").isin(2020, 2022), "COVID-19").otherwise("À investiguer")).alias("explication"))


def costs(sums: DataFrame) -> DataFrame:
    """claim and productivity costs from sector totals."""
    other = F.col("n") - F.col("tms") - F.col("psy")
    cost = F.col("tms") * COST_TMS + F.col("psy") * COST_PSY + other * COST_OTHER
    days = F.col("n") * DAYS_PER_LESION
    return sums.select(
        "secteur_scian", F.col("n").alias("total"), "tms", "psy", other.alias("autres"), cost.alias("cout_total"),
        F.round(cost / YEARS_COVERED, 0).cast("bigint").alias("cout_annuel_moyen"),
        F.round(F.try_divide(cost, F.col("n")), 0).cast("bigint").alias("cout_par_lesion"),
        days.alias("jours_perdus_estimes"), (days * COST_PER_DAY).alias("cout_productivite"),
        (cost + days * COST_PER_DAY).alias("impact_total"))


def demographic_profile(lesions: DataFrame, k: int = 10) -> DataFrame:
    """age shares, sex shares and the largest age-sex cells, stacked; cells above 30 % TMS are marked."""
    return demographics_of(cut_lineage(cohorts(lesions)), k)


def demographics_of(cohort: DataFrame, k: int = 10) -> DataFrame:

    def shares(column, kind):
        counted = cohort.groupBy("secteur_scian", F.col(column).alias("a")).agg(F.sum("n").alias("n"))
        return share_of_total(counted, ["secteur_scian"]).select(
            "secteur_scian", F.lit(kind).alias("tableau"), "a", F.lit(None).cast("string").alias("b"),
            F.col("n").alias("total"), "pct", F.lit(None).cast("boolean").alias("risque_eleve"))

    cells = top_n_by(cohort.withColumn("cell", F.struct("groupe_age", "sexe_pers_phys")), ["secteur_scian"], "cell", k)
    crossed = cells.select(
        "secteur_scian", F.lit("age_sexe").alias("tableau"), F.col("groupe_age").alias("a"), F.col("sexe_pers_phys").alias("b"),
        F.col("n").alias("total"), ratio("tms", "n", 100, 1).alias("pct"),
        (F.col("tms") * 100 > F.col("n") * 30).alias("risque_eleve"))
    return shares("groupe_age", "age").unionByName(shares("sexe_pers_phys", "sexe")).unionByName(crossed)


def demographic_advice(profile: DataFrame) -> DataFrame:
    """the leading age group, then up to three marked cells, as ordered texts."""
    age = profile.filter(F.col("tableau") == "age").groupBy("secteur_scian").agg(
        F.min(F.struct((-F.col("total")).alias("rank"), "a", "pct")).alias("best"))
    window = Window.partitionBy("secteur_scian").orderBy(F.col("total").desc(), "a", "b")
    cells = profile.filter("risque_eleve").withColumn("__r", F.row_number().over(window)).filter(F.col("__r") <= 3)
    cell_text = F.concat(F.lit("⚠️ Population à risque: "), "b", F.lit(" - "), "a", F.lit(" - TMS à "),
                         F.col("pct").cast("string"), F.lit("%"))
    marked = cells.groupBy("secteur_scian").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__r", cell_text.alias("texte")))), lambda c: c["texte"]).alias("cells"))
    lead = F.concat(F.lit("🎯 Groupe d'âge prioritaire: "), F.col("best.a"), F.lit(" ("), F.col("best.pct").cast("string"),
                    F.lit("% des lésions)"))
    return join_sector(age, marked).select("secteur_scian", F.concat(
        present(lead), F.coalesce("cells", F.array().cast("array<string>"))).alias("recommandations"))


def executive_report(lesions: DataFrame) -> DataFrame:
    """F16: forecast, costs and advice of each sector on one row, with the whole as JSON.

    One scan builds a small (sector, year, age, sex) cube; every section rolls it up.
    """
    cube = cut_lineage(counts_by(lesions, [*COHORT, "annee"], YEARLY_FLAGS))
    measures = [F.sum(c).alias(c) for c in ("n", *YEARLY_FLAGS)]
    years = cube.groupBy("secteur_scian", "annee").agg(*measures)
    cohort = cube.groupBy(*COHORT).agg(*measures)
    predicted = forecast(years).groupBy("secteur_scian").agg(
        F.max("direction").alias("niveau_risque"), F.max("variation_totale_pct").alias("variation"),
        F.max("recommandation").alias("action_1"),
        F.array_sort(F.collect_list(F.struct("annee", "prediction"))).alias("predictions"))
    cost = costs(sector_sums(years))
    yearly = anomalies(years).groupBy("secteur_scian").agg(
        F.count_if("anomalie").alias("nb_anomalies"),
        F.array_sort(F.collect_list(F.struct("annee", "variation_pct", "anomalie"))).alias("variations_yoy"))
    people = demographic_advice(demographics_of(cohort))
    insights = cross_tab_insights(rate_tabs(cohort)).groupBy("secteur_scian").agg(
        F.array_sort(F.collect_list("finding")).alias("constats"))
    out = cost
    for side in (predicted, yearly, people, insights):
        out = join_sector(out, side)
    impact = F.concat(F.lit("$"), F.format_number("impact_total", 0))
    tendency = F.format_string("%+.1f%%", F.coalesce("variation", F.lit(0.0)))
    actions = F.array(F.coalesce("action_1", F.lit("")), F.lit("Programme ergonomique TMS"),
                      F.lit("Formation ciblée par groupe d'âge"))
    return out.select(
        "secteur_scian", F.coalesce("niveau_risque", F.lit("N/A")).alias("niveau_risque"),
        impact.alias("impact_economique_7_ans"), tendency.alias("tendance"), F.array_join(actions, " | ").alias("actions"),
        F.coalesce("nb_anomalies", F.lit(0)).alias("nb_anomalies"),
        F.to_json(F.struct("secteur_scian", "predictions", "cout_total", "impact_total", "variations_yoy",
                           "recommandations", "constats")).alias("rapport"))
