"""Risk scores, alerts, training scenarios, cohorts and insurance quotes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmlens.functions.exprs import at_most, change_pct, clamp, contains_ci, percent, present, ratio, row_count, truncate
from harmlens.operators.aggregates import counts_by
from harmlens.operators.enrichment import join_sector, province_of, sector_sums, sector_years
from harmlens.operators.windows import latest_two, rank_risks, top_n_by
from harmlens.workspace import cut_lineage

# Seasonal factors, alert months, scenario titles, tariffs.
SEASON_FACTOR = {"winter": 1.25, "spring": 1.10, "summer": 0.95, "fall": 1.05}
ALERT_MONTHS = {1: "Janvier - Risque hivernal élevé", 2: "Février - Fatigue hivernale",
                7: "Juillet - Chaleur et déshydratation", 8: "Août - Personnel de remplacement"}
SCENARIO_TITLES = (
    ("PERSONNE-TRAVAILLEUR BLESSE,MALADE", "Manutention sécuritaire et postures"),
    ("EFFORT EXCESSIF", "Techniques de levage et ergonomie"),
    ("CHUTE SUR LE MEME NIVEAU", "Circulation sécuritaire en milieu de travail"),
    ("VEHICULE", "Sécurité avec véhicules et chariots"),
    ("MACHINE", "Sécurité machine et procédures LOTO"),
)
QUOTE_COST, QUOTE_TMS, QUOTE_PSY, QUOTE_DAYS, QUOTE_DAY_COST = 12500, 15000, 28000, 45, 350


def _share(flag: str) -> Column:
    """Unrounded percentage of a flag among all rows."""
    return F.col(flag) / F.col("n") * 100


def incident_outlook(years: DataFrame, employees: int = 100, history: int = 0, season: str = "winter") -> DataFrame:
    """trend-adjusted score, 30-day probability, ranked risks and actions per sector."""
    factor = SEASON_FACTOR.get(season.lower(), 1.0)
    summed = years.groupBy("secteur_scian").agg(
        *[F.sum(c).alias(c) for c in ("n", "tms", "psy", "machine")], row_count().alias("years"),
        F.min_by("n", "annee").alias("first_n"), F.max_by("n", "annee").alias("last_n"))
    trend = F.when(F.col("years") >= 2, change_pct(F.col("last_n"), F.col("first_n"))).otherwise(F.lit(0.0))
    base = summed.withColumn("trend", trend).withColumn("__score", clamp(
        at_most(F.col("n") / 1000 * 10, 100) + F.col("trend") * 5 + F.log10(F.lit(employees + 1)) * 5 + F.lit(history * 2), 0.0, 100.0))
    for f in ("tms", "psy", "machine"):
        base = base.withColumn(f"rate_{f}", ratio(f, "n", 100, 1))
    probability = at_most(F.col("n") / F.col("years") / 12 / 10000 * employees * factor, 0.95)
    ranked = rank_risks(base, [("TMS", "rate_tms"), ("PSY", "rate_psy"), ("Machine", "rate_machine")])
    by_risk = F.transform("ranked", lambda r: (
        F.when((r == "TMS") & (F.col("rate_tms") > 25), "🦴 Programme ergonomique prioritaire (TMS élevés)")
        .when((r == "PSY") & (F.col("rate_psy") > 5), "🧠 Programme bien-être psychologique recommandé")
        .when((r == "Machine") & (F.col("rate_machine") > 5), "⚙️ Audit LOTO et sécurité machines")))
    actions = F.concat(
        present(F.when(F.col("__score") > 70, "⚠️ URGENT: Audit SST complet recommandé dans les 15 jours"),
                F.when(F.col("trend") > 20, "📈 Tendance à la hausse: Renforcer les mesures préventives")),
        F.array_compact(by_risk))
    priority = F.transform("ranked", lambda r: (
        F.when(r == "TMS", F.when(_share("tms") > 25, 1).otherwise(2))
        .when(r == "PSY", F.when(_share("psy") > 5, 1).otherwise(3))
        .otherwise(F.when(_share("machine") > 5, 1).otherwise(2))))
    return ranked.select(
        "secteur_scian", F.round("__score", 1).alias("risk_score"), F.round(probability * 100, 1).alias("probability_30_days"),
        F.col("ranked").alias("top_risks"), priority.alias("priorities"),
        F.when(F.size(actions) > 0, actions).otherwise(F.array(F.lit("✅ Maintenir les mesures préventives actuelles"))).alias("actions"),
        F.when(F.col("years") >= 5, "HIGH").when(F.col("years") >= 3, "MEDIUM").otherwise("LOW").alias("confidence"),
        F.col("n").alias("total_incidents"), F.col("years").alias("years_of_data"), F.round("trend", 1).alias("trend_percentage"))


def _alert(df: DataFrame, level: Column, kind: Column, message: Column, actions: Column, as_of: date) -> DataFrame:
    identity = F.substring(F.md5(F.concat_ws("|", F.col("secteur_scian"), kind, F.lit(as_of.isoformat()))), 1, 12)
    return df.select("secteur_scian", identity.alias("id"), level.alias("level"), kind.alias("type"),
                     message.alias("message"), actions.alias("actions"))


def trend_alerts(years: DataFrame, as_of: date, warn: float = 15, critical: float = 30) -> DataFrame:
    """jump of the latest year over the one before."""
    pair = latest_two(years.select("secteur_scian", "annee", "n"), ["secteur_scian"], "annee", "n")
    change = F.col("change")
    rows = pair.withColumn("change", change_pct(F.col("recent"), F.col("previous"))).filter(change > warn)
    spike = change > critical
    return _alert(
        rows, F.when(spike, "CRITICAL").otherwise("WARNING"), F.when(spike, "TREND_SPIKE").otherwise("TREND_INCREASE"),
        F.when(spike, F.format_string("Augmentation critique de %.1f%% des incidents", F.round(change, 1)))
        .otherwise(F.format_string("Augmentation de %.1f%% des incidents", F.round(change, 1))),
        F.when(spike, F.array(F.lit("Audit immédiat"), F.lit("Réunion SST d'urgence"), F.lit("Analyse des causes")))
        .otherwise(F.array(F.lit("Renforcer la surveillance"), F.lit("Analyser les causes"))), as_of)


def seasonal_alerts(years: DataFrame, as_of: date) -> DataFrame:
    """one notice per sector in the risky months of ``as_of``."""
    text = ALERT_MONTHS.get(as_of.month)
    sectors = years.groupBy("secteur_scian").agg(row_count().alias("__n")).filter(F.lit(text is not None))
    return _alert(sectors, F.lit("INFO"), F.lit("SEASONAL_RISK"), F.lit(text),
                  F.array(F.lit("Rappel des mesures saisonnières"), F.lit("Communication aux équipes")), as_of)


def benchmark_alerts(years: DataFrame, as_of: date, points: float = 5.0) -> DataFrame:
    """TMS rate more than ``points`` above the province."""
    province = province_of(years)
    rows = sector_sums(years).withColumn("__p", province).withColumn("rate", percent("tms", "n")).withColumn(
        "province", percent("__p.tms", "__p.n")).withColumn("gap", F.round(F.col("rate") - F.col("province"), 2))
    return _alert(rows.filter(F.col("gap") > points), F.lit("WARNING"), F.lit("BENCHMARK_EXCEEDED"),
                  F.format_string("TMS %.1f%% au-dessus de la moyenne provinciale", F.round("gap", 1)),
                  F.array(F.lit("Programme ergonomique"), F.lit("Évaluation des postes")), as_of)


def all_alerts(years: DataFrame, as_of: date, points: float = 5.0, warn: float = 15, critical: float = 30) -> DataFrame:
    """F21."""
    return trend_alerts(years, as_of, warn, critical).unionByName(seasonal_alerts(years, as_of)).unionByName(
        benchmark_alerts(years, as_of, points))


def training_scenarios(lesions: DataFrame, count: int = 3) -> DataFrame:
    """the leading causes per sector as scenarios; shares are of all the sector's rows."""
    causes = counts_by(lesions, ["secteur_scian", "agent_causal_lesion"])
    sums = causes.groupBy("secteur_scian").agg(F.sum("n").alias("sector_n"))
    top = top_n_by(causes.filter(F.col("agent_causal_lesion").isNotNull()), ["secteur_scian"], "agent_causal_lesion", count)
    cause = F.col("agent_causal_lesion")
    title = None
    for key, text in SCENARIO_TITLES:
        hit = F.lower(cause).contains(key.lower())
        title = F.when(hit, text) if title is None else title.when(hit, text)
    return join_sector(top, sums).select(
        "secteur_scian",
        F.format_string("VR-%s-%03d", F.upper(F.substring("secteur_scian", 1, 4)), F.col("rank")).alias("id"),
        title.otherwise(F.concat(F.lit("Prévention: "), F.substring(cause, 1, 50))).alias("title"),
        (F.lit(15) + (F.col("rank") - 1) * 5).alias("duration_minutes"), F.col("n").alias("based_on_incidents"),
        cause.alias("cause_type"), ratio("n", "sector_n", 100, 1).alias("cause_percentage"))


def _worker_columns(age: Column) -> list[Column]:
    tms, psy = F.col("tms_rate"), F.col("psy_rate")
    seen = F.col("n") > 0
    return [
        F.when(seen, F.round(at_most(40 + tms + psy * 3, 100), 1)).otherwise(50.0).alias("risk_score"),
        F.when(seen, present(F.when(tms > F.col("sector_tms"), "TMS"), F.when(psy > 5, "PSY")))
        .otherwise(F.array().cast("array<string>")).alias("specific_risks"),
        F.when(seen, present(
            F.when(tms > 25, "Ergonomie et manutention (PRIORITÉ HAUTE)"),
            F.when(age.contains("45") | age.contains("55"), "Adaptation du poste de travail"),
            F.lit("Formation SST de base"))).otherwise(F.array(F.lit("Formation SST générale"))).alias("recommended_training"),
        F.when(seen, present(
            F.lit("Examen médical annuel"), F.when(tms > 30, "Évaluation musculo-squelettique"),
            F.when(psy > 5, "Suivi psychologique"))).otherwise(F.array(F.lit("Examen médical annuel"))).alias("medical_surveillance"),
    ]


def worker_profiles(lesions: DataFrame) -> DataFrame:
    """F23 for every (sector, age group, sex); one small count, its sums give the sector rates."""
    cohort = counts_by(lesions, ["secteur_scian", "groupe_age", "sexe_pers_phys"], ["tms", "psy"])
    sector = cohort.groupBy("secteur_scian").agg(F.sum("n").alias("sn"), F.sum("tms").alias("st"), F.sum("psy").alias("sp"))
    rows = join_sector(cohort, sector).select(
        "secteur_scian", "groupe_age", "sexe_pers_phys", "n", percent("tms", "n").alias("tms_rate"),
        percent("psy", "n").alias("psy_rate"), percent("st", "sn").alias("sector_tms"), percent("sp", "sn").alias("sector_psy"))
    return rows.select("*", *_worker_columns(F.col("groupe_age")))


def worker_profile_for(lesions: DataFrame, sector: str, age_group: str, gender: str) -> DataFrame:
    """F23 as asked for one person: substring filters, and defaults when nobody matches."""
    rows = lesions.filter(contains_ci("secteur_scian", sector))
    cohort = counts_by(rows, ["groupe_age", "sexe_pers_phys"], ["tms", "psy"])
    fits = contains_ci("groupe_age", age_group) & contains_ci("sexe_pers_phys", gender)
    one = cohort.agg(
        *[F.coalesce(F.sum(F.when(fits, F.col(c))), F.lit(0)).alias(c) for c in ("n", "tms", "psy")],
        F.sum("n").alias("sn"), F.sum("tms").alias("st"))
    return one.select(
        F.lit(sector).alias("secteur"), F.lit(age_group).alias("age_group"), F.lit(gender).alias("gender"), "n",
        F.coalesce(percent("tms", "n"), F.lit(0.0)).alias("tms_rate"), F.coalesce(percent("psy", "n"), F.lit(0.0)).alias("psy_rate"),
        F.coalesce(percent("st", "sn"), F.lit(0.0)).alias("sector_tms"),
    ).select("*", *_worker_columns(F.lit(age_group)))


def insurance_quotes(sums: DataFrame, employees: int, history: int = 0) -> DataFrame:
    """expected cost, premium range and savings per sector."""
    rate = F.col("n") / 7 / 100000 * 1000
    expected = rate / 1000 * employees
    if history > 0:
        expected = (expected + history) / 2
    tms = F.when(F.col("n") > 0, F.col("tms") / F.col("n")).otherwise(0.25)
    psy = F.when(F.col("n") > 0, F.col("psy") / F.col("n")).otherwise(0.04)
    rows = sums.withColumn("e", expected).withColumn("t", tms).withColumn("p", psy)
    direct = F.col("e") * (F.lit(QUOTE_COST) * (1 - F.col("t") - F.col("p")) + F.lit(QUOTE_TMS) * F.col("t") + F.lit(QUOTE_PSY) * F.col("p"))
    rows = rows.withColumn("direct", direct).withColumn("total", F.col("direct") + F.col("e") * QUOTE_DAYS * QUOTE_DAY_COST)
    whole = lambda c: F.round(c, 0).cast("bigint")
    return rows.select(
        "secteur_scian", F.lit(employees).alias("employee_count"), F.lit(history).alias("historical_incidents"),
        whole(F.col("total")).alias("estimated_annual_cost"), whole(F.col("total") * 0.40).alias("premium_low"),
        whole(F.col("total") * 0.60).alias("premium_high"), F.round(F.col("total") * 0.10, 2).alias("saving_incidents"),
        F.round(F.col("direct") * F.col("t") * 0.20, 2).alias("saving_tms"),
        F.round(F.col("total") * 0.60 * 0.15, 2).alias("saving_prevention"))


def intelligence_report(lesions: DataFrame, as_of: date, employees: int = 100) -> DataFrame:
    """outlook, alerts, scenarios and quote of each sector as one row with a JSON document."""
    years = cut_lineage(sector_years(lesions))
    outlook = incident_outlook(years, employees)
    alerts = all_alerts(years, as_of).groupBy("secteur_scian").agg(
        row_count().alias("nb_alerts"), F.array_sort(F.collect_list(F.struct("level", "type", "message", "actions"))).alias("alerts"))
    scenarios = training_scenarios(lesions).groupBy("secteur_scian").agg(
        row_count().alias("nb_scenarios"), F.array_sort(F.collect_list(F.struct(
            "id", "title", "duration_minutes", "based_on_incidents", "cause_percentage"))).alias("scenarios"))
    quote = insurance_quotes(sector_sums(years), employees)
    out = outlook
    for side in (alerts, scenarios, quote):
        out = join_sector(out, side)
    return out.select(
        "secteur_scian", "risk_score", "probability_30_days", F.coalesce("nb_alerts", F.lit(0)).alias("nb_alerts"),
        F.coalesce("nb_scenarios", F.lit(0)).alias("nb_scenarios"), "estimated_annual_cost",
        F.to_json(F.struct(
            F.struct("risk_score", "probability_30_days", "top_risks", "actions", "confidence").alias("prediction"), "alerts",
            F.col("scenarios").alias("vr_scenarios"),
            F.struct("estimated_annual_cost", "premium_low", "premium_high", "saving_incidents", "saving_tms",
                     "saving_prevention").alias("insurance"))).alias("document"))


def simple_prediction(sums: DataFrame, employees: int) -> DataFrame:
    """the simplified score, probability and texts per sector."""
    rows = sums.select("secteur_scian", "n", _share("tms").alias("t"), _share("psy").alias("p"), _share("machine").alias("m"))
    base = F.least(F.lit(100).cast("bigint"), truncate(F.col("n") / 10000 * 50 + F.col("t") + F.col("p")))
    rows = rows.withColumn("risk_score", F.least(F.lit(100).cast("bigint"), base + F.lit(employees // 50)))
    risks = present(
        F.when(F.col("t") > 20, F.format_string("TMS (%.1f%%)", F.round("t", 1))),
        F.when(F.col("p") > 5, F.format_string("Psychologique (%.1f%%)", F.round("p", 1))),
        F.when(F.col("m") > 10, F.format_string("Machines (%.1f%%)", F.round("m", 1))))
    return rows.select(
        "secteur_scian", "risk_score",
        F.round(at_most(F.col("n") / 7 / 12 / 1000 * employees, 0.99), 2).alias("probability_30_days"),
        F.when(F.size(risks) > 0, risks).otherwise(F.array(F.lit("Risque modéré"))).alias("top_risks"),
        F.when(F.col("risk_score") > 70, "Action immédiate requise - Formation SST et audit recommandés")
        .when(F.col("risk_score") > 40, "Surveillance accrue recommandée - Réviser les procédures")
        .otherwise("Maintenir les mesures préventives actuelles").alias("recommendation"))
