"""Sector enrichment: profile, benchmarks, trends, dangers, recommendations.

Everything is computed for all sectors at once. One scan counts the flags per
sector and year; one stacked count covers the three descriptive columns. The
composite reports checkpoint those two small results and derive the rest from
them, so the injury rows are read twice however many sections a report has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmlens.functions.exprs import BENCHMARK_FLAGS, at_most, band, change_pct, contains_ci, percent, present, row_count
from harmlens.operators.aggregates import counts_by, dominant_values, grand_total, stacked_counts
from harmlens.operators.windows import first_last, top_n_by
from harmlens.workspace import cut_lineage

# Level names, thresholds and status texts.
LEVEL_STEPS = ((50000, "🔴 CRITIQUE"), (20000, "🟠 ÉLEVÉ"), (5000, "🟡 MODÉRÉ"))
LOWEST = "🟢 FAIBLE"
HIGH_LEVELS = ("🔴 CRITIQUE", "🟠 ÉLEVÉ")
ABOVE, BELOW, AVERAGE = "⚠️ AU-DESSUS", "✅ EN-DESSOUS", "➡️ MOYENNE"
UP, DOWN, FLAT = "📈 HAUSSE", "📉 BAISSE", "➡️ STABLE"

DESCRIPTIVE = {"nature_lesion": "top_nature_lesion", "siege_lesion": "top_siege_lesion",
               "agent_causal_lesion": "top_agent_causal"}
YEARLY_FLAGS = list(BENCHMARK_FLAGS)


def sector_years(lesions: DataFrame) -> DataFrame:
    """The single scan most operators here start from: counts per sector and year."""
    return counts_by(lesions, ["secteur_scian", "annee"], YEARLY_FLAGS)


def sector_sums(years: DataFrame) -> DataFrame:
    return years.groupBy("secteur_scian").agg(*[F.sum(c).alias(c) for c in ("n", *YEARLY_FLAGS)])


def province_of(years: DataFrame) -> Column:
    return grand_total(years, ["secteur_scian", "annee"])


def described(lesions: DataFrame) -> DataFrame:
    """One stacked count of the three descriptive columns."""
    return stacked_counts(lesions, list(DESCRIPTIVE))


def linear_score(n: Column, pct_tms: Column, pct_psy: Column) -> Column:
    """F09."""
    return F.round(at_most(n / 10000 * 10, 40) + at_most(pct_tms * 1.5, 30) + at_most(pct_psy * 5, 30), 1)


def join_sector(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on the sector, which may be missing on both sides."""
    side = right.withColumnRenamed("secteur_scian", "__s")
    return left.join(side, F.col("secteur_scian").eqNullSafe(F.col("__s")), "left").drop("__s")


def sector_profiles(lesions: DataFrame, steps=LEVEL_STEPS) -> DataFrame:
    """totals, rates, share, score, level and dominant values per sector."""
    return profiles_of(sector_years(lesions), dominant_values(described(lesions), DESCRIPTIVE), steps)


def profiles_of(years: DataFrame, dominants: DataFrame, steps=LEVEL_STEPS) -> DataFrame:
    province = province_of(years)
    rated = sector_sums(years).select(
        "secteur_scian", F.col("n").alias("total_lesions"), percent("n", province["n"]).alias("pct_total_qc"),
        *[percent(f, "n").alias(f"risk_{f}_pct") for f in YEARLY_FLAGS])
    rated = rated.withColumn("risk_score", linear_score(F.col("total_lesions"), F.col("risk_tms_pct"), F.col("risk_psy_pct")))
    rated = rated.withColumn("risk_level", band(F.col("total_lesions"), list(steps), LOWEST))
    return join_sector(rated, dominants)


def matching(df: DataFrame, sector: str, column: str = "secteur_scian") -> DataFrame:
    """The single-sector form of any keyed result: keep the sectors containing ``sector``."""
    return df.filter(contains_ci(column, sector))


def benchmarks(lesions: DataFrame) -> DataFrame:
    """each sector's four rates against the province, with status and advice."""
    return benchmarks_of(sector_years(lesions))


def benchmarks_of(years: DataFrame) -> DataFrame:
    province = province_of(years)
    entries = F.explode(F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(f.upper()).alias("indicateur"), percent(f, "n").alias("taux_secteur"),
                 percent(f"__p.{f}", "__p.n").alias("taux_provincial"))
        for i, f in enumerate(BENCHMARK_FLAGS)])).alias("b")
    gap, base = F.col("ecart"), F.col("taux_provincial")
    rows = sector_sums(years).withColumn("__p", province).select("secteur_scian", entries).select("secteur_scian", "b.*")
    rows = rows.withColumn("ecart", F.col("taux_secteur") - base)
    high, low = gap > base * 0.2, gap < -base * 0.2
    return rows.select(
        "*", F.when(base > 0, gap / base * 100).otherwise(F.lit(0.0)).alias("ecart_pct"),
        F.when(high, ABOVE).when(low, BELOW).otherwise(AVERAGE).alias("statut"),
        F.when(high, F.format_string("Action prioritaire requise: réduire les %s de %.1f%%", F.col("indicateur"), F.round(F.abs(gap), 1)))
        .when(low, "Performance supérieure: maintenir les bonnes pratiques")
        .otherwise("Dans la moyenne provinciale: surveiller les tendances").alias("recommandation"))


def trends(lesions: DataFrame) -> DataFrame:
    """rows per sector and year."""
    return counts_by(lesions, ["secteur_scian", "annee"]).withColumnRenamed("n", "total")


def top_values(stacked: DataFrame, n: int = 5) -> DataFrame:
    """F04 for every stacked column: the top values with their share of the non-null rows."""
    best = top_n_by(stacked, ["secteur_scian", "colonne"], "valeur", n)
    sums = stacked.groupBy(F.col("secteur_scian").alias("__s"), F.col("colonne").alias("__c")).agg(F.sum("n").alias("__n"))
    same = F.col("secteur_scian").eqNullSafe(F.col("__s")) & (F.col("colonne") == F.col("__c"))
    return best.join(sums, same, "left").select(
        "secteur_scian", "colonne", "rank", "valeur", F.col("n").alias("total"), percent("n", "__n").alias("pct"))


def recommendations(profiles: DataFrame, benchmark_rows: DataFrame) -> DataFrame:
    """ordered advice texts per sector."""
    over = benchmark_rows.filter(F.col("statut") == ABOVE).groupBy("secteur_scian").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ord", "indicateur", "recommandation"))),
                    lambda b: F.concat(F.lit("📊 "), b["indicateur"], F.lit(": "), b["recommandation"])).alias("over"))
    joined = join_sector(profiles, over)
    first = present(
        F.when(F.col("risk_level").isin(*HIGH_LEVELS), F.concat(
            F.lit("⚠️ Secteur à haut risque ("), F.format_number("total_lesions", 0),
            F.lit(" lésions): audit SST complet recommandé"))),
        F.when(F.col("risk_tms_pct") > 25, F.concat(
            F.lit("🦴 TMS élevés ("), F.col("risk_tms_pct").cast("string"), F.lit("%): programme ergonomique prioritaire"))),
        F.when(F.col("risk_psy_pct") > 5, F.concat(
            F.lit("🧠 Risques psychosociaux ("), F.col("risk_psy_pct").cast("string"),
            F.lit("%): programme bien-être recommandé"))))
    last = present(F.when(F.col("top_nature_lesion").isNotNull(), F.concat(
        F.lit("🎯 Nature dominante: "), F.col("top_nature_lesion"), F.lit(" - cibler les mesures de prévention"))))
    none = F.array().cast("array<string>")
    return joined.select("secteur_scian", F.concat(first, F.coalesce("over", none), last).alias("recommandations_ia"))


def full_enrichment(lesions: DataFrame, steps=LEVEL_STEPS, n: int = 5) -> DataFrame:
    """one nested row per sector. Each list is bounded: 4 benchmarks, the years, n values."""
    years = cut_lineage(sector_years(lesions))
    tops = cut_lineage(top_values(described(lesions), n))
    dominants = dominant_values(tops.withColumnRenamed("total", "n"), DESCRIPTIVE)
    profiles = profiles_of(years, dominants, steps)
    rows = benchmarks_of(years)
    bench = rows.groupBy("secteur_scian").agg(F.array_sort(F.collect_list(F.struct(
        "ord", "indicateur", "taux_secteur", "taux_provincial", "ecart", "ecart_pct", "statut", "recommandation"))).alias("benchmarks"))
    by_year = years.groupBy("secteur_scian").agg(
        F.array_sort(F.collect_list(F.struct("annee", F.col("n").alias("total")))).alias("tendances"))
    entry = F.struct("rank", "valeur", "total", "pct")
    lists = tops.groupBy("secteur_scian").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("colonne") == column, entry))).alias(label)
        for column, label in (("nature_lesion", "top_5_natures"), ("siege_lesion", "top_5_sieges"),
                              ("agent_causal_lesion", "top_5_agents"))])
    out = profiles
    for side in (bench, by_year, lists, recommendations(profiles, rows)):
        out = join_sector(out, side)
    return out


def enrichment_json(enriched: DataFrame) -> DataFrame:
    """The enrichment as one JSON document per sector."""
    brief = F.transform("benchmarks", lambda b: F.struct(
        b["indicateur"].alias("indicateur"), b["taux_secteur"].alias("taux_secteur"),
        b["taux_provincial"].alias("taux_provincial"), b["ecart"].alias("ecart"), b["statut"].alias("statut")))
    by_year = F.map_from_entries(F.transform("tendances", lambda y: F.struct(y["annee"].cast("string"), y["total"])))
    values = {c: F.transform(c, lambda v: F.struct(v["valeur"].alias("valeur"), v["total"].alias("total"), v["pct"].alias("pct")))
              for c in ("top_5_natures", "top_5_sieges", "top_5_agents")}
    document = F.to_json(F.struct(
        "secteur_scian",
        F.struct("total_lesions", "pct_total_qc", "risk_score", "risk_level", "risk_tms_pct", "risk_psy_pct",
                 F.col("top_nature_lesion").alias("top_nature"), F.col("top_siege_lesion").alias("top_siege"),
                 F.col("top_agent_causal").alias("top_agent")).alias("risk_profile"),
        brief.alias("benchmarks"), by_year.alias("tendances"), *[v.alias(c) for c, v in values.items()], "recommandations_ia"))
    return enriched.select("secteur_scian", document.alias("document"))


def hazard_map(profiles: DataFrame) -> DataFrame:
    """the three dangers of each sector with their priority."""
    rules = (("TMS", "risk_tms_pct", 20, 2), ("PSY", "risk_psy_pct", 5, 2), ("MACHINE", "risk_machine_pct", 3, 3))
    dangers = F.array(*[
        F.struct(F.lit(kind).alias("type"), F.col(rate).alias("taux"),
                 F.when(F.col(rate) > limit, 1).otherwise(other).alias("priorite"))
        for kind, rate, limit, other in rules])
    return profiles.select("secteur_scian", "risk_level", "risk_score", F.explode(dangers).alias("d")).select(
        "secteur_scian", "risk_level", "risk_score", "d.*")


def benchmark_score(benchmark_rows: DataFrame) -> DataFrame:
    """share of a sector's indicators that are below the average."""
    below = F.avg(F.when(F.col("statut") == BELOW, 1.0).otherwise(0.0)) * 100
    return benchmark_rows.groupBy("secteur_scian").agg(below.alias("score_global"), row_count().alias("indicateurs"))


def trend_analysis(years: DataFrame) -> DataFrame:
    """change between the first and last year; needs two years."""
    ends = first_last(years, ["secteur_scian"], "annee", "n")
    change = change_pct(F.col("valeur_fin"), F.col("valeur_debut"))
    enough = F.col("nb_annees") >= 2
    return ends.withColumn("__change", change).select(
        "secteur_scian", "annee_debut", "annee_fin", "valeur_debut", "valeur_fin",
        F.when(enough, F.round("__change", 1)).alias("variation_pct"),
        F.when(enough, F.when(F.col("__change") > 10, UP).when(F.col("__change") < -10, DOWN).otherwise(FLAT)).alias("tendance"),
        F.when(enough, F.format_string("Variation de %+.1f%% sur %d ans", F.round("__change", 1), F.col("nb_annees")))
        .otherwise("Données insuffisantes").alias("analyse"))
