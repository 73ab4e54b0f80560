"""Grouped statistics over injury rows (A01-A40) and the cores they share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmlens.functions.exprs import FLAGS, as_col, band, contains_ci, flag_count, percent, ratio, row_count
from harmlens.operators.windows import top_k

# Volume thresholds and their level names.
VOLUME_STEPS = ((50000, "CRITIQUE"), (20000, "ÉLEVÉ"), (5000, "MODÉRÉ"))
LOWEST_LEVEL = "FAIBLE"


# -- cores -------------------------------------------------------------------

def counts_by(df: DataFrame, keys: Sequence[str], flags: Sequence[str] = ()) -> DataFrame:
    """Rows ``n`` and set flags per key; one scan, map-side combined."""
    return df.groupBy(*keys).agg(row_count().alias("n"), *[flag_count(f).alias(f) for f in flags])


def grand_total(counted: DataFrame, keys: Sequence[str]) -> Column:
    """All measures of a grouped frame summed into one struct, as a scalar subquery.

    It reads the grouped result, not the input, and asks for every measure, so
    the subquery reuses the shuffle of the main branch: no second scan, no join.
    Where several fields are needed, add it as a column first: it is planned once.
    """
    measures = [c for c in counted.columns if c not in keys]
    return counted.agg(F.struct(*[F.sum(m).alias(m) for m in measures]).alias("total")).scalar()


def volume_level(n: Column, steps=VOLUME_STEPS) -> Column:
    return band(n, list(steps), LOWEST_LEVEL)


def stacked_counts(df: DataFrame, columns: Sequence[str], keep_null: bool = False) -> DataFrame:
    """Rows per (sector, column, value) for several columns in one pass."""
    tall = df.unpivot(["secteur_scian"], list(columns), "colonne", "valeur")
    if not keep_null:
        tall = tall.filter(F.col("valeur").isNotNull())
    return tall.groupBy("secteur_scian", "colonne", "valeur").agg(row_count().alias("n"))


def dominant_values(stacked: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Most frequent value of each stacked column per sector; ties go to the smallest value."""
    rank = F.struct((-F.col("n")).alias("rank"), "valeur")
    best = [F.min(F.when(F.col("colonne") == column, rank))["valeur"].alias(label) for column, label in labels.items()]
    return stacked.groupBy("secteur_scian").agg(*best)


def _share_top(counted: DataFrame, key: str, label: str, k: int, extra: Sequence[Column] = ()) -> DataFrame:
    total = grand_total(counted, [key])
    return (
        top_k(counted, "n", k, [key])
        .select(F.col(key).alias(label), F.col("n").alias("total"), percent("n", total["n"]).alias("pct_total"), *extra)
    )


# -- injury rows of the province (A01-A09, A14, A15, A22, A24, A25, A35) -------

def sector_year_stats(lesions: DataFrame) -> DataFrame:
    """A01."""
    counted = counts_by(lesions, ["secteur_scian", "annee"], list(FLAGS))
    return counted.select(
        "secteur_scian", "annee", F.col("n").alias("total_lesions"),
        *[F.col(f).alias(f"lesions_{f}") for f in FLAGS],
        percent("tms", "n").alias("pct_tms"), percent("psy", "n").alias("pct_psy"),
    )


def top_sectors(lesions: DataFrame) -> DataFrame:
    """A02. Counting by (sector, year) first makes the year range a by-product."""
    by_year = counts_by(lesions, ["secteur_scian", "annee"], ["tms", "psy"])
    total = grand_total(by_year, ["secteur_scian", "annee"])
    per_sector = by_year.groupBy("secteur_scian").agg(
        *[F.sum(c).alias(c) for c in ("n", "tms", "psy")],
        F.min("annee").alias("annee_min"), F.max("annee").alias("annee_max"),
    )
    return per_sector.select(
        "secteur_scian", F.col("n").alias("total_lesions"), percent("n", total["n"]).alias("pct_total"),
        F.col("tms").alias("lesions_tms"), F.col("psy").alias("lesions_psy"),
        percent("tms", "n").alias("pct_tms"), percent("psy", "n").alias("pct_psy"), "annee_min", "annee_max",
    )


def nature_stats(lesions: DataFrame, k: int = 20) -> DataFrame:
    """A03."""
    pairs = counts_by(lesions, ["nature_lesion", "secteur_scian"])
    total = grand_total(pairs, ["nature_lesion", "secteur_scian"])
    counted = pairs.groupBy("nature_lesion").agg(
        F.sum("n").alias("n"), F.count("secteur_scian").alias("nb_secteurs_touches")
    )
    return top_k(counted, "n", k, ["nature_lesion"]).select(
        "nature_lesion", F.col("n").alias("total"), percent("n", total["n"]).alias("pct_total"), "nb_secteurs_touches"
    )


def body_site_stats(lesions: DataFrame, k: int = 20) -> DataFrame:
    """A04."""
    return _share_top(counts_by(lesions, ["siege_lesion"], ["tms"]), "siege_lesion", "siege_lesion", k,
                      [F.col("tms").alias("avec_tms")])


def agent_stats(lesions: DataFrame, k: int = 20) -> DataFrame:
    """A05; a missing agent is a group of its own."""
    return _share_top(counts_by(lesions, ["agent_causal_lesion"]), "agent_causal_lesion", "agent_causal", k)


def accident_type_stats(lesions: DataFrame, k: int = 20) -> DataFrame:
    """A06."""
    return _share_top(counts_by(lesions, ["genre"]), "genre", "genre_accident", k)


def demographics(lesions: DataFrame) -> DataFrame:
    """A07."""
    keys = ["sexe_pers_phys", "groupe_age"]
    counted = counts_by(lesions, keys, ["tms", "psy"])
    total = grand_total(counted, keys)
    return counted.select(
        F.col("sexe_pers_phys").alias("sexe"), "groupe_age", F.col("n").alias("total"),
        percent("n", total["n"]).alias("pct_total"),
        F.col("tms").alias("lesions_tms"), F.col("psy").alias("lesions_psy"),
    )


def year_trends(lesions: DataFrame) -> DataFrame:
    """A08."""
    return counts_by(lesions, ["annee"], ["tms", "psy", "covid"]).select(
        "annee", F.col("n").alias("total_lesions"), "tms", "psy", "covid",
        percent("tms", "n").alias("pct_tms"), percent("psy", "n").alias("pct_psy"),
    )


def sector_risk_profile(lesions: DataFrame, steps=VOLUME_STEPS) -> DataFrame:
    """Rates, a log-scaled score and a level per sector."""
    flags = ["tms", "psy", "machine", "surdite"]
    counted = counts_by(lesions, ["secteur_scian"], flags)
    total = counted.agg(
        F.struct(F.sum("n").alias("n"), F.max("n").alias("largest"),
                 *[F.sum(f).alias(f) for f in flags]).alias("total")).scalar()
    counted = counted.withColumn("__t", total)
    score = (
        F.log(F.col("n") + 1) / F.log(F.col("__t.largest") + 1) * 40
        + F.col("tms").cast("double") / F.col("n") * 30
        + F.col("psy").cast("double") / F.col("n") * 30
    )
    return counted.select(
        "secteur_scian", F.col("n").alias("total_lesions"), percent("n", "__t.n").alias("pct_total_qc"),
        *[percent(f, "n").alias(f"risk_{f}_pct") for f in flags],
        F.round(score, 1).alias("risk_score"), volume_level(F.col("n"), steps).alias("risk_level"),
    )


def sector_profile_exact(lesions: DataFrame, sector: str | None = None, steps=VOLUME_STEPS) -> DataFrame:
    """One row per sector (or for exactly one), with its three most frequent values."""
    counted = counts_by(lesions, ["secteur_scian"], ["tms", "psy"])
    total = grand_total(counted, ["secteur_scian"])
    rows = lesions if sector is None else lesions.filter(F.col("secteur_scian") == sector)
    out = counted if sector is None else counted.filter(F.col("secteur_scian") == sector)
    out = out.select(
        "secteur_scian", F.col("n").alias("total_lesions"), percent("n", total["n"]).alias("pct_total"),
        percent("tms", "n").alias("risk_tms"), percent("psy", "n").alias("risk_psy"),
        volume_level(F.col("n"), steps).alias("risk_level"),
    )
    labels = {"nature_lesion": "top_nature", "siege_lesion": "top_siege", "agent_causal_lesion": "top_agent"}
    side = dominant_values(stacked_counts(rows, list(labels), keep_null=True), labels).withColumnRenamed("secteur_scian", "__s")
    return out.join(side, F.col("secteur_scian").eqNullSafe(F.col("__s")), "left").drop("__s").withColumnRenamed("secteur_scian", "secteur")


# Status texts of the provincial comparison.
ABOVE, BELOW, WITHIN = "⚠️ AU-DESSUS (+20%)", "✅ EN-DESSOUS (-20%)", "➡️ DANS LA MOYENNE"


def compare_to_province(lesions: DataFrame, indicator: str, sector: str | None = None) -> DataFrame:
    """A sector's rate against the whole, status at 20 % either side."""
    name = indicator.lower()
    counted = counts_by(lesions, ["secteur_scian"], [name])
    total = grand_total(counted, ["secteur_scian"])
    rate, province = F.col("taux_secteur"), F.col("taux_provincial")
    rows = counted if sector is None else counted.filter(F.col("secteur_scian") == sector)
    return rows.withColumn("__t", total).select(
        F.col("secteur_scian").alias("secteur"), percent(name, "n").alias("taux_secteur"),
        percent(f"__t.{name}", "__t.n").alias("taux_provincial"),
    ).select(
        "*", F.round(rate - province, 2).alias("ecart"),
        F.when(rate > province * 1.2, ABOVE).when(rate < province * 0.8, BELOW).otherwise(WITHIN).alias("statut"),
    )


def totals(df: DataFrame, key: str, label: str) -> DataFrame:
    """Rows per key."""
    return df.groupBy(F.col(key).alias(label)).agg(row_count().alias("total"))


def sector_list(lesions: DataFrame) -> DataFrame:
    """Sectors with counts and rates."""
    counted = counts_by(lesions.filter(F.col("secteur_scian").isNotNull()), ["secteur_scian"], ["tms", "psy"])
    return counted.select(
        F.col("secteur_scian").alias("sector"), F.col("n").alias("total_incidents"),
        F.col("tms").alias("tms_count"), F.col("psy").alias("psy_count"),
        percent("tms", "n").alias("tms_rate"), percent("psy", "n").alias("psy_rate"),
    )


def sector_detail(lesions: DataFrame, name: str) -> DataFrame:
    """Yearly series of the matching sectors, with their total on each row."""
    counted = counts_by(lesions.filter(contains_ci("secteur_scian", name)), ["annee"], ["tms", "psy"])
    total = grand_total(counted, ["annee"])
    return counted.select(F.lit(name).alias("sector"), F.col("annee").alias("year"), F.col("n").alias("incidents"),
                          "tms", "psy", total["n"].alias("total_incidents"))


def sector_year_graph_stats(lesions: DataFrame) -> DataFrame:
    """What the statistics graph stores per sector and year."""
    counted = counts_by(lesions.filter(F.col("secteur_scian").isNotNull()), ["secteur_scian", "annee"],
                        ["tms", "psy", "machine"])
    return counted.select(F.col("secteur_scian").alias("secteur"), "annee", F.col("n").alias("total"),
                          "tms", "psy", "machine", percent("tms", "n").alias("tms_rate"))


# -- US and European rows (A10, A11, A34, A36) -----------------------------------

def state_stats(osha: DataFrame) -> DataFrame:
    """A10; the share's denominator includes rows without a state."""
    counted = counts_by(osha, ["state"])
    total = grand_total(counted, ["state"])
    return counted.filter(F.col("state").isNotNull()).select(
        F.col("state").alias("etat"), F.col("n").alias("total_incidents"), percent("n", total["n"]).alias("pct_total"))


def industry_stats(osha: DataFrame, k: int = 50) -> DataFrame:
    """A11."""
    keys = ["naics_code", "industry_description"]
    counted = counts_by(osha, keys)
    total = grand_total(counted, keys)
    return top_k(counted.filter(F.col("naics_code").isNotNull()), "n", k, keys).select(
        *keys, F.col("n").alias("total_incidents"), percent("n", total["n"]).alias("pct_total"))


def country_totals(esaw: DataFrame) -> DataFrame:
    """A34; the count is text at the source and may fail to parse."""
    return (
        esaw.filter(F.col("country_code").isNotNull())
        .groupBy(F.col("country_code").alias("country"), "country_name")
        .agg(row_count().alias("total"), F.sum(F.col("incident_count").try_cast("bigint")).alias("incidents"))
    )


def state_totals(osha: DataFrame) -> DataFrame:
    """Rows of every state."""
    return counts_by(osha.filter(F.col("state").isNotNull()), ["state"]).withColumnRenamed("n", "total")


def top_states(osha: DataFrame, k: int = 50) -> DataFrame:
    """The report of the largest states."""
    return top_k(state_totals(osha), "total", k, ["state"])


# -- all sources together (A12, A13, A23, A33, A39) ---------------------------------

# How each source is described.
SOURCE_FACTS = {
    "osha": ("OSHA USA", "🇺🇸", "2016-2021", "NAICS"),
    "eurostat": ("Eurostat EU-27", "🇪🇺", "2010-2022", "NACE"),
    "cnesst": ("CNESST Québec", "🇨🇦", "2017-2023", "SCIAN"),
}


def source_summary(osha: DataFrame, eurostat: DataFrame, cnesst: DataFrame) -> DataFrame:
    """One row per source."""
    parts = []
    for key, df in (("osha", osha), ("eurostat", eurostat), ("cnesst", cnesst)):
        name, sign, period, scheme = SOURCE_FACTS[key]
        parts.append(df.agg(row_count().alias("total_records")).select(
            F.lit(name).alias("source"), F.lit(sign).alias("flag"), "total_records",
            F.lit(period).alias("periode"), F.lit(scheme).alias("classification")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def table_counts(osha: DataFrame, eurostat: DataFrame, cnesst: DataFrame) -> DataFrame:
    """The three row counts side by side."""
    return osha.agg(row_count().alias("osha_usa")).select(
        "osha_usa",
        eurostat.agg(row_count()).scalar().alias("eurostat_eu"),
        cnesst.agg(row_count()).scalar().alias("cnesst_qc"),
    )


def total_records(osha: DataFrame, eurostat: DataFrame, cnesst: DataFrame) -> DataFrame:
    """A13."""
    return table_counts(osha, eurostat, cnesst).select(
        (F.col("osha_usa") + F.col("eurostat_eu") + F.col("cnesst_qc")).alias("total_global"),
        "osha_usa", "eurostat_eu", "cnesst_qc")


def coverage(osha: DataFrame, eurostat: DataFrame, cnesst: DataFrame) -> DataFrame:
    """Counts per jurisdiction, their sum, and the covered years as an array."""
    years = counts_by(cnesst, ["annee"])
    quebec = years.agg(F.sum("n").alias("qc"), F.array_sort(F.collect_list("annee")).alias("years_covered"))
    return quebec.select(
        F.col("qc"), osha.agg(row_count()).scalar().alias("usa"), eurostat.agg(row_count()).scalar().alias("eu27"),
        "years_covered",
    ).withColumn("total_incidents", F.col("qc") + F.col("usa") + F.col("eu27"))


def jurisdiction_comparison(osha: DataFrame, eurostat: DataFrame, lesions: DataFrame, k: int = 5) -> DataFrame:
    """Totals per jurisdiction, Quebec rates, the largest US states as an array."""
    states = counts_by(osha, ["state"])
    total_usa = grand_total(states, ["state"])
    largest = top_k(states.filter(F.col("state").isNotNull()), "n", k, ["state"])
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("rank"), "state")))
    usa = largest.agg(F.transform(ranked, lambda s: s["state"]).alias("top_states")).select(
        F.lit("usa").alias("jurisdiction"), total_usa["n"].alias("total_records"), F.lit("2016-2021").alias("period"),
        F.lit("NAICS").alias("classification"), "top_states")
    eu = eurostat.agg(row_count().alias("total_records")).select(
        F.lit("eu").alias("jurisdiction"), "total_records", F.lit("2010-2022").alias("period"),
        F.lit("NACE").alias("classification"), F.lit(27).alias("countries"))
    quebec = lesions.agg(row_count().alias("n"), flag_count("tms").alias("tms"), flag_count("psy").alias("psy")).select(
        F.lit("quebec").alias("jurisdiction"), F.col("n").alias("total_records"), F.lit("2017-2023").alias("period"),
        F.lit("SCIAN").alias("classification"), percent("tms", "n").alias("tms_rate"),
        percent("psy", "n").alias("psy_rate"))
    return usa.unionByName(eu, allowMissingColumns=True).unionByName(quebec, allowMissingColumns=True)


# -- the warehouse table (A16-A21, A37) ------------------------------------------------

def _fatal() -> Column:
    return F.count_if(F.col("incident_type") == "fatal")


def global_stats(incidents: DataFrame) -> DataFrame:
    """A16; distinct industries by a second group-by, so no key is exploded."""
    keys = ["jurisdiction", "year", "incident_type"]
    pairs = incidents.groupBy(*keys, "industry_code").agg(
        row_count().alias("n"), F.sum("days_lost").alias("days"), F.count("days_lost").alias("with_days"))
    return pairs.groupBy(*keys).agg(
        F.sum("n").alias("incident_count"),
        F.sum(F.when(F.col("incident_type") == "fatal", F.col("n")).otherwise(0)).alias("fatalities"),
        F.try_divide(F.sum("days"), F.sum("with_days")).alias("avg_days_lost"),
        F.count("industry_code").alias("industries_affected"),
    )


def dashboard_summary(incidents: DataFrame) -> DataFrame:
    """A17."""
    by = incidents.groupBy("jurisdiction", "year", "source").agg(row_count().alias("n"), _fatal().alias("fatal"))
    return by.groupBy("jurisdiction").agg(
        F.sum("n").alias("total_incidents"), F.sum("fatal").alias("total_fatalities"),
        F.count_distinct("year").alias("years_covered"), F.min("year").alias("first_year"),
        F.max("year").alias("last_year"), F.count_distinct("source").alias("data_sources"))


def yearly_stats(incidents: DataFrame, jurisdiction: str | None = None) -> DataFrame:
    """A18."""
    rows = incidents if jurisdiction is None else incidents.filter(F.col("jurisdiction") == jurisdiction)
    return rows.groupBy("jurisdiction", "year").agg(
        row_count().alias("incidents"), _fatal().alias("fatalities"), F.round(F.avg("days_lost"), 1).alias("avg_days_lost"))


def health_check(incidents: DataFrame) -> DataFrame:
    """One row of counts and the covered span."""
    by = incidents.groupBy("jurisdiction", "source", "year").agg(row_count().alias("n"))
    return by.agg(
        F.sum("n").alias("total_incidents"), F.count_distinct("jurisdiction").alias("jurisdictions"),
        F.count_distinct("source").alias("sources"), F.make_date(F.min("year"), F.lit(1), F.lit(1)).alias("oldest_incident"),
        F.make_date(F.max("year"), F.lit(12), F.lit(31)).alias("newest_incident"))


def jurisdiction_summary(incidents: DataFrame) -> DataFrame:
    """A21."""
    by = incidents.groupBy("jurisdiction", "year").agg(row_count().alias("n"))
    return by.groupBy("jurisdiction").agg(F.sum("n").alias("incidents"), F.count("year").alias("years"),
                                          F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def distribution(incidents: DataFrame) -> DataFrame:
    """Rows by year and jurisdiction."""
    return incidents.groupBy("year", "jurisdiction").agg(row_count().alias("n"))


# -- pre-aggregated tables (A26-A32) ------------------------------------------------------

def two_table_stats(cnesst: DataFrame, osha: DataFrame) -> DataFrame:
    """A26."""
    us = osha.agg(F.struct(row_count().alias("records"), F.sum("total_cases").alias("cases"),
                           F.sum("total_deaths").alias("deaths")).alias("t")).scalar()
    own = cnesst.agg(row_count().alias("cnesst_records"), F.coalesce(F.sum("nombre_lesions"), F.lit(0)).alias("total_lesions"))
    return own.withColumn("us", us).select(
        "cnesst_records", "total_lesions", F.col("us.records").alias("osha_records"),
        F.coalesce("us.cases", F.lit(0)).alias("total_cases"), F.coalesce("us.deaths", F.lit(0)).alias("total_deaths"),
    ).withColumn("combined_incidents", F.col("total_lesions") + F.col("total_cases"))


def sector_severity(cnesst: DataFrame) -> DataFrame:
    """Sums, and the mean of the rows' own days-per-case ratios."""
    own = F.try_divide(F.col("jours_perdus"), F.col("nombre_lesions"))
    return cnesst.groupBy("scian").agg(
        F.sum("nombre_lesions").alias("total_lesions"), F.sum("jours_perdus").alias("total_jours"),
        F.round(F.avg(own), 2).alias("gravite_moyenne"))


def yearly_totals(cnesst: DataFrame) -> DataFrame:
    """A28."""
    return cnesst.groupBy("annee").agg(F.sum("nombre_lesions").alias("total_lesions"),
                                       F.sum("jours_perdus").alias("total_jours"))


def naics_fatality(osha: DataFrame) -> DataFrame:
    """The fatality rate is a ratio of sums."""
    return osha.groupBy("naics", "industry_description").agg(
        F.sum("total_cases").alias("total_cases"), F.sum("total_deaths").alias("total_deaths"),
        F.sum("days_away").alias("total_days_away"),
    ).withColumn("fatality_rate", ratio("total_deaths", "total_cases", scale=1000))


def paired_extract(cnesst: DataFrame, osha: DataFrame, scian: str, naics: str) -> DataFrame:
    """One sector's yearly cases on both sides, stacked."""
    own = cnesst.filter(F.col("scian") == scian).groupBy(F.col("annee").alias("year"), F.col("genre_accident").alias("event")).agg(
        F.sum("nombre_lesions").alias("cases"), F.sum("jours_perdus").alias("days"))
    us = osha.filter(F.col("naics") == naics).groupBy("year", F.col("industry_description").alias("event")).agg(
        F.sum("total_cases").alias("cases"), F.sum("total_deaths").alias("deaths"))
    return own.withColumn("side", F.lit("cnesst")).unionByName(us.withColumn("side", F.lit("osha")), allowMissingColumns=True)


def sectors_by_injuries(osha: DataFrame) -> DataFrame:
    """The sector table behind A31."""
    return osha.groupBy(F.col("naics").alias("naics_code"), F.col("industry_description").alias("sector_name")).agg(
        F.sum("total_cases").alias("injuries"), F.sum("total_deaths").alias("deaths"))


def most_injuries(sectors: DataFrame, k: int = 20) -> DataFrame:
    """A31, first endpoint."""
    return top_k(sectors, "injuries", k, ["naics_code", "sector_name"])


def most_dangerous(sectors: DataFrame, k: int = 10) -> DataFrame:
    """A31, second endpoint."""
    return top_k(sectors.filter(F.col("deaths") > 0), "deaths", k, ["naics_code", "sector_name"])


def headline_board(sectors: DataFrame, k: int = 10, alert_k: int = 5, alert_above: int = 50000) -> DataFrame:
    """The largest sectors with shortened names; CRITIQUE marks the huge ones among the first few."""
    largest = top_k(sectors, "total_incidents", k, ["sector"])
    first = top_k(sectors, "total_incidents", alert_k, ["sector"]).select(F.col("sector").alias("__s"))
    alert = F.col("__s").isNotNull() & (F.col("total_incidents") > alert_above)
    return largest.join(F.broadcast(first), F.col("sector").eqNullSafe(F.col("__s")), "left").select(
        F.substring("sector", 1, 30).alias("name"), F.col("total_incidents").alias("incidents"), "tms_rate",
        F.when(alert, F.lit("CRITIQUE")).alias("alert"))


def most_frequent_value(lesions: DataFrame, column: str) -> DataFrame:
    """Per sector, the most frequent non-null value."""
    return dominant_values(stacked_counts(lesions, [column]), {column: "valeur"})


def run_report(log: DataFrame) -> DataFrame:
    """Run log -> one summary row."""
    return log.agg(
        row_count().alias("total_sources"), F.count_if(as_col("status") == "success").alias("successful"),
        F.count_if(as_col("status") == "failed").alias("failed"),
        F.coalesce(F.sum("gold_rows"), F.lit(0)).alias("total_rows_ingested"))
