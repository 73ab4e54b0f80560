"""Queries A01-A40."""

from pyspark.sql import functions as F

from harmlens.operators import aggregates as agg
from harmlens.operators import incremental as inc
from harmlens.operators import sql_functions as sf
from harmlens.plans.oracle import flag, percent, ratio
from harmlens.plans.registry import query
from harmlens.workspace import scratch_path

# Thresholds scaled to the fixture, so that every level occurs.
STEPS = ((10400, "CRITIQUE"), (10000, "ÉLEVÉ"), (9500, "MODÉRÉ"))


def level(n: str) -> str:
    whens = " ".join(f"WHEN {n} > {limit} THEN '{label}'" for limit, label in STEPS)
    return f"CASE {whens} ELSE 'FAIBLE' END"


LEVEL = level("n")


@query("a01_sector_year_stats", f"""
SELECT secteur_scian, annee, n AS total_lesions, tms AS lesions_tms, psy AS lesions_psy, covid AS lesions_covid,
  surdite AS lesions_surdite, machine AS lesions_machine, {percent('tms', 'n')} AS pct_tms, {percent('psy', 'n')} AS pct_psy
FROM sector_year""")
def _(t):
    return agg.sector_year_stats(t.lesions)


@query("a02_top_sectors", f"""
SELECT s.secteur_scian, s.n AS total_lesions, {percent('s.n', 'p.n')} AS pct_total, s.tms AS lesions_tms, s.psy AS lesions_psy,
  {percent('s.tms', 's.n')} AS pct_tms, {percent('s.psy', 's.n')} AS pct_psy, s.annee_min, s.annee_max
FROM sector_total s, province p""")
def _(t):
    return agg.top_sectors(t.lesions)


@query("a03_nature_stats", f"""
SELECT nature_lesion, COUNT(*) AS total, {percent('COUNT(*)', '(SELECT n FROM province)')} AS pct_total,
  COUNT(DISTINCT secteur_scian) AS nb_secteurs_touches
FROM lesions GROUP BY 1 ORDER BY total DESC, nature_lesion NULLS FIRST LIMIT 20""")
def _(t):
    return agg.nature_stats(t.lesions)


@query("a04_body_site_stats", f"""
SELECT siege_lesion, COUNT(*) AS total, {percent('COUNT(*)', '(SELECT n FROM province)')} AS pct_total, {flag('tms')} AS avec_tms
FROM lesions GROUP BY 1 ORDER BY total DESC, siege_lesion NULLS FIRST LIMIT 20""")
def _(t):
    return agg.body_site_stats(t.lesions)


@query("a05_agent_stats", f"""
SELECT agent_causal_lesion AS agent_causal, COUNT(*) AS total, {percent('COUNT(*)', '(SELECT n FROM province)')} AS pct_total
FROM lesions GROUP BY 1 ORDER BY total DESC, agent_causal NULLS FIRST LIMIT 20""")
def _(t):
    return agg.agent_stats(t.lesions)


@query("a06_accident_type_stats", f"""
SELECT genre AS genre_accident, COUNT(*) AS total, {percent('COUNT(*)', '(SELECT n FROM province)')} AS pct_total
FROM lesions GROUP BY 1 ORDER BY total DESC, genre NULLS FIRST LIMIT 20""")
def _(t):
    return agg.accident_type_stats(t.lesions)


@query("a07_demographics", f"""
SELECT sexe_pers_phys AS sexe, groupe_age, COUNT(*) AS total, {percent('COUNT(*)', '(SELECT n FROM province)')} AS pct_total,
  {flag('tms')} AS lesions_tms, {flag('psy')} AS lesions_psy FROM lesions GROUP BY 1, 2""")
def _(t):
    return agg.demographics(t.lesions)


@query("a08_year_trends", f"""
SELECT annee, COUNT(*) AS total_lesions, {flag('tms')} AS tms, {flag('psy')} AS psy, {flag('covid')} AS covid,
  {percent(flag('tms'), 'COUNT(*)')} AS pct_tms, {percent(flag('psy'), 'COUNT(*)')} AS pct_psy FROM lesions GROUP BY 1""")
def _(t):
    return agg.year_trends(t.lesions)


@query("a09_sector_risk_profile", f"""
SELECT s.secteur_scian, s.n AS total_lesions, {percent('s.n', 'p.n')} AS pct_total_qc, s.pct_tms AS risk_tms_pct,
  s.pct_psy AS risk_psy_pct, s.pct_machine AS risk_machine_pct, s.pct_surdite AS risk_surdite_pct,
  ROUND(ln(s.n + 1) / ln((SELECT MAX(n) FROM sector_total) + 1) * 40 + CAST(s.tms AS DOUBLE) / s.n * 30
    + CAST(s.psy AS DOUBLE) / s.n * 30, 1) AS risk_score, {level('s.n')} AS risk_level
FROM sector_rate s, province p""")
def _(t):
    return agg.sector_risk_profile(t.lesions, STEPS)


@query("a10_state_stats", f"""
SELECT state AS etat, COUNT(*) AS total_incidents, {percent('COUNT(*)', '(SELECT COUNT(*) FROM osha_raw)')} AS pct_total
FROM osha_raw WHERE state IS NOT NULL GROUP BY 1""")
def _(t):
    return agg.state_stats(t.osha_raw)


@query("a11_industry_stats", f"""
SELECT naics_code, industry_description, COUNT(*) AS total_incidents,
  {percent('COUNT(*)', '(SELECT COUNT(*) FROM osha_raw)')} AS pct_total
FROM osha_raw WHERE naics_code IS NOT NULL GROUP BY 1, 2
ORDER BY total_incidents DESC, naics_code, industry_description LIMIT 50""")
def _(t):
    return agg.industry_stats(t.osha_raw)


SUMMARY_SQL = """
SELECT 'OSHA USA' AS source, '🇺🇸' AS flag, (SELECT COUNT(*) FROM osha_raw) AS total_records, '2016-2021' AS periode, 'NAICS' AS classification
UNION ALL SELECT 'Eurostat EU-27', '🇪🇺', (SELECT COUNT(*) FROM esaw), '2010-2022', 'NACE'
UNION ALL SELECT 'CNESST Québec', '🇨🇦', (SELECT COUNT(*) FROM lesions), '2017-2023', 'SCIAN'"""


@query("a12_source_summary", SUMMARY_SQL)
def _(t):
    return agg.source_summary(t.osha_raw, t.esaw, t.lesions)


@query("a13_total_records", """
SELECT o + e + c AS total_global, o AS osha_usa, e AS eurostat_eu, c AS cnesst_qc FROM (SELECT
  (SELECT COUNT(*) FROM osha_raw) AS o, (SELECT COUNT(*) FROM esaw) AS e, (SELECT COUNT(*) FROM lesions) AS c)""")
def _(t):
    return agg.total_records(t.osha_raw, t.esaw, t.lesions)


def mode_sql(column: str, keep_null: bool) -> str:
    where = "" if keep_null else f"WHERE {column} IS NOT NULL"
    return f"""SELECT secteur_scian, {column} AS v FROM (SELECT secteur_scian, {column}, ROW_NUMBER() OVER
      (PARTITION BY secteur_scian ORDER BY COUNT(*) DESC, {column} NULLS FIRST) AS rn
      FROM lesions {where} GROUP BY 1, 2) WHERE rn = 1"""


@query("a14_sector_profile_exact", f"""
SELECT s.secteur_scian AS secteur, s.n AS total_lesions, {percent('s.n', 'p.n')} AS pct_total, s.pct_tms AS risk_tms,
  s.pct_psy AS risk_psy, {level('s.n')} AS risk_level, a.v AS top_nature, b.v AS top_siege, c.v AS top_agent
FROM sector_rate s, province p, mode_nature a, mode_siege b, mode_agent c
WHERE a.secteur_scian = s.secteur_scian AND b.secteur_scian = s.secteur_scian AND c.secteur_scian = s.secteur_scian""",
       mode_nature=mode_sql("nature_lesion", True), mode_siege=mode_sql("siege_lesion", True),
       mode_agent=mode_sql("agent_causal_lesion", True))
def _(t):
    return agg.sector_profile_exact(t.lesions, steps=STEPS)


@query("a15_compare_to_province", """
SELECT s.secteur_scian AS secteur, s.pct_psy AS taux_secteur, p.pct_psy AS taux_provincial,
  ROUND(s.pct_psy - p.pct_psy, 2) AS ecart,
  CASE WHEN s.pct_psy > p.pct_psy * CAST(1.2 AS DOUBLE) THEN '⚠️ AU-DESSUS (+20%)'
       WHEN s.pct_psy < p.pct_psy * CAST(0.8 AS DOUBLE) THEN '✅ EN-DESSOUS (-20%)' ELSE '➡️ DANS LA MOYENNE' END AS statut
FROM sector_rate s, province_rate p""")
def _(t):
    return agg.compare_to_province(t.lesions, "PSY")


WANTED = "(SELECT DISTINCT secteur_scian AS secteur FROM {lesions})"


@query("a14_sql_function", same_as="a14_sector_profile_exact")
def _(t):
    sf.register_functions(t.lesions, steps=STEPS)
    return t.spark.sql(f"SELECT p.* FROM {WANTED} w, LATERAL {sf.PROFILE_FUNCTION}(w.secteur) p", lesions=t.lesions)


@query("a15_sql_function", " UNION ALL ".join(f"""
SELECT s.secteur_scian AS secteur, '{flag.upper()}' AS indicateur, s.pct_{flag} AS taux_secteur, p.pct_{flag} AS taux_provincial,
  ROUND(s.pct_{flag} - p.pct_{flag}, 2) AS ecart,
  CASE WHEN s.pct_{flag} > p.pct_{flag} * CAST(1.2 AS DOUBLE) THEN '⚠️ AU-DESSUS (+20%)'
       WHEN s.pct_{flag} < p.pct_{flag} * CAST(0.8 AS DOUBLE) THEN '✅ EN-DESSOUS (-20%)' ELSE '➡️ DANS LA MOYENNE' END AS statut
FROM sector_rate s, province_rate p""" for flag in ("tms", "psy", "machine", "surdite")))
def _(t):
    sf.register_functions(t.lesions)
    wanted = f"SELECT secteur, indicateur FROM {WANTED} LATERAL VIEW explode(array('TMS', 'PSY', 'MACHINE', 'SURDITE')) AS indicateur"
    return t.spark.sql(f"SELECT p.*, w.indicateur FROM ({wanted}) w, LATERAL {sf.COMPARE_FUNCTION}(w.secteur, w.indicateur) p", lesions=t.lesions)


@query("a16_global_stats", """
SELECT jurisdiction, year, incident_type, COUNT(*) AS incident_count,
  CAST(COUNT(*) FILTER (WHERE incident_type = 'fatal') AS BIGINT) AS fatalities, AVG(days_lost) AS avg_days_lost,
  COUNT(DISTINCT industry_code) AS industries_affected FROM incidents_global GROUP BY 1, 2, 3""")
def _(t):
    return agg.global_stats(t.incidents_global)


@query("a17_dashboard_summary", """
SELECT jurisdiction, COUNT(*) AS total_incidents, CAST(COUNT(*) FILTER (WHERE incident_type = 'fatal') AS BIGINT) AS total_fatalities,
  COUNT(DISTINCT year) AS years_covered, MIN(year) AS first_year, MAX(year) AS last_year, COUNT(DISTINCT source) AS data_sources
FROM incidents_global GROUP BY 1""")
def _(t):
    return agg.dashboard_summary(t.incidents_global)


@query("a18_yearly_stats", """
SELECT jurisdiction, year, COUNT(*) AS incidents, CAST(COUNT(*) FILTER (WHERE incident_type = 'fatal') AS BIGINT) AS fatalities,
  ROUND(AVG(days_lost), 1) AS avg_days_lost FROM incidents_global GROUP BY 1, 2""")
def _(t):
    return agg.yearly_stats(t.incidents_global)


@query("a19_health_check", """
SELECT COUNT(*) AS total_incidents, COUNT(DISTINCT jurisdiction) AS jurisdictions, COUNT(DISTINCT source) AS sources,
  make_date(MIN(year), 1, 1) AS oldest_incident, make_date(MAX(year), 12, 31) AS newest_incident FROM incidents_global""")
def _(t):
    return agg.health_check(t.incidents_global)


@query("a21_jurisdiction_summary", """
SELECT jurisdiction, COUNT(*) AS incidents, COUNT(DISTINCT year) AS years, MIN(year) AS first_year, MAX(year) AS last_year
FROM incidents_global GROUP BY 1""")
def _(t):
    return agg.jurisdiction_summary(t.incidents_global)


@query("a22_sector_and_year_totals", """
SELECT 'secteur' AS vue, secteur_scian AS cle, COUNT(*) AS total FROM lesions GROUP BY 2
UNION ALL SELECT 'annee', CAST(annee AS STRING), COUNT(*) FROM lesions GROUP BY 2""")
def _(t):
    sectors = agg.totals(t.lesions, "secteur_scian", "cle").withColumn("vue", F.lit("secteur"))
    years = agg.totals(t.lesions, "annee", "cle").withColumn("cle", F.col("cle").cast("string"))
    return sectors.unionByName(years.withColumn("vue", F.lit("annee")))


@query("a23_coverage", """
SELECT (SELECT COUNT(*) FROM lesions) AS qc, (SELECT COUNT(*) FROM osha_raw) AS usa, (SELECT COUNT(*) FROM esaw) AS eu27,
  (SELECT COUNT(*) FROM lesions) + (SELECT COUNT(*) FROM osha_raw) + (SELECT COUNT(*) FROM esaw) AS total_incidents,
  (SELECT string_agg(CAST(annee AS STRING), ',' ORDER BY annee) FROM (SELECT DISTINCT annee FROM lesions)) AS years_covered""")
def _(t):
    out = agg.coverage(t.osha_raw, t.esaw, t.lesions)
    return out.withColumn("years_covered", F.array_join(F.col("years_covered").cast("array<string>"), ","))


@query("a24_sector_list", """
SELECT secteur_scian AS sector, n AS total_incidents, tms AS tms_count, psy AS psy_count, pct_tms AS tms_rate, pct_psy AS psy_rate
FROM sector_rate WHERE secteur_scian IS NOT NULL""")
def _(t):
    return agg.sector_list(t.lesions)


@query("a25_sector_detail", f"""
SELECT 'm' AS sector, annee AS year, COUNT(*) AS incidents, {flag('tms')} AS tms, {flag('psy')} AS psy,
  (SELECT COUNT(*) FROM lesions WHERE secteur_scian ILIKE '%m%') AS total_incidents
FROM lesions WHERE secteur_scian ILIKE '%m%' GROUP BY 2""")
def _(t):
    return agg.sector_detail(t.lesions, "m")


@query("a26_two_table_stats", """
SELECT c.cnesst_records, c.total_lesions, o.osha_records, o.total_cases, o.total_deaths,
  c.total_lesions + o.total_cases AS combined_incidents
FROM (SELECT COUNT(*) AS cnesst_records, CAST(SUM(nombre_lesions) AS BIGINT) AS total_lesions FROM cnesst_lesions) c,
  (SELECT COUNT(*) AS osha_records, CAST(SUM(total_cases) AS BIGINT) AS total_cases,
    CAST(SUM(total_deaths) AS BIGINT) AS total_deaths FROM osha_injuries) o""")
def _(t):
    return agg.two_table_stats(t.cnesst_lesions, t.osha_injuries)


SEVERITY_SQL = """
SELECT scian, CAST(SUM(nombre_lesions) AS BIGINT) AS total_lesions, CAST(SUM(jours_perdus) AS BIGINT) AS total_jours,
  ROUND(AVG(CAST(jours_perdus AS DOUBLE) / NULLIF(nombre_lesions, 0)), 2) AS gravite_moyenne FROM cnesst_lesions GROUP BY 1"""


@query("a27_sector_severity", SEVERITY_SQL)
def _(t):
    return agg.sector_severity(t.cnesst_lesions)


@query("a28_yearly_totals", """
SELECT annee, CAST(SUM(nombre_lesions) AS BIGINT) AS total_lesions, CAST(SUM(jours_perdus) AS BIGINT) AS total_jours
FROM cnesst_lesions GROUP BY 1""")
def _(t):
    return agg.yearly_totals(t.cnesst_lesions)


@query("a29_naics_fatality", f"""
SELECT naics, industry_description, CAST(SUM(total_cases) AS BIGINT) AS total_cases, CAST(SUM(total_deaths) AS BIGINT) AS total_deaths,
  CAST(SUM(days_away) AS BIGINT) AS total_days_away, {ratio('SUM(total_deaths)', 'SUM(total_cases)', 1000, 2)} AS fatality_rate
FROM osha_injuries GROUP BY 1, 2""")
def _(t):
    return agg.naics_fatality(t.osha_injuries)


@query("a30_paired_extract", """
SELECT 'cnesst' AS side, annee AS year, genre_accident AS event, CAST(SUM(nombre_lesions) AS BIGINT) AS cases,
  CAST(SUM(jours_perdus) AS BIGINT) AS days, CAST(NULL AS BIGINT) AS deaths
FROM cnesst_lesions WHERE scian = '62' GROUP BY 2, 3
UNION ALL SELECT 'osha', year, industry_description, CAST(SUM(total_cases) AS BIGINT), NULL, CAST(SUM(total_deaths) AS BIGINT)
FROM osha_injuries WHERE naics = '62' GROUP BY 2, 3""")
def _(t):
    return agg.paired_extract(t.cnesst_lesions, t.osha_injuries, "62", "62")


OSHA_SECTORS = """SELECT naics AS naics_code, industry_description AS sector_name, CAST(SUM(total_cases) AS BIGINT) AS injuries,
  CAST(SUM(total_deaths) AS BIGINT) AS deaths FROM osha_injuries GROUP BY 1, 2"""


@query("a31_sectors_by_injuries", """
SELECT 'injuries' AS board, * FROM (SELECT * FROM osha_sectors ORDER BY injuries DESC, naics_code, sector_name LIMIT 20)
UNION ALL SELECT 'dangerous', * FROM (SELECT * FROM osha_sectors WHERE deaths > 0 ORDER BY deaths DESC, naics_code, sector_name LIMIT 10)""",
       osha_sectors=OSHA_SECTORS)
def _(t):
    sectors = agg.sectors_by_injuries(t.osha_injuries)
    return agg.most_injuries(sectors).withColumn("board", F.lit("injuries")).unionByName(
        agg.most_dangerous(sectors).withColumn("board", F.lit("dangerous")))


@query("a32_headline_board", """
SELECT substr(secteur_scian, 1, 30) AS name, n AS incidents, pct_tms AS tms_rate,
  CASE WHEN rn <= 3 AND n > 9800 THEN 'CRITIQUE' END AS alert
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY n DESC, secteur_scian) AS rn FROM sector_rate) WHERE rn <= 5""")
def _(t):
    return agg.headline_board(agg.sector_list(t.lesions), k=5, alert_k=3, alert_above=9800)


@query("a33_jurisdiction_comparison", """
SELECT 'usa' AS jurisdiction, (SELECT COUNT(*) FROM osha_raw) AS total_records, '2016-2021' AS period, 'NAICS' AS classification,
  (SELECT string_agg(state, '|' ORDER BY n DESC, state) FROM (SELECT state, COUNT(*) AS n FROM osha_raw WHERE state IS NOT NULL
    GROUP BY 1 ORDER BY n DESC, state LIMIT 5)) AS top_states, CAST(NULL AS INT) AS countries,
  CAST(NULL AS DOUBLE) AS tms_rate, CAST(NULL AS DOUBLE) AS psy_rate
UNION ALL SELECT 'eu', (SELECT COUNT(*) FROM esaw), '2010-2022', 'NACE', NULL, 27, NULL, NULL
UNION ALL SELECT 'quebec', n, '2017-2023', 'SCIAN', NULL, NULL, pct_tms, pct_psy FROM province_rate""")
def _(t):
    out = agg.jurisdiction_comparison(t.osha_raw, t.esaw, t.lesions)
    return out.withColumn("top_states", F.array_join("top_states", "|"))


@query("a34_country_totals", """
SELECT country_code AS country, country_name, COUNT(*) AS total, CAST(SUM(TRY_CAST(incident_count AS BIGINT)) AS BIGINT) AS incidents
FROM esaw WHERE country_code IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return agg.country_totals(t.esaw)


@query("a35_sector_year_graph_stats", f"""
SELECT secteur_scian AS secteur, annee, n AS total, tms, psy, machine, {percent('tms', 'n')} AS tms_rate
FROM sector_year WHERE secteur_scian IS NOT NULL""")
def _(t):
    return agg.sector_year_graph_stats(t.lesions)


@query("a36_top_states", """
SELECT state, COUNT(*) AS total FROM osha_raw WHERE state IS NOT NULL GROUP BY 1 ORDER BY total DESC, state LIMIT 50""")
def _(t):
    return agg.top_states(t.osha_raw)


@query("a37_distribution", "SELECT year, jurisdiction, COUNT(*) AS n FROM incidents_global GROUP BY 1, 2")
def _(t):
    return agg.distribution(t.incidents_global)


@query("a38_most_frequent_value", "SELECT secteur_scian, v AS valeur FROM mode_agent",
       mode_agent=mode_sql("agent_causal_lesion", False))
def _(t):
    return agg.most_frequent_value(t.lesions, "agent_causal_lesion")


@query("a39_table_counts", """
SELECT (SELECT COUNT(*) FROM osha_raw) AS osha_usa, (SELECT COUNT(*) FROM esaw) AS eurostat_eu, (SELECT COUNT(*) FROM lesions) AS cnesst_qc""")
def _(t):
    return agg.table_counts(t.osha_raw, t.esaw, t.lesions)


# -- the same statistics from the state of ingest batches ------------------------------------

def batch_state(t, more=None):
    """State after three batches of incidents, and one of further rows."""
    root = scratch_path(t.spark, "statistics")
    for batch in range(3):
        inc.apply_batch(t.incidents_global.filter(F.col("year") % 3 == batch), root, str(batch))
    if more is not None:
        inc.apply_batch(more, root, "more")
    return root


@query("a16_incremental", same_as="a16_global_stats")
def _(t):
    return inc.global_stats(t.spark, batch_state(t))


@query("a17_incremental", same_as="a17_dashboard_summary")
def _(t):
    return inc.dashboard_summary(t.spark, batch_state(t))


@query("a18_incremental", same_as="a18_yearly_stats")
def _(t):
    return inc.yearly_stats(t.spark, batch_state(t))


@query("a19_incremental", same_as="a19_health_check")
def _(t):
    return inc.health_check(t.spark, batch_state(t))


@query("a23_incremental", same_as="a23_coverage")
def _(t):
    europe = t.esaw.select(F.lit("ESAW").alias("source"), F.lit("EU27").alias("jurisdiction"), "year", F.col("deviation").alias("industry_code"),
                           F.lit("non-fatal").alias("incident_type"), F.lit(None).cast("double").alias("days_lost"))
    out = inc.coverage(t.spark, batch_state(t, europe))
    return out.withColumn("years_covered", F.array_join(F.col("years_covered").cast("array<string>"), ","))
