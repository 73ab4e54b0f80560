"""Queries F27-F43, J07-J09, O04, D01-D05: advice, features and text rules."""

from pyspark.sql import functions as F

from harmlens.operators import advisors as adv
from harmlens.operators import aggregates as agg
from harmlens.operators import enrichment as enr
from harmlens.operators import features as feat
from harmlens.operators import outlook as out
from harmlens.operators import text_rules as txt
from harmlens.operators import windows as win
from harmlens.plans.oracle import ratio
from harmlens.plans.q_aggregates import SEVERITY_SQL
from harmlens.plans.q_sectors import FIT, FORECAST
from harmlens.plans.registry import query

CASES = "SELECT scian AS sector, CAST(SUM(nombre_lesions) AS BIGINT) AS cases, CAST(SUM(jours_perdus) AS BIGINT) AS days FROM cnesst_lesions GROUP BY 1"
COMPARE = f"""SELECT sector, qc_cases, qc_days, us_cases, us_deaths, us_days, {ratio('us_cases', 'GREATEST(1, qc_cases)')} AS ratio_usa_qc FROM (
  SELECT COALESCE(q.sector, u.naics) AS sector, COALESCE(q.cases, 0) AS qc_cases, COALESCE(q.days, 0) AS qc_days, COALESCE(u.c, 0) AS us_cases,
    COALESCE(u.d, 0) AS us_deaths, COALESCE(u.y, 0) AS us_days
  FROM (SELECT x.sector, x.cases, x.days, COALESCE(d.naics, x.sector) AS naics FROM case_sums x LEFT JOIN dim_scian_naics d ON d.scian = x.sector) q
  FULL JOIN (SELECT naics, CAST(SUM(total_cases) AS BIGINT) AS c, CAST(SUM(total_deaths) AS BIGINT) AS d, CAST(SUM(days_away) AS BIGINT) AS y
    FROM osha_injuries GROUP BY 1) u ON u.naics = q.naics)"""
RISK = """SELECT sector, cases, days, CASE WHEN cases > 50000 OR sev > 8 THEN 'CRITICAL' WHEN cases > 20000 OR sev > 6 THEN 'HIGH'
    WHEN cases > 5000 OR sev > 4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  ROUND(CASE WHEN cases > 50000 OR sev > 8 THEN 90 + LEAST(10, sev) WHEN cases > 20000 OR sev > 6 THEN 70 + LEAST(20, sev * 2)
    WHEN cases > 5000 OR sev > 4 THEN 40 + LEAST(30, sev * 3) ELSE 10 + LEAST(30, sev * 4) END, 2) AS score,
  COALESCE(NULLIF(concat_ws('|', CASE WHEN sev > 6 THEN 'High severity per incident' END, CASE WHEN cases > 10000 THEN 'High incident volume' END,
    CASE WHEN sector IN ('23', '21', '221122') THEN 'Inherently hazardous industry' END), ''), 'Standard risk profile') AS factors
FROM (SELECT *, CAST(days AS DOUBLE) / GREATEST(1, cases) AS sev FROM case_sums)"""
SECTOR_RISKS = """SELECT c.sector, r.risk_ord, r.risk_type FROM case_sums c JOIN dim_sector_risk r ON r.sector = c.sector
UNION ALL SELECT c.sector, v.o, v.r FROM case_sums c, (VALUES (1, 'TMS'), (2, 'CHUTE')) v(o, r) WHERE c.sector NOT IN (SELECT sector FROM dim_sector_risk)"""
REMEDIES = """SELECT *, ROW_NUMBER() OVER (PARTITION BY sector ORDER BY roi DESC, risk_ord, ord) AS rank FROM (
  SELECT r.sector, r.risk_ord, s.ord, r.risk_type, s.id, s.solution, s.efficacite, s.cout,
    CAST(trunc((s.efficacite * 10 * 50000 - s.cout) / GREATEST(1, s.cout) * 100) AS BIGINT) AS roi
  FROM sector_risks r JOIN dim_solution s ON s.risk_type = r.risk_type)"""
STATUSES = """SELECT DISTINCT scian AS sector, CASE genre_accident WHEN '31' THEN 'RSST-312' WHEN '51' THEN 'RSST-51' WHEN '52' THEN 'RSST-166'
    WHEN '50' THEN 'ISO-45001' ELSE 'LSST-51' END AS code, 'A VERIFIER' AS status FROM cnesst_lesions WHERE jours_perdus % 7 = 1 AND annee >= 2022"""
APPLICABLE = "SELECT DISTINCT c.sector, r.source, r.code, r.titre FROM case_sums c JOIN dim_regulation r ON r.sector = c.sector OR r.sector = '*'"
AUDIT = f"""SELECT sector, checked AS regulations_checked, bad AS non_conformites, {ratio('checked - bad', 'GREATEST(1, checked)', 100, 1)} AS score_conformite FROM (
  SELECT a.sector, COUNT(*) AS checked, COUNT(s.code) AS bad FROM applicable a LEFT JOIN statuses s ON s.sector = a.sector AND s.code = a.code GROUP BY 1)"""
POSITION = f"""SELECT scian AS sector, g AS gravite_moyenne, p AS percentile, CASE WHEN p > 50 THEN 'Top ' || CAST(100 - p AS STRING) || '%' ELSE 'Bottom ' || CAST(p AS STRING) || '%' END AS rank
FROM (SELECT scian, gravite_moyenne AS g, CASE WHEN gravite_moyenne < 4 THEN 75 WHEN gravite_moyenne < 6 THEN 50 WHEN gravite_moyenne < 8 THEN 30 ELSE 15 END AS p
  FROM ({SEVERITY_SQL}))"""
PARTS = {"case_sums": CASES, "compared": COMPARE, "risk": RISK, "sector_risks": SECTOR_RISKS, "remedy_rows": REMEDIES, "statuses": STATUSES,
         "applicable": APPLICABLE, "audit_rows": AUDIT, "positions": POSITION}


def statuses(t):
    code = (F.when(F.col("genre_accident") == "31", "RSST-312").when(F.col("genre_accident") == "51", "RSST-51")
            .when(F.col("genre_accident") == "52", "RSST-166").when(F.col("genre_accident") == "50", "ISO-45001").otherwise("LSST-51"))
    rows = t.cnesst_lesions.filter((F.col("jours_perdus") % 7 == 1) & (F.col("annee") >= 2022))
    return rows.select(F.col("scian").alias("sector"), code.alias("code"), F.lit("A VERIFIER").alias("status"))


def sectors(t):
    return adv.case_totals(t.cnesst_lesions).select("sector")


@query("j07_compare_jurisdictions", "SELECT * FROM compared", **PARTS)
def _(t):
    return adv.compare_jurisdictions(t.cnesst_lesions, t.osha_injuries)


@query("j08_sector_risks", "SELECT sector, CAST(risk_ord AS INT) - 1 AS risk_ord, risk_type FROM sector_risks", **PARTS)
def _(t):
    return adv.sector_risks(sectors(t))


@query("j09_applicable_regulations", "SELECT * FROM applicable", **PARTS)
def _(t):
    return adv.applicable_regulations(sectors(t))


@query("f27_severity_risk", "SELECT * FROM risk", **PARTS)
def _(t):
    return adv.severity_risk(adv.case_totals(t.cnesst_lesions)).withColumn("factors", F.array_join("factors", "|"))


@query("f28_patterns", """
SELECT sector, cases, days, cases > 0 AND days > cases * 7 AS high_severity, CASE WHEN cases > 10000 THEN 'TMS' ELSE 'Chutes' END AS dominant_risk FROM case_sums""", **PARTS)
def _(t):
    return adv.patterns(adv.case_totals(t.cnesst_lesions))


@query("f28_row_anomalies", "SELECT * FROM cnesst_lesions WHERE CAST(jours_perdus AS DOUBLE) / NULLIF(nombre_lesions, 0) > 12")
def _(t):
    return adv.row_anomalies(t.cnesst_lesions, 12)


SECTOR_PAIR = """SELECT scian, MAX(CASE WHEN r = 1 THEN n END) AS recent, MAX(CASE WHEN r = 2 THEN n END) AS previous FROM (
  SELECT scian, annee, CAST(SUM(nombre_lesions) AS BIGINT) AS n, ROW_NUMBER() OVER (PARTITION BY scian ORDER BY annee DESC) AS r FROM cnesst_lesions GROUP BY 1, 2)
  WHERE r <= 2 GROUP BY 1"""


@query("f29_projection", """
SELECT scian, recent, previous, CASE WHEN c > 5 THEN 'increasing' WHEN c < -5 THEN 'decreasing' ELSE 'stable' END AS trend, ROUND(c, 2) AS change_pct,
  CAST(trunc(recent * (1 + c / 200)) AS BIGINT) AS projected_cases_6m
FROM (SELECT *, CAST(recent - previous AS DOUBLE) / GREATEST(1, previous) * 100 AS c FROM pair)""", pair=SECTOR_PAIR)
def _(t):
    series = t.cnesst_lesions.groupBy("scian", "annee").agg(F.sum("nombre_lesions").alias("n"))
    return adv.projection(win.latest_two(series, ["scian"], "annee", "n"))


@query("f30_remedy_plan", """
SELECT sector, string_agg(id, '|' ORDER BY rank) FILTER (WHERE rank <= 5) AS solutions, MAX(roi) AS best_roi,
  CAST(SUM(cout) FILTER (WHERE rank <= 5) AS BIGINT) AS total_investment,
  ROUND(SUM(efficacite) FILTER (WHERE rank <= 3) / 3 * 100, 1) AS expected_reduction FROM remedy_rows GROUP BY 1""", **PARTS)
def _(t):
    return adv.remedy_plan(adv.remedies(sectors(t))).withColumn("solutions", F.array_join("solutions", "|"))


@query("o04_rank_solutions", "SELECT sector, risk_type, id, solution, efficacite, cout, roi, CAST(rank AS INT) AS rank FROM remedy_rows", **PARTS)
def _(t):
    return adv.remedies(sectors(t)).drop("risk_ord", "ord")


@query("f31_audit", "SELECT * FROM audit_rows", **PARTS)
def _(t):
    return adv.audit(sectors(t), statuses(t))


@query("f32_positioning", "SELECT * FROM positions", **PARTS)
def _(t):
    return adv.positioning(t.cnesst_lesions)


@query("d03_peer_rank", f"""
SELECT scian, gravite_moyenne, ROUND(percent_rank() OVER (ORDER BY gravite_moyenne DESC) * 100, 1) AS better_than_pct FROM ({SEVERITY_SQL})""")
def _(t):
    return adv.peer_rank(agg.sector_severity(t.cnesst_lesions))


@query("f33_advice_board", """
SELECT sector, 'analyse' AS analyse, 'ALERTE: Gravite elevee detectee dans secteur ' || sector AS recommandation FROM case_sums WHERE days > cases * 7
UNION ALL SELECT sector, 'prediction', CASE risk_level WHEN 'CRITICAL' THEN 'ACTION IMMEDIATE: Audit de securite requis'
  WHEN 'HIGH' THEN 'Planifier revue des procedures dans 60 jours' ELSE 'Maintenir surveillance standard' END FROM risk WHERE risk_level <> 'LOW'
UNION ALL SELECT sector, 'recommandation', 'Top solution: ' || solution || ' (ROI: ' || CAST(roi AS STRING) || '%)' FROM remedy_rows WHERE rank = 1
UNION ALL SELECT sector, 'conformite', CASE WHEN non_conformites > 0 THEN 'ATTENTION: ' || CAST(non_conformites AS STRING) || ' element(s) a verifier'
  WHEN score_conformite < 80 THEN 'Score critique - plan d''action immediat requis' ELSE 'Maintenir veille reglementaire trimestrielle' END FROM audit_rows
UNION ALL SELECT sector, 'benchmarking', CASE WHEN percentile > 75 THEN 'Performance superieure a 75% des secteurs'
  WHEN percentile < 25 THEN 'Performance dans le quartile inferieur' ELSE 'Performance dans la moyenne sectorielle' END FROM positions""", **PARTS)
def _(t):
    return adv.advice_board(t.cnesst_lesions, statuses(t))


@query("f43_sector_digest", """
SELECT r.sector, (SELECT COUNT(*) FROM cnesst_lesions c WHERE c.scian = r.sector) AS records, x.ratio_usa_qc, r.risk_level, r.score,
  (SELECT CAST(SUM(nombre_lesions) AS BIGINT) FROM cnesst_lesions) + (SELECT CAST(SUM(total_cases) AS BIGINT) FROM osha_injuries) AS combined_incidents
FROM risk r JOIN compared x ON x.sector = r.sector""", **PARTS)
def _(t):
    return adv.sector_digest(t.cnesst_lesions, t.osha_injuries)


# -- features and models ------------------------------------------------------------

FEATURE_INPUT = """SELECT 'CNESST' AS source, annee AS year, scian AS sector, CAST(SUM(nombre_lesions) AS BIGINT) AS total_cases,
  CAST(SUM(jours_perdus) AS BIGINT) AS days_lost, CAST(0 AS BIGINT) AS total_deaths FROM cnesst_lesions GROUP BY 2, 3
UNION ALL SELECT 'OSHA', year, naics, CAST(SUM(total_cases) AS BIGINT), CAST(SUM(days_away) AS BIGINT), CAST(SUM(total_deaths) AS BIGINT) FROM osha_injuries GROUP BY 2, 3"""
FEATURES = f"""SELECT source, year, sector, GREATEST(1, total_cases) AS total_cases, days_lost, total_deaths, {ratio('days_lost', 'GREATEST(1, total_cases)')} AS days_per_case,
  {ratio('total_deaths', 'GREATEST(1, total_cases)', 1000, 4)} AS fatality_rate,
  ROUND(LEAST(50, total_deaths * CAST(0.5 AS DOUBLE)) + LEAST(30, CAST(days_lost AS DOUBLE) / GREATEST(1, total_cases) * 3)
    + LEAST(20, CAST(GREATEST(1, total_cases) AS DOUBLE) / 1000), 2) AS severity_score,
  CASE WHEN total_deaths > 50 OR total_cases > 50000 THEN 'CRITICAL' WHEN total_deaths > 20 OR total_cases > 20000 THEN 'HIGH'
    WHEN total_deaths > 5 OR total_cases > 5000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category FROM feature_input"""
FPARTS = {"feature_input": FEATURE_INPUT, "features": FEATURES}


def feature_input(t):
    own = t.cnesst_lesions.groupBy(F.col("annee").alias("year"), F.col("scian").alias("sector")).agg(
        F.sum("nombre_lesions").alias("total_cases"), F.sum("jours_perdus").alias("days_lost")).withColumns(
        {"source": F.lit("CNESST"), "total_deaths": F.lit(0).cast("bigint")})
    us = t.osha_injuries.groupBy("year", F.col("naics").alias("sector")).agg(
        F.sum("total_cases").alias("total_cases"), F.sum("days_away").alias("days_lost"), F.sum("total_deaths").alias("total_deaths"))
    return own.unionByName(us.withColumn("source", F.lit("OSHA")))


@query("f34_derive_features", "SELECT * FROM features", **FPARTS)
def _(t):
    return feat.derive_features(feature_input(t))


@query("f35_feature_vector", """
SELECT source, year, sector, concat_ws(',', CAST(CAST(year AS DOUBLE) AS STRING), CAST(CAST(total_cases AS DOUBLE) AS STRING), CAST(CAST(days_lost AS DOUBLE) AS STRING),
  CAST(CAST(total_deaths AS DOUBLE) AS STRING), CAST(days_per_case AS STRING), CAST(fatality_rate AS STRING), CAST(severity_score AS STRING)) AS vector FROM features""", **FPARTS)
def _(t):
    rows = feat.feature_vector(feat.derive_features(feature_input(t)))
    return rows.select("source", "year", "sector", F.array_join(F.col("vector").cast("array<string>"), ",").alias("vector"))


DEATHS = 60  # the fixture's deaths are 0 or 1 a row; the rules' limits are not


def establishment_features(t):
    """One feature row per establishment and year."""
    rows = t.osha_raw.groupBy("establishment_name", F.col("year_filing_for").alias("year")).agg(
        F.sum("total_injuries").alias("total_cases"), F.sum("days_away").alias("days_lost"), F.sum(F.col("total_deaths") * DEATHS).alias("total_deaths"))
    return feat.derive_features(rows)


ESTABLISHMENTS = f"""SELECT *, CAST('0x' || substr(md5(establishment_name || '|' || CAST(year AS STRING)), 1, 8) AS BIGINT) % 1000 < 800 AS train,
  CASE WHEN deaths > 50 OR cases > 50000 THEN 'CRITICAL' WHEN deaths > 20 OR cases > 20000 THEN 'HIGH' WHEN deaths > 5 OR cases > 5000 THEN 'MEDIUM' ELSE 'LOW' END AS category
FROM (SELECT establishment_name, year_filing_for AS year, SUM(total_deaths) * {DEATHS} AS deaths, SUM(total_injuries) AS cases FROM osha_raw GROUP BY 1, 2)"""
SPLIT_SQL = "COUNT(*) FILTER (WHERE train) AS train_rows, COUNT(*) FILTER (WHERE NOT train) AS test_rows, COUNT(*) FILTER (WHERE NOT train) AS scored"
ESTABLISHMENT_KEY = ("establishment_name", "year")


@query("f36_classify_high_risk", f"SELECT CAST(deaths > 50 AS DOUBLE) AS label, {SPLIT_SQL} FROM est GROUP BY 1", est=ESTABLISHMENTS)
def _(t):
    return feat.classify_high_risk(establishment_features(t), key=ESTABLISHMENT_KEY).drop("correct")


@query("f36_classify_category", f"SELECT category AS risk_category, {SPLIT_SQL} FROM est GROUP BY 1", est=ESTABLISHMENTS)
def _(t):
    return feat.classify_category(establishment_features(t), key=ESTABLISHMENT_KEY).drop("correct")


@query("f36_regress_severity", f"SELECT {SPLIT_SQL} FROM est", est=ESTABLISHMENTS)
def _(t):
    return feat.regress_severity(establishment_features(t), key=ESTABLISHMENT_KEY).drop("rmse")


# What the models answer on the test side has no twin; a fixture with known answers tests it.

@query("f36_high_risk_scores")
def _(t):
    return feat.classify_high_risk(establishment_features(t), key=ESTABLISHMENT_KEY)


@query("f36_category_scores")
def _(t):
    return feat.boost_category(establishment_features(t), key=ESTABLISHMENT_KEY)


@query("f36_severity_scores")
def _(t):
    return feat.regress_severity(establishment_features(t), key=ESTABLISHMENT_KEY)


CASE_YEAR = "SELECT industry_description AS secteur_scian, year AS annee, CAST(SUM(total_cases) AS BIGINT) AS n FROM osha_injuries GROUP BY 1, 2"


@query("f37_incident_forecast", FORECAST, fit=FIT.replace("sector_year", "case_year"), case_year=CASE_YEAR)
def _(t):
    # the reported cases of each industry, by year
    years = t.osha_injuries.groupBy(F.col("industry_description").alias("secteur_scian"), F.col("year").alias("annee")).agg(F.sum("total_cases").alias("n"))
    return out.forecast(years)


MONTHLY = f"""SELECT cle, mois, n, {ratio('n * months', 'total', 1, 4)} AS seasonal_index FROM (SELECT *, SUM(n) OVER (PARTITION BY cle) AS total,
  COUNT(*) OVER (PARTITION BY cle) AS months FROM (SELECT o_orderpriority AS cle, CAST(month(o_orderdate) AS INT) AS mois, COUNT(*) AS n FROM orders GROUP BY 1, 2))"""


@query("d01_monthly_index", "SELECT * FROM monthly", monthly=MONTHLY)
def _(t):
    return feat.monthly_index(t.base("orders"), "o_orderpriority", "o_orderdate")


@query("d02_seasonal_spikes", "SELECT *, ROUND((seasonal_index - 1) * 100, 1) AS ecart_pct FROM monthly WHERE seasonal_index > CAST(1.02 AS DOUBLE)", monthly=MONTHLY)
def _(t):
    return feat.seasonal_spikes(feat.monthly_index(t.base("orders"), "o_orderpriority", "o_orderdate"), above=1.02)


@query("d04_rate_by_jurisdiction", f"""
SELECT jurisdiction, cases, {ratio('cases', 'workers', 1000, 2)} AS rate_per_1000, ROUND(CAST(l - f AS DOUBLE) / f * 100, 1) AS trend_pct FROM (
  SELECT jurisdiction, CAST(SUM(n) AS BIGINT) AS cases, arg_min(n, year) AS f, arg_max(n, year) AS l,
    CASE jurisdiction WHEN 'USA' THEN (SELECT COUNT(DISTINCT c_custkey) FROM customer) ELSE (SELECT COUNT(*) FROM part) END AS workers
  FROM (SELECT jurisdiction, year, COUNT(*) AS n FROM incidents_global GROUP BY 1, 2) GROUP BY 1)""")
def _(t):
    years = t.incidents_global.groupBy("jurisdiction", "year").agg(F.count(F.lit(1)).alias("n"))
    workers = t.base("customer").agg(F.count(F.lit(1)).alias("workers")).withColumn("jurisdiction", F.lit("USA")).unionByName(
        t.base("part").agg(F.count(F.lit(1)).alias("workers")).withColumn("jurisdiction", F.lit("Quebec")))
    return feat.rate_by_jurisdiction(years, workers)


@query("d05_zone_band", """
SELECT secteur_scian, risk_score, CASE WHEN risk_score > 70 THEN 'ROUGE' WHEN risk_score > 50 THEN 'ORANGE' WHEN risk_score > 30 THEN 'JAUNE' ELSE 'VERT' END AS zone
FROM (SELECT secteur_scian, ROUND(LEAST(40, CAST(n AS DOUBLE) / 10000 * 10) + LEAST(30, pct_tms * CAST(1.5 AS DOUBLE)) + LEAST(30, pct_psy * 5), 1) AS risk_score FROM sector_rate)""")
def _(t):
    from harmlens.functions.exprs import percent as pct

    sums = enr.sector_sums(enr.sector_years(t.lesions))
    scored = sums.select("secteur_scian", enr.linear_score(F.col("n"), pct("tms", "n"), pct("psy", "n")).alias("risk_score"))
    return feat.zone_band(scored, "risk_score")


# -- text rules -------------------------------------------------------------------------

def behaviour_sql(table: str, keys: str) -> str:
    from harmlens.functions.dims import BEHAVIOUR_KEYWORDS

    tags = ", ".join(f"CASE WHEN contains(low, '{w}') THEN '{c}:{w}' END" for c, w in BEHAVIOUR_KEYWORDS)
    hits = " + ".join(f"CAST(contains(low, '{w}') AS INT)" for _, w in BEHAVIOUR_KEYWORDS)
    return f"""SELECT {keys}, indicators, pattern, CASE WHEN hits >= 3 THEN 'CRITIQUE' WHEN hits >= 2 THEN 'ELEVE' WHEN hits >= 1 THEN 'MODERE' ELSE 'FAIBLE' END AS risk_level,
  score AS risk_score, CASE WHEN score >= 75 THEN 'ARRET_IMMEDIAT|INTERVENTION_SUPERVISEUR|CORRECTION_IMMEDIATE|RAPPEL_SECURITE' WHEN score >= 50
    THEN 'CORRECTION_IMMEDIATE|RAPPEL_SECURITE' ELSE '' END AS interventions
FROM (SELECT *, LEAST(100, hits * 25 + CASE WHEN pattern <> 'STANDARD' THEN 15 ELSE 0 END) AS score FROM (
  SELECT {keys}, concat_ws('|', {tags}) AS indicators, {hits} AS hits,
    CASE WHEN contains(low, 'rapide') OR contains(low, 'presse') THEN 'RACCOURCI_TEMPS' WHEN contains(low, 'fatigue') OR contains(low, 'lent') THEN 'FATIGUE' ELSE 'STANDARD' END AS pattern
  FROM (SELECT {keys}, lower(text) AS low FROM {table})))"""


def _listed(df):
    return df.withColumn("indicators", F.array_join("indicators", "|")).withColumn("interventions", F.array_join("interventions", "|"))


@query("f38_score_documents", behaviour_sql("documents", "doc_id"))
def _(t):
    return _listed(txt.score_observations(t.base("documents").select("doc_id", "text")).drop("text"))


@query("f38_score_conversations", behaviour_sql("conversations", "conv_id, turn"))
def _(t):
    return _listed(txt.score_observations(t.base("conversations").select("conv_id", "turn", "text")).drop("text"))


def _intent_sql() -> str:
    from harmlens.functions.dims import INTENT_WORDS

    whens = " ".join(f"WHEN {' OR '.join(f'contains(lower(text), {chr(39)}{w}{chr(39)})' for w in words)} THEN '{name}'" for name, words in INTENT_WORDS)
    return f"CASE {whens} ELSE 'general' END"


def _sector_sql() -> str:
    from harmlens.functions.dims import NAMED_SECTORS

    return "CASE " + " ".join(f"WHEN contains(text, '{c}') OR contains(lower(text), '{n.lower()}') THEN '{c}'" for c, n in NAMED_SECTORS) + " ELSE '221122' END"


@query("f39_detect_intent", f"SELECT 'conversations' AS origin, intent, COUNT(*) AS n FROM (SELECT {_intent_sql()} AS intent FROM conversations) GROUP BY 2 "
                            f"UNION ALL SELECT 'documents', intent, COUNT(*) FROM (SELECT {_intent_sql()} AS intent FROM documents) GROUP BY 2")
def _(t):
    rows = t.base("conversations").select("text", F.lit("conversations").alias("origin")).unionByName(
        t.base("documents").select("text", F.lit("documents").alias("origin")))
    return agg.counts_by(txt.detect_intent(rows), ["origin", "intent"])


@query("f40_mentioned_sector", f"SELECT doc_id, {_sector_sql()} AS sector FROM documents")
def _(t):
    return txt.mentioned_sector(t.base("documents").select("doc_id", "text")).drop("text")


@query("f41_chain_confidence", """
SELECT conv_id, ROUND(product(CASE role WHEN 'user' THEN CAST(0.92 AS DOUBLE) WHEN 'assistant' THEN CAST(0.97 AS DOUBLE) ELSE CAST(0.99 AS DOUBLE) END), 3) AS confidence,
  COUNT(*) AS steps FROM conversations GROUP BY 1""")
def _(t):
    confidence = F.when(F.col("role") == "user", 0.92).when(F.col("role") == "assistant", 0.97).otherwise(0.99)
    return txt.chain_confidence(t.base("conversations").withColumn("confidence", confidence), "conv_id", "confidence")


@query("f42_summarize", """
SELECT conv_id, string_agg('[' || role || ']: ' || CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END, chr(10) ORDER BY turn) AS summary
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) WHERE r <= 5 GROUP BY 1""")
def _(t):
    return txt.summarize(t.base("conversations"))
