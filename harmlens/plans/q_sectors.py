"""Queries J04-J06 and F01-F26: per-sector analytics on the injury rows."""

from datetime import date

from pyspark.sql import functions as F

from harmlens.operators import aggregates as agg
from harmlens.operators import enrichment as enr
from harmlens.operators import outlook as out
from harmlens.operators import predictive as pre
from harmlens.operators import windows as win
from harmlens.plans.oracle import flag, percent, ratio
from harmlens.plans.q_aggregates import mode_sql
from harmlens.plans.q_windows import LATEST_TWO, RANKED, YOY_SQL
from harmlens.plans.registry import query
from harmlens.workspace import cut_lineage

# Thresholds scaled to the fixture, so that every level occurs.
STEPS = ((10400, "🔴 CRITIQUE"), (10000, "🟠 ÉLEVÉ"), (9500, "🟡 MODÉRÉ"))
LEVEL = "CASE " + " ".join(f"WHEN s.n > {a} THEN '{b}'" for a, b in STEPS) + " ELSE '🟢 FAIBLE' END"
AS_OF = date(2024, 7, 15)

PROFILE = f"""SELECT s.secteur_scian, s.n AS total_lesions, {percent('s.n', 'p.n')} AS pct_total_qc, s.pct_tms AS risk_tms_pct,
  s.pct_psy AS risk_psy_pct, s.pct_machine AS risk_machine_pct, s.pct_surdite AS risk_surdite_pct,
  ROUND(LEAST(40, CAST(s.n AS DOUBLE) / 10000 * 10) + LEAST(30, s.pct_tms * CAST(1.5 AS DOUBLE)) + LEAST(30, s.pct_psy * 5), 1) AS risk_score,
  {LEVEL} AS risk_level, a.v AS top_nature_lesion, b.v AS top_siege_lesion, c.v AS top_agent_causal
FROM sector_rate s, province p, mode_nature a, mode_siege b, mode_agent c
WHERE a.secteur_scian = s.secteur_scian AND b.secteur_scian = s.secteur_scian AND c.secteur_scian = s.secteur_scian"""
BENCH = """SELECT secteur_scian, ord, indicateur, taux_secteur, taux_provincial, ecart,
  CASE WHEN taux_provincial > 0 THEN ecart / taux_provincial * 100 ELSE 0 END AS ecart_pct,
  CASE WHEN ecart > taux_provincial * CAST(0.2 AS DOUBLE) THEN '⚠️ AU-DESSUS' WHEN ecart < -taux_provincial * CAST(0.2 AS DOUBLE) THEN '✅ EN-DESSOUS' ELSE '➡️ MOYENNE' END AS statut,
  CASE WHEN ecart > taux_provincial * CAST(0.2 AS DOUBLE) THEN 'Action prioritaire requise: réduire les ' || indicateur || ' de ' || printf('%.1f', ROUND(abs(ecart), 1)) || '%'
       WHEN ecart < -taux_provincial * CAST(0.2 AS DOUBLE) THEN 'Performance supérieure: maintenir les bonnes pratiques'
       ELSE 'Dans la moyenne provinciale: surveiller les tendances' END AS recommandation
FROM (SELECT s.secteur_scian, v.ord, v.indicateur, v.a AS taux_secteur, v.b AS taux_provincial, v.a - v.b AS ecart
  FROM sector_rate s, province_rate p, LATERAL (VALUES (0, 'TMS', s.pct_tms, p.pct_tms), (1, 'PSY', s.pct_psy, p.pct_psy),
    (2, 'MACHINE', s.pct_machine, p.pct_machine), (3, 'SURDITE', s.pct_surdite, p.pct_surdite)) v(ord, indicateur, a, b))"""
STACKED = """SELECT secteur_scian, colonne, valeur, COUNT(*) AS n FROM (
  SELECT secteur_scian, 'nature_lesion' AS colonne, nature_lesion AS valeur FROM lesions
  UNION ALL SELECT secteur_scian, 'siege_lesion', siege_lesion FROM lesions
  UNION ALL SELECT secteur_scian, 'agent_causal_lesion', agent_causal_lesion FROM lesions) WHERE valeur IS NOT NULL GROUP BY 1, 2, 3"""
TOPS = f"""SELECT secteur_scian, colonne, CAST(rank AS INT) AS rank, valeur, n AS total, {percent('n', 'tot')} AS pct FROM (SELECT *,
  ROW_NUMBER() OVER (PARTITION BY secteur_scian, colonne ORDER BY n DESC, valeur) AS rank,
  SUM(n) OVER (PARTITION BY secteur_scian, colonne) AS tot FROM stacked) WHERE rank <= 5"""
RECS = """SELECT p.secteur_scian, concat_ws(' | ',
  CASE WHEN risk_level IN ('🔴 CRITIQUE', '🟠 ÉLEVÉ') THEN '⚠️ Secteur à haut risque (' || format('{:,}', total_lesions) || ' lésions): audit SST complet recommandé' END,
  CASE WHEN risk_tms_pct > 25 THEN '🦴 TMS élevés (' || CAST(risk_tms_pct AS STRING) || '%): programme ergonomique prioritaire' END,
  CASE WHEN risk_psy_pct > 5 THEN '🧠 Risques psychosociaux (' || CAST(risk_psy_pct AS STRING) || '%): programme bien-être recommandé' END,
  (SELECT string_agg('📊 ' || b.indicateur || ': ' || b.recommandation, ' | ' ORDER BY b.ord) FROM bench b
    WHERE b.secteur_scian = p.secteur_scian AND b.statut = '⚠️ AU-DESSUS'),
  '🎯 Nature dominante: ' || top_nature_lesion || ' - cibler les mesures de prévention') AS recommandations_ia FROM profile p"""
BASE = {"mode_nature": mode_sql("nature_lesion", False), "mode_siege": mode_sql("siege_lesion", False),
        "mode_agent": mode_sql("agent_causal_lesion", False), "profile": PROFILE, "bench": BENCH, "stacked": STACKED,
        "tops": TOPS, "recs": RECS, "yoy_rows": YOY_SQL, "latest": LATEST_TWO, "ranked_risks": RANKED}


def years_of(t):
    return enr.sector_years(t.lesions)


@query("j04_sector_vs_province", """
SELECT s.secteur_scian AS secteur, s.pct_tms AS taux_secteur, p.pct_tms AS taux_provincial, ROUND(s.pct_tms - p.pct_tms, 2) AS ecart,
  CASE WHEN s.pct_tms > p.pct_tms * CAST(1.2 AS DOUBLE) THEN '⚠️ AU-DESSUS (+20%)'
       WHEN s.pct_tms < p.pct_tms * CAST(0.8 AS DOUBLE) THEN '✅ EN-DESSOUS (-20%)' ELSE '➡️ DANS LA MOYENNE' END AS statut
FROM sector_rate s, province_rate p""")
def _(t):
    return agg.compare_to_province(t.lesions, "TMS")


@query("j05_share_by_scalar_total", f"""
SELECT siege_lesion, COUNT(*) AS n, {percent('COUNT(*)', '(SELECT n FROM province)')} AS pct FROM lesions GROUP BY 1""")
def _(t):
    return win.share_of_total(agg.counts_by(t.lesions, ["siege_lesion"]), [])


@query("j06_dominant_values", """
SELECT a.secteur_scian, a.v AS top_nature_lesion, b.v AS top_siege_lesion, c.v AS top_agent_causal
FROM mode_nature a, mode_siege b, mode_agent c WHERE a.secteur_scian = b.secteur_scian AND a.secteur_scian = c.secteur_scian""", **BASE)
def _(t):
    return agg.dominant_values(enr.described(t.lesions), enr.DESCRIPTIVE)


@query("f01_sector_profiles", "SELECT * FROM profile", **BASE)
def _(t):
    return enr.sector_profiles(t.lesions, STEPS)


@query("f02_benchmarks", "SELECT * FROM bench", **BASE)
def _(t):
    return enr.benchmarks(t.lesions)


@query("f03_trends", "SELECT secteur_scian, annee, n AS total FROM sector_year")
def _(t):
    return enr.trends(t.lesions)


@query("f04_top_values", "SELECT * FROM tops", **BASE)
def _(t):
    return enr.top_values(enr.described(t.lesions))


@query("f05_full_enrichment", """
SELECT p.secteur_scian, p.total_lesions, p.risk_score, p.risk_level, r.recommandations_ia,
  (SELECT string_agg(indicateur || ':' || statut, ',' ORDER BY ord) FROM bench b WHERE b.secteur_scian = p.secteur_scian) AS benchmarks,
  (SELECT string_agg(CAST(annee AS STRING) || '=' || CAST(n AS STRING), ',' ORDER BY annee) FROM sector_year y WHERE y.secteur_scian = p.secteur_scian) AS tendances,
  (SELECT string_agg(valeur || '=' || CAST(total AS STRING), ',' ORDER BY rank) FROM tops x WHERE x.secteur_scian = p.secteur_scian AND colonne = 'nature_lesion') AS top_5_natures,
  (SELECT string_agg(valeur || '=' || CAST(total AS STRING), ',' ORDER BY rank) FROM tops x WHERE x.secteur_scian = p.secteur_scian AND colonne = 'siege_lesion') AS top_5_sieges,
  (SELECT string_agg(valeur || '=' || CAST(total AS STRING), ',' ORDER BY rank) FROM tops x WHERE x.secteur_scian = p.secteur_scian AND colonne = 'agent_causal_lesion') AS top_5_agents
FROM profile p JOIN recs r ON p.secteur_scian = r.secteur_scian""", **BASE)
def _(t):
    rich = enr.full_enrichment(t.lesions, STEPS)
    listed = lambda c: F.array_join(F.transform(c, lambda v: F.concat(v["valeur"], F.lit("="), v["total"].cast("string"))), ",").alias(c)
    return rich.select(
        "secteur_scian", "total_lesions", "risk_score", "risk_level", F.array_join("recommandations_ia", " | ").alias("recommandations_ia"),
        F.array_join(F.transform("benchmarks", lambda b: F.concat(b["indicateur"], F.lit(":"), b["statut"])), ",").alias("benchmarks"),
        F.array_join(F.transform("tendances", lambda y: F.concat(y["annee"].cast("string"), F.lit("="), y["total"].cast("string"))), ",").alias("tendances"),
        listed("top_5_natures"), listed("top_5_sieges"), listed("top_5_agents"))


@query("f06_hazard_map", """
SELECT p.secteur_scian, p.risk_level, p.risk_score, v.type, v.taux, v.priorite FROM profile p, LATERAL (VALUES
  ('TMS', risk_tms_pct, CASE WHEN risk_tms_pct > 20 THEN 1 ELSE 2 END), ('PSY', risk_psy_pct, CASE WHEN risk_psy_pct > 5 THEN 1 ELSE 2 END),
  ('MACHINE', risk_machine_pct, CASE WHEN risk_machine_pct > 3 THEN 1 ELSE 3 END)) v(type, taux, priorite)""", **BASE)
def _(t):
    return enr.hazard_map(enr.sector_profiles(t.lesions, STEPS))


@query("f07_benchmark_score", """
SELECT secteur_scian, AVG(CASE WHEN statut = '✅ EN-DESSOUS' THEN CAST(1 AS DOUBLE) ELSE 0 END) * 100 AS score_global, COUNT(*) AS indicateurs
FROM bench GROUP BY 1""", **BASE)
def _(t):
    return enr.benchmark_score(enr.benchmarks(t.lesions))


@query("f08_trend_analysis", """
SELECT secteur_scian, annee_debut, annee_fin, valeur_debut, valeur_fin, ROUND(c, 1) AS variation_pct,
  CASE WHEN c > 10 THEN '📈 HAUSSE' WHEN c < -10 THEN '📉 BAISSE' ELSE '➡️ STABLE' END AS tendance,
  'Variation de ' || printf('%+.1f', ROUND(c, 1)) || '% sur ' || CAST(k AS STRING) || ' ans' AS analyse FROM (
  SELECT secteur_scian, MIN(annee) AS annee_debut, MAX(annee) AS annee_fin, arg_min(n, annee) AS valeur_debut, arg_max(n, annee) AS valeur_fin,
    COUNT(*) AS k, CAST(arg_max(n, annee) - arg_min(n, annee) AS DOUBLE) / arg_min(n, annee) * 100 AS c FROM sector_year GROUP BY 1)""")
def _(t):
    return enr.trend_analysis(years_of(t))


@query("f09_linear_score", """
SELECT secteur_scian, ROUND(LEAST(40, CAST(n AS DOUBLE) / 10000 * 10) + LEAST(30, pct_tms * CAST(1.5 AS DOUBLE)) + LEAST(30, pct_psy * 5), 1) AS risk_score
FROM sector_rate""")
def _(t):
    from harmlens.functions.exprs import percent as pct

    sums = enr.sector_sums(years_of(t))
    return sums.select("secteur_scian", enr.linear_score(F.col("n"), pct("tms", "n"), pct("psy", "n")).alias("risk_score"))


@query("f10_recommendations", "SELECT * FROM recs", **BASE)
def _(t):
    years = years_of(t)
    profiles = enr.profiles_of(years, agg.dominant_values(enr.described(t.lesions), enr.DESCRIPTIVE), STEPS)
    recs = enr.recommendations(profiles, enr.benchmarks_of(years))
    return recs.select("secteur_scian", F.array_join("recommandations_ia", " | ").alias("recommandations_ia"))


FIT = """SELECT *, (sy - slope * sx) / k AS intercept, CAST(last_n - first_n AS DOUBLE) / first_n * 100 AS c FROM (
  SELECT *, CAST(k * sxy - sx * sy AS DOUBLE) / CAST(k * sxx - sx * sx AS DOUBLE) AS slope FROM (
  SELECT secteur_scian, COUNT(*) AS k, CAST(SUM(annee) AS BIGINT) AS sx, CAST(SUM(n) AS BIGINT) AS sy, CAST(SUM(annee * n) AS BIGINT) AS sxy,
    CAST(SUM(annee * annee) AS BIGINT) AS sxx, MAX(annee) AS last_year, arg_min(n, annee) AS first_n, arg_max(n, annee) AS last_n
  FROM sector_year GROUP BY 1) WHERE k >= 3)"""
FORECAST = """SELECT secteur_scian, annee, GREATEST(0, CAST(trunc(slope * annee + intercept) AS BIGINT)) AS prediction,
  CASE WHEN slope > 0 THEN '📈 HAUSSE' ELSE '📉 BAISSE' END AS direction, ROUND(slope, 1) AS pente_annuelle, ROUND(c, 1) AS variation_totale_pct,
  CASE WHEN k >= 5 THEN 'MOYENNE' ELSE 'FAIBLE' END AS confiance,
  CASE WHEN c > 20 THEN '⚠️ ALERTE: Secteur en forte croissance de risque. Audit complet recommandé.'
       WHEN c > 10 THEN '⚡ ATTENTION: Tendance à la hausse. Renforcer les mesures préventives.'
       WHEN c < -10 THEN '✅ POSITIF: Amélioration continue. Maintenir les bonnes pratiques.'
       ELSE '➡️ STABLE: Surveiller les indicateurs. Prévention continue.' END AS recommandation
FROM (SELECT *, last_year + i AS annee FROM fit, (VALUES (1), (2)) v(i))"""


@query("f11_forecast", FORECAST, fit=FIT)
def _(t):
    return out.forecast(years_of(t))


TABS = f"""SELECT secteur_scian, 'age_tms' AS tableau, groupe_age AS a, CAST(NULL AS STRING) AS b, COUNT(*) AS total, {percent(flag('tms'), 'COUNT(*)')} AS taux FROM lesions GROUP BY 1, 3
UNION ALL SELECT secteur_scian, 'sexe_psy', sexe_pers_phys, NULL, COUNT(*), {percent(flag('psy'), 'COUNT(*)')} FROM lesions GROUP BY 1, 3
UNION ALL SELECT secteur_scian, 'agent_siege', agent_causal_lesion, siege_lesion, n, NULL FROM (SELECT secteur_scian, agent_causal_lesion, siege_lesion,
  COUNT(*) AS n, ROW_NUMBER() OVER (PARTITION BY secteur_scian ORDER BY COUNT(*) DESC, agent_causal_lesion NULLS FIRST, siege_lesion NULLS FIRST) AS rn
  FROM lesions GROUP BY 1, 2, 3) WHERE rn <= 10"""
INSIGHTS = """SELECT secteur_scian, 'AGE_TMS' AS type, 'Groupe d''âge le plus touché par TMS: ' || a || ' (' || CAST(taux AS STRING) || '%)' AS finding,
  'Cibler les formations ergonomiques sur ce groupe' AS action FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY secteur_scian ORDER BY taux DESC, a) AS rn
  FROM tabs WHERE tableau = 'age_tms') WHERE rn = 1
UNION ALL SELECT secteur_scian, 'SEXE_PSY', a || ': ' || CAST(taux AS STRING) || '% de lésions psychologiques', 'Programme de soutien psychologique recommandé'
FROM tabs WHERE tableau = 'sexe_psy' AND taux > 5"""


@query("f12_cross_tabs", "SELECT * FROM tabs", tabs=TABS)
def _(t):
    return out.cross_tabs(t.lesions)


@query("f12_cross_tab_insights", INSIGHTS, tabs=TABS)
def _(t):
    return out.cross_tab_insights(out.cross_tabs(t.lesions))


ANOMALIES = """SELECT secteur_scian, annee, n AS total, variation_pct, abs(variation_pct) > 3 AS anomalie,
  CASE WHEN abs(variation_pct) > 3 THEN CASE WHEN annee IN (2020, 2022) THEN 'COVID-19' ELSE 'À investiguer' END END AS explication
FROM yoy_rows WHERE previous IS NOT NULL"""


@query("f13_anomalies", ANOMALIES, **BASE)
def _(t):
    return out.anomalies(years_of(t), beyond=3)


COSTS = """SELECT secteur_scian, n AS total, tms, psy, n - tms - psy AS autres, cost AS cout_total, CAST(ROUND(cost / 7.0::DOUBLE, 0) AS BIGINT) AS cout_annuel_moyen,
  CAST(ROUND(CAST(cost AS DOUBLE) / n, 0) AS BIGINT) AS cout_par_lesion, n * 45 AS jours_perdus_estimes, n * 45 * 350 AS cout_productivite, cost + n * 45 * 350 AS impact_total
FROM (SELECT *, tms * 12000 + psy * 25000 + (n - tms - psy) * 8500 AS cost FROM sector_total)"""


@query("f14_costs", COSTS)
def _(t):
    return out.costs(enr.sector_sums(years_of(t)))


DEMO = f"""SELECT secteur_scian, 'age' AS tableau, groupe_age AS a, CAST(NULL AS STRING) AS b, n AS total, {percent('n', 'SUM(n) OVER (PARTITION BY secteur_scian)')} AS pct, CAST(NULL AS BOOLEAN) AS risque_eleve
  FROM (SELECT secteur_scian, groupe_age, COUNT(*) AS n FROM lesions GROUP BY 1, 2)
UNION ALL SELECT secteur_scian, 'sexe', sexe_pers_phys, NULL, n, {percent('n', 'SUM(n) OVER (PARTITION BY secteur_scian)')}, NULL
  FROM (SELECT secteur_scian, sexe_pers_phys, COUNT(*) AS n FROM lesions GROUP BY 1, 2)
UNION ALL SELECT secteur_scian, 'age_sexe', groupe_age, sexe_pers_phys, n, {ratio('tms', 'n', 100, 1)}, tms * 100 > n * 30 FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY secteur_scian ORDER BY n DESC, groupe_age, sexe_pers_phys) AS rn FROM (
    SELECT secteur_scian, groupe_age, sexe_pers_phys, COUNT(*) AS n, {flag('tms')} AS tms FROM lesions GROUP BY 1, 2, 3)) WHERE rn <= 10"""
DEMO_ADVICE = """SELECT a.secteur_scian, concat_ws(' | ', '🎯 Groupe d''âge prioritaire: ' || a.a || ' (' || CAST(a.pct AS STRING) || '% des lésions)',
  (SELECT string_agg('⚠️ Population à risque: ' || b || ' - ' || c.a || ' - TMS à ' || CAST(pct AS STRING) || '%', ' | ' ORDER BY rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY secteur_scian ORDER BY total DESC, a, b) AS rn FROM demo WHERE risque_eleve) c
    WHERE c.secteur_scian = a.secteur_scian AND rn <= 3)) AS recommandations
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY secteur_scian ORDER BY total DESC, a) AS rn FROM demo WHERE tableau = 'age') a WHERE a.rn = 1"""


@query("f15_demographic_profile", "SELECT * FROM demo", demo=DEMO)
def _(t):
    return out.demographic_profile(t.lesions)


@query("f15_demographic_advice", DEMO_ADVICE, demo=DEMO)
def _(t):
    advice = out.demographic_advice(out.demographic_profile(t.lesions))
    return advice.withColumn("recommandations", F.array_join("recommandations", " | "))


@query("f16_executive_report", """
SELECT c.secteur_scian, f.direction AS niveau_risque, '$' || format('{:,}', c.impact_total) AS impact_economique_7_ans,
  printf('%+.1f%%', f.variation_totale_pct) AS tendance,
  f.recommandation || ' | Programme ergonomique TMS | Formation ciblée par groupe d''âge' AS actions,
  (SELECT COUNT(*) FROM strange s WHERE s.secteur_scian = c.secteur_scian AND anomalie) AS nb_anomalies
FROM (SELECT * FROM costs_rows) c JOIN (SELECT DISTINCT secteur_scian, direction, variation_totale_pct, recommandation FROM predicted) f
  ON c.secteur_scian = f.secteur_scian""", fit=FIT, predicted=FORECAST, costs_rows=COSTS, strange=ANOMALIES.replace("> 3 ", "> 30 "), **BASE)
def _(t):
    return out.executive_report(t.lesions).drop("rapport")


OUTLOOK = f"""SELECT *, LEAST(100, GREATEST(0, LEAST(100, CAST(n AS DOUBLE) / 1000 * 10) + trend * 5 + log10(101) * 5 + 4)) AS score,
  LEAST(CAST(0.95 AS DOUBLE), CAST(n AS DOUBLE) / years / 12 / 10000 * 100 * CAST(1.25 AS DOUBLE)) AS prob,
  {ratio('tms', 'n', 100, 1)} AS rt, {ratio('psy', 'n', 100, 1)} AS rp, {ratio('machine', 'n', 100, 1)} AS rm,
  CAST(tms AS DOUBLE) / n * 100 AS xt, CAST(psy AS DOUBLE) / n * 100 AS xp, CAST(machine AS DOUBLE) / n * 100 AS xm
FROM (SELECT secteur_scian, CAST(SUM(n) AS BIGINT) AS n, CAST(SUM(tms) AS BIGINT) AS tms, CAST(SUM(psy) AS BIGINT) AS psy,
  CAST(SUM(machine) AS BIGINT) AS machine, COUNT(*) AS years,
  CAST(arg_max(n, annee) - arg_min(n, annee) AS DOUBLE) / arg_min(n, annee) * 100 AS trend FROM sector_year GROUP BY 1)"""


@query("f17_incident_outlook", """
SELECT o.secteur_scian, ROUND(score, 1) AS risk_score, ROUND(prob * 100, 1) AS probability_30_days,
  string_agg(v.ty, '>' ORDER BY v.r DESC, v.ord) AS top_risks, string_agg(CAST(v.pr AS STRING), '>' ORDER BY v.r DESC, v.ord) AS priorities,
  concat_ws(' | ', CASE WHEN score > 70 THEN '⚠️ URGENT: Audit SST complet recommandé dans les 15 jours' END,
    CASE WHEN trend > 20 THEN '📈 Tendance à la hausse: Renforcer les mesures préventives' END,
    string_agg(v.act, ' | ' ORDER BY v.r DESC, v.ord)) AS actions,
  CASE WHEN years >= 5 THEN 'HIGH' WHEN years >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS confidence, n AS total_incidents, years AS years_of_data,
  ROUND(trend, 1) AS trend_percentage
FROM outlook_rows o, LATERAL (VALUES
  (1, 'TMS', rt, CASE WHEN xt > 25 THEN 1 ELSE 2 END, CASE WHEN rt > 25 THEN '🦴 Programme ergonomique prioritaire (TMS élevés)' END),
  (2, 'PSY', rp, CASE WHEN xp > 5 THEN 1 ELSE 3 END, CASE WHEN rp > 5 THEN '🧠 Programme bien-être psychologique recommandé' END),
  (3, 'Machine', rm, CASE WHEN xm > 5 THEN 1 ELSE 2 END, CASE WHEN rm > 5 THEN '⚙️ Audit LOTO et sécurité machines' END)) v(ord, ty, r, pr, act)
GROUP BY o.secteur_scian, score, prob, trend, years, n""", outlook_rows=OUTLOOK)
def _(t):
    rows = pre.incident_outlook(years_of(t), employees=100, history=2, season="winter")
    return rows.withColumn("top_risks", F.array_join("top_risks", ">")).withColumn(
        "priorities", F.array_join(F.col("priorities").cast("array<string>"), ">")).withColumn("actions", F.array_join("actions", " | "))


ID = "substr(md5(concat_ws('|', secteur_scian, type, '2024-07-15')), 1, 12) AS id"
ALERTS = f"""SELECT secteur_scian, {ID}, level, type, message, actions FROM (
  SELECT secteur_scian, CASE WHEN c > 2 THEN 'CRITICAL' ELSE 'WARNING' END AS level, CASE WHEN c > 2 THEN 'TREND_SPIKE' ELSE 'TREND_INCREASE' END AS type,
    CASE WHEN c > 2 THEN 'Augmentation critique de ' ELSE 'Augmentation de ' END || printf('%.1f', ROUND(c, 1)) || '% des incidents' AS message,
    CASE WHEN c > 2 THEN 'Audit immédiat|Réunion SST d''urgence|Analyse des causes' ELSE 'Renforcer la surveillance|Analyser les causes' END AS actions
  FROM (SELECT *, CAST(recent - previous AS DOUBLE) / previous * 100 AS c FROM latest) WHERE c > 0.5
  UNION ALL SELECT secteur_scian, 'INFO', 'SEASONAL_RISK', 'Juillet - Chaleur et déshydratation', 'Rappel des mesures saisonnières|Communication aux équipes' FROM sector_total
  UNION ALL SELECT s.secteur_scian, 'WARNING', 'BENCHMARK_EXCEEDED', 'TMS ' || printf('%.1f', ROUND(ROUND(s.pct_tms - p.pct_tms, 2), 1)) || '% au-dessus de la moyenne provinciale',
    'Programme ergonomique|Évaluation des postes' FROM sector_rate s, province_rate p WHERE ROUND(s.pct_tms - p.pct_tms, 2) > CAST(0.3 AS DOUBLE))"""


def _joined(alerts):
    return alerts.withColumn("actions", F.array_join("actions", "|"))


# The last fixture year is partial, so the trend is judged on the years before it.
EARLIER = {**BASE, "latest": LATEST_TWO.replace("FROM sector_year)", "FROM sector_year WHERE annee <= 2022)")}


@query("f18_trend_alerts", "SELECT * FROM alerts WHERE type LIKE 'TREND%'", alerts=ALERTS, **EARLIER)
def _(t):
    return _joined(pre.trend_alerts(years_of(t).filter("annee <= 2022"), AS_OF, warn=0.5, critical=2))


@query("f19_seasonal_alerts", "SELECT * FROM alerts WHERE type = 'SEASONAL_RISK'", alerts=ALERTS, **BASE)
def _(t):
    return _joined(pre.seasonal_alerts(years_of(t), AS_OF))


@query("f20_benchmark_alerts", "SELECT * FROM alerts WHERE type = 'BENCHMARK_EXCEEDED'", alerts=ALERTS, **BASE)
def _(t):
    return _joined(pre.benchmark_alerts(years_of(t), AS_OF, points=0.3))


@query("f21_all_alerts", "SELECT * FROM alerts", alerts=ALERTS, **BASE)
def _(t):
    return _joined(pre.all_alerts(cut_lineage(years_of(t)), AS_OF, points=0.3, warn=0.5, critical=2))


SCENARIOS = f"""SELECT secteur_scian, 'VR-' || upper(substr(secteur_scian, 1, 4)) || '-' || lpad(CAST(rn AS STRING), 3, '0') AS id,
  'Prévention: ' || substr(agent_causal_lesion, 1, 50) AS title, CAST(15 + (rn - 1) * 5 AS INT) AS duration_minutes, n AS based_on_incidents,
  agent_causal_lesion AS cause_type, {ratio('n', 'tot', 100, 1)} AS cause_percentage FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY secteur_scian ORDER BY n DESC, agent_causal_lesion) AS rn FROM (
    SELECT secteur_scian, agent_causal_lesion, COUNT(*) AS n, (SELECT t.n FROM sector_total t WHERE t.secteur_scian = l.secteur_scian) AS tot
    FROM lesions l WHERE agent_causal_lesion IS NOT NULL GROUP BY 1, 2)) WHERE rn <= 3"""


@query("f22_training_scenarios", SCENARIOS)
def _(t):
    return pre.training_scenarios(t.lesions)


@query("f23_worker_profiles", f"""
SELECT secteur_scian, groupe_age, sexe_pers_phys, n, tms_rate, psy_rate, sector_tms, sector_psy,
  ROUND(LEAST(100, 40 + tms_rate + psy_rate * 3), 1) AS risk_score,
  concat_ws('|', CASE WHEN tms_rate > sector_tms THEN 'TMS' END, CASE WHEN psy_rate > 5 THEN 'PSY' END) AS specific_risks,
  concat_ws('|', CASE WHEN tms_rate > 25 THEN 'Ergonomie et manutention (PRIORITÉ HAUTE)' END,
    CASE WHEN groupe_age LIKE '%45%' OR groupe_age LIKE '%55%' THEN 'Adaptation du poste de travail' END, 'Formation SST de base') AS recommended_training,
  concat_ws('|', 'Examen médical annuel', CASE WHEN tms_rate > 30 THEN 'Évaluation musculo-squelettique' END,
    CASE WHEN psy_rate > 5 THEN 'Suivi psychologique' END) AS medical_surveillance
FROM (SELECT c.secteur_scian, c.groupe_age, c.sexe_pers_phys, c.n, {percent('c.tms', 'c.n')} AS tms_rate, {percent('c.psy', 'c.n')} AS psy_rate,
  s.pct_tms AS sector_tms, s.pct_psy AS sector_psy FROM (SELECT secteur_scian, groupe_age, sexe_pers_phys, COUNT(*) AS n, {flag('tms')} AS tms,
    {flag('psy')} AS psy FROM lesions GROUP BY 1, 2, 3) c JOIN sector_rate s ON c.secteur_scian = s.secteur_scian)""")
def _(t):
    rows = pre.worker_profiles(t.lesions)
    for c in ("specific_risks", "recommended_training", "medical_surveillance"):
        rows = rows.withColumn(c, F.array_join(c, "|"))
    return rows


QUOTES = """SELECT secteur_scian, 250 AS employee_count, 3 AS historical_incidents, CAST(ROUND(total, 0) AS BIGINT) AS estimated_annual_cost,
  CAST(ROUND(total * CAST(0.40 AS DOUBLE), 0) AS BIGINT) AS premium_low, CAST(ROUND(total * CAST(0.60 AS DOUBLE), 0) AS BIGINT) AS premium_high,
  ROUND(total * CAST(0.10 AS DOUBLE), 2) AS saving_incidents, ROUND(direct * t * CAST(0.20 AS DOUBLE), 2) AS saving_tms,
  ROUND(total * CAST(0.60 AS DOUBLE) * CAST(0.15 AS DOUBLE), 2) AS saving_prevention
FROM (SELECT *, direct + e * 45 * 350 AS total FROM (SELECT *, e * (12500 * (1 - t - p) + 15000 * t + 28000 * p) AS direct FROM (
  SELECT secteur_scian, (CAST(n AS DOUBLE) / 7 / 100000 * 1000 / 1000 * 250 + 3) / 2 AS e, CAST(tms AS DOUBLE) / n AS t, CAST(psy AS DOUBLE) / n AS p FROM sector_total)))"""


@query("f24_insurance_quotes", QUOTES)
def _(t):
    return pre.insurance_quotes(enr.sector_sums(years_of(t)), employees=250, history=3)


@query("f25_intelligence_report", """
SELECT o.secteur_scian, ROUND(LEAST(100, GREATEST(0, score - 4)), 1) AS risk_score, ROUND(prob * 100, 1) AS probability_30_days,
  (SELECT COUNT(*) FROM alerts a WHERE a.secteur_scian = o.secteur_scian AND type <> 'BENCHMARK_EXCEEDED') AS nb_alerts, CAST(3 AS BIGINT) AS nb_scenarios,
  CAST(ROUND(e * (12500 * (1 - t - p) + 15000 * t + 28000 * p) + e * 45 * 350, 0) AS BIGINT) AS estimated_annual_cost
FROM (SELECT *, CAST(n AS DOUBLE) / 7 / 100000 * 1000 / 1000 * 100 AS e, CAST(tms AS DOUBLE) / n AS t, CAST(psy AS DOUBLE) / n AS p FROM outlook_rows) o""",
       outlook_rows=OUTLOOK.replace("* 5 + 4))", "* 5 + 4)) + 0"), alerts=ALERTS, **BASE)
def _(t):
    return pre.intelligence_report(t.lesions, AS_OF).drop("document")


@query("f26_simple_prediction", """
SELECT secteur_scian, risk_score, ROUND(LEAST(CAST(0.99 AS DOUBLE), CAST(n AS DOUBLE) / 7 / 12 / 1000 * 5), 2) AS probability_30_days,
  COALESCE(NULLIF(concat_ws('|', CASE WHEN t > 20 THEN 'TMS (' || printf('%.1f', ROUND(t, 1)) || '%)' END, CASE WHEN p > 5 THEN 'Psychologique (' || printf('%.1f', ROUND(p, 1)) || '%)' END,
    CASE WHEN m > 10 THEN 'Machines (' || printf('%.1f', ROUND(m, 1)) || '%)' END), ''), 'Risque modéré') AS top_risks,
  CASE WHEN risk_score > 70 THEN 'Action immédiate requise - Formation SST et audit recommandés' WHEN risk_score > 40
    THEN 'Surveillance accrue recommandée - Réviser les procédures' ELSE 'Maintenir les mesures préventives actuelles' END AS recommendation
FROM (SELECT *, LEAST(100, LEAST(100, CAST(trunc(CAST(n AS DOUBLE) / 10000 * 50 + t + p) AS BIGINT)) + 5 // 50) AS risk_score FROM (
  SELECT secteur_scian, n, CAST(tms AS DOUBLE) / n * 100 AS t, CAST(psy AS DOUBLE) / n * 100 AS p, CAST(machine AS DOUBLE) / n * 100 AS m FROM sector_total))""")
def _(t):
    rows = pre.simple_prediction(enr.sector_sums(years_of(t)), employees=5)
    return rows.withColumn("top_risks", F.array_join("top_risks", "|"))
