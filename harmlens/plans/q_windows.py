"""Queries W01-W07, O01-O08 and P10-P19."""

from pyspark.sql import functions as F

from harmlens.operators import aggregates as agg
from harmlens.operators import windows as win
from harmlens.plans.oracle import percent
from harmlens.plans.q_aggregates import STEPS, SUMMARY_SQL, level
from harmlens.plans.registry import query


def _sector_year(t):
    return agg.counts_by(t.lesions, ["secteur_scian", "annee"])


@query("w01_share_of_total", f"""
SELECT secteur_scian, groupe_age, n, {percent('n', 'SUM(n) OVER (PARTITION BY secteur_scian)')} AS pct
FROM (SELECT secteur_scian, groupe_age, COUNT(*) AS n FROM lesions GROUP BY 1, 2)""")
def _(t):
    return win.share_of_total(agg.counts_by(t.lesions, ["secteur_scian", "groupe_age"]), ["secteur_scian"])


YOY_SQL = """SELECT secteur_scian, annee, n, prev AS previous,
  ROUND(CASE WHEN prev IS NULL THEN NULL WHEN prev > 0 THEN CAST(n - prev AS DOUBLE) / prev * 100 ELSE 0 END, 1) AS variation_pct
FROM (SELECT secteur_scian, annee, n, LAG(n) OVER (PARTITION BY secteur_scian ORDER BY annee) AS prev FROM sector_year)"""


@query("w02_yoy", YOY_SQL)
def _(t):
    return win.yoy(_sector_year(t), ["secteur_scian"], "annee", "n")


@query("w03_first_last", """
SELECT secteur_scian, MIN(annee) AS annee_debut, MAX(annee) AS annee_fin, arg_min(n, annee) AS valeur_debut,
  arg_max(n, annee) AS valeur_fin, COUNT(*) AS nb_annees FROM sector_year GROUP BY 1""")
def _(t):
    return win.first_last(_sector_year(t), ["secteur_scian"], "annee", "n")


LATEST_TWO = """SELECT secteur_scian, recent, previous FROM (SELECT secteur_scian, MAX(CASE WHEN r = 1 THEN n END) AS recent,
  MAX(CASE WHEN r = 2 THEN n END) AS previous, COUNT(*) AS c FROM (SELECT *, ROW_NUMBER() OVER
  (PARTITION BY secteur_scian ORDER BY annee DESC) AS r FROM sector_year) WHERE r <= 2 GROUP BY 1) WHERE c = 2"""


@query("w04_latest_two", LATEST_TWO)
def _(t):
    return win.latest_two(_sector_year(t), ["secteur_scian"], "annee", "n")


@query("w05_latest_two_overall", """
SELECT arg_max(n, annee) AS recent, arg_min(n, annee) AS previous, COUNT(*) AS points
FROM (SELECT annee, CAST(SUM(nombre_lesions) AS BIGINT) AS n FROM cnesst_lesions GROUP BY 1 ORDER BY annee DESC LIMIT 2)""")
def _(t):
    return win.latest_two_overall(agg.yearly_totals(t.cnesst_lesions), "annee", "total_lesions")


@query("w06_top_n_by", """
SELECT secteur_scian, nature_lesion, n, CAST(rank AS INT) AS rank FROM (SELECT secteur_scian, nature_lesion, COUNT(*) AS n,
  ROW_NUMBER() OVER (PARTITION BY secteur_scian ORDER BY COUNT(*) DESC, nature_lesion NULLS FIRST) AS rank
  FROM lesions GROUP BY 1, 2) WHERE rank <= 5""")
def _(t):
    return win.top_n_by(agg.counts_by(t.lesions, ["secteur_scian", "nature_lesion"]), ["secteur_scian"], "nature_lesion", 5)


@query("w07_last_turns", """
SELECT conv_id, turn, role, text, CAST(recency AS INT) AS recency FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS recency
  FROM conversations) WHERE recency <= 5""")
def _(t):
    return win.last_turns(t.base("conversations"), 5)


@query("o01_top_k", """
SELECT siege_lesion, COUNT(*) AS n FROM lesions GROUP BY 1 ORDER BY n DESC, siege_lesion NULLS FIRST LIMIT 10""")
def _(t):
    return win.top_k(agg.counts_by(t.lesions, ["siege_lesion"]), "n", 10, ["siege_lesion"])


@query("o02_order_nulls_last", "SELECT state, COUNT(*) AS n FROM osha_raw GROUP BY 1")
def _(t):
    return win.order_nulls_last(agg.counts_by(t.osha_raw, ["state"]), "state")


RANKED = """SELECT secteur_scian, (SELECT string_agg(ty, '>' ORDER BY rate DESC, ord) FROM (VALUES (1, 'TMS', pct_tms), (2, 'PSY', pct_psy),
  (3, 'Machine', pct_machine)) v(ord, ty, rate)) AS ranked FROM sector_rate"""


@query("o03_rank_risks", RANKED)
def _(t):
    from harmlens.functions.exprs import percent as pct

    rated = agg.counts_by(t.lesions, ["secteur_scian"], ["tms", "psy", "machine"]).select(
        "secteur_scian", *[pct(f, "n").alias(f"pct_{f}") for f in ("tms", "psy", "machine")])
    ranked = win.rank_risks(rated, [("TMS", "pct_tms"), ("PSY", "pct_psy"), ("Machine", "pct_machine")])
    return ranked.select("secteur_scian", F.array_join("ranked", ">").alias("ranked"))


@query("o05_union_all", SUMMARY_SQL)
def _(t):
    return agg.source_summary(t.osha_raw, t.esaw, t.lesions)


@query("o06_concat_by_name", """
SELECT jurisdiction, CAST(SUM(with_state) AS BIGINT) AS with_state, CAST(SUM(with_country) AS BIGINT) AS with_country, COUNT(*) AS n FROM (
  SELECT 'USA' AS jurisdiction, CASE WHEN state IS NULL THEN 0 ELSE 1 END AS with_state, 0 AS with_country FROM osha_raw
  UNION ALL SELECT 'EU27', 0, CASE WHEN country_code IS NULL THEN 0 ELSE 1 END FROM esaw) GROUP BY 1""")
def _(t):
    us = t.osha_raw.select(F.lit("USA").alias("jurisdiction"), "state")
    eu = t.esaw.select(F.lit("EU27").alias("jurisdiction"), "country_code")
    return win.concat(us, eu).groupBy("jurisdiction").agg(
        F.count("state").alias("with_state"), F.count("country_code").alias("with_country"), F.count(F.lit(1)).alias("n"))


@query("o07_distinct_values", "SELECT DISTINCT annee FROM lesions")
def _(t):
    return win.distinct_values(t.lesions, "annee")


@query("o08_first_k", """
SELECT annee, scian, genre_accident, nature_lesion, nombre_lesions, jours_perdus FROM cnesst_lesions
WHERE CAST(jours_perdus AS DOUBLE) / NULLIF(nombre_lesions, 0) > 15 ORDER BY annee, scian, genre_accident, nature_lesion LIMIT 5""")
def _(t):
    heavy = t.cnesst_lesions.filter(F.try_divide("jours_perdus", "nombre_lesions") > 15)
    return win.first_k(heavy, ["annee", "scian", "genre_accident", "nature_lesion"], 5)


@query("p10_lesion_scan", "SELECT * FROM lesions WHERE secteur_scian ILIKE '%mall%' AND annee = 2019")
def _(t):
    return win.scan(t.lesions, contains={"secteur_scian": "mall"}, equals={"annee": 2019})


@query("p11_state_scan", "SELECT * FROM osha_raw WHERE state ILIKE '%nation_1%'")
def _(t):
    return win.scan(t.osha_raw, contains={"state": "nation_1"})


@query("p12_country_scan", "SELECT * FROM esaw WHERE country_code ILIKE '%n1%'")
def _(t):
    return win.scan(t.esaw, contains={"country_code": "n1"})


@query("p13_case_scan", """
SELECT * FROM cnesst_lesions WHERE scian = '62' ORDER BY annee DESC, nombre_lesions DESC, genre_accident, nature_lesion LIMIT 100""")
def _(t):
    order = [F.col("annee").desc(), F.col("nombre_lesions").desc(), F.col("genre_accident"), F.col("nature_lesion")]
    return win.scan(t.cnesst_lesions, equals={"scian": "62", "annee": None}, order=order, limit=100)


@query("p14_industry_scan", """
SELECT * FROM osha_injuries WHERE year = 2019 ORDER BY year DESC, total_cases DESC, naics, industry_description LIMIT 100""")
def _(t):
    order = [F.col("year").desc(), F.col("total_cases").desc(), F.col("naics"), F.col("industry_description")]
    return win.scan(t.osha_injuries, equals={"year": 2019, "naics": None}, order=order, limit=100)


@query("p15_substring_filter", """
SELECT secteur_scian, COUNT(*) AS n FROM lesions WHERE secteur_scian ILIKE '%E_O%' GROUP BY 1""")
def _(t):
    return agg.counts_by(win.scan(t.lesions, contains={"secteur_scian": "E_O"}), ["secteur_scian"])


@query("p16_cohort_filter", """
SELECT secteur_scian, groupe_age, sexe_pers_phys, COUNT(*) AS n FROM lesions WHERE secteur_scian ILIKE '%ar%'
  AND groupe_age ILIKE '%45%' AND sexe_pers_phys ILIKE '%femme%' GROUP BY 1, 2, 3""")
def _(t):
    rows = win.scan(t.lesions, contains={"secteur_scian": "ar", "groupe_age": "45", "sexe_pers_phys": "femme"})
    return agg.counts_by(rows, ["secteur_scian", "groupe_age", "sexe_pers_phys"])


@query("p17_not_null", "SELECT state, naics_code, COUNT(*) AS n FROM osha_raw WHERE state IS NOT NULL AND naics_code IS NOT NULL GROUP BY 1, 2")
def _(t):
    return agg.counts_by(win.not_null(t.osha_raw, "state", "naics_code"), ["state", "naics_code"])


@query("p18_distinct_by_volume", "SELECT secteur_scian, COUNT(*) AS total FROM lesions GROUP BY 1")
def _(t):
    return win.by_volume(t.lesions, "secteur_scian")


@query("p19_volume_band", f"SELECT secteur_scian, n, {level('n')} AS niveau FROM sector_total")
def _(t):
    return win.volume_band(agg.counts_by(t.lesions, ["secteur_scian"]), "n", STEPS, agg.LOWEST_LEVEL)
