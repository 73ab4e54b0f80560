"""Queries S01-S13, K01-K10, P01-P09, P20-P21, T01-T06, A20, A40: files, layers and warehouse state.

File queries first write the driver's tables to the shared scratch folder in the
source's own format, then read them back through the operator under test.
"""

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmlens.functions import dims
from harmlens.operators import aggregates as agg
from harmlens.operators import enrichment as enr
from harmlens.operators import features as feat
from harmlens.operators import harmonize as har
from harmlens.operators import keyed_table as kt
from harmlens.operators import warehouse as wh
from harmlens.operators.windows import concat
from harmlens.plans.oracle import ratio
from harmlens.plans.q_advisors import FEATURE_INPUT, FEATURES, feature_input
from harmlens.plans.q_harmonize import PARTS as HPARTS
from harmlens.plans.q_harmonize import flatten, malformed_input
from harmlens.plans.q_sectors import BASE as FBASE
from harmlens.plans.q_sectors import STEPS
from harmlens.plans.registry import query
from harmlens.sources import catalog, conform, layers, readers, widening
from harmlens.workspace import cut_lineage, scratch_path

NOW = datetime(2024, 1, 1)
DAY = date(2024, 1, 1)
ESTABLISHMENT = ["establishment_name", "state", "naics_code", "industry_description", "total_hours_worked", "total_deaths", "total_injuries", "year_filing_for"]


# -- sources ------------------------------------------------------------------------

@query("s01_csv_folder", """
SELECT year_filing_for AS year, COUNT(*) AS n, COUNT(state) AS with_state, COUNT(CASE WHEN year_filing_for % 2 = 0 THEN days_away END) AS with_days
FROM osha_raw GROUP BY 1""")
def _(t):
    # Two header variants in one folder: odd years lack the days_away column.
    folder = scratch_path(t.spark, "csv")
    even = t.osha_raw.filter("year_filing_for % 2 = 0").select("year_filing_for", "state", "days_away")
    odd = t.osha_raw.filter("year_filing_for % 2 = 1").select("state", "year_filing_for")
    even.write.mode("append").csv(folder, header=True)
    odd.write.mode("append").csv(folder, header=True)
    rows = readers.read_csv_folder(t.spark, folder)
    return rows.groupBy(F.col("year_filing_for").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count("state").alias("with_state"), F.count("days_away").alias("with_days"))


@query("s02_osha_extract", """
SELECT 'osha_accident' AS extract, naics_code, COUNT(*) AS n FROM osha_raw WHERE total_deaths > 0 GROUP BY 2
UNION ALL SELECT 'unknown', naics_code, COUNT(*) FROM osha_raw GROUP BY 2""")
def _(t):
    root = scratch_path(t.spark, "osha")
    t.osha_raw.select("id", "naics_code").write.csv(f"{root}/osha_inspection", header=True)
    t.osha_raw.filter("total_deaths > 0").select("id", "naics_code").write.csv(f"{root}/osha_accident", header=True)
    counted = lambda name: agg.counts_by(readers.read_osha_extract(t.spark, root, name), ["naics_code"])
    return counted("osha_accident").withColumn("extract", F.lit("osha_accident")).unionByName(counted("no_such").withColumn("extract", F.lit("unknown")))


def series_documents(t):
    """One response per year: a series per industry, a data point per state; one year failed."""
    point = F.struct(F.col("year_filing_for").cast("string").alias("year"), F.coalesce("state", F.lit("none")).alias("period"),
                     F.col("v").cast("string").alias("value"), F.array().cast("array<map<string,string>>").alias("footnotes"))
    cells = t.osha_raw.groupBy("year_filing_for", "state", F.coalesce("naics_code", F.lit("FWU00X4XXXXXXXX1")).alias("seriesID")).agg(F.sum("total_injuries").alias("v"))
    series = cells.groupBy("year_filing_for", "seriesID").agg(F.collect_list(point).alias("data"))
    docs = series.groupBy("year_filing_for").agg(F.struct(F.collect_list(F.struct("seriesID", "data")).alias("series")).alias("Results"))
    status = F.when(F.col("year_filing_for") == 2018, "REQUEST_FAILED").otherwise("REQUEST_SUCCEEDED")
    return docs.select(status.alias("status"), "Results")


SERIES = """SELECT COALESCE(naics_code, 'FWU00X4XXXXXXXX1') AS series_id, year_filing_for AS year, COALESCE(state, 'none') AS period,
  CAST(SUM(total_injuries) AS DOUBLE) AS value FROM osha_raw WHERE year_filing_for <> 2018 GROUP BY 1, 2, 3"""


def series_of(t):
    path = scratch_path(t.spark, "series")
    series_documents(t).write.json(path)
    return readers.read_series(t.spark, path, multiline=False)


@query("s03_series", "SELECT * FROM series_rows", series_rows=SERIES)
def _(t):
    return series_of(t).drop("footnotes")


CUBE = """SELECT COALESCE(country_code, 'none') AS geo, country_name AS geo_label, CAST(year AS STRING) AS time, CAST(year AS STRING) AS time_label,
  CAST(SUM(CAST(incident_count AS BIGINT)) AS DOUBLE) AS value FROM esaw GROUP BY 1, 2, 3"""


def cube_documents(t):
    """JSON-stat cubes over country and year, one document per year; labels are given for countries only."""
    cells = t.esaw.groupBy(F.coalesce("country_code", F.lit("none")).alias("geo"), "country_name", F.col("year").cast("string").alias("time")).agg(
        F.sum(F.col("incident_count").cast("bigint")).cast("double").alias("value"))
    rows = cells.groupBy("time").agg(F.array_sort(F.collect_list(F.struct("geo", "country_name", "value"))).alias("g"))
    indexed = lambda items: F.map_from_entries(F.transform(items, lambda e, i: F.struct(e, i)))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    geo = F.struct(F.struct(indexed(F.transform("g", lambda e: e["geo"])).alias("index"),
                            F.map_from_entries(F.transform("g", lambda e: F.struct(e["geo"], e["country_name"]))).alias("label")).alias("category"))
    time = F.struct(F.struct(indexed(F.array("time")).alias("index"), none.alias("label")).alias("category"))
    return rows.select(F.create_map(F.lit("geo"), geo, F.lit("time"), time).alias("dimension"),
                       F.map_from_entries(F.transform("g", lambda e, i: F.struct(i.cast("string"), e["value"]))).alias("value"))


def cube_of(t):
    path = scratch_path(t.spark, "cube")
    cube_documents(t).write.json(path)
    return readers.read_cube(t.spark, path, ["geo", "time"], multiline=False)


@query("s04_cube", "SELECT * FROM cube_rows", cube_rows=CUBE)
def _(t):
    return cube_of(t)


@query("s05_sdmx_csv", "SELECT country_code AS \"REF_AREA\", CAST(year AS STRING) AS \"TIME_PERIOD\", incident_count AS \"OBS_VALUE\" FROM esaw")
def _(t):
    path = scratch_path(t.spark, "sdmx")
    t.esaw.select(F.col("country_code").alias("REF_AREA"), F.col("year").alias("TIME_PERIOD"), F.col("incident_count").alias("OBS_VALUE")).write.csv(path, header=True)
    return readers.read_sdmx_csv(t.spark, path)


@query("s06_xml", "SELECT id, state, total_deaths AS deaths FROM osha_raw WHERE total_deaths > 0")
def _(t):
    path = scratch_path(t.spark, "xml")
    t.osha_raw.filter("total_deaths > 0").select("id", "state", F.col("total_deaths").alias("deaths")).write.option(
        "rootTag", "incidents").option("rowTag", "incident").xml(path)
    return readers.read_xml(t.spark, path, "incident", "id bigint, state string, deaths bigint")


@query("s07_read_records", """
SELECT f.suffix, scian, CAST(SUM(nombre_lesions) AS BIGINT) AS total, COUNT(*) AS n FROM cnesst_lesions, (VALUES ('json'), ('array'), ('jsonl'), ('csv')) f(suffix) GROUP BY 1, 2""")
def _(t):
    root = scratch_path(t.spark, "records")
    cases = cut_lineage(t.cnesst_lesions)  # counted once for all four files
    cases.write.json(f"{root}/cases.json")
    cases.write.json(f"{root}/cases.jsonl")
    cases.write.csv(f"{root}/cases.csv", header=True)
    # one array per sector, each in a file of its own
    arrays = cases.groupBy("scian").agg(F.to_json(F.collect_list(F.struct(*cases.columns))).alias("value"))
    arrays.repartition(F.col("scian")).withColumn("part", F.col("scian")).select("part", "value").write.partitionBy("part").text(f"{root}/arrays.json")
    parts = []
    for kind, name in (("json", "cases.json"), ("array", "arrays.json"), ("jsonl", "cases.jsonl"), ("csv", "cases.csv"), ("txt", "cases.txt")):
        rows = readers.read_records(t.spark, f"{root}/{name}", "scian string, nombre_lesions bigint")
        parts.append(rows.groupBy("scian").agg(F.sum(F.col("nombre_lesions").cast("bigint")).alias("total"), F.count(F.lit(1)).alias("n")).withColumn("suffix", F.lit(kind)))
    return reduce(DataFrame.unionByName, parts)


@query("s08_read_sql", "SELECT annee, COUNT(*) AS n FROM lesions WHERE ind_lesion_psy = 'OUI' GROUP BY annee HAVING COUNT(*) > 10")
def _(t):
    return readers.read_sql(t.spark, "SELECT annee, COUNT(*) AS n FROM {rows} WHERE ind_lesion_psy = 'OUI' GROUP BY annee HAVING COUNT(*) > 10", rows=t.lesions)


def kaggle_gold(t):
    return conform.to_gold(conform.from_kaggle(t.osha_raw.select(*ESTABLISHMENT)), "OSHA", "USA", NOW)


def eurostat_gold(t):
    renamed = conform.from_eurostat(t.esaw.withColumnsRenamed({"country_code": "geo", "country_name": "geo_label", "year": "time", "incident_count": "value"}))
    return conform.to_gold(renamed, "Eurostat", "EU-27", NOW)


@query("s09_merge_gold", """
SELECT 'USA' AS jurisdiction, 'OSHA' AS source, COUNT(*) AS n, COUNT(state) AS with_state, 0 AS with_country FROM osha_raw
UNION ALL SELECT 'EU-27', 'Eurostat', COUNT(*), 0, COUNT(country_code) FROM esaw""")
def _(t):
    root = scratch_path(t.spark, "gold")
    layers.save_gold(kaggle_gold(t), root, "20240101")
    layers.save_gold(eurostat_gold(t), root, "20240101")
    merged = readers.merge_gold(t.spark, f"{root}/gold")
    return merged.groupBy("jurisdiction", "source").agg(F.count(F.lit(1)).alias("n"), F.count("state").alias("with_state"), F.count("country_code").alias("with_country"))


@query("s09_merge_conflicting", """
SELECT 'row' AS part, CAST(year_filing_for AS STRING) AS name, COUNT(*) AS n, CAST(SUM(total_injuries) AS BIGINT) AS injuries, CAST(SUM(FLOOR(total_hours_worked)) AS BIGINT) AS hours FROM osha_raw GROUP BY 2
UNION ALL SELECT 'total_injuries', t.type, NULL, NULL, NULL FROM (VALUES ('int'), ('bigint'), ('double'), ('string')) t(type)
UNION ALL SELECT 'total_hours_worked', t.type, NULL, NULL, NULL FROM (VALUES ('int'), ('bigint')) t(type)
UNION ALL SELECT 'unreadable', 'CANNOT_READ_FILE_FOOTER', 1, NULL, NULL""")
def _(t):
    # Four writers, each with its own type of a count, two with their own type of the hours, and one file that is not Parquet.
    root = scratch_path(t.spark, "gold")
    hours = {"int": "int", "bigint": "bigint", "double": "bigint", "string": "int"}
    for i, kind in enumerate(hours):
        t.osha_raw.filter(f"year_filing_for % 4 = {i}").select(
            F.col("year_filing_for").alias("year"), F.col("total_injuries").cast(kind), F.col("total_hours_worked").cast(hours[kind])).write.parquet(f"{root}/writer={kind}")
    t.spark.range(1).select(F.lit("no columns").alias("value")).coalesce(1).write.text(f"{root}/writer=other")
    merged = widening.merge_widened(t.spark, root)
    rows = merged.rows.groupBy(F.col("year").cast("string").alias("name")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("total_injuries").cast("double")).cast("bigint").alias("injuries"), F.sum("total_hours_worked").cast("bigint").alias("hours"))
    kinds = merged.conflicts.select(F.col("column").alias("part"), F.col("type").alias("name"))
    bad = merged.unreadable.groupBy(F.col("reason").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("unreadable"))
    return concat(rows.withColumn("part", F.lit("row")), kinds, bad).select("part", "name", "n", "injuries", "hours")


@query("s10_replace_table", "SELECT naics_code, COUNT(*) AS n, CAST(SUM(total_injuries) AS BIGINT) AS injuries FROM osha_raw GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "table")
    t.osha_raw.write.csv(f"{path}/landing", header=True)
    landed = t.spark.read.csv(f"{path}/landing", header=True)
    for _ in range(2):  # the second load replaces the first
        landed.write.mode("overwrite").parquet(f"{path}/osha_injuries_raw")
    return t.spark.read.parquet(f"{path}/osha_injuries_raw").groupBy("naics_code").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("total_injuries").cast("bigint")).alias("injuries"))


@query("s11_run_order", """
SELECT s.ord, s.source_key, s.priority, COALESCE(i.n, 0) AS n FROM dim_source s LEFT JOIN (SELECT jurisdiction, COUNT(*) AS n FROM incidents_global GROUP BY 1) i
ON i.jurisdiction = s.jurisdiction WHERE s.enabled AND s.priority <= 1""")
def _(t):
    rows = t.incidents_global.groupBy(F.col("jurisdiction").alias("__j")).agg(F.count(F.lit(1)).alias("n"))
    chosen = catalog.run_order(catalog.registered(t.spark), 1)
    return chosen.join(rows, F.col("jurisdiction") == F.col("__j"), "left").select("ord", "source_key", "priority", F.coalesce("n", F.lit(0)).alias("n"))


@query("s11_run_all", """
SELECT s.source_key AS source, CASE WHEN s.source_key NOT IN ('kaggle_osha_injuries', 'osha_inspections', 'eurostat_esaw', 'ilostat_injuries', 'cnesst_lesions') THEN 'failed' ELSE 'success' END AS status,
  CASE s.source_key WHEN 'kaggle_osha_injuries' THEN (SELECT COUNT(*) FROM osha_raw) WHEN 'osha_inspections' THEN (SELECT COUNT(*) FROM osha_raw) WHEN 'cnesst_lesions' THEN (SELECT COUNT(*) FROM cnesst_lesions)
    WHEN 'eurostat_esaw' THEN (SELECT COUNT(*) FROM esaw) WHEN 'ilostat_injuries' THEN (SELECT COUNT(*) FROM esaw) END AS gold_rows,
  ROW_NUMBER() OVER (ORDER BY s.priority, s.ord)::INTEGER AS position FROM dim_source s WHERE s.enabled""")
def _(t):
    identity = lambda df: df
    connectors = {
        "kaggle_osha_injuries": (lambda: t.osha_raw.select(*ESTABLISHMENT), conform.from_kaggle),
        "osha_inspections": (lambda: t.osha_raw.select(F.col("id").alias("reporting_id"), "naics_code"), conform.from_osha),
        "eurostat_esaw": (lambda: t.esaw.withColumnsRenamed({"country_code": "geo", "year": "time"}), conform.from_eurostat),
        "ilostat_injuries": (lambda: t.esaw, conform.from_ilostat), "cnesst_lesions": (lambda: t.cnesst_lesions, identity)}
    log = layers.run_all(t.spark, catalog.registered(t.spark), connectors, scratch_path(t.spark, "all"), "20240101", NOW)
    return log.select("source", "status", "gold_rows", "position")


@query("s12_connector_routes", """
SELECT c.route, COUNT(*) AS n FROM (SELECT s.jurisdiction, CASE WHEN contains(source_key, 'osha') THEN 'osha' WHEN contains(source_key, 'bls') THEN 'bls'
  WHEN contains(source_key, 'eurostat') THEN 'eurostat' WHEN contains(source_key, 'ilostat') THEN 'ilostat' WHEN contains(source_key, 'dares') THEN 'dares'
  ELSE CASE type WHEN 'kaggle' THEN 'kaggle' WHEN 'api' THEN 'osha' WHEN 'sdmx' THEN 'eurostat' WHEN 'file' THEN 'dares' ELSE 'base' END END AS route
  FROM dim_source s) c JOIN incidents_global i ON i.jurisdiction = c.jurisdiction GROUP BY 1""")
def _(t):
    routes = catalog.registered(t.spark).select(
        F.col("jurisdiction").alias("__j"), catalog.connector(F.col("source_key"), F.col("type")).alias("route"))
    return t.incidents_global.join(F.broadcast(routes), F.col("jurisdiction") == F.col("__j")).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query("s13_feature_extract", "SELECT * FROM feature_input", feature_input=FEATURE_INPUT)
def _(t):
    return feature_input(t)


# -- layers and sinks --------------------------------------------------------------------

def _layer_query(layer):
    def run(t):
        path, rows = layers.save_layer(t.osha_raw, scratch_path(t.spark, layer), layer, "osha", "20240101")
        stored = t.spark.read.parquet(path)
        return agg.counts_by(stored, ["year_filing_for", "naics_code"]).withColumn("written", F.lit(rows).cast("bigint"))
    return run


LAYER_SQL = "SELECT year_filing_for, naics_code, COUNT(*) AS n, (SELECT COUNT(*) FROM osha_raw) AS written FROM osha_raw GROUP BY 1, 2"
query("k01_save_bronze", LAYER_SQL)(_layer_query("bronze"))
query("k02_save_silver", LAYER_SQL)(_layer_query("silver"))


@query("k03_save_gold", """
SELECT 'USA' AS jurisdiction, src AS source, day AS run, naics_code AS industry_code, COUNT(*) AS n FROM osha_raw, (VALUES ('OSHA', '20240101'), ('OSHA', '20240102'), ('ITA', '20240101')) v(src, day)
WHERE day = '20240101' OR total_deaths = 0 GROUP BY 2, 3, 4""")
def _(t):
    # Two sources of one jurisdiction, one of them on two days and once more on the first: no day is lost, none is doubled.
    root = scratch_path(t.spark, "gold")
    base = conform.from_kaggle(t.osha_raw.select(*ESTABLISHMENT))
    for source, day in (("OSHA", "20240101"), ("ITA", "20240101"), ("OSHA", "20240102"), ("OSHA", "20240101")):
        rows = base if day == "20240101" else base.filter("fatalities = 0")
        layers.save_gold(conform.to_gold(rows, source, "USA", NOW), root, day)
    stored = readers.merge_gold(t.spark, f"{root}/gold").withColumn("run", F.col("run").cast("string"))
    return agg.counts_by(stored, ["jurisdiction", "source", "run", "industry_code"])


@query("k04_save_json", "SELECT * FROM osha_unified", **HPARTS)
def _(t):
    path = scratch_path(t.spark, "json")
    unified = har.transform_osha(t.osha_records, DAY)
    layers.save_json(unified, path)
    return flatten(t.spark.read.schema(unified.drop("_source_record").schema).json(path))


@query("k05_export_csv", "SELECT source, CAST(year AS STRING) AS year, sector, CAST(total_cases AS STRING) AS total_cases, risk_category FROM features",
       feature_input=FEATURE_INPUT, features=FEATURES)
def _(t):
    path = layers.export_csv(feat.derive_features(feature_input(t)), scratch_path(t.spark, "features"))
    return t.spark.read.csv(path, header=True).select("source", "year", "sector", "total_cases", "risk_category")


@query("k06_load_gold", """
SELECT 'batch_1' AS ingestion_batch_id, year_filing_for AS year, 'NAICS' AS industry_code_system, COUNT(*) AS n, COUNT(naics_code) AS with_code,
  (SELECT COUNT(*) FROM osha_raw) AS written FROM osha_raw GROUP BY 2""")
def _(t):
    target = scratch_path(t.spark, "warehouse")
    rows = layers.load_gold(kaggle_gold(t), target, "batch_1", NOW)
    return t.spark.read.parquet(target).groupBy("ingestion_batch_id", "year", "industry_code_system").agg(
        F.count(F.lit(1)).alias("n"), F.count("industry_code").alias("with_code")).withColumn("written", F.lit(rows).cast("bigint"))


@query("k07_land_raw", "SELECT country_code, 2 * COUNT(*) AS n FROM esaw GROUP BY 1")
def _(t):
    root = scratch_path(t.spark, "landing")
    for _ in range(2):
        layers.land_raw(t.esaw, root, "eurostat")
    return agg.counts_by(t.spark.read.parquet(f"{root}/raw/eurostat"), ["country_code"])


@query("k08_save_features", "SELECT source, risk_category, COUNT(*) AS n FROM features GROUP BY 1, 2", feature_input=FEATURE_INPUT, features=FEATURES)
def _(t):
    root = scratch_path(t.spark, "store")
    layers.save_features(feat.derive_features(feature_input(t)), root)
    return agg.counts_by(t.spark.read.parquet(root), ["source", "risk_category"])


TOP = ("SELECT string_agg(valeur || '=' || CAST(total AS STRING) || '/' || CAST(CAST(pct * 100 AS BIGINT) AS STRING), ',' ORDER BY rank) FROM tops x "
       "WHERE x.secteur_scian = p.secteur_scian AND colonne = '{}'")


@query("k10_enrichment_json", f"""
SELECT p.secteur_scian, p.total_lesions, p.pct_total_qc, p.risk_score, p.risk_level, p.risk_tms_pct, p.risk_psy_pct, p.top_nature_lesion AS top_nature,
  p.top_siege_lesion AS top_siege, p.top_agent_causal AS top_agent, r.recommandations_ia,
  (SELECT string_agg(indicateur || ':' || CAST(CAST(taux_secteur * 100 AS BIGINT) AS STRING) || ':' || CAST(CAST(taux_provincial * 100 AS BIGINT) AS STRING) || ':' || statut, ',' ORDER BY ord)
     FROM bench b WHERE b.secteur_scian = p.secteur_scian) AS benchmarks,
  (SELECT string_agg(CAST(annee AS STRING) || '=' || CAST(n AS STRING), ',' ORDER BY annee) FROM sector_year y WHERE y.secteur_scian = p.secteur_scian) AS tendances,
  ({TOP.format("nature_lesion")}) AS top_5_natures, ({TOP.format("siege_lesion")}) AS top_5_sieges, ({TOP.format("agent_causal_lesion")}) AS top_5_agents
FROM profile p JOIN recs r ON p.secteur_scian = r.secteur_scian""", **FBASE)
def _(t):
    entry = "array<struct<valeur:string,total:bigint,pct:double>>"
    schema = ("struct<secteur_scian:string,risk_profile:struct<total_lesions:bigint,pct_total_qc:double,risk_score:double,risk_level:string,risk_tms_pct:double,"
              "risk_psy_pct:double,top_nature:string,top_siege:string,top_agent:string>,benchmarks:array<struct<indicateur:string,taux_secteur:double,taux_provincial:double,"
              f"statut:string>>,tendances:map<string,bigint>,top_5_natures:{entry},top_5_sieges:{entry},top_5_agents:{entry},recommandations_ia:array<string>>")
    rows = enr.enrichment_json(enr.full_enrichment(t.lesions, STEPS)).select(F.from_json("document", schema).alias("d")).select("d.*")
    cents = lambda c: F.round(c * 100).cast("bigint").cast("string")
    top = lambda c: F.array_join(F.transform(c, lambda v: F.concat(v["valeur"], F.lit("="), v["total"].cast("string"), F.lit("/"), cents(v["pct"]))), ",").alias(c)
    marks = F.transform("benchmarks", lambda b: F.concat_ws(":", b["indicateur"], cents(b["taux_secteur"]), cents(b["taux_provincial"]), b["statut"]))
    years = F.transform(F.array_sort(F.map_keys("tendances")), lambda y: F.concat(y, F.lit("="), F.col("tendances")[y].cast("string")))
    return rows.select("secteur_scian", "risk_profile.*", F.array_join("recommandations_ia", " | ").alias("recommandations_ia"), F.array_join(marks, ",").alias("benchmarks"),
                       F.array_join(years, ",").alias("tendances"), top("top_5_natures"), top("top_5_sieges"), top("top_5_agents"))


# -- column contracts --------------------------------------------------------------------

@query("p01_from_kaggle", """
SELECT establishment_name, state, naics_code AS industry_code, industry_description AS industry_name, total_hours_worked AS hours_worked, total_deaths AS fatalities,
  total_injuries AS total_incidents, year_filing_for AS year, 'NAICS' AS industry_code_system,
  ROUND(CASE WHEN total_hours_worked <> 0 THEN CAST(total_injuries AS DOUBLE) / total_hours_worked * 200000 END, 2) AS incidence_rate FROM osha_raw""")
def _(t):
    return conform.from_kaggle(t.osha_raw.select(*ESTABLISHMENT))


@query("p02_from_osha", """
SELECT id AS incident_id, establishment_name, state, naics_code AS industry_code, 'NAICS' AS industry_code_system, 'osha_inspection' AS source_table FROM osha_raw""")
def _(t):
    source = t.osha_raw.select(F.col("id").alias("reporting_id"), F.col("establishment_name").alias("estab_name"), F.col("state").alias("site_state"), "naics_code")
    return conform.from_osha(source)


@query("p03_from_bls", "SELECT series_id, year, period, value, CASE series_id WHEN 'FWU00X4XXXXXXXX1' THEN 'fatal_injuries_total' ELSE series_id END AS indicator FROM series_rows",
       series_rows=SERIES)
def _(t):
    return conform.from_bls(series_of(t).drop("footnotes"))


@query("p04_from_eurostat", """
SELECT geo AS country_code, geo_label AS country_name, time AS year, time_label, value AS incident_count, 'NACE_REV2' AS industry_code_system FROM cube_rows""", cube_rows=CUBE)
def _(t):
    return conform.from_eurostat(cube_of(t))


@query("p05_from_ilostat", "SELECT country_code, year, incident_count AS value, 'ISIC' AS industry_code_system FROM esaw")
def _(t):
    return conform.from_ilostat(t.esaw.select(F.col("country_code").alias("REF_AREA"), F.col("year").alias("TIME_PERIOD"), F.col("incident_count").alias("OBS_VALUE")))


@query("p06_from_dares", """
SELECT secteur_scian AS industry_name, annee AS year, n AS incident_count, 'NAF' AS industry_code_system FROM sector_year""")
def _(t):
    path = scratch_path(t.spark, "dares")
    counted = agg.counts_by(t.lesions, ["secteur_scian", "annee"])
    counted.withColumnsRenamed({"secteur_scian": "Secteur d'activité", "annee": "Année", "n": "Nombre d'AT"}).write.parquet(path)
    return conform.from_dares(t.spark.read.parquet(path))


@query("p07_to_gold", """
SELECT 'OSHA' AS source, 'USA' AS jurisdiction, year_filing_for AS year, naics_code AS industry_code, CAST(NULL AS STRING) AS incident_type, CAST(NULL AS DOUBLE) AS days_lost,
  COUNT(*) AS n FROM osha_raw GROUP BY ALL UNION ALL
SELECT 'Eurostat', 'EU-27', year, NULL, NULL, NULL, COUNT(*) FROM esaw GROUP BY ALL""")
def _(t):
    keys = ["source", "jurisdiction", "year", "industry_code", "incident_type", "days_lost"]
    return agg.counts_by(kaggle_gold(t), keys).unionByName(agg.counts_by(eurostat_gold(t), keys))


@query("p08_run_layers", """
SELECT 'OSHA' AS source, 'success' AS status, COUNT(*) AS bronze_rows, COUNT(*) AS silver_rows, COUNT(*) AS gold_rows FROM osha_raw
UNION ALL SELECT 'ILOSTAT', 'success', COUNT(*), COUNT(*), COUNT(*) FROM esaw UNION ALL SELECT 'Empty', 'empty', 0, 0, 0 UNION ALL SELECT 'Broken', 'failed', NULL, NULL, NULL""")
def _(t):
    return _run_log(t).drop("error")


def _run_log(t):
    root = scratch_path(t.spark, "layers")
    run = lambda name, where, fetch, change: layers.run_layers(t.spark, name, where, fetch, change, root, "20240101", NOW)
    logs = [run("OSHA", "USA", lambda: t.osha_raw.select(*ESTABLISHMENT), conform.from_kaggle), run("ILOSTAT", "International", lambda: t.esaw, conform.from_ilostat),
            run("Empty", "France", lambda: t.esaw.filter("year < 0"), conform.from_dares), run("Broken", "France", lambda: t.esaw.select("no_such_column"), conform.from_dares)]
    return logs[0].union(logs[1]).union(logs[2]).union(logs[3])


@query("a40_run_report", """
SELECT CAST(4 AS BIGINT) AS total_sources, CAST(2 AS BIGINT) AS successful, CAST(1 AS BIGINT) AS failed, (SELECT COUNT(*) FROM osha_raw) + (SELECT COUNT(*) FROM esaw) AS total_rows_ingested""")
def _(t):
    return agg.run_report(_run_log(t))


@query("p09_whitelisted", """
SELECT 'OSHA' AS source, 'USA' AS jurisdiction, year_filing_for AS year, naics_code AS industry_code, industry_description AS industry_name, 'NAICS' AS industry_code_system FROM osha_raw""")
def _(t):
    return conform.whitelisted(kaggle_gold(t), ("source", "jurisdiction", "year", "no_such", "industry_code", "industry_name", "industry_code_system"))


@query("p20_normalize", """
SELECT 'incident:osha:' || CAST(year_filing_for AS STRING) || ':' || CAST(id AS STRING) AS incident_uri, industry_description AS sector,
  CASE lower(industry_description) WHEN 'construction' THEN '23' ELSE industry_description END AS scian_code,
  CASE WHEN total_deaths > 0 THEN 'Fatal' WHEN days_away > 20 THEN 'serious' ELSE 'Other' END AS severity,
  CASE WHEN total_deaths > 0 THEN 'CRITICAL' WHEN days_away > 20 THEN 'HIGH' ELSE 'MEDIUM' END AS severity_normalized, 'osha' AS source FROM osha_raw""")
def _(t):
    severity = F.when(F.col("total_deaths") > 0, "Fatal").when(F.col("days_away") > 20, "serious").otherwise("Other")
    raw = t.osha_raw.select("id", F.col("year_filing_for").alias("when"), F.col("industry_description").alias("branch"), severity.alias("severity"))
    out = conform.normalize(raw, "osha", "id", NOW, names={"when": "date", "branch": "sector"})
    return out.drop("id", "date", "ingested_at")


@query("p21_integrate_file", """
SELECT source, outputs, extracted, harmonized, valid, CASE WHEN outputs IN ('json', 'all') THEN harmonized ELSE 0 END AS written,
  CASE outputs WHEN 'json' THEN 0 WHEN 'all' THEN harmonized + nodes WHEN 'graph' THEN nodes ELSE harmonized END AS loaded
FROM (VALUES ('json'), ('graph'), ('table'), ('all')) o(outputs), (
  SELECT 'osha' AS source, COUNT(*) AS extracted, COUNT(*) AS harmonized, COUNT(*) AS valid, COUNT(DISTINCT risk_id) AS nodes FROM osha_unified
  UNION ALL SELECT 'cnesst', COUNT(*), COUNT(*), COUNT(*), COUNT(DISTINCT risk_id) FROM cnesst_unified
  UNION ALL SELECT 'esaw', (SELECT COUNT(*) FROM esaw), COUNT(*), COUNT(*), COUNT(DISTINCT risk_id) FROM esaw_good)""",
       esaw_good="SELECT * FROM esaw_unified WHERE period_start NOT IN ('2011-01-01', '2013-01-01', '2017-01-01')", **HPARTS)
def _(t):
    root = scratch_path(t.spark, "integrate")
    t.osha_records.write.csv(f"{root}/osha.csv", header=True)
    t.cnesst_lesions.write.csv(f"{root}/cnesst.csv", header=True)
    malformed_input(t).write.csv(f"{root}/esaw.csv", header=True)
    logs = []
    for kind in ("osha", "cnesst", "esaw"):  # one attempt for each file, delivered to each sink alone and to all
        attempt = layers.store_attempt(layers.read_records(t.spark, f"{root}/{kind}.csv"), f"{root}/{kind}", DAY, har.SCHEMA)
        logs += [layers.deliver(attempt, f"{root}/{kind}_{sink}", [sink]).withColumn("outputs", F.lit(sink)) for sink in (*layers.OUTPUTS, "all")]
    return reduce(DataFrame.unionByName, logs)


# -- warehouse state -------------------------------------------------------------------------

def _runs(t, factor):
    rows = t.incidents_global.groupBy("source", "jurisdiction").agg((F.count(F.lit(1)) * factor).alias("rows"))
    return rows.select(F.col("source").alias("source_key"), F.concat(F.lit("Source "), F.col("source")).alias("source_name"), "jurisdiction", "rows",
                       F.lit("success").alias("status"), F.lit(None).cast("string").alias("error_message"))


def _status(t):
    first = wh.update_sources(wh.empty_status(t.spark), _runs(t, 1).filter("source_key = 'OSHA'"), NOW)
    return wh.update_sources(first, _runs(t, 2), datetime(2024, 1, 2))


STATUS = """SELECT source AS source_key, 'Source ' || source AS source_name, jurisdiction, TIMESTAMP '2024-01-02 00:00:00' AS last_ingestion,
  CASE source WHEN 'OSHA' THEN 3 ELSE 2 END * COUNT(*) AS rows_ingested, CASE source WHEN 'OSHA' THEN 2 * COUNT(*) ELSE 0 END AS total_rows, 'success' AS status
FROM incidents_global GROUP BY 1, 2, 3"""


@query("t01_update_sources", "SELECT source_key, source_name, jurisdiction, rows_ingested, total_rows, status FROM source_rows", source_rows=STATUS)
def _(t):
    return _status(t).select("source_key", "source_name", "jurisdiction", "rows_ingested", "total_rows", "status")


@query("t01_upsert_touched", same_as="t01_update_sources")
def _(t):
    table = kt.create(wh.empty_status(t.spark), scratch_path(t.spark, "sources"), ("source_key",))
    for d, runs in ((1, _runs(t, 1).filter("source_key = 'OSHA'")), (2, _runs(t, 2))):
        kt.upsert_stored(table, runs, lambda old, new, d=d: wh.update_sources(old, new, datetime(2024, 1, d)))
    return kt.read(t.spark, table).select("source_key", "source_name", "jurisdiction", "rows_ingested", "total_rows", "status")


@query("a20_source_status", "SELECT * FROM source_rows", source_rows=STATUS)
def _(t):
    return wh.source_status(_status(t))


@query("t02_batch_log", """
SELECT 'batch_' || CAST(year AS STRING) AS batch_id, 'success' AS status, COUNT(*) AS total_rows_ingested FROM incidents_global GROUP BY 1""")
def _(t):
    rows = t.incidents_global.withColumn("batch", F.concat(F.lit("batch_"), F.col("year").cast("string")))
    return wh.batch_log(rows, "batch", NOW).select("batch_id", "status", "total_rows_ingested")


KEYS = ["incident_id", "source"]


@query("t03_unique_rows", """
SELECT incident_id, source, jurisdiction, year, industry_code, incident_type, days_lost, copies FROM (SELECT *, COUNT(*) OVER (PARTITION BY incident_id, source) AS copies,
  ROW_NUMBER() OVER (PARTITION BY incident_id, source ORDER BY jurisdiction, year, industry_code NULLS FIRST, incident_type, days_lost) AS rn FROM incidents_global) WHERE rn = 1""")
def _(t):
    return wh.unique_rows(t.incidents_global, KEYS)


@query("t03_new_rows", """
SELECT * EXCLUDE rn FROM (SELECT incident_id, source, jurisdiction, year, industry_code, incident_type, days_lost, COUNT(*) OVER (PARTITION BY incident_id, source) AS copies,
  ROW_NUMBER() OVER (PARTITION BY incident_id, source ORDER BY jurisdiction, year, industry_code NULLS FIRST, incident_type, days_lost) AS rn FROM incidents_global) u
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM incidents_global s WHERE s.incident_id = u.incident_id AND s.source = u.source AND s.incident_type <> 'non-fatal')""")
def _(t):
    return wh.unique_rows(t.incidents_global, KEYS, existing=t.incidents_global.filter("incident_type <> 'non-fatal'"))


@query("t03_rejected_rows", """
SELECT incident_id, source, jurisdiction, year, industry_code, incident_type, days_lost, COUNT(*) AS rejected FROM (SELECT *,
  ROW_NUMBER() OVER (PARTITION BY incident_id, source ORDER BY jurisdiction, year, industry_code NULLS FIRST, incident_type, days_lost) AS rn FROM incidents_global)
WHERE rn > 1 GROUP BY ALL""")
def _(t):
    return wh.rejected_rows(t.incidents_global, KEYS)


@query("t04_seed_missing", """
SELECT code, seen FROM (SELECT domain AS code, COUNT(*) AS seen FROM osha_unified WHERE domain <> 'AUTRE' GROUP BY 1)
UNION ALL SELECT code, NULL FROM dim_risk_domain WHERE code NOT IN (SELECT domain FROM osha_unified WHERE domain <> 'AUTRE')""", **HPARTS)
def _(t):
    from harmlens.operators.lookups import osha_event

    seen = osha_event(t.osha_records, prefix="").filter("domain <> 'AUTRE'").groupBy(F.col("domain").alias("code")).agg(F.count(F.lit(1)).alias("seen"))
    return wh.seed_missing(seen, dims.frame(t.spark, dims.RISK_DOMAIN).select("code"), ["code"])


@query("t05_industry_mapping", f"""
SELECT c.scian AS scian_code, d.nace AS nace_code, d.name_en AS industry_name_en, (SELECT string_agg(risk_type, '|' ORDER BY risk_ord) FROM dim_sector_risk r WHERE r.sector = c.scian) AS hazards,
  CAST(SUM(c.nombre_lesions) AS BIGINT) AS cases, {ratio('SUM(c.jours_perdus)', 'SUM(c.nombre_lesions)')} AS severity
FROM cnesst_lesions c JOIN dim_sector_crosswalk d ON d.scian = c.scian GROUP BY 1, 2, 3, 4""")
def _(t):
    from harmlens.functions.exprs import ratio as exact

    mapping = F.broadcast(wh.industry_mapping(t.spark))
    joined = t.cnesst_lesions.groupBy("scian").agg(F.sum("nombre_lesions").alias("cases"), F.sum("jours_perdus").alias("days")).join(
        mapping, F.col("scian") == F.col("scian_code"))
    return joined.select("scian_code", "nace_code", "industry_name_en", F.array_join("typical_hazards", "|").alias("hazards"), "cases", exact("days", "cases").alias("severity"))


@query("t06_merge_nodes", """
SELECT COALESCE(a.naics_code, b.naics_code) AS code, CASE WHEN a.naics_code IS NULL THEN 'created' WHEN b.naics_code IS NULL THEN 'kept' ELSE 'matched' END AS state,
  COALESCE(b.n, a.n) AS total, a.n AS first_total FROM (SELECT naics_code, COUNT(*) AS n FROM osha_raw WHERE naics_code <> '62' GROUP BY 1) a
FULL JOIN (SELECT naics_code, COUNT(*) AS n FROM osha_records GROUP BY 1) b ON a.naics_code = b.naics_code""")
def _(t):
    return _merge_nodes(*_nodes(t))


def _nodes(t):
    old = t.osha_raw.filter("naics_code <> '62'").groupBy(F.col("naics_code").alias("code")).agg(F.count(F.lit(1)).alias("total")).select(
        "code", F.lit("kept").alias("state"), "total", F.col("total").alias("first_total"))
    new = t.osha_records.groupBy(F.col("naics_code").alias("code")).agg(F.count(F.lit(1)).alias("seen"))
    return old, new


def _merge_nodes(old, new):
    return wh.upsert(old, new, ["code"], on_create={"state": F.lit("created"), "total": F.col("n.seen")}, on_match={"state": F.lit("matched"), "total": F.col("n.seen")})


@query("t06_upsert_touched", same_as="t06_merge_nodes")
def _(t):
    old, new = _nodes(t)
    table = kt.create(old, scratch_path(t.spark, "nodes"), ("code",))
    kt.upsert_stored(table, new, _merge_nodes)
    return kt.read(t.spark, table)
