"""Queries H01-H21, J01-J03 and K09: code lookups and harmonised records."""

from datetime import date

from pyspark.sql import functions as F

from harmlens.operators import harmonize as har
from harmlens.operators import json_schema as js
from harmlens.operators import lookups as lk
from harmlens.operators.aggregates import counts_by
from harmlens.plans.registry import query
from harmlens.sources import variants
from harmlens.workspace import scratch_path

AS_OF = date(2024, 1, 1)
CASE_ID = ["annee", "scian", "genre_accident", "nature_lesion"]

EVENT = """SELECT r.event_type, COALESCE(a.hazard_code, b.hazard_code, 'AUTRE-99') AS hazard_code, COALESCE(a.domain, b.domain, 'AUTRE') AS domain,
  COALESCE(a.label_fr, b.label_fr, 'Non classé') AS label_fr, COALESCE(a.label_en, b.label_en, 'Unclassified') AS label_en, r.id, r.nature, r.body_part, r.naics_code
FROM osha_records r LEFT JOIN dim_osha_event a ON a.code = r.event_type
LEFT JOIN dim_osha_event b ON length(r.event_type) > 2 AND b.code = substr(r.event_type, 1, 2)"""


@query("h01_osha_event", "SELECT event_type, hazard_code, domain, label_fr, label_en, COUNT(*) AS n FROM ev GROUP BY ALL", ev=EVENT)
def _(t):
    out = lk.osha_event(t.osha_records, prefix="")
    return counts_by(out, ["event_type", "hazard_code", "domain", "label_fr", "label_en"])


@query("h02_osha_nature", """
SELECT r.nature, COALESCE(a.nature_code, b.nature_code, 'NAT-99') AS nature_code, COALESCE(a.label_fr, b.label_fr, 'Non spécifié') AS label_fr,
  COALESCE(a.label_en, b.label_en, 'Unspecified') AS label_en, COUNT(*) AS n FROM osha_records r LEFT JOIN dim_osha_nature a ON a.code = r.nature
LEFT JOIN dim_osha_nature b ON length(r.nature) > 2 AND b.code = substr(r.nature, 1, 2) || '1' GROUP BY ALL""")
def _(t):
    return counts_by(lk.osha_nature(t.osha_records, prefix=""), ["nature", "nature_code", "label_fr", "label_en"])


@query("h03_osha_bodypart", """
SELECT r.body_part, COALESCE(a.part_code, b.part_code, 'BP-99') AS part_code, COALESCE(a.label_fr, b.label_fr, 'Non spécifié') AS label_fr,
  COALESCE(a.label_en, b.label_en, 'Unspecified') AS label_en, COUNT(*) AS n FROM osha_records r LEFT JOIN dim_osha_bodypart a ON a.code = r.body_part
LEFT JOIN dim_osha_bodypart b ON length(r.body_part) > 1 AND b.code = substr(r.body_part, 1, 1) GROUP BY ALL""")
def _(t):
    return counts_by(lk.osha_bodypart(t.osha_records, prefix=""), ["body_part", "part_code", "label_fr", "label_en"])


def _exact(view: str, key: str, dim: str) -> str:
    return f"""SELECT r.{key}, COALESCE(a.hazard_code, 'AUTRE-99') AS hazard_code, COALESCE(a.domain, 'AUTRE') AS domain,
  COALESCE(a.label_fr, 'Non classé') AS label_fr, COALESCE(a.label_en, 'Unclassified') AS label_en, COUNT(*) AS n
FROM {view} r LEFT JOIN {dim} a ON a.code = r.{key} GROUP BY ALL"""


HAZARD = ["hazard_code", "domain", "label_fr", "label_en"]


@query("h04_esaw_deviation", _exact("esaw", "deviation", "dim_esaw_deviation"))
def _(t):
    return counts_by(lk.esaw_deviation(t.esaw, prefix=""), ["deviation", *HAZARD])


@query("h05_cnesst_genre", _exact("cnesst_lesions", "genre_accident", "dim_cnesst_genre"))
def _(t):
    return counts_by(lk.cnesst_genre(t.cnesst_lesions, prefix=""), ["genre_accident", *HAZARD])


INDUSTRY_SQL = """SELECT r.naics_code, COALESCE(a.nace, '') AS nace, COALESCE(a.isic, '') AS isic, COALESCE(a.label, '') AS label, COUNT(*) AS n
FROM osha_records r LEFT JOIN dim_industry a ON a.code = r.naics_code GROUP BY ALL"""


@query("h06_industry", INDUSTRY_SQL)
def _(t):
    return counts_by(lk.industry(t.osha_records, prefix=""), ["naics_code", "nace", "isic", "label"])


@query("h07_unified_exact", _exact("osha_records", "event_type", "dim_osha_event"))
def _(t):
    return counts_by(lk.unified_exact(t.osha_records, "osha", "event_type", prefix=""), ["event_type", *HAZARD])


def sql_uuid(h: str) -> str:
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || substr({h}, 17, 4) "
            f"|| '-' || substr({h}, 21, 12)")


def sql_code(domain: str, jur: str, key: str) -> str:
    number = f"(CAST('0x' || substr(md5({domain} || {jur} || {key}), 1, 8) AS BIGINT) % 100000000)"
    return f"upper(substr({domain}, 1, 4)) || '-' || upper({jur}) || '-' || lpad(CAST({number} AS STRING), 8, '0')"


OSHA_KEY = "concat_ws('|', e.id, e.event_type, e.nature, e.body_part, e.naics_code)"
OSHA_UNIFIED = f"""SELECT {sql_uuid(f"md5('osha|' || {OSHA_KEY})")} AS risk_id, {sql_code('e.domain', "'US'", OSHA_KEY)} AS risk_code,
  'ACTIVE' AS status, e.label_en AS title_en, 'US' AS country, '' AS subdivision, e.domain, e.event_type AS source_code,
  e.naics_code AS scian, COALESCE(i.nace, '') AS nace, COALESCE(i.isic, '') AS isic, CAST(NULL AS BIGINT) AS incidents, CAST(NULL AS BIGINT) AS lost_days,
  '' AS period_start, 'OSHA_SEVERE_INJURY' AS source_system, 'osha,usa,' || lower(e.domain) AS tags
FROM ev e LEFT JOIN dim_industry i ON i.code = e.naics_code"""
ESAW_KEY = "concat_ws('|', 'OBS_VALUE=' || r.incident_count, 'TIME_PERIOD=' || CAST(r.year AS STRING), 'deviation=' || r.deviation, 'geo=' || r.country_code)"
CNESST_KEY = ("concat_ws('|', 'annee=' || CAST(r.annee AS STRING), 'genre_accident=' || r.genre_accident, 'jours_perdus=' || CAST(r.jours_perdus AS STRING), "
              "'nature_lesion=' || r.nature_lesion, 'nombre_lesions=' || CAST(r.nombre_lesions AS STRING), 'scian=' || r.scian)")
ESAW_UNIFIED = f"""SELECT {sql_uuid(f"md5('esaw|' || {ESAW_KEY})")} AS risk_id,
  {sql_code("COALESCE(a.domain, 'AUTRE')", "upper(substr(COALESCE(r.country_code, 'EU'), 1, 2))", ESAW_KEY)} AS risk_code, 'ACTIVE' AS status,
  COALESCE(a.label_en, 'Unclassified') AS title_en, upper(substr(COALESCE(r.country_code, 'EU'), 1, 2)) AS country, '' AS subdivision,
  COALESCE(a.domain, 'AUTRE') AS domain, r.deviation AS source_code, '' AS scian, '' AS nace, '' AS isic, CAST(r.incident_count AS BIGINT) AS incidents,
  CAST(NULL AS BIGINT) AS lost_days, CAST(r.year AS STRING) || '-01-01' AS period_start, 'EUROSTAT_ESAW' AS source_system,
  'esaw,eurostat,' || lower(substr(COALESCE(r.country_code, 'EU'), 1, 2)) || ',' || lower(COALESCE(a.domain, 'AUTRE')) AS tags
FROM esaw r LEFT JOIN dim_esaw_deviation a ON a.code = r.deviation"""
CNESST_UNIFIED = f"""SELECT {sql_uuid(f"md5('cnesst|' || {CNESST_KEY})")} AS risk_id, {sql_code("COALESCE(a.domain, 'AUTRE')", "'QC'", CNESST_KEY)} AS risk_code,
  'ACTIVE' AS status, COALESCE(a.label_en, 'Unclassified') AS title_en, 'CA' AS country, 'CA-QC' AS subdivision,
  COALESCE(a.domain, 'AUTRE') AS domain, r.genre_accident AS source_code, r.scian, COALESCE(i.nace, '') AS nace, '' AS isic,
  r.nombre_lesions AS incidents, r.jours_perdus AS lost_days, '' AS period_start, 'CNESST' AS source_system,
  'cnesst,quebec,canada,' || lower(COALESCE(a.domain, 'AUTRE')) AS tags
FROM cnesst_lesions r LEFT JOIN dim_cnesst_genre a ON a.code = r.genre_accident LEFT JOIN dim_industry i ON i.code = r.scian"""


def flatten(unified, *more):
    """The unified record's main fields as plain columns."""
    empty = F.lit("")
    h = "hazard_classification"
    return unified.select(
        "risk_id", "risk_code", "status", F.col("title.en").alias("title_en"), F.coalesce("jurisdiction.primary_country", empty).alias("country"),
        F.coalesce("jurisdiction.subdivision.code", empty).alias("subdivision"), F.col(f"{h}.unified.domain_code").alias("domain"),
        F.coalesce(f"{h}.osha_usa.event_type_code", f"{h}.esaw.deviation_code", f"{h}.cnesst.genre_accident_code", empty).alias("source_code"),
        F.coalesce("industry_classification.scian.code", empty).alias("scian"), F.coalesce("industry_classification.nace.code", empty).alias("nace"),
        F.coalesce("industry_classification.isic.code", empty).alias("isic"), F.col("incident_statistics.total_incidents").alias("incidents"),
        F.col("incident_statistics.total_lost_days").alias("lost_days"),
        F.coalesce("incident_statistics.reporting_period.start_date", empty).alias("period_start"),
        F.col("data_provenance.source_system").alias("source_system"), F.coalesce(F.array_join("metadata.tags", ","), empty).alias("tags"), *more)


def esaw_input(t):
    return t.esaw.select("deviation", F.col("country_code").alias("geo"), F.col("incident_count").alias("OBS_VALUE"), F.col("year").alias("TIME_PERIOD"))


UNHASHED = [c for c in ("status title_en country subdivision domain source_code scian nace isic incidents lost_days period_start "
                        "source_system tags").split()]


@query("h08_osha_unified", "SELECT * FROM osha_unified", ev=EVENT, osha_unified=OSHA_UNIFIED)
def _(t):
    return flatten(har.transform_osha(t.osha_records, AS_OF))


@query("h09_esaw_unified", "SELECT * FROM esaw_unified", esaw_unified=ESAW_UNIFIED)
def _(t):
    return flatten(har.transform_esaw(esaw_input(t), AS_OF))


@query("h10_cnesst_unified", "SELECT * FROM cnesst_unified", cnesst_unified=CNESST_UNIFIED)
def _(t):
    return flatten(har.transform_cnesst(t.cnesst_lesions, AS_OF))


def mixed_records(t):
    """Rows of every source as string maps, plus conversation turns that fit none."""
    as_map = lambda df: df.select(F.create_map(*[
        part for c in df.columns for part in (F.lit(c), F.col(c).cast("string"))]).alias("record"))
    parts = [as_map(t.osha_records), as_map(esaw_input(t)), as_map(t.cnesst_lesions), as_map(t.base("conversations").select("conv_id", "role"))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


PLAIN = ", ".join(UNHASHED)
ALL_FIELDS = f"risk_id, risk_code, {PLAIN}"


def generic_sql(*fields: str) -> str:
    key = "concat_ws('|', " + ", ".join(f"'{f}=' || CAST(c.{f} AS STRING)" for f in sorted(fields)) + ")"
    return GENERIC.format(id=sql_uuid(f"md5('generic|' || {key})"), code=sql_code("'AUTRE'", "'XX'", key))


GENERIC = """SELECT {id} AS risk_id, {code} AS risk_code, 'DRAFT' AS status, 'Unclassified Record' AS title_en, '' AS country, '' AS subdivision, 'AUTRE' AS domain, '' AS source_code,
  '' AS scian, '' AS nace, '' AS isic, CAST(NULL AS BIGINT) AS incidents, CAST(NULL AS BIGINT) AS lost_days, '' AS period_start,
  'MANUAL_ENTRY' AS source_system, '' AS tags FROM conversations c"""
MIXED = " UNION ALL ".join(f"SELECT {ALL_FIELDS} FROM {source}_unified" for source in ("osha", "esaw", "cnesst", "generic"))
PARTS = {"ev": EVENT, "osha_unified": OSHA_UNIFIED, "esaw_unified": ESAW_UNIFIED, "cnesst_unified": CNESST_UNIFIED,
         "generic_unified": generic_sql("conv_id", "role"), "mixed": MIXED}


@query("h11_transform_mixed", f"SELECT {ALL_FIELDS}, COUNT(*) AS n FROM mixed GROUP BY ALL", **PARTS)
def _(t):
    return flatten(har.transform_mixed(mixed_records(t), AS_OF, counted=True), "n")


def landed_variants(t):
    """Rows of every source as JSON lines with numbers, conversation turns that fit none, and as many lines that hold no record."""
    turns = t.base("conversations")
    frames = (t.osha_records, esaw_input(t), t.cnesst_lesions, turns.select("conv_id", "role"))
    lines = [df.select(F.to_json(F.struct("*")).alias("value")) for df in frames]
    lines.append(turns.select(F.concat(F.lit('{"conv_id": '), F.col("conv_id").cast("string")).alias("value")))
    lines.append(turns.select(F.to_json(F.array("conv_id")).alias("value")))
    folder = scratch_path(t.spark, "lines")
    for part in lines:
        part.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", 500_000).text(f"{folder}/text")
    variants.land_variants(t.spark, f"{folder}/text", f"{folder}/parsed")
    return f"{folder}/parsed"


@query("h11_variant", same_as="h11_transform_mixed")
def _(t):
    records = variants.landed_records(t.spark, landed_variants(t))
    return flatten(har.transform_variants(records, AS_OF, counted=True), "n")


@query("h11_variant_rejects", "SELECT r AS reason, COUNT(*) AS n FROM conversations, (VALUES ('not JSON'), ('not an object')) v(r) GROUP BY 1")
def _(t):
    return counts_by(variants.landed_rejects(t.spark, landed_variants(t)), ["reason"])


@query("h11_detect_record", """
SELECT 'osha' AS source, COUNT(*) AS n FROM osha_records UNION ALL SELECT 'esaw', COUNT(*) FROM esaw
UNION ALL SELECT 'cnesst', COUNT(*) FROM cnesst_lesions UNION ALL SELECT 'generic', COUNT(*) FROM conversations""")
def _(t):
    return counts_by(mixed_records(t).select(har.detect_record(F.col("record")).alias("source")), ["source"])


@query("h12_generic_records", f"SELECT {ALL_FIELDS}, COUNT(*) AS n FROM drafts GROUP BY ALL", drafts=generic_sql("conv_id", "role", "turn"))
def _(t):
    drafts = har.transform_generic(t.base("conversations").select("conv_id", "role", "turn"), AS_OF)
    return counts_by(flatten(drafts), ["risk_id", "risk_code", *UNHASHED])


@query("h13_batch_outcome", "SELECT source_system, COUNT(*) AS harmonized, COUNT(*) AS valid, 0 AS rejected FROM mixed GROUP BY 1", **PARTS)
def _(t):
    return har.batch_outcome(har.attempt_mixed(mixed_records(t), AS_OF))


def malformed_input(t):
    """Aggregate records whose count is a flag, a mark of missing data or not a number in some years."""
    count = F.col("OBS_VALUE")
    bad = F.when(F.col("TIME_PERIOD") == 2011, F.concat(count, F.lit(" p"))).when(F.col("TIME_PERIOD") == 2013, ":").when(F.col("TIME_PERIOD") == 2017, "NaN")
    return esaw_input(t).withColumn("OBS_VALUE", F.coalesce(bad, count))


MALFORMED = """SELECT *, CASE year WHEN 2011 THEN incident_count || ' p' WHEN 2013 THEN ':' WHEN 2017 THEN 'NaN' ELSE incident_count END AS given FROM esaw"""


@query("h13_unreadable_counts", """
SELECT 'EUROSTAT_ESAW' AS source_system, CASE WHEN year IN (2011, 2013, 2017) THEN 'incidents unreadable: ' || given ELSE 'harmonized' END AS outcome, COUNT(*) AS n,
  CAST(COALESCE(SUM(CASE WHEN year NOT IN (2011, 2013, 2017) THEN CAST(incident_count AS BIGINT) END), 0) AS BIGINT) AS incidents FROM given_counts GROUP BY 2""", given_counts=MALFORMED)
def _(t):
    tried = har.attempt("esaw", malformed_input(t), AS_OF)
    bad = har.failed(tried).select("source_system", F.col("failure").alias("outcome"), F.lit(0).cast("bigint").alias("incidents"))
    good = har.succeeded(tried).select(F.col("data_provenance.source_system").alias("source_system"), F.lit("harmonized").alias("outcome"),
                                       F.col("incident_statistics.total_incidents").alias("incidents"))
    return bad.unionByName(good).groupBy("source_system", "outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("incidents").alias("incidents"))


@query("h14_detect_frame", """
SELECT 'osha' AS detected, COUNT(*) AS n FROM osha_records UNION ALL SELECT 'esaw', COUNT(*) FROM esaw
UNION ALL SELECT 'cnesst', COUNT(*) FROM cnesst_lesions UNION ALL SELECT 'generic', COUNT(*) FROM osha_injuries""")
def _(t):
    parts = [counts_by(df, []).select(F.lit(har.detect_frame(df)).alias("detected"), "n")
             for df in (t.osha_records, t.esaw, t.cnesst_lesions, t.osha_injuries)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("h15_risk_identity", "SELECT risk_id, risk_code, COUNT(*) AS n FROM osha_unified GROUP BY 1, 2", **PARTS)
def _(t):
    key = F.concat_ws("|", "id", "event_type", "nature", "body_part", "naics_code")
    coded = lk.osha_event(t.osha_records, prefix="")
    return counts_by(coded.select(har.risk_id(har.identity_hash(F.lit("osha"), key)).alias("risk_id"),
                                  har.risk_code(F.col("domain"), F.lit("US"), key).alias("risk_code")), ["risk_id", "risk_code"])


@query("h16_validate", """
SELECT 'none' AS schema, TRUE AS valid, '' AS errors, COUNT(*) AS n FROM mixed UNION ALL SELECT 'plain', TRUE, '', COUNT(*) FROM mixed
UNION ALL SELECT 'strict', domain <> 'AUTRE', CASE WHEN domain = 'AUTRE' THEN 'known_domain' ELSE '' END, COUNT(*) FROM mixed GROUP BY 2, 3""", **PARTS)
def _(t):
    # records are unified once; each brings its outcome under every schema
    checked, outcomes = har.transform_mixed(mixed_records(t), AS_OF), []
    for name, checks in (("none", ()), ("plain", har.SCHEMA), ("strict", (*har.SCHEMA, "known_domain"))):
        checked = har.validate(checked, checks).withColumn(f"__{name}", F.struct(F.lit(name).alias("schema"), "valid", F.array_join("errors", ",").alias("errors")))
        outcomes.append(f"__{name}")
    counted = counts_by(checked, outcomes)  # few kinds of outcomes, expanded after counting
    stacked = counted.select("n", F.inline(F.array(*outcomes)))
    return stacked.groupBy("schema", "valid", "errors").agg(F.sum("n").alias("n"))


@query("h16_validate_schema", """
SELECT risk_id, '$.hazard_classification' AS path, 'oneOf' AS rule FROM mixed WHERE source_system = 'MANUAL_ENTRY'
UNION ALL SELECT risk_id, '$.jurisdiction.primary_country', 'pattern' FROM mixed WHERE country <> '' AND NOT regexp_full_match(country, '[A-Z]{2}')
UNION ALL SELECT risk_id, '$.jurisdiction.applicable_jurisdictions[0]', 'pattern' FROM mixed WHERE source_system = 'EUROSTAT_ESAW' AND NOT regexp_full_match(country, '[A-Z]{2}')
UNION ALL SELECT risk_id, '$.jurisdiction.applicable_jurisdictions', 'uniqueItems' FROM mixed WHERE country = 'EU'
UNION ALL SELECT risk_id, '$.hazard_classification.osha_usa.event_type_code', 'pattern' FROM mixed WHERE source_system LIKE 'OSHA%' AND NOT regexp_full_match(source_code, '[0-9]{2,4}')
UNION ALL SELECT risk_id, '$.industry_classification.scian.code', 'not' FROM mixed WHERE scian = '99'
UNION ALL SELECT risk_id, '$.incident_statistics.total_incidents', 'minimum' FROM mixed WHERE incidents < 1
UNION ALL SELECT risk_id, '$.metadata.tags[' || CAST(i AS STRING) || ']', 'pattern' FROM (
  SELECT risk_id, string_split(tags, ',') AS parts, unnest(range(len(string_split(tags, ',')))) AS i FROM mixed WHERE tags <> '')
  WHERE NOT regexp_full_match(parts[i + 1], '[a-z][a-z_-]*')""", **PARTS)
def _(t):
    document = js.unified_schema()
    return js.error_rows(har.transform_mixed(mixed_records(t), AS_OF), document, "risk_id", list(document["properties"]))


@query("h17_statistics", """
SELECT 'source' AS vue, source_system AS cle, COUNT(*) AS n FROM mixed GROUP BY 2 UNION ALL SELECT 'domaine', domain, COUNT(*) FROM mixed GROUP BY 2
UNION ALL SELECT 'top', * FROM (SELECT domain, COUNT(*) AS n FROM mixed GROUP BY 1 ORDER BY n DESC, domain LIMIT 5)""", **PARTS)
def _(t):
    stats = har.statistics(har.transform_mixed(mixed_records(t), AS_OF))
    return stats.unionByName(har.leading_domains(stats).withColumn("vue", F.lit("top")))


SECTOR = """SELECT code0 AS scian, COALESCE(d.scian, code0) AS sector_scian, COALESCE(d.naics, code0) AS sector_naics, COALESCE(d.nace, 'UNKNOWN') AS sector_nace,
  COALESCE(d.name_fr, 'Non classé') AS sector_name_fr, COALESCE(d.name_en, 'Unclassified') AS sector_name_en, d.name_de AS sector_name_de FROM (
  SELECT c.code0, COALESCE((SELECT ord FROM dim_sector_crosswalk x WHERE x.code = c.code0),
    (SELECT MIN(ord) FROM dim_sector_crosswalk x WHERE starts_with(c.code0, x.code) OR starts_with(x.code, c.code0))) AS o
  FROM codes c) LEFT JOIN dim_sector_crosswalk d ON d.ord = o"""
CODES = "SELECT DISTINCT naics_code AS code0 FROM osha_records UNION SELECT DISTINCT scian FROM cnesst_lesions UNION SELECT DISTINCT event_type FROM osha_records UNION SELECT ''"
SECTOR_COLUMNS = ["sector_scian", "sector_naics", "sector_nace", "sector_name_fr", "sector_name_en"]


def _codes(t):
    rec = t.osha_records
    codes = rec.select(F.col("naics_code").alias("scian")).union(t.cnesst_lesions.select("scian")).union(rec.select("event_type"))
    return codes.union(rec.select(F.lit("")))


@query("h18_sector_crosswalk", "SELECT * FROM sector_rows", sector_rows=SECTOR, codes=CODES)
def _(t):
    return lk.sector_crosswalk(_codes(t).distinct())


INJ = """SELECT r.nature_lesion AS code, r.nature_lesion AS injury_cnesst, COALESCE(a.osha_code, 'UNK') AS injury_osha, COALESCE(a.esaw_code, 'UNK') AS injury_esaw,
  COALESCE(a.cnesst_name, '') AS injury_name_fr, COALESCE(a.osha_name, '') AS injury_name_en"""


@query("h19_type_crosswalks", """
SELECT 'injury' AS kind, r.nature_lesion AS code, r.nature_lesion AS cnesst_code, COALESCE(a.osha_code, 'UNK') AS osha_code, COALESCE(a.esaw_code, 'UNK') AS esaw_code, COUNT(*) AS n
FROM cnesst_lesions r LEFT JOIN dim_injury_crosswalk a ON a.code = r.nature_lesion GROUP BY ALL
UNION ALL SELECT 'cause', r.genre_accident, r.genre_accident, COALESCE(a.osha_code, 'UNK'), COALESCE(a.esaw_code, 'UNK'), COUNT(*)
FROM cnesst_lesions r LEFT JOIN dim_cause_crosswalk a ON a.code = r.genre_accident GROUP BY ALL
UNION ALL SELECT 'body', r.body_part, r.body_part, COALESCE(a.osha_code, 'UNK'), COALESCE(a.esaw_code, 'UNK'), COUNT(*)
FROM osha_records r LEFT JOIN dim_cause_crosswalk a ON a.code = r.body_part GROUP BY ALL""")
def _(t):
    cols = ["cnesst_code", "osha_code", "esaw_code"]

    def counted(df, kind, key):
        return counts_by(df, [key, *cols]).withColumnRenamed(key, "code").withColumn("kind", F.lit(kind))

    return counted(lk.injury_crosswalk(t.cnesst_lesions, prefix=""), "injury", "nature_lesion").unionByName(
        counted(lk.cause_crosswalk(t.cnesst_lesions, prefix=""), "cause", "genre_accident")).unionByName(
        counted(lk.cause_crosswalk(t.osha_records, "body_part", prefix=""), "body", "body_part"))


FLAT = """SELECT 'CNESST-' || rid AS id, 'cnesst' AS source_jurisdiction, rid AS original_id, s.sector_scian, s.sector_naics, s.sector_nace, s.sector_name_fr, s.sector_name_en,
  r.nature_lesion AS injury_cnesst, COALESCE(i.osha_code, 'UNK') AS injury_osha, COALESCE(i.esaw_code, 'UNK') AS injury_esaw, COALESCE(i.cnesst_name, '') AS injury_name_fr,
  COALESCE(i.osha_name, '') AS injury_name_en, r.genre_accident AS causation_cnesst, COALESCE(c.osha_code, 'UNK') AS causation_osha, COALESCE(c.esaw_code, 'UNK') AS causation_esaw,
  COALESCE(c.cnesst_name, '') AS causation_name_fr, COALESCE(c.osha_name, '') AS causation_name_en, r.annee AS year, r.nombre_lesions AS count, r.jours_perdus AS days_lost,
  LEAST(5, GREATEST(1, r.nombre_lesions // 1000 + 1)) AS severity_level, 'Incident SST - ' || s.sector_name_fr || ' - ' || CAST(r.annee AS STRING) AS dc_title,
  'CNESST' AS dc_creator, CAST(r.annee AS STRING) AS dc_date, 'Québec, Canada' AS dc_coverage, 'Open Data License - Gouvernement du Québec' AS dc_rights
FROM (SELECT *, concat_ws('-', CAST(annee AS STRING), scian, genre_accident, nature_lesion) AS rid FROM cnesst_lesions) r JOIN sector_rows s ON s.scian = r.scian
LEFT JOIN dim_injury_crosswalk i ON i.code = r.nature_lesion LEFT JOIN dim_cause_crosswalk c ON c.code = r.genre_accident"""
FLAT_PARTS = {"sector_rows": SECTOR, "codes": CODES, "flat": FLAT}


def flat_of(t):
    return har.flat_record(t.cnesst_lesions.withColumn("id", F.concat_ws("-", *CASE_ID)))


@query("h20_flat_record", "SELECT * FROM flat", **FLAT_PARTS)
def _(t):
    return flat_of(t)


DUBLIN = {"title": "dc_title", "creator": "dc_creator", "subject": "sector_name_fr || '|' || injury_name_fr", "description": "'Incident SST dans le secteur ' || sector_name_fr",
          "date": "dc_date", "type": "'Dataset'", "format": "'application/json'", "identifier": "id", "source": "'cnesst'", "language": "'fr-CA'", "coverage": "dc_coverage", "rights": "dc_rights"}


@query("h21_dublin_core", "SELECT id, " + ", ".join(f"{value} AS dc_{name}" for name, value in DUBLIN.items()) + " FROM flat", **FLAT_PARTS)
def _(t):
    rows = har.dublin_core(flat_of(t)).select("id", F.from_json("dublin_core", "map<string, string>").alias("d"))
    text = lambda name: F.array_join(F.from_json(F.col("d")["dc:subject"], "array<string>"), "|") if name == "subject" else F.col("d")[f"dc:{name}"]
    return rows.select("id", *[text(name).alias(f"dc_{name}") for name in DUBLIN])


@query("k09_graph_statements", """
SELECT 'MERGE (i:Incident {id: ''' || id || '''}) SET i.year = ' || CAST(year AS STRING) || ', i.count = ' || CAST(count AS STRING) || ', i.days_lost = ' || CAST(days_lost AS STRING)
  || ', i.severity = ' || CAST(severity_level AS STRING) || ', i.sector_scian = ''' || sector_scian || ''', i.sector_nace = ''' || sector_nace || ''', i.injury_cnesst = '''
  || injury_cnesst || ''', i.injury_osha = ''' || injury_osha || ''' WITH i MATCH (s:Secteur {scian: ''' || sector_scian || '''}) MERGE (i)-[:DANS_SECTEUR]->(s);' AS value
FROM flat""", **FLAT_PARTS)
def _(t):
    return har.graph_statement(flat_of(t))


@query("j01_lookup_default", """
SELECT c.scian, c.annee, COALESCE(d.name_en, 'other') AS name_en, CAST(SUM(c.nombre_lesions) AS BIGINT) AS cases FROM cnesst_lesions c
LEFT JOIN (SELECT * FROM dim_sector_crosswalk WHERE scian NOT IN ('23', '62')) d ON d.code = c.scian GROUP BY 1, 2, 3""")
def _(t):
    from harmlens.functions import dims

    some = dims.Dimension(dims.SECTOR_CROSSWALK.columns[1:], tuple(r[1:] for r in dims.SECTOR_CROSSWALK.rows if r[1] not in ("23", "62")))
    found = lk.lookup(t.cnesst_lesions, some, "scian", default={"name_en": "other"}, prefix="d_")
    return found.groupBy("scian", "annee", F.col("d_name_en").alias("name_en")).agg(F.sum("nombre_lesions").alias("cases"))


@query("j02_lookup_fallbacks", """
SELECT r.event_type, COALESCE(a.domain, b.domain, c.domain, 'AUTRE') AS domain, COUNT(*) AS n FROM osha_records r
LEFT JOIN dim_osha_event a ON a.code = r.event_type LEFT JOIN dim_osha_event b ON b.code = substr(r.event_type, 1, 2)
LEFT JOIN dim_osha_event c ON c.code = substr(r.event_type, 2, 2) GROUP BY ALL""")
def _(t):
    from harmlens.functions import dims

    found = lk.lookup(t.osha_records, dims.OSHA_EVENT, "event_type", default={"domain": "AUTRE"},
                      fallbacks=[lambda c: F.substring(c, 1, 2), lambda c: F.substring(c, 2, 2)])
    return counts_by(found, ["event_type", "domain"])


@query("j03_prefix_lookup", """
SELECT r.code0 AS event_type, COALESCE(d.name_en, 'none') AS name_en FROM (SELECT c.code0, COALESCE((SELECT ord FROM dim_sector_crosswalk x WHERE x.code = c.code0),
    (SELECT MIN(ord) FROM dim_sector_crosswalk x WHERE starts_with(c.code0, x.code) OR starts_with(x.code, c.code0))) AS o
  FROM (SELECT event_type AS code0 FROM osha_records) c) r LEFT JOIN dim_sector_crosswalk d ON d.ord = o""")
def _(t):
    from harmlens.functions import dims

    return lk.prefix_lookup(t.osha_records, dims.SECTOR_CROSSWALK, "event_type", default={"name_en": F.lit("none")}).select("event_type", "name_en")
