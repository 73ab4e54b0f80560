"""Raw records of three jurisdictions -> one unified risk record.

Records arrive as typed columns. Where a source may spell a field two ways, the
first spelling present wins; a null field counts as absent.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmlens.functions import dims
from harmlens.functions.exprs import apart, row_count
from harmlens.operators import lookups
from harmlens.operators.aggregates import counts_by
from harmlens.operators.windows import top_k

# Fields that reveal a record's source, in test order.
SOURCE_FIELDS = (
    ("osha", ("event_type", "EventType", "ActivityNr")),
    ("esaw", ("deviation", "DEVIATION", "nace_r2")),
    ("cnesst", ("genre_accident", "GenreAccident", "scian")),
)
# The narrower test applied to a whole file.
FILE_FIELDS = (
    ("osha", ("event_type", "EventType", "ActivityNr")),
    ("esaw", ("deviation", "DEVIATION")),
    ("cnesst", ("genre_accident", "GenreAccident")),
)
SCHEMA_VERSION = "1.0.0"


def identity_hash(source: Column, key: Column) -> Column:
    """The hash a record's id and number are taken from."""
    return F.md5(F.concat_ws("|", source, key))


def risk_id(h: Column) -> Column:
    """A stable id, the record's hash laid out as a UUID; a projection that forms it is compiled ``apart``."""
    return F.concat_ws("-", F.substring(apart(h), 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def risk_code(domain: Column, jurisdiction: Column, key: Column) -> Column:
    """``DOMA-JUR-00000000``; the number is drawn from a hash of the key."""
    seed = F.md5(F.concat(domain, jurisdiction, key))
    number = F.conv(F.substring(seed, 1, 8), 16, 10).cast("bigint") % 100000000
    return F.concat_ws("-", F.upper(F.substring(domain, 1, 4)), F.upper(jurisdiction), F.lpad(number.cast("string"), 8, "0"))


Get = Callable[..., Column]

# The common layout every source is brought into before codes are looked up.
PREPARED = {
    "place": "string", "code": "string", "nature": "string", "part": "string", "site": "string", "agent": "string",
    "industry": "string", "text": "string", "sector_text": "string", "record_id": "string", "system": "string", "country": "string",
    "period": "string", "incidents": "bigint", "days": "bigint", "failure": "string",
}
HAZARDS = dims.Dimension(dims.OSHA_EVENT.columns, tuple(
    (f"{source}:{row[0]}", *row[1:]) for source, dim in (("osha", dims.OSHA_EVENT), ("esaw", dims.ESAW_DEVIATION), ("cnesst", dims.CNESST_GENRE))
    for row in dim.rows))


def from_columns(df: DataFrame) -> Get:
    """Access by column name: the first spelling the frame has and the row fills."""
    def get(*names: str, default: str | None = "") -> Column:
        found = [F.col(n).cast("string") for n in names if n in df.columns]
        return F.coalesce(*found, F.lit(default)) if found else F.lit(default).cast("string")
    return get


def from_map(record: Column) -> Get:
    """Access by map key, for records of mixed sources."""
    def get(*names: str, default: str | None = "") -> Column:
        return F.coalesce(*[F.try_element_at(record, F.lit(n)) for n in names], F.lit(default))
    return get


def _counts(get: Get, **names: Sequence[str]) -> dict[str, Column]:
    """Whole counts by column; an absent one is 0, and one that can't be read is the record's failure."""
    out, reasons = {}, []
    for column, spellings in names.items():
        raw = get(*spellings, default=None)
        value = raw.try_cast("double").try_cast("bigint")  # NaN, infinities and what is too large give null as well
        out[column] = F.coalesce(value, F.when(raw.isNull(), F.lit(0)).cast("bigint"))
        reasons.append(F.when(raw.isNotNull() & value.isNull(), F.concat(F.lit(f"{column} unreadable: "), raw)))
    return {**out, "failure": F.nullif(F.concat_ws("; ", *reasons), F.lit(""))}


def _osha(get: Get) -> dict[str, Column]:
    code, nature, part = get("event_type", "EventType"), get("nature", "Nature"), get("body_part", "PartOfBody")
    industry, record_id = get("naics_code", "NAICS"), get("id", "ActivityNr")
    inspected = F.lower(get("source")).contains("inspection")
    return {"place": F.lit("US"), "code": code, "nature": nature, "part": part,
            "industry": industry, "text": get("event_description"), "record_id": record_id, "country": F.lit("US"),
            "system": F.when(inspected, "OSHA_INSPECTION").otherwise("OSHA_SEVERE_INJURY")}


def _esaw(get: Get) -> dict[str, Column]:
    code, industry, period = get("deviation", "DEVIATION"), get("nace_r2", "NACE_R2"), get("TIME_PERIOD", "year", default="2023")
    country = F.upper(F.substring(get("geo", "GEO", default="EU"), 1, 2))
    return {"place": country, "code": code, "industry": industry, "country": country, "period": period, "system": F.lit("EUROSTAT_ESAW"),
            **_counts(get, incidents=("OBS_VALUE", "value"))}


def _cnesst(get: Get) -> dict[str, Column]:
    return {"place": F.lit("QC"), "code": get("genre_accident", "GenreAccident"), "text": get("genre_description"),
            "nature": get("nature_lesion"), "site": get("siege_lesion"), "agent": get("agent_causal"), "industry": get("scian", "SCIAN"),
            "sector_text": get("secteur"), "record_id": get("id", default=None), "country": F.lit("CA"), "system": F.lit("CNESST"),
            **_counts(get, incidents=("nombre_lesions", "nb_lesions"), days=("jours_perdus",))}


def _generic(get: Get) -> dict[str, Column]:
    return {"place": F.lit("XX"), "system": F.lit("MANUAL_ENTRY")}


PREPARE = {"osha": _osha, "esaw": _esaw, "cnesst": _cnesst, "generic": _generic}


def _text(fr: Column, en: Column) -> Column:
    return F.struct(en.alias("en"), fr.alias("fr"))


# What the flat fields of a unified record (q_harmonize.flatten) are made of: the id takes the source and the key, each other
# one stands in a flat field or follows from the source, so rows that differ here differ there.
FLAT_INPUTS = ["src", "key", "code", "place", "country", "industry", "incidents", "days", "period", "system"]


def keyed(prepared: DataFrame) -> DataFrame:
    """Prepared rows with the key that identifies a record: a source's own id with the codes it is reported under, otherwise every field, by name."""
    src, own = F.col("src"), F.col("record_id") != ""
    return prepared.withColumn("key", F.when((src == "osha") & own, F.concat_ws("|", "record_id", "code", "nature", "part", "industry"))
                               .when((src == "cnesst") & own, F.concat_ws("|", "record_id", "code", "nature", "industry"))
                               .otherwise(F.col("_fields")))


def unify(prepared: DataFrame, as_of: date) -> DataFrame:
    """Prepared rows -> unified records, in one pass over rows of any source."""
    return _unified(keyed(prepared), as_of)


def _unified(keyed_rows: DataFrame, as_of: date, *more: str) -> DataFrame:
    """Two broadcast lookups and one projection; for a single source the ``src``
    column is a literal and the optimizer drops the branches of the others.
    """
    src = F.col("src")
    osha, esaw, cnesst, known = src == "osha", src == "esaw", src == "cnesst", src != "generic"
    parent = lambda k: F.when((F.col("src") == "osha") & (F.length("code") > 2), F.concat(F.lit("osha:"), F.substring("code", 1, 2)))
    coded = lookups.lookup(keyed_rows.withColumn("__hazard", F.concat_ws(":", "src", "code")), HAZARDS, "__hazard", default=lookups.UNKNOWN_HAZARD, fallbacks=[parent], prefix="__")
    coded = lookups.industry(coded, "industry", "__industry_").withColumn("__id", identity_hash(src, F.col("key")))
    fr = F.when(known, F.col("__label_fr")).otherwise("Autre")
    en = F.when(known, F.col("__label_en")).otherwise("Other")
    domain = F.col("__domain")
    hazard = F.struct(
        F.when(osha, F.struct(F.col("code").alias("event_type_code"), F.col("text").alias("event_type_description"),
                              F.col("nature").alias("nature_code"), F.col("part").alias("body_part_code"))).alias("osha_usa"),
        F.when(esaw, F.struct(F.col("code").alias("deviation_code"), _text(fr, en).alias("deviation_description"))).alias("esaw"),
        F.when(cnesst, F.struct(
            F.col("code").alias("genre_accident_code"), F.col("text").alias("genre_accident_description"),
            F.col("nature").alias("nature_lesion_code"), F.col("site").alias("siege_lesion_code"),
            F.col("agent").alias("agent_causal_code"))).alias("cnesst"),
        F.struct(domain.alias("domain_code"), _text(fr, en).alias("domain_label")).alias("unified"))
    place = F.struct(
        F.col("country").alias("primary_country"), F.when(osha, _text(F.lit("États-Unis"), F.lit("United States"))).alias("country_name"),
        F.when(cnesst, F.struct(F.lit("CA-QC").alias("code"), _text(F.lit("Québec"), F.lit("Quebec")).alias("name"),
                                F.lit("STATE_PROVINCIAL").alias("type"))).alias("subdivision"),
        F.when(osha, F.array(F.lit("US"))).when(esaw, F.array(F.col("country"), F.lit("EU"))).otherwise(
            F.array(F.lit("CA"), F.lit("QC"))).alias("applicable_jurisdictions"))
    industry = F.struct(
        F.when(osha | cnesst, F.struct(F.col("industry").alias("code"), F.when(cnesst, F.col("sector_text")).alias("description_fr"),
                                       F.col("__industry_label").alias("description_en"))).alias("scian"),
        F.struct(F.when(esaw, F.col("industry")).otherwise(F.col("__industry_nace")).alias("code"),
                 F.when(osha, F.col("__industry_label")).alias("description")).alias("nace"),
        F.when(osha, F.struct(F.col("__industry_isic").alias("code"), F.lit(4).alias("revision"))).alias("isic"))
    period = F.struct(F.concat(F.col("period"), F.lit("-01-01")).alias("start_date"), F.concat(F.col("period"), F.lit("-12-31")).alias("end_date"))
    counts = F.struct(F.col("incidents").alias("total_incidents"), F.col("days").alias("total_lost_days"), F.when(esaw, period).alias("reporting_period"))
    low = F.lower(domain)
    tags = (F.when(osha, F.array(F.lit("osha"), F.lit("usa"), low))
            .when(esaw, F.array(F.lit("esaw"), F.lit("eurostat"), F.lower("country"), low))
            .when(cnesst, F.array(F.lit("cnesst"), F.lit("quebec"), F.lit("canada"), low)))
    stamp = F.lit(as_of.isoformat())
    title = _text(F.when(known, F.col("__label_fr")).otherwise("Enregistrement non classé"),
                  F.when(known, F.col("__label_en")).otherwise("Unclassified Record"))
    return coded.select(
        risk_id(F.col("__id")).alias("risk_id"), risk_code(domain, F.col("place"), F.col("key")).alias("risk_code"),
        F.struct(F.lit(1).alias("major"), F.lit(0).alias("minor"), F.lit(0).alias("patch")).alias("version"),
        F.when(known, "ACTIVE").otherwise("DRAFT").alias("status"), title.alias("title"),
        F.when(known, place).alias("jurisdiction"), hazard.alias("hazard_classification"), F.when(known, industry).alias("industry_classification"),
        F.when(esaw | cnesst, counts).alias("incident_statistics"),
        F.struct(F.col("system").alias("source_system"), F.col("record_id").alias("source_record_id"), stamp.alias("extraction_date"),
                 F.when(known, "PENDING").otherwise("REVIEW_REQUIRED").alias("validation_status")).alias("data_provenance"),
        F.struct(stamp.alias("created_at"), F.lit(SCHEMA_VERSION).alias("schema_version"), tags.alias("tags")).alias("metadata"),
        "_source_record", "failure", *more)


def attempt(source: str, df: DataFrame, as_of: date) -> DataFrame:
    """Unified records of all rows; ``failure`` says why a row can't be one."""
    values = PREPARE[source](from_columns(df))
    fields = F.concat_ws("|", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in sorted(df.columns)])
    prepared = df.select(F.lit(source).alias("src"), *[values.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in PREPARED.items()],
                         F.to_json(F.struct(*df.columns)).alias("_source_record"), fields.alias("_fields"))
    return unify(prepared, as_of)


def succeeded(attempted: DataFrame) -> DataFrame:
    """The records of a batch that could be read."""
    return attempted.filter(F.col("failure").isNull()).drop("failure")


def failed(attempted: DataFrame) -> DataFrame:
    """The raw records that could not, with the reason."""
    return attempted.filter(F.col("failure").isNotNull()).select(F.col("data_provenance.source_system").alias("source_system"), "failure", "_source_record")


def _transform(source: str, df: DataFrame, as_of: date) -> DataFrame:
    return succeeded(attempt(source, df, as_of))


def transform_osha(df: DataFrame, as_of: date) -> DataFrame:
    """H08."""
    return _transform("osha", df, as_of)


def transform_esaw(df: DataFrame, as_of: date) -> DataFrame:
    """H09."""
    return _transform("esaw", df, as_of)


def transform_cnesst(df: DataFrame, as_of: date) -> DataFrame:
    """H10."""
    return _transform("cnesst", df, as_of)


def transform_generic(df: DataFrame, as_of: date) -> DataFrame:
    """A draft placeholder that keeps the raw record."""
    return _transform("generic", df, as_of)


TRANSFORMS = {"osha": transform_osha, "esaw": transform_esaw, "cnesst": transform_cnesst, "generic": transform_generic}


def detect_record(record: Column) -> Column:
    """A record's source by the fields its map contains."""
    return _detect(lambda f: F.map_contains_key(record, f))


def _detect(has: Callable[[str], Column]) -> Column:
    out = None
    for name, fields in SOURCE_FIELDS:
        hit = F.lit(False)
        for f in fields:
            hit = hit | has(f)
        out = (F if out is None else out).when(hit, F.lit(name))
    return out.otherwise(F.lit("generic"))


def detect_frame(df: DataFrame) -> str:
    """A file's source by its column names."""
    return next((name for name, fields in FILE_FIELDS if any(f in df.columns for f in fields)), "generic")


def attempt_mixed(records: DataFrame, as_of: date, record: str = "record", counted: bool = False) -> DataFrame:
    """``attempt`` for records of any source, each a map of strings."""
    r = F.col("r")
    return _attempt_any(records.select(F.col(record).alias("r")), detect_record(r), from_map(r), _map_fields(r), F.to_json(r), as_of, counted)


def _map_fields(record: Column) -> Column:
    """All filled fields of a map, by name."""
    return F.array_join(F.transform(F.array_sort(F.map_keys(record)), lambda k: F.concat(k, F.lit("="), record[k])), "|")


def _attempt_any(records: DataFrame, detected: Column, get: Get, fields: Column, raw: Column, as_of: date, counted: bool = False) -> DataFrame:
    """One detection and one struct per row: only the branch of the row's own source reads the record ``r``.

    ``counted``: the records that can be read, those of equal flat fields once with their number ``n``. They are counted by the
    few columns that flat fields are made of, before they grow wide; fields beside the flat ones are null.
    """
    # a generator keeps the optimizer from copying the detection into every use of its column
    rows = records.select("r", F.inline(F.array(F.struct(detected.alias("src")))))
    chosen, failure = F, F
    for source, prepare in PREPARE.items():
        values, own = prepare(get), F.col("src") == source
        chosen = chosen.when(own, F.struct(*[values.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in PREPARED.items() if c != "failure"]))
        failure = failure.when(own, values.get("failure", F.lit(None)).cast("string"))
    # the failure is a column of its own: a filter on it, moved down by the optimizer, takes no copy of the struct along
    prepared = rows.select(apart(F.col("src")).alias("src"), "r", chosen.alias("p"), failure.alias("failure"))
    rows = keyed(prepared.select("src", "r", "p.*", "failure").withColumns({"_source_record": raw, "_fields": fields}).drop("r"))
    if not counted:
        return _unified(rows, as_of)
    equal = counts_by(succeeded(rows), FLAT_INPUTS)
    rest = {c: F.lit(None).cast("string") for c in (*PREPARED, "_source_record") if c not in FLAT_INPUTS}
    return _unified(equal.withColumns(rest), as_of, "n")


def from_variant(record: Column) -> Get:
    """Access by field of a VARIANT object; a number is its value, a nested field its JSON text."""
    def get(*names: str, default: str | None = "") -> Column:
        return F.coalesce(*[F.try_variant_get(record, f"$.{n}", "string") for n in names], F.lit(default))
    return get


def attempt_variants(records: DataFrame, as_of: date, record: str = "record", counted: bool = False) -> DataFrame:
    """``attempt`` for records of any source, each a VARIANT object as ``sources.variants`` reads them.

    Fields are read by path where a row's source asks for them; nested values and numbers stay in ``_source_record``.
    """
    r = F.col("r")
    detected = _detect(lambda f: F.try_variant_get(r, f"$.{f}", "variant").isNotNull())
    fields = _map_fields(F.try_variant_get(r, "$", "map<string,string>"))
    return _attempt_any(records.select(F.col(record).alias("r")), detected, from_variant(r), fields, F.to_json(r), as_of, counted)


def transform_variants(records: DataFrame, as_of: date, record: str = "record", counted: bool = False) -> DataFrame:
    """H11 over VARIANT records: those that can be read, unified; ``counted`` as in ``_attempt_any``."""
    return succeeded(attempt_variants(records, as_of, record, counted))


def transform_mixed(records: DataFrame, as_of: date, record: str = "record", counted: bool = False) -> DataFrame:
    """The records that can be read, unified; ``counted`` as in ``_attempt_any``."""
    return succeeded(attempt_mixed(records, as_of, record, counted))


# -- validation and statistics (H13, H16, H17) ---------------------------------------

CHECKS = {
    "risk_id": lambda: F.col("risk_id").isNotNull() & (F.length("risk_id") > 0),
    "risk_code": lambda: F.col("risk_code").rlike("^[A-Z]{2,4}-[A-Z0-9]{2}-[0-9]{8}$"),
    "status": lambda: F.col("status").isin("ACTIVE", "DRAFT"),
    "domain": lambda: F.col("hazard_classification.unified.domain_code").isNotNull(),
    "jurisdiction": lambda: (F.col("status") == "DRAFT") | F.col("jurisdiction.primary_country").isNotNull(),
    "known_domain": lambda: F.col("hazard_classification.unified.domain_code") != "AUTRE",
}
SCHEMA = ("risk_id", "risk_code", "status", "domain", "jurisdiction")


def validate(unified: DataFrame, checks: Sequence[str] = ()) -> DataFrame:
    """Each record with the names of the checks it fails; without a schema (``checks``) all pass."""
    if not checks:
        return unified.withColumn("errors", F.array().cast("array<string>")).withColumn("valid", F.lit(True))
    errors = F.array_compact(F.array(*[F.when(~F.coalesce(CHECKS[c](), F.lit(False)), F.lit(c)) for c in checks]))
    return unified.withColumn("errors", errors).withColumn("valid", F.size("errors") == 0)


def batch_outcome(attempted: DataFrame, checks: Sequence[str] = ()) -> DataFrame:
    """How many records were taken, pass the checks, and could not be read, per source system."""
    read = F.col("failure").isNull()
    return validate(attempted, checks).groupBy(F.col("data_provenance.source_system").alias("source_system")).agg(
        F.count_if(read).alias("harmonized"), F.count_if(read & F.col("valid")).alias("valid"), F.count_if(~read).alias("rejected"))


def rejects(attempted: DataFrame, checks: Sequence[str] = ()) -> DataFrame:
    """Records that could not be read or fail a check, kept with their reasons."""
    reasons = F.array_compact(F.concat(F.array("failure"), F.col("errors")))
    return validate(attempted, checks).withColumn("errors", reasons).filter(F.size("errors") > 0).select("risk_id", "errors", "_source_record")


def statistics(unified: DataFrame) -> DataFrame:
    """Records by source system and by domain, stacked."""
    both = unified.groupBy(F.col("data_provenance.source_system").alias("s"),
                           F.col("hazard_classification.unified.domain_code").alias("d")).agg(row_count().alias("n"))
    by = lambda column, kind: both.groupBy(F.col(column).alias("cle")).agg(F.sum("n").alias("n")).withColumn("vue", F.lit(kind))
    return by("s", "source").unionByName(by("d", "domaine"))


def leading_domains(stats: DataFrame, k: int = 5) -> DataFrame:
    """The k domains with most records, from the statistics."""
    return top_k(stats.filter(F.col("vue") == "domaine"), "n", k, ["cle"])


# -- flat record, second generation (H20, H21, K09) -------------------------------------

def flat_record(df: DataFrame) -> DataFrame:
    """The flat harmonised record of an aggregated case row."""
    base = df.select(
        F.coalesce(F.col("id").cast("string"), F.lit("UNK")).alias("rid"), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("original_id"),
        F.coalesce("scian", F.lit("")).alias("scian"), F.coalesce("nature_lesion", F.lit("")).alias("nature"),
        F.coalesce("genre_accident", F.lit("")).alias("genre"), F.col("annee").alias("annee"),
        F.coalesce(F.col("nombre_lesions"), F.lit(0)).cast("bigint").alias("count"),
        F.coalesce(F.col("jours_perdus"), F.lit(0)).cast("bigint").alias("days_lost"))
    coded = lookups.sector_crosswalk(base, "scian", "sector_")
    coded = lookups.injury_crosswalk(coded, "nature", "injury_")
    coded = lookups.cause_crosswalk(coded, "genre", "causation_")
    year_text = F.coalesce(F.col("annee").cast("string"), F.lit(""))
    level = F.least(F.lit(5).cast("bigint"), F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("count") / 1000) + 1))
    renamed = {"injury_cnesst_code": "injury_cnesst", "injury_osha_code": "injury_osha", "injury_esaw_code": "injury_esaw",
               "injury_cnesst_name": "injury_name_fr", "injury_osha_name": "injury_name_en",
               "causation_cnesst_code": "causation_cnesst", "causation_osha_code": "causation_osha",
               "causation_esaw_code": "causation_esaw", "causation_cnesst_name": "causation_name_fr",
               "causation_osha_name": "causation_name_en"}
    return coded.select(
        F.concat(F.lit("CNESST-"), F.col("rid")).alias("id"), F.lit("cnesst").alias("source_jurisdiction"), "original_id",
        "sector_scian", "sector_naics", "sector_nace", "sector_name_fr", "sector_name_en",
        *[F.col(a).alias(b) for a, b in renamed.items()],
        F.coalesce("annee", F.lit(2023)).alias("year"), "count", "days_lost", level.alias("severity_level"),
        F.concat(F.lit("Incident SST - "), F.col("sector_name_fr"), F.lit(" - "), year_text).alias("dc_title"),
        F.lit("CNESST").alias("dc_creator"), year_text.alias("dc_date"), F.lit("Québec, Canada").alias("dc_coverage"),
        F.lit("Open Data License - Gouvernement du Québec").alias("dc_rights"))


def dublin_core(flat: DataFrame) -> DataFrame:
    """The twelve Dublin Core fields of each record, as one JSON document."""
    fields = {
        "dc:title": F.col("dc_title"), "dc:creator": F.col("dc_creator"),
        "dc:subject": F.array("sector_name_fr", "injury_name_fr"),
        "dc:description": F.concat(F.lit("Incident SST dans le secteur "), F.col("sector_name_fr")),
        "dc:date": F.col("dc_date"), "dc:type": F.lit("Dataset"), "dc:format": F.lit("application/json"),
        "dc:identifier": F.col("id"), "dc:source": F.col("source_jurisdiction"), "dc:language": F.lit("fr-CA"),
        "dc:coverage": F.col("dc_coverage"), "dc:rights": F.col("dc_rights"),
    }
    return flat.select("id", F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("dublin_core"))


def graph_statement(flat: DataFrame) -> DataFrame:
    """One graph upsert statement per record, with quotes escaped."""
    quoted = lambda c: F.concat(F.lit("'"), F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'"))
    number = lambda c: F.col(c).cast("string")
    statement = F.concat(
        F.lit("MERGE (i:Incident {id: "), quoted("id"), F.lit("}) SET i.year = "), number("year"), F.lit(", i.count = "), number("count"),
        F.lit(", i.days_lost = "), number("days_lost"), F.lit(", i.severity = "), number("severity_level"),
        F.lit(", i.sector_scian = "), quoted("sector_scian"), F.lit(", i.sector_nace = "), quoted("sector_nace"),
        F.lit(", i.injury_cnesst = "), quoted("injury_cnesst"), F.lit(", i.injury_osha = "), quoted("injury_osha"),
        F.lit(" WITH i MATCH (s:Secteur {scian: "), quoted("sector_scian"), F.lit("}) MERGE (i)-[:DANS_SECTEUR]->(s);"))
    return flat.select(statement.alias("value"))
