"""Table contracts as DDL text; ``struct`` parses one inside a running session."""

from __future__ import annotations

from pyspark.sql.types import StructType

LESIONS = (
    "secteur_scian string, annee int, nature_lesion string, siege_lesion string, genre string, agent_causal_lesion string, "
    "sexe_pers_phys string, groupe_age string, ind_lesion_tms string, ind_lesion_psy string, ind_lesion_covid_19 string, "
    "ind_lesion_surdite string, ind_lesion_machine string")

# Gold: the columns every source is conformed to.
GOLD = (
    "incident_id string, source string, jurisdiction string, date timestamp, year int, industry_code string, "
    "industry_code_system string, industry_name string, establishment_size string, incident_type string, severity string, "
    "nature_of_injury string, body_part string, event_type string, days_lost double, worker_age double, worker_gender string, "
    "worker_employment_status string, latitude double, longitude double, narrative string, created_at timestamp, updated_at timestamp")

# Columns the warehouse table accepts from a Gold frame.
WAREHOUSE_COLUMNS = (
    "incident_id", "source", "jurisdiction", "incident_date", "year", "industry_code", "industry_code_system", "industry_name",
    "establishment_size", "incident_type", "severity", "nature_of_injury", "body_part", "event_type", "days_lost", "worker_age",
    "worker_gender", "worker_employment_status", "narrative", "latitude", "longitude", "created_at", "updated_at",
    "ingestion_batch_id")

SOURCE_STATUS = (
    "source_key string, source_name string, jurisdiction string, last_ingestion timestamp, rows_ingested bigint, "
    "total_rows bigint, status string, error_message string, updated_at timestamp")

BATCH_LOG = (
    "batch_id string, started_at timestamp, completed_at timestamp, status string, total_rows_ingested bigint")

INDUSTRY_MAPPING = (
    "naics_code string, nace_code string, naf_code string, scian_code string, isic_code string, industry_name_en string, "
    "industry_name_fr string, risk_level string, typical_hazards array<string>")


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


_TEXT = "struct<en: string, fr: string>"
UNIFIED = (
    f"risk_id string, risk_code string, version struct<major: int, minor: int, patch: int>, status string, title {_TEXT}, "
    f"jurisdiction struct<primary_country: string, country_name: {_TEXT}, subdivision: struct<code: string, name: {_TEXT}, type: string>, "
    "applicable_jurisdictions: array<string>>, "
    "hazard_classification struct<"
    "osha_usa: struct<event_type_code: string, event_type_description: string, nature_code: string, body_part_code: string>, "
    f"esaw: struct<deviation_code: string, deviation_description: {_TEXT}>, "
    "cnesst: struct<genre_accident_code: string, genre_accident_description: string, nature_lesion_code: string, "
    "siege_lesion_code: string, agent_causal_code: string>, "
    f"unified: struct<domain_code: string, domain_label: {_TEXT}>>, "
    "industry_classification struct<scian: struct<code: string, description_fr: string, description_en: string>, "
    "nace: struct<code: string, description: string>, isic: struct<code: string, revision: int>>, "
    "incident_statistics struct<total_incidents: bigint, total_lost_days: bigint, "
    "reporting_period: struct<start_date: string, end_date: string>>, "
    "data_provenance struct<source_system: string, source_record_id: string, extraction_date: string, validation_status: string>, "
    "metadata struct<created_at: string, schema_version: string, tags: array<string>>, _source_record string")

BLS_RESPONSE = (
    "status string, message string, Results struct<series: array<struct<seriesID: string, data: array<struct<"
    "year: string, period: string, value: string, footnotes: array<map<string, string>>>>>>>")

JSONSTAT = (
    "id array<string>, dimension map<string, struct<category: struct<index: map<string, int>, label: map<string, string>>>>, "
    "value map<string, double>")
