"""Column contracts: renames, Gold conform, whitelist, normalisation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType

from harmlens.functions import dims
from harmlens.operators.lookups import lookup
from harmlens.schemas import GOLD, WAREHOUSE_COLUMNS, struct

# Source header -> common name.
KAGGLE_NAMES = {
    "ein": "establishment_id", "naics_code": "industry_code", "industry_description": "industry_name",
    "annual_average_employees": "establishment_size", "total_hours_worked": "hours_worked", "total_deaths": "fatalities",
    "total_dafw_cases": "days_away_cases", "total_djtr_cases": "restricted_duty_cases", "total_injuries": "total_incidents",
    "year_filing_for": "year",
}
OSHA_NAMES = {
    "activity_nr": "inspection_id", "reporting_id": "incident_id", "estab_name": "establishment_name", "site_address": "address",
    "site_city": "city", "site_state": "state", "site_zip": "zip_code", "naics_code": "industry_code", "open_date": "inspection_date",
    "case_mod_date": "updated_date", "nr_in_estab": "establishment_size", "insp_type": "inspection_type",
    "safety_hlth": "safety_health_focus", "violation_type_s": "violation_type", "initial_penalty": "penalty_amount",
    "nr_instances": "violation_instances", "hazsub1": "hazardous_substance", "summary_nr": "accident_summary_id",
}
EUROSTAT_NAMES = {
    "geo": "country_code", "geo_label": "country_name", "nace_r2": "industry_code", "nace_r2_label": "industry_name",
    "severity": "severity_code", "severity_label": "severity", "sex": "gender_code", "sex_label": "worker_gender", "time": "year",
    "value": "incident_count",
}
ILOSTAT_NAMES = {"REF_AREA": "country_code", "SEX": "gender_code", "CLASSIF1": "classification1", "TIME_PERIOD": "year", "OBS_VALUE": "value"}
DARES_NAMES = {
    "Secteur d'activité": "industry_name", "Code NAF": "industry_code", "Année": "year", "Nombre d'AT": "incident_count",
    "Nombre de décès": "fatalities", "Nombre de jours d'arrêt": "days_lost", "Indice de fréquence": "frequency_index",
    "Indice de gravité": "severity_index",
}


def rename(df: DataFrame, names: dict[str, str], system: str) -> DataFrame:
    """Rename the columns that are present and tag the industry code system."""
    return df.withColumnsRenamed(names).withColumn("industry_code_system", F.lit(system))


def from_kaggle(df: DataFrame) -> DataFrame:
    """P01; the incidence rate is per 200 000 hours worked."""
    out = rename(df, KAGGLE_NAMES, "NAICS")
    if "total_incidents" in out.columns and "hours_worked" in out.columns:
        per_hour = F.try_divide(F.col("total_incidents").cast("double"), F.col("hours_worked").cast("double"))
        out = out.withColumn("incidence_rate", F.round(per_hour * 200000, 2))
    return out


def from_osha(df: DataFrame) -> DataFrame:
    """P02."""
    return rename(df, OSHA_NAMES, "NAICS").withColumn("source_table", F.lit("osha_inspection"))


def from_bls(df: DataFrame) -> DataFrame:
    """Series id -> indicator name; an unmapped id keeps itself."""
    named = lookup(df, dims.BLS_SERIES, "series_id", default={}, dim_key="series_id")
    return named.withColumn("indicator", F.coalesce("indicator", "series_id"))


def from_eurostat(df: DataFrame) -> DataFrame:
    """P04."""
    return rename(df, EUROSTAT_NAMES, "NACE_REV2")


def from_ilostat(df: DataFrame) -> DataFrame:
    """P05."""
    return rename(df, ILOSTAT_NAMES, "ISIC")


def from_dares(df: DataFrame) -> DataFrame:
    """P06."""
    return rename(df, DARES_NAMES, "NAF")


def to_gold(df: DataFrame, source: str, jurisdiction: str, as_of: datetime) -> DataFrame:
    """Absent text is NULL, absent numbers NULL, absent whole numbers 0; absent
    timestamps are not added, and columns outside the contract stay."""
    added: dict[str, Column] = {}
    for f in struct(GOLD).fields:
        if f.name in df.columns:
            continue
        if isinstance(f.dataType, IntegerType):
            added[f.name] = F.lit(0)
        elif isinstance(f.dataType, (StringType, DoubleType)):
            added[f.name] = F.lit(None).cast(f.dataType)
    stamped = {"source": F.lit(source), "jurisdiction": F.lit(jurisdiction), "updated_at": F.lit(as_of)}
    return df.withColumns({**added, **stamped})


def whitelisted(df: DataFrame, columns=WAREHOUSE_COLUMNS) -> DataFrame:
    """The allowed columns the frame has, in contract order."""
    return df.select(*[c for c in columns if c in df.columns])


def normalize(df: DataFrame, source: str, row_key: str, as_of: datetime, names: dict[str, str] | None = None, namespace: str = "incident") -> DataFrame:
    """P20: renamed columns, an incident URI, sector and severity words mapped.

    The last URI part is the row's own key: stable across runs, and no global
    numbering of the rows is needed.
    """
    out = df.withColumnsRenamed(names or {})
    when = F.coalesce(F.col("date").cast("string"), F.lit("unknown")) if "date" in out.columns else F.lit("unknown")
    out = out.withColumn("incident_uri", F.concat_ws(":", F.lit(namespace), F.lit(source), when, F.col(row_key).cast("string")))
    if "sector" in out.columns:
        out = out.withColumn("__word", F.lower("sector"))
        out = lookup(out, dims.SECTOR_WORDS, "__word", default={}, dim_key="word")
        out = out.withColumn("scian_code", F.coalesce("scian_code", F.col("sector").cast("string")))
    if "severity" in out.columns:
        out = out.withColumn("__word", F.lower("severity"))
        out = lookup(out, dims.SEVERITY_WORDS, "__word", default={"severity_class": "MEDIUM"}, dim_key="word")
        out = out.withColumnRenamed("severity_class", "severity_normalized")
    return out.drop("__word").withColumns({"source": F.lit(source), "ingested_at": F.lit(as_of)})


