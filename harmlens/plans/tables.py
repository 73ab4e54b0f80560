"""Domain tables derived from the driver's parquet tables.

``Tables`` gives each query its inputs. The derived tables are plain lazy
DataFrames; joins carry no broadcast hints, so Spark picks a strategy by size.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harmlens.functions.exprs import row_count

DAYS_DIVISOR = {"ECONOMY": 3, "LARGE": 4, "MEDIUM": 5, "PROMO": 7, "SMALL": 2}
SECTOR_CODE = {"ECONOMY": "23", "LARGE": "31-33", "MEDIUM": "62", "PROMO": "48-49", "SMALL": "221122"}
GENRE_CODE = {"1": "31", "2": "42", "3": "50", "4": "51", "5": "52", "6": "60"}
NATURE_CODE = {"15-24": "10", "25-34": "20", "35-44": "30", "45-54": "40"}
SEGMENT_NAICS = {"BUILDING": "23", "MACHINERY": "31-33", "HOUSEHOLD": "62", "AUTOMOBILE": "48-49"}
LINE_NAICS = {1: "23", 2: "23821", 3: "221122", 4: "62", 5: "484", 6: "236"}


def _choose(column: str, mapping: dict, otherwise):
    out = None
    for key, value in mapping.items():
        out = (F if out is None else out).when(F.col(column) == key, F.lit(value))
    return out.otherwise(F.lit(otherwise))


def _yes_no(condition):
    return F.when(condition, F.lit("OUI")).otherwise(F.lit("NON"))


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

        self._base: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._base:
            self._base[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._base[name]

    @cached_property
    def lesions(self) -> DataFrame:
        line, orders, part = self.base("lineitem"), self.base("orders"), self.base("part")
        joined = line.join(orders, line.l_orderkey == orders.o_orderkey).join(part, line.l_partkey == part.p_partkey)
        quantity, year = F.col("l_quantity"), F.year("l_shipdate")
        age = (
            F.when(quantity <= 10, "15-24").when(quantity <= 20, "25-34").when(quantity <= 30, "35-44")
            .when(quantity <= 40, "45-54").otherwise("55+")
        )
        return joined.select(
            F.col("p_type").alias("secteur_scian"),
            (year + 22).cast("int").alias("annee"),
            F.col("p_name").alias("nature_lesion"),
            F.col("p_brand").alias("siege_lesion"),
            F.col("l_linenumber").cast("string").alias("genre"),
            F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("o_orderpriority")).alias("agent_causal_lesion"),
            F.when(F.col("l_linestatus") == "F", "FEMME").otherwise("HOMME").alias("sexe_pers_phys"),
            age.alias("groupe_age"),
            _yes_no(F.col("l_returnflag") == "R").alias("ind_lesion_tms"),
            _yes_no(F.col("l_discount") > F.lit(0.095)).alias("ind_lesion_psy"),
            _yes_no((F.col("l_tax") > F.lit(0.075)) & (year >= 1998)).alias("ind_lesion_covid_19"),
            _yes_no(F.col("l_tax") < F.lit(0.005)).alias("ind_lesion_surdite"),
            _yes_no(F.col("l_linenumber") == 3).alias("ind_lesion_machine"),
            F.floor(quantity / _choose("p_type", DAYS_DIVISOR, 10)).cast("bigint").alias("jours_perdus"),
        )

    @cached_property
    def osha_raw(self) -> DataFrame:
        orders, customer, nation = self.base("orders"), self.base("customer"), self.base("nation")
        joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
            nation, customer.c_nationkey == nation.n_nationkey
        )
        return joined.select(
            F.col("o_orderkey").alias("id"),
            F.col("c_name").alias("establishment_name"),
            F.when(F.col("n_nationkey") == 0, None).otherwise(F.col("n_name")).alias("state"),
            _choose("c_mktsegment", SEGMENT_NAICS, None).alias("naics_code"),
            F.col("c_mktsegment").alias("industry_description"),
            (F.year("o_orderdate") + 22).cast("int").alias("year_filing_for"),
            F.col("o_totalprice").alias("total_hours_worked"),
            (F.col("o_orderkey") % 7).cast("bigint").alias("total_injuries"),
            F.when(F.col("o_orderkey") % 97 == 0, 1).otherwise(0).cast("bigint").alias("total_deaths"),
            (F.col("o_custkey") % 31).cast("bigint").alias("days_away"),
        )

    @cached_property
    def esaw(self) -> DataFrame:
        customer, nation = self.base("customer"), self.base("nation")
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
            F.when(F.col("n_nationkey") == 3, None)
            .otherwise(F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))).alias("country_code"),
            F.col("n_name").alias("country_name"),
            (F.col("c_custkey") % 50).cast("string").alias("incident_count"),
            (F.lit(2010) + F.col("c_custkey") % 13).cast("int").alias("year"),
            (F.col("c_custkey") % 90).cast("string").alias("deviation"),
        )

    @cached_property
    def osha_records(self) -> DataFrame:
        return self.base("lineitem").select(
            F.col("l_orderkey").cast("string").alias("id"),
            (F.col("l_partkey") % 600).cast("string").alias("event_type"),
            (F.lit(100) + F.col("l_suppkey") * 7 % 500).cast("string").alias("nature"),
            (F.col("l_partkey") % 60).cast("string").alias("body_part"),
            _choose("l_linenumber", LINE_NAICS, "99").alias("naics_code"),
        )

    @cached_property
    def cnesst_lesions(self) -> DataFrame:
        coded = self.lesions.select(
            "annee",
            _choose("secteur_scian", SECTOR_CODE, "21").alias("scian"),
            _choose("genre", GENRE_CODE, "72").alias("genre_accident"),
            _choose("groupe_age", NATURE_CODE, "50").alias("nature_lesion"),
            "jours_perdus",
        )
        return coded.groupBy("annee", "scian", "genre_accident", "nature_lesion").agg(
            row_count().alias("nombre_lesions"), F.sum("jours_perdus").alias("jours_perdus")
        )

    @cached_property
    def osha_injuries(self) -> DataFrame:
        return (
            self.osha_raw.filter(F.col("naics_code").isNotNull())
            .groupBy(F.col("year_filing_for").alias("year"), F.col("naics_code").alias("naics"), "industry_description")
            .agg(
                F.sum("total_injuries").alias("total_cases"),
                F.sum("total_deaths").alias("total_deaths"),
                F.sum("days_away").alias("days_away"),
            )
        )

    @cached_property
    def incidents_global(self) -> DataFrame:
        usa = self.osha_raw.select(
            F.lit("OSHA").alias("source"),
            F.lit("USA").alias("jurisdiction"),
            F.col("id").cast("string").alias("incident_id"),
            F.col("year_filing_for").alias("year"),
            F.col("naics_code").alias("industry_code"),
            F.when(F.col("total_deaths") > 0, "fatal").otherwise("non-fatal").alias("incident_type"),
            F.col("days_away").cast("double").alias("days_lost"),
        )
        quebec = self.lesions.select(
            F.lit("CNESST").alias("source"),
            F.lit("Quebec").alias("jurisdiction"),
            F.concat_ws("-", "genre", "siege_lesion").alias("incident_id"),
            F.col("annee").alias("year"),
            F.col("secteur_scian").alias("industry_code"),
            F.when(F.col("ind_lesion_psy") == "OUI", "illness").otherwise("non-fatal").alias("incident_type"),
            F.col("jours_perdus").cast("double").alias("days_lost"),
        )
        return usa.unionByName(quebec)


_TABLES: dict[tuple[str, str], Tables] = {}


def tables_for(spark: SparkSession, sf_dir: str) -> Tables:
    """The tables of a folder, planned once per application: file schemas are read only once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, sf_dir)
    return _TABLES[key]
