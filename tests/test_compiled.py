"""What is generated for long projections stays small enough for the JVM to compile, and nothing is computed twice."""

import re

import pytest
from pyspark.sql import functions as F

from harmlens.operators import graph as gr
from harmlens.operators import harmonize as har
from harmlens.operators import json_schema as js
from harmlens.plans.q_graph import osha_risks
from harmlens.plans.q_harmonize import AS_OF, mixed_records
from harmlens.plans.tables import Tables

HUGE = 8000  # bytes of a method that the JVM leaves uncompiled


@pytest.fixture
def plain(spark, sf_dir):
    """Tables of a session whose plans are final before they run."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield Tables(spark, sf_dir)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def longest_method(df):
    parts = df._jdf.queryExecution().debug().codegenToSeq()
    return max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size()))


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def violations(t):
    document = js.unified_schema()
    return js.error_rows(har.transform_mixed(mixed_records(t), AS_OF), document, "risk_id", list(document["properties"]))


@pytest.mark.parametrize("rows", [osha_risks, lambda t: har.transform_mixed(mixed_records(t), AS_OF).drop("_source_record"), violations])
def test_methods_are_compiled(plain, rows):
    assert longest_method(rows(plain)) <= HUGE


def test_records_are_hashed_once(plain):
    # one hash is the id's, one the code's
    assert len(re.findall(r"\bmd5\(", physical(osha_risks(plain)))) == 2


def test_risks_are_grouped_as_one_struct(plain):
    keys = re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", physical(osha_risks(plain)))
    assert len(keys) == 2 and all(re.fullmatch(r"row#\d+", k) for k in keys)


def test_violations_are_listed_once(plain):
    assert physical(violations(plain)).count("AS errors#") == 1
    assert not re.search(r"Filter[^\n]*size\(concat", physical(violations(plain)))


UNIFIED = ("risk_id string, risk_code string, title struct<en: string, fr: string>, hazard_classification struct<unified: struct<domain_code: string>>, "
           "data_provenance struct<source_system: string>, incident_statistics struct<total_incidents: bigint>, "
           "industry_classification struct<scian: struct<code: string>, nace: struct<code: string>>, metadata struct<tags: array<string>>, "
           "jurisdiction struct<primary_country: string, subdivision: struct<code: string>>")


def record(risk, country, subdivision):
    return (risk, "C", ("t", "t"), (("ELEC",),), ("S",), (1,), (("23",), ("F",)), (["a"],), (country, (subdivision,)))


def test_rows_without_an_id_and_equal_edges(spark):
    unified = spark.createDataFrame([record("r1", "CA", "CA-QC"), record("r1", "CA", "CA-QC"), record("r2", "QC", "CA-QC"), record("r3", "XX", "XX"),
                                     record(None, "CA", "CA-QC"), record("", "CA", "CA-QC")], UNIFIED)
    rows = gr.risk_rows(unified)
    assert {r.id: r.copies for r in rows.collect()} == {"r1": 2, "r2": 1, "r3": 1}
    assert gr.edge_rows(unified).count() == 3
    places = sorted((r.src, r.dst) for r in gr.risk_edges(rows).filter(F.col("rel") == "LOCALISE_DANS").collect())
    assert places == [("r1", "CA"), ("r1", "QC"), ("r2", "QC")]
