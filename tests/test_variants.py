"""Mixed records as VARIANT values."""

import json
from datetime import date

from pyspark.sql import functions as F

from harmlens.operators import harmonize as har
from harmlens.sources import variants

DAY = date(2024, 1, 1)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_lanes(spark, tmp_path):
    bad = ["{bad", '{"a": 1, "a": 2}', "[1]", '"text"', "null", "3"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(['{"a": 1}', "", "   ", "{}", *bad]))
    variants.land_variants(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = {r.line: r.reason for r in variants.landed_rejects(spark, str(tmp_path / "out")).collect()}
    assert got == {"{bad": "not JSON", '{"a": 1, "a": 2}': "not JSON", "[1]": "not an object", '"text"': "not an object",
                   "null": "not an object", "3": "not an object"}
    assert sorted(r[0] for r in variants.landed_records(spark, str(tmp_path / "out")).select(F.to_json("record")).collect()) == ['{"a":1}', "{}"]


def test_no_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n")
    parsed = variants.parse_lines(spark.read.text(str(tmp_path / "in")))
    assert parsed.isEmpty() and har.transform_variants(parsed, DAY).isEmpty()
    assert variants.parse_lines(lines(spark, None, "")).isEmpty()


def test_nested_values_and_numbers_are_kept(spark):
    record = {"event_type": 4, "id": 12345678901, "site": {"geo": [1, 2.5], "name": None}, "naics_code": "23"}
    row = har.transform_variants(variants.parse_lines(lines(spark, json.dumps(record))), DAY).select(
        "data_provenance", "_source_record", "hazard_classification").first()
    assert json.loads(row._source_record) == record
    assert row.data_provenance.source_record_id == "12345678901" and row.hazard_classification.osha_usa.event_type_code == "4"


def test_equal_to_maps_on_flat_records(spark):
    flat = [{"event_type": "4", "nature": "110", "id": "a"}, {"deviation": "50", "geo": "FR", "OBS_VALUE": "7"}, {"genre_accident": "31", "nombre_lesions": "x"},
            {"scian": None, "k": "v"}, {"other": "1", "more": None}, {}]
    maps = spark.createDataFrame([(r,) for r in flat], "record map<string,string>")
    parsed = variants.parse_lines(lines(spark, *[json.dumps(r) for r in flat]))
    view = lambda df: sorted((r.risk_id, r.risk_code, str(r.data_provenance), str(r.incident_statistics), r.failure) for r in df.collect())
    assert [str(r) for r in view(har.attempt_variants(parsed, DAY))] == [str(r) for r in view(har.attempt_mixed(maps, DAY))]
