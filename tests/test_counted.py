"""Records counted before they are unified give the rows and numbers of counting unified records."""

from harmlens.operators import harmonize as har
from harmlens.operators.aggregates import counts_by
from harmlens.plans.q_harmonize import AS_OF, UNHASHED, flatten, landed_variants
from harmlens.plans.tables import Tables
from harmlens.sources import variants

FLAT = ["risk_id", "risk_code", *UNHASHED]
RECORDS = [
    {"id": "1", "event_type": "31", "nature": "10", "event_description": "a"}, {"id": "1", "event_type": "31", "nature": "10", "event_description": "b"},
    {"id": "1", "event_type": "31", "nature": "10", "source": "Inspection"}, {"event_type": "31", "event_description": "a"}, {"event_type": "31", "event_description": "b"},
    {"ActivityNr": "9", "EventType": ""}, {"ActivityNr": "9", "EventType": None}, {"deviation": "50", "geo": "FR", "OBS_VALUE": "3"},
    {"deviation": "50", "geo": "FR", "value": "3"}, {"deviation": "50", "geo": "FR", "OBS_VALUE": ":"}, {"deviation": "50", "OBS_VALUE": None}, {"deviation": "50"},
    {"id": "7", "genre_accident": "31", "scian": "23", "nombre_lesions": "4", "jours_perdus": "2", "agent_causal": "x"},
    {"id": "7", "genre_accident": "31", "scian": "23", "nombre_lesions": "4", "jours_perdus": "2", "agent_causal": "y"},
    {"id": "7", "genre_accident": "31", "scian": "23", "nombre_lesions": "5"}, {"id": "7", "genre_accident": "31", "scian": "23", "nombre_lesions": "n/a"},
    {"genre_accident": "31", "scian": "23", "nombre_lesions": "5"}, {"x": "1"}, {"x": "1"}, {"x": "2"}, {"x": None}, {}]


def test_counted_records(spark):
    records = spark.createDataFrame([(r,) for r in RECORDS * 2], "record map<string,string>")
    wide = counts_by(flatten(har.transform_mixed(records, AS_OF)), FLAT)
    counted = flatten(har.transform_mixed(records, AS_OF, counted=True), "n")
    assert counted.columns == wide.columns
    assert sorted(map(repr, counted.collect())) == sorted(map(repr, wide.collect()))
    assert max(r.n for r in wide.collect()) > 2  # some differ only beside the flat fields


def test_narrow_rows_are_moved(spark):
    records = spark.createDataFrame([(r,) for r in RECORDS], "record map<string,string>")
    plan = flatten(har.transform_mixed(records, AS_OF, counted=True), "n")._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Aggregate [")]
    assert plan.count("Aggregate [") == 1 and "risk_id" in above and "risk_id" not in plan[plan.index("Aggregate ["):]


def test_landed_lines_are_compressed(spark, sf_dir):
    folder = landed_variants(Tables(spark, sf_dir))
    lines = spark.read.text(folder.removesuffix("/parsed") + "/text")
    assert all(f.endswith(".txt.gz") for f in lines.inputFiles())
    landed = variants.landed_records(spark, folder).count() + variants.landed_rejects(spark, folder).count()
    assert lines.count() == landed > 0
