"""Published results that the operators must reproduce."""

from datetime import date

from harmlens.operators import advisors as adv
from harmlens.operators import features as feat
from harmlens.operators import harmonize as har
from harmlens.operators import text_rules as txt
from harmlens.schemas import UNIFIED, struct

# Source, year, sector, cases, days, deaths -> days per case, fatality, severity, category.
FEATURE_ROWS = [
    ("CNESST", 2023, "221122", 748, 7480, 3, 10.0, 4.0107, 32.25, "LOW"),
    ("CNESST", 2023, "23", 7518, 52626, 12, 7.0, 1.5962, 34.52, "MEDIUM"),
    ("CNESST", 2023, "62", 21346, 85384, 5, 4.0, 0.2342, 34.5, "HIGH"),
    ("CNESST", 2023, "31-33", 12252, 73512, 8, 6.0, 0.653, 34.25, "MEDIUM"),
    ("OSHA", 2023, "2211", 1850, 18500, 82, 10.0, 44.3243, 72.85, "CRITICAL"),
    ("OSHA", 2023, "23", 46200, 462000, 423, 10.0, 9.1558, 100.0, "CRITICAL"),
    ("OSHA", 2023, "62", 124000, 744000, 23, 6.0, 0.1855, 49.5, "CRITICAL"),
    ("OSHA", 2023, "31-33", 34500, 241500, 67, 7.0, 1.942, 74.5, "CRITICAL"),
]
FEATURE_DDL = "source string, year int, sector string, total_cases bigint, days_lost bigint, total_deaths bigint"
CASE_DDL = "annee int, scian string, genre_accident string, nature_lesion string, nombre_lesions bigint, jours_perdus bigint"


def test_features(spark):
    out = feat.derive_features(spark.createDataFrame([r[:6] for r in FEATURE_ROWS], FEATURE_DDL))
    got = {(r.source, r.sector): (r.days_per_case, r.fatality_rate, r.severity_score, r.risk_category) for r in out.collect()}
    assert got == {(r[0], r[2]): r[6:] for r in FEATURE_ROWS}


def test_feature_vector(spark):
    out = feat.feature_vector(feat.derive_features(spark.createDataFrame([FEATURE_ROWS[0][:6]], FEATURE_DDL)))
    assert out.first().vector == [2023.0, 748.0, 7480.0, 3.0, 10.0, 4.0107, 32.25]


def test_feature_zero_cases(spark):
    row = feat.derive_features(spark.createDataFrame([("X", 2023, "1", 0, 5, 0)], FEATURE_DDL)).first()
    assert (row.total_cases, row.days_per_case, row.fatality_rate, row.risk_category) == (1, 5.0, 0.0, "LOW")


def electric(spark):
    return spark.createDataFrame([(2023, "221122", "51", "40", 5000, 60000), (2022, "221122", "51", "40", 218, 1339)], CASE_DDL)


def test_severity_risk(spark):
    row = adv.severity_risk(adv.case_totals(electric(spark))).first()
    assert (row.cases, row.days, row.risk_level, row.score) == (5218, 61339, "CRITICAL", 100.0)
    assert row.factors == ["High severity per incident", "Inherently hazardous industry"]


def test_compare_jurisdictions(spark):
    osha = spark.createDataFrame([(2023, "2211", "x", 10870, 451, 9)], "year int, naics string, industry_description string, total_cases bigint, total_deaths bigint, days_away bigint")
    rows = {r.sector: r for r in adv.compare_jurisdictions(electric(spark), osha).collect()}
    assert (rows["221122"].us_cases, rows["221122"].us_deaths, rows["221122"].ratio_usa_qc) == (10870, 451, 2.08)


def test_remedies(spark):
    ranked = adv.remedies(spark.createDataFrame([("221122",), ("99",)], "sector string"))
    top = [(r.id, r.roi) for r in ranked.filter("sector = '221122' AND rank <= 5").orderBy("rank").collect()]
    assert top == [("C3", 18650), ("E1", 9400), ("T2", 6400), ("C2", 4900), ("T1", 2816)]
    plan = {r.sector: r for r in adv.remedy_plan(ranked).collect()}
    assert (plan["221122"].total_investment, plan["221122"].expected_reduction, plan["221122"].best_roi) == (32000, 78.3, 18650)
    assert {r.risk_type for r in ranked.filter("sector = '99'").collect()} == {"TMS", "CHUTE"}


def test_audit(spark):
    sectors = spark.createDataFrame([("221122",)], "sector string")
    statuses = spark.createDataFrame([("221122", "ISO-14001", "A VERIFIER"), ("221122", "ISO-14001", "A VERIFIER"), ("221122", "29CFR1926.501", "A VERIFIER")],
                                     "sector string, code string, status string")
    row = adv.audit(sectors, statuses).first()
    assert (row.regulations_checked, row.non_conformites, row.score_conformite) == (7, 1, 85.7)


def test_positioning(spark):
    rows = spark.createDataFrame([(2023, "221122", "51", "40", 100, 1283)], CASE_DDL)
    row = adv.positioning(rows).first()
    assert (row.gravite_moyenne, row.percentile, row["rank"]) == (12.83, 15, "Bottom 15%")


def test_mixed_batch(spark):
    records = spark.createDataFrame([
        ({"ActivityNr": "123456789", "event_type": "42", "nature": "121", "body_part": "52", "naics_code": "23821"},),
        ({"deviation": "61", "geo": "fr", "nace_r2": "F4321", "OBS_VALUE": "1250", "TIME_PERIOD": "2023"},),
        ({"genre_accident": "31", "scian": "23", "nombre_lesions": "45"},),
        ({"colour": "red"},)], "record map<string, string>")
    out = {r.data_provenance.source_system: r for r in har.transform_mixed(records, date(2024, 1, 1)).collect()}
    osha, esaw, cnesst, generic = (out[k] for k in ("OSHA_SEVERE_INJURY", "EUROSTAT_ESAW", "CNESST", "MANUAL_ENTRY"))
    assert osha.hazard_classification.unified.domain_code == "CHUTE"
    assert (osha.industry_classification.nace.code, osha.data_provenance.source_record_id) == ("F4321", "123456789")
    assert esaw.hazard_classification.unified.domain_code == "ELEC"
    assert (esaw.jurisdiction.primary_country, esaw.jurisdiction.applicable_jurisdictions) == ("FR", ["FR", "EU"])
    assert (esaw.incident_statistics.total_incidents, esaw.incident_statistics.reporting_period.end_date) == (1250, "2023-12-31")
    assert cnesst.hazard_classification.unified.domain_code == "CHUTE"
    assert (cnesst.industry_classification.nace.code, cnesst.incident_statistics.total_incidents, cnesst.incident_statistics.total_lost_days) == ("F", 45, 0)
    assert cnesst.metadata.tags == ["cnesst", "quebec", "canada", "chute"]
    assert (generic.status, generic.data_provenance.validation_status, generic.jurisdiction) == ("DRAFT", "REVIEW_REQUIRED", None)


def test_observation(spark):
    text = "Travailleur penche avec dos courbe, souleve charge rapide, sans gants"
    row = txt.score_observations(spark.createDataFrame([(text,)], "text string")).first()
    assert row.indicators == ["POSTURE:penche", "POSTURE:courbe", "POSTURE:dos", "VITESSE:rapide", "EPI:sans gants"]
    assert (row.risk_score, row.risk_level, row.pattern) == (100, "CRITIQUE", "RACCOURCI_TEMPS")
    assert row.interventions == ["ARRET_IMMEDIAT", "INTERVENTION_SUPERVISEUR", "CORRECTION_IMMEDIATE", "RAPPEL_SECURITE"]


def test_intent_and_sector(spark):
    texts = ["Combien au TOTAL ?", "Secteur construction", "comparer usa", "danger", "une solution", "bonjour"]
    rows = txt.mentioned_sector(txt.detect_intent(spark.createDataFrame([(x,) for x in texts], "text string"))).collect()
    assert [r.intent for r in rows] == ["stats", "sector_analysis", "comparison", "risk_prediction", "recommendation", "general"]
    assert [r.sector for r in rows] == ["221122", "23", "221122", "221122", "221122", "221122"]


def test_inspection_source(spark):
    rows = spark.createDataFrame([("1", "421", "OSHA Inspection file"), ("2", "429", None)], "id string, event_type string, source string")
    out = {r.data_provenance.source_record_id: r for r in har.transform_osha(rows, date(2024, 1, 1)).collect()}
    assert out["1"].data_provenance.source_system == "OSHA_INSPECTION"
    assert out["2"].data_provenance.source_system == "OSHA_SEVERE_INJURY"
    assert out["2"].hazard_classification.unified.domain_code == "CHUTE"  # the two-digit parent
    assert har.detect_frame(rows) == "osha"


def test_every_source_gives_the_same_schema(spark):
    def shape(dtype):
        """Names and types without nullability."""
        return dtype.simpleString()

    one = spark.createDataFrame([("1",)], "id string")
    expected = shape(struct(UNIFIED))
    for transform in har.TRANSFORMS.values():
        assert shape(transform(one, date(2024, 1, 1)).schema) == expected
    mixed = spark.createDataFrame([({"id": "1"},)], "record map<string, string>")
    assert shape(har.transform_mixed(mixed, date(2024, 1, 1)).schema) == expected
