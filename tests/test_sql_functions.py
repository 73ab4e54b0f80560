"""A14 and A15 as SQL table functions."""

import pytest

from harmlens.operators import aggregates as agg
from harmlens.operators import sql_functions as sf
from harmlens.plans.tables import tables_for
from tests.test_edges import LESION, lesion


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_one_sector_equals_the_frame_form(spark, sf_dir):
    lesions = tables_for(spark, sf_dir).lesions
    sf.register_functions(lesions)
    sector = lesions.select("secteur_scian").first()[0]
    one = spark.sql(f"SELECT * FROM {sf.PROFILE_FUNCTION}(:s)", args={"s": sector})
    assert rows(one) == rows(agg.sector_profile_exact(lesions, sector).select(one.columns))
    for indicator in ("TMS", "PSY", "MACHINE", "SURDITE"):
        rate = spark.sql(f"SELECT * FROM {sf.COMPARE_FUNCTION}(:s, :i)", args={"s": sector, "i": indicator})
        assert rows(rate) == rows(agg.compare_to_province(lesions, indicator, sector).select(rate.columns))


def test_many_sectors_take_one_aggregate(spark, sf_dir):
    lesions = tables_for(spark, sf_dir).lesions
    sf.register_functions(lesions)
    wanted = "VALUES ('ECONOMY'), ('LARGE'), ('nowhere'), (NULL)"
    for call, shuffles in ((f"{sf.PROFILE_FUNCTION}(w.s)", 2), (f"{sf.COMPARE_FUNCTION}(w.s, 'PSY')", 1)):
        df = spark.sql(f"SELECT p.* FROM ({wanted}) w(s), LATERAL {call} p")
        plan = plan_of(df)
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert plan.count("lineitem.parquet") <= 1 and plan.count("Exchange hashpartitioning(secteur_scian") <= shuffles
        assert {r.secteur for r in df.collect()} == {"ECONOMY", "LARGE"}
    kept = spark.sql(f"SELECT w.s, p.total_lesions FROM (VALUES ('nowhere')) w(s) LEFT JOIN LATERAL {sf.PROFILE_FUNCTION}(w.s) p").collect()
    assert [tuple(r) for r in kept] == [("nowhere", None)]


def test_ties_nulls_and_no_rows(spark):
    data = [lesion(nature=None), lesion(nature="a", tms="OUI"), lesion(sector=None), lesion(sector="B", nature="z", psy=None)]
    sf.register_functions(spark.createDataFrame(data, LESION), prefix="small_")
    got = spark.sql("SELECT * FROM small_get_sector_risk_profile('A')").first()
    assert (got.total_lesions, got.pct_total, got.risk_tms, got.risk_psy, got.risk_level, got.top_nature) == (2, 50.0, 50.0, 0.0, "FAIBLE", None)
    assert spark.sql("SELECT * FROM small_get_sector_risk_profile(NULL)").isEmpty()
    sf.register_functions(spark.createDataFrame([], LESION), prefix="small_")
    for call in ("small_get_sector_risk_profile('A')", "small_compare_to_provincial_avg('A', 'TMS')"):
        assert spark.sql(f"SELECT * FROM {call}").isEmpty()


def test_unknown_indicator_gives_no_row(spark):
    sf.register_functions(spark.createDataFrame([lesion()], LESION), prefix="one_")
    assert spark.sql("SELECT * FROM one_compare_to_provincial_avg('A', 'X')").isEmpty()
    with pytest.raises(Exception, match="one_compare_to_provincial_avg"):
        spark.sql("SELECT * FROM one_compare_to_provincial_avg('A')")
