"""Properties of the physical plans: no product joins, no Python rows, pruned scans."""

import re

import pytest

from harmlens.operators import aggregates as agg
from harmlens.operators import windows as win
from harmlens.plans import REGISTRY
from harmlens.plans.tables import tables_for

EAGER = {n for n in REGISTRY if n.startswith("f36_")}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in REGISTRY if n not in EAGER])
def test_no_product_join_and_no_python(name, spark, sf_dir):
    plan = plan_of(REGISTRY[name].run(spark, sf_dir))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert banned not in plan


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = plan_of(agg.counts_by(tables_for(spark, sf_dir).base("lineitem"), ["l_returnflag"]))
    assert re.search(r"ReadSchema: struct<l_returnflag:string>", plan)


def test_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(win.scan(tables_for(spark, sf_dir).base("orders"), equals={"o_orderstatus": "F"}))
    assert "EqualTo(o_orderstatus,F)" in plan


def test_top_n_is_pruned_before_the_shuffle(spark, sf_dir):
    plan = plan_of(REGISTRY["w06_top_n_by"].run(spark, sf_dir))
    assert plan.count("WindowGroupLimit") == 2


def test_totals_reuse_the_grouped_shuffle(spark, sf_dir):
    df = REGISTRY["f02_benchmarks"].run(spark, sf_dir)
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_risk_nodes_are_hashed(spark, sf_dir):
    plan = plan_of(REGISTRY["g02_risk_edges"].run(spark, sf_dir))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_mixed_records_are_detected_once(spark, sf_dir):
    plan = REGISTRY["h11_transform_mixed"].run(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 18_000 and plan.count("array_contains") == 9


def test_mixed_records_are_unified_once_for_all_schemas(spark, sf_dir):
    # one scan for the inspection records and one for the cases counted from the same lines
    plan = REGISTRY["h16_validate"].run(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_linenumber") and len(re.findall(r"Relation \[l_orderkey", plan)) == 2


def test_scratch_folders_are_removed(spark):
    from harmlens.workspace import clear_scratch, scratch_path

    path = scratch_path(spark, "gone")
    spark.range(1).write.parquet(path)
    assert clear_scratch(spark) >= 1
    assert clear_scratch(spark) == 0


def test_risk_edges_move_their_own_columns_only(spark, sf_dir):
    plan = REGISTRY["g02_risk_edges"].run(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "titre_fr" not in plan and "tags" not in plan and "total_incidents" not in plan
