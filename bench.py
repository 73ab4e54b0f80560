"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from harmlens.plans import REGISTRY
from harmlens.session import local_session
from harmlens.workspace import clear_scratch

HEADLINE = [
    "a01_sector_year_stats", "a03_nature_stats", "a09_sector_risk_profile", "a14_sector_profile_exact", "a16_global_stats",
    "a27_sector_severity", "a29_naics_fatality", "w02_yoy", "w06_top_n_by", "f02_benchmarks", "f05_full_enrichment",
    "f11_forecast", "f12_cross_tabs", "f16_executive_report", "f17_incident_outlook", "f23_worker_profiles",
    "f25_intelligence_report", "f30_remedy_plan", "f34_derive_features", "f38_score_documents", "f42_summarize",
    "h01_osha_event", "h08_osha_unified", "h11_transform_mixed", "h18_sector_crosswalk", "j07_compare_jurisdictions", "t03_unique_rows",
    "t03_rejected_rows", "g02_risk_edges", "g16_incident_edges", "x02_stream_spikes", "s01_csv_folder", "p21_integrate_file",
    "g07_concordance_path", "k03_save_gold", "f36_classify_high_risk",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, memory=os.environ.get("BENCH_MEMORY", "8g"))
    REGISTRY["a08_year_trends"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm the JVM
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    clear_scratch(spark)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
