"""Edge cases: nulls, ties, zero divisors, fallbacks, and brute-force comparisons."""

import random
from collections import deque
from datetime import date, datetime

from pyspark.sql import functions as F

from harmlens.functions import dims
from harmlens.functions.exprs import percent, ratio
from harmlens.operators import aggregates as agg
from harmlens.operators import graph as gr
from harmlens.operators import lookups as lk
from harmlens.operators import outlook as out
from harmlens.operators import predictive as pre
from harmlens.operators import text_rules as txt
from harmlens.operators import warehouse as wh
from harmlens.operators import windows as win
from harmlens.sources import catalog, conform, layers, readers
from harmlens.workspace import scratch_path

LESION = ("secteur_scian string, annee int, nature_lesion string, siege_lesion string, genre string, agent_causal_lesion string, sexe_pers_phys string, "
          "groupe_age string, ind_lesion_tms string, ind_lesion_psy string, ind_lesion_covid_19 string, ind_lesion_surdite string, ind_lesion_machine string")


def lesion(sector="A", year=2020, nature="n", agent="g", sex="F", age="45-54", tms="NON", psy="NON"):
    return (sector, year, nature, "s", "1", agent, sex, age, tms, psy, "NON", "NON", "NON")


def test_rounding_is_half_up(spark):
    rows = spark.createDataFrame([(1, 8), (1, 800), (5, 0), (2, 3)], "a bigint, b bigint")
    got = [r[0] for r in rows.select(percent("a", "b")).collect()]
    assert got == [12.5, 0.13, None, 66.67]
    assert [r[0] for r in rows.select(ratio("a", "b", 1000, 4)).collect()] == [125.0, 1.25, None, 666.6667]


def test_null_flags_and_null_groups(spark):
    rows = spark.createDataFrame([lesion(tms=None), lesion(tms="OUI"), lesion(sector=None, tms="OUI")], LESION)
    got = {r.secteur_scian: (r.total_lesions, r.lesions_tms, r.pct_tms) for r in agg.sector_year_stats(rows).collect()}
    assert got == {"A": (2, 1, 50.0), None: (1, 1, 100.0)}
    profile = {r.secteur: r.top_agent for r in agg.sector_profile_exact(rows).collect()}
    assert profile == {"A": "g", None: "g"}


def test_ties_take_the_smallest_value(spark):
    rows = spark.createDataFrame([lesion(agent=a) for a in ("z", "b", "z", "b", "c", None, None, None)], LESION)
    assert agg.most_frequent_value(rows, "agent_causal_lesion").first().valeur == "b"
    assert agg.sector_profile_exact(rows).first().top_agent is None  # here a missing agent is a value
    top = win.top_n_with_share(rows, ["secteur_scian"], "agent_causal_lesion", 2)
    assert [(r.valeur, r.total, r.pct) for r in top.orderBy("rank").collect()] == [("b", 2, 40.0), ("z", 2, 40.0)]


def test_table_functions_filter_exactly(spark):
    rows = spark.createDataFrame([lesion("AB"), lesion("A"), lesion("A", psy="OUI")], LESION)
    one = agg.sector_profile_exact(rows, "A").collect()
    assert [(r.secteur, r.total_lesions, r.pct_total) for r in one] == [("A", 2, 66.67)]
    status = {r.secteur: r.statut for r in agg.compare_to_province(rows, "PSY").collect()}
    assert status == {"A": agg.ABOVE, "AB": agg.BELOW}


def test_wildcards_stay_live(spark):
    rows = spark.createDataFrame([("abc",), ("axc",), ("ac",)], "s string")
    assert {r.s for r in win.scan(rows, contains={"s": "A_C"}).collect()} == {"abc", "axc"}
    assert win.scan(rows, contains={"s": None}, limit=2).count() == 2


def test_code_fallbacks(spark):
    codes = spark.createDataFrame([("42",), ("429",), ("5",), ("9",), ("",), (None,)], "event_type string")
    got = {r.event_type: r.event_hazard_code for r in lk.osha_event(codes).collect()}
    assert got == {"42": "CHUTE-01", "429": "CHUTE-01", "5": "AUTRE-99", "9": "AUTRE-99", "": "AUTRE-99", None: "AUTRE-99"}
    natures = spark.createDataFrame([("129",), ("12",)], "nature string")
    assert {r.nature: r.nature_nature_code for r in lk.osha_nature(natures).collect()} == {"129": "NAT-01", "12": "NAT-99"}
    parts = spark.createDataFrame([("19",), ("8",), ("77",)], "body_part string")
    assert {r.body_part: r.part_part_code for r in lk.osha_bodypart(parts).collect()} == {"19": "BP-01", "8": "BP-90", "77": "BP-99"}
    assert {r.event_type: r.hazard_domain for r in lk.unified_exact(codes, "osha", "event_type").collect()}["429"] == "AUTRE"


def test_prefix_lookup_brute_force(spark):
    rng = random.Random(7)
    keys = [""] + ["".join(rng.choice("1234-69") for _ in range(rng.randint(1, 7))) for _ in range(300)] + [r[1] for r in dims.SECTOR_CROSSWALK.rows]
    entries = [(r[1], r[4]) for r in dims.SECTOR_CROSSWALK.rows]

    def expected(code):
        exact = dict(entries)
        if code in exact:
            return exact[code]
        return next((nace for key, nace in entries if code.startswith(key) or key.startswith(code)), "UNKNOWN")

    rows = lk.sector_crosswalk(spark.createDataFrame([(k,) for k in keys], "scian string"))
    assert all(r.sector_nace == expected(r.scian) for r in rows.collect())
    assert expected("") == "D35.13"


def test_containment_join_brute_force(spark):
    agents = [("A", "23,31-33"), ("B", "62"), ("C", ""), ("D", "2,6")]
    keys = ["23", "3", "62", "", "9", "31-33", ",", "2"]
    index = gr.containment_index(spark.createDataFrame(agents, "id string, cover string"), "id", ["cover"])
    got = {(r.key, r.item) for r in gr.containment_join(spark.createDataFrame([(k,) for k in keys], "key string"), "key", index).collect()}
    assert got == {(k, i) for k in keys for i, text in agents if k in text}


def test_shortest_paths_brute_force(spark):
    rng = random.Random(3)
    nodes = [f"n{i:02d}" for i in range(30)]
    edges = list({(rng.choice(nodes), rng.choice(nodes)) for _ in range(38)}) + [("hub", n) for n in nodes[:5]]

    def distance(start):
        near = {}
        for a, b in edges:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
        seen, queue = {start: 0}, deque([start])
        while queue:
            node = queue.popleft()
            if seen[node] < 5:
                for other in near.get(node, ()):
                    if other not in seen:
                        seen[other] = seen[node] + 1
                        queue.append(other)
        return seen

    sources = spark.createDataFrame([(n,) for n in nodes[:4]], "node string")
    targets = spark.createDataFrame([(n,) for n in nodes], "node string")
    rows = gr.shortest_paths(spark.createDataFrame(edges, "a string, b string"), sources, targets).collect()
    expected = {(s, n): d for s in nodes[:4] for n, d in distance(s).items() if n != s and n in nodes}
    assert {(r.source, r.target): r.path_length for r in rows} == expected
    linked = {frozenset(e) for e in edges}
    assert all(len(r.path) == r.path_length + 1 and all(frozenset(p) in linked for p in zip(r.path, r.path[1:])) for r in rows)


def test_forecast_needs_three_years(spark):
    years = spark.createDataFrame([("A", 2020, 10), ("A", 2021, 20), ("A", 2022, 30), ("B", 2021, 5), ("B", 2022, 1), ("C", 2020, 9), ("C", 2021, 5), ("C", 2022, 1)],
                                  "secteur_scian string, annee int, n bigint")
    rows = {(r.secteur_scian, r.annee): r.prediction for r in out.forecast(years).collect()}
    assert rows == {("A", 2023): 40, ("A", 2024): 50, ("C", 2023): 0, ("C", 2024): 0}


def test_trend_alert_bands(spark):
    years = spark.createDataFrame([("A", 2021, 100), ("A", 2022, 131), ("B", 2021, 100), ("B", 2022, 116), ("C", 2021, 100), ("C", 2022, 115), ("D", 2022, 9)],
                                  "secteur_scian string, annee int, n bigint")
    rows = {r.secteur_scian: r.type for r in pre.trend_alerts(years, date(2024, 1, 1)).collect()}
    assert rows == {"A": "TREND_SPIKE", "B": "TREND_INCREASE"}
    assert pre.seasonal_alerts(years, date(2024, 3, 1)).count() == 0
    assert pre.seasonal_alerts(years, date(2024, 8, 1)).count() == 4


def test_worker_profile_for(spark):
    rows = spark.createDataFrame([lesion(age="45-54", tms="OUI"), lesion(age="15-24"), lesion(age="15-24", sex="M")], LESION)
    one = pre.worker_profile_for(rows, "a", "45", "f").first()
    assert (one.n, one.tms_rate, one.risk_score, one.specific_risks) == (1, 100.0, 100.0, ["TMS"])
    assert one.recommended_training == ["Ergonomie et manutention (PRIORITÉ HAUTE)", "Adaptation du poste de travail", "Formation SST de base"]
    none = pre.worker_profile_for(rows, "zz", "45", "f").first()
    assert (none.n, none.risk_score, none.recommended_training, none.specific_risks) == (0, 50.0, ["Formation SST générale"], [])


def test_chain_confidence_and_summary(spark):
    steps = spark.createDataFrame([("a", 0.9), ("a", 0.95), ("b", 1.0)], "k string, c double")
    assert {r.k: (r.confidence, r.steps) for r in txt.chain_confidence(steps, "k", "c").collect()} == {"a": (0.855, 2), "b": (1.0, 1)}
    turns = spark.createDataFrame([("x", i, "user", f"{i}" * (150 if i == 7 else 1)) for i in range(1, 8)], "conv_id string, turn int, role string, text string")
    lines = txt.summarize(turns).first().summary.split("\n")
    assert lines[0] == "[user]: 3" and lines[-1] == "[user]: " + "7" * 100 + "..." and len(lines) == 5


def test_upsert_running_totals(spark):
    runs = lambda n: spark.createDataFrame([("k", "K", "QC", n, "success", None)],
                                           "source_key string, source_name string, jurisdiction string, rows bigint, status string, error_message string")
    first = wh.update_sources(wh.empty_status(spark), runs(10), datetime(2024, 1, 1))
    second = wh.update_sources(first, runs(5), datetime(2024, 1, 2)).first()
    assert (first.first().rows_ingested, first.first().total_rows) == (10, 0)
    assert (second.rows_ingested, second.total_rows, second.last_ingestion) == (15, 5, datetime(2024, 1, 2))


def test_unique_and_rejected_rows_are_whole(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randint(1, 30)}", "s", rng.randint(1, 4)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "incident_id string, source string, v int")
    kept, lost = wh.unique_rows(df, ["incident_id", "source"]), wh.rejected_rows(df, ["incident_id", "source"])
    best = {}
    for k, s, v in rows:
        best[k] = min(v, best.get(k, v))
    assert {r.incident_id: r.v for r in kept.collect()} == best
    assert kept.agg(F.sum("copies")).first()[0] == len(rows)
    assert lost.agg(F.sum("rejected")).first()[0] == len(rows) - len(best)
    old = spark.createDataFrame([("hot", "s")], "incident_id string, source string")
    assert wh.unique_rows(df, ["incident_id", "source"], old).count() == len(best) - 1


def test_cube_decoding(spark):
    folder = scratch_path(spark, "cube")
    spark.sql("""SELECT '{"dimension":{"geo":{"category":{"index":{"FR":0,"DE":1},"label":{"FR":"France"}}},
        "time":{"category":{"index":{"2020":0,"2021":1,"2022":2},"label":{}}}},"value":{"0":5,"4":7.5}}' AS value""").write.text(folder)
    rows = {(r.geo, r.geo_label, r.time, r.value) for r in readers.read_cube(spark, folder, ["geo", "time"]).collect()}
    assert rows == {("FR", "France", "2020", 5.0), ("DE", "DE", "2021", 7.5)}


def test_gold_contract(spark):
    gold = conform.to_gold(spark.createDataFrame([("x",)], "extra string"), "S", "J", datetime(2024, 1, 1))
    row = gold.first()
    assert (row.extra, row.source, row.jurisdiction, row.year, row.days_lost, row.incident_id) == ("x", "S", "J", 0, None, None)
    assert "date" not in gold.columns and "created_at" not in gold.columns and "updated_at" in gold.columns


def test_normalize(spark):
    raw = spark.createDataFrame([("7", "2024-01-15", "Mining", "DEATH"), ("8", None, "Other", None)], "id string, date string, sector string, severity string")
    rows = {r.id: r for r in conform.normalize(raw, "osha", "id", datetime(2024, 1, 1)).collect()}
    assert (rows["7"].incident_uri, rows["7"].scian_code, rows["7"].severity_normalized) == ("incident:osha:2024-01-15:7", "21", "CRITICAL")
    assert (rows["8"].incident_uri, rows["8"].scian_code, rows["8"].severity_normalized) == ("incident:osha:unknown:8", "Other", "MEDIUM")


def test_connector_rule(spark):
    routes = catalog.registered(spark).select("source_key", catalog.connector(F.col("source_key"), F.col("type")).alias("r"))
    got = dict(routes.collect())
    assert (got["kaggle_osha_injuries"], got["cnesst_lesions"], got["carsat_opendata"], got["ilostat_injuries"]) == ("osha", "dares", "osha", "ilostat")
    assert [r.source_key for r in catalog.run_order(catalog.registered(spark), 1).collect()][:2] == ["kaggle_osha_injuries", "osha_inspections"]


def test_long_sector_names_and_late_years_stay_apart(spark):
    counts = spark.createDataFrame([("TRANSPORT ET ENTREPOSAGE A", 2024, 9), ("TRANSPORT ET ENTREPOSAGE B", 2024, 4), ("MINES", 2009, 1)], "secteur string, annee int, total bigint")
    nodes, edges = gr.sector_graph(counts)
    stats = {r.key: r.total for r in nodes.filter("array_contains(labels, 'IncidentStats')").collect()}
    assert stats == {"QC-TRANSPORT ET ENTREPOSAGE A-2024": 9, "QC-TRANSPORT ET ENTREPOSAGE B-2024": 4, "QC-MINES-2009": 1}
    assert [edges.filter(F.col("rel") == rel).count() for rel in ("HAS_STATS", "IN_YEAR", "IN_JURISDICTION")] == [3, 3, 3]
    years = {r.key for r in gr.stat_base_nodes(spark, counts).filter("array_contains(labels, 'Year')").collect()}
    assert {"2009", "2010", "2023", "2024"} <= years


def test_country_name_falls_back_to_code(spark):
    countries = spark.createDataFrame([("FR", None, 3, 1), ("DE", "Germany", 2, 1)], "country string, country_name string, total bigint, incidents bigint")
    nodes, edges = gr.country_graph(countries)
    assert {r.key: r.name for r in nodes.collect()} == {"EU-FR": "FR", "EU-DE": "Germany"}
    assert edges.count() == 2


def test_empty_export_writes_nothing(spark):
    assert layers.export_csv(spark.createDataFrame([], "a int"), scratch_path(spark, "none")) is None


def test_failed_source_is_reported(spark):
    log = layers.run_layers(spark, "S", "J", lambda: spark.read.parquet("/no/such/folder"), conform.from_dares, scratch_path(spark, "l"), "1", datetime(2024, 1, 1)).first()
    assert log.status == "failed" and log.error


def test_missing_csv_folder(spark):
    assert readers.read_csv_folder(spark, scratch_path(spark, "absent")) is None


def test_unknown_suffix_is_empty(spark):
    assert readers.read_records(spark, "/tmp/file.xlsx", "a string").count() == 0


def test_a_batch_loaded_twice_is_there_once(spark):
    from datetime import datetime

    from harmlens.sources import layers
    from harmlens.workspace import scratch_path

    root = scratch_path(spark, "twice")
    gold = spark.createDataFrame([("a", "OSHA", 2020), ("b", "OSHA", 2021)], "incident_id string, source string, year int")
    load = lambda df, batch, mode="append": layers.load_gold(df, f"{root}/table", batch, datetime(2024, 1, 1), mode)
    stored = lambda: sorted((r.incident_id, str(r.ingestion_batch_id)) for r in spark.read.parquet(f"{root}/table").collect())
    load(gold, "one")
    load(gold.filter("incident_id = 'b'"), "two")
    assert load(gold, "one") == 2
    assert stored() == [("a", "one"), ("b", "one"), ("b", "two")]
    load(gold, "three", "overwrite")
    assert stored() == [("a", "three"), ("b", "three")]
    for _ in range(2):
        layers.land_raw(gold, root, "osha", "day1")
    layers.land_raw(gold, root, "osha", "day2")
    assert spark.read.parquet(f"{root}/raw/osha").count() == 4


def test_one_attempt_serves_all_sinks(spark):
    from datetime import date

    from harmlens.operators import harmonize
    from harmlens.sources import layers
    from harmlens.workspace import scratch_path

    root = scratch_path(spark, "attempt")
    raw = spark.createDataFrame([("1", "11"), ("2", "11"), ("2", "11")], "id string, event_type string")
    attempt = layers.store_attempt(raw, root, date(2024, 1, 1), harmonize.SCHEMA)
    assert (attempt.source, attempt.extracted, attempt.harmonized, attempt.valid) == ("osha", 3, 3, 3)
    found = {sink: layers.deliver(attempt, f"{root}/{sink}", [sink]).first() for sink in (*layers.OUTPUTS, "all")}
    assert {k: (r.written, r.loaded) for k, r in found.items()} == {"json": (3, 0), "graph": (0, 2), "table": (0, 3), "all": (3, 5)}
    whole = layers.integrate(raw, f"{root}/whole", date(2024, 1, 1), ["all"], harmonize.SCHEMA).first()
    assert whole == found["all"]
