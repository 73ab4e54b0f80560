"""Incremental ingest reads a file once; streamed spikes equal the batch result."""

from datetime import datetime, timedelta

from harmlens.streaming import ingest
from harmlens.workspace import scratch_path


def test_only_new_files_are_ingested(spark):
    root = scratch_path(spark, "ingest")
    rows = spark.createDataFrame([(1,), (2,)], "a int")
    run = lambda: ingest.ingest_new_files(spark, f"{root}/landing", rows.schema, f"{root}/bronze", f"{root}/state")
    rows.write.parquet(f"{root}/landing")
    run()
    run()  # nothing new
    spark.createDataFrame([(3,)], "a int").write.mode("append").parquet(f"{root}/landing")
    run()
    stored = spark.read.parquet(f"{root}/bronze")
    assert sorted(r.a for r in stored.collect()) == [1, 2, 3]
    assert sorted((r.a, r.ingestion_batch) for r in stored.collect()) == [(1, 0), (2, 0), (3, 1)]


def test_streamed_spikes_match_batch(spark):
    root = scratch_path(spark, "spikes")
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(days=d, minutes=i), "x") for d, n in enumerate((10, 12, 20, 5)) for i in range(n)]
    events = spark.createDataFrame(rows, "ts timestamp, kind string")
    events.write.parquet(f"{root}/events")
    stream = spark.readStream.schema(events.schema).parquet(f"{root}/events")
    ingest.stream_spikes(stream, "kind", f"{root}/out", f"{root}/state")
    streamed = {(r.debut, r.n, r.previous, r.change_pct, r.level) for r in ingest.read_spikes(spark, f"{root}/out").collect()}
    batch = {(r.debut, r.n, r.previous, r.change_pct, r.level) for r in ingest.spikes(ingest.windowed_counts(events, "kind")).collect()}
    assert streamed == batch
    assert sorted(r[4] for r in streamed) == ["CRITICAL", "NORMAL", "WARNING"]


def test_state_stays_bounded_and_late_rows_are_dropped(spark):
    """A file a day, one batch a file: open windows only, whatever the number of days, and after a restart."""
    root = scratch_path(spark, "days")
    start = datetime(2024, 1, 1)

    def land(name, rows):
        spark.createDataFrame(rows, "ts timestamp, kind string").coalesce(1).write.parquet(f"{root}/events/{name}")

    def run():
        stream = spark.readStream.schema("ts timestamp, kind string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{root}/events")
        query = ingest.stream_spikes(stream, "kind", f"{root}/out", f"{root}/state")
        return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]

    for day in range(12):
        land(f"a{day:02d}", [(start + timedelta(days=day, minutes=i), "x") for i in range(day + 1)])
        if day == 5:
            first = run()
    sizes = first + run()  # the second run goes on from the checkpoint
    land("late", [(start, "x")] * 50)
    run()
    assert max(sizes) <= 4
    counts = {r.debut: r.n for r in ingest.read_spikes(spark, f"{root}/out").collect()}
    assert counts == {start + timedelta(days=d): d + 1 for d in range(1, 12)}


def _land(spark, root, name, rows, ddl="id bigint, ts timestamp, v string"):
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{root}/landing/{name}")


def test_a_record_is_stored_once_across_files_runs_and_restarts(spark):
    root, start = scratch_path(spark, "unique"), datetime(2024, 1, 1)
    schema = spark.createDataFrame([], "id bigint, ts timestamp, v string").schema
    at = lambda day: start + timedelta(days=day)

    def run():
        return ingest.ingest_unique(spark, f"{root}/landing", schema, f"{root}/stored", f"{root}/state", ["id"], "ts", maxFilesPerTrigger="1")

    _land(spark, root, "a", [(i, at(0), "first") for i in range(100)])
    _land(spark, root, "b", [(i, at(0), "again") for i in range(50, 120)])  # in a second file of the same run
    first = run()
    assert (first.stored, first.late) == (120, 0)
    _land(spark, root, "c", [(i, at(1), "later") for i in range(90, 150)] + [(None, at(1), "none"), (None, at(1), "none too")])  # after a restart
    assert run().stored == 30 + 1  # a missing key is one key
    sizes = []
    for day in range(2, 14):
        _land(spark, root, f"d{day:02d}", [(1000 * day + i, at(day), "x") for i in range(200)])
        sizes.append(run().state)
    assert max(sizes) <= 200 * 6  # days that are still open, not all keys seen
    _land(spark, root, "late", [(5, at(0), "copy"), (7777, at(0), "new but late"), (8888, None, "no time"), (13_000, at(13), "copy")])
    last = run()
    assert (last.stored, last.late) == (0, 3)
    assert ingest.admit_late(spark, f"{root}/landing", schema, f"{root}/stored", ["id"], "1") == 2
    assert ingest.admit_late(spark, f"{root}/landing", schema, f"{root}/stored", ["id"], "2") == 0
    stored = spark.read.schema(schema).parquet(f"{root}/stored").collect()
    ids = [r.id for r in stored]
    assert len(ids) == len(set(ids)) == 150 + 1 + 12 * 200 + 2
    assert {r.v for r in stored if r.id in (5, 60)} <= {"first", "again"} and {r.v for r in stored if r.id == 7777} == {"new but late"}


def test_alerts_are_emitted_once_with_late_rows_and_a_restart(spark):
    root, start = scratch_path(spark, "alerts"), datetime(2024, 1, 1)
    days = {0: 10, 1: 12, 2: 20, 3: 5, 5: 4, 6: 6, 9: 3, 10: 3, 11: 4, 16: 1}  # 4, 7, 8 and 12 to 15 are empty

    def land(name, rows):
        spark.createDataFrame(rows, "ts timestamp, kind string").coalesce(1).write.parquet(f"{root}/events/{name}")

    def run():
        stream = spark.readStream.schema("ts timestamp, kind string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{root}/events")
        return ingest.stream_alerts(stream, "kind", f"{root}/out", f"{root}/state")

    def stored():
        return sorted((r.debut, r.n, r.previous, r.level) for r in spark.read.parquet(f"{root}/out").collect())

    states = []
    for day, n in days.items():
        land(f"a{day:02d}", [(start + timedelta(days=day, minutes=i), "x") for i in range(n)])
        if day in (2, 6):
            states.append(run().state)
    early = stored()
    land("late", [(start + timedelta(days=1), "x")] * 50)
    states.append(run().state)
    late = run()
    assert late.late == 0  # nothing new
    everything = spark.createDataFrame([(start + timedelta(days=d, minutes=i), "x") for d, n in days.items() for i in range(n)], "ts timestamp, kind string")
    want = sorted((r.debut, r.n, r.previous, r.level) for r in ingest.batch_alerts(everything, "kind").collect())
    found = stored()
    assert set(early) <= set(found) and len(found) == len(set(found))
    assert found == want
    assert [(d - start).days for d, *_ in found] == [1, 2, 6, 11]
    assert [level for *_, level in found] == ["WARNING", "CRITICAL", "CRITICAL", "CRITICAL"]
    assert max(states) <= 8
