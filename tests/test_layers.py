"""Sinks write compact files that many tasks can read."""

import zlib
from datetime import date

from harmlens import workspace
from harmlens.operators import harmonize as har
from harmlens.plans import REGISTRY, q_storage
from harmlens.plans.tables import tables_for
from harmlens.sources import layers


def files(folder, suffix):
    return [p for p in folder.rglob("part-*") if p.name.endswith(suffix)]


def test_json_lines_are_compressed_in_bounded_files(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(layers, "FILE_RECORDS", 500)
    unified = har.transform_osha(tables_for(spark, sf_dir).osha_records, date(2024, 1, 1))
    rows = layers.save_json(unified, str(tmp_path / "json"))
    packed = files(tmp_path / "json", ".json.gz")
    assert len(packed) >= rows / 500 and not files(tmp_path / "json", ".json")
    kept = unified.drop("_source_record")
    stored = spark.read.schema(kept.schema).json(str(tmp_path / "json"))
    assert stored.count() == rows and stored.exceptAll(kept).isEmpty() and kept.exceptAll(stored).isEmpty()
    kept.write.json(str(tmp_path / "plain"))
    assert sum(p.stat().st_size for p in packed) * 5 < sum(p.stat().st_size for p in files(tmp_path / "plain", ".json"))


def test_integration_stores_compact_files(spark, sf_dir, tmp_path):
    layers.integrate(tables_for(spark, sf_dir).osha_records, str(tmp_path), date(2024, 1, 1), ["all"], har.SCHEMA)
    for folder in ("attempted", "graph/nodes", "graph/edges", "table"):
        stored = list((tmp_path / folder).glob("part-*"))
        assert stored and all(p.name.endswith(".zstd.parquet") for p in stored)


def test_integration_spends_little_time_on_codecs(spark, sf_dir, tmp_path):
    layers.integrate(tables_for(spark, sf_dir).osha_records, str(tmp_path), date(2024, 1, 1), ["json"])
    for p in files(tmp_path / "json", ".json.gz"):
        packed = p.read_bytes()
        text = zlib.decompress(packed, 31)
        assert abs(len(packed) - len(zlib.compress(text, 3))) < abs(len(packed) - len(zlib.compress(text, 6)))


def test_record_files_come_from_one_count(spark, sf_dir, monkeypatch):
    cuts, cut = [], workspace.cut_lineage
    monkeypatch.setattr(q_storage, "cut_lineage", lambda df: cuts.append(df) or cut(df), raising=False)
    assert REGISTRY["s07_read_records"].run(spark, sf_dir).count() == 24
    assert len(cuts) == 1
