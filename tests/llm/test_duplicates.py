"""Near-duplicate operators and the pipeline against brute force."""

import dataclasses
import random
import re
import resource

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from harmlens.llm import compression_quality, near_duplicates, packing, secret_ledger, target_ratio, vector_duplicates
from harmlens.llm import queries as q
from harmlens.llm.links import components
from harmlens.llm.super_minhash import signatures

from .helpers import ODD_TEXTS, SCHEMA, clashing, documents, edited, prose, union_find

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, k):
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def components_of(rows, k=4):
    """Smallest reachable id by id, from all pairs."""
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, union_find(links, ids)


def corpus():
    """Exact copies, families of edits around the threshold, chains, shared passages, and unrelated texts."""
    rows, r = [], random.Random(3)
    for f in range(6):
        base = prose(f, 120)
        rows += [edited(base, 100 * f + k, r.randint(0, 9)) for k in range(25)] + [base] * 5
    text = prose(50, 90)
    for k in range(12):
        rows.append(text)
        text = edited(text, 900 + k, 2)
    passage = prose(60, 60)
    rows += [prose(1000 + k, 60) + " " + passage for k in range(30)]
    rows += [prose(2000 + k, r.randint(1, 6)) for k in range(40)] + ["a b c d e f g", "A B C d e f g", "a  b\tc d\ne f g"]
    return list(enumerate(rows, 1))


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(0)
    for n in (5, 60, 800):
        for j in (0.3, 0.8):
            both = round(2 * n * j / (1 + j))
            found = []
            for _ in range(30):
                x = rng.integers(0, 2**63, 2 * n - both).astype(np.uint64)
                s = signatures(np.concatenate([x[:n], x[n - both :]]), np.repeat([0, 1], n), 2, 252)
                found.append((s[0] == s[1]).mean() - both / (2 * n - both))
            assert abs(np.mean(found)) < 0.02 and np.std(found) < 1.2 * np.sqrt(j * (1 - j) / 252)


def test_super_minhash_of_small_sets_uses_every_rank():
    assert (signatures(np.zeros(0, np.uint64), np.zeros(0, np.int64), 2, 16) == 0xFFFFFFFF).all()
    one = signatures(np.array([5], np.uint64), np.array([0]), 1, 252)
    assert sorted((one[0] >> 24).tolist()) == list(range(252))  # each slot a rank of its own


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(k, k + 1) for k in range(1, 60)] + [(200, 100), (100, 100), (100, 150), (300, 301), (301, 300)]
    got = {r.id: r.component for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{k: 1 for k in range(1, 61)}, 200: 100, 100: 100, 150: 100, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_keep_the_estimate_of_their_size_short(spark):
    ids = random.Random(3).sample(range(10**6), 300)  # a chain that takes many rounds of joins
    found = components(spark.createDataFrame(list(zip(ids, ids[1:])), "a bigint, b bigint"))
    assert found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 2**63
    assert {(r.id, r.component) for r in found.collect()} == {(k, min(ids)) for k in ids}


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus()
    sets, expected = components_of(rows)
    got = near_duplicates.grouped(clashing(documents(spark, rows)), near_duplicates.Settings(words=4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        i: (len(sets[i]), expected[i], expected[i] == i) for i in sets}
    assert len(set(expected.values())) < len(rows) - 80  # the corpus has groups


def test_near_duplicates_of_given_documents(spark, sf_dir):
    docs = q.texts(spark, sf_dir)
    sets, expected = components_of([(r.doc_id, r.text) for r in docs.collect()])
    got = q.op8(spark, sf_dir).collect()
    assert {r.doc_id: r.component_id for r in got} == expected and all(r.n_shingles == len(sets[r.doc_id]) for r in got)


def test_near_duplicates_of_odd_rows(spark):
    docs = clashing(documents(spark, ODD_TEXTS))
    rows = near_duplicates.grouped(docs).collect()
    assert len(rows) == len(ODD_TEXTS)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by_id[1] == by_id[2] == [(0, by_id[1][0][1], True)] or (by_id[1], by_id[2]) == ([(0, 1, True)], [(0, 2, True)])
    assert by_id[4] == [(1, 4, True)] and by_id[5] == [(1, 4, False)] * 2  # "one" twice more
    assert sorted(by_id[None], key=str) == [(0, None, True), (1, None, True)]
    kept = near_duplicates.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(ODD_TEXTS) - 2
    assert near_duplicates.grouped(docs.filter("false")).count() == 0


# -- vectors -----------------------------------------------------------------------------------------

def cosine_components(rows, threshold=0.93):
    good = {}
    for i, label, v in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = (label, np.array(v, dtype=np.float64))
    links, count, ids = [], dict.fromkeys([r[0] for r in rows], 0), sorted(good)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            (la, x), (lb, y) = good[a], good[b]
            if la == lb and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                links.append((a, b))
                count[a], count[b] = count[a] + 1, count[b] + 1
    return count, union_find(links, [r[0] for r in rows])


@pytest.mark.parametrize("tile", [7, 64])
def test_vectors_equal_brute_force(spark, tile):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        for _ in range(15):
            rows.append((centre + rng.normal(size=16) * rng.choice([0.02, 0.2, 0.35])) * rng.choice([1e-30, 1, 1e6]))
    rows = [(i, i % 3, [float(x) for x in np.float32(v)]) for i, v in enumerate(rows)]
    rows += [(500, 1, None), (501, 1, []), (502, 1, [0.0] * 16), (503, None, [1.0] * 16), (504, 1, [float("nan")] * 16),
             (505, 1, [1.0] * 15 + [None]), (506, 1, [float("inf")] * 16), (507, 1, [1.0, 1.0]), (508, 1, [2.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    count, component = cosine_components(rows)
    got = vector_duplicates.grouped(clashing(df), dataclasses.replace(vector_duplicates.Settings(), tile=tile, pivots=9)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (count[i], component[i], component[i] == i) for i in count}
    assert sum(count.values()) > 100


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(5)
    u, v = vector_duplicates.unit(rng.normal(size=(300, 24))), vector_duplicates.unit(rng.normal(size=(300, 24)))
    (qa, sa, ea), (qb, sb, eb) = vector_duplicates.quantised(u), vector_duplicates.quantised(v)
    error = np.abs(u @ v.T - (qa * sa[:, None]) @ (qb * sb[:, None]).T)
    assert (error <= ea[:, None] * (1 + eb) + (1 + ea)[:, None] * eb).all()


def test_repeated_and_missing_vectors(spark):
    rows = [(1, 0, [1.0, 0.0]), (1, 0, [1.0, 0.0]), (None, 0, [1.0, 0.0]), (2, 0, [1.0, 0.01]), (3, 0, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in vector_duplicates.grouped(df).collect()))
    assert got == [(0, 0, 0, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    assert vector_duplicates.grouped(df.filter("false")).count() == 0


# -- pipeline ----------------------------------------------------------------------------------------

def test_pipeline_stages_equal_brute_force(spark, tmp_path):
    path = "/root/testdata/sf0.001"
    docs, labels = q.table(spark, path, "documents"), q.table(spark, path, "labels")
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality classifier", "quality rules", "near duplicates", "secrets", "packing"]

    def run(name, given):
        out = stage[name](spark, given, path)
        assert name == "packing" or out.columns == columns
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    rows = {r.doc_id: r for r in docs.collect()}
    classified = run("quality classifier", docs)
    model = compression_quality.fit(docs, labels)
    good = {r.doc_id for r in compression_quality.scored(docs, model).collect() if r[compression_quality.SCORE] >= 0.7}
    assert {r.doc_id: r for r in classified.collect()} == {i: rows[i] for i in good} and 0 < len(good) < len(rows)

    ruled = run("quality rules", classified)
    judged = target_ratio.judged(classified, target_ratio.fit(classified, labels)).collect()
    assert {r.doc_id for r in ruled.collect()} == {r.doc_id for r in judged if r["__kept"]}

    single = run("near duplicates", ruled)
    _, component = components_of([(r.doc_id, r.text) for r in ruled.collect()], k=5)
    assert {r.doc_id for r in single.collect()} == {i for i, c in component.items() if i == c}

    clean = run("secrets", single)
    before = {r.doc_id: r for r in single.collect()}
    after = {r.doc_id: r for r in clean.collect()}
    assert before.keys() == after.keys()
    hits = {r.doc_id for r in secret_ledger.joined(single, secret_ledger.findings(secret_ledger.ledger_rows(secret_ledger.scan(single)))).collect() if r["__spans"]}
    for i, r in after.items():
        assert (r == before[i]) == (i not in hits)
        assert i not in hits or ("[SECRET]" in r.text and r.n_chars == len(r.text))

    packed = run("packing", clean)
    assert {r.doc_id for r in packed.collect()} == after.keys()
    whole = corpus_pipeline.run(spark, path)
    pieces = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert sum(n for _, _, n, _ in pieces(whole)) == sum(n for _, _, n, _ in pieces(packed))


def test_pipeline_on_odd_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for rows in (ODD_TEXTS, []):
        docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.count() <= max(200, 50 * len(rows))
            if name != "packing":
                assert out.columns == docs.columns
                docs = docs if not out.count() else out


def test_secrets_keep_all_rows(spark):
    docs = documents(spark, [(1, "password = hunter2222"), (1, "password = hunter2222"), (None, "token: abcdefgh1"), (2, None)])
    out = corpus_pipeline.redact(spark, docs, "").collect()
    assert sorted(str(r.text) for r in out) == ["None", "[SECRET]", "[SECRET]", "[SECRET]"]
    assert packing.packed(docs).agg(F.sum("length")).first()[0] > 4


def test_repeated_rows_leave_one(spark):
    a, b = prose(1, 40), prose(2, 40)
    rows = [(7, a), (7, a), (9, a), (3, b), (3, b), (3, prose(5, 40)), (None, a), (None, a), (8, None), (8, None)]
    kept = near_duplicates.deduplicated(clashing(documents(spark, rows)))
    assert sorted((r.doc_id or 0, r.text in (a, None) or r.doc_id == 3) for r in kept.collect()) == [(0, True), (0, True), (3, True), (7, True), (8, True)]
    again = near_duplicates.deduplicated(clashing(documents(spark, rows[::-1])))
    assert sorted(map(str, kept.collect())) == sorted(map(str, again.collect()))
    assert kept.columns == clashing(documents(spark, [])).columns


def test_large_families_of_short_texts_stay_in_bounded_tiles(spark):
    """20 000 sets of five shingles that all hold one shingle: tiles of about a thousand documents, whatever their shingles."""
    ids = np.arange(20_000)
    sets = spark.createDataFrame([(int(i), sorted([1, *(int(i) * 10 + k for k in range(2, 6))])) for i in ids], "id bigint, hashes array<bigint>")
    rest = spark.createDataFrame([(0, int(i), 5) for i in ids], "key bigint, id bigint, n bigint")
    assert near_duplicates._tile_links(rest, sets, near_duplicates.Settings()).collect() == []  # each pair shares one of nine shingles
    used = resource.getrusage(resource.RUSAGE_CHILDREN).ru_maxrss / 1024
    assert used < 2048


def test_vectors_of_double_precision_keep_their_digits(spark):
    base = np.array([1.0, 0.0, 0.0])
    at = lambda cosine: [cosine, float(np.sqrt(1 - cosine * cosine)), 0.0]
    rows = [(1, 1, base.tolist()), (2, 1, at(0.93 + 1e-12)), (3, 2, base.tolist()), (4, 2, at(0.93 - 1e-12)), (5, 3, [1e200, 0.0, 0.0]), (6, 3, [2e200, 1e180, 0.0])]
    found = {r.vec_id: (r.n_links, r.component_id) for r in vector_duplicates.grouped(spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")).collect()}
    assert found == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4), 5: (1, 5), 6: (1, 5)}
