"""Periodic runs, ranked search and repeated lines against brute force."""

import dataclasses
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from harmlens.llm import hashed_index, lexical_search, line_dedup, periodic_runs
from harmlens.llm import queries as q
from harmlens.llm.square_catchers import SquareCatchers

from .helpers import ODD_TEXTS, clashing, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
lower = lambda text: re.sub("[A-Z]", lambda m: m[0].lower(), text)


def written(spark, path, **tables):
    for name, df in tables.items():
        df.coalesce(2).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def twin(path, sql, *tables):
    con = duckdb.connect()
    for name in tables:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet/*.parquet')")
    return con.execute(sql).fetchall()


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=str)


# --- periodic runs


def runs_by_definition(words, shortest=12):
    """Every period's maximal stretches; of one stretch the smallest period."""
    found, n = {}, len(words)
    for period in range(1, n // 2 + 1):
        at = 0
        while at + period < n:
            end = at
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end - at + period
            if end > at and length >= max(shortest, 2 * period):
                found.setdefault((at, length), period)
            at = end + 1
    return sorted((start, length, period) for (start, length), period in found.items())


def caught(words, cuts):
    codes = np.array([hash(w) for w in words], dtype=np.int64).view(np.uint64)
    catchers = SquareCatchers()
    for part in np.split(codes, cuts):
        catchers.append(part)
    return sorted(zip(*(p.tolist() for p in catchers.runs())), key=lambda r: (r[0], r[2]))


PERIODIC = st.builds(
    lambda head, part, times, cut, tail: (head + part * times)[: len(head) + max(0, len(part) * times - cut)] + tail,
    st.lists(st.integers(0, 3), max_size=30), st.lists(st.integers(0, 3), min_size=1, max_size=25), st.integers(0, 9), st.integers(0, 5),
    st.lists(st.integers(0, 3), max_size=30),
)


@settings(max_examples=300, deadline=None)
@given(PERIODIC, st.lists(st.integers(0, 200), max_size=12))
def test_catchers_find_all_runs_however_words_arrive(words, cuts):
    want = sorted(runs_by_definition(words), key=lambda r: (r[0], r[2]))
    assert caught(words, []) == want
    assert caught(words, sorted(c for c in cuts if c <= len(words))) == want


def test_catchers_word_by_word():
    words = [0, 1] * 9 + [2] + [0, 0, 1] * 8 + list(range(40)) * 3 + [7] * 5
    assert caught(words, list(range(1, len(words)))) == sorted(runs_by_definition(words), key=lambda r: (r[0], r[2]))


@settings(max_examples=100, deadline=None)
@given(st.lists(PERIODIC, max_size=6))
def test_runs_of_many_texts_do_not_mix(texts):
    row, *parts = periodic_runs.runs_of([[b"%d" % w for w in t] for t in texts])
    got = list(zip(row.tolist(), *(p.tolist() for p in parts)))
    assert got == [(i, *r) for i, t in enumerate(texts) for r in sorted(runs_by_definition(t), key=lambda r: (r[0], r[2]))]


def test_hashes_are_not_fooled_by_doubling_words():
    """Words whose polynomial hashes modulo a power of two collide."""
    words = [0]
    while len(words) < 4096:
        words += [1 - w for w in words]
    assert all(words[s + k] == words[s + k + p] for s, n, p in caught(words, []) for k in range(n - p))
    assert max(n for _, n, _ in caught(words, [])) == 2 * max(p for _, _, p in caught(words, []))


def test_long_periodic_texts_take_little():
    row, start, length, period = periodic_runs.runs_of([[b"word"] * 300_000, [b"a", b"b", b"c"] * 100_000])
    assert list(zip(row, start, length, period)) == [(0, 0, 300_000, 1), (1, 0, 300_000, 3)]


def expected_runs(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(runs_by_definition(words), key=lambda r: (r[0], r[2])) if len(set(words)) > 1 else [(0, n, 1)] if n >= 12 else []
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(kept))


def test_runs_query_equals_definition(spark, tmp_path):
    r = random.Random(4)
    rows = [*ODD_TEXTS, (11, "a\tb  c\n" * 30 + "d"), (12, " ".join(prose(s, 4) * 3 + " x" for s in range(20)))]
    for i in range(20, 160):  # ten of them get a repeated tail
        rows.append((i, " ".join(r.choice("ab cd ef gh ij kl".split()) for _ in range(r.randint(0, 90))).replace(" ", r.choice([" ", "\n", "  "]))))
    path = written(spark, tmp_path, documents=clashing(documents(spark, rows)))
    found = q.op11(spark, path)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert in_order(found.collect()) == in_order(expected_runs(*row) for row in rows)


def test_runs_of_an_empty_table_and_of_clashing_columns(spark):
    assert periodic_runs.with_runs(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.with_runs(periodic_runs.with_runs(documents(spark, [])))


# --- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def expected_ranks(rows, items, best=10):
    held = [(i, Counter(TERM.findall(lower(t or "")))) for i, t in rows]
    held = [(i, tf) for i, tf in held if tf]
    n, length = len(held), sum(sum(tf.values()) for _, tf in held)
    df = Counter(t for _, tf in held for t in tf)
    out = []
    for item_id, text in items:
        asked, scores = Counter(TERM.findall(lower(text or ""))), []
        for doc_id, tf in held:
            m = 100 - 75 + 75 * sum(tf.values()) * n // length
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m))
                        for t, times in asked.items() if t in tf)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (minus, no_id, doc_id) in enumerate(sorted(scores)[:best], 1):
            out.append((item_id, rank, None if no_id else doc_id, -minus))
    return out


def search_rows():
    r = random.Random(8)
    words = "the of and a in to with by for is été 漢字 x1 2 zebra quagga".split()
    texts = [" ".join(r.choices(words, weights=[60 / (k + 1) for k in range(len(words))], k=r.randint(1, 60))) for _ in range(400)]
    texts += [texts[0]] * 15 + [texts[1].upper()] * 15  # ties
    rows = [*ODD_TEXTS, *enumerate(texts, 100)]
    items = [(1, "The ZEBRA, the quagga"), (2, None), (3, ""), (4, "!?"), (5, "of"), (6, "été-漢字 ÉTÉ"), (7, "nowhere found"), (7, "x1 2 x1 2 x1"),
             (None, "word a"), (8, " ".join(words * 3) + " " + " ".join(f"w{k}" for k in range(200))), (9, texts[0]), (10, "a" * 50_000)]
    return rows, items


BENCHMARK = "item_id bigint, text string"


@pytest.mark.parametrize("change", [{}, {"block_documents": 7}, {"items": 2, "best": 3}, {"terms": 4, "cells": 64}])
def test_search_equals_definition(spark, change):
    rows, items = search_rows()
    use = dataclasses.replace(lexical_search.Settings(), **change)
    found = lexical_search.ranked(clashing(documents(spark, rows)).repartition(3), spark.createDataFrame(items, BENCHMARK), use)
    assert in_order(found.collect()) == in_order(expected_ranks(rows, items, use.best))


def test_search_query_and_twin_on_odd_rows(spark, tmp_path):
    rows, items = search_rows()
    path = written(spark, tmp_path, documents=documents(spark, rows), benchmark=spark.createDataFrame(items, BENCHMARK))
    want = in_order(expected_ranks(rows, items))
    assert in_order(q.op12(spark, path).collect()) == want
    assert in_order(twin(path, q.SQL["op12_lexical_search"], "documents", "benchmark")) == want


def test_search_stops_before_all_masks():
    """Documents that can't reach the last place are not scored."""
    found = [(i, 50, {0: 1, 1: 20} if i < 20 else {0: 1, 2 + i % 30: 1}) for i in range(2000)]
    block = lexical_search.Block(found, 40, 2000, 100_000)
    scored, scores = [], block.scores
    block.scores = lambda documents, weight_of: scored.extend(documents) or scores(documents, weight_of)
    weights = np.array([1, 900, *[5] * 30], dtype=np.int64)
    best = lexical_search.improve([], block, np.arange(32), weights, np.zeros(40, np.int64), lexical_search.Settings())
    assert [i for _, _, i in best] == list(range(10)) and len(scored) < 1100


def test_search_without_documents_or_items(spark):
    none, items = documents(spark, []), spark.createDataFrame([(1, "a")], BENCHMARK)
    assert lexical_search.ranked(none, items).collect() == []
    assert lexical_search.ranked(documents(spark, [(1, "a"), (2, None)]), items.limit(0)).collect() == []
    assert lexical_search.ranked(documents(spark, [(1, "-"), (2, None)]), items).collect() == []
    with pytest.raises(TypeError):
        lexical_search.ranked(none.selectExpr("string(doc_id) doc_id", "text"), items)


# --- repeated lines


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**128 - 1), max_size=400, unique=True), st.lists(st.integers(0, 2**128 - 1), max_size=40))
def test_perfect_hash_is_minimal_and_knows_its_keys(keys, others):
    halves = lambda values: [np.array([v >> s & (2**64 - 1) for v in values], dtype=np.uint64) for s in (64, 0)]
    carried = np.arange(len(keys), dtype="i8")
    index = hashed_index.Index.read(hashed_index.build(*halves(keys), carried).written(), ["i8"])
    places = index.places(*halves(keys))
    assert sorted(places.tolist()) == list(range(len(keys))) and len(index) == len(keys)
    assert index.carried[0][places].tolist() == list(range(len(keys)))
    assert [v for v, p in zip(others, index.places(*halves(others))) if p >= 0] == [v for v in others if v in set(keys)]


def test_perfect_hash_is_compact():
    r = np.random.default_rng(0)
    first, second = r.integers(0, 2**63, 100_000).astype(np.uint64), r.integers(0, 2**63, 100_000).astype(np.uint64)
    index = hashed_index.build(first, second)
    assert len(index.bits) * 8 < 4.5 * len(first)
    assert (np.sort(index.places(first, second)) == np.arange(len(first))).all()


def expected_lines(rows, characters=40, least=5):
    strip = " \t\n\v\f\r"
    cut = [(i, (t or "").split("\n")) for i, t in rows]
    holders = defaultdict(set)
    for at, (_, lines) in enumerate(cut):
        for line in lines:
            if len(line.strip(strip)) >= characters:
                holders[lower(line.strip(strip))].add(at)
    largest = {k: max((cut[at][0] for at in v if cut[at][0] is not None), default=None) for k, v in holders.items() if len(v) >= least}
    out = []
    for i, lines in cut:
        kept = [x for x in lines if i is None or (k := lower(x.strip(strip))) not in largest or largest[k] == i]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def line_rows():
    r = random.Random(5)
    shared = ["A line that many documents hold, license and all %d" % k for k in range(8)] + ["é" * 39, "é" * 40, "漢字😀" * 14, "x" * 39, "Y" * 40, " " * 60]
    pad = ["", " ", "\t", " \r", "\v\f"]
    rows = list(ODD_TEXTS)
    for i in range(100, 300):
        lines = [r.choice(pad) + r.choice([str.upper, str.lower, str])(r.choice(shared)) + r.choice(pad) for _ in range(r.randint(0, 4))]
        lines += [prose(i * 10 + k, 12) for k in range(r.randint(0, 3))]
        r.shuffle(lines)
        rows.append((i, "\n".join([*lines, shared[0]] if i % 3 == 0 else lines)))
    rows += [(350, shared[0]), (350, shared[0] + "\n" + shared[1]), (None, shared[0]), (-5, shared[2] + "\n\n" + shared[2])]
    rows += [(400 + k, "held by four documents, which is one too few to drop it") for k in range(4)]
    return rows + [(500 + k, "held by five documents, which is enough to drop it from four") for k in range(5)]


@pytest.mark.parametrize("change", [{}, {"head": 1, "shard_lines": 20}, {"head": 20, "shard_lines": 3}, {"characters": 45, "documents": 2, "head": 3}])
def test_lines_equal_definition(spark, change):
    rows = line_rows()
    use = dataclasses.replace(line_dedup.Settings(), **change)
    found = line_dedup.deduplicated(clashing(documents(spark, rows)).repartition(3), use)
    got = [(r.doc_id, r["__n_lines"], r["__n_dropped"], sha(r["__kept_text"])) for r in found.collect()]
    assert in_order(got) == in_order(expected_lines(rows, use.characters, use.documents))


def test_lines_query_and_twin_on_odd_rows(spark, tmp_path):
    rows = line_rows()
    path = written(spark, tmp_path, documents=documents(spark, rows))
    want = in_order(expected_lines(rows))
    assert in_order(q.op13(spark, path).collect()) == want
    assert in_order(twin(path, q.SQL["op13_line_dedup"], "documents")) == want


def test_lines_of_an_empty_table_and_of_clashing_columns(spark):
    assert line_dedup.deduplicated(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        line_dedup.deduplicated(line_dedup.deduplicated(documents(spark, [])))
    with pytest.raises(TypeError):
        line_dedup.deduplicated(documents(spark, []).selectExpr("string(doc_id) doc_id", "text"))


def test_a_line_of_most_documents_is_not_sent_to_a_shard(spark):
    rows = [(i, "the same line in each of these documents, without end\n" + prose(i, 12)) for i in range(400)]
    use = line_dedup.Settings(head=8, shard_lines=50)
    held = line_dedup.digests(documents(spark, rows), use)
    lines = line_dedup.counted(held)
    top = lines.filter("n > 100").collect()
    head = line_dedup._built({c: np.array([r[c] for r in top], dtype=np.int64) for c in ("first", "second", "n", "largest")}).written()
    asked = line_dedup.probes(held, head, 16).collect()
    assert len(top) == 1 and sum(len(r.ids) for r in asked) == 400 and len({r.shard for r in asked}) == 16
    found = line_dedup.deduplicated(documents(spark, rows), use).collect()
    assert sum(r["__n_dropped"] for r in found) == 399
