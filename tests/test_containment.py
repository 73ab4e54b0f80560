"""Containment of long lists against a comparison of all pairs."""

import random

import pytest
from pyspark.sql import functions as F
from test_compiled import HUGE, longest_method

from harmlens.operators import containment
from harmlens.plans import REGISTRY


def lists(seed, n_texts=150, n_keys=200):
    r = random.Random(seed)
    word = lambda low, high: "".join(r.choice("abcé😀 ") for _ in range(r.randint(low, high)))
    texts = [(i, word(0, 60)) for i in range(n_texts)] + [(1, "abc again"), (None, "abc none"), (7, None), (8, ""), (9, "abcabcabc" * 50), (9, "abcabcabc" * 50)]
    keys = [word(0, 6) for _ in range(n_keys)] + ["abc", "abc", "", None, "a", "😀", "é😀", "abcabcabcabc", "zzz", "%", "a_c", "abc again and more"]
    return texts, keys


@pytest.mark.parametrize("q, part, send, window", [(3, 100_000, 0, 12), (2, 7, 0, 12), (4, 1, 0, 12), (1, 50, 0, 12), (5, 1, 1000, 12), (6, 1, 1000, 6), (7, 1, 1000, 9)])
def test_pairs_equal_a_comparison_of_all(spark, q, part, send, window):
    texts, keys = lists(q)
    found = containment.contained_keys(spark.createDataFrame(texts, "id int, body string"), "id", "body", spark.createDataFrame([(k,) for k in keys], "k string"), "k", q, part, send, window)
    got = [tuple(r) for r in found.collect()]
    want = {(k, i) for k in keys if k is not None for i, t in texts if t is not None and k in t}
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("send", [0, 1000])
def test_empty_lists(spark, send):
    texts, keys = spark.createDataFrame([(1, "abc")], "id int, body string"), spark.createDataFrame([("ab",)], "k string")
    assert containment.contained_keys(texts.limit(0), "id", "body", keys, "k", send=send).collect() == []
    assert containment.contained_keys(texts, "id", "body", keys.limit(0), "k", send=send).collect() == []


def test_no_product_of_texts_and_keys(spark, sf_dir):
    plan = REGISTRY["j13_long_lists"].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


@pytest.mark.parametrize("send, part", [(1000, 1), (0, 3)])
@pytest.mark.parametrize("bounds", [{"CHUNK": 5}, {"INITIALS": 2}, {"WORDS": 1, "BLOCK": 1}, {"CHUNK": 1, "INITIALS": 0, "WORDS": 4, "BLOCK": 2}])
def test_bounds_lose_nothing(spark, monkeypatch, bounds, send, part):
    for name, value in bounds.items():
        monkeypatch.setattr(containment, name, value)
    texts, keys = lists(8)
    found = containment.contained_keys(spark.createDataFrame(texts, "id int, body string"), "id", "body", spark.createDataFrame([(k,) for k in keys], "k string"), "k", 3, part, send)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == {(k, i) for k in keys if k is not None for i, t in texts if t is not None and k in t}


def test_few_windows_meet_keys(spark):
    r = random.Random(3)
    word = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    texts = [(i, word(10_000)) for i in range(20)]
    keys = [word(9) for _ in range(300)] + [t[700 * i:700 * i + 9] for i, t in texts[:10]]
    items, wanted = spark.createDataFrame(texts, "item int, text string"), spark.createDataFrame([(k,) for k in keys], "key string")
    assert containment._windows(items, containment._headed(wanted, 12), [9], 12).count() < 400  # of 200,000
    # a list that is not sent: no run of the texts is posted, and only windows that passed are dealt
    found = containment.contained_keys(items, "item", "text", wanted, "key", send=0)
    assert "array_distinct" not in found._jdf.queryExecution().analyzed().toString()
    assert {tuple(x) for x in found.collect()} == {(k, i) for k in keys for i, t in texts if k in t}


def test_a_head_of_many_windows_has_parts(spark):
    windows = spark.range(1000).select(F.col("id").alias("item"), F.lit("red door").alias("w"), F.xxhash64(F.lit("red")).alias("h"))
    keys = containment._headed(spark.createDataFrame([("red",), ("red d",), ("blue",)], "key string"), 12)
    dealt = containment._dealt(windows, keys, 100)
    assert dealt.count() == 2000 and dealt.groupBy("key", "part").count().agg(F.max("count")).first()[0] < 200


def test_windows_of_all_lengths_are_compiled(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        texts, keys = spark.createDataFrame([(1, "abc" * 10)], "id int, body string"), spark.createDataFrame([("abcabcabcabc"[:n],) for n in range(1, 13)], "k string")
        found = containment.contained_keys(texts, "id", "body", keys, "k")
        assert found.count() == 12 and longest_method(found) <= HUGE
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
