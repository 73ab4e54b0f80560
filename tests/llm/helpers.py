"""Small inputs shared by the tests of the training-text operators."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Null id, null, empty and blank texts, repeated rows, one very long text and text outside ASCII.
ODD_TEXTS = [
    (1, None), (2, ""), (3, " \n\t\v\f\r "), (4, "one"), (5, "one"), (5, "one"), (None, "no id here at all"), (None, None),
    (6, "é ü ñ 漢字 😀 \n\n x \n x \n"), (7, "word " * 40_000), (8, "a" * 50_000), (9, "    nbsp"), (10, "nul\x00byte"),
]


def documents(spark, rows):
    """Documents with all their columns; the number of characters is left null."""
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], SCHEMA)


def clashing(df):
    """The same rows with further columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    names = ("score", "kept", "id", "key", "rep", "component_id", "n_words", "spans", "blob", "ids", "shard", "g", "a", "b", "x", "label")
    return df.withColumns({c: F.lit(7) for c in names if c not in df.columns})


def prose(seed, words):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(words))


def edited(text, seed, edits):
    r = random.Random(seed)
    words = text.split(" ")
    for _ in range(edits):
        words[r.randrange(len(words))] = prose(r.random(), 1)
    return " ".join(words)


def union_find(links, nodes):
    """Smallest reachable id by id."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
