"""J13 for long lists: which texts contain which keys, without a pair that shares no characters.

Every position of a text gives a window of a few characters, and a match starts at one of them. Keys are looked up by the
hash of their first characters. Two bitmaps of such hashes, of bounded size, go with the plan: few windows begin like any
key, and of those few have a key's whole head. What passes meets the keys by an equality join and is compared with them. A
counted list of keys that is small is sent to every task. A longer one is dealt by hash, and a head that many windows have
is dealt to parts of bounded size, with its keys in each part.

A key longer than a window meets texts again. In a long list it goes by runs of q characters instead: it stands in a text
only where its rarest run does. The texts' runs are counted as far as some such key has them, each key picks its rarest, and
only texts that hold that run are looked through for it, dealt in parts as well.

The result has one row for each key and item; a null key or text has none, and an empty key stands in every text that is
not null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmlens.functions.exprs import row_count
from harmlens.workspace import cut_lineage, stored

PART = 100_000  # postings of a run, or windows with a head, that one task takes
SMALL = 100_000  # runs that every task may be sent, a few MB
KEYS = 500_000  # keys that every task may be sent, about 220 bytes each there,
KEY_CHARS = 16_000_000  # and their characters
HEADS = (1, 2, 3, 6, 9, 12)  # numbers of characters that windows are looked up by
BEGIN = 3  # characters that all but the shortest keys are told by first
WORDS = 1 << 20  # of 64 bits, in a bitmap at most; a fuller one only lets more windows pass
BLOCK = 1024  # words that are gathered by one task
INITIALS = 64  # first characters that a pattern lists
CHUNK = 4096  # characters of a text whose windows are formed at once
LIST = 64  # lists of candidate keys that a text with very many is given


def _runs(chars: str, q: int) -> Column:
    """Distinct runs of ``q`` characters, from a column of characters."""
    column = F.col(chars)
    begins = F.slice(column, F.lit(1), F.greatest(F.size(column) - (q - 1), F.lit(0)))
    return F.array_distinct(F.transform(begins, lambda c, i: F.concat(c, *[column[i + k] for k in range(1, q)])))


def _sized(df: DataFrame) -> DataFrame:
    """Sent to every task if it has few rows, and otherwise left to the optimizer; rows are short runs, counted from a stored table."""
    return F.broadcast(df) if df.count() <= SMALL else df


def _chars(text: str) -> Column:
    return F.when(F.col(text) == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))


def _head(column: str, n: int) -> Column:
    return F.xxhash64(F.substring(column, 1, n))


def _marks(h: Column) -> Column:
    """Two of 64 bits, told by a hash."""
    mark = lambda n: F.call_function("shiftleft", F.lit(1).cast("bigint"), n.bitwiseAND(63).cast("int"))
    return mark(h).bitwiseOR(mark(F.shiftrightunsigned(h, 40)))


def _passes(hashes: DataFrame) -> Callable[[Column], Column]:
    """A test for values that may be among the ``hashes``, of a column h: a bitmap with 32 bits for each, of which two are set."""
    words = min(WORDS, max(BLOCK, 1 << (hashes.count() // 2).bit_length()))
    word = lambda h: F.shiftrightunsigned(h, 6).bitwiseAND(words - 1).cast("int")
    in_order = lambda by: F.transform(F.array_sort(F.collect_list(F.struct(by, "bits"))), lambda x: x.bits)
    blank = hashes.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    filled = hashes.select(word(F.col("h")).alias("word"), _marks(F.col("h")).alias("bits"))
    rows = blank.unionByName(filled).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    blocks = rows.groupBy(F.floor(F.col("word") / BLOCK).alias("block")).agg(in_order("word").alias("bits"))
    bitmap = blocks.agg(F.flatten(in_order("block"))).scalar()
    return lambda h: F.get(bitmap, word(h)).bitwiseAND(_marks(h)) == _marks(h)


def _headed(keys: DataFrame, window: int) -> DataFrame:
    """Keys that are not empty, with the length n and the hash h of their heads."""
    length = F.coalesce(*[F.when(F.length("key") >= n, F.lit(n)) for n in reversed(HEADS) if n <= window])
    return keys.filter("key <> ''").withColumn("n", length).withColumn("h", F.xxhash64(F.expr("substring(key, 1, n)")))


def _windows(texts: DataFrame, headed: DataFrame, lengths: list[int], window: int) -> DataFrame:
    """Rows (item, w, h): windows, and hashes of their heads, that some key may start with; others are rare."""
    initials = [r.c for r in headed.select(F.substring("key", 1, 1).alias("c")).distinct().limit(INITIALS + 1).collect()]
    # one match at each code point: a position inside a surrogate pair is none
    first = "".join(rf"\x{{{ord(c):x}}}" for c in initials) if len(initials) <= INITIALS else r"\P{Cs}"
    chunk, pattern = rf"(?s)(?=(.{{1,{CHUNK + window - 1}}})).{{1,{CHUNK}}}", rf"(?s)(?=([{first}].{{0,{window - 1}}}))"
    chunks = texts.select("item", F.explode(F.regexp_extract_all("text", F.lit(chunk), F.lit(1))).alias("chunk"))
    windows = chunks.select("item", F.explode(F.regexp_extract_all("chunk", F.lit(pattern), F.lit(1))).alias("w"))
    begins = sorted({min(n, BEGIN) for n in lengths})
    begun, whole = _passes(headed.select(_head("key", BEGIN).alias("h")).distinct()), _passes(headed.select("h"))
    # hashes come from generators, so that each is formed once for both uses in its test
    likely = windows.select("item", "w", F.posexplode(F.array(*[_head("w", n) for n in begins])).alias("at", "begin")).filter(begun(F.col("begin")))
    heads = [F.when(F.col("at") == begins.index(min(n, BEGIN)), _head("w", n)) for n in lengths]
    return likely.select("item", "w", F.explode(F.array(*heads)).alias("h")).filter(whole(F.col("h")))


def _dealt(windows: DataFrame, headed: DataFrame, part: int) -> DataFrame:
    """Windows with the keys of their heads, for a list of keys too long to be sent; a head of many windows has several parts."""
    rows = stored(windows.distinct(), "windows")
    many = cut_lineage(rows.groupBy("h").agg(F.ceil(row_count() / part).cast("int").alias("parts")).filter("parts > 1"))
    parts = F.coalesce("parts", F.lit(1))
    parted = rows.join(_sized(many), "h", "left").select("item", "w", "h", F.pmod(F.xxhash64("item", "w"), parts).cast("int").alias("part"))
    asked = headed.join(_sized(many), "h", "left").select("key", "h", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    return parted.join(asked, ["h", "part"])


def _in_windows(texts: DataFrame, wanted: DataFrame, window: int, part: int, send: int) -> DataFrame:
    """Rows (key, item) by windows; up to ``send`` keys are sent to the texts."""
    headed = _headed(wanted, window)
    sizes = headed.groupBy("n").agg(row_count().alias("keys")).collect()
    lengths = sorted(r.n for r in sizes)
    found = texts.filter("false").select(F.lit("").alias("key"), "item")
    if lengths:
        windows = _windows(texts, headed, lengths, window)
        met = windows.join(F.broadcast(headed.select("key", "h")), "h") if sum(r["keys"] for r in sizes) <= send else _dealt(windows, headed, part)
        found = met.filter(F.col("w").startswith(F.substring("key", 1, window))).select("key", "item").distinct()
    if not wanted.filter(F.length("key") > window).isEmpty():
        found = cut_lineage(found)
        short = F.length("key") <= window
        lists = found.filter(~short).groupBy(F.col("item").alias("__item")).agg(F.collect_set("key").alias("keys"))  # no longer than the list of keys
        whole = texts.join(lists, F.col("item").eqNullSafe(F.col("__item"))).select("item", F.explode(F.filter("keys", lambda k: F.col("text").contains(k))).alias("key"))
        found = found.filter(short).unionByName(whole.distinct())
    empty = wanted.filter("key = ''")
    if not empty.isEmpty():
        found = found.unionByName(texts.select(F.lit("").alias("key"), "item").distinct())
    return found


def _by_runs(texts: DataFrame, wanted: DataFrame, q: int, part: int) -> DataFrame:
    """Rows (key, item) by runs; no key is shorter than ``q``."""
    long_runs = wanted.withColumn("chars", _chars("key")).select("key", F.explode(_runs("chars", q)).alias("run"))
    known = cut_lineage(long_runs.select("run").distinct())
    # two passes over the texts: runs are counted first, combined within each task; postings are made for the chosen ones only
    held = texts.withColumn("chars", _chars("text"))
    runs = held.select("item", F.xxhash64("text").alias("t"), F.explode(_runs("chars", q)).alias("run"))
    counts = cut_lineage(runs.select("run").join(_sized(known), "run").groupBy("run").agg(row_count().alias("texts")))
    rarest = cut_lineage(long_runs.join(counts, "run", "left").withColumn("texts", F.coalesce("texts", F.lit(0))).groupBy("key").agg(
        F.min(F.struct("texts", "run")).alias("least")).filter("least.texts > 0").select("key", "least.run", F.ceil(F.col("least.texts") / part).cast("int").alias("parts")))
    # each part of a run has all its keys and a share of its texts
    chosen = cut_lineage(rarest.groupBy("run").agg(F.max("parts").alias("parts")))
    parted = runs.join(_sized(chosen), "run").withColumn("part", F.pmod(F.xxhash64("item", "t"), F.col("parts")).cast("int"))
    asked = rarest.select("run", "key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    candidates = parted.select("run", "part", "item", "t").join(asked, ["run", "part"])
    lists = candidates.groupBy("item", "t", F.pmod(F.xxhash64("key"), F.lit(LIST)).alias("list")).agg(F.collect_set("key").alias("keys"))
    looked = texts.withColumn("t", F.xxhash64("text")).join(lists.withColumnRenamed("item", "__item").withColumnRenamed("t", "__t"), F.col("item").eqNullSafe(F.col("__item")) & (F.col("t") == F.col("__t")))
    return looked.select("item", F.explode(F.filter("keys", lambda k: F.col("text").contains(k))).alias("key")).select("key", "item").distinct()


def contained_keys(items: DataFrame, item: str, text: str, keys: DataFrame, key: str, q: int = 3, part: int = PART,
                   send: int = KEYS, window: int = 12) -> DataFrame:
    """Rows (key, item): every key, once, with every item one of whose texts contains it.

    Up to ``send`` counted keys, of ``KEY_CHARS`` characters at most, are sent to the texts; beyond that keys longer than a
    window go by runs.
    """
    wanted = cut_lineage(keys.select(F.col(key).alias("key")).filter("key is not null").distinct())
    texts = items.select(F.col(item).alias("item"), F.col(text).alias("text")).filter("text is not null")
    size = wanted.agg(row_count().alias("n"), F.sum(F.length("key")).alias("chars")).first()
    if size.n <= send and (size.chars or 0) <= KEY_CHARS:
        return _in_windows(texts, wanted, window, part, send)
    short, longer = wanted.filter(F.length("key") <= window), wanted.filter(F.length("key") > window)
    found = _in_windows(texts, short, window, part, send)
    return found if longer.isEmpty() else found.unionByName(_by_runs(texts, longer, min(q, window), part))
