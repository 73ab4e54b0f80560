"""Near-duplicate documents: SuperMinHash, banding, verification on full shingle sets, union-find.

Texts with equal shingle sets are collapsed first, so that copies cost one row each. Band keys of the
remaining sets give candidates. Verification is in two steps. Each document is compared with one leader of
its buckets, the one with which it shares most bands; that settles most of a group in one comparison a document.
Then only documents that share a bucket but not yet a component are compared, and of those only the ones that
still can have a link: a document that has fewer shingles in common with other components than any link asks
for drops out. The rest is compared tile by tile. Both steps count the exact intersection of full sets, and
neither sends more than one row a document and tile.

A text without words, null included, has an empty set: it links with nothing and is kept. Rows with a null
id are not linked and are kept; rows that share an id are one node. Extra columns are ignored. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmlens.llm.batches import U64, Texts, mix, slices, take_arrays, texts_of
from harmlens.llm.links import components, least_reached
from harmlens.llm.super_minhash import band_keys, signatures
from harmlens.workspace import cut_lineage


@dataclass(frozen=True)
class Settings:
    words: int = 5
    percent: int = 80  # least similarity of linked sets
    bands: int = 42
    rows: int = 6
    tile_shingles: int = 60_000  # size of the tiles that are compared as a whole
    tile_documents: int = 1024


def shingle_sets(held: Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their row, by row and hash. A shorter text is one shingle."""
    start, stop, row = held.words()
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = held.span_hashes(held.prefix_sums(True), start, stop)
    counts = np.bincount(row, minlength=len(held))
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    left = counts[row] - (np.arange(len(row)) - first[row])  # words from here to the row's end
    takes = (left >= words) | ((counts[row] < words) & (left == counts[row]))
    at = np.flatnonzero(takes)
    code = np.zeros(len(at), dtype=np.uint64)
    length = np.minimum(words, counts[row[at]])
    for k in range(words):
        use = length > k
        code[use] = mix(code[use] * U64(0x9E3779B97F4A7C15) + word[at[use] + k] + U64(k + 1))
    order = np.lexsort((code, row[at]))
    code, row = code[order], row[at][order]
    fresh = np.concatenate([[True], (code[1:] != code[:-1]) | (row[1:] != row[:-1])])
    return code[fresh], row[fresh]


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                held = texts_of(batch.column(1).slice(lo, hi - lo))
                code, row = shingle_sets(held, settings.words)
                n = np.bincount(row, minlength=len(held))
                digests = []
                for salt in (1, 2):
                    total = np.zeros(len(held), dtype=np.uint64)
                    np.add.at(total, row, mix(code + U64(salt * 0x2545F4914F6CDD1D)))
                    digests.append(pa.array(total.view(np.int64)))
                keys = band_keys(signatures(code, row, len(held), settings.bands * settings.rows), settings.rows).view(np.int64)
                ends = np.concatenate([[0], np.cumsum(np.where(n > 0, settings.bands, 0))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), *digests, take_arrays(keys[n > 0].reshape(-1), ends, pa.int64())],
                    names=["doc_id", "n_shingles", "d1", "d2", "keys"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, keys array<bigint>")


def full_sets(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """Sorted shingle hashes of the documents in ``wanted`` (id and further columns)."""
    extra = [c for c in wanted.columns if c != "id"]
    # the ids' side is built into hash tables: texts are moved once, neither sorted nor spilled
    chosen = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("t")).join(wanted.hint("shuffle_hash"), "id").select("t", "id", *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                part = batch.slice(lo, hi - lo)
                held = texts_of(part.column(0))
                code, row = shingle_sets(held, settings.words)
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(held)))])
                yield pa.RecordBatch.from_arrays([*part.columns[1:], take_arrays(code.view(np.int64), ends, pa.int64())], names=["id", *extra, "hashes"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema.fields[1:])
    return chosen.mapInArrow(run, f"{types}, hashes array<bigint>")


def _linked(percent: int) -> str:
    """100 * intersection >= percent * union, with n + m = intersection + union."""
    common = "size(array_intersect(x, y))"
    return f"(100 + {percent}) * {common} >= {percent} * (size(x) + size(y))"


def verified_links(docs: DataFrame, buckets: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) that connect exactly the documents of ``buckets`` (key, id, n) that chains of links connect."""
    # step 1: each document against the leader with which it shares most buckets; a bucket's leader is the member
    # that meets most others in all its buckets, so it lies in the middle of its group
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    meets = buckets.join(sizes, "key").groupBy("id").agg(F.sum("size").alias("meets"))
    ranked = buckets.select("key", "id").join(meets, "id")
    heads = ranked.groupBy("key").agg(F.max(F.struct("meets", (-F.col("id")).alias("minus"))).alias("m")).select("key", (-F.col("m.minus")).alias("leader"))
    shared = buckets.join(heads, "key").groupBy("id", "leader").agg(F.count(F.lit(1)).alias("times"))
    best = shared.filter("id != leader").groupBy("id").agg(F.max(F.struct("times", (-F.col("leader")).alias("minus"))).alias("m"))
    lead = buckets.select("id").distinct().join(best.select("id", (-F.col("m.minus")).alias("leader")), "id", "left")
    leads = lead.select(F.col("leader").alias("id")).filter("id is not null").distinct().withColumn("leads", F.lit(True))
    wanted = lead.join(leads, "id", "left").withColumn("leads", F.coalesce("leads", F.lit(False)))
    sets = cut_lineage(full_sets(docs, wanted, settings))
    led = sets.filter("leader is not null").select(F.col("id").alias("b"), F.col("leader").alias("a"), F.col("hashes").alias("x"))
    leading = sets.filter("leads").select(F.col("id").alias("a"), F.col("hashes").alias("y"))
    tested = cut_lineage(led.join(leading, "a").select("a", "b", F.expr(_linked(settings.percent)).alias("ok")))
    links = tested.filter("ok").select("a", "b")
    # step 2: pairs within buckets across components
    group = components(links)
    placed = buckets.join(group, "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("c"))
    mixed = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("n").alias("least")).filter("lo != hi")
    rest = cut_lineage(placed.join(mixed.select("key", "least"), "key"))
    able = _able(rest, sets, settings)
    return links.unionByName(_tile_links(rest.join(able, "id"), sets, settings))


def _tile_links(rest: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links (id, smallest id reached) among documents that share buckets, from tile products of full sets.

    Documents chained by buckets form a family, dealt to tiles of bounded size; each pair of a family's tiles is
    compared in one task, which sends a row for each linked document and never pairs.
    """
    heads = rest.groupBy("key").agg(F.min("id").alias("a"))
    family = components(rest.join(heads, "key").select("a", F.col("id").alias("b")))
    members = sets.join(family, "id").select("id", "hashes", F.col("component").alias("family"))
    tiles = F.ceil(F.greatest(F.sum(F.size("hashes")) / settings.tile_shingles, F.count(F.lit(1)) / settings.tile_documents))
    weight = members.groupBy("family").agg(tiles.alias("tiles"))
    dealt = members.join(weight, "family").withColumn("tile", F.pmod(F.xxhash64("id"), "tiles"))
    tiles = cut_lineage(dealt.select("family", "tile", "id", "hashes").groupBy("family", "tile").applyInArrow(_pack, TILE))
    side = tiles.select("family", "tile")
    pairs = side.join(side.withColumnRenamed("tile", "tile2"), "family").filter("tile <= tile2")
    other = tiles.select("family", *(F.col(c).alias(f"{c}2") for c in ("tile", "ids", "counts", "hashes")))
    work = pairs.join(tiles, ["family", "tile"]).join(other, ["family", "tile2"])
    return work.drop("family").mapInArrow(_compare(settings.percent), "a bigint, b bigint")


TILE = "family bigint, tile bigint, ids binary, counts binary, hashes binary"


def _pack(group: pa.Table) -> pa.Table:
    """One row per tile: ids, set sizes and all hashes, one set after the other."""
    sets = group.column("hashes").combine_chunks()
    first = {c: pa.array([group.column(c)[0].as_py()], pa.int64()) for c in ("family", "tile")}
    parts = {"ids": group.column("id").to_numpy(), "counts": np.diff(sets.offsets.to_numpy()), "hashes": sets.flatten().to_numpy(zero_copy_only=False)}
    return pa.table({**first, **{c: pa.array([v.astype("<i8").tobytes()], pa.binary()) for c, v in parts.items()}})


def common_counts(a: np.ndarray, rows_a: np.ndarray, n_a: int, b: np.ndarray, rows_b: np.ndarray, n_b: int, block: int = 4096) -> np.ndarray:
    """Size of the intersection of each set of one group with each of another, by products of 0/1 matrices."""
    shared = np.intersect1d(a, b)
    out = np.zeros((n_a, n_b), dtype=np.float32)  # whole numbers below 2 ** 24 are exact
    at_a, at_b = np.searchsorted(shared, a), np.searchsorted(shared, b)
    hit_a = (at_a < len(shared)) & (np.append(shared, 0)[at_a] == a)
    hit_b = (at_b < len(shared)) & (np.append(shared, 0)[at_b] == b)
    for low in range(0, len(shared), block):
        sides = []
        for at, hit, rows, n in ((at_a, hit_a, rows_a, n_a), (at_b, hit_b, rows_b, n_b)):
            use = hit & (at >= low) & (at < low + block)
            side = np.zeros((n, min(block, len(shared) - low)), dtype=np.float32)
            side[rows[use], at[use] - low] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                read = lambda name: np.frombuffer(at[name], dtype="<i8")
                sides = [(read(f"ids{s}"), read(f"counts{s}"), read(f"hashes{s}")) for s in ("", "2")]
                (ids_a, n_a, a), (ids_b, n_b, b) = sides
                same = at["tile"] == at["tile2"]
                common = common_counts(a, np.repeat(np.arange(len(n_a)), n_a), len(n_a), b, np.repeat(np.arange(len(n_b)), n_b), len(n_b))
                linked = (100 + percent) * common.astype(np.int64) >= percent * (n_a[:, None] + n_b[None, :])
                if same:
                    np.fill_diagonal(linked, False)
                to_a, to_b = least_reached(linked, ids_a, ids_b)
                ids, to = (ids_a, to_a) if same else (np.concatenate([ids_a, ids_b]), np.concatenate([to_a, to_b]))
                yield pa.RecordBatch.from_arrays([pa.array(to[to < ids]), pa.array(ids[to < ids])], names=["a", "b"])

    return run


def _able(rest: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Ids that share enough shingles with documents of other components to have a link with one."""
    nodes = rest.groupBy("id", "c").agg(F.min("least").alias("least"), F.max("n").alias("n"))
    held = nodes.join(sets.select("id", "hashes"), "id").select("id", "c", "n", "least", F.explode("hashes").alias("h"))
    crossing = held.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo != hi").select("h")
    common = held.join(crossing, "h").groupBy("id", "n", "least").agg(F.count(F.lit(1)).alias("shared"))
    p = settings.percent
    return common.filter(f"(100 + {p}) * shared >= {p} * (n + greatest(least, ceil({p} * n / 100)))").select("id").distinct()


def grouped(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links), kept; one row per input row."""
    sketch = cut_lineage(sketches(docs, settings))
    filled = sketch.filter("n_shingles > 0 and doc_id is not null")
    equal = filled.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"))
    reps = equal.select(F.col("rep").alias("id"), "n_shingles", "d1", "d2")
    heads = filled.withColumnRenamed("doc_id", "id").join(reps, ["id", "n_shingles", "d1", "d2"], "left_semi")
    members = heads.select("id", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    several = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("key")
    buckets = cut_lineage(members.join(several, "key").select("key", "id", "n"))
    group = components(verified_links(docs, buckets, settings))
    owner = equal.join(group.withColumnRenamed("id", "rep"), "rep", "left").select("n_shingles", "d1", "d2", F.coalesce("component", "rep").alias("component"))
    # a repeated id with several texts is one node: its smallest component counts for all of them
    out = sketch.select("doc_id", "n_shingles", "d1", "d2").join(owner, ["n_shingles", "d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.least("doc_id", F.coalesce("component", "doc_id")))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that are kept, with their own columns: one row of each group.

    Of rows that share an id one stays, whatever their texts: the first by a hash of all columns. Rows without an id stay.
    """
    marked = cut_lineage(grouped(docs, settings).groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count(F.lit(1)).alias("rows")).filter("doc_id is not null and (not kept or rows > 1)"))
    alone = docs.join(marked.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.join(marked.filter("kept").select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    first = repeated.groupBy(F.col("doc_id").alias("__id")).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("__row"))
    return alone.unionByName(first.select("__row.*"))
