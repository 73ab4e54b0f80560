"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Vectors of one label are laid out in tiles of bounded size, near ones together. A pair of tiles is skipped
when their centres are further apart than both radii and the threshold's angle allow. Otherwise the tile
product of the int8 vectors estimates all cosines at once; with ``e`` the length of what quantisation lost of
a unit vector, the estimate is off by at most ``e_u |v'| + e_v |u'| + e_u e_v``. Pairs whose bound excludes
the threshold are settled; only the others are computed again in double precision. A tile pair sends one
row per linked vector (its links there and the smallest id it reaches there), never pairs.

Vectors that are null, empty or zero, or hold null or non-finite components, and rows with a null label or
id, link with nothing and are kept. Vectors of different length aren't compared. Rows may repeat: each row
counts as a vector of its own; rows that share an id are one node of the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harmlens.llm.links import components, least_reached
from harmlens.workspace import cut_lineage

SLACK = 1e-9  # above every rounding error of the bounds


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.93
    tile: int = 1024  # vectors
    pivots: int = 128  # bound of the sample that orders vectors; it has no part in which links are found
    seed: int = 29


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _pivot_order(valid: DataFrame, settings: Settings) -> dict[int, np.ndarray]:
    """Unit pivots per vector length, each next to a near one."""
    rows = valid.select("dim", "embedding").orderBy(F.xxhash64("row"), "row").limit(settings.pivots).collect()
    out = {}
    for dim in sorted({r["dim"] for r in rows}):
        points = unit(np.array([r["embedding"] for r in rows if r["dim"] == dim], dtype=np.float64))
        chain, left = [0], set(range(1, len(points)))
        while left:
            near = max(left, key=lambda i: (points[i] @ points[chain[-1]], -i))
            chain.append(near)
            left.remove(near)
        out[dim] = points[chain]
    return out


def _cells(valid: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Number of the nearest pivot."""
    at = valid.columns.index("embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(at).to_pylist()
            cells = np.zeros(len(vectors), dtype=np.int32)
            for dim, points in pivots.items():
                own = [i for i, v in enumerate(vectors) if len(v) == dim]
                if own:
                    cells[own] = (unit(np.array([vectors[i] for i in own])) @ points.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32())], names=[*batch.schema.names, "cell"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in valid.schema.fields)
    return valid.mapInArrow(run, f"{types}, cell int")


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 vectors, their scales and the length of what is lost of each unit vector."""
    scale = np.abs(units).max(axis=1) / 127.0
    q = np.rint(units / scale[:, None]).astype(np.int8)
    lost = units - q * scale[:, None]
    return q, scale, np.sqrt((lost * lost).sum(axis=1)) + SLACK


def _pack(group: pa.Table) -> pa.Table:
    """One row per tile: rows, ids, vectors, centre and angle radius."""
    keep = lambda name, kind: group.column(name).to_numpy().astype(kind)
    dim = group.column("dim")[0].as_py()
    flat = group.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = flat.reshape(-1, dim)  # of the column's own precision
    units = unit(vectors)
    centre = units.sum(axis=0)
    size = np.sqrt(centre @ centre)
    centre = centre / size if size > 0 else units[0]
    radius = float(np.arccos(np.clip(units @ centre, -1, 1)).max()) + SLACK
    first = {c: [group.column(c)[0].as_py()] for c in ("label", "dim", "tile")}
    return pa.table({
        **{c: pa.array(v, group.schema.field(c).type) for c, v in first.items()},
        "n": pa.array([len(vectors)], pa.int64()), "rows": pa.array([keep("row", "<i8").tobytes()], pa.binary()),
        "ids": pa.array([keep("vec_id", "<i8").tobytes()], pa.binary()), "vectors": pa.array([vectors.tobytes()], pa.binary()),
        "centre": pa.array([centre.tolist()], pa.list_(pa.float64())), "radius": pa.array([radius], pa.float64()),
    })


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> np.ndarray:
    """Boolean link matrix of two tiles, exact in double precision."""
    ua, ub = unit(a), unit(b)
    (qa, sa, ea), (qb, sb, eb) = quantised(ua), quantised(ub)
    exact = np.float32 if a.shape[1] * 127 * 127 < 1 << 24 else np.float64  # whole numbers up to there are exact
    estimate = (qa.astype(exact) @ qb.astype(exact).T).astype(np.float64) * sa[:, None] * sb[None, :]
    bound = ea[:, None] * (1 + eb)[None, :] + (1 + ea)[:, None] * eb[None, :] + SLACK  # |u'| <= 1 + e_u
    linked = estimate - bound >= threshold
    unsure = np.argwhere((estimate + bound >= threshold) & ~linked)
    for at in range(0, len(unsure), 65_536):
        i, j = unsure[at : at + 65_536].T
        x, y = a[i].astype(np.float64), b[j].astype(np.float64)
        dot = np.einsum("ij,ij->i", x, y)
        size = np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))
        plain = np.isfinite(dot) & np.isfinite(size) & (size > 1e-280)
        cosine = np.where(plain, dot / np.where(plain, size, 1.0), np.einsum("ij,ij->i", ua[i], ub[j]))
        linked[i, j] = cosine >= threshold
    if same:
        np.fill_diagonal(linked, False)
    return linked


def _compare(settings: Settings, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                read = lambda name, kind: np.frombuffer(at[name], dtype=kind)
                same = at["tile"] == at["tile2"]
                a = read("vectors", kind).reshape(-1, at["dim"])
                b = read("vectors2", kind).reshape(-1, at["dim"])
                linked = tile_links(a, b, settings.threshold, same)
                ids_a, ids_b = read("ids", "<i8"), read("ids2", "<i8")
                to_a, to_b = least_reached(linked, ids_a, ids_b)
                sides = [(read("rows", "<i8"), ids_a, to_a, linked.sum(axis=1))]
                if not same:
                    sides.append((read("rows2", "<i8"), ids_b, to_b, linked.sum(axis=0)))
                row, ids, to, n = (np.concatenate(x) for x in zip(*sides))
                hit = n > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[hit].astype(np.int64)) for x in (row, ids, to, n)], names=["row", "vec_id", "least", "n"]
                )

    return run


def grouped(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id (smallest id reachable), kept; one row per input row."""
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"  # any other kind of number is held in double precision
    held = F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding")
    rows = cut_lineage(vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", held))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    valid = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & some).withColumn("dim", F.size("embedding"))
    pivots = _pivot_order(valid, settings)
    placed = cut_lineage(_cells(valid, pivots).withColumn("luck", F.rand(settings.seed)))
    # tiles are runs of the order (cell, chance): the cells' counts say where each begins
    cells = placed.groupBy("label", "dim", "cell").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("label", "dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.withColumn("begin", F.coalesce(F.sum("size").over(before), F.lit(0)))
    tile = F.floor((F.col("begin") + F.floor(F.col("luck") * F.col("size"))) / settings.tile).cast("bigint").alias("tile")
    dealt = placed.join(starts, ["label", "dim", "cell"]).select("label", "dim", tile, "row", "vec_id", "embedding")
    kinds = {f.name: f.dataType.simpleString() for f in dealt.schema.fields}
    schema = f"label {kinds['label']}, dim int, tile bigint, n bigint, rows binary, ids binary, vectors binary, centre array<double>, radius double"
    tiles = cut_lineage(dealt.groupBy("label", "dim", "tile").applyInArrow(_pack, schema))
    # tile pairs, first without their vectors
    side = tiles.select("label", "dim", "tile", "centre", "radius")
    other = side.select("label", "dim", *(F.col(c).alias(f"{c}2") for c in ("tile", "centre", "radius")))
    dot = F.aggregate(F.zip_with("centre", "centre2", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    gap = F.acos(F.greatest(F.least(dot, F.lit(1.0)), F.lit(-1.0)))
    near = gap - F.col("radius") - F.col("radius2") <= float(np.arccos(settings.threshold)) + 1e-6
    pairs = side.join(other, ["label", "dim"]).filter((F.col("tile") <= F.col("tile2")) & near).select("label", "dim", "tile", "tile2")
    one = tiles.select("label", "dim", "tile", "rows", "ids", "vectors")
    two = tiles.select("label", "dim", *(F.col(c).alias(f"{c}2") for c in ("tile", "rows", "ids", "vectors")))
    loaded = pairs.join(one, ["label", "dim", "tile"]).join(two, ["label", "dim", "tile2"])
    work = loaded.select("dim", "tile", "tile2", "rows", "ids", "vectors", "rows2", "ids2", "vectors2")
    found = cut_lineage(work.mapInArrow(_compare(settings, np.float32 if single else np.float64), "row bigint, vec_id bigint, least bigint, n bigint"))
    group = components(found.select(F.col("vec_id").alias("a"), F.col("least").alias("b")))
    counts = found.groupBy("row").agg(F.sum("n").alias("n_links"))
    out = rows.select("row", "vec_id").join(counts, "row", "left").join(group.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id").alias("component_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
