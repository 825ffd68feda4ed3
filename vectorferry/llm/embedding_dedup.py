"""Near-duplicate vectors by collision counting on one-dimensional projections.

Each vector is projected on many random lines. On every line the vectors beyond a
threshold at either end, where close vectors meet far more often than others, form a
cell. Within a cell a window centred on each query's value is laid on further lines, and
the collisions of each pair are counted; pairs with as many as a pair at the threshold
similarity has, up to the allowed loss, are verified on whole vectors in double
precision. The number of lines follows from the loss, the width of the ends from the
number of vectors, so a cell holds about their square root.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorferry.llm.graph import connected_components
from vectorferry.llm.store import materialize


@dataclass(frozen=True)
class Projections:
    """Settings. ``loss`` is the chance to miss a pair exactly at ``cosine``, for cells and for
    counts each; closer pairs are missed far less often. ``block`` bounds the rows of a tile."""

    cosine: float = 0.9
    loss: float = 1e-4
    counting: int = 24
    window: float = 2.0  # half width, in deviations of the difference of a pair at ``cosine``
    block: int = 1500
    seed: int = 7


@dataclass(frozen=True)
class Layout:
    """What the settings give for a number of vectors."""

    lines: int
    threshold: float
    half_width: float
    least: int


def _normal(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.vectorize(math.erf)(x / math.sqrt(2)))


def calibrate(setting: Projections, vectors: int) -> Layout:
    """Lines, ends, windows and the least count.

    On a random line a unit vector's value is standard normal, whatever the data. A
    pair at the threshold shares an end of a line with a chance that the bivariate
    normal gives; lines are added until sharing none is as rare as ``loss``.
    """
    share = min(0.25, 1.5 / math.sqrt(max(1, vectors)))
    grid = np.linspace(-8, 8, 16001)
    threshold = float(grid[np.searchsorted(_normal(grid), 1 - share)])
    x = np.linspace(threshold, threshold + 8, 8001)
    rho = setting.cosine
    density = np.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    both = float(np.sum(density * _normal((rho * x - threshold) / math.sqrt(1 - rho * rho))) * (x[1] - x[0]))
    lines = math.ceil(-math.log(setting.loss) / (2 * both))
    deviation = math.sqrt(2 - 2 * rho)
    inside = math.erf(setting.window / math.sqrt(2))
    least, missed = 0, 0.0
    while least < setting.counting:
        missed += math.comb(setting.counting, least) * inside**least * (1 - inside) ** (setting.counting - least)
        if missed > setting.loss:
            break
        least += 1
    return Layout(lines, threshold, setting.window * deviation, least)


def _lines(dimension: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dimension]).standard_normal((dimension, count)).astype(np.float32)


def _rows(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(dimension, places, float64 matrix)`` of the vectors without null components."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.array([-1 if n is None else n for n in pc.list_value_length(column).to_pylist()])
    for dimension in np.unique(lengths[lengths > 0]).tolist():
        places = np.flatnonzero(lengths == dimension)
        flat = column.take(pa.array(places)).flatten()
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
        yield dimension, places, values


LINES = 1024  # projected on at a time: memory follows from it and not from the number of lines
KEPT = 1 << 24  # numbers of lines that a task keeps; those of further lines are drawn again


class _Drawn:
    """The lines of one dimension in blocks, each from a seed of its own."""

    def __init__(self, dimension: int, count: int, seed: int):
        self.dimension, self.count, self.seed = dimension, count, seed
        self.held: dict[int, np.ndarray] = {}

    def blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        for first in range(0, self.count, LINES):
            lines = self.held.get(first)
            if lines is None:
                generator = np.random.default_rng([self.seed, self.dimension, first])
                lines = generator.standard_normal((self.dimension, min(LINES, self.count - first)), np.float32)
                if (first + LINES) * self.dimension <= KEPT:
                    self.held[first] = lines
            yield first, lines


def cells_of(unit: np.ndarray, lines: _Drawn, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Owner, ascending, and number of each cell: a line for its upper end, that plus all lines for its lower."""
    small = unit.astype(np.float32)
    owners, cells = [], []
    for first, block in lines.blocks():
        on = small @ block
        for shift, beyond in ((first, on >= threshold), (first + lines.count, on <= -threshold)):
            owner, line = np.nonzero(beyond)
            owners.append(owner)
            cells.append(line + shift)
    owner, cell = np.concatenate(owners), np.concatenate(cells)
    order = np.lexsort([cell, owner])
    return owner[order], cell[order]


def _cell_task(layout: Layout, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[int, _Drawn] = {}
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                for dimension, places, values in _rows(part.column("v")):
                    norm = np.linalg.norm(values, axis=1)
                    good = np.isfinite(norm) & (norm > 0)
                    places, unit = places[good], values[good] / norm[good][:, None]
                    if not len(places):
                        continue
                    if dimension not in lines:
                        lines[dimension] = _Drawn(dimension, layout.lines, seed)
                    owner, cell = cells_of(unit, lines[dimension], layout.threshold)
                    edges = np.searchsorted(owner, np.arange(len(places) + 1)).astype(np.int32)
                    kept = part.take(pa.array(places))
                    yield pa.RecordBatch.from_arrays([
                        kept.column("id"), kept.column("v"), pa.array(np.full(len(places), dimension, np.int32)),
                        pa.ListArray.from_arrays(edges, pa.array(cell.astype(np.int32))),
                    ], names=["id", "v", "dimension", "cells"])
    return run


def _padded(lists: pa.Array) -> np.ndarray:
    lengths = pc.list_value_length(lists).to_numpy()
    table = np.full((len(lists), max(1, int(lengths.max()))), -1, np.int32)
    table[np.arange(table.shape[1])[None, :] < lengths[:, None]] = lists.flatten().to_numpy()
    return table


def linked_pairs(unit: np.ndarray, left: np.ndarray, right: np.ndarray, counting: np.ndarray, layout: Layout,
                 cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of verified pairs, one of ``left`` (ascending), one of ``right``."""
    on = unit.astype(np.float32) @ counting
    found_left, found_right = [], []
    for first in range(0, len(left), 128):
        own = left[first: first + 128]
        hits = np.zeros((len(own), len(right)), np.uint8)
        for j in range(counting.shape[1]):
            hits += np.abs(on[own, j][:, None] - on[right, j][None, :]) <= np.float32(layout.half_width)
        a, b = np.nonzero(hits >= layout.least)
        a, b = own[a], right[b]
        for at in range(0, len(a), 20000):
            x, y = a[at: at + 20000], b[at: at + 20000]
            close = np.einsum("ij,ij->i", unit[x], unit[y]) >= cosine
            found_left.append(x[close])
            found_right.append(y[close])
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(found_left or empty), np.concatenate(found_right or empty)


def _tile_task(setting: Projections, layout: Layout, id_type: pa.DataType):
    names = ["id", "links", "root"]

    def run(table: pa.Table) -> pa.Table:
        cell, i, j, dimension = (table.column(c)[0].as_py() for c in ("cell", "i", "j", "dimension"))
        table = table.sort_by("id")
        ids = table.column("id").combine_chunks()
        blocks = table.column("block").to_numpy()
        (_, _, values), = _rows(table.column("v"))
        unit = values / np.linalg.norm(values, axis=1)[:, None]
        counting = _lines(dimension, setting.counting, setting.seed + 1)
        if i == j:
            a, b = linked_pairs(unit, np.arange(len(ids)), np.arange(len(ids)), counting, layout, setting.cosine)
            a, b = a[a < b], b[a < b]
        else:
            a, b = linked_pairs(unit, np.flatnonzero(blocks == i), np.flatnonzero(blocks == j), counting, layout,
                                setting.cosine)
        cells = _padded(table.column("cells").combine_chunks())
        here = np.zeros(len(a), bool)  # the pair's first common cell is this one
        earlier = np.where(cells < cell, cells, -1)
        for at in range(0, len(a), 20000):
            x, y = earlier[a[at: at + 20000]], earlier[b[at: at + 20000]]
            here[at: at + 20000] = ~((x[:, :, None] == y[:, None, :]) & (x[:, :, None] >= 0)).any(axis=(1, 2))
        a, b = a[here], b[here]
        links = np.bincount(np.concatenate([a, b]), minlength=len(ids))
        root = np.arange(len(ids))
        while len(a):
            new = root.copy()
            low = np.minimum(root[a], root[b])
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            np.minimum.at(new, root[a], low)
            np.minimum.at(new, root[b], low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        some = np.flatnonzero(links)
        return pa.table([
            ids.take(pa.array(some)).cast(id_type), pa.array(links[some].astype(np.int64)),
            ids.take(pa.array(root[some])).cast(id_type),
        ], names=names)
    return run


def near_duplicate_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                           setting: Projections = Projections()) -> DataFrame:
    """``(id_column, n_links, component_id, kept)``: one row per vector id.

    ``n_links`` counts the other vectors at ``cosine`` or more, ``component_id`` is the
    smallest id that links reach, ``kept`` marks it. Vectors that are null, empty or
    zero or hold null or non-finite components link with nothing, nor do vectors of
    different length with each other. Rows of one id are one vector; of different
    ones the smallest counts. Each row with a null id is returned, kept, without a
    component. Other columns are not read. An empty table gives an empty result.

    A cell with more rows than ``block`` is dealt into blocks, and each pair of blocks
    is a task of its own; a pair of vectors counts in its first common cell only.
    Tasks send the number of links and a local component per vector, not pairs.
    """
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("v"))
    one = rows.filter("id is not null").groupBy("id").agg(F.min("v").alias("v"))
    usable = one.filter(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)))
    source = materialize(usable, "vectors")
    layout = calibrate(setting, source.count())
    kind, element = source.schema["id"].dataType.simpleString(), source.schema["v"].dataType.simpleString()
    placed = materialize(
        source.mapInArrow(_cell_task(layout, setting.seed), f"id {kind}, v {element}, dimension int, cells array<int>"),
        "cells")
    spread = placed.select("*", F.explode("cells").alias("cell"))
    # one row per dimension and end of a line
    parts = placed.select("dimension", F.explode("cells").alias("cell")).groupBy("dimension", "cell").agg(
        F.ceil(F.count("cell") / setting.block).cast("int").alias("parts"), F.count("cell").alias("size"),
    ).filter("size > 1").drop("size")
    block = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    dealt = spread.join(parts, ["dimension", "cell"]).withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = dealt.select("id", "v", "dimension", "cells", "cell", "block", F.least("block", "other").alias("i"),
                         F.greatest("block", "other").alias("j"))
    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    found = materialize(
        tiles.groupBy("dimension", "cell", "i", "j").applyInArrow(
            _tile_task(setting, layout, id_type), f"id {kind}, links long, root {kind}"), "found")
    counts = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    components = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = one.select("id").join(counts, "id", "left").join(
        components.withColumnRenamed("node", "id"), "id", "left").select(
        "id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    nameless = rows.filter("id is null").select("id", F.lit(0).cast("bigint").alias("n_links"),
                                                F.col("id").alias("component_id"))
    return named.unionByName(nameless).select(
        F.col("id").alias(id_column), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
