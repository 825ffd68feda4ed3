"""Hard negatives by exact search in a multiway hyperplane tree.

The tree is that of geometric near-neighbour access: a node has several split points, a
vector belongs to the nearest one, and for each split point the node knows the range of its
distances to the vectors of every sibling subtree. A search for an annulus around an anchor
leaves a subtree out as soon as one split point's range does not meet the annulus.

Split points come from a bounded sample; ranges and leaves cover all rows. Scores are inner
products, so vectors get one more component that gives all the same length, and a window of
scores becomes an annulus of distances. What is left is compared whole: blocks of rows of a
leaf with blocks of anchors, as matrix products within tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorferry.llm.store import materialize

SAMPLE = 8192  # rows that split points and first bounds are taken from
SPLITS = 8  # split points of a node
LEAF_ROWS = 2048  # rows of a leaf, about; a larger one is compared in several blocks
BLOCK_ANCHORS = 2048
SLICE = 256  # anchors whose scores are held at a time

ROW = "row bigint, id bigint, label bigint, vector array<bigint>"
EXACT = 2.0 ** 53


def vectors_of(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    """Lists of whole numbers as the rows of a matrix; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dimension).all():
        return values.reshape(len(sizes), dimension)
    out = np.zeros((len(sizes), dimension), np.int64)
    out[np.arange(dimension)[None, :] < sizes[:, None]] = values
    return out


def scores_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as doubles where these are exact."""
    a = np.abs(left.astype(np.float64)).max(initial=0) * np.abs(right.astype(np.float64)).max(initial=0)
    if a * max(1, left.shape[1]) < EXACT:
        return left.astype(np.float64) @ right.astype(np.float64).T
    return left.astype(object) @ right.astype(object).T


@dataclass
class Tree:
    """Split points of the inner nodes, what is below each, and ranges of distances.

    ``below`` holds the number of a node, or of a leaf as ``-1 - leaf``. ``near`` and ``far``
    are, for each node, split point and subtree, the least and largest distance.
    """

    dimension: int
    radius2: float  # squared length of all vectors with their further component
    points: list[np.ndarray] = field(default_factory=list)
    below: list[list[int]] = field(default_factory=list)
    leaves: int = 1
    near: list[np.ndarray] = field(default_factory=list)
    far: list[np.ndarray] = field(default_factory=list)

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        real = vectors.astype(np.float64)
        rest = np.sqrt(np.maximum(0, self.radius2 - (real * real).sum(axis=1)))
        return np.column_stack([real, rest])

    def distances(self, node: int, lifted: np.ndarray) -> np.ndarray:
        points = self.points[node]
        square = (lifted * lifted).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :] - 2 * lifted @ points.T
        return np.sqrt(np.maximum(0, square))

    def descend(self, lifted: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray | None, np.ndarray | None]]:
        """``(node, rows, distances, subtree of each)`` of the nodes on the way, then leaves with None."""
        stack = [(0 if self.points else -1, np.arange(len(lifted)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if node < 0:
                yield node, rows, None, None
                continue
            distance = self.distances(node, lifted[rows])
            nearest = distance.argmin(axis=1)
            yield node, rows, distance, nearest
            stack.extend((child, rows[nearest == j]) for j, child in enumerate(self.below[node]))

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(vectors), np.int64)
        for node, rows, distance, _ in self.descend(self.lift(vectors)):
            if distance is None:
                leaf[rows] = -1 - node
        return leaf

    def reached(self, vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[list[int]]:
        """Leaves of each anchor that may hold a score in one of its windows.

        ``low`` and ``high`` have one window a column; an empty one has NaN.
        """
        real = vectors.astype(np.float64)
        square = (real * real).sum(axis=1)
        lifted = np.column_stack([real, np.zeros(len(real))])
        slack = 1e-5 * (math.sqrt(self.radius2) + np.sqrt(square))[:, None] + 1e-9
        base = (square + self.radius2)[:, None]
        with np.errstate(invalid="ignore"):
            inner = np.sqrt(np.maximum(0, base - 2 * high)) - slack
            outer = np.sqrt(np.maximum(0, base - 2 * low)) + slack
        found: list[list[int]] = [[] for _ in range(len(vectors))]
        some = np.flatnonzero(~np.isnan(inner).all(axis=1))
        stack = [(0 if self.points else -1, some)]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if node < 0:
                for r in rows.tolist():
                    found[r].append(-1 - node)
                continue
            distance = self.distances(node, lifted[rows])[:, :, None, None]  # rows, points, subtrees, windows
            least, most = self.near[node][None, :, :, None], self.far[node][None, :, :, None]
            inside, outside = inner[rows][:, None, None, :], outer[rows][:, None, None, :]
            meets = (least <= distance + outside) & (most >= distance - outside) & (distance + most >= inside)
            open_ = meets.all(axis=1).any(axis=2)
            for j, child in enumerate(self.below[node]):
                stack.append((child, rows[open_[:, j]]))
        return found


def grow(sample: np.ndarray, rows: int, dimension: int, radius2: float, splits: int = SPLITS, leaf_rows: int = LEAF_ROWS) -> Tree:
    """A tree whose leaves hold about ``leaf_rows`` of ``rows`` rows, as far as the sample tells."""
    tree = Tree(dimension, radius2)
    lifted = tree.lift(sample)
    share = rows / max(1, len(sample))
    leaves = 0

    def part(own: np.ndarray) -> int:
        nonlocal leaves
        points = _split_points(lifted[own], splits) if len(own) * share > leaf_rows and len(own) >= 4 * splits else own[:0]
        if len(points) < 2:
            leaves += 1
            return -leaves
        node = len(tree.points)
        tree.points.append(lifted[own][points])
        tree.below.append([])
        nearest = tree.distances(node, lifted[own]).argmin(axis=1)
        if (nearest == nearest[0]).all():  # equal vectors: no plane parts them
            tree.points.pop()
            tree.below.pop()
            leaves += 1
            return -leaves
        tree.below[node] = [part(own[nearest == j]) for j in range(len(points))]
        return node

    part(np.arange(len(sample)))
    tree.leaves = max(1, leaves)
    return tree


def _split_points(lifted: np.ndarray, splits: int) -> np.ndarray:
    """Points far from each other, among the first three for each that is wanted."""
    candidates = np.arange(min(len(lifted), 3 * splits))
    chosen = [0]
    nearest = ((lifted[candidates] - lifted[0]) ** 2).sum(axis=1)
    while len(chosen) < splits and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((lifted[candidates] - lifted[chosen[-1]]) ** 2).sum(axis=1))
    return np.array(chosen)


# -- index ------------------------------------------------------------------------


def _assign_task(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaf_of(vectors_of(batch.column("vector"), tree.dimension))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

    return run


def _range_task(tree: Tree):
    """Least and largest distances from split points to subtrees, over the rows of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = [np.full((len(p), len(p)), np.inf) for p in tree.points]
        far = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
        for batch in batches:
            for node, _, distance, nearest in tree.descend(tree.lift(vectors_of(batch.column("vector"), tree.dimension))):
                if distance is not None:
                    for j in np.unique(nearest).tolist():
                        own = distance[nearest == j]
                        near[node][:, j] = np.minimum(near[node][:, j], own.min(axis=0))
                        far[node][:, j] = np.maximum(far[node][:, j], own.max(axis=0))
        for node, (a, b) in enumerate(zip(near, far)):
            point, below = np.nonzero(np.isfinite(a))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(point), node)), pa.array(point), pa.array(below),
                pa.array(a[point, below]), pa.array(b[point, below]),
            ], names=["node", "point", "below", "near", "far"])

    return run


def index(rows: DataFrame, sample_rows: int = SAMPLE, splits: int = SPLITS, leaf_rows: int = LEAF_ROWS
          ) -> tuple[DataFrame, Tree, dict[int, int], list]:
    """All rows with their leaf, the tree, the rows of each leaf, and the sample.

    The driver holds the sample, the split points, their ranges and one count per leaf: all
    are bounded by ``sample_rows``.
    """
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, dimension, radius2 = rows.agg(F.count("row"), F.max(F.size("vector")), F.max(square)).first()
    sample = rows.orderBy(F.xxhash64("id", "row"), "row").limit(sample_rows).collect()
    dimension = max(1, dimension or 0)
    matrix = vectors_of(pa.array([r["vector"] for r in sample], pa.list_(pa.int64())), dimension)
    tree = grow(matrix, n, dimension, (radius2 or 0.0) * (1 + 1e-12), splits, leaf_rows)
    placed = materialize(rows.mapInArrow(_assign_task(tree), f"{ROW}, leaf bigint"), "vectors-by-leaf")
    ranges = placed.select("vector").mapInArrow(
        _range_task(tree), "node bigint, point bigint, below bigint, near double, far double"
    ).groupBy("node", "point", "below").agg(F.min("near").alias("near"), F.max("far").alias("far")).collect()
    tree.near = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    tree.far = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
    for r in ranges:
        tree.near[r["node"]][r["point"], r["below"]] = r["near"]
        tree.far[r["node"]][r["point"], r["below"]] = r["far"]
    counts = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}
    return placed, tree, counts, sample


def _deal(counts: dict[int, int], leaves: int, size: int) -> tuple[list[int], list[int]]:
    """First group and number of groups of each leaf: small leaves share one, large ones have several."""
    first, several, group, filled = [], [], 0, 0
    for leaf in range(leaves):
        n = counts.get(leaf, 0)
        if filled and filled + n > size:
            group, filled = group + 1, 0
        first.append(group)
        several.append(max(1, math.ceil(n / size)))
        filled += n
        if filled >= size:
            group, filled = group + several[-1], 0
    return first, several


# -- search -----------------------------------------------------------------------


class Sample:
    """Rows at hand in every task: their scores bound what a search has to look for."""

    def __init__(self, rows: list, dimension: int):
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        self.vectors = vectors_of(pa.array([r["vector"] for r in rows], pa.list_(pa.int64())), dimension)


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; minus infinity if there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k].astype(np.float64)


def _windows(targets: pa.ListArray | pa.ChunkedArray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of the window of each of an anchor's targets, one a column."""
    lists = targets.to_pylist()
    width = max([1, *map(len, lists)])
    least, most = np.full((len(lists), width), np.nan), np.full((len(lists), width), np.nan)
    for i, own in enumerate(lists):
        for j, score in enumerate(own):
            a, b = -(-low * score // 100), high * score // 100
            if a <= b:
                least[i, j], most[i, j] = a, b
    return least, most


def _plan_task(tree: Tree, sample: Sample, same: bool, k: int, low: int, high: int, first: list[int], several: list[int]):
    """Adds to each anchor the blocks of rows that its search cannot leave out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units: list[list[int]] = []
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                vectors = vectors_of(part.column("vector"), tree.dimension)
                ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
                scores = scores_of(vectors, sample.vectors).astype(np.float64)
                alike = labels[:, None] == sample.labels[None, :]
                other = ids[:, None] != sample.ids[None, :]
                if same:
                    least = _kth(np.where(alike & other, scores, -np.inf), k)[:, None]
                    most = np.full(least.shape, np.inf)
                else:
                    least, most = _windows(part.column("targets"), low, high)
                    for j in range(least.shape[1]):
                        with np.errstate(invalid="ignore"):
                            inside = ~alike & other & (scores >= least[:, j: j + 1]) & (scores <= most[:, j: j + 1])
                        least[:, j] = np.fmax(least[:, j], _kth(np.where(inside, scores, -np.inf), k)) + 0 * least[:, j]
                reached = tree.reached(vectors, least, most)
                units += [[first[leaf] + c for leaf in own for c in range(several[leaf])] for own in reached]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(units, pa.list_(pa.int64()))], names=[*batch.schema.names, "units"])

    return run


FOUND = "anchor bigint, target int, id bigint, score bigint"


def _best(scores: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row, column)`` of the k largest of each row, the first of equal ones first; overwrites."""
    rows = np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        column = scores.argmax(axis=1)
        has = scores[rows, column] > -np.inf
        yield rows[has], column[has]
        scores[rows, column] = -np.inf


def _compare_task(dimension: int, same: bool, k: int, low: int, high: int):
    """The k best of a block of rows for each anchor and target of a block of anchors."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if anchors.num_rows and rows.num_rows:
            rows = rows.sort_by("id")
            right = vectors_of(rows.column("vector"), dimension)
            ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
            for start in range(0, anchors.num_rows, SLICE):
                part = anchors.slice(start, SLICE)
                exact = scores_of(vectors_of(part.column("vector"), dimension), right)
                scores = exact.astype(np.float64)
                alike = part.column("label").to_numpy()[:, None] == labels[None, :]
                other = part.column("id").to_numpy()[:, None] != ids[None, :]
                names = part.column("row").to_numpy()
                if same:
                    choices = [np.where(alike & other, scores, -np.inf)]
                else:
                    least, most = _windows(part.column("targets"), low, high)
                    usable = ~alike & other
                    with np.errstate(invalid="ignore"):
                        choices = [
                            np.where(usable & (scores >= least[:, j: j + 1]) & (scores <= most[:, j: j + 1]), scores, -np.inf)
                            for j in range(least.shape[1])]
                for target, choice in enumerate(choices):
                    for row, column in _best(choice, k):
                        out.append((names[row], np.full(len(row), target), ids[column], exact[row, column].astype(np.int64)))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["anchor", "target", "id", "score"])

    return run


def _search(anchors: DataFrame, placed: DataFrame, tree: Tree, counts: dict[int, int], sample: Sample, same: bool, k: int,
            low: int = 0, high: int = 0, block_rows: int = LEAF_ROWS) -> DataFrame:
    """``(anchor, target, id, score, place)``: the k best for each anchor and target, over all rows.

    Every leaf is dealt into blocks of about ``block_rows`` by hash, anchors into groups, so
    that a task compares bounded numbers of both, however many rows are alike.
    """
    several = [max(1, math.ceil(counts.get(leaf, 0) / block_rows)) for leaf in range(tree.leaves)]
    first = np.concatenate([[0], np.cumsum(several)])[:-1].tolist()
    at, blocks = F.col("leaf") + 1, F.array(*map(F.lit, several))
    rows = placed.select("row", "id", "label", "vector", (
        F.element_at(F.array(*map(F.lit, first)), at.cast("int"))
        + F.pmod(F.xxhash64("row"), F.element_at(blocks, at.cast("int")))).cast("bigint").alias("unit"))
    planned = materialize(
        anchors.mapInArrow(
            _plan_task(tree, sample, same, k, low, high, first, several),
            f"{ROW}, group bigint, targets array<bigint>, units array<bigint>"), "search-plan")
    asked = planned.select("row", "id", "label", "vector", "group", "targets", F.explode("units").alias("unit"))
    pairs = planned.select(F.col("group").alias("asking"), F.explode("units").alias("unit")).distinct()
    needed = rows.join(pairs, "unit").select("unit", F.col("asking").alias("group"), "id", "label", "vector")
    found = asked.groupBy("unit", "group").cogroup(needed.groupBy("unit", "group")).applyInArrow(
        _compare_task(tree.dimension, same, k, low, high), FOUND)
    order = Window.partitionBy("anchor", "target").orderBy(F.col("score").desc(), "id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "vector",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    sample_rows: int = SAMPLE,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Hard negatives of every anchor and positive, exactly.

    A row has an id, a label and an array of whole numbers; a score is the inner product with
    the anchor, higher ones first, then smaller ids. An anchor's positives are its first
    ``positives`` rows of the same label; negatives are the first ``negatives`` rows of
    another label that score from ``low`` to ``high`` hundredths of the positive.

    Returns ``anchor_id``, ``positive_id``, ``rank`` from 1, ``negative_id``,
    ``positive_score``, ``negative_score``. Rows with a null id, label or vector, or a null in
    it, take no part. A shorter vector counts as if zeros followed. A row with the anchor's own
    id is no partner of it; other repeated rows count each. Anchors with too few rows have
    fewer results; a negative positive score has an empty window. Scores must fit a long.
    """
    known = F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & F.coalesce(
        F.forall(vector_column, lambda x: x.isNotNull()), F.lit(False))
    usable = materialize(rows.filter(known).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("id"),
        F.col(label_column).cast("bigint").alias("label"), F.col(vector_column).cast("array<bigint>").alias("vector"),
        is_anchor.alias("anchor")), "vectors")
    placed, tree, counts, taken = index(usable.select("row", "id", "label", "vector"), sample_rows, SPLITS, leaf_rows)
    sample = Sample(taken, tree.dimension)
    chosen = placed.join(usable.filter("anchor").select("row"), "row")
    chosen = materialize(chosen, "anchors")
    held = {r["leaf"]: r["count"] for r in chosen.groupBy("leaf").count().collect()}
    first, several = _deal(held, tree.leaves, BLOCK_ANCHORS)
    at = (F.col("leaf") + 1).cast("int")
    group = F.element_at(F.array(*map(F.lit, first)), at) + F.pmod(F.xxhash64("row"), F.element_at(F.array(*map(F.lit, several)), at))
    anchors = chosen.select("row", "id", "label", "vector", group.cast("bigint").alias("group"))

    bare = anchors.withColumn("targets", F.lit(None).cast("array<bigint>"))
    best = materialize(_search(bare, placed, tree, counts, sample, True, positives, block_rows=leaf_rows), "positives")
    windows = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("p"))
    aimed = anchors.join(windows, anchors["row"] == windows["anchor"]).select(
        "row", "id", "label", "vector", "group", F.transform("p", lambda x: x["score"]).alias("targets"))
    hard = _search(aimed, placed, tree, counts, sample, False, negatives, low, high, leaf_rows)
    hard = hard.select("anchor", (F.col("target") + 1).alias("place"), F.col("place").alias("rank"),
                       F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = best.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return hard.join(pairs, ["anchor", "place"]).join(named, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
