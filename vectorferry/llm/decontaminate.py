"""Benchmark decontamination by greedy string tiling.

Words are letters and digits, so punctuation does not hide a passage. Runs of words
that a document shares with a benchmark item seed the pairs; for each pair the longest
matches that do not overlap are marked again and again, found by a running Karp-Rabin
hash, down to the length of a seed. As tiles may lie in any order, a passage whose
sentences were reordered is still covered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorferry.llm import kernels
from vectorferry.llm.store import materialize

SALTS = 16  # parts of the rows of one item


@dataclass(frozen=True)
class Tiling:
    """Settings: shortest tile in words, share of an item's words that makes a leak, bits of the filter."""

    shortest: int = 5
    coverage: float = 0.5
    filter_bits: int = 22


def punctuation() -> tuple[int, ...]:
    """ASCII that is neither a letter nor a digit."""
    return tuple(b for b in range(128) if not chr(b).isalnum())


def _tables():
    return kernels.byte_codes(), kernels.Powers(), kernels.separator_table(punctuation())


def greedy_tiles(text: list[int], item: list[int], shortest: int, gap: int = -1,
                 powers: kernels.Powers | None = None) -> list[tuple[int, int, int]]:
    """``(place in text, place in item, length)`` of the tiles, the longest first.

    ``gap`` in the text matches nothing. Of matches of one length the first in the
    item, then in the text, is marked. The length of the longest match is found by
    bisection, as a run in common has all its parts in common; each step hashes the
    free windows of one length, so repeated words cost no more than others.
    """
    powers = powers or kernels.Powers()
    text, item = np.asarray(text, np.int64), np.asarray(item, np.int64)
    ours, theirs = _Windows(text, text == gap, powers), _Windows(item, np.zeros(len(item), bool), powers)
    tiles: list[tuple[int, int, int]] = []
    most = min(len(text), len(item))
    while most >= shortest:
        length = _longest(ours, theirs, shortest, most)
        if not length:
            break
        tiles += _mark(ours, theirs, length)
        most = length - 1
    return tiles


class _Windows:
    """Running Karp-Rabin hashes of the windows of a sequence, and which words are taken."""

    def __init__(self, words: np.ndarray, taken: np.ndarray, powers: kernels.Powers):
        self.words, self.taken = words, taken
        up, self.down = powers.upto(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(kernels.mix64(words.view(np.uint64)) * up[: len(words)], dtype=np.uint64, out=self.sums[1:])

    def free(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the windows of ``length`` without a taken word."""
        before = np.concatenate([[0], np.cumsum(self.taken)])
        places = np.flatnonzero(before[length:] == before[: len(before) - length])
        return places, (self.sums[places + length] - self.sums[places]) * self.down[places]


def _longest(ours: _Windows, theirs: _Windows, shortest: int, most: int) -> int:
    """Length of the longest free run in common, from ``shortest`` to ``most``; 0 if there is none."""
    def common(length: int) -> bool:
        return bool(np.isin(theirs.free(length)[1], ours.free(length)[1]).any())

    if not common(shortest):
        return 0
    if common(most):
        return most
    while most - shortest > 1:
        middle = (shortest + most) // 2
        shortest, most = (middle, most) if common(middle) else (shortest, middle)
    return shortest


def _mark(ours: _Windows, theirs: _Windows, length: int) -> list[tuple[int, int, int]]:
    """Take all matches of the greatest length that do not overlap.

    Windows and marked matches have one length, so a window overlaps a mark if it
    holds its first or its last word.
    """
    places, hashes = ours.free(length)
    order = np.argsort(hashes, kind="stable")
    places, hashes = places[order], hashes[order]
    items, wanted = theirs.free(length)
    first, last = np.searchsorted(hashes, wanted), np.searchsorted(hashes, wanted, side="right")
    some = np.flatnonzero(last > first)
    reached: dict[int, int] = {}  # of the windows of one hash, those before are taken
    tiles, end = [], 0
    for place, low, high in zip(items[some].tolist(), first[some].tolist(), last[some].tolist()):
        if place < end:
            continue
        at = reached.get(low, low)
        while at < high and (ours.taken[places[at]] or ours.taken[places[at] + length - 1]):
            at += 1
        reached[low] = at
        if at == high:
            continue
        found, end_of = int(places[at]), place + length
        if (ours.words[found: found + length] != theirs.words[place: end_of]).any():
            continue  # one hash for two runs
        ours.taken[found: found + length] = theirs.taken[place: end_of] = True
        tiles.append((found, place, length))
        end = end_of
    return tiles


def _item_task(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, powers, separators = _tables()
        for rows, data, offsets in kernels.chunks(batches):
            words = kernels.Words(data, offsets, codes, powers, separators)
            hashes, owner = kernels.ngram_hashes(words, shortest)
            edges = np.searchsorted(owner, np.arange(rows.num_rows + 1)).astype(np.int32)
            places = np.concatenate([words.first, [len(words.hashes)]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                rows.column("item"),
                pa.ListArray.from_arrays(places, pa.array((words.hashes >> np.uint64(3)).view(np.int64))),
                pa.ListArray.from_arrays(edges, pa.array(hashes.view(np.int64))),
            ], names=["item", "words", "seeds"])
    return run


def _region_task(shortest: int, bits: np.ndarray):
    """Stretches of a text that its seeds cover, one gap (-1) after each, and the distinct seeds."""
    mask = np.uint64(len(bits) * 64 - 1)

    def hit(values: np.ndarray) -> np.ndarray:
        at = values & mask
        return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, powers, separators = _tables()
        for rows, data, offsets in kernels.chunks(batches):
            words = kernels.Words(data, offsets, codes, powers, separators)
            n = len(words.hashes) - shortest + 1
            hashes, owner = kernels.ngram_hashes(words, shortest)
            if n < 1 or not len(hashes):
                continue
            starts = np.flatnonzero(words.owner[:n] == words.owner[shortest - 1:])
            found = hit(hashes) & hit(hashes >> np.uint64(32))
            if not found.any():
                continue
            hashes, owner, starts = hashes[found], owner[found], starts[found]
            ids, stretches, seeds = [], [], []
            edges = np.searchsorted(owner, np.arange(rows.num_rows + 1)).tolist()
            small = (words.hashes >> np.uint64(3)).view(np.int64)
            for i in np.unique(owner).tolist():
                own = starts[edges[i]: edges[i + 1]]
                covered = np.unique((own[:, None] + np.arange(shortest)).ravel())
                breaks = np.flatnonzero(np.diff(covered) > 1) + 1
                stretches.append(np.insert(small[covered], np.append(breaks, len(covered)), -1))
                seeds.append(np.unique(hashes[edges[i]: edges[i + 1]]).view(np.int64))
                ids.append(i)
            yield pa.RecordBatch.from_arrays([
                rows.column("id").take(pa.array(ids)),
                pa.array(stretches, pa.list_(pa.int64())), pa.array(seeds, pa.list_(pa.int64())),
            ], names=["id", "stretch", "seeds"])
    return run


def _tile_task(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = kernels.Powers()
        for batch in batches:
            tiles, covered = [], []
            for text, item in zip(batch.column("stretch"), batch.column("words")):
                found = greedy_tiles(text.values.to_numpy(), item.values.to_numpy(), shortest, powers=powers)
                tiles.append(len(found))
                covered.append(sum(n for _, _, n in found))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("item"), batch.column("size"),
                pa.array(tiles, pa.int64()), pa.array(covered, pa.int64()),
            ], names=["id", "item", "size", "tiles", "covered"])
    return run


def tile_pairs(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
               item_column: str = "item_id", item_text: str = "text", setting: Tiling = Tiling()) -> DataFrame:
    """``(id, item, size, tiles, covered)`` of the pairs that seeds let reach the coverage.

    Only stretches of a text that seeds cover can hold tiles, so only those are kept
    of it. Every tile of ``n`` words holds ``n - shortest + 1`` seeds; pairs whose
    seeds, each as often as the item has it, cannot cover enough of the item are left
    out before tiling. Seeds reach the
    documents as a bit filter of fixed size (``2 ** filter_bits`` bits); what passes
    it wrongly is left out by the join.
    """
    k = setting.shortest
    source = items.select(F.col(item_column).alias("item"), F.col(item_text).alias("text"))
    kind = source.schema["item"].dataType.simpleString()
    tokens = materialize(
        source.mapInArrow(_item_task(k), f"item {kind}, words array<long>, seeds array<long>").filter("size(seeds) > 0"),
        "items")
    every = tokens.select("item", F.explode("seeds").alias("seed"), F.size("words").alias("size"))
    seeds = materialize(every.groupBy("item", "seed", "size").agg(F.count("seed").alias("n")), "seeds")
    mask = F.lit((1 << setting.filter_bits) - 1)
    both = seeds.select(F.explode(F.array("seed", F.shiftrightunsigned("seed", 32))).alias("x"))
    at = F.col("x").bitwiseAND(mask)
    one = F.expr("shiftleft(1L, cast(x & 63 as int))")
    filled = both.groupBy(F.shiftright(at, 6).alias("cell")).agg(F.bit_or(one).alias("bits")).collect()
    bits = np.zeros((1 << setting.filter_bits) // 64, np.int64)
    for cell, value in filled:
        bits[cell] = value

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    name = rows.schema["id"].dataType.simpleString()
    regions = materialize(
        rows.mapInArrow(_region_task(k, bits.view(np.uint64)), f"id {name}, stretch array<long>, seeds array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "regions")
    hits = regions.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed")
    enough = F.col("seeds") * k >= F.col("size") * setting.coverage
    pairs = hits.groupBy("row", "item", "size").agg(F.sum("n").alias("seeds")).filter(enough)
    salted = tokens.select("item", "words", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    full = (
        pairs.select("row", "item", "size").join(regions.select("row", "id", "stretch"), "row")
        .withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(salted, ["item", "salt"])
    )
    return full.select("id", "item", "size", "stretch", "words").mapInArrow(
        _tile_task(k), f"id {name}, item {kind}, size int, tiles long, covered long")


def contamination(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  item_column: str = "item_id", item_text: str = "text", setting: Tiling = Tiling()) -> DataFrame:
    """``(id_column, contaminated, item_column, coverage, n_tiles)``: one row per document id.

    ``coverage`` is the largest share of an item's words that tiles cover, with the
    item (the smallest of equal ones) and its tiles; 0 and null where no item can
    reach the threshold. Texts that are null, empty or shorter than a tile cover
    nothing, and items shorter than a tile are never covered. Rows of one id, and
    those with a null id, are judged together: the largest coverage counts. Items of
    one id are separate texts. Other columns are not read. An empty table of
    documents gives an empty result, an empty benchmark leaves all clean.
    """
    tiled = tile_pairs(docs, items, id_column, text_column, item_column, item_text, setting)
    share = F.col("covered") / F.col("size")
    best = tiled.groupBy("id").agg(F.min(F.struct((-share).alias("share"), "item", "tiles")).alias("b"))
    named = best.select(F.col("id").alias("_id"), F.col("b.item").alias("_item"), (-F.col("b.share")).alias("_share"),
                        F.col("b.tiles").alias("_tiles"))
    ids = docs.select(id_column).distinct()
    coverage = F.coalesce("_share", F.lit(0.0))
    return ids.join(named, ids[id_column].eqNullSafe(named["_id"]), "left").select(
        id_column, (coverage >= setting.coverage).alias("contaminated"), F.col("_item").alias(item_column),
        coverage.alias("coverage"), F.coalesce("_tiles", F.lit(0).cast("bigint")).alias("n_tiles"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                      item_column: str = "item_id", item_text: str = "text", setting: Tiling = Tiling()) -> DataFrame:
    """The documents without those that leak an item; all columns."""
    found = tile_pairs(docs, items, id_column, text_column, item_column, item_text, setting)
    leaks = found.filter(F.col("covered") >= F.col("size") * setting.coverage).select(
        F.col("id").alias("_leak")).distinct()
    return docs.join(leaks, docs[id_column].eqNullSafe(leaks["_leak"]), "left_anti")
