"""MinHash near-dedup: one-permutation hashing, banded buckets, star-shaped candidates.

One hash of each shingle serves all signature bins; empty bins are filled by optimal
densification. Texts of equal shingle sets form a class that one document stands for.
Documents that share a band meet in a bucket; each is paired with the bucket's smallest
id only, so pairs grow with bucket sizes, not with their squares. Pairs are confirmed
on whole shingle sets. Where a bucket still spans more than one confirmed component, a
star may have lost a link between two of its points. Such a bucket is dealt anew by
shingles: members order their sets by rarity around the star's centre, and linked ones
must share a shingle among the first of that order. Members that meet so in different
components are compared by size, place of the shingle and an odd sketch of their sets,
and the few that may reach the threshold are confirmed as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectorferry.llm import kernels
from vectorferry.llm.graph import connected_components
from vectorferry.llm.store import materialize

NO_BIN = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class MinHash:
    """Settings. Linked: ``100 * intersection >= percent * union``.

    With 40 bands of 6 rows a pair at 0.8 shares no band about 5 times in a million, one
    at 0.85 far less often. ``bins`` is a power of two and at least ``bands * rows``,
    ``sketch`` a multiple of 64.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 6
    bins: int = 256
    sketch: int = 1024


def signatures(hashes: np.ndarray, owner: np.ndarray, texts: int, bins: int) -> np.ndarray:
    """One-permutation signatures of sorted shingle sets, densified.

    The upper bits of a hash name its bin; as each set is sorted, the first hash of
    a bin is its minimum. An empty bin tries bins of the same text in an order that
    a hash of bin and attempt gives, the same for all texts, until one that was
    filled from the start is found.
    """
    shift = np.uint64(64 - (bins.bit_length() - 1))
    own = (hashes >> shift).astype(np.int64)
    first = np.ones(len(hashes), bool)
    first[1:] = (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])
    table = np.full((texts, bins), NO_BIN, np.uint64)
    filled = np.zeros((texts, bins), bool)
    table[owner[first], own[first]] = hashes[first]
    filled[owner[first], own[first]] = True
    rows, cols = np.nonzero(~filled & filled.any(axis=1)[:, None])
    attempt = 0
    while len(rows):
        attempt += 1
        seed = cols.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(attempt << 32)
        target = (kernels.mix64(seed) >> shift).astype(np.int64)
        found = filled[rows, target]
        table[rows[found], cols[found]] = table[rows[found], target[found]]
        rows, cols = rows[~found], cols[~found]
    return table


def band_keys(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per text and band; the band's number is part of it."""
    keys = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :], len(table), axis=0)
    shaped = table[:, : bands * rows].reshape(len(table), bands, rows)
    for j in range(rows):
        keys = kernels.mix64(keys * np.uint64(0xD6E8FEB86659FD93) + shaped[:, :, j])
    return keys.view(np.int64)


def odd_sketches(hashes: np.ndarray, owner: np.ndarray, texts: int, bits: int) -> np.ndarray:
    """Parity of the number of shingles at each of ``bits`` places, packed into 64-bit numbers.

    The places where two sketches differ tell the size of the symmetric difference.
    """
    place = (kernels.mix64(hashes ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(owner * bits + place, minlength=texts * bits).astype(np.uint8) & 1
    return np.packbits(odd.reshape(texts, bits), axis=1).view(np.int64)


def _sums(values: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    running = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, dtype=np.uint64, out=running[1:])
    edges = np.searchsorted(owner, np.arange(texts + 1))
    total = running[edges[1:]] - running[edges[:-1]]
    return total.view(np.int64)


def _bit_names(setting: MinHash) -> list[str]:
    return [f"b{i}" for i in range(setting.sketch // 64)]


def _signature_task(setting: MinHash):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, powers, separators = kernels.byte_codes(), kernels.Powers(), kernels.separator_table()
        for rows, data, offsets in kernels.chunks(batches):
            words = kernels.Words(data, offsets, codes, powers, separators)
            hashes, owner = kernels.shingle_sets(words, setting.shingle)
            n = np.bincount(owner, minlength=rows.num_rows)
            table = signatures(hashes, owner, rows.num_rows, setting.bins)
            keys = band_keys(table, setting.bands, setting.rows)
            bits = odd_sketches(hashes, owner, rows.num_rows, setting.sketch)
            yield pa.RecordBatch.from_arrays([
                rows.column(0),
                pa.array(n.astype(np.int64)),
                pa.array(_sums(kernels.mix64(hashes), owner, rows.num_rows)),
                pa.array(_sums(kernels.mix64(hashes ^ np.uint64(0x5851F42D4C957F2D)), owner, rows.num_rows)),
                pa.ListArray.from_arrays(
                    np.arange(0, keys.size + 1, setting.bands, dtype=np.int32), pa.array(keys.reshape(-1))),
                *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(bits.shape[1])],
            ], names=["id", "n", "h1", "h2", "keys", *_bit_names(setting)])
    return run


def _set_task(setting: MinHash):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, powers, separators = kernels.byte_codes(), kernels.Powers(), kernels.separator_table()
        for rows, data, offsets in kernels.chunks(batches, "text"):
            words = kernels.Words(data, offsets, codes, powers, separators)
            hashes, owner = kernels.shingle_sets(words, setting.shingle)
            edges = np.searchsorted(owner, np.arange(rows.num_rows + 1))
            same = np.diff(edges) == rows.column("n").to_numpy()
            same &= _sums(kernels.mix64(hashes), owner, rows.num_rows) == rows.column("h1").to_numpy()
            sets = [hashes[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), pa.array(sets, pa.binary())], names=["id", "s"]).filter(pa.array(same))
    return run


ENTRIES = 1 << 20  # entries of a batch that a task sends on


def _lacking_task(percent: int):
    """The shingles of each member that its centre lacks, and of the others as many as the first may take."""
    names = ["bucket", "g", "id", "n", "c", "common"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries() -> pa.RecordBatch:
            lengths = np.array([len(x) for x in keys])
            at = pa.array(np.repeat(np.array(rows), lengths))
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(keys).view(np.int64)), batch.column("g").take(at), batch.column("a").take(at),
                pa.array(np.repeat(sizes, lengths)), batch.column("c").take(at), pa.array(np.concatenate(common))],
                names=names)

        for batch in batches:
            members, centres = batch.column("sa"), batch.column("sb")
            groups = batch.column("g").to_numpy().view(np.uint64)
            keys, common, rows, sizes, held = [], [], [], [], 0
            for i in range(batch.num_rows):
                x = np.frombuffer(members[i].as_buffer(), np.uint64)
                y = np.frombuffer(centres[i].as_buffer(), np.uint64)
                both = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
                lacking = x[~both]
                rest = x[both][: max(0, len(x) - (percent * len(x) + 99) // 100 + 1 - len(lacking))]
                keys.append(kernels.mix64(np.concatenate([lacking, rest]) * np.uint64(0xD6E8FEB86659FD93) + groups[i]))
                common.append(np.arange(len(keys[-1])) >= len(lacking))
                rows.append(i)
                sizes.append(len(x))
                held += len(keys[-1])
                if held >= ENTRIES:
                    yield entries()
                    keys, common, rows, sizes, held = [], [], [], [], 0
            if rows:
                yield entries()
    return run


def _confirm_task(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("sa"), batch.column("sb")
            linked = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x = np.frombuffer(left[i].as_buffer(), np.uint64)
                y = np.frombuffer(right[i].as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum()) if len(y) else 0
                linked[i] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
            kept = batch.filter(pa.array(linked))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])
    return run


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    setting: MinHash = MinHash()) -> DataFrame:
    """``(id_column, n_shingles, component_id, kept)``: one row per document.

    Words are split at ASCII white space, A-Z are lower-cased. ``component_id`` is the
    smallest id that links reach; ``kept`` marks the document that stays. A document
    with fewer words than a shingle has the whole sequence as its one shingle; one
    that is null, empty or without words has none, links with nothing and is kept.
    Rows of one id count as one document: of different texts the one with most
    shingles (then the larger hash) stands for it. Rows with a null id link with
    nothing, and each is returned, kept, without a component. Other columns are not
    read, whatever their names. An empty table gives an empty result.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    signed = materialize(
        source.mapInArrow(_signature_task(setting), f"id {kind}, n long, h1 long, h2 long, keys array<long>, "
                           + ", ".join(f"{b} long" for b in _bit_names(setting))),
        "signatures",
    )
    named = signed.filter("id is not null")
    one = named.select("id", "n", "h1", "h2").groupBy("id").agg(F.max(F.struct("n", "h1", "h2")).alias("w")).select("id", "w.*")
    filled = one.filter("n > 0")
    classes = materialize(filled.groupBy("n", "h1", "h2").agg(F.min("id").alias("rep")), "representatives")
    member = materialize(filled.join(classes, ["n", "h1", "h2"]).select("id", "n", "h1", "h2", "rep"), "classes")

    stands = member.filter("id = rep").select("id", "n", "h1", "h2")
    signature = stands.join(named, ["id", "n", "h1", "h2"])
    rows = signature.select("id", "n", F.explode("keys").alias("bucket")).distinct()
    shared = rows.groupBy("bucket").agg(F.min("id").alias("center"), F.count("id").alias("size")).filter("size > 1")
    buckets = materialize(rows.join(shared.drop("size"), "bucket"), "buckets")
    candidates = buckets.select("id").distinct().join(stands.select("id", "n", "h1"), "id")
    texts = source.join(candidates, "id").dropDuplicates(["id", "text"])
    sets = materialize(texts.mapInArrow(_set_task(setting), f"id {kind}, s binary"), "sets")

    sizes = stands.select(F.col("id").alias("center"), F.col("n").alias("m"))
    star = buckets.filter("id <> center").select("id", "n", "center").distinct().join(sizes, "center")
    star = star.filter(_may_link("n", "m", setting.percent)).select(F.col("id").alias("a"), F.col("center").alias("b"))
    links = materialize(_confirmed(star, sets, kind, setting), "links")
    found = connected_components(links)

    labelled = materialize(
        buckets.join(found.withColumnRenamed("node", "id"), "id", "left")
        .select("bucket", "center", "id", "n", F.coalesce("component", "id").alias("c")),
        "labelled",
    )
    bits = signature.select("id", *_bit_names(setting)).dropDuplicates(["id"])
    met = materialize(_met_by_shingles(labelled, sets, kind, setting), "met")
    across = materialize(_across_components(met, bits, setting).distinct(), "across")
    if not across.isEmpty():
        more = _confirmed(across.join(star, ["a", "b"], "left_anti"), sets, kind, setting)
        found = connected_components(links.unionByName(more))

    reached = member.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "id", F.coalesce("component", "rep").alias("component_id"))
    result = one.select("id", "n").join(reached, "id", "left").select(
        "id", "n", F.coalesce("component_id", "id").alias("component_id"))
    nameless = signed.filter("id is null").select("id", "n", F.col("id").alias("component_id"))
    return result.unionByName(nameless).select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _may_link(n: str, m: str, percent: int):
    """Sizes that let two sets reach the threshold at all."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _most_unlike(n: str, m: str, setting: MinHash):
    """Places in which the sketches of linked sets may differ: the mean for the largest
    symmetric difference that links, and 4.5 deviations."""
    size = setting.sketch
    x = (F.col(n) + F.col(m)) * ((100 - setting.percent) / (100 + setting.percent)) * (2 / size)
    spread = (size / 4) * (1 - F.exp(-2 * x) - 2 * x * F.exp(-2 * x))
    return (size / 2) * (1 - F.exp(-x)) + 4.5 * F.sqrt(F.greatest(spread, F.lit(0.0))) + 1


def _met_by_shingles(labelled: DataFrame, sets: DataFrame, kind: str, setting: MinHash) -> DataFrame:
    """``(bucket, id, n, c, left)``: members of mixed buckets by a centre and one of their first shingles.

    Around a centre all members order their shingles alike: what the centre lacks first, there the
    rarest first. Of linked sets at least ``percent`` of either is in the other, so both have a common
    shingle among the first that are more than the rest of the set. ``left`` counts the shingles from
    this one on. The centre itself needs no row, as it was compared with every member; a centre's members
    are dealt once, however many buckets they share. A window holds the shingles of one document.
    """
    mixed = labelled.groupBy("bucket").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high")
    members = labelled.join(mixed.select("bucket"), "bucket", "left_semi").filter("id <> center").select(
        F.col("id").alias("a"), F.col("center").alias("b"), "c").distinct()
    left = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    joined = members.join(left, "a").join(right, "b").select("a", "c", F.xxhash64("b").alias("g"), "sa", "sb")
    rows = materialize(
        joined.mapInArrow(_lacking_task(setting.percent), f"bucket long, g long, id {kind}, n long, c {kind}, common boolean"),
        "lacking")
    often = rows.groupBy("bucket").agg(F.count("id").alias("k")).filter("k > 1")
    order = Window.partitionBy("g", "id").orderBy("common", "k", "bucket")
    first = rows.join(often, "bucket", "left").withColumn("place", F.row_number().over(order)).filter(
        F.expr(f"place <= n - ({setting.percent} * n + 99) div 100 + 1") & F.col("k").isNotNull())
    return first.select("bucket", "id", "n", "c", (F.col("n") - F.col("place") + 1).alias("left"))


def _across_components(met: DataFrame, bits: DataFrame, setting: MinHash) -> DataFrame:
    """Pairs that meet in different components, one side outside the largest that meets there,
    and may be linked by their sizes, the place where they meet and their sketches.

    Every pair across components has such a side, and members of one component need
    no further link, so where one component meets no pair is made. At the first shingle that a
    pair has in common no more than the shingles left of either can be shared.
    """
    held = met.groupBy("bucket", "c").agg(F.count("id").alias("k"))
    largest = held.groupBy("bucket").agg(
        F.max(F.struct("k", "c")).alias("w"), F.count("c").alias("kinds")).filter("kinds > 1")
    mixed = met.join(largest.select("bucket", F.col("w.c").alias("most")), "bucket")
    mixed = materialize(mixed.join(bits, "id"), "mixed")
    names = _bit_names(setting)
    few = mixed.filter("c <> most").select(
        "bucket", F.col("id").alias("i"), F.col("n").alias("p"), F.col("c").alias("d"), F.col("left").alias("rest"),
        *[F.col(b).alias(f"o{b}") for b in names])
    unlike = sum((F.bit_count(F.col(b).bitwiseXOR(F.col(f"o{b}"))) for b in names), F.lit(0))
    shared = F.least("left", "rest") * (100 + setting.percent) >= setting.percent * (F.col("p") + F.col("n"))
    like = (few["d"] != mixed["c"]) & _may_link("p", "n", setting.percent) & shared & (
        unlike <= _most_unlike("p", "n", setting))
    return few.join(mixed, (few["bucket"] == mixed["bucket"]) & like).select(
        F.greatest("i", "id").alias("a"), F.least("i", "id").alias("b"))


def _confirmed(pairs: DataFrame, sets: DataFrame, kind: str, setting: MinHash) -> DataFrame:
    left = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return joined.mapInArrow(_confirm_task(setting.percent), f"a {kind}, b {kind}")


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                         setting: MinHash = MinHash()) -> DataFrame:
    """The documents that stay, all columns: one of each group, and of the rows of one id.

    Rows with a null id stay.
    """
    found = near_duplicates(docs, id_column, text_column, setting)
    dropped = found.filter("not kept").select(F.col(id_column).alias("_dropped"))
    staying = docs.join(dropped, docs[id_column] == dropped["_dropped"], "left_anti")
    repeated = docs.groupBy(id_column).agg(F.count(F.lit(1)).alias("_rows")).filter(
        (F.col("_rows") > 1) & F.col(id_column).isNotNull())
    if repeated.isEmpty():
        return staying
    named = staying.filter(F.col(id_column).isNotNull())
    return named.dropDuplicates([id_column]).unionByName(staying.filter(F.col(id_column).isNull()))
