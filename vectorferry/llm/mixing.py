"""Mixing sources to target weights by systematic sampling.

Within each source, documents stand in order of size. Each is expected ``target /
source size`` times; the running sum of that, plus one offset per source, crosses an
integer once for each copy taken. As neighbours are alike in size, the words taken from
a source differ from its target by about one document at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorferry.llm.store import materialize

WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"
_ROW_MASK = (1 << 33) - 1  # monotonically_increasing_id: row number below, partition above


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not ASCII white space; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _positions(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """Add ``_pos``, the 0-based place within ``group``, for rows dealt by ranges of ``order``.

    ``order`` starts with the group. Rows are numbered within their range; a small
    table with one row per group and range has the rows of the group before. A group
    with a large share of all rows lies in many ranges.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()
    placed = materialize(
        ranged.withColumns({"_range": F.shiftright(number, 33), "_row": number.bitwiseAND(F.lit(_ROW_MASK))}), name)
    held = placed.groupBy(*group, "_range").agg(F.count("_row").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(
        *group, "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(held, [*group, "_range"]).withColumn("_pos", F.col("_row") + F.col("_shift")).drop(
        "_range", "_row", "_shift")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``(_null, _key, _size, _target)`` from one row per source with its size.

    The sources in code point order, null last, weigh ``weights``, repeating. What
    goes beyond ``most`` times a source's size is shared anew among the others by
    weight, until no target is above; each round is one sum over the sources.
    """
    ranked = sizes.withColumn("_all", F.lit(0))
    ranked = _positions(ranked, ["_all"], [F.col("_all"), F.col("_null"), F.col("_key")], "ranks")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_pos") % len(weights) + 1).cast("int"))
    weighed = materialize(ranked.select("_null", "_key", "_size", weight.alias("_weight")), "weights")
    total = weighed.agg(F.sum("_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = F.lit(False) if capped < 0 else F.col("_size") * most <= F.col("_weight") * level
        n, spent, free = weighed.agg(
            F.count_if(above), F.sum(F.when(above, F.col("_size") * most)), F.sum(F.when(~above, F.col("_weight"))),
        ).first()
        if n == capped or not free:
            break
        capped, level = n, (total - (spent or 0)) / free
    return weighed.withColumn(
        "_target", F.least((F.col("_size") * most).cast("double"), F.col("_weight") * F.lit(float(level))))


def mix_sources(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
                weights: tuple[int, ...] = WEIGHTS, most: int = 3, seed: int = 0,
                size_column: str | None = None) -> DataFrame:
    """All columns of the documents and ``size, source_size, target, copies, taken``.

    ``size`` counts words, unless ``size_column`` has the sizes; ``taken`` is ``copies * size``. No document is copied more
    than ``most`` times. Documents stand within their source by size, id and a hash of
    all columns, so reruns agree; equal rows are told apart only by their number. Null
    texts have size 0, null sources are one source, null ids come first. A source
    without words has target 0 and no copies. Columns of the documents with the names
    added here are replaced. An empty table gives an empty result.
    """
    added = ["size", "source_size", "target", "copies", "taken"]
    own = [c for c in docs.columns if c not in added or c in (id_column, text_column, source_column)]
    words = word_count(F.col(text_column)) if size_column is None else F.col(size_column).cast("bigint")
    rows = docs.select(
        *own, F.col(source_column).isNull().alias("_null"),
        F.coalesce(F.col(source_column).cast("string"), F.lit("")).alias("_key"),
        words.alias("_words"), F.xxhash64(*own).alias("_tie"),
    )
    order = [F.col("_null"), F.col("_key"), F.col("_words"), F.col(id_column), F.col("_tie")]
    placed = _positions(rows, ["_null", "_key"], order, "mixing")
    sizes = placed.groupBy("_null", "_key").agg(F.sum("_words").alias("_size"))
    targets = source_targets(sizes, weights, most)
    rate = F.when(F.col("_size") > 0, F.col("_target") / F.col("_size")).otherwise(0.0)
    name = F.concat(F.lit(f"{seed}|"), F.when(F.col("_null"), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("_key"))))
    offset = F.conv(F.substring(F.md5(name), 1, 5), 16, 10).cast("double") / (1 << 20)
    crossed = F.floor(offset + (F.col("_pos") + 1) * rate) - F.floor(offset + F.col("_pos") * rate)
    copies = F.least(crossed, F.lit(most)).cast("bigint")
    return placed.join(targets, ["_null", "_key"]).select(
        *[c for c in own if c not in added], F.col("_words").alias("size"), F.col("_size").alias("source_size"),
        F.col("_target").alias("target"), copies.alias("copies"), (copies * F.col("_words")).alias("taken"),
    )


def emit(mixed: DataFrame) -> DataFrame:
    """One row per copy taken, with its number ``copy`` from 1 on."""
    return mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
