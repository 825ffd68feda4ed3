"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate. Lines that occur too seldom are left
out by a plain count. For the others HyperLogLog sketches of the sites are merged per
line hash; only lines whose estimate lies near the threshold get an exact distinct
count. The first occurrence of a boilerplate line stays, all others are removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorferry.llm.store import materialize


@dataclass(frozen=True)
class Spread:
    """A line is boilerplate from ``sites`` distinct sites on; a long one from ``long_sites`` on,
    as lines of ``long_chars`` characters do not recur by chance."""

    sites: int = 8
    long_sites: int = 3
    long_chars: int = 200
    log2_registers: int = 12

    @property
    def margin(self) -> float:
        """Four standard errors of the sketch."""
        return 4 * 1.04 / 2 ** (self.log2_registers / 2)


def _trimmed(line):
    return F.btrim(line, F.lit(" \t\r"))


def document_lines(docs: DataFrame, id_column: str, text_column: str, site_column: str) -> DataFrame:
    """``(id, site, pos, h, g, long)`` of all lines that are not blank."""
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.concat(F.lit("s"), F.col(site_column).cast("string")), F.lit("n")).alias("site"),
        F.posexplode(F.split(F.col(text_column), "\n", -1)).alias("pos", "line"),
    ).withColumn("line", _trimmed("line")).filter("line <> ''")
    return rows.select("id", "site", "pos", F.xxhash64("line").alias("h"), F.hash("line").alias("g"),
                       F.length("line").alias("chars"))


def boilerplate(lines: DataFrame, setting: Spread) -> DataFrame:
    """``(h, g)`` of the lines that are on enough sites."""
    key = ["h", "g"]
    needed = F.when(F.col("chars") >= setting.long_chars, setting.long_sites).otherwise(setting.sites)
    sketched = materialize(
        lines.groupBy(*key).agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", setting.log2_registers)).alias("about"),
            F.max(needed).alias("needed"),
        ), "sketches",
    )
    over = sketched.filter(F.col("about") > F.col("needed") * (1 + setting.margin) + 0.5).select(*key)
    near = sketched.filter(
        (F.col("about") <= F.col("needed") * (1 + setting.margin) + 0.5)
        & (F.col("about") >= F.col("needed") * (1 - setting.margin) - 0.5))
    exact = lines.join(near, key).groupBy(*key, "needed", "site").agg(F.lit(1).alias("one"))
    exact = exact.groupBy(*key, "needed").agg(F.count("one").alias("sites")).filter("sites >= needed").select(*key)
    return over.unionByName(exact)


def _without(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        at = batch.schema.get_field_index("_text")
        texts = batch.column(at).to_pylist()
        gone = batch.column("_gone").to_pylist()
        for i, places in enumerate(gone):
            if places:
                places = set(places)
                texts[i] = "\n".join(x for j, x in enumerate(texts[i].split("\n")) if j not in places)
        names = [n for n in batch.schema.names if n != "_gone"]
        columns = [pa.array(texts, pa.string()) if n == "_text" else batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", site_column: str = "source",
                setting: Spread = Spread()) -> DataFrame:
    """All columns of the documents, the text without repeated boilerplate, and
    ``n_lines`` and ``n_removed``.

    Lines are compared without blanks around them; ``n_lines`` counts those that are
    not blank. Of a boilerplate line the occurrence with the smallest ``(id, place)``
    stays. Null sites are one site. A null text stays null and has no lines. Rows of
    one id are one document: what is removed from one is removed from all. Rows with
    a null id count for the spread, but are left as they are. Columns named
    ``n_lines`` or ``n_removed`` are replaced. An empty table gives an empty result.
    """
    lines = document_lines(docs, id_column, text_column, site_column)
    least = min(setting.sites, setting.long_sites)
    # tables of their own, so that a join with them can be split where a line is very frequent
    often = materialize(
        lines.groupBy("h", "g").agg(F.count("pos").alias("n")).filter(F.col("n") >= least).select("h", "g"), "often")
    shared = materialize(lines.join(often, ["h", "g"], "left_semi"), "lines")
    spread = boilerplate(shared, setting)
    marked = materialize(shared.join(spread, ["h", "g"], "left_semi").filter("id is not null"), "marked")
    first_id = materialize(marked.groupBy("h", "g").agg(F.min("id").alias("first")), "first")
    first = materialize(
        marked.join(first_id, ["h", "g"]).filter("id = first").groupBy("h", "g", "first").agg(F.min("pos").alias("place")),
        "first")
    gone = marked.join(first, ["h", "g"]).filter("not (id = first and pos = place)").select("id", "pos").distinct()
    gone = gone.groupBy("id").agg(F.sort_array(F.collect_list("pos")).alias("_gone")).withColumnRenamed("id", "_id")

    own = [c for c in docs.columns if c not in ("n_lines", "n_removed") or c in (id_column, text_column, site_column)]
    counted = F.size(F.filter(F.split(F.coalesce(text_column, F.lit("")), "\n", -1), lambda x: _trimmed(x) != ""))
    rows = docs.select(*own, counted.cast("bigint").alias("_lines"))
    joined = rows.join(gone, rows[id_column] == gone["_id"], "left").drop("_id")
    joined = joined.withColumn("_removed", F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint"))
    renamed = joined.withColumnRenamed(text_column, "_text")
    schema = renamed.drop("_gone").schema
    cleaned = renamed.mapInArrow(_without, schema).withColumnRenamed("_text", text_column)
    return cleaned.select(*[c for c in own if c not in ("n_lines", "n_removed")], F.col("_lines").alias("n_lines"),
                          F.col("_removed").alias("n_removed"))
