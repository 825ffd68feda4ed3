"""Quality by hierarchical empirical Bayes.

A logistic regression on the shape of a text gives each document its own evidence. The
evidence is summed per host and per path of a host; a host is shrunk toward the mean of
all, a path toward its host, the more the fewer documents it has. How strongly is
estimated from the spread between groups. A document's score combines its evidence with
the posterior of its path, in which the document itself does not count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorferry.llm import kernels
from vectorferry.llm.store import materialize

SHAPE = ("log_words", "word_length", "upper", "symbols", "digits", "distinct", "repeated", "adjacent", "single", "ended")


@dataclass(frozen=True)
class Model:
    """Standardised logistic regression; ``prior`` is the share of good texts it was fitted on."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def evidence(self, shape: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio of good to bad."""
        raw = ((shape - self.mean) / self.scale) @ self.weights + self.bias
        return np.clip(raw - np.log(self.prior / (1 - self.prior)), -30, 30)


def shapes(data: np.ndarray, offsets: np.ndarray, tables) -> np.ndarray:
    """One row of ``SHAPE`` per text."""
    words = kernels.Words(data, offsets, *tables)
    texts = len(offsets) - 1
    n = np.maximum(words.counts, 1).astype(np.float64)
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)

    def share(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return (total[offsets[1:]] - total[offsets[:-1]]) / size

    def per_word(flag: np.ndarray) -> np.ndarray:
        return np.bincount(words.owner, flag, minlength=texts) / n

    upper = (data >= 65) & (data <= 90)
    digit = (data >= 48) & (data <= 57)
    letter = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
    symbol = ~letter & ~digit & ~kernels.separator_table((9, 10, 11, 12, 13, 32, 44, 46))[data]
    length = words.ends - words.starts
    order = np.lexsort((words.hashes, words.owner))
    hashes, owner = words.hashes[order], words.owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    kinds = np.bincount(owner[new], minlength=texts)
    run = np.diff(np.append(np.flatnonzero(new), len(hashes)))
    most = np.zeros(texts)
    np.maximum.at(most, owner[new], run)
    same = np.zeros(len(words.hashes), bool)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.owner[1:] == words.owner[:-1])
    last = data[np.maximum(words.ends - 1, 0)] if len(words.ends) else np.zeros(0, np.uint8)
    return np.stack([
        np.log1p(words.counts), per_word(length), share(upper), share(symbol), share(digit), kinds / np.sqrt(n),
        most / n, per_word(same), per_word(length == 1), per_word((last == 46) | (last == 44)),
    ], axis=1)


def _tables():
    return kernels.byte_codes(), kernels.Powers(), kernels.separator_table()


def _shape_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = _tables()
    for rows, data, offsets in kernels.chunks(batches):
        found = shapes(data, offsets, tables)
        yield pa.RecordBatch.from_arrays([
            rows.column("id"),
            pa.ListArray.from_arrays(np.arange(0, found.size + 1, len(SHAPE), dtype=np.int32), pa.array(found.reshape(-1))),
        ], names=["id", "shape"])


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          label_column: str = "quality", most_rows: int = 20_000, rounds: int = 60, ridge: float = 1.0) -> Model:
    """Fit the regression by Newton steps on a sample of about ``most_rows`` labelled rows.

    The driver gets ``len(SHAPE)`` numbers per row of the sample. Rows with a null id
    or label teach nothing; of several labels of an id the largest counts. Without
    labels of both kinds all evidence is 0.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label")).filter(
        "id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    share = most_rows / max(most_rows, known.count())
    picked = known.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000)).limit(2 * most_rows)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(F.broadcast(picked), "id")
    kind = rows.schema["id"].dataType.simpleString()
    shaped = rows.select("id", "text").mapInArrow(_shape_task, f"id {kind}, shape array<double>")
    sample = shaped.join(F.broadcast(picked), "id").select("label", "shape").toPandas()
    width = len(SHAPE)
    flat = Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.5)
    if sample["label"].nunique() < 2:
        return flat
    x, y = np.stack(sample["shape"].to_numpy()), sample["label"].to_numpy(np.float64)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    design = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1)
    penalty = np.diag([ridge] * width + [1e-6])
    w = np.zeros(width + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (y - p) - penalty @ w
        step = np.linalg.solve((design * (p * (1 - p) + 1e-9)[:, None]).T @ design + penalty, slope)
        w += step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return Model(mean, scale, w[:-1], float(w[-1]), float(y.mean()))


def _evidence_task(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables()
        for rows, data, offsets in kernels.chunks(batches):
            evidence = model.evidence(shapes(data, offsets, tables))
            evidence[offsets[1:] == offsets[:-1]] = 0.0
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), rows.column("host"), rows.column("path"), pa.array(evidence)],
                names=["id", "host", "path", "evidence"])
    return run


def _logit(p: Column) -> Column:
    held = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(held / (1 - held))


def _strength(groups: DataFrame, mean: Column, n: str = "n", total: str = "total") -> float:
    """Documents that the prior of a level counts for, by the method of moments.

    The less groups differ beyond what chance gives for their size, the stronger.
    """
    inside = mean * (1 - mean)
    row = groups.filter(F.col(n) > 1).select(
        F.pow(F.col(total) / F.col(n) - mean, 2).alias("spread"), (inside / F.col(n)).alias("chance"), inside.alias("v"),
    ).agg(F.avg("spread"), F.avg("chance"), F.avg("v")).first()
    if row[0] is None or row[2] is None or row[0] - row[1] <= 0:
        return 1000.0
    return float(min(1000.0, max(2.0, row[2] / (row[0] - row[1]) - 1)))


def score_quality(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text",
                  host: Column | None = None, path: Column | None = None, threshold: float = 0.5) -> DataFrame:
    """``(id_column, score, good, evidence, path_posterior, host_posterior)`` of each row.

    ``host`` and ``path`` are string columns, by default ``source`` and ``lang``; a null
    one is a group of its own. ``evidence`` is a log-likelihood ratio, 0 for a null or
    empty text. The posteriors are means over the documents beside this one. Each row
    has its own result, also if rows repeat or have a null id. Other columns are not
    read. An empty table gives an empty result.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"),
        F.coalesce(F.concat(F.lit("s"), host.cast("string")), F.lit("n")).alias("host"),
        F.coalesce(F.concat(F.lit("s"), path.cast("string")), F.lit("n")).alias("path"))
    kind = rows.schema["id"].dataType.simpleString()
    prior = model.prior
    own = materialize(
        rows.mapInArrow(_evidence_task(model), f"id {kind}, host string, path string, evidence double")
        .withColumn("p", 1 / (1 + F.exp(-(F.col("evidence") + F.lit(float(np.log(prior / (1 - prior)))))))),
        "evidence")
    paths = own.groupBy("host", "path").agg(F.count("p").alias("n"), F.sum("p").alias("total"))
    paths = materialize(paths, "paths")
    hosts = materialize(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "hosts")
    overall = hosts.agg(F.sum("total") / F.sum("n")).first()[0]
    mean = F.lit(float(overall) if overall is not None else prior)
    k_host = _strength(hosts, mean)
    shrunk = hosts.select("host", F.col("n").alias("host_n"), F.col("total").alias("host_total"),
                          ((F.col("total") + k_host * mean) / (F.col("n") + k_host)).alias("host_mean"))
    joined = paths.join(shrunk, "host")
    k_path = _strength(joined, F.col("host_mean"))
    merged = own.join(joined, ["host", "path"])
    host_posterior = (F.col("host_total") - F.col("p") + k_host * mean) / (F.col("host_n") - 1 + k_host)
    path_posterior = (F.col("total") - F.col("p") + k_path * host_posterior) / (F.col("n") - 1 + k_path)
    score = 1 / (1 + F.exp(-(F.col("evidence") + _logit(path_posterior))))
    return merged.select(
        F.col("id").alias(id_column), score.alias("score"), (score >= threshold).alias("good"), "evidence",
        path_posterior.alias("path_posterior"), host_posterior.alias("host_posterior"))
