"""Scores of texts under a smoothed n-gram model, read as a weighted backoff automaton.

The model is never held in one place. Every task cuts its texts into blocks; a block asks
for the counts of its own distinct n-grams, sorted, packed and dealt by ranges of their
hashes. Where a range meets, counts of all blocks are added up and each block is sent its
totals in the order it asked in. A block then compiles the part of the automaton that its
texts can reach: contexts seen in training are states, seen n-grams arcs, and a failure
arc leads to the context without its first word. One pass from left to right over each
text carries the state and adds up weights.

Smoothing (a Dirichlet prior): ``p(w|h) = (c(hw) + k p(w|h')) / (c(h) + k)``, where ``h'`` is
``h`` without its first word; without a context ``(c(w) + 1) / (N + V + 1)``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorferry.llm.kernels import Powers, Words, byte_codes, chunks, mix64, separator_table
from vectorferry.llm.store import materialize

ORDER = 3
PRIOR = 32.0
BLOCK_BYTES = 8 << 20  # text of a block; its n-grams are held in one task
RANGE_GRAMS = 1 << 20  # n-grams of all blocks that meet in one range, about
UNIT = 1e9  # weights are whole billionths, so a sum does not depend on its order

BEGIN, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_FACTORS = [np.uint64(pow(0x9FB21C651E98DF25, j + 1, 1 << 64)) for j in range(8)]

REQUEST = "part bigint, block bigint, n int, grams binary, counts binary"
TOTALS = "block bigint, part bigint, n int, totals binary, kinds bigint, tokens bigint"
STREAM = "block bigint, texts binary, vocabulary binary"


# -- packing ----------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, n * 8, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(n)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n), dtype=np.uint64)


# -- blocks -----------------------------------------------------------------------


class Block:
    """Tokens of some texts: hashes of words, an end after each text, and the texts' lengths."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray):
        self.lengths = lengths
        self.first = np.concatenate([[0], np.cumsum(lengths)])
        self.vocabulary, self.words = np.unique(hashes, return_inverse=True)
        self.place = np.arange(len(hashes)) - np.repeat(self.first[:-1], lengths)

    @classmethod
    def of(cls, hashes: list[np.ndarray], counts: list[np.ndarray]) -> Block:
        words, lengths = np.concatenate(hashes), np.concatenate(counts) + 1
        tokens = np.empty(int(lengths.sum()), np.uint64)
        ends = np.zeros(len(tokens), bool)
        ends[np.cumsum(lengths) - 1] = True
        tokens[ends], tokens[~ends] = END, words
        return cls(tokens, lengths)

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct n-grams as sorted hashes, where each stands first, and the n-gram of each place.

        An n-gram ends at its place; before a text stands one beginning. The last array
        holds the places that have one.
        """
        tokens = self.vocabulary[self.words]
        at = np.flatnonzero(self.place >= size - 2)
        if size == 1:
            keys = tokens
        else:
            keys = np.full(len(at), np.uint64(size))
            for back in range(size):
                own = tokens[at - back]
                own[self.place[at] - back == -1] = BEGIN
                keys += own * _FACTORS[back]
            keys = mix64(keys)
        distinct, first, index = np.unique(keys, return_index=True, return_inverse=True)
        return distinct, at[first], index, at


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[Block, pa.Table]]:
    """Blocks of about ``block_bytes`` of text in the order of the rows; a longer text is a block alone."""
    codes, powers, separators = byte_codes(), Powers(), separator_table()
    rows, hashes, counts, size = [], [], [], 0
    for rows_, data, offsets in chunks(batches, "_text"):
        if size and size + len(data) > block_bytes:
            yield Block.of(hashes, counts), pa.Table.from_batches(rows)
            rows, hashes, counts, size = [], [], [], 0
        words = Words(data, offsets, codes, powers, separators)
        rows.append(rows_.select([n for n in rows_.schema.names if n != "_text"]))
        hashes.append(words.hashes)
        counts.append(words.counts)
        size += len(data)
    if rows:
        yield Block.of(hashes, counts), pa.Table.from_batches(rows)


def _number(place: int) -> int:
    return (TaskContext.get().partitionId() << 32) + place


def _request_task(order: int, ranges: int, block_bytes: int):
    """What each block asks for: its distinct n-grams and how often its training texts hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (block, rows) in enumerate(_blocks(batches, block_bytes)):
            taught = np.repeat(rows.column("_train").to_numpy(zero_copy_only=False).astype(bool), block.lengths)
            for size in range(1, order + 1):
                keys, _, index, at = block.grams(size)
                own = np.bincount(index[taught[at]], minlength=len(keys))
                part = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                found, start = np.unique(part, return_index=True)
                edges = [*start.tolist(), len(keys)]
                slices = list(zip(edges[:-1], edges[1:]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(found.astype(np.int64) + size * ranges),
                    pa.array([_number(number)] * len(slices), pa.int64()),
                    pa.array([b - a for a, b in slices], pa.int32()),
                    pa.array([pack_sorted(keys[a:b]) for a, b in slices], pa.binary()),
                    pa.array([pack(own[a:b]) for a, b in slices], pa.binary()),
                ], names=["part", "block", "n", "grams", "counts"])

    return run


def _add_up(asked: pa.Table) -> pa.Table:
    """Totals of one range over all blocks, sent back in the order each block asked in."""
    sizes = asked.column("n").to_pylist()
    keys = np.concatenate([unpack_sorted(g, n) for g, n in zip(asked.column("grams").to_pylist(), sizes)])
    own = np.concatenate([unpack(c, n) for c, n in zip(asked.column("counts").to_pylist(), sizes)])
    distinct, index = np.unique(keys, return_inverse=True)
    totals = np.zeros(len(distinct), np.int64)
    np.add.at(totals, index, own.astype(np.int64))
    answers, edges = totals[index], np.concatenate([[0], np.cumsum(sizes)])
    once = np.zeros(len(sizes), np.int64)
    kinds, tokens = once.copy(), once
    kinds[0], tokens[0] = (totals > 0).sum(), totals.sum()
    return pa.table({
        "block": asked.column("block"), "part": asked.column("part"), "n": asked.column("n"),
        "totals": pa.array([pack(answers[a:b]) for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
        "kinds": pa.array(kinds), "tokens": pa.array(tokens),
    })


def _stream_task(block_bytes: int):
    """Blocks as numbers of words: what is needed of the texts, without the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for number, (block, rows) in enumerate(_blocks(batches, block_bytes)):
            offsets = pa.array(block.first.astype(np.int64))
            words = pa.LargeListArray.from_arrays(offsets, pa.array(block.words.astype(np.int32)))
            table = rows.append_column("_words", words).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
                writer.write_table(table)
            yield pa.RecordBatch.from_arrays([
                pa.array([_number(number)], pa.int64()),
                pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                pa.array([pack_sorted(block.vocabulary)], pa.binary()),
            ], names=["block", "texts", "vocabulary"])

    return run


# -- automaton --------------------------------------------------------------------


def _weight(chance: np.ndarray) -> np.ndarray:
    return np.rint(np.log10(chance) * UNIT).astype(np.int64)


class Automaton:
    """States, arcs and failure arcs that the texts of one block can reach.

    State 0 is the empty context, state 1 the beginning of a text; then come the distinct
    n-grams of the block by size. ``totals`` are counts in training by size, in the order of
    ``Block.grams``; ``tokens``, ``kinds`` and ``texts`` are the numbers of training tokens,
    distinct ones, and training texts.
    """

    def __init__(self, block: Block, totals: list[np.ndarray], tokens: int, kinds: int, texts: int, prior: float):
        order = len(totals)
        words = len(block.vocabulary)
        self.words = words
        self.root = _weight((totals[0] + 1) / (tokens + kinds + 1))
        last = block.vocabulary == END
        self.root_next = np.where((totals[0] > 0) & ~last & (order > 1), 2 + np.arange(words), 0)
        chance = (totals[0] + 1) / (tokens + kinds + 1)
        at = [0, 0, 2]  # first state of the contexts of one word less than the place in this list
        for t in totals[:-1]:
            at.append(at[-1] + len(t))
        self.fail = np.zeros(at[order + 1], np.int64)  # weight of the failure arc of each state
        self.back = np.zeros(at[order + 1], np.int64)  # and where it leads
        self.fail[1] = _weight(np.array([prior / (texts + prior)]))[0]
        self.start = 1 if texts > 0 and order > 1 else 0
        keys, weights, targets = [], [], []
        index = block.words  # the shorter n-gram that ends at each place
        self._failures(at, 1, totals[0], prior, np.zeros(words, np.int64))
        for size in range(2, order + 1):
            count = totals[size - 1]
            _, first, gram, places = block.grams(size)
            low = index[first]
            begins = block.place[first] == 0
            before = np.where(begins, 0, index[first - 1])
            context = np.where(begins, 1, at[size] + before)
            seen = np.where(begins, texts, totals[size - 2][before])
            chance = (count + prior * chance[low]) / (seen + prior)
            if size < order:
                self._failures(at, size, count, prior, at[size] + low)
            word = block.words[first]
            onward = (at[size + 1] + np.arange(len(count))) if size < order else at[size] + low
            known = count > 0
            keys.append((context * words + word)[known])
            weights.append(_weight(chance)[known])
            targets.append(np.where(last[word], 0, onward)[known])
            following = np.full(len(block.words), -1)
            following[places] = gram
            index = following
        none = [np.zeros(0, np.int64)]
        self.arc = np.concatenate(keys or none)
        by = np.argsort(self.arc)
        self.arc, self.arc_weight, self.arc_next = (
            self.arc[by], np.concatenate(weights or none)[by], np.concatenate(targets or none)[by])

    def _failures(self, at: list[int], size: int, count: np.ndarray, prior: float, back: np.ndarray) -> None:
        """Failure arcs of the contexts of one size, each to its suffix."""
        if at[size + 1] < len(self.fail):
            own = slice(at[size + 1], at[size + 1] + len(count))
            self.fail[own] = _weight(prior / (count + prior))
            self.back[own] = back

    def score(self, block: Block) -> np.ndarray:
        """Sum of the weights along each text, from left to right; texts advance side by side."""
        sums = np.zeros(len(block.lengths), np.int64)
        order = np.argsort(-block.lengths, kind="stable")
        first, length = block.first[:-1][order], block.lengths[order]
        state = np.full(len(order), self.start, np.int64)
        total = np.zeros(len(order), np.int64)
        active = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), side="left")
        for step, n in enumerate(active.tolist()):
            word = block.words[first[:n] + step]
            open_ = np.flatnonzero(state[:n])
            state_now = state[:n]
            done = np.zeros(n, bool)
            while len(open_):
                wanted = state_now[open_] * self.words + word[open_]
                found = np.searchsorted(self.arc, wanted)
                hit = found < len(self.arc)
                hit[hit] = self.arc[found[hit]] == wanted[hit]
                there = open_[hit]
                total[there] += self.arc_weight[found[hit]]
                state_now[there] = self.arc_next[found[hit]]
                done[there] = True
                lost = open_[~hit]
                total[lost] += self.fail[state_now[lost]]
                state_now[lost] = self.back[state_now[lost]]
                open_ = lost[state_now[lost] > 0]
            rest = np.flatnonzero(~done)
            total[rest] += self.root[word[rest]]
            state_now[rest] = self.root_next[word[rest]]
        sums[order] = total
        return sums


def _score_task(order: int, ranges: int, tokens: int, kinds: int, texts: int, prior: float, names: list[str]):
    """Compile the automaton of one block and run its texts through it."""

    def run(stream: pa.Table, answers: pa.Table) -> pa.Table:
        if stream.num_rows != 1:
            raise RuntimeError("a block was cut otherwise when it was read again")
        table = pa.ipc.open_stream(stream.column("texts")[0].as_py()).read_all().combine_chunks()
        lists = table.column("_words").chunk(0)
        lengths = np.diff(lists.offsets.to_numpy())
        words = lists.values.to_numpy()
        block = Block.__new__(Block)
        block.lengths, block.words = lengths, words.astype(np.int64)
        block.first = np.concatenate([[0], np.cumsum(lengths)])
        block.place = np.arange(len(words)) - np.repeat(block.first[:-1], lengths)
        block.vocabulary = unpack_sorted(stream.column("vocabulary")[0].as_py(), int(words.max()) + 1)
        totals: list[list[np.ndarray]] = [[] for _ in range(order)]
        for part, n, packed in sorted(zip(*(answers.column(c).to_pylist() for c in ("part", "n", "totals")))):
            totals[part // ranges - 1].append(unpack(packed, n).astype(np.int64))
        counts = [np.concatenate(t) if t else np.zeros(0, np.int64) for t in totals]
        if len(counts[0]) != len(block.vocabulary):
            raise RuntimeError("a block was cut otherwise when it was read again")
        automaton = Automaton(block, counts, tokens, kinds, texts, prior)
        starts = block.first[:-1]
        known = np.add.reduceat((counts[0] > 0)[block.words].astype(np.int64), starts)
        base = np.add.reduceat(automaton.root[block.words], starts)
        result = table.select(names)
        for name, column in (
            ("n_tokens", lengths.astype(np.int64)), ("n_known", known),
            ("train_tokens", np.full(len(lengths), tokens)),
            ("base_score", base / UNIT), ("score", automaton.score(block) / UNIT),
        ):
            result = result.append_column(name, pa.array(column))
        return result

    return run


def score_texts(
    docs: DataFrame,
    train: Column,
    text_column: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    order: int = ORDER,
    prior: float = PRIOR,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``keep`` columns of each row with the log10 probability of its whole text.

    ``train`` says which rows the model learns from. A-Z are lower-cased; tokens are runs of
    ``[^\\x20\\x09-\\x0D]`` and one end. ``n_tokens`` counts them, ``n_known`` those seen in
    training, ``train_tokens`` all training tokens; ``base_score`` is the score without
    contexts. ``prior`` is the weight of the shorter context, as a number of tokens.

    A null or empty text is one end. Repeated rows each have their own result, and each counts
    in training. Where ``train`` is null the row is not learned from. Without training rows all
    words are unknown; an empty table gives no rows. Names of other columns do not matter.

    Nothing is cut off or left out: all n-grams of all training texts count, in tables that
    Spark deals out by hash. ``docs`` is read twice and must be dealt to tasks alike both
    times, as files are; materialize anything else first. A block that differs is an error.
    """
    if order < 1 or order > len(_FACTORS):
        raise ValueError(f"order must be 1 to {len(_FACTORS)}")
    names = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(
        *[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text_column).alias("_text"),
        F.coalesce(train, F.lit(False)).alias("_train"))
    size, texts = rows.agg(F.sum(F.octet_length("_text")), F.count_if("_train")).first()
    # a block has at most one distinct n-gram of each size for each word
    ranges = max(1, math.ceil((size or 0) / 6 / RANGE_GRAMS))
    asked = rows.select("_text", "_train").mapInArrow(_request_task(order, ranges, block_bytes), REQUEST)
    most = 8 * docs.sparkSession.sparkContext.defaultParallelism
    dealt = asked.repartition(min(order * ranges, most), "part")
    totals = materialize(dealt.groupBy("part").applyInArrow(_add_up, TOTALS), "ngram-totals")
    kinds, tokens, blocks = totals.filter(F.col("part") < 2 * ranges).agg(
        F.sum("kinds"), F.sum("tokens"), F.count_distinct("block")).first()
    spread = max(1, min(blocks, most))
    streams = rows.mapInArrow(_stream_task(block_bytes), STREAM).repartition(spread, "block")
    answers = totals.select("block", "part", "n", "totals").repartition(spread, "block")
    kept = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    schema = f"{kept}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    scored = streams.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score_task(order, ranges, tokens or 0, kinds or 0, texts or 0, prior, names), schema)
    return scored.select(
        *[F.col(n).alias(c) for c, n in zip(keep, names)], "n_tokens", "n_known", "train_tokens", "base_score", "score")
