"""Language identification of whole, possibly mixed texts.

Letters tell their script by code point ranges, and a word's script leaves only the
languages that were seen in it. Each word gets a score per language from letter
trigrams; a Viterbi path over the words, with a penalty for each switch, labels the
spans of a text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
PART_BYTES = 1 << 18  # text whose letters are held in arrays at a time; a longer text is held alone
SIDE_BY_SIDE = 16  # chunks of texts whose paths advance together
PLANES = 0x20000  # code points that the letter tables cover; later ones are looked at one by one

# First and last code points of scripts, by the Unicode blocks.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
}


RESULT = "lang_pred string, score double, confidence double, spans array<struct<begin: long, end: long, lang: string>>"

DOUBT = 2.0  # by how much a word's letters must look random, as a log-ratio, before it counts against a text
LEAST_CONFIDENCE = 0.25


@dataclass(frozen=True)
class Model:
    """Languages in code point order, log-probabilities of trigrams, and scripts per language.

    Trigrams are true keys, three code points of 21 bits, in a hash table with open places:
    ``slots`` has the keys and ``rows`` their rows in ``weights``, whose first row stands for any
    trigram not seen. The table has four places for each trigram that was seen.

    ``letters`` has the log-probability of each letter in any language, place 0 that of a word's edge.
    """

    languages: tuple[str, ...]
    weights: np.ndarray  # float32, 1 + trigrams x languages
    slots: np.ndarray  # uint64, a power of two
    rows: np.ndarray  # int32
    scripts: np.ndarray  # bool, scripts + 1 (other) x languages
    letters: np.ndarray  # float32, by code point; the last place stands for those beyond the tables
    kinds: int  # letters seen, and the edge

    def place(self, keys: np.ndarray) -> np.ndarray:
        """Row of each trigram; 0 if it was not seen."""
        at = _slot(keys, len(self.slots))
        held = self.slots[at]
        row = np.where(held == keys, self.rows[at], 0)
        open_ = np.flatnonzero((held != keys) & (held != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
            held = self.slots[at[open_]]
            row[open_] = np.where(held == keys[open_], self.rows[at[open_]], 0)
            open_ = open_[(held != keys[open_]) & (held != 0)]
        return row


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def _table(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and rows of distinct keys, the first of them in row 1."""
    size = 1 << max(4, (4 * len(keys)).bit_length())
    slots, rows = np.zeros(size, np.uint64), np.zeros(size, np.int32)
    left, at = np.arange(len(keys)), _slot(keys, size)
    while len(left):
        free = np.flatnonzero(slots[at[left]] == 0)
        _, first = np.unique(at[left][free], return_index=True)
        put = left[free[first]]
        slots[at[put]], rows[at[put]] = keys[put], put + 1
        left = np.setdiff1d(left, put, assume_unique=True)
        at[left] = (at[left] + 1) & (size - 1)
    return slots, rows


class Letters:
    """Tables by code point: lower case, letter or not, script."""

    def __init__(self) -> None:
        points = [chr(i) for i in range(PLANES)]
        self.lower = np.arange(PLANES, dtype=np.uint32)
        self.letter = np.zeros(PLANES, bool)
        for i, c in enumerate(points):
            if c.isalpha():
                self.letter[i] = True
                low = c.lower()
                if len(low) == 1:
                    self.lower[i] = ord(low)
        self.script = np.full(PLANES, len(SCRIPTS), np.uint8)
        for number, ranges in enumerate(SCRIPTS.values()):
            for first, last in ranges:
                self.script[first: last + 1] = number

    def decode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Folded code points of texts with one break after each, letters or not, first places."""
        points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(lengths + 1, out=first[1:])
        low = np.minimum(points, PLANES - 1)
        letter = self.letter[low]
        for i in np.flatnonzero(points >= PLANES):
            letter[i] = chr(points[i]).isalpha()
        return np.where(points < PLANES, self.lower[low], points), letter, first


class LetterWords:
    """Runs of letters of texts: ranges, owners, scripts; of each letter its place in the tables and trigram."""

    def __init__(self, tables: Letters, texts: list[str]):
        points, letter, self.first = tables.decode(texts)
        edge = np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.owner = np.searchsorted(self.first, self.starts, side="right") - 1
        self.script = tables.script[np.minimum(points[self.starts], PLANES - 1)]
        self.letters = np.minimum(points[letter], PLANES - 1)
        symbol = np.where(letter, points, 0).astype(np.uint64)
        key = symbol << np.uint64(21)
        key[1:] |= symbol[:-1] << np.uint64(42)
        key[:-1] |= symbol[1:]
        self.trigrams = key[letter]
        self.lengths = self.ends - self.starts
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])


def _parts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Slices of batches with about ``PART_BYTES`` of text; a longer text is held alone."""
    for batch in batches:
        sizes = np.cumsum([0, *pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()])
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(sizes, sizes[first] + PART_BYTES, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last
    give_back()


def give_back() -> None:
    """Free memory goes back to the system: a Python worker lives on after its task, beside the next one's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _texts(batch: pa.RecordBatch, text: str) -> list[str]:
    return [t or "" for t in batch.column(text).to_pylist()]


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram and script counts per language, and counts of letters, of what one task reads."""
    tables = Letters()
    grams: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    scripts: dict[str, np.ndarray] = {}
    letters_seen = np.zeros(PLANES, np.int64)
    for part in _parts(batches, "text"):
        words = LetterWords(tables, _texts(part, "text"))
        language = np.array(part.column("lang").to_pylist(), object)
        letters_seen += np.bincount(words.letters, minlength=PLANES)
        letters_seen[0] += len(words.starts)
        for name in sorted(set(language.tolist())):
            own = (language == name)[words.owner]
            letters = np.repeat(own, words.lengths)
            found, n = np.unique(words.trigrams[letters], return_counts=True)
            known, before = grams.get(name, (found[:0], n[:0]))
            both, place = np.unique(np.concatenate([known, found]), return_inverse=True)
            grams[name] = both, np.bincount(place, np.concatenate([before, n]), len(both)).astype(np.int64)
            scripts.setdefault(name, np.zeros(len(SCRIPTS) + 1, np.int64))
            scripts[name] += np.bincount(words.script[own], minlength=len(SCRIPTS) + 1)
    sparse = [("gram", name, *counts) for name, counts in grams.items()]
    for kind, name, values in [*(("script", n, v) for n, v in scripts.items()), ("letter", "", letters_seen)]:
        at = np.flatnonzero(values)
        sparse.append((kind, name, at, values[at]))
    for kind, name, keys, n in sparse:
        yield pa.RecordBatch.from_arrays([
            pa.array([kind] * len(keys), pa.string()), pa.array([name] * len(keys), pa.string()),
            pa.array(keys.astype(np.int64)), pa.array(n, pa.int64()),
        ], names=["kind", "lang", "key", "n"])


def train(labelled: DataFrame, text_column: str = "text", lang_column: str = "lang", smoothing: float = 0.5,
          least_script_share: float = 0.001) -> Model:
    """Count letter trigrams per language over all rows with a language.

    Each task sends its own sums; the driver gets one number per language and distinct
    trigram, and one per letter: as many as the alphabets have, not as the texts.
    """
    rows = labelled.select(F.col(text_column).alias("text"), F.col(lang_column).alias("lang")).filter(
        "lang is not null and text is not null")
    counts = rows.mapInArrow(_count_task, "kind string, lang string, key long, n long").groupBy(
        "kind", "lang", "key").agg(F.sum("n").alias("n")).toPandas()
    letter_counts = counts[counts["kind"] == "letter"]
    counts = counts[counts["kind"] != "letter"]
    languages = tuple(sorted(counts["lang"].unique()))
    number = {name: i for i, name in enumerate(languages)}
    keys = np.unique(counts["key"][counts["kind"] == "gram"].to_numpy(np.uint64))
    grams = np.zeros((1 + len(keys), len(languages)))  # the first row for trigrams not seen
    scripts = np.zeros((len(SCRIPTS) + 1, len(languages)))
    for kind, table in (("gram", grams), ("script", scripts)):
        own = counts[counts["kind"] == kind]
        row = own["key"].to_numpy(np.int64) if kind == "script" else 1 + np.searchsorted(keys, own["key"].to_numpy(np.uint64))
        table[row, [number[x] for x in own["lang"]]] = own["n"].to_numpy()
    seen = max(1, len(keys))
    weights = np.log((grams + smoothing) / (grams.sum(axis=0) + smoothing * seen))
    share = scripts / np.maximum(1, scripts.sum(axis=0))
    letters = np.full(PLANES, smoothing)
    letters[letter_counts["key"].to_numpy()] += letter_counts["n"].to_numpy()
    letters = np.log(letters / (letter_counts["n"].sum() + smoothing * max(1, len(letter_counts))))
    return Model(languages, weights.astype(np.float32), *_table(keys), share >= least_script_share, letters.astype(np.float32),
                 max(1, len(letter_counts)))


def word_scores(words: LetterWords, model: Model) -> np.ndarray:
    """Log-likelihood of each word per language; languages not seen in its script get a large penalty."""
    if not len(words.starts):
        return np.zeros((0, len(model.languages)), np.float32)
    scores = np.add.reduceat(model.weights[model.place(words.trigrams)], words.offsets[:-1], axis=0)
    allowed = model.scripts[words.script]
    allowed |= ~allowed.any(axis=1)[:, None]
    return np.where(allowed, scores, scores - np.float32(1e4))


def random_scores(words: LetterWords, model: Model) -> np.ndarray:
    """Log-likelihood of each word as letters at random.

    They are drawn one by one, for half of the words as often as they occur in all learned
    texts, for half all alike (else no word of rare letters could look random).
    """
    if not len(words.starts):
        return np.zeros(0)
    single = model.letters[words.letters].astype(np.float64)
    last = words.offsets[1:] - 1
    chance = 3 * np.add.reduceat(single, words.offsets[:-1]) - single[words.offsets[:-1]] - single[last] + 2 * model.letters[0]
    alike = -3 * words.lengths * np.log(model.kinds)
    return np.logaddexp(chance, alike) - np.log(2)


def word_confidence(words: LetterWords, model: Model, scores: np.ndarray, labels: np.ndarray, random: np.ndarray) -> np.ndarray:
    """How likely each word is of the language that the path gives it, rather than letters at random.

    ``DOUBT`` is the lead that a language has. A word in a script in which no language was
    seen has 0.
    """
    lead = scores[np.arange(len(labels)), labels] - random + DOUBT
    known = model.scripts[words.script].any(axis=1)
    return np.where(known, 1 / (1 + np.exp(-np.clip(lead, -50, 50))), 0.0)


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word: the sum of scores less ``penalty`` for each switch.

    Texts advance side by side, the longest first, one word a step. Ties keep the
    label, then take the first.
    """
    labels = np.zeros(len(scores), np.int16)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    if not len(order):
        return labels
    first = np.concatenate([[0], np.cumsum(counts)])[order]
    length = counts[order]
    active = np.searchsorted(-length, -np.arange(length[0]), side="left")  # texts longer than each step
    back = np.zeros((len(scores), scores.shape[1]), np.int16)
    best = scores[first].astype(np.float64)
    own = np.arange(scores.shape[1], dtype=np.int16)[None, :]
    for t in range(1, int(length[0])):
        n = active[t]
        state = best[:n]
        top = state.argmax(axis=1)
        jump = state[np.arange(n), top][:, None] - penalty
        move = jump > state
        at = first[:n] + t
        back[at] = np.where(move, top[:, None].astype(np.int16), own)
        best[:n] = np.where(move, jump, state) + scores[at]
    current = best.argmax(axis=1).astype(np.int16)
    labels[first + length - 1] = current
    for t in range(int(length[0]) - 1, 0, -1):
        n = active[t]
        at = first[:n] + t
        current[:n] = back[at, current[:n]]
        labels[at - 1] = current[:n]
    return labels


def _label_task(model: Model, penalty: float, text: str, keep: list[str]):
    langs = len(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Letters()
        held: list[tuple[pa.RecordBatch, LetterWords, np.ndarray, np.ndarray, np.ndarray]] = []
        for part in _parts(batches, text):
            words = LetterWords(tables, _texts(part, text))
            scores = word_scores(words, model) if langs else np.zeros((len(words.starts), 1), np.float32)
            random = random_scores(words, model) if langs else np.zeros(len(words.starts))
            del words.trigrams, words.letters
            held.append((part, words, np.bincount(words.owner, minlength=part.num_rows), scores, random))
            if len(held) == SIDE_BY_SIDE:
                yield from decided(held)
                held.clear()
                del part, words, scores, random
        if held:
            yield from decided(held)

    def decided(held) -> Iterator[pa.RecordBatch]:
        every = viterbi(np.concatenate([h[3] for h in held]), np.concatenate([h[2] for h in held]), penalty)
        at = 0
        for part, words, counts, scores, random in held:
            labels, at = every[at: at + len(scores)], at + len(scores)
            texts = part.num_rows
            kinds = max(1, langs)
            letters = np.bincount(words.owner * kinds + labels, words.lengths, texts * kinds).reshape(texts, kinds)
            total = np.zeros((texts, kinds))
            if len(scores):
                filled = counts > 0
                total[filled] = np.add.reduceat(
                    scores.astype(np.float64), np.concatenate([[0], np.cumsum(counts)])[:-1][filled], axis=0)
            has = counts > 0
            most = letters == letters.max(axis=1)[:, None]
            pick = np.where(most, total, -np.inf).argmax(axis=1)
            rows = np.arange(texts)
            own = np.zeros_like(total)  # over the words that the path gives to the language
            mine = labels == pick[words.owner]
            for k in range(kinds):
                own[:, k] = np.bincount(words.owner[mine], scores[mine, k], texts)
            chance = np.exp(np.minimum(0, own - own[rows, pick][:, None]))
            share = letters[rows, pick] / np.maximum(1, letters.sum(axis=1))
            score = np.where(has, share / np.maximum(1, chance.sum(axis=1)), 0.0)
            known = has & (langs > 0)
            sure = np.zeros(texts)
            if langs and len(scores):
                weight = word_confidence(words, model, scores, labels, random) * words.lengths
                sure = np.bincount(words.owner, weight, texts) / np.maximum(1, letters.sum(axis=1))
            change = np.ones(len(labels), bool)
            change[1:] = (labels[1:] != labels[:-1]) | (words.owner[1:] != words.owner[:-1])
            head = np.flatnonzero(change) if langs else np.zeros(0, np.int64)
            tail = np.append(head[1:], len(labels)) - 1 if len(head) else head
            base = words.first[words.owner[head]]
            spans = pa.StructArray.from_arrays([
                pa.array(words.starts[head] - base), pa.array(words.ends[tail] - base),
                pa.array([model.languages[i] for i in labels[head].tolist()], pa.string()),
            ], names=["begin", "end", "lang"])
            edges = np.searchsorted(words.owner[head], np.arange(texts + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                *[part.column(n) for n in keep],
                pa.array([model.languages[p] if k else UNKNOWN for p, k in zip(pick.tolist(), known.tolist())]),
                pa.array(np.where(known, score, 0.0)), pa.array(sure), pa.ListArray.from_arrays(edges, spans),
            ], names=[*keep, "lang_pred", "score", "confidence", "spans"])
    return run


def label_spans(docs: DataFrame, model: Model, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",),
                penalty: float = 12.0) -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score``, ``confidence`` and ``spans (begin, end, lang)`` of each row.

    ``lang_pred`` is the language with most letters on the path; of equal ones the
    one with the larger sum of word scores, then the first by name. ``score`` is its
    share of the letters times its probability among all languages for the words that
    the path gives to it. ``confidence`` is that of the whole path: over all words, letters times
    the probability that the word is of its span's language and not letters at random.
    Spans are in code points, from the first letter of their first word to the
    end of their last one. A null or empty text, or one without a letter, is ``und``
    with score and confidence 0 and no spans; so is every text if nothing was learned. Each row has
    its own result, also if rows repeat.
    """
    names = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(n).alias(k) for n, k in zip(keep, names)])
    text = "_text"
    if text_column in keep:
        text = names[keep.index(text_column)]
    else:
        rows = docs.select(*[F.col(n).alias(k) for n, k in zip(keep, names)], F.col(text_column).alias(text))
    schema = ", ".join([*(f"{k} {rows.schema[k].dataType.simpleString()}" for k in names), RESULT])
    found = rows.mapInArrow(_label_task(model, penalty, text, names), schema)
    return found.select(*[F.col(k).alias(n) for n, k in zip(keep, names)], "lang_pred", "score", "confidence", "spans")


def drop_unidentified(docs: DataFrame, model: Model, text_column: str = "text", penalty: float = 12.0,
                      least: float = LEAST_CONFIDENCE) -> DataFrame:
    """The rows whose path is a language's by ``least`` of its letters; all columns.

    Rows without a letter go, and so do texts most of whose letters stand in no order of a
    learned language, or in a script of none. The score is no reason to go: it falls with the
    number of languages that a text is written in, and with the number that a short text fits;
    the path's confidence does neither. If no language was learned, rows with a letter stay.
    """
    if not model.languages:
        return docs.filter(F.coalesce(F.col(text_column).rlike(r"\p{L}"), F.lit(False)))
    labelled = label_spans(docs.toDF(*(f"_c{i}" for i in range(len(docs.columns)))), model,
                           f"_c{docs.columns.index(text_column)}", tuple(f"_c{i}" for i in range(len(docs.columns))), penalty)
    staying = labelled.filter((F.col("lang_pred") != UNKNOWN) & (F.col("confidence") >= least))
    return staying.select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(docs.columns)])
