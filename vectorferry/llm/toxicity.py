"""Toxicity of whole texts, disguised words included.

Writers hide words by symbols for letters, by spacing and by repetition. For each token
that may be disguised a lattice of the letters it may stand for is decoded by Viterbi
under a character trigram model of the whole corpus; the restored text is then scored.
The share of toxic texts among those that hold a word is shrunk toward that of its surest
run of five letters, and this toward the share of all texts, so rare words of a stem
teach together, in languages with few labels too. A logistic regression over the surest
words, the sum of the strong ones and the number of words gives the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorferry.llm import kernels
from vectorferry.llm.language import PLANES, Letters, _parts, _texts
from vectorferry.llm.store import materialize

# Letters that a digit or symbol is written for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "¥": "y",
}
CORE = "0123456789@$€£¥"  # lookalikes that are no punctuation
PARTING = "-_./'’,:;&"  # may also stand between two words

NEAR_BITS = 20
# log costs of the channel
SUBSTITUTED, SKIPPED, DROPPED, OUTER = -0.7, -3.0, -7.0, -0.1  # dropped: a lookalike that stands for nothing
COLLAPSED, SINGLED, PARTED = -0.5, -4.0, -1.5  # singled: a double letter meant as one
JOINED, WIDE = 0.0, -1.5  # letters across a blank, and across one that is wider than others
BLANKS = [i for i in range(PLANES) if chr(i).isspace()]


@dataclass(frozen=True)
class Classifier:
    """Weights of the toxic and clean texts that hold a word of toxic texts, bounds of runs of
    letters above ``base``, and the regression over what they say about a text."""

    keys: np.ndarray  # uint64, sorted: words
    toxic: np.ndarray
    clean: np.ndarray
    runs: np.ndarray  # uint64, sorted
    bounds: np.ndarray
    base: float
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one stands alone

    def near(self) -> np.ndarray:
        """Whether any run has these upper bits: rules most out at once."""
        table = np.zeros(1 << NEAR_BITS, bool)
        table[_upper(self.runs, NEAR_BITS)] = True
        return table

    def score(self, evidence: np.ndarray) -> np.ndarray:
        """Chances that texts are toxic; 0 for a text without words."""
        value = (evidence - self.centre) / self.scale @ self.weights[:-1] + self.weights[-1]
        return np.where(evidence[:, -1] > 0, 1 / (1 + np.exp(-np.clip(value, -700, 700))), 0.0)


def _upper(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _codes(before, middle, after):
    return (before << np.uint64(42)) | (middle << np.uint64(21)) | after


# -- the character model --------------------------------------------------------


def _gram_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = Letters()
    for part in _parts(batches, "text"):
        points, letter, _ = tables.decode(_texts(part, "text"))
        symbol = np.where(letter, points, 0).astype(np.uint64)
        before, ahead = np.zeros_like(symbol), np.zeros_like(symbol)
        before[1:], ahead[2:] = symbol[:-1], symbol[:-2]
        ahead[before == 0] = 0
        used = letter | (before > 0)  # each letter, and the edge that ends a word
        keys, n = np.unique(_codes(ahead, before, symbol)[used], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])


@dataclass(frozen=True)
class Grams:
    """Counts of letter trigrams, and of the two letters before."""

    keys: np.ndarray  # uint64, sorted
    counts: np.ndarray
    contexts: np.ndarray  # uint64, sorted
    sums: np.ndarray

    def log_probability(self, ahead: int, before: int, letter: int) -> float:
        context = (ahead << 21) | before
        count = _count(self.keys, self.counts, (context << 21) | letter)
        return float(np.log(0.8 * count / max(1.0, _count(self.contexts, self.sums, context)) + 0.2 / 40))


def _count(keys: np.ndarray, counts: np.ndarray, key: int) -> float:
    at = int(np.searchsorted(keys, np.uint64(key)))
    return float(counts[at]) if at < len(keys) and int(keys[at]) == key else 0.0


def train_characters(docs: DataFrame, text_column: str = "text") -> Grams:
    """Count letter trigrams of all texts. The driver gets a row per distinct trigram: alphabets
    bound their number, not texts."""
    rows = docs.select(F.col(text_column).alias("text")).filter("text is not null")
    found = rows.mapInArrow(_gram_task, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    found = found.sort_values("key")
    keys, counts = found["key"].to_numpy().view(np.uint64), found["n"].to_numpy(np.float64)
    contexts, of = np.unique(keys >> np.uint64(21), return_inverse=True)
    return Grams(keys, counts, contexts, np.bincount(of, counts, minlength=len(contexts)))


# -- restoring ------------------------------------------------------------------


class Restorer:
    """Decodes disguised tokens; remembers what it has decoded, up to a bound."""

    MOST = 200_000
    LONGEST = 100  # characters of a token that is remembered

    def __init__(self, grams: Grams):
        self.grams = grams
        self.known: dict[str, str] = {}
        self.chances: dict[tuple[int, int, int], float] = {}

    def chance(self, ahead: int, before: int, letter: int) -> float:
        key = (ahead, before, letter)
        if key not in self.chances:
            if len(self.chances) >= 4 * self.MOST:
                self.chances.clear()
            self.chances[key] = self.grams.log_probability(*key)
        return self.chances[key]

    def restore(self, token: str) -> str:
        """The likeliest words that a token stands for."""
        found = self.known.get(token)
        if found is None:
            if len(self.known) >= self.MOST:
                self.known.clear()
            found = self._decode(token.lower())
            if len(token) <= self.LONGEST:
                self.known[token] = found
        return found

    @staticmethod
    def lattice(token: str) -> list[list[tuple[str, float]]]:
        """For each run of one character: what it may stand for, with its cost.

        A blank parts letters of a word or two words; two blanks rather words.
        """
        runs: list[tuple[str, int]] = []
        for c in token:
            if runs and runs[-1][0] == c:
                runs[-1] = (c, runs[-1][1] + 1)
            else:
                runs.append((c, 1))
        letters = [i for i, (c, _) in enumerate(runs) if c.isalpha() or (" " in token and c in CORE)]
        first, last = (letters[0], letters[-1]) if letters else (0, len(runs) - 1)
        columns = []
        for i, (c, n) in enumerate(runs):
            if c.isalpha():
                options = [(c, 0.0 if n == 1 else SINGLED if n == 2 else COLLAPSED)]
                if n > 1:
                    options.append((c * 2, 0.0 if n == 2 else COLLAPSED))
            elif c == " ":
                options = [("", JOINED if n == 1 else WIDE), (" ", 0.0)]
            else:
                options = [(x, SUBSTITUTED) for x in LOOKALIKES.get(c, "")]
                inside = first < i < last or i in letters
                options.append(("", (DROPPED if options else SKIPPED) if inside else OUTER))
                if c in PARTING and first < i < last:
                    options.append((" ", PARTED))
            columns.append(options)
        return columns

    def _decode(self, token: str) -> str:
        states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}  # a path: the one before, and a piece
        for options in self.lattice(token):
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (ahead, before), (score, path) in states.items():
                for emitted, cost in options:
                    a, b, value = ahead, before, score + cost
                    for c in emitted:
                        if c == " ":
                            value += self.chance(a, b, 0) if b else 0.0
                            a = b = 0
                        else:
                            value += self.chance(a, b, ord(c))
                            a, b = b, ord(c)
                    old = after.get((a, b))
                    if old is None or value > old[0]:
                        after[a, b] = (value, (path, emitted) if emitted else path)
            states = after
        ends = [(score + (self.chance(a, b, 0) if b else 0.0), path) for (a, b), (score, path) in states.items()]
        most = max(score for score, _ in ends)
        return max(_along(path) for score, path in ends if score == most)


def _along(path: tuple) -> str:
    pieces = []
    while path:
        path, piece = path
        pieces.append(piece)
    return "".join(reversed(pieces))


SPACED = 4  # single characters in a row from which on they may be one word
SHORTEST = 3  # the same where the lattice decides whether they are


def disguised(tables: Letters, texts: list[str], spaced: int = SPACED) -> list[list[tuple[int, int]]]:
    """Ranges of each text that may be disguised: tokens that mix letters with symbols,
    repeat a letter three times or double several, and runs of tokens of one character
    each, also repeated or with punctuation, of which ``spaced`` are letters or lookalikes
    and at least one is a letter. Blanks between them are of any kind and length."""
    points, letter, first = tables.decode(texts)
    low = np.minimum(points, PLANES - 1)
    space = np.zeros(PLANES, bool)
    space[BLANKS] = True
    blank = space[low]
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return [[] for _ in texts]
    odd = ~letter & ~blank
    before, after = np.zeros_like(letter), np.zeros_like(letter)
    before[1:], after[:-1] = letter[:-1], letter[1:]
    lookalike = np.zeros(PLANES, bool)
    lookalike[[ord(c) for c in LOOKALIKES]] = True
    inner = odd & ((before & after) | (lookalike[low] & (before | after)))
    again = np.zeros_like(letter)  # the character before it once more
    again[1:] = points[1:] == points[:-1]
    triple, double = np.zeros_like(letter), letter & again
    triple[2:] = letter[2:] & again[2:] & again[1:-1]
    marked = np.logical_or.reduceat(inner | triple, starts) | (np.add.reduceat(double, starts, dtype=np.int64) > 1)
    owner = np.searchsorted(first, starts, side="right") - 1
    same = again | blank
    same[starts] = True
    core = np.zeros(PLANES, bool)
    core[[ord(c) for c in CORE]] = True
    core = core[low] | letter
    single = np.logical_and.reduceat(same, starts) | (np.add.reduceat(core & ~again, starts, dtype=np.int64) == 1)
    begins = single.copy()
    begins[1:] &= ~single[:-1] | (owner[1:] != owner[:-1])
    run = np.cumsum(begins) - 1  # of each single token
    runs = int(begins.sum())
    of = run[single]
    letters = np.bincount(of[np.logical_or.reduceat(letter, starts)[single]], minlength=runs)
    members = np.bincount(of[np.logical_or.reduceat(core | lookalike[low], starts)[single]], minlength=runs)
    chosen = (members >= spaced) & (letters > 0)
    last = np.flatnonzero(single)[np.searchsorted(of, np.arange(runs), side="right") - 1]
    ranges: list[list[tuple[int, int]]] = [[] for _ in texts]
    alone = marked.copy()
    alone[single] &= ~chosen[of]
    for i in np.flatnonzero(alone).tolist():
        base = int(first[owner[i]])
        ranges[owner[i]].append((int(starts[i]) - base, int(ends[i]) - base))
    for a, b in zip(np.flatnonzero(begins)[chosen].tolist(), last[chosen].tolist()):
        base = int(first[owner[a]])
        ranges[owner[a]].append((int(starts[a]) - base, int(ends[b]) - base))
    return ranges


def _evened(token: str) -> str:
    """One blank for the narrowest between its characters, two for each wider one."""
    blanks = re.findall(r"\s+", token)
    if not blanks:
        return token

    def width(blank: str) -> tuple[int, int]:
        return blank.count("\n"), len(blank)

    least = min(map(width, blanks))
    return re.sub(r"\s+", lambda m: " " if width(m[0]) == least else "  ", token)


def restore_texts(tables: Letters, restorer: Restorer, texts: list[str]) -> list[str]:
    out = []
    for text, ranges in zip(texts, disguised(tables, texts, SHORTEST)):
        if ranges:
            pieces, at = [], 0
            for begin, end in sorted(ranges):
                pieces += [text[at:begin], restorer.restore(_evened(text[begin:end]))]
                at = end
            text = "".join([*pieces, text[at:]])
        out.append(text)
    return out


# -- the classifier -------------------------------------------------------------


class Features:
    """Hashes of the words of texts and of their runs of five letters, where an edge counts as one."""

    def __init__(self, tables: Letters, powers: kernels.Powers, texts: list[str]):
        self.points, letter, first = tables.decode(texts)
        symbol = np.where(letter, self.points, 0).astype(np.uint64)
        edge = np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = powers.upto(len(symbol) + 1)
        sums = np.zeros(len(symbol) + 1, np.uint64)
        np.cumsum(kernels.mix64(symbol) * up[: len(symbol)], dtype=np.uint64, out=sums[1:])
        self.words = kernels.mix64((sums[self.ends] - sums[self.starts]) * down[self.starts])
        self.owner = np.searchsorted(first, self.starts, side="right") - 1
        inner = letter[:-2] & letter[1:-1] & letter[2:] if len(letter) > 2 else np.zeros(0, bool)
        middle = np.flatnonzero(inner) + 1
        wide = np.concatenate([[0], symbol, [0]]).astype(np.uint64)
        value = np.zeros(len(middle), np.uint64)
        for j in range(5):
            value = value * np.uint64(0x9E3779B97F4A7C15) + wide[middle - 1 + j] + np.uint64(j + 1)
        self.grams = kernels.mix64(value ^ np.uint64(0x94D049BB133111EB))
        self.word = np.searchsorted(self.starts, middle, side="right") - 1  # of each run

    def strings(self) -> list[str]:
        text = self.points.tobytes().decode("utf-32-le", "surrogatepass")
        return [text[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist())]


def _found(keys: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each hash is a key, and its place among them."""
    if not len(keys):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return keys[place] == hashes, place


def _copies_task(hashes: int):
    """The least of each of several hashes over a text's five-word shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, powers, separators = kernels.byte_codes(), kernels.Powers(), kernels.separator_table()
        for rows, data, offsets in kernels.chunks(batches):
            words = kernels.Words(data, offsets, codes, powers, separators)
            values, owner = kernels.shingle_sets(words)
            texts = np.unique(owner)
            edges = np.searchsorted(owner, texts)
            least = [np.minimum.reduceat(kernels.mix64(values ^ np.uint64(k << 32 | k)), edges)
                     if len(texts) else values for k in range(1, hashes + 1)]
            yield pa.RecordBatch.from_arrays([
                rows.column("id").take(pa.array(texts)),
                pa.ListArray.from_arrays(np.arange(0, len(texts) * hashes + 1, hashes, dtype=np.int32),
                                         pa.array(np.stack(least, axis=1).reshape(-1).view(np.int64))),
            ], names=["id", "least"])
    return run


def _copy_weights(texts: DataFrame, hashes: int = 5) -> DataFrame:
    """``(id, weight)``: one over the number of texts that share the median hash, so that
    a group of copies teaches about as much as one text."""
    kind = texts.schema["id"].dataType.simpleString()
    found = texts.select("id", "text").mapInArrow(_copies_task(hashes), f"id {kind}, least array<long>")
    each = materialize(found.select("id", F.posexplode("least").alias("k", "value")), "least")
    sizes = each.groupBy("k", "value").agg(F.count("id").alias("n"))
    held = each.join(sizes, ["k", "value"]).groupBy("id").agg(F.sort_array(F.collect_list("n")).alias("n"))
    return held.select("id", (1 / F.element_at("n", hashes // 2 + 1)).alias("weight"))


def _weigh_task(grams: Grams):
    """Weights of the toxic and clean texts of one part that hold a word or a run of letters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, powers, restorer = Letters(), kernels.Powers(), Restorer(grams)
        for part in _parts(batches, "text"):
            weight = np.array(part.column("weight").to_pylist(), np.float64)
            label = np.array(part.column("label").to_pylist(), np.int64)
            found = Features(tables, powers, restore_texts(tables, restorer, _texts(part, "text")))
            for kind, hashes, owner in (("word", found.words, found.owner),
                                        ("run", found.grams, found.owner[found.word])):
                keys, of = np.unique(hashes, return_inverse=True)
                held = np.unique(of * part.num_rows + owner)
                of, owner = held // part.num_rows, held % part.num_rows
                sums = [np.bincount(of, weight[owner] * (label[owner] == y), minlength=len(keys)) for y in (1, 0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(keys), pa.string()), pa.array(keys.view(np.int64)),
                     pa.array(sums[0], pa.float64()), pa.array(sums[1], pa.float64())],
                    names=["kind", "key", "toxic", "clean"])
    return run


SHRINK = 10.0  # texts that the bound of a run of letters counts as
STRONG = 1.0  # log-odds above the base from which on a word counts as a strong one
EVIDENCE = 4


def evidence(found: Features, texts: int, classifier: Classifier, near: np.ndarray,
             labels: np.ndarray | None = None) -> np.ndarray:
    """What the distinct words of each text say: log-odds above the base of the surest word, of the
    three surest, of all strong ones, and the logarithm of the number of words.

    With ``labels``, for texts learned from, a text's own weight is taken off its words first.
    """
    first = np.lexsort([found.words, found.owner])
    again = np.zeros(len(first), bool)
    again[1:] = (found.words[first[1:]] == found.words[first[:-1]]) & (found.owner[first[1:]] == found.owner[first[:-1]])
    first = first[~again]
    owner, words = found.owner[first], found.words[first]
    best = np.full(len(found.words), classifier.base)
    some = np.flatnonzero(near[_upper(found.grams, NEAR_BITS)])
    known, place = _found(classifier.runs, found.grams[some])
    np.maximum.at(best, found.word[some][known], classifier.bounds[place[known]])
    best = best[first]
    known, place = _found(classifier.keys, words)
    toxic, clean = np.zeros(len(words)), np.zeros(len(words))
    toxic[known], clean[known] = classifier.toxic[place[known]], classifier.clean[place[known]]
    if labels is not None:
        own = labels[owner]
        toxic = np.maximum(0.0, toxic - (own == 1))
        clean = np.maximum(0.0, clean - (own == 0))
    share = (toxic + SHRINK * best) / (toxic + clean + SHRINK)
    odds = np.log(share / (1 - share)) - np.log(classifier.base / (1 - classifier.base))
    out = np.zeros((texts, EVIDENCE))
    order = np.lexsort([-odds, owner])
    owner, odds = owner[order], odds[order]
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
    out[owner[rank == 0], 0] = odds[rank == 0]
    out[:, 1] = np.bincount(owner[rank < 3], odds[rank < 3], minlength=texts)
    out[:, 2] = np.bincount(owner, np.where(odds > STRONG, odds, 0.0), minlength=texts)
    out[:, 3] = np.log1p(np.bincount(owner, minlength=texts))
    return out


def _evidence_task(grams: Grams, classifier: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, powers, restorer, near = Letters(), kernels.Powers(), Restorer(grams), classifier.near()
        for part in _parts(batches, "text"):
            labels = np.array(part.column("label").to_pylist(), np.int64)
            found = Features(tables, powers, restore_texts(tables, restorer, _texts(part, "text")))
            values = evidence(found, part.num_rows, classifier, near, labels)
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), part.column("weight"), *[pa.array(v) for v in values.T.copy()]],
                names=["label", "weight", *[f"e{i}" for i in range(EVIDENCE)]])
    return run


def _regression(values: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Centre, scale and weights of a ridge logistic regression, by Newton's steps."""
    centre = np.average(values, axis=0, weights=weight)
    scale = np.sqrt(np.average((values - centre) ** 2, axis=0, weights=weight)) + 1e-9
    rows = np.column_stack([(values - centre) / scale, np.ones(len(values))])
    ridge = np.diag([1.0] * values.shape[1] + [1e-3])
    share = np.average(labels, weights=weight)
    weights = np.append(np.zeros(values.shape[1]), np.log(share / (1 - share)))

    def loss(w: np.ndarray) -> float:
        at = rows @ w
        return float(weight @ (np.logaddexp(0, at) - labels * at) + w @ ridge @ w / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -500, 500)))
        slope = rows.T @ (weight * (p - labels)) + ridge @ weights
        step = np.linalg.solve((rows.T * (weight * p * (1 - p))) @ rows + ridge, slope)
        size = 1.0
        while size > 1e-6 and loss(weights - size * step) > loss(weights):
            size /= 2
        weights = weights - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return centre, scale, weights


def train_classifier(docs: DataFrame, labels: DataFrame, grams: Grams, id_column: str = "doc_id",
                     text_column: str = "text", label_column: str = "toxic", most_rows: int = 20_000,
                     deviations: float = 3.0) -> Classifier:
    """Weigh words and runs of letters over a sample of the labelled documents, by a hash of their id.

    ``most_rows`` is the size aimed at; twice as many labels, in the order of that hash, are
    never sent to the tasks. Rows with a null id or label teach nothing; of several labels of
    an id the largest counts. Copies of a text share one weight. The bound of a run of letters
    is Wilson's, ``deviations`` from the share found; runs no surer than the share of all texts
    are left out. Only words and runs of toxic texts reach the driver. Without a toxic or
    without a clean text nothing is learned: every text scores 0.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label")).filter(
        "id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    share = most_rows / max(most_rows, known.count())
    place = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    picked = known.filter(place < int(share * 1_000_000)).orderBy(place, "id").limit(2 * most_rows)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).filter("text is not null")
    sample = materialize(rows.join(F.broadcast(picked), "id"), "sample")
    weighed = materialize(sample.join(_copy_weights(sample), "id").select("text", "label", "weight"), "weighed")

    sums = weighed.groupBy().agg(F.sum(F.expr("weight * label")), F.sum(F.expr("weight * (1 - label)"))).first()
    toxic, clean = (float(x or 0) for x in sums)
    none = np.zeros(0, np.uint64), np.zeros(0)
    if not toxic or not clean:
        return Classifier(none[0], none[1], none[1], *none, 0.5, np.zeros(EVIDENCE), np.ones(EVIDENCE),
                          np.append(np.zeros(EVIDENCE), -np.inf))
    base = (toxic + 0.5) / (toxic + clean + 1)
    found = weighed.mapInArrow(_weigh_task(grams), "kind string, key long, toxic double, clean double").groupBy(
        "kind", "key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter("toxic > 0")
    n, z = F.col("toxic") + F.col("clean"), deviations
    of = F.col("toxic") / n
    bound = (of + z * z / (2 * n) - z * F.sqrt(of * (1 - of) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    found = materialize(found.withColumn("bound", bound).filter((F.col("kind") == "word") | (F.col("bound") > base)),
                        "features").toPandas()
    found["key"] = found["key"].to_numpy().view(np.uint64)
    found = found.sort_values("key")
    words, runs = found[found["kind"] == "word"], found[found["kind"] == "run"]
    tables = [c.to_numpy() for c in (words["key"], words["toxic"], words["clean"], runs["key"], runs["bound"])]
    classifier = Classifier(*tables, base, np.zeros(EVIDENCE), np.ones(EVIDENCE), np.zeros(EVIDENCE + 1))
    names = [f"e{i}" for i in range(EVIDENCE)]
    taught = weighed.mapInArrow(
        _evidence_task(grams, classifier), "label int, weight double, " + ", ".join(f"{n} double" for n in names)
    ).toPandas().sort_values([*names, "label", "weight"])  # whatever the order of tasks
    return Classifier(*tables, base, *_regression(
        taught[names].to_numpy(), taught["label"].to_numpy(np.float64), taught["weight"].to_numpy()))


def _score_task(grams: Grams, classifier: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, powers, restorer, near = Letters(), kernels.Powers(), Restorer(grams), classifier.near()
        for part in _parts(batches, "text"):
            restored = restore_texts(tables, restorer, _texts(part, "text"))
            score = classifier.score(evidence(Features(tables, powers, restored), part.num_rows, classifier, near))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(score), pa.array(restored, pa.string())],
                names=["id", "score", "restored"])
    return run


def score_toxicity(docs: DataFrame, grams: Grams, classifier: Classifier, id_column: str = "doc_id",
                   text_column: str = "text", threshold: float = 0.3) -> DataFrame:
    """``(id_column, score, predicted, restored)`` of each row.

    ``predicted`` is 1 from ``threshold`` on. A null or empty text, or one without a
    word, scores 0. Rows are scored one by one, so repeated rows and null
    ids have their own results. Other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(_score_task(grams, classifier), f"id {kind}, score double, restored string")
    return found.select(F.col("id").alias(id_column), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"), "restored")
