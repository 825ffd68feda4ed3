"""Operators 11 to 13 against brute force in plain Python, and their edge cases."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectorferry.llm import backoff, hard_negatives, turn_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = "doc_id long, text string, lang string, score double, block long, n int, _text int"


# -- 11 backoff automaton ---------------------------------------------------------


def lower(text):
    return "".join(c.lower() if c < "\x80" else c for c in text or "")


def model_scores(rows, taught, order, prior):
    """The recursion of the docstring, word by word."""
    texts = [WORD.findall(lower(t)) + [None] for t in rows]
    counts, after = Counter(), Counter()
    for words, own in zip(texts, taught):
        if own:
            line = ["<begin>", *words]
            for end in range(1, len(line)):
                for size in range(1, order + 1):
                    if end - size + 1 >= (0 if size > 1 else 1):
                        gram = tuple(line[end - size + 1: end + 1])
                        counts[size, gram] += 1
                        after[gram[:-1]] += 1 if size > 1 else 0
    tokens = sum(n for (size, _), n in counts.items() if size == 1)
    kinds = sum(1 for size, _ in counts if size == 1)

    def chance(gram):
        if len(gram) == 1:
            return (counts[1, gram] + 1) / (tokens + kinds + 1)
        return (counts[len(gram), gram] + prior * chance(gram[1:])) / (after[gram[:-1]] + prior)

    found = []
    for words in texts:
        line = ["<begin>", *words]
        grams = [tuple(line[max(0 if order > 1 else end, end - order + 1): end + 1]) for end in range(1, len(line))]
        found.append((len(words), sum(counts[1, (w,)] > 0 for w in words), tokens,
                      sum(math.log10(chance((w,))) for w in words), sum(math.log10(chance(g)) for g in grams)))
    return found


@pytest.mark.parametrize("order, prior, block_bytes", [(1, 1.0, 1 << 20), (2, 3.0, 200), (3, 32.0, 200), (4, 0.5, 1 << 20)])
def test_backoff_is_the_recursion(spark, order, prior, block_bytes):
    rng = np.random.default_rng(order)
    texts = [" ".join(rng.choice(["a", "b", "C", "dé", "e"], rng.integers(0, 40))) for _ in range(60)]
    texts += [None, "", " \t\n", "x" * 5000, "a b " * 3000, "A B", "ÀB àb"] + ["same text twice"] * 20
    rows = [(i, t, "x", 0.0, 1, 1, 1) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, TEXTS).repartition(3)
    got = backoff.score_texts(frame, F.col("doc_id") % 3 != 0, order=order, prior=prior, block_bytes=block_bytes).collect()
    assert len(got) == len(rows)
    want = model_scores(texts, [i % 3 != 0 for i in range(len(texts))], order, prior)
    for r in got:
        expected = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == expected[:3]
        assert (r["base_score"], r["score"]) == pytest.approx(expected[3:], rel=1e-6)


def test_backoff_chances_sum_to_one(spark):
    """Over all words that were seen and one that was not, after any context."""
    frame = spark.createDataFrame([(i, t, "x", 0.0, 1, 1, 1) for i, t in enumerate(
        ["a b c", "a b b", "c a", *[f"a b {w}" for w in ("a", "b", "c", "new")], "a b"])], TEXTS)
    got = {r["doc_id"]: r for r in backoff.score_texts(frame, F.col("doc_id") < 3, order=3, prior=2.0).collect()}
    # "a b w" ends after w; take the end's own chance off by asking the recursion for it
    texts = [frame.collect()[i]["text"] for i in range(8)]
    want = model_scores(texts, [i < 3 for i in range(8)], 3, 2.0)
    assert [got[i]["score"] for i in range(8)] == pytest.approx([w[4] for w in want])
    parts = []
    for i in (3, 4, 5, 6):
        words = texts[i].split()
        end = model_scores(["a b c", "a b b", "c a", " ".join(words)], [True] * 3 + [False], 3, 2.0)[3][4]
        assert got[i]["score"] == pytest.approx(end)
        parts.append(10 ** end)
    assert sum(parts) < 1


def test_backoff_edges(spark):
    frame = spark.createDataFrame([(None, None, None, None, None, None, None), (1, "", "x", 0.0, 1, 1, 1),
                                   (1, "", "x", 0.0, 1, 1, 1)], TEXTS)
    nothing = backoff.score_texts(frame, F.col("doc_id") > 5).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in nothing] == [(1, 0, 0, 0.0, 0.0)] * 3
    some = backoff.score_texts(frame, F.col("doc_id") == 1).collect()
    assert {r["train_tokens"] for r in some} == {2} and all(r["n_known"] == 1 for r in some)
    assert backoff.score_texts(frame.limit(0), F.lit(True)).isEmpty()
    with pytest.raises(ValueError):
        backoff.score_texts(frame, F.lit(True), order=0)


# -- 12 prefix trie ---------------------------------------------------------------


def trie_of(conversations):
    """``{(conv_id, depth): row}`` by looking at every beginning."""
    members, words = defaultdict(list), {}
    for conv, turns in conversations.items():
        for depth in range(len(turns) + 1):
            key = tuple(t[0] for t in turns[:depth])
            members[key].append(conv)
            words[key] = turns[depth - 1][1] if depth else 0
    below = defaultdict(list)
    for key in members:
        for depth in range(len(key) + 1):
            below[key[:depth]].append(key)
    children = Counter(key[:-1] for key in members if key)
    rows = []
    for key, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(conversations[c]) == len(key))))
        rows.append((
            min(own), len(key), min(members[key[:-1]]) if key else None, len(own), children[key],
            sum(children[k] == 0 for k in below[key]), sum((len(members[k]) - 1) * words[k] for k in below[key]),
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def as_frame(spark, conversations):
    rows = [(c, [(i, name, words) for i, (name, words) in enumerate(turns)]) for c, turns in conversations.items()]
    return spark.createDataFrame(rows, "conv_id long, turns array<struct<turn: long, id: string, words: long>>")


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_rows(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("block_turns", [1, 30, 1 << 17])
def test_trie_is_every_beginning(spark, block_turns):
    """Also in many small blocks, over several levels; a third are copies, some are beginnings of others."""
    rng = np.random.default_rng(block_turns)
    names = [hashlib.md5(str(i).encode()).hexdigest() for i in range(300)]
    turns = [(n, i % 5) for i, n in enumerate(names)]
    made = {}
    for conv in range(240):
        if conv % 3 == 0:
            made[conv] = [turns[0], turns[1], turns[2]]
        else:
            made[conv] = [turns[int(rng.integers(0, 300 if rng.random() < 0.3 else 3))] for _ in range(int(rng.integers(0, 9)))]
    made[1000] = [turns[i % 300] for i in range(700)]
    made[1001] = made[1000][:650] + [turns[5]]
    made[999] = made[1000][:400]
    assert trie_rows(turn_trie.prefix_trie(as_frame(spark, made), block_turns)) == trie_of(made)


def test_radix_nodes_grow():
    """Node layouts of 4, 16, 48 and 256 children hold what they were given, in order."""
    for n in (3, 4, 5, 16, 17, 48, 49, 256):
        paths = sorted(bytes([i]) + bytes(15) for i in range(n))
        tree = turn_trie.RadixTree(paths)
        assert tree.root.size == next(s for s in (4, 16, 48, 256) if n <= s)
        assert tree.root.children() == list(range(n)) and all(tree.root.get(p[0]) == i for i, p in enumerate(paths))
        depths, parents, first, counts = tree.nodes()
        assert depths == [0] + [1] * n and parents == [-1] + [0] * n and counts == [n] + [1] * n


def test_only_whole_turns_are_nodes():
    """Turns that share 15 bytes, or split in the middle of an id, make no node in between."""
    a, b, c = bytes(15) + b"a", bytes(15) + b"b", bytes(7) + b"x" + bytes(8)
    depths, parents, _, counts = turn_trie.RadixTree(sorted([a, a + b, a + c, b + a + a])).nodes()
    assert sorted(zip(depths, counts)) == [(0, 4), (1, 1), (1, 3), (2, 1), (2, 1), (2, 1), (3, 1)]


def test_trie_edges(spark):
    rows = spark.createDataFrame([
        (None, 0, "user", "x", 1), (1, None, None, None, 1), (1, 0, "user", "two words", 1), (1, 0, "user", "two words", 1),
        (2, 5, "user", "y" * 100_000, 1), (3, 0, "us", "erx", 1), (4, 0, "use", "rx", 1),
    ], "conv_id long, turn long, role string, text string, words int")
    turns = turn_trie.conversation_turns(rows)
    got = {r["conv_id"]: r["turns"] for r in turns.collect()}
    assert sorted(got) == [1, 2, 3, 4] and [t["words"] for t in got[1]] == [0, 2, 2] and got[1][0]["turn"] is None
    assert got[3][0]["id"] != got[4][0]["id"]
    assert trie_rows(turn_trie.prefix_trie(turns)) == trie_of({c: [(t["id"], t["words"]) for t in v] for c, v in got.items()})
    assert turn_trie.prefix_trie(turns.limit(0)).isEmpty()
    bare = as_frame(spark, {7: [], 9: []})
    assert trie_rows(turn_trie.prefix_trie(bare)) == trie_of({7: [], 9: []})


# -- 13 hard negatives ------------------------------------------------------------


def mined(rows, anchor, positives=5, negatives=3):
    out = []
    for a_id, a_label, a in rows:
        if not anchor(a_id):
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), i, label) for i, label, v in rows if i != a_id]
        for s, p, _ in sorted(x for x in scored if x[2] == a_label)[:positives]:
            fit = sorted(x for x in scored if x[2] != a_label and -50 * s <= -100 * x[0] <= -95 * s)
            out += [(a_id, p, rank, n, -s, -t) for rank, (t, n, _) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def mine_rows(frame):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in frame.select(*columns).collect())


VECTORS = "vec_id long, label int, vector array<bigint>, row int, id int, unit int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], VECTORS)


@pytest.mark.parametrize("leaf_rows", [8, 40, 5000])
def test_mining_is_brute_force(spark, leaf_rows):
    """Clusters, a vector that a third of all rows share, ties, zeros and negative scores; many small leaves."""
    rng = np.random.default_rng(leaf_rows)
    centres = rng.integers(-200, 200, (12, 6))
    rows = [(i, int(rng.integers(0, 3)), (centres[i % 12] + rng.integers(-9, 9, 6)).tolist()) for i in range(500)]
    rows += [(1000 + i, i % 2, [100, 50, 0, 0, 20, 7]) for i in range(250)]
    rows += [(2000, 0, [0] * 6), (2010, 9, [1] * 6), (2020, 1, [100, 50, 1, 0, 20, 7])]
    got = hard_negatives.mine(vectors(spark, rows).repartition(5), F.col("vec_id") % 10 == 0, leaf_rows=leaf_rows)
    assert mine_rows(got) == mined(rows, lambda i: i % 10 == 0)


def test_tree_leaves_subtrees_out():
    """Near clusters are searched without most leaves, and nothing in a window lies in a leaf left out."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-5000, 5000, (30, 8))
    points = centres[rng.integers(0, 30, 4000)] + rng.integers(-20, 20, (4000, 8))
    tree = hard_negatives.grow(points[:1000], 4000, 8, float((points ** 2).sum(axis=1).max()), leaf_rows=100)
    assert tree.leaves > 10
    lifted, leaf = tree.lift(points), tree.leaf_of(points)
    tree.near = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    tree.far = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
    for node, _, distance, nearest in tree.descend(lifted):
        if distance is not None:
            for j in np.unique(nearest):
                tree.near[node][:, j] = np.minimum(tree.near[node][:, j], distance[nearest == j].min(axis=0))
                tree.far[node][:, j] = np.maximum(tree.far[node][:, j], distance[nearest == j].max(axis=0))
    scores = points[:50] @ points.T
    high = scores.max(axis=1, keepdims=True).astype(float)
    low = high - 0.001 * np.abs(high)
    reached = tree.reached(points[:50], low, high)
    assert np.mean([len(r) for r in reached]) < tree.leaves / 3
    for i, own in enumerate(reached):
        assert set(leaf[(scores[i] >= low[i]) & (scores[i] <= high[i])].tolist()) <= set(own)


def test_large_scores_stay_exact():
    big = np.array([[2 ** 30 + 1, 3], [7, 2 ** 30 - 1]])
    assert hard_negatives.scores_of(big, big).tolist() == [[(2 ** 30 + 1) ** 2 + 9, 7 * (2 ** 30 + 1) + 3 * (2 ** 30 - 1)],
                                                          [7 * (2 ** 30 + 1) + 3 * (2 ** 30 - 1), 49 + (2 ** 30 - 1) ** 2]]


def test_mining_edges(spark):
    rows = [(0, 1, [2, 2]), (10, 1, [3, 3]), (1, 1, [3]), (2, 0, [2, 1]), (3, 0, [2, 1]), (3, 0, [2, 1]), (4, 2, [])]
    bad = [(5, None, [1, 1]), (6, 0, None), (7, 0, [1, None]), (None, 0, [1, 1]), (None, None, None)]
    got = hard_negatives.mine(vectors(spark, rows + bad), F.col("vec_id") % 10 == 0)
    padded = [(i, label, (v + [0, 0])[:2]) for i, label, v in rows]
    assert mine_rows(got) == mined(padded, lambda i: i % 10 == 0)
    assert hard_negatives.mine(vectors(spark, rows).limit(0), F.lit(True)).isEmpty()
    assert hard_negatives.mine(vectors(spark, rows), F.lit(False)).isEmpty()
