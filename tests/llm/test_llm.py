"""The corpus operators against SQL, brute force and hand-made edge cases."""

import glob
import hashlib
import os
import re
import time
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vectorferry.llm import (
    chat,
    decontaminate,
    embedding_dedup,
    kernels,
    language,
    licenses,
    lines,
    minhash,
    mixing,
    quality,
    toxicity,
)
from vectorferry.llm.graph import connected_components
from vectorferry.llm.queries import ORACLES, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, id int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
HELD = "the quick brown fox jumps over the lazy dog while seven grey wizards mix strange purple potions"


def docs(spark, rows):
    """Rows of (doc_id, text, lang, source); two further columns have names that operators use inside."""
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", 7) for r in rows], DOCS)


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, an id with two texts."""
    long = " ".join(f"word{i % 9973}" for i in range(60_000))
    return docs(spark, [
        (1, "the cat sat on the mat and the dog ran off", "en", "a"), (1, "the cat sat on the mat and the dog ran off", "en", "a"),
        (2, None, None, None), (3, "", "en", "b"), (4, " \n\t ", "de", None), (5, long, "en", "a"), (6, long, None, "b"),
        (None, "the cat sat on the mat and the dog ran off", "en", "a"), (None, None, None, None),
        (7, "der hund und die katze sind im haus und schlafen", "de", "c"), (7, "anderer text unter einer nummer steht hier", "de", "c"),
        (8, "two words", "en", "b"), (9, "TWO\twords", "en", "c"),
    ])


@pytest.fixture(scope="module")
def documents(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").cache()
    yield rows
    rows.unpersist(blocking=True)


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def by_id(frame):
    return {r[0]: r for r in frame.collect()}


# -- queries ----------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, folder, name):
    db = duckdb.connect()
    for file in glob.glob(f"{folder}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(file).removesuffix('.parquet')} AS SELECT * FROM '{file}'")
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    frame = QUERIES[name](spark, folder)
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame, *columns) == sorted(result.fetchall(), key=repr)


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


# -- 1 mixing ---------------------------------------------------------------------


def test_mix_edges(spark, edge):
    mixed = mixing.mix_sources(edge)
    assert mixed.count() == edge.count()
    assert set(edge.columns) <= set(mixed.columns)
    for r in mixed.collect():
        assert r["size"] == len(WORD.findall(r["text"] or "")) and r["taken"] == r["copies"] * r["size"]
        assert 0 <= r["copies"] <= 3 and r["target"] <= 3 * r["source_size"]
    assert mixing.emit(mixed).count() == sum(r["copies"] for r in mixed.collect())
    assert rows_of(mixing.mix_sources(edge), "doc_id", "text", "copies") == rows_of(mixed, "doc_id", "text", "copies")
    assert mixing.mix_sources(edge.limit(0)).isEmpty()


def test_mix_comes_near_targets(documents):
    got = mixing.mix_sources(documents).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 3 * r["most"] for r in got)
    assert abs(sum(r["target"] for r in got) - sum(len(WORD.findall(t[0])) for t in documents.select("text").collect())) < 1e-3


def test_mix_targets_stop_at_the_cap(spark):
    rows = [(i, "a " * (1000 if s == "c" else 10), "en", s) for i, s in enumerate(["a", "b", "c"])]
    got = {r["source"]: r["target"] for r in mixing.mix_sources(docs(spark, rows)).collect()}
    assert got == {"a": 30.0, "b": 30.0, "c": 960.0}


# -- 2 toxicity -------------------------------------------------------------------


@pytest.fixture(scope="module")
def grams(spark):
    text = " ".join(["you are an idiot and a moron", "stupid people read good books", "the idiot is so stupid"] * 30)
    return toxicity.train_characters(docs(spark, [(1, text, "en", "a")]))


@pytest.mark.parametrize("hidden, word", [
    ("1d1ot", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooooot", "idiot"), ("m0r0n!!", "moron"), ("st*up*id", "stupid"),
    ("$tup1d", "stupid"), ("people", "people"), ("books", "books"),
])
def test_restore(grams, hidden, word):
    assert toxicity.Restorer(grams).restore(hidden) == word


def test_viterbi_is_the_best_path(grams):
    """Against all paths through the lattice."""
    import itertools

    restorer = toxicity.Restorer(grams)

    def value(options):
        a = b = 0
        total = 0.0
        for emitted, cost in options:
            total += cost
            for c in emitted:
                if c == " ":
                    total += restorer.chance(a, b, 0) if b else 0.0
                    a = b = 0
                else:
                    total += restorer.chance(a, b, ord(c))
                    a, b = b, ord(c)
        return total + (restorer.chance(a, b, 0) if b else 0.0)

    for token in ("1d10t", "m0-r0n", "ss+tup|d"):
        paths = list(itertools.product(*restorer.lattice(token)))
        best = max(paths, key=value)
        assert restorer.restore(token) == "".join(e for e, _ in best)


def test_spaced_letters_are_found(grams):
    tables = language.Letters()
    texts = ["say i d i o t now", "a b c", "plain text, nothing here.", "x1y 2024 10.5", ""]
    found = toxicity.disguised(tables, texts)
    assert [[t[a:b] for a, b in r] for t, r in zip(texts, found)] == [["i d i o t"], [], [], ["x1y"], []]
    restored = toxicity.restore_texts(tables, toxicity.Restorer(grams), texts)
    assert restored[0] == "say idiot now" and restored[2] == texts[2]


@pytest.mark.parametrize("text, restored", [
    ("so s 7 u p 1 d now", "so stupid now"), ("5 7 u p 1 d", "stupid"), ("a  s  t  u  p  i  d", "a stupid"),
    ("s\tt\tu\tp\ti\td", "stupid"), ("s\nt\nu\np\ni\nd", "stupid"), ("s\xa0t\xa0u\xa0p\xa0i\xa0d", "stupid"),
    ("s t u p i d i d i o t", "stupid idiot"), ("m o r o n  i d i o t.", "moron idiot"), ("not a n d but", "not and but"),
    ("iiddiioott", "idiot"), ("ssttuuppiidd", "stupid"), ("m 0 r 0 n, and", "moron and"), ("good books", "good books"),
    ("1 2 3 4 5", "1 2 3 4 5"), ("10 a 20 b 30 c", "10 a 20 b 30 c"),
])
def test_spacing_and_doubling(grams, text, restored):
    found = toxicity.restore_texts(language.Letters(), toxicity.Restorer(grams), ["x", text, "s t"])
    assert found == ["x", restored, "s t"]


def test_spaced_runs_end_with_their_text(grams):
    assert toxicity.disguised(language.Letters(), ["s t", "u p", "i d"], 3) == [[], [], []]
    long = " ".join("idiot" * 2_000)
    assert toxicity.restore_texts(language.Letters(), toxicity.Restorer(grams), [long])[0].replace(" ", "") == "idiot" * 2_000


def test_toxicity_edges(spark, edge, grams):
    rows = [(i, f"words number {i} that idiot wrote about w{i * 7}" if i % 3 == 0 else f"words number {i} nice w{i * 5}", "en", "a")
            for i in range(150)]
    many = docs(spark, rows)
    labels = spark.createDataFrame([(i, 1 if i % 3 == 0 else 0) for i in range(120)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    found = toxicity.train_classifier(many, labels, grams)
    got = by_id(toxicity.score_toxicity(many, grams, found))
    assert all(got[i]["predicted"] == (1 if i % 3 == 0 else 0) for i in range(150))
    scored = toxicity.score_toxicity(edge, grams, found)
    assert scored.count() == edge.count()
    assert {r["score"] for r in scored.filter("doc_id in (2, 3, 4)").collect()} == {0.0}
    assert toxicity.score_toxicity(edge.limit(0), grams, found).isEmpty()
    assert toxicity.train_classifier(many, labels.limit(0), grams).keys.size == 0


def test_trigrams_are_told_apart(spark):
    """More trigrams than any small table of hashes holds: every count is its own."""
    text = " ".join(chr(0x4E00 + i) + chr(0x4E00 + j) for i in range(300) for j in range(100))
    found = toxicity.train_characters(docs(spark, [(1, text, "zh", "a"), (None, None, None, None)]))
    assert len(found.keys) == 2 * 300 * 100 + 300 and set(found.counts.tolist()) == {1.0, 100.0}
    assert found.log_probability(0, 0x4E00, 0x4E01) == pytest.approx(np.log(0.8 / 100 + 0.2 / 40))
    assert found.log_probability(0, 0x4E00, 0x9999) == pytest.approx(np.log(0.2 / 40))


def brute_evidence(texts, labels, weights, own, shrink=10.0, z=3.0):
    """The evidence of texts in plain Python; ``own`` takes a text's weight off its words."""
    def words(text):
        return sorted(set(re.findall(r"[^\W\d_]+", text.lower())))

    def runs(word):
        wide = f"_{word}_"
        return {wide[i: i + 5] for i in range(len(wide) - 4)}

    held, total = {}, [0.0, 0.0]
    for text, label, weight in zip(texts, labels, weights):
        total[label] += weight
        for key in {("w", w) for w in words(text)} | {("r", r) for w in words(text) for r in runs(w)}:
            held.setdefault(key, [0.0, 0.0])[label] += weight
    base = (total[1] + 0.5) / (sum(total) + 1)

    def bound(run):
        clean, toxic = held.get(("r", run), (0.0, 0.0))
        if not toxic:
            return 0.0
        n, p = clean + toxic, toxic / (clean + toxic)
        return (p + z * z / (2 * n) - z * (p * (1 - p) / n + z * z / (4 * n * n)) ** 0.5) / (1 + z * z / n)

    out = []
    for text, label in zip(texts, labels):
        odds = []
        for word in words(text):
            best = max([base, *(bound(r) for r in runs(word))])
            clean, toxic = held.get(("w", word), (0.0, 0.0))
            clean = clean if toxic else 0.0
            if own:
                clean, toxic = max(0.0, clean - (label == 0)), max(0.0, toxic - (label == 1))
            p = (toxic + shrink * best) / (clean + toxic + shrink)
            odds.append(np.log(p / (1 - p)) - np.log(base / (1 - base)))
        odds.sort(reverse=True)
        out.append([max(odds, default=0.0) if odds else 0.0, sum(odds[:3]), sum(x for x in odds if x > 1), np.log1p(len(odds))])
    return np.array(out)


def test_toxicity_equals_brute_force(spark, grams):
    """Distinct texts, so each has the weight 1: evidence of all texts and the regression's own conditions."""
    rng = np.random.default_rng(5)
    stems = ["blorv", "quim", "tandes", "orlick", "pemba", "sutter"]
    rows, labels = [], []
    for i in range(240):
        label = int(i % 4 == 0)
        words = [rng.choice(stems[2:]) + rng.choice(list("aeiou")) + rng.choice(list("mnrst")) for _ in range(30)]
        if label or i % 31 == 0:
            words += [stems[i % 2] + rng.choice(list("aeiou")) + rng.choice(list("mnrst")) for _ in range(1 + 4 * label)]
        rows.append((i, " ".join(rng.permutation(words)), "en", "a"))
        labels.append(label)
    texts = [r[1] for r in rows]
    found = toxicity.train_classifier(
        docs(spark, rows), spark.createDataFrame(list(zip(range(240), labels)), "doc_id long, toxic int"), grams)
    features = toxicity.Features(language.Letters(), toxicity.kernels.Powers(), texts)
    for own in (False, True):
        got = toxicity.evidence(features, 240, found, found.near(), np.array(labels) if own else None)
        assert np.allclose(got, brute_evidence(texts, labels, [1.0] * 240, own))
    rows_ = np.column_stack([(got - found.centre) / found.scale, np.ones(240)])
    p = 1 / (1 + np.exp(-rows_ @ found.weights))
    slope = rows_.T @ (p - np.array(labels)) + np.append(found.weights[:-1], 1e-3 * found.weights[-1])
    assert np.abs(slope).max() < 1e-6
    plain = brute_evidence(texts, labels, [1.0] * 240, False)
    want = 1 / (1 + np.exp(-((plain - found.centre) / found.scale @ found.weights[:-1] + found.weights[-1])))
    scored = by_id(toxicity.score_toxicity(docs(spark, rows), grams, found))
    assert np.allclose([scored[i]["score"] for i in range(240)], want)
    neutral = " ".join(texts[1].split()[:30])  # as long as those learned from
    fresh = by_id(toxicity.score_toxicity(docs(spark, [
        (1, f"{neutral} blorvux blorvif blorvaz blorvop blorvew", "en", "a"), (2, f"{neutral} wumbux wumbif wumbaz", "en", "a")]),
        grams, found))
    assert fresh[1]["predicted"] == 1 and fresh[2]["predicted"] == 0  # words never seen, of a stem that was


# -- 3 vectors --------------------------------------------------------------------


def brute_links(vectors, cosine=0.9):
    ids = sorted(vectors)
    unit = np.array([np.array(vectors[i], np.float64) / np.linalg.norm(vectors[i]) for i in ids])
    close = unit @ unit.T >= cosine
    return {a: {b for j, b in enumerate(ids) if close[i, j] and b != a} for i, a in enumerate(ids)}


def components(links):
    root = {i: i for i in links}
    changed = True
    while changed:
        changed = False
        for i, others in links.items():
            low = min([root[i], *(root[o] for o in others)])
            if low != root[i]:
                root[i], changed = low, True
    return root


def test_cells_of_many_lines():
    """Lines of a billion vectors: a part of rows is projected in blocks, the cells are those of all lines."""
    rng = np.random.default_rng(4)
    unit = rng.standard_normal((50, 8))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    count = embedding_dedup.calibrate(embedding_dedup.Projections(), 1_000_000_000).lines
    assert count > 200_000
    lines = embedding_dedup._Drawn(8, 5_000, 7)
    whole = unit.astype(np.float32) @ np.concatenate([block for _, block in lines.blocks()], axis=1)
    owner, cell = embedding_dedup.cells_of(unit, lines, 2.0)
    wanted = np.nonzero(np.concatenate([whole >= 2.0, whole <= -2.0], axis=1))
    assert np.array_equal(owner, wanted[0]) and np.array_equal(cell, wanted[1])
    tracemalloc.start()
    owner, cell = embedding_dedup.cells_of(unit, embedding_dedup._Drawn(8, count, 7), 3.9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(owner) and peak < 150e6 and (np.diff(owner) >= 0).all()


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = {}
    for i in range(400):
        base = rng.standard_normal(24)
        vectors[i] = base.tolist()
        if i % 8 == 0:
            for j in range(6):
                vectors[1000 + 10 * i + j] = (base + rng.standard_normal(24) * rng.uniform(0.1, 0.6)).tolist()
    frame = spark.createDataFrame([(i, [float(np.float32(x)) for x in v], 1) for i, v in vectors.items()], "vec_id long, embedding array<float>, cells int")
    vectors = {r[0]: r[1] for r in frame.collect()}
    links = brute_links(vectors)
    root = components(links)
    for block in (1500, 7):  # one block, and cells in many
        got = by_id(embedding_dedup.near_duplicate_vectors(frame, setting=embedding_dedup.Projections(block=block)))
        assert {i: r["n_links"] for i, r in got.items()} == {i: len(x) for i, x in links.items()}
        assert {i: r["component_id"] for i, r in got.items()} == root


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [nan, 1.0]),
            (8, [inf, 1.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (None, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = rows_of(embedding_dedup.near_duplicate_vectors(frame), "vec_id", "n_links", "component_id", "kept")
    alone = [(i, 0, i, True) for i in range(3, 10)]
    assert got == sorted([(1, 1, 1, True), (2, 1, 1, False), *alone, (None, 0, None, True), (None, 0, None, True)], key=repr)
    assert embedding_dedup.near_duplicate_vectors(frame.limit(0)).isEmpty()


# -- 4 chat -----------------------------------------------------------------------


NASTY = ["", "\\", "<|", "<\\|", "\\<|", "<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n", "<\\n>", "a\nb", "\\\\<\\\\|\\", "é<|😀|>"]


def test_chat_round_trip(spark):
    turns = [(c, i, "assistant" if i % 2 else "us\ner<|", t) for c in range(2) for i, t in enumerate([*NASTY, None])]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = chat.format_trees(chat.linear_messages(frame))
    read = out.select("conv_id", chat.parsed(chat.rendered(F.col("segments"))).alias("t"), chat.learned(F.col("segments")).alias("l"))
    for r in read.collect():
        assert [(t["role"], t["text"]) for t in r["t"]] == [(x[2], x[3] or "") for x in turns if x[0] == r["conv_id"]]
        assert r["l"] == "".join(x[3] or "" for x in turns if x[0] == r["conv_id"] and x[2] == "assistant")


def test_chat_trees(spark):
    rows = [  # two branches, an orphan, a cycle with a tail, a message without id, a repeated row, null conversation
        (1, 1, None, 0.0, "user", "q"), (1, 2, 1, 0.5, "assistant", "bad"), (1, 3, 1, 0.9, "assistant", "good"),
        (1, 4, 3, 0.0, "user", "more"), (1, 4, 3, 0.0, "user", "more"), (2, 5, 99, None, "user", "orphan"),
        (3, 6, 7, 1.0, "user", "cycle"), (3, 7, 6, 1.0, "user", "cycle"), (3, 8, 7, 1.0, "user", "tail"),
        (4, None, None, 1.0, "user", "no id"), (None, 1, None, 0.0, None, None),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, message_id long, parent_id long, score double, role string, text string")
    out = {(r["conv_id"], r["branch"]): [t["text"] for t in r["t"]] for r in chat.format_trees(frame, branches=2).select(
        "conv_id", "branch", chat.parsed(chat.rendered(F.col("segments"))).alias("t")).collect()}
    assert out == {(1, 1): ["q", "good", "more"], (1, 2): ["q", "bad"], (2, 1): ["orphan"], (None, 1): [""]}
    assert chat.format_trees(frame.limit(0)).isEmpty()


def test_chat_long_chain(spark):
    frame = spark.range(300).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    row = chat.format_trees(chat.linear_messages(frame)).select(chat.parsed(chat.rendered(F.col("segments"))).alias("t")).first()
    assert [t["text"] for t in row["t"]] == [str(i) for i in range(300)]


def test_chat_is_native(spark, folder):
    plan = QUERIES["op4_chat_formatting"](spark, folder)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# -- 5 licences -------------------------------------------------------------------


def test_licenses(spark, documents, edge):
    model = licenses.train(documents, most_rows=300, each=30, epochs=10)
    rows = [(1, "Some words here.\nReleased under the MIT License.\nMore words", "en", "a"), (2, "Licensed under CC BY-NC 4.0.", "en", "a"),
            (3, "Licensed under CC BY-SA 4.0.", "en", "a"), (4, "we took the bus under the bridge", "en", "a"), (5, "All rights reserved.", "en", "a"),
            (6, "a license to drive is required under the law", "en", "a")]
    got = by_id(licenses.scan_licenses(docs(spark, rows), model))
    assert [got[i]["license"] for i in range(1, 7)] == ["mit", "cc-by-nc", "cc-by-sa", "unknown", "reserved", "unknown"]
    assert [x["line"] for x in got[1]["found"]] == [1]
    scanned = licenses.scan_licenses(edge, model)
    assert scanned.count() == edge.count() and {r["license"] for r in scanned.collect()} == {"unknown"}
    assert licenses.scan_licenses(edge.limit(0), model).isEmpty()


def test_licenses_wrapped_and_inside_long_texts(spark, documents):
    model = licenses.train(documents)
    gpl = ("/*\n * This program is free software: you can redistribute it and/or\n * modify it under the terms of the GNU General\n"
           " * Public License as published by the Free\n * Software Foundation, either version 3.\n */\nint main;")
    bsd = ("# Redistribution and use in source and binary forms,\n# with or without modification, are permitted\n"
           "# provided that the following conditions are met:")
    share = "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License."
    text = " ".join(r["text"] for r in documents.filter("lang = 'en' and text is not null").orderBy("doc_id").limit(8).collect()).split()
    inside = " ".join([*text[:200], licenses.TEMPLATES["mpl"][0], *text[200:400]])
    both = " ".join([*text[:40], licenses.TEMPLATES["cc-by"][1], *text[40:50], licenses.TEMPLATES["mpl"][0], *text[50:90]])
    rows = [gpl, bsd, share, inside, both, " ".join(text[:400]), "\n".join(text[:400])]
    got = by_id(licenses.scan_licenses(docs(spark, [(i, t, "en", "a") for i, t in enumerate(rows)]), model))
    assert [got[i]["license"] for i in range(4)] == ["gpl", "bsd", "cc-by-sa", "mpl"]
    assert [len(got[i]["found"]) for i in range(4)] == [1, 1, 1, 1] and got[0]["found"][0]["line"] == 1
    assert {f["family"] for f in got[4]["found"]} == {"cc-by", "mpl"}
    assert got[5]["license"] == got[6]["license"] == "unknown"


def plain_scan(text, model, least, confirmed):
    """Families and shares found by looking at every line and window with sets and plain sums."""
    separators = licenses.kernels.separator_table(licenses.punctuation())
    spaced = "".join(" " if ord(c) < 128 and separators[ord(c)] else c for c in text)
    place = [(m.group(), text.count("\n", 0, m.start())) for m in WORD.finditer(spaced)]
    tables = licenses._tables()

    def of(words):
        one = licenses.Paragraphs(*licenses._encode([" ".join(words)]), *tables)
        return one.words.hashes, one.pair

    def chances(features):
        buckets = sorted({int(f) >> (64 - licenses.FEATURE_BITS) for f in features})
        logits = model.weights[buckets].astype(float).sum(axis=0) + model.bias
        return licenses._softmax(logits / model.temperature)

    def spans(words, family):
        hashes, pairs = of(words)
        own = set(hashes.tolist()) | set(pairs.tolist())
        for k, template, length in model.templates:
            whole = sum(t in own for t in template.tolist()) / len(template)
            if k == family and whole >= confirmed:
                best = (0.0, 0, 0)
                mine = set(template.tolist())
                for a in range(len(words)):
                    if int(hashes[a]) not in mine and (a + 1 == len(words) or int(pairs[a]) not in mine):
                        continue  # a span begins with something of the template
                    wide, seen, last = length + (length + 1) // 2, set(), a
                    for i in range(a, min(len(words), a + wide)):
                        for end, h in ((i + 1, int(hashes[i])), (i + 2, int(pairs[i]) if i + 1 < len(words) else -1)):
                            if end <= a + wide and h in mine:
                                seen.add(h)
                                last = max(last, end)
                    if len(seen) / len(template) > best[0]:
                        best = (len(seen) / len(template), a, last)
                yield whole, best

    candidates, classes = [], len(model.families)
    for line in sorted({n for _, n in place}):
        a = min(i for i, (_, n) in enumerate(place) if n == line)
        words = [w for w, n in place if n == line]
        hashes, pairs = of(words)
        chance = chances([*hashes.tolist(), *pairs.tolist()])
        family = int(chance.argmax())
        if family < classes and chance[family] >= least:
            whole, best = max(spans(words, family), key=lambda x: x[0], default=(0, None))
            if best:
                candidates.append((-whole, False, -float(chance[family]), family, a + best[1], a + best[2]))
    step = licenses.WINDOW // 2
    for a in range(0, max(1, len(place) - step) if place else 0, step):
        words = [w for w, _ in place[a: a + licenses.WINDOW]]
        hashes, pairs = of(words)
        chance = chances([*hashes.tolist(), *pairs.tolist()])
        for family in range(classes):
            p = float(chance[family] / (chance[family] + chance[-1]))
            if p >= least:
                share, begin, end = max((b for _, b in spans(words, family)), key=lambda x: x[0], default=(0.0, 0, 0))
                if share >= confirmed:
                    candidates.append((-share, True, -p, family, a + begin, a + end))
    taken, out = [], []
    for share, _, p, family, a, b in sorted(candidates, key=lambda c: (c[0], c[1], c[2], c[3], c[4])):
        if all(b <= x or y <= a for x, y in taken):
            taken.append((a, b))
            out.append((place[a][1], model.families[family], round(-p, 4), round(-share, 6)))
    return sorted(out)


def test_licenses_equal_brute_force(spark, documents):
    model = licenses.train(documents, most_rows=300, each=30, epochs=10)
    rng = np.random.default_rng(3)
    lines = [r["text"] for r in documents.filter("length(text) > 0").orderBy("doc_id").limit(30).collect()]
    notices = [t for f in licenses.TEMPLATES.values() for t in f]
    texts = ["", "one", " ".join(lines[:3])]
    for i in range(40):
        words = " ".join(lines[i % 30: i % 30 + 3]).split()
        for notice in rng.choice(notices, 1 + i % 3):
            notice = notice.split()
            if i % 2:
                notice = [w for w in notice if rng.random() > 0.15]
            at = int(rng.integers(0, len(words) + 1))
            words[at:at] = notice
        texts.append(" ".join(w + ("\n" if rng.random() < 0.05 else "") for w in words))
    got = by_id(licenses.scan_licenses(docs(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]), model))
    found = 0
    for i, text in enumerate(texts):
        plain = plain_scan(text, model, 0.5, 0.6)
        assert sorted((f["line"], f["family"], round(f["probability"], 4), round(f["held"], 6)) for f in got[i]["found"]) == plain, text
        found += len(plain)
    assert found > 40


def test_license_windows_are_scored_whether_or_not_they_hold_a_template(documents):
    model = licenses.train(documents, most_rows=300, each=30, epochs=10)
    scorer, tables = licenses._Scorer(model), licenses._tables()
    for n in (0, 1, 31, 32, 33, 63, 64, 65, 96, 97, 200):
        words = [f"w{i % 37}" if i % 3 else "license" for i in range(n)]
        windows = licenses.Paragraphs(*licenses._encode(["first text", " ".join(words), "last"]), *tables).windows()
        chance = scorer.windows(windows)
        parts = [["first", "text"], *(words[a: a + 64] for a in range(0, max(1, n - 32) if n else 0, 32)), ["last"]]
        assert len(chance) == len(parts)
        for got, part in zip(chance, parts):
            bucket = np.unique(licenses._bucket(licenses._features(" ".join(part), tables)))
            want = licenses._softmax((model.weights[bucket].astype(float).sum(axis=0) + model.bias) / model.temperature)
            # features that move all classes alike are left out of both sides of the softmax
            assert np.allclose(got, want, atol=1e-4)


def test_license_families(spark, documents):
    model = licenses.train(documents)
    rows = [(f, t) for f, notices in licenses.TEMPLATES.items() for t in notices]
    got = by_id(licenses.scan_licenses(docs(spark, [(i, t, "en", "a") for i, (_, t) in enumerate(rows)]), model))
    assert [got[i]["license"] for i in range(len(rows))] == [f for f, _ in rows]


# -- 6 quality --------------------------------------------------------------------


def test_quality(spark, documents, edge, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.train(documents, labels)
    got = by_id(quality.score_quality(documents, model))
    known = [(r["quality"], got[r["doc_id"]]["good"]) for r in labels.collect()]
    assert sum((q == 1) == g for q, g in known) / len(known) > 0.9
    scored = quality.score_quality(edge, model)
    assert scored.count() == edge.count()
    assert all(0 <= r["score"] <= 1 for r in scored.collect())
    assert {r["evidence"] for r in scored.filter("doc_id in (2, 3)").collect()} == {0.0}
    assert quality.score_quality(edge.limit(0), model).isEmpty()
    assert quality.train(documents, labels.limit(0)).bias == 0.0


def test_sparse_hosts_shrink(spark, documents):
    flat = quality.Model(np.zeros(10), np.ones(10), np.array([1.0, *[0.0] * 9]), -2.0, 0.5)
    rows = [(i, "a " * (40 if h == "good" else 1), "en", h) for i, h in enumerate(["good"] * 60 + ["bad"] * 60 + ["few"] * 2)]
    got = by_id(quality.score_quality(docs(spark, rows), flat))
    assert got[0]["host_posterior"] > got[120]["host_posterior"] > got[60]["host_posterior"]


# -- 7 MinHash --------------------------------------------------------------------


def shingle_set(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4)))


def brute_groups(texts, percent):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    links = {i: set() for i in sets}
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in holders[x] if j != i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                links[i].add(j)
    return sets, components(links)


@pytest.mark.parametrize("percent", [85, 80])
def test_minhash_equals_brute_force(spark, documents, percent):
    rng = np.random.default_rng(3)
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    base = [t for t in texts.values() if 100 < len(t.split()) < 400][0].split()
    for i in range(60):  # a group of near copies at many distances
        words = list(base)
        for at in rng.integers(0, len(words), rng.integers(0, 12)):
            words[at] = f"new{rng.integers(10**6)}"
        texts[5000 + i] = " ".join(words)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets, root = brute_groups(texts, percent)
    got = by_id(minhash.near_duplicates(frame, setting=minhash.MinHash(percent=percent)))
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r["component_id"] for i, r in got.items()} == root


def variants(rng, base, count, least, most):
    """Copies of a text with some words replaced, far enough apart for no shingle to stay in between."""
    for _ in range(count):
        words = list(base)
        for at in rng.choice(len(base) // 5, rng.integers(least, most + 1), replace=False):
            words[5 * at] = f"new{rng.integers(10**9)}"
        yield words


def test_minhash_finds_links_that_stars_lose(spark):
    rng = np.random.default_rng(8)
    texts = {}
    for group in range(6):
        base = [f"b{group}x{i}" for i in range(300)]
        texts[len(texts)] = " ".join(base)
        for branch in variants(rng, base, 25, 6, 10):  # near the base, and pairs of them nearer to each other
            texts[len(texts)] = " ".join(branch)
            for twig in variants(rng, branch, int(rng.integers(0, 3)), 1, 3):
                texts[len(texts)] = " ".join(twig)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets, root = brute_groups(texts, 85)
    assert len(set(root.values())) > 60
    got = by_id(minhash.near_duplicates(frame, setting=minhash.MinHash(percent=85)))
    assert {i: r["component_id"] for i, r in got.items()} == root


def test_minhash_mixed_buckets_make_few_pairs(spark, monkeypatch):
    rng = np.random.default_rng(9)
    base = [f"b{i}" for i in range(200)]
    made = []

    def members(labelled, *rest):
        mixed = labelled.groupBy("bucket").agg(F.countDistinct("c").alias("kinds")).filter("kinds > 1")
        made.append([labelled.join(mixed, "bucket", "left_semi").select("id").distinct().count()])
        return met_by(labelled, *rest)

    def compared(met, *rest):
        held = met.groupBy("bucket", "c").count().groupBy("bucket").agg(F.sum("count").alias("k"), F.max("count").alias("most"))
        made[-1].append(held.agg(F.coalesce(F.sum((F.col("k") - F.col("most")) * F.col("k")), F.lit(0))).first()[0])
        return across(met, *rest)

    met_by, across = minhash._met_by_shingles, minhash._across_components
    monkeypatch.setattr(minhash, "_met_by_shingles", members)
    monkeypatch.setattr(minhash, "_across_components", compared)
    for size in (400, 1600):  # each about 0.6 like their text: they share buckets, and nothing is linked
        texts = [(i, " ".join(w)) for i, w in enumerate(variants(rng, base, size, 9, 9))]
        frame = spark.createDataFrame(texts, "doc_id long, text string")
        assert minhash.near_duplicates(frame).filter("not kept").isEmpty()
    assert made[0][0] > 350 and made[1][0] > 1500
    assert all(pairs <= 2 * mixed for mixed, pairs in made), made  # before, each met all of its buckets


def test_minhash_edges(spark, edge):
    got = by_id(minhash.near_duplicates(edge).filter("doc_id is not null"))
    assert {i: r["component_id"] for i, r in got.items()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8, 9: 8}
    assert [got[i]["n_shingles"] for i in (2, 3, 4, 8)] == [0, 0, 0, 1]
    assert minhash.near_duplicates(edge).filter("doc_id is null and kept").count() == 2
    staying = minhash.drop_near_duplicates(edge)
    assert sorted(str(r["doc_id"]) for r in staying.collect()) == ["1", "2", "3", "4", "5", "7", "8", "None", "None"]
    assert staying.columns == edge.columns
    assert minhash.near_duplicates(edge.limit(0)).isEmpty() and minhash.drop_near_duplicates(edge.limit(0)).isEmpty()


def test_kernel_words():
    texts = ["Ab c", "", "  x\ty\nz ", "é à", "ab C"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    words = kernels.Words(np.frombuffer(b"".join(raw), np.uint8), offsets, kernels.byte_codes(), kernels.Powers(), kernels.separator_table())
    assert words.counts.tolist() == [2, 0, 3, 2, 2]
    assert words.hashes[0] == words.hashes[7] and words.hashes[1] == words.hashes[8] and len(set(words.hashes.tolist())) == 7


def test_components(spark):
    edges = [(2, 1), (3, 2), (4, 3), (10, 11), (12, 11), (5, 5), (None, 1)] + [(20 + i, 21 + i) for i in range(40)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = dict(tuple(r) for r in connected_components(frame).collect())
    assert got == {**{i: 1 for i in (1, 2, 3, 4)}, 10: 10, 11: 10, 12: 10, **{20 + i: 20 for i in range(41)}}
    assert connected_components(frame.limit(0)).isEmpty()


# -- 8 decontamination ------------------------------------------------------------


def test_tiles_are_maximal_and_reordered_passages_are_covered():
    item = list(range(100, 130))
    text = [1, 2, *item[15:], 3, *item[:15], 4]
    assert decontaminate.greedy_tiles(text, item, 5) == [(18, 0, 15), (2, 15, 15)]
    assert decontaminate.greedy_tiles([7] * 9, [7] * 6, 5) == [(0, 0, 6)]
    assert decontaminate.greedy_tiles(list(range(4)), list(range(4)), 5) == []


def brute_tiles(text, item, shortest):
    """Mark the longest match of free words, the first in the item and the text, until none is left."""
    free_text, free_item, tiles = [True] * len(text), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(text)):
                n = 0
                while i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n] and free_text[i + n] and free_item[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < shortest:
            return tiles
        n, i, j = best
        free_text[i: i + n], free_item[j: j + n] = [False] * n, [False] * n
        tiles.append((i, j, n))


def test_tiles_equal_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(60):
        text, item = rng.integers(0, 4, rng.integers(5, 60)).tolist(), rng.integers(0, 4, rng.integers(5, 25)).tolist()
        got = decontaminate.greedy_tiles(text, item, 3)
        assert got == brute_tiles(text, item, 3)
        assert all(text[i: i + n] == item[j: j + n] for i, j, n in got)
        assert len({j + k for _, j, n in got for k in range(n)}) == sum(n for *_, n in got)


def test_tiles_of_repeated_words():
    """Equal words, and words of a short period, cost little more than others."""
    started = time.time()
    assert decontaminate.greedy_tiles([7] * 20_000, [7] * 1_000, 5) == [(0, 0, 1_000)]
    period = list(range(9)) * 120
    broken = [x for i in range(200) for x in (*period[: 40 + i % 60], -1)]
    found = decontaminate.greedy_tiles(broken, period, 5)
    assert found[0][2] == 99 and len({j + k for _, j, n in found for k in range(n)}) == sum(n for *_, n in found)
    assert decontaminate.greedy_tiles(broken[:400], period[:70], 5) == brute_tiles(
        [-2 if x == -1 else x for x in broken[:400]], period[:70], 5)
    assert time.time() - started < 1.5  # seconds, the plain comparison included
    assert decontaminate.greedy_tiles([], [1, 2], 1) == decontaminate.greedy_tiles([1], [], 1) == []


def test_contamination(spark, edge):
    words = HELD.split()
    rows = [(1, f"intro here. {HELD.upper()}! and more", "en", "a"), (2, " ".join(words[8:] + ["x"] + words[:8]), "en", "a"),
            (3, " ".join(words[:6]), "en", "a"), (4, "nothing of it", "en", "a"), (None, HELD, "en", "a"), (1, "clean", "en", "a")]
    items = spark.createDataFrame([(10, HELD, 1), (11, "too short", 1), (12, None, 1), (None, "", 1)], "item_id long, text string, id int")
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs(spark, rows), items).collect()}
    assert {i: r["contaminated"] for i, r in got.items()} == {1: True, 2: True, 3: False, 4: False, None: True}
    assert got[2]["coverage"] == 1.0 and got[2]["n_tiles"] == 2 and got[4]["item_id"] is None
    left = decontaminate.drop_contaminated(docs(spark, rows), items)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4]
    assert decontaminate.contamination(edge, items).count() == 10
    assert decontaminate.contamination(edge.limit(0), items).isEmpty()
    assert not decontaminate.contamination(edge, items.limit(0)).filter("contaminated").count()


def test_items_with_a_repeating_pattern(spark):
    item = " ".join(["row", "row", "boat"] * 20)
    texts = docs(spark, [(1, f"before {item} after", "en", "a"), (2, "row row boat row row boat and nothing more", "en", "a")])
    got = by_id(decontaminate.contamination(texts, spark.createDataFrame([(7, item)], "item_id int, text string")))
    assert (got[1]["contaminated"], got[1]["coverage"], got[1]["item_id"]) == (True, 1.0, 7)
    assert not got[2]["contaminated"]


# -- 9 language -------------------------------------------------------------------


def brute_path(scores, penalty):
    best = [(s, [k]) for k, s in enumerate(scores[0])]
    for row in scores[1:]:
        best = [max((v + (0 if p[-1] == k else -penalty) + s, p + [k]) for v, p in best) for k, s in enumerate(row)]
    return max(v for v, _ in best)


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(4)
    counts = np.array([5, 0, 12, 1, 30])
    scores = rng.normal(0, 4, (counts.sum(), 3)).astype(np.float32)
    labels = language.viterbi(scores, counts, 3.0)
    first = np.concatenate([[0], np.cumsum(counts)])
    for a, b in zip(first[:-1], first[1:]):
        if b > a:
            own = labels[a:b]
            value = scores[np.arange(a, b), own].astype(float).sum() - 3.0 * (own[1:] != own[:-1]).sum()
            assert abs(value - brute_path(scores[a:b].astype(float).tolist(), 3.0)) < 1e-4


def test_language(spark, documents, edge):
    model = language.train(documents)
    got = by_id(language.label_spans(documents, model))
    right = [got[r["doc_id"]]["lang_pred"] == r["lang"] for r in documents.collect()]
    assert sum(right) / len(right) > 0.97
    found = language.label_spans(edge, model, keep=("doc_id", "text", "score"))
    assert found.count() == edge.count()
    none = found.filter("doc_id in (2, 3, 4)").collect()
    assert all(r["lang_pred"] == "und" and r[4] == 0.0 and r["spans"] == [] for r in none)
    assert language.label_spans(edge.limit(0), model).isEmpty()
    empty = language.train(edge.limit(0))
    assert {r["lang_pred"] for r in language.label_spans(edge, empty).collect()} == {"und"}
    assert language.drop_unidentified(edge, empty).count() == edge.count() - 4


def test_mixed_spans_and_scripts(spark):
    english, russian = "the house and the garden are near the old river bank", "дом и сад стоят рядом со старой рекой в городе"
    model = language.train(docs(spark, [(1, english * 20, "en", "a"), (2, russian * 20, "ru", "a"), (3, "la casa y el jardín " * 40, "es", "a")]))
    row = language.label_spans(docs(spark, [(9, f"{english}. {russian}", None, None)]), model).first()
    text = f"{english}. {russian}"
    assert [(text[s["begin"]: s["end"]], s["lang"]) for s in row["spans"]] == [(english, "en"), (russian, "ru")]


def test_mixed_and_short_texts_are_identified(spark):
    parts = {"en": "the weather which they thought", "de": "zwischen möchten schließlich gegenüber", "fr": "aujourd beaucoup quelque toujours",
             "pl": "wszystko dziękuję przepraszam", "fi": "yhdessä kuitenkin mielestäni"}
    rows = [(i, f"{t} xo " * 20, name, "a") for i, (name, t) in enumerate(parts.items())]
    model = language.train(docs(spark, rows))
    mixed = " ".join(" ".join([t] * 6) for t in parts.values())
    texts = docs(spark, [(10, mixed, None, "a"), (11, "xo", None, "a"), (12, "12 - 34", None, "a"), (13, None, None, "a")])
    labelled = by_id(language.label_spans(texts, model))
    assert len(labelled[10]["spans"]) == 5 and max(labelled[i]["score"] for i in (10, 11)) < 0.3
    kept = language.drop_unidentified(texts, model)
    assert kept.columns == texts.columns and sorted(r["doc_id"] for r in kept.collect()) == [10, 11]


# -- 10 lines ---------------------------------------------------------------------


def test_lines_edges(spark, edge):
    out = lines.dedup_lines(edge)
    assert out.count() == edge.count() and out.columns == [*edge.columns, "n_lines", "n_removed"]
    assert rows_of(out, "doc_id", "text") == rows_of(edge, "doc_id", "text")
    assert lines.dedup_lines(edge.limit(0)).isEmpty()


def test_lines_keep_the_first(spark):
    boiler, long = "sign up now", "x" * 250
    rows = [(i, f"own {i}\n {boiler}\t\n\nend {i}\n{long if i < 13 else i}", "en", f"s{i}") for i in range(10, 20)]
    rows += [(30, boiler, "en", None), (31, "own 10", "en", "s10")]
    got = by_id(lines.dedup_lines(docs(spark, rows)))
    assert got[10]["text"] == rows[0][1] and got[11]["text"] == "own 11\n\nend 11" and got[15]["text"] == "own 15\n\nend 15\n15"
    assert (got[11]["n_lines"], got[11]["n_removed"]) == (4, 2)
    assert got[30]["text"] == "" and got[31]["n_removed"] == 0


# -- pipeline ---------------------------------------------------------------------


def test_pipeline(spark, folder, documents):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "line_dedup", "near_dedup", "decontaminate", "mix"]
    stage = documents
    for name, function in corpus_pipeline.STAGES[:-1]:
        before, stage = stage, function(spark, stage, folder)
        assert stage.columns == documents.columns
        assert stage.join(before, "doc_id", "left_anti").isEmpty()
    out = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in out.collect()} <= {r["doc_id"] for r in stage.collect()}
    digest = hashlib.md5(repr(rows_of(out, "doc_id", "copy")).encode()).hexdigest()
    assert digest == hashlib.md5(repr(rows_of(corpus_pipeline.run(spark, folder), "doc_id", "copy")).encode()).hexdigest()


def test_pipeline_edges(spark, edge, folder):
    for rows in (edge, edge.limit(0)):
        stage = rows
        for _, function in corpus_pipeline.STAGES:
            stage = function(spark, stage, folder)
        assert stage.count() >= 0
