"""The pipeline's language stage decides by the confidence of the path."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vectorferry.llm import language

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def model(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return language.train(rows)


@pytest.fixture(scope="module")
def words(spark):
    """Clean words by language, as they stand in the tables."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").groupBy("lang").agg(F.max("text").alias("t")).collect()
    return {r["lang"]: [w for w in r["t"].split() if w.isalpha()][:40] for r in rows}


def frame(spark, texts):
    return spark.createDataFrame([(i, t, None, "a", len(t or "")) for i, t in enumerate(texts)], DOCS)


def test_junk_goes_and_language_stays(spark, model, words):
    clean = [" ".join(w) for w in words.values()]
    mixed = [" ".join(itertools.chain(*words.values())), " ".join(itertools.chain(*zip(*(w[:10] for w in words.values()))))]
    short = [w[0] for w in words.values()]
    junk = ["xqzvk wjqxz pfkqj zzxwq vbqkx " * 5, "qqqqqqqqqqqqqqqqqqqqqqqqq", "字字字字字字", "zxzxzxzx kqkqkqkq", None, "", "12 34 --"]
    rows = frame(spark, clean + mixed + short + junk)
    kept = {r["doc_id"] for r in language.drop_unidentified(rows, model).collect()}
    letters = {r["doc_id"] for r in rows.filter(F.col("text").rlike(r"\p{L}")).collect()}
    good = set(range(len(clean + mixed + short)))
    assert good <= kept and kept != letters
    lost = [junk[i - len(good)] for i in range(len(good), rows.count()) if i not in kept]
    assert {j for j in junk if j is None or not any(c.isalpha() for c in j)} <= set(lost)
    assert "qqqqqqqqqqqqqqqqqqqqqqqqq" in lost and "字字字字字字" in lost


def test_half_junk_has_half_the_confidence(spark, model, words):
    clean = " ".join(words["en"][:20])
    junk = "q" * sum(map(len, words["en"][:20]))
    got = language.label_spans(frame(spark, [clean, f"{clean} {junk}", junk]), model).orderBy("doc_id").collect()
    assert got[0]["confidence"] > 0.9 and got[1]["confidence"] == pytest.approx(got[0]["confidence"] / 2, abs=0.02)
    assert got[2]["confidence"] < 0.05


def test_confidence_is_that_of_the_best_path(spark, model, words):
    """All labellings of short texts, word by word."""
    texts = [" ".join(words["en"][:3]), f"{words['de'][0]} {words['fr'][1]} xqxq", f"{words['es'][2]} {words['en'][4]}", "Zq", "字 the"]
    got = {r["doc_id"]: r for r in language.label_spans(frame(spark, texts), model, penalty=12.0).collect()}
    tables = language.Letters()
    for number, text in enumerate(texts):
        parts = language.LetterWords(tables, [text])
        scores = language.word_scores(parts, model).astype(float)
        paths = itertools.product(range(len(model.languages)), repeat=len(scores))
        best = max(paths, key=lambda p: sum(scores[i, k] for i, k in enumerate(p)) - 12.0 * sum(a != b for a, b in zip(p, p[1:])))
        sure = letters = 0
        for i, (label, word) in enumerate(zip(best, text.split())):
            low = word.lower()
            single = [float(model.letters[min(ord(c), language.PLANES - 1)]) for c in low]
            edges = [float(model.letters[0]), *single, float(model.letters[0])]
            chance = sum(edges[j] + edges[j + 1] + edges[j + 2] for j in range(len(low)))
            chance = math.log(0.5 * math.exp(chance) + 0.5 * model.kinds ** (-3.0 * len(low)))
            lead = scores[i, label] - chance + language.DOUBT
            known = model.scripts[parts.script[i]].any()
            sure += len(low) * (1 / (1 + math.exp(-np.clip(lead, -50, 50))) if known else 0)
            letters += len(low)
        assert got[number]["confidence"] == pytest.approx(sure / letters, rel=1e-4, abs=1e-6)


def test_stage_keeps_the_tables_and_drops_planted_junk(spark):
    """Of the given documents none goes; planted letter junk does, and columns stay."""
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    planted = spark.range(20).select(
        (F.col("id") + 10_000_000).alias("doc_id"), F.repeat(F.lit("qxzjq vkqzx "), 30).alias("text"),
        F.lit(None).cast("string").alias("lang"), F.lit("junk").alias("source"), F.lit(360).cast("bigint").alias("n_chars"))
    kept = corpus_pipeline.identify_language(spark, rows.unionByName(planted), folder)
    assert kept.columns == rows.columns
    assert kept.filter("doc_id < 10000000").count() == rows.count() and kept.filter("doc_id >= 10000000").isEmpty()


def test_trigrams_are_told_apart(spark):
    """No two trigrams share a place, whatever their number; those not seen have none."""
    points = np.arange(0x61, 0x61 + 26, dtype=np.uint64)
    keys = ((points[:, None, None] << np.uint64(42)) | (points[None, :, None] << np.uint64(21)) | points[None, None, :]).ravel()
    seen, unseen = keys[::2], keys[1::2]
    slots, rows = language._table(np.sort(seen))
    model = language.Model((), np.zeros((1, 0)), slots, rows, np.zeros((0, 0)), np.zeros(0), 1)
    assert model.place(np.sort(seen)).tolist() == list(range(1, len(seen) + 1)) and not model.place(unseen).any()


def test_letters_beyond_the_tables(spark):
    rows = frame(spark, ["\U0003134a\U0003134b \U0003134a", "abc"])
    trained = language.train(rows.withColumn("lang", F.when(F.col("doc_id") == 0, "zz").otherwise("aa")))
    got = [r["lang_pred"] for r in language.label_spans(rows, trained).orderBy("doc_id").collect()]
    assert got == ["zz", "aa"]
