from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveworks.llm import langid, quality, toxicity
from sieveworks.llm.common import fold

ODD = [(9001, None), (9002, ""), (9003, "12345 !!"), (9004, "lone 😀"), (9005, "word " * 60_000), (9005, "word " * 60_000)]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(3)
    words = {"en": "the of and to in is that it was for on are with as at be this have from".split(), "fr": "le la les des une est pas que dans pour qui sur avec être où déjà".split()}
    rows, labels = [], []
    for i in range(600):
        lang = ("en", "fr")[i % 2]
        text = list(rng.choice(words[lang], 40))
        toxic, bad = i % 5 == 0, i % 3 == 0
        if toxic:
            text[int(rng.integers(40))] = str(rng.choice(["stupid", "idiot"]))
        rows.append((i, ("!!! ".join(text[:6]) + " !!!") * 8 if bad else " ".join(text), lang))
        labels.append((i, int(not bad), int(toxic)))
    rows += [(i, t, None) for i, t in ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1))
    return docs, spark.createDataFrame([*labels, (9002, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int")


def test_language(spark, corpus):
    docs, _ = corpus
    got = {r["doc_id"]: r for r in langid.predict(docs, langid.train(docs, fold("doc_id", 4) != 2)).collect()}
    assert all(got[i]["lang_pred"] == ("en", "fr")[i % 2] and 0.5 <= got[i]["score"] <= 1 for i in range(600))
    assert [got[i]["lang_pred"] for i in (9001, 9002, 9003)] == ["und"] * 3
    none = langid.predict(docs, langid.train(docs, F.lit(False))).groupBy("lang_pred").count().collect()
    assert [(r["lang_pred"], r["count"]) for r in none] == [("und", 606)]


def test_a_text_has_one_score_in_any_company(spark, corpus):
    docs, labels = corpus
    texts = docs.where("doc_id < 40 or doc_id > 9000").distinct()
    languages, toxic = langid.train(docs, fold("doc_id", 4) != 2), toxicity.train(docs, labels, "toxic", F.lit(True))
    good = quality.train(quality.features(docs), labels, "quality", F.lit(True))
    for score in (lambda d: langid.predict(d, languages), lambda d: toxicity.score(d, toxic), lambda d: quality.score(quality.features(d), good)):
        together = {r["doc_id"]: r["score"] for r in score(texts.coalesce(1)).collect()}
        alone = {r["doc_id"]: r["score"] for r in score(texts.repartition(45)).collect()}
        assert together.keys() == alone.keys() and all(abs(together[i] - alone[i]) < 1e-6 for i in alone)


def test_language_against_brute_force(spark):
    rows = [(1, "aba abb", "x"), (2, "cdc ddc", "y"), (3, "ab", None), (4, "Cd cD", None), (5, "zz", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    letters = langid.letter_table()
    logs = {}
    for lang, text in (("x", rows[0][1]), ("y", rows[1][1])):
        for k, n in enumerate(langid.ORDERS):
            count = np.full(1 << langid.BITS, 0.5)
            padded = f" {text} "
            for j in range(len(padded) - n + 1):
                count[langid.char_ngrams(letters[[ord(c) for c in padded[j : j + n]]], n, langid.BITS)[0]] += 1
            logs[lang, k] = np.log(count / count.sum())
    got = {r["doc_id"]: r for r in langid.predict(docs, langid.train(docs, F.lit(True))).collect()}
    for i, text, _ in rows:
        padded = f" {text} "
        total = {}
        for lang in "xy":
            total[lang] = sum(
                logs[lang, k][langid.char_ngrams(letters[[ord(c) for c in padded[j : j + n]]], n, langid.BITS)[0]]
                for k, n in enumerate(langid.ORDERS) for j in range(len(padded) - n + 1)
            ) / np.sqrt(len(padded))
        best = max("xy", key=lambda x: (total[x], -ord(x)))  # a tie: the first by name
        assert got[i]["lang_pred"] == best and abs(got[i]["score"] - 1 / (1 + np.exp(-abs(total["x"] - total["y"])))) < 1e-4
    assert got[5]["lang_pred"] == "x"


def test_null_ids_large_ids_and_empty_tables(spark, tmp_path):
    big = (1 << 62) + 1
    docs = spark.createDataFrame([(None, "some text", "en", 1), (big, "other text", "en", 2), (big, "other text", "en", 2)], "doc_id long, text string, lang string, score int")
    labels = spark.createDataFrame([(big, 1, 0)], "doc_id long, quality int, toxic int")
    for k, (d, l) in enumerate(((docs, labels), (docs, labels.where("doc_id = 0")), (docs.where("doc_id = 0"), labels), (docs.where("doc_id = 0"), labels.where("doc_id = 0")))):
        place = str(tmp_path / str(k))
        d.write.parquet(f"{place}/documents.parquet")
        l.write.parquet(f"{place}/labels.parquet")
        for query in (toxicity.query, quality.query, langid.query):
            rows = query(spark, place).collect()
            assert sorted(str(r["doc_id"]) for r in rows) == ([str(big), str(big), "None"] if k < 2 else [])
            assert all(r["held_out"] is not None and 0 <= r["score"] <= 1 for r in rows)
            assert not [r for r in rows if r["doc_id"] is None and r["held_out"]]


def test_logistic_against_the_gradient():
    rng = np.random.default_rng(6)
    n, k = 60, 8
    full = rng.normal(size=(n, k)) * (rng.random((n, k)) < 0.6)
    full[:, 0] = 1.0  # no row is empty
    y = (full @ rng.normal(size=k) + rng.normal(size=n) > 0).astype(float)
    row, idx = np.nonzero(full)
    starts = np.searchsorted(row, np.arange(n))
    w, b, still = toxicity.logistic(starts, idx.astype(np.int32), full[row, idx].astype(np.float32), y, k)
    p = 1 / (1 + np.exp(-(full @ w + b)))
    assert still and np.abs(full.T @ (p - y) / n + toxicity.RIDGE * w).max() < 0.02


def test_toxicity(spark, corpus):
    docs, labels = corpus
    got = toxicity.score(docs, toxicity.train(docs, labels, "toxic", fold("doc_id", 4) != 2)).collect()
    assert len(got) == 606 and all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    held = [r["doc_id"] for r in docs.where((fold("doc_id", 4) == 2) & (F.col("doc_id") < 600)).collect()]
    toxic = [score[i] for i in held if i % 5 == 0 and i % 3]
    clean = [score[i] for i in held if i % 5]
    assert min(toxic) > max(clean) and min(toxic) > 0.3 > max(clean)


def test_toxicity_without_a_class(spark, corpus):
    docs, labels = corpus
    model = toxicity.train(docs, labels.where("toxic = 0"), "toxic", F.lit(True))
    assert toxicity.score(docs, model).agg(F.max("score")).first()[0] < 1e-6


def test_quality(spark, corpus):
    docs, labels = corpus
    got = {r["doc_id"]: r["score"] for r in quality.classify(docs, labels, fold("doc_id", 3) != 1).collect()}
    assert len(got) == 605 and all(0 <= x <= 1 for x in got.values())
    assert all((got[i] >= 0.5) == (i % 3 != 0) for i in range(600))
    none = quality.classify(docs, labels, F.lit(False)).select("score").distinct().collect()
    assert [r["score"] for r in none] == [0.5]


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(40):
        y, n = rng.random(7), rng.integers(1, 5, 7).astype(float)
        got = quality.isotonic(np.arange(7), y, n)
        # min-max formula of isotonic regression
        mean = lambda a, b: (y[a:b] * n[a:b]).sum() / n[a:b].sum()
        want = [max(min(mean(a, b) for b in range(i + 1, 8)) for a in range(i + 1)) for i in range(7)]
        assert np.allclose(got, want)
