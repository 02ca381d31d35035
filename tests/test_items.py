from __future__ import annotations

import numpy as np
import pytest

from sieveworks.operators import items, similarity

CHUNK = "chunk_id string, doc_id string, page int, ord int, text string"
QUOTE = "qa_id string, quote_no int, doc_id string, page int, quote string"


@pytest.fixture(scope="module")
def chunks(spark):
    return spark.createDataFrame([
        ("a__c0000", "a", None, 0, "alpha beta"), ("a__c0001", "a", None, 1, "gamma  delta"), ("b__c0000", "b", 1, 0, "one two"),
        ("b__c0001", "b", 1, 1, "three four"), ("b__c0002", "b", 2, 2, "five six"),
    ], CHUNK)


def test_anchors(spark, chunks):
    quotes = spark.createDataFrame([
        ("q1", 0, "a", None, "gammadelta"), ("q2", 0, "b", 1, "three\nfour"), ("q3", 0, "b__c0002", None, "xx"), ("q4", 0, "b__c0001", 2, "six"),
        ("q5", 0, "b", 9, "five"), ("q6", 0, "zzz", 1, "one"), ("q7", 0, "b", 1, ""),
    ], QUOTE)
    got = {r["qa_id"]: r["chunk_id"] for r in items.resolve_anchors(quotes, chunks).collect()}
    assert got == {"q1": "a__c0001", "q2": "b__c0001", "q3": "b__c0002", "q4": "b__c0002", "q5": "b__c0002", "q7": "b__c0000"}


def test_grounding(spark, chunks):
    quotes = spark.createDataFrame([("q1", 0, "a", None, "alphabeta"), ("q1", 1, "a", None, "nowhere"), ("q2", 0, "x", 1, "y"), ("q3", 0, "b", 1, "one two")], QUOTE)
    got = {r["qa_id"]: r["rationale_grounded"] for r in items.grounding(quotes, items.resolve_anchors(quotes, chunks)).collect()}
    assert got == {"q1": 0.5, "q2": 0.0, "q3": 1.0}


def test_hits(spark):
    quotes = spark.createDataFrame([("q1", 0, "a", 1, "b c"), ("q2", 0, "a__c0001", 1, "zz"), ("q3", 0, "x", 1, "zz"), ("q4", 0, "a", 1, "q")], QUOTE)
    found = spark.createDataFrame([("q1", 1, "a__c0000", "a", "a b"), ("q1", 2, "b__c0000", "b", "c d"), ("q2", 1, "a__c0001", "a", "t"), ("q3", 1, "b__c0000", "b", "t")], "qa_id string, rank int, chunk_id string, doc_id string, text string")
    got = {r["qa_id"]: (r["hit_doc"], r["hit_chunk"]) for r in items.retrieval_hits(quotes, found).collect()}
    assert got == {"q1": (True, True), "q2": (True, False), "q3": (False, False), "q4": (False, False)}


def test_remote_partners_keep_their_distance(spark):
    rows = spark.createDataFrame([("d", i) for i in range(9)] + [("e", 0), ("e", 1)], "doc_id string, position int")
    got = items.remote_partners(rows).collect()
    assert len(got) == 9 and all(abs(r["partner"] - r["position"]) >= 3 and 0 <= r["partner"] < 9 for r in got)


def test_followed_references(spark):
    rows = spark.createDataFrame([("c1", ["r", "s"]), ("c2", ["r"]), ("c3", ["r", "r"])], "chunk_id string, refs array<string>")
    got = {(r["chunk_id"], r["ref"]): r["target"] for r in items.followed_references(rows).collect()}
    assert got == {("c1", "r"): "c2", ("c2", "r"): "c1", ("c3", "r"): "c1"}
    rows = spark.createDataFrame([("c1", ["JIS B 1083"]), ("c2", ["JIS B 1083-1"]), ("c3", [""]), ("c4", None)], "chunk_id string, refs array<string>")
    assert [tuple(r) for r in items.followed_references(rows).select("chunk_id", "ref", "target").collect()] == [("c1", "JIS B 1083", "c2")]


def vectors(spark, v, labels=None):
    return spark.createDataFrame([(i, [float(x) for x in row], (labels or [0] * len(v))[i]) for i, row in enumerate(v)], "id long, vec array<double>, label long")


def test_nearest_is_exact(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 7)
    v = np.random.default_rng(0).normal(size=(60, 8))
    corpus = vectors(spark, v, [i % 3 for i in range(60)])
    n = v / np.linalg.norm(v, axis=1, keepdims=True)
    sims = n @ n.T
    np.fill_diagonal(sims, -9)
    got = similarity.nearest(corpus, corpus.where("id % 3 = 0"), 4).collect()
    assert {(r["query"], r["id"]) for r in got} == {(q, int(j)) for q in range(0, 60, 3) for j in np.argsort(-sims[q])[:4]}
    u = {r["id"]: r["uniqueness"] for r in similarity.uniqueness(corpus).collect()}
    assert all(abs(u[i] - (1 - max(0, sims[i].max()))) < 1e-9 for i in range(60))


def test_ties_go_by_id_and_bad_vectors_raise(spark):
    corpus = vectors(spark, [[1, 0], [1, 0], [2, 0], [0, 1], [0, 0]])
    got = similarity.nearest(corpus, corpus.where("id = 2"), 2).orderBy("rank").collect()
    assert [r["id"] for r in got] == [0, 1]
    assert similarity.nearest(corpus, corpus, 0).count() == 0
    with pytest.raises(ValueError):
        similarity.nearest(corpus, corpus.where("id = 4"), 1)
    with pytest.raises(Exception, match="width"):
        similarity.nearest(corpus, vectors(spark, [[1, 0, 0]]), 1).collect()


def test_latest_and_reports(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string")
    from pyspark.sql import functions as F

    assert {(r["k"], r["v"]) for r in items.latest(log, "k", [F.col("t").desc()]).collect()} == {("a", "y"), ("b", "z")}
    from sieveworks import dims

    rows = spark.createDataFrame([("Easy",), ("Easy",), ("odd",), (None,)], "retrieval_level string")
    got = items.distribution(rows, "retrieval_level", dims.domain(spark, "level", dims.LEVELS), "level").orderBy("ord").collect()
    assert [(r["n"], r["ratio"]) for r in got] == [(2, 0.5), (0, 0.0), (0, 0.0)]
