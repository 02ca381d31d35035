from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from sieveworks import schemas
from sieveworks.functions import text
from sieveworks.operators import anchors


@pytest.fixture(scope="module")
def chunks(spark):
    rows = [(f"a__c{i:04d}", "a", None, f"text {i}", i, [], ["ISO 9001"] if i == 2 else []) for i in range(6)]
    rows += [("b__c0000", "b", None, "see ISO 9001 <table", 0, [], ["ISO 9001", "第3条"]), ("c__c0000", "c", None, "as in 第3条", 0, [], ["第3条"])]
    return spark.createDataFrame(rows, schemas.CHUNK)


def ask(spark, chunks, *aspects, vectors=None):
    df = spark.createDataFrame(list(enumerate(aspects)), "request_id int, aspect string")
    return {r["request_id"]: r for r in anchors.anchor_sets(df, chunks, vectors).collect()}


def ids(row):
    return [c["chunk_id"] for c in row["anchors"]]


def test_strategies(spark, chunks):
    got = ask(spark, chunks, "simple_table", "remote_reference", "standards_reference", "flowchart", "causal", "multi_hop", "simple_table")
    assert ids(got[0]) == ids(got[6]) == ["b__c0000"] and got[0]["miss"] is None
    assert got[3]["miss"] == got[4]["miss"] == "compat" and len(ids(got[3])) == 1
    pair = got[1]["anchors"]
    assert len(pair) == 1 or (pair[0]["doc_id"] == pair[1]["doc_id"] and abs(pair[0]["position"] - pair[1]["position"]) >= 3)
    assert got[2]["miss"] is None and set(ids(got[2])) <= {"a__c0002", "b__c0000", "c__c0000"} and len(ids(got[2])) == 2
    assert got[5]["miss"] == "partner"


def test_neighbours(spark, chunks):
    v = {"a__c0000": [1, 0, 0], "a__c0001": [0.99, 0.1, 0], "b__c0000": [0.9, 0.2, 0], "c__c0000": [0, 0, 1]}
    vectors = spark.createDataFrame([(k, [float(y) for y in x]) for k, x in v.items()], "chunk_id string, vec array<double>")
    few = chunks.join(vectors.select("chunk_id"), "chunk_id").select(chunks.columns)
    got = ask(spark, few, *["multi_doc_reference"] * 4, *["multi_hop"] * 4, vectors=vectors)
    near = {ids(r)[0]: ids(r)[1:] for r in got.values() if r["aspect"] == "multi_hop"}
    other = {ids(r)[0]: ids(r)[1:] for r in got.values() if r["aspect"] == "multi_doc_reference"}
    assert near == {"a__c0000": ["a__c0001"], "a__c0001": ["a__c0000"], "b__c0000": ["a__c0001"]}  # c has none near: another first anchor is tried
    assert other == {"a__c0000": ["b__c0000"], "a__c0001": ["b__c0000"], "b__c0000": ["a__c0001"]}
    assert {r["miss"] for r in got.values()} == {None}
    only = few.where("doc_id <> 'b'")
    got = ask(spark, only, "multi_doc_reference", "multi_doc_reference", vectors=vectors.where("chunk_id not like 'b%'"))
    assert all(set(ids(r)) == {"a__c0000", "a__c0001"} for r in got.values())  # no near chunk elsewhere: one of the same document


@pytest.mark.parametrize("body,quote,want", [
    ("a <b> rated 24 V & more", "rated  24\nV", "a &lt;b&gt; <mark>rated 24 V</mark> &amp; more"), ("abc.def", "abcxdef", "abc.def"), ("abc", "abc", "abc"), ("x(y)+z?", "(y)+z", "x<mark>(y)+z</mark>?"),
])
def test_highlight(spark, body, quote, want):
    df = spark.createDataFrame([(body, quote)], "b string, q string")
    assert df.select(text.highlighted(F.col("b"), F.col("q")).alias("x")).first()["x"] == want


def test_bullets(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "x array<string>").select(text.bullets(F.col("x")).alias("t"))
    assert [r["t"] for r in df.collect()] == ["- a\n- b", "(該当なし)"]


def test_first_anchors_are_found_by_rank(spark, chunks):
    """Requests and chunks of one aspect meet by aspect and rank, not all with all, and come in the order of the hash."""
    rows = [(f"d{i}__c0000", f"d{i}", None, "<table" if i % 3 else "x", 0, [], []) for i in range(700)]
    asked = [(i, a) for i, a in enumerate(["simple_table", "multi_hop", "flowchart"] * 150)]
    requests = spark.createDataFrame(asked, "request_id int, aspect string")
    got = anchors.first_anchors(requests, anchors.marked(spark.createDataFrame(rows, schemas.CHUNK)))
    want = set()
    for aspect in ("simple_table", "multi_hop", "flowchart"):
        pool = [r[0] for r in rows if aspect != "simple_table" or r[3] == "<table"]
        pool = sorted(pool, key=lambda c: (hashlib.md5(f"42:{aspect}:{c}".encode()).hexdigest(), c))[: 150 + anchors.ATTEMPTS]
        for i, (request, _) in enumerate(x for x in asked if x[1] == aspect):
            want |= {(request, aspect, t, pool[(i + t) % len(pool)], aspect != "flowchart") for t in range(anchors.ATTEMPTS if aspect == "multi_hop" else 1)}
    assert set(map(tuple, got.collect())) == want and got.count() == len(want)
    joins = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line and "aspect" in line]
    assert any(re.search(r"n#\d+L? = ", line) or re.search(r"= n#\d+L?", line) for line in joins)
    assert not any("pmod" in line for line in joins)
