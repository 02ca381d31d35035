from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sieveworks.operators import asking, chunking


def pieces(spark, texts, size, overlap):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r["p"] for r in df.select("i", chunking.pieces(F.col("text"), size, overlap).alias("p")).orderBy("i").collect()]


CASES = [
    ("", 20, 5, []),
    ("  ", 20, 5, []),
    ("short", 20, 5, ["short"]),
    ("a b c d e f g h i j k l m n", 20, 5, ["a b c d e f g h i j", "h i j k l m n"]),
    ("one. two! three? four. five", 20, 5, ["one. two! three?", "hree? four. five"]),
    ("one. two! three? four. five", 12, 0, ["one. two!", "three? four.", "five"]),
    ("para one\n\npara two\n\n\npara three is longer", 20, 5, ["para one para two", "a two para three is", "ee is longer"]),
    ("para one\n\npara two", 12, 0, ["para one", "para two"]),
    ("x" * 45, 20, 5, ["x x x x x x x x x x"] * 6),
]


@pytest.mark.parametrize("text,size,overlap,chunks", CASES)
def test_pieces(spark, text, size, overlap, chunks):
    assert pieces(spark, [text], size, overlap) == [chunks]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab .\n!c", max_size=80), min_size=20, max_size=20))
def test_pieces_of_any_text(spark, texts):
    """Without overlap nothing but white space goes, and order stays; with it each chunk begins as the one before it ends."""
    bare = lambda x: "".join(x.split())
    for text, chunks in zip(texts, pieces(spark, texts, 16, 0), strict=True):
        assert bare("".join(chunks)) == bare(text) and all(x.strip() and len(x) <= 16 for x in chunks)
    for chunks in pieces(spark, texts, 16, 4):
        assert all(b.startswith(a[-4:].lstrip()) for a, b in zip(chunks, chunks[1:], strict=False)) and all(len(x) <= 16 + 4 + 1 for x in chunks)


@pytest.mark.parametrize("unit", ["word and ", "x", "A sentence. ", "line\n"])
def test_time_grows_with_the_text(spark, unit):
    """Five million characters: ten times the text takes about ten times the time."""
    import time

    took = []
    for n in (500_000, 5_000_000):
        text = unit * (n // len(unit))
        began = time.process_time()
        chunks = chunking._cut(text, 800, 100)
        took.append(time.process_time() - began)
        assert "".join("".join(chunking._cut(text, 800, 0)).split()) == "".join(text.split()) and len(chunks) > n // 900
    assert took[1] < 25 * took[0] + 0.5
    text = unit * (200_000 // len(unit))
    assert pieces(spark, [text, None, ""], 800, 100) == [chunking._cut(text, 800, 100), None, []]


def test_chunk_ids_of_pages_are_unique(spark):
    rows = [("a", 2, "page two"), ("a", 1, "page one " * 30), ("b", 1, "other"), ("a", None, "no page")]
    got = chunking.chunk_documents(spark.createDataFrame(rows, "doc_id string, page int, text string"), 100, 0).orderBy("chunk_id").collect()
    assert [r["chunk_id"] for r in got] == ["a__c0000", "a__c0001", "a__c0002", "a__c0003", "a__c0004", "b__c0000"]
    assert [r["page"] for r in got] == [1, 1, 1, 2, None, 1] and [r["position"] for r in got] == [0, 1, 2, 3, 4, 0]


def test_rendered_values_are_not_scanned_again(spark):
    df = spark.createDataFrame([("why {answer}?", "so", None)], "q string, a string, n string")
    out = df.select(asking.rendered("{question} / {answer} / {none} / {other}", question=F.col("q"), answer=F.col("a"), none=F.col("n")).alias("x"))
    assert out.first()["x"] == "why {answer}? / so /  / {other}"


def test_null_text_has_no_chunk(spark):
    df = spark.createDataFrame([("d", None), ("e", "hello")], "doc_id string, text string")
    assert [r["chunk_id"] for r in chunking.chunk_documents(df).collect()] == ["e__c0000"]


def test_sections(spark):
    text = "intro\n# A\nbody a\n## A1\nbody a1\n### deep\n\n# B\n### jump\nbody j"
    df = spark.createDataFrame([(text,), ("no heading",), ("# only",)], "t string").select(chunking.sections(F.col("t")).alias("s"))
    got = [[(list(s["path"]), s["body"].strip()) for s in r["s"]] for r in df.collect()]
    assert got[0] == [([], "intro"), (["A"], "body a"), (["A", "A1"], "body a1"), (["B", "", "jump"], "body j")]
    assert got[1] == [([], "no heading")]
    assert got[2] == [([], "# only")]


def test_pages(spark):
    text = 'one\n<!-- PageNumber="4" -->\n<!-- PageBreak -->\ntwo\n<!-- PageBreak -->\n \n<!-- PageBreak -->\nthree'
    df = spark.createDataFrame([(text,)], "t string").select(chunking.layout_pages(F.col("t")).alias("p"))
    assert [(p["page"], p["text"]) for p in df.first()["p"]] == [(4, "one"), (5, "two"), (6, "three")]


def test_chunks_carry_references_and_paths(spark):
    df = spark.createDataFrame([("m", "# JIS B 1083\nuse ISO  9001 and ISO 9001, 第 3 条")], "doc_id string, text string")
    row = chunking.chunk_documents(df, markdown=True).first()
    assert row["section_path"] == ["JIS B 1083"] and row["references"] == ["ISO 9001", "第 3 条", "JIS B 1083"] and row["position"] == 0


def test_windows_cover_the_text(spark):
    df = spark.createDataFrame([(1, "abcdefghij" * 3), (2, None), (3, "ab")], "doc_id int, text string")
    got = chunking.windows(df, 10, 8).orderBy("doc_id", "position").collect()
    assert "".join(r["text"][:8] for r in got if r["doc_id"] == 1).startswith(("abcdefghij" * 3)[:24]) and [r["text"] for r in got if r["doc_id"] == 3] == ["ab"]


def test_texts_are_cut_a_few_at_a_time(spark):
    """No batch of 10,000 texts is held in a Python worker, whatever their length; empty and null texts keep their rows."""
    df = spark.createDataFrame([("a b " * 500,), ("x",), ("",), (None,)], "text string").select(chunking.pieces(F.col("text")).alias("p"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    assert [r["p"] and len(r["p"]) for r in df.collect()] == [3, 1, [], None]
