from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sieveworks.functions import rules, text


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("said,unable", [("不明", True), ("「不明」。", True), (" ", True), (None, True), ("Unknown.", True), ("not available", True), ("不明な点は3つ", False), ("24V", False)])
def test_unable(spark, said, unable):
    assert one(spark, text.is_unable(F.col("t").cast("string")), t=said) is unable


@pytest.mark.parametrize("reply,k", [('{"k": 3}', 3), ('```json\n{"k": 4}\n```', 4), ('Well, {"k": 5} it is', 5), ('say {"a": {"b": 1}, "k": 6} and {"k": 7}', 6), ("nothing", None), ("{broken", None)])
def test_parsed(spark, reply, k):
    assert one(spark, text.parsed(F.col("t"), "k bigint, a struct<b:int>")["k"], t=reply) == k


def test_ids(spark):
    assert one(spark, text.plain_doc_id(F.col("t")), t="a__c0012") == "a" and one(spark, text.plain_doc_id(F.col("t")), t="a__cx") == "a__cx"
    import hashlib

    want = "auto_" + hashlib.sha1(b"a+b::k::q").hexdigest()[:8]
    assert one(spark, text.qa_id(F.array(F.lit("a"), F.lit("b")), F.lit("k"), F.lit("q"))) == want


def test_references_keep_their_order(spark):
    got = one(spark, text.references(F.col("t")), t="see JIS  B 1083-2, 別表 2, JIS B 1083-2 and 3.1 項")
    assert got == ["JIS B 1083-2", "別表 2", "3.1 項"]


def test_unseen_terms(spark):
    assert one(spark, text.unseen_terms(F.lit("カタカナワードとアイウエ"), F.lit("アイウエオ"))) == ["カタカナワード"]


@pytest.mark.parametrize("declared,measured,want", [("Hard", "Easy", "too_easy"), ("Easy", "Hard", "too_hard"), ("Easy", "Easy", "aligned"), ("Easy", "x", None)])
def test_difficulty(spark, declared, measured, want):
    assert one(spark, rules.difficulty_match(F.col("a"), F.col("b")), a=declared, b=measured) == want


@pytest.mark.parametrize("n,docs,gap,want", [(1, 1, 0, "Easy"), (2, 1, 2, "Medium"), (2, 1, 20, "Hard"), (2, 2, 0, "Hard")])
def test_retrieval_level(spark, n, docs, gap, want):
    assert one(spark, rules.retrieval_level(F.lit(n), F.lit(docs), F.lit(gap))) == want


def test_aspects(spark):
    body = "| a |\n|---|\n| 1 |\n| 2 |\n| 3 |\n値は 3 以上 5 以下"
    fits = rules.aspect_fits(F.lit(body), F.array(F.lit("x"), F.lit("y")), F.array(F.lit("ISO 9001")))
    got = spark.range(1).select(*[c.alias(a) for a, c in fits.items()]).first().asDict()
    assert len(got) == 26
    assert [got[a] for a in ("simple_table", "complex_form", "quantitative_calc", "complex_layout", "standards_reference", "reference_follow", "multi_hop")] == [True] * 7
    assert not got["flowchart"] and not got["negation"] and not got["large_enumeration"]


def test_reasons(spark):
    row = dict(answerability=2.0, leakage="fail", grounding=5.0, rationale_grounded=0.2, difficulty_match="too_easy", answer_match="partial", retrieval_hit_doc=True, retrieval_hit_chunk=False, retrieval_hit=True)
    base = spark.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()], F.lit(None).cast("double").alias("uniqueness"))
    assert base.select(rules.reject_reasons().alias("r")).first()["r"] == ["answerability", "leakage", "rationale_grounded"]
    more = rules.reject_reasons(reject_too_easy=True, rag_hit=True, rationale_retrieved=True)
    assert base.select(more.alias("r")).first()["r"][3:] == ["difficulty_match", "rag_no_match", "not_retrieved"]
    with pytest.raises(ValueError):
        rules.reject_reasons(rag_fail=True, rag_hit=True)


@pytest.mark.parametrize(
    "body,quote,want",
    [
        ("rated 24 V here", "24 V", "rated 24 V here"),
        ("rated 24 V < 30", "rated24", "<mark>rated 24</mark> V &lt; 30"),
        ("a\n\n b&c d\u3000e", "b&cde", "a\n\n <mark>b&amp;c d\u3000e</mark>"),
        ("xabcabcd", "abcd", "xabc<mark>abcd</mark>"),
        ("aaaa aaaa", " a a a a ", "<mark>aaaa</mark> aaaa"),
        ("𝄞𝄞 𝄞𝄞!", "𝄞𝄞𝄞𝄞", "<mark>𝄞𝄞 𝄞𝄞</mark>!"),
        ("some text", "other", "some text"),
        ("some text", "", "some text"),
        ("  lead", "lead", "  <mark>lead</mark>"),
        ("", "quote", ""),
        (None, "quote", None),
        ("some text", None, "some text"),
    ],
)
def test_highlighted(spark, body, quote, want):
    if body == "rated 24 V here":
        want = body  # three characters besides the space
    df = spark.createDataFrame([(body, quote)], "b string, q string")
    assert df.select(text.highlighted(F.col("b"), F.col("q")).alias("x")).first()["x"] == want


@pytest.mark.parametrize("body", ["値は１０以上２０以下", "値は 10 以上 20 以下"])
def test_digits_of_all_scripts_count(spark, body):
    fits = rules.aspect_fits(F.lit(body), F.array(F.lit("x")), F.array().cast("array<string>"))
    assert one(spark, fits["quantitative_calc"]) and one(spark, fits["numeric_inclusion"])
    listed = "\n".join(f"{x}. item" for x in "１２３４５")
    assert one(spark, rules.aspect_fits(F.lit(listed), F.array(F.lit("x")), F.array().cast("array<string>"))["large_enumeration"])
