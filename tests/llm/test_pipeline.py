from __future__ import annotations

import os

import pytest

import corpus_pipeline
from sieveworks.llm import decontam, entries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, n = docs.columns, docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        place = str(tmp_path / name)
        stage(spark, docs, DATA).write.parquet(place)
        docs = spark.read.parquet(place)
        if name != "packing":
            assert docs.columns == columns and docs.count() <= n
            n = docs.count()
        if name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
            matcher = decontam.Matcher(items, decontam.ERROR_RATE)
            assert not any(matcher.find(decontam.fold_text(r["text"])) for r in docs.collect())
    assert docs.select("doc_id").distinct().count() == n <= len(texts)


def test_every_query_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in entries.queries()) == list(range(1, 14))
