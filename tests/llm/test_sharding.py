from __future__ import annotations

import zlib

import pytest

from sieveworks.llm import sharding


def run(spark, rows, shards, monkeypatch):
    monkeypatch.setattr(sharding, "SHARDS", shards)
    df = spark.createDataFrame(rows, "key long, grp string")
    return {r["key"]: r["shard"] for r in sharding.balanced_shards(df, shards).collect()}


def even(got, n, shards):
    sizes = [list(got.values()).count(s) for s in range(shards)]
    return len(got) == n and max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("n,shards", [(0, 4), (3, 5), (41, 4)])
def test_unlinked_rows_are_dealt_evenly(spark, n, shards, monkeypatch):
    got = run(spark, [(i, None) for i in range(n)], shards, monkeypatch)
    assert even(got, n, shards) if n else not got


def test_groups_stay_together(spark, monkeypatch):
    rows = [(i, f"g{i // 3}" if i < 60 else None) for i in range(200)]
    got = run(spark, rows, 5, monkeypatch)
    assert even(got, 200, 5)
    assert sum(len({got[i] for i in range(3 * g, 3 * g + 3)}) > 1 for g in range(20)) == 0


def test_a_group_larger_than_a_shard_fills_whole_shards(spark, monkeypatch):
    rows = [(i, "hot" if i < 130 else f"p{i // 2}" if i < 200 else None) for i in range(300)]
    got = run(spark, rows, 6, monkeypatch)
    assert even(got, 300, 6)
    assert len({got[i] for i in range(130)}) <= 4
    assert sum(got[i] != got[i + 1] for i in range(130, 200, 2)) <= 3


def test_all_rows_linked(spark, monkeypatch):
    got = run(spark, [(i, f"g{i // 4}") for i in range(120)], 6, monkeypatch)
    assert even(got, 120, 6)
    assert sum(len({got[4 * g + j] for j in range(4)}) > 1 for g in range(30)) <= 10


def test_query(spark, tmp_path):
    texts = ["é", None, "", "é", "same", "same", "x" * 1000]
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, shard string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    rows = sharding.query(spark, str(tmp_path)).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 7 and all(r["law"] == "rows" and r["grown_shard"] is None and r["slot"] == 0 for r in rows)
    assert [by[i]["size"] for i in range(4)] == [18, 16, 16, 18]
    assert by[0]["text_crc32"] == zlib.crc32("é".encode()) and by[1]["text_crc32"] == 0
    assert len({r["shard"] for r in rows}) == 7  # counts differ by one at most, so equal texts part here
