from __future__ import annotations

import hashlib

import pytest

from sieveworks.llm import fingerprints


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, after = text or "", after or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        c = fingerprints.canonical
        out[doc] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), float(c(text) == c(edited)), float(c(text) == c(after)))
    return out


@pytest.mark.parametrize("size", [1, 3, 40])
def test_against_brute_force(spark, size):
    spark.conf.set("spark.sql.shuffle.partitions", size)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(i, t) for i, t in enumerate(["Ab  c", "ab c", None, "", "ﬁne", "FINE", "x" * 5000, "日本語テキスト", "Straße", "STRASSE", "aaaa", "aaaa"])]
    rows += [(40, "far"), (-3, "negative"), (None, "no id")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fingerprint int")
    got = fingerprints.fingerprint(df).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got} == brute(rows)
    mark = {r["doc_id"]: r["fingerprint"] for r in got}
    assert mark[0] == mark[1] and mark[2] == mark[3] and mark[4] == mark[5] and mark[8] == mark[9] and mark[10] == mark[11]
    assert len(set(mark.values())) == 10
    assert all((r["fingerprint"] == r["edited_fingerprint"]) == bool(r["near_edited"]) for r in got)


def test_bytes_part_what_a_digest_joins(spark, monkeypatch):
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(fingerprints)  # the tasks get the weaker digest
    monkeypatch.setattr(fingerprints, "digest", lambda data: str(len(data)))
    try:
        df = spark.createDataFrame([(0, "ab"), (1, "AB"), (2, "cd"), (3, "xyz"), (7, "aa"), (8, "aa")], "doc_id long, text string")
        rows = fingerprints.fingerprint(df).collect()
        mark = {r["doc_id"]: r["fingerprint"] for r in rows}
        edited = {r["doc_id"]: r["edited_fingerprint"] for r in rows}
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[fingerprints.__name__])
    assert mark[0] == mark[1] != mark[2] and mark[7] == mark[8] and len(set(mark.values())) == 4
    assert edited[8] == mark[8] and edited[1] == mark[8]  # "AB" before "ab" becomes "Aa"
    assert all((r["fingerprint"] == r["edited_fingerprint"]) == bool(r["near_edited"]) for r in rows)


def test_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "doc_id long, text string")
    assert fingerprints.fingerprint(df).count() == 3
    assert fingerprints.fingerprint(df.where("doc_id > 9")).count() == 0
