from __future__ import annotations

import random
from collections import Counter

import pytest

from sieveworks.operators import partners

CHUNKS = "doc_id string, position int, section_path array<string>"


def check(rows, got, gap=3):
    top = {(d, p): (s or [None])[0] for d, p, s in rows}
    found = {(r.doc_id, r.position): r for r in got}
    assert len(found) == len(got)
    for d, p, _ in rows:
        far = [q for (e, q) in top if e == d and abs(q - p) >= gap]
        other = [q for q in far if top[d, q] != top[d, p]]
        if not far:
            assert (d, p) not in found
            continue
        r = found[d, p]
        assert r.partner in (other or far) and r.other_section == bool(other)


@pytest.mark.parametrize("part", [2, 4096])
def test_remote_partners_against_all_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(partners, "PART", part)
    rng = random.Random(part)
    rows = []
    for d in range(30):
        kinds = rng.choice([[["a"]], [["a"], ["b"]], [None, [], ["a", "x"], ["b"], ["c"]]])
        top = rng.choice(kinds)
        for p in range(rng.choice([1, 3, 4, 7, 25])):
            top = rng.choice(kinds) if rng.random() < 0.4 else top
            rows.append((f"d{d}", p, top))
    check(rows, partners.remote_by_section(spark.createDataFrame(rows, CHUNKS)).collect())
    check(rows, partners.remote_by_section(spark.createDataFrame(rows, CHUNKS), gap=1).collect(), 1)


def test_a_document_with_most_chunks_spreads_its_partners(spark):
    rows = [("big", p, ["a" if p < 400 or p % 50 == 0 else "b"]) for p in range(1000)]
    got = partners.remote_by_section(spark.createDataFrame(rows, CHUNKS)).collect()
    check(rows, got)
    from_a = Counter(r.partner for r in got if r.position < 400)
    assert max(from_a.values()) <= 6 and len(from_a) > 250


def test_remote_partners_edges(spark):
    assert partners.remote_by_section(spark.createDataFrame([], CHUNKS)).collect() == []
    rows = [(None, p, None) for p in range(2)] + [("x", 0, None)]
    assert partners.remote_by_section(spark.createDataFrame(rows, CHUNKS)).collect() == []
    more = spark.createDataFrame([("d", p, ["s"], 1, 2, 3) for p in range(5)], f"{CHUNKS}, top int, size int, n int")
    assert {(r.position, r.partner) for r in partners.remote_by_section(more).collect() if r.position != 2} >= {(1, 4), (3, 0)}


def brute_holders(rows):
    known = {r for _, refs in rows for r in refs or [] if r}
    return {ref: {c for c, refs in rows if any(r and ref in r for r in refs or [])} for ref in known}


def test_reference_partners_are_other_holders(spark):
    rng = random.Random(3)
    pool = ["第1条", "第1条の2", "別表 2", "JIS B 1083", "JIS B 1083-1", "JIS B 1083-2", "alone", "", None, "3.1 項"]
    rows = [(f"c{i:03d}", rng.sample(pool[:6] + pool[7:], rng.randint(0, 3))) for i in range(80)] + [("only", ["alone", "alone"]), ("none", None), ("twice", ["別表 2", "別表 2"])]
    got = partners.reference_partners(spark.createDataFrame(rows, "chunk_id string, refs array<string>")).collect()
    holders = brute_holders(rows)
    want = {(c, ref) for c, refs in rows for ref in refs or [] if ref and len(holders[ref]) > 1}
    assert {(r.chunk_id, r.ref) for r in got} == want and len(got) == len(want)
    for r in got:
        assert r.target in holders[r.ref] - {r.chunk_id} and r.holders == len(holders[r.ref])
        assert r.specific == (r.ref.startswith("第1条") or r.ref.startswith("別表"))


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_partners_spread_over_all_holders(spark, monkeypatch, digits):
    """A reference that 600 chunks hold leads to most of them, however its ring is split."""
    monkeypatch.setattr(partners, "SALT_DIGITS", digits)
    got = partners.reference_partners(spark.createDataFrame([(f"c{i}", ["第7条"]) for i in range(600)], "chunk_id string, refs array<string>")).collect()
    targets = Counter(r.target for r in got)
    assert len(got) == 600 and all(r.target != r.chunk_id for r in got)
    assert len(targets) > 330 and max(targets.values()) <= 7  # 1 - 1/e of 600 are to be expected


def test_long_references(spark):
    long = "第1条" + "x" * 3000
    got = partners.within(spark.createDataFrame([(long,), ("第1条",), ("x",)], "ref string")).collect()
    assert {(r.whole == long, r.ref) for r in got} == {(True, long), (True, "第1条"), (True, "x"), (False, "第1条"), (False, "x")}
