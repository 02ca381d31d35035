from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from sieveworks.llm import resampling

SCHEMA = "doc_id long, text string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return [zlib.crc32(x.encode()) % 10000 for x in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]], len(w)


def brute(docs, target):
    """The law, one document after the other."""
    s = Counter(b for _, t in docs for b in features(t)[0])
    t = Counter(b for x in target for b in features(x)[0])
    big, small = sum(s.values()), sum(t.values())
    out, able = [], []
    for doc, text in docs:
        found, n = features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (big + 10000) / ((s[b] + 1) * (small + 10000)))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if n >= 20:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: len(able) * 25 // 100], 1):
        r[4] = i
    return sorted(map(repr, map(tuple, out)))


def got(spark, docs, target):
    found = resampling.resample(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(x,) for x in target], "text string"))
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted(repr(tuple(r)) for r in found.collect())


def some(seed, n):
    rng = random.Random(seed)
    pool = [*"The of and ÉTÉ été 漢字 x1 A-b don't İ naïve".split(), *(f"w{i}" for i in range(200))]
    return [(i, " ".join(rng.choices(pool, k=rng.choice([0, 5, 19, 20, 21, 60])))) for i in range(n)]


def test_brute_force(spark):
    docs = some(1, 300) + [(-5, "the " * 50_000), (10**12, None), (10**12 + 1, ""), (10**12 + 2, "...")]
    target = [t for _, t in some(2, 20)] + [None, ""]
    assert got(spark, docs, target) == brute(docs, target)


def test_crcs_go_on_from_their_parents():
    rng = random.Random(6)
    texts = [bytes(rng.choices(b"ab  \xc3\xa9xyz", k=rng.choice([0, 3, 40, 3000]))) for _ in range(20)]
    trie = resampling.Trie()
    for batch in (texts[:7], [], texts[7:]):
        words, nodes, counts, which, n = trie.walk(batch)
        found = [re.findall(rb"[0-9a-z\x80-\xff]+", x) for x in batch]
        assert words.tolist() == [zlib.crc32(w) for x in found for w in x] and n.tolist() == [len(x) for x in found]
        pairs = [a + b" " + b for x in found for a, b in zip(x, x[1:], strict=False)]
        assert nodes[which].tolist() == [zlib.crc32(x) for x in pairs] if pairs else not len(which)
        assert sorted(counts.tolist()) == sorted(Counter(pairs).values())
    assert zlib.crc32(b"left" + b"right!") == int(shift(zlib.crc32(b"left"), 6)) ^ zlib.crc32(b"right!")


def shift(crc, n):
    table = resampling.shift_table(n)
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def test_a_trie_that_is_begun_anew_changes_nothing(spark, monkeypatch):
    docs, target = some(3, 120), [t for _, t in some(4, 9)]
    want = brute(docs, target)
    monkeypatch.setattr(resampling, "NODES", 3)
    monkeypatch.setattr(resampling, "by_chars", lambda batches: (pdf.iloc[i : i + 1] for pdf in batches for i in range(len(pdf))))
    assert got(spark, docs, target) == want


def test_ties_and_repeated_rows(spark):
    docs = [(i % 7, "one two three four five " * 5) for i in range(80)]
    found = resampling.resample(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([("one two",)], "text string")).collect()
    drawn = sorted((r for r in found if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, 21))
    assert [(-r.score, r.doc_id) for r in drawn] == sorted((-r.score, r.doc_id) for r in drawn)


@pytest.mark.parametrize("target", [[], [None], ["a b"]])
def test_empty_tables(spark, target):
    assert got(spark, [], target) == []
    docs = some(5, 30)
    assert got(spark, docs, target) == brute(docs, target)


def test_nulls_and_clashing_columns(spark):
    docs = spark.createDataFrame([(None, "a " * 30, 1, 2), (3, None, None, None)], "doc_id long, text string, score int, weight int")
    found = resampling.resample(docs, docs.select("text", "score")).collect()
    assert sorted((r.doc_id is None, r.n_features) for r in found) == [(False, 0), (True, 59)]
