from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

from sieveworks.llm import convtrie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """All nodes of the trie of rebuilt conversations, one after the other."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    rebuilt = {c: [*own.get(c - int(math.fmod(c, 100)), [])[: h[c]], *own[c][h[c] :]] for c in own}
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in kids[path]) if kids[path] else 1
        saved[path] = sum(saved[k] for k in kids[path]) + ((len(members[path]) - 1) * len(path[-1][1]) if path else 0)
    out = []
    for path, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(rebuilt[c]) == len(path))
        out.append((min(found), len(path), min(members[path[:-1]]) if path else None, len(found), len(kids[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, out))


def got(spark, rows, schema=SCHEMA):
    found = convtrie.prefix_trie(spark.createDataFrame(rows, schema))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(repr(tuple(r)) for r in found.collect())


def some(seed, ids, kinds=3):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"][: 1 + t % 2]), "".join(rng.choices("ab€𝄞"[:kinds], k=rng.randint(0, 1)))) for c in ids for t in range(rng.randint(1, 7))]


def test_brute_force(spark):
    rows = some(1, range(260)) + some(2, range(-205, -195)) + some(3, [10**12, 10**12 + 1, 10**12 + 7], 4)
    random.Random(5).shuffle(rows)
    assert got(spark, rows) == brute(rows)


def test_missing_donors_and_turnless_conversations(spark):
    rows = [(c, 0, "user", "hi") for c in range(101, 130)] + [(205, t, "user", "x") for t in range(9)]
    found = brute(rows)
    assert any(", 0, None, 30," in x for x in found) and got(spark, rows) == found


def test_copies_and_a_long_conversation(spark):
    """One conversation has most of the rows, and many are equal: as many rounds as turns are shared."""
    rows = [(7, t, "user", f"turn {t}") for t in range(1500)] + [(c, t, "user", "same") for c in range(300, 460) for t in range(3)]
    assert got(spark, rows) == brute(rows)


def test_blocks_of_ends(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "BLOCK", 3)
    rows = [(c, 0, "user", "same") for c in range(120)]
    assert got(spark, rows) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(0, None, None, None), (0, 1, "a", "x"), (0, 1, "a", "x"), (0, 1, "a", "w"), (1, 2, "b", None), (1, None, "b", "y"), (None, 1, "a", "x"), (2, 1, "a", "x"), (2, 1, "a", "x"), (3, 1, None, "")]
    rows += [(c, t, "a", "x") for c in (4, 5, 6) for t in (1, 1, None)]
    assert got(spark, rows) == brute(rows)


def test_empty_table_one_row_and_extra_columns(spark):
    assert got(spark, []) == [] and got(spark, [(None, 1, "a", "b")]) == []
    assert got(spark, [(0, 1, "a", "b")]) == brute([(0, 1, "a", "b")])
    rows = some(8, range(20))
    assert got(spark, [(*r, 1, 2, "z") for r in rows], f"{SCHEMA}, depth int, node int, mark string") == brute(rows)
