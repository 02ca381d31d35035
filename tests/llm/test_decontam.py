from __future__ import annotations

import random

import pytest

from sieveworks.llm import decontam


def distance(pattern, text):
    """Least edit distance of the pattern to any substring of text, row by row; an end inside a word is an edit too."""
    ends = [int(0 < j < len(text) and text[j - 1] != " " != text[j]) for j in range(len(text) + 1)]
    row = list(ends)
    for i, c in enumerate(pattern, 1):
        above, row = row, [ends[0] + i] + [0] * len(text)
        for j, d in enumerate(text, 1):
            row[j] = min(above[j - 1] + (c != d), above[j] + 1, row[j - 1] + 1)
    return min(map(sum, zip(row, ends, strict=True)))


def test_myers_against_the_table():
    rng = random.Random(1)
    for _ in range(300):
        p = "".join(rng.choices("abc ", k=rng.randint(1, 30)))
        t = "".join(rng.choices("abc ", k=rng.randint(0, 60)))
        masks = {}
        for i, c in enumerate(p):
            masks[c] = masks.get(c, 0) | 1 << i
        got = decontam.best_match(masks, len(p), t, 0, len(t), len(p))
        assert (got[0] if got else len(p)) == min(distance(p, t), len(p))


def test_items_of_all_lengths_follow_one_law():
    """Items of 1 to 40 characters, with and without edits, against all substrings of a text."""
    rng = random.Random(7)
    hits = {}
    for size in range(1, 41):
        for _ in range(12):
            item = decontam.fold_text("".join(rng.choices("abcde ", k=size)))
            if not item:
                continue
            chars = list(item)
            for _ in range(rng.randint(0, 3)):
                chars[(at := rng.randrange(len(chars))) : at + rng.randint(0, 1)] = rng.choice(["", "z", " "])
                chars = chars or ["z"]
            around = lambda: "".join(rng.choices("abcde ", k=rng.randint(0, 30)))
            text = decontam.fold_text(around() + rng.choice(["", " "]) + "".join(chars) + rng.choice(["", " "]) + around())
            edits, most = distance(item, text), int(decontam.ERROR_RATE * len(item))
            got = decontam.Matcher([(1, item)], decontam.ERROR_RATE).find(text)
            assert [x[1] for x in got] == ([edits] if edits <= most and text else []), (item, text)
            hits[most] = hits.get(most, 0) + len(got)
    assert all(hits.get(k) for k in range(4)), hits


@pytest.mark.parametrize("rate", [0.05, 0.15])
def test_all_items_are_found(rate):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(12))) for i in range(15)]
    found = missed = 0
    matcher = decontam.Matcher(items, rate)
    for _ in range(60):
        item = rng.choice(items)[1]
        chars = list(item)
        for _ in range(rng.randint(0, 9)):
            at = rng.randrange(len(chars))
            chars[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "zz"])
        text = decontam.fold_text(" ".join(word() for _ in range(30)) + " " + "".join(chars) + " " + " ".join(word() for _ in range(20)))
        want = {(i, distance(decontam.fold_text(t), text)) for i, t in items}
        want = {(i, d) for i, d in want if d <= int(rate * len(decontam.fold_text(items[i][1])))}
        got = {(i, d) for i, d, _, _ in matcher.find(text)}
        assert got == want
        found += len(got)
        missed += not want
    assert found and missed


def test_tables(spark, monkeypatch):
    item = "The quick brown fox jumps over the lazy dog and runs away quickly."
    items = spark.createDataFrame([(1, item), (2, item), (3, None), (4, "too short"), (5, "another item that has quite a few words in it")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "x " * 50 + item.upper().replace(" ", "\n") + " tail " + item, "a"), (2, None, "a"), (3, "", "a"), (4, "clean text " * 40, "a"),
        (5, "the quick brown fix jumps over the lazy dog, and runs away quickly", "a"), (6, "the quick brown fox", "a"),
    ], "doc_id long, text string, item_id string")
    want = {(1, 1, 0), (1, 2, 0), (5, 1, 1), (5, 2, 1)}
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in decontam.matches(docs, items).collect()} == want
    monkeypatch.setattr(decontam, "MAX_ITEM_CHARS", 80)
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in decontam.matches(docs, items).collect()} == want
    kept = decontam.decontaminate(docs, items)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 6] and kept.columns == docs.columns
    assert decontam.matches(docs, items.where("item_id > 9")).count() == 0 and decontam.matches(docs.where("doc_id > 9"), items).count() == 0


def test_short_items_have_the_same_law(spark):
    items = [(1, "What is 7 times 8?"), (2, "東京はどこですか"), (3, "one"), (4, "one"), (5, "?!"), (6, None), (7, "quick brown"), (8, "The quick brown fox jumps over the lazy dog."), (1, "ten")]
    docs = [
        (1, "So: WHAT is 7\ntimes 8? What is 7 times 8"), (2, "what is 7 times 81"), (3, "what is 9 times 8"), (4, "問題：東京はどこですか。"), (5, "では東京はどこですかと聞く"),
        (6, "東京 はどこですか"), (7, "gone, oneself, no ones"), (8, "no, One."), (9, "the quick brown fix jumps over the lazy dog"), (10, "?! ?!"), (11, None), (12, "ten what is 7 times 8"),
    ]
    items, docs = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["edits"], r["start"], r["end"]) for r in decontam.matches(docs, items).collect())
    assert got == [
        (1, 1, 0, 3, 20), (2, 1, 1, 0, 16), (3, 1, 1, 0, 17), (4, 2, 0, 3, 11), (5, 2, 0, 2, 10), (8, 3, 0, 3, 6), (8, 4, 0, 3, 6), (9, 7, 0, 4, 15), (9, 8, 1, 0, 43),
        (12, 1, 0, 0, 3), (12, 1, 0, 4, 21),
    ]
    assert sorted(r["doc_id"] for r in decontam.decontaminate(docs, items).collect()) == [6, 7, 10, 11]
