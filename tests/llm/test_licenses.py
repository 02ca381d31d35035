from __future__ import annotations

import random
import re

import pytest

from sieveworks.llm import licenses
from sieveworks.llm.licenses import NOTICES, PHRASES, Template

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    """n_words, n_base, first_word, last_word and base_labels by trying all places."""
    w = words(text)
    hits = [(i, t.label) for t in PHRASES for p in [t.text.split()] for i in range(len(w)) if w[i : i + len(p)] == p]
    at = [i for i, _ in hits]
    return len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def run(df, *templates):
    return licenses.summary(licenses.spans(licenses.scan(df, *templates)))


def test_base_by_brute_force(spark):
    rng = random.Random(4)
    pool = "gnu general public license apache mit cc by nc GPL MIT License, É ä1 the-of 版权 Apache".split()
    texts = ["".join(rng.choice(pool) + rng.choice([" ", "\n", ". ", "-"]) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts += [None, "", "...", "cc", "cc by", "CC-BY", "\x00cc\x7fby\x00", "MIT LİCENSE", "apache license" * 3, "mit license " * 30_000]
    got = run(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id]), texts[r.doc_id][:200]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.n_base)


@pytest.mark.parametrize("notice", [t for t in NOTICES if len(t.text.split()) >= licenses.NOTICE], ids=lambda t: t.label)
def test_notices_with_edits(spark, notice):
    """Words put in, left out and changed in the middle keep the label; less than half of a notice does not give it."""
    w = notice.text.split()
    filler = "some words before it and others after it that belong to no license at all".split()
    half = len(w) // 2
    edited = [*filler, *w[:half], "indeed", *w[half + 1 :], *filler]
    part = [*filler, *w[: int(len(w) * 0.4)], *filler]
    got = {r.doc_id: r for r in run(spark.createDataFrame([(1, " ".join(edited).upper()), (2, " ".join(part)), (3, " ".join(filler)), (4, ", ".join(w))], SCHEMA), (notice,)).collect()}
    assert [got[i].labels for i in (1, 2, 3, 4)] == [notice.label if len(w) >= 13 else got[1].labels, "", "", notice.label]
    assert got[4].score == 1 and got[3].score == 0 and got[1].score >= (0.5 if len(w) >= 13 else 0)


def test_two_places_of_a_notice_are_two_spans(spark):
    notice = NOTICES[0]
    text = f"{notice.text} {'and so on ' * 40} {notice.text}"
    found = licenses.spans(licenses.scan(spark.createDataFrame([(1, text)], SCHEMA), (notice,))).where("verified").collect()
    n = len(notice.text.split())
    assert sorted((r.start, r.end) for r in found) == [(0, n), (n + 120, 2 * n + 120)]


def test_repeated_rows_nulls_and_extra_columns(spark):
    rows = [(1, "the mit license", "x", 1)] * 3 + [(1, "cc by", "x", 1), (None, "apache license", None, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string, n_words int")
    got = sorted((r.doc_id is None, r.base_labels, r.n_base) for r in run(df).collect())
    assert got == [(False, "cc-by", 1), (False, "mit", 1), (False, "mit", 1), (False, "mit", 1), (True, "", 0), (True, "apache", 1)]


def test_empty_table_and_short_templates(spark):
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []
    got = run(spark.createDataFrame([(1, "gpl mit license")], SCHEMA), (Template("x", "gpl"), Template("mit", "mit license", True))).first()
    assert (got.labels, got.n_base) == ("mit", 1)


def test_templates_are_bounded(spark):
    with pytest.raises(ValueError):
        licenses.places(spark, (Template("x", " ".join(map(str, range(licenses.MOST_WORDS + 1)))),))
