from __future__ import annotations

import os
import sys
import time

import pytest
from pyspark import cloudpickle

from sieveworks.plans import jobs
from sieveworks.sources import files, layouts

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors can't import this file


def reader(calls):
    """A service that makes layout Markdown of a file's text, and leaves a file for each call."""

    def read(content):
        import uuid

        text = content.decode()
        with open(os.path.join(calls, uuid.uuid4().hex), "w") as f:
            f.write(text)
        if "broken" in text:
            raise RuntimeError("no PDF")
        return "\n<!-- PageBreak -->\n".join(f'<!-- PageNumber="{i}" -->\n{page}' for i, page in enumerate(text.split("|"), 1))

    return read


def said(calls):
    out = sorted(p.read_text() for p in calls.iterdir())
    for p in calls.iterdir():
        p.unlink()
    return out


@pytest.fixture
def place(tmp_path):
    (tmp_path / "docs" / "deep").mkdir(parents=True)
    (tmp_path / "calls").mkdir()
    (tmp_path / "docs" / "a.pdf").write_text("# T\none ISO 9001|## U\ntwo||four")
    (tmp_path / "docs" / "deep" / "b.pdf").write_text("plain")
    return tmp_path


def test_only_new_and_changed_files_are_read(spark, place):
    calls, go = place / "calls", lambda: layouts.layouts(spark, str(place / "docs"), str(place / "cache"), reader(str(place / "calls")))
    got, failed = go()
    assert got.count() == 2 and failed.count() == 0 and said(calls) == ["# T\none ISO 9001|## U\ntwo||four", "plain"]
    assert go()[0].count() == 2 and said(calls) == []
    (place / "docs" / "deep" / "b.pdf").write_text("changed")
    later = time.time() + 60
    os.utime(place / "docs" / "deep" / "b.pdf", (later, later))
    got = {r["path"][-5:]: r["markdown"] for r in go()[0].collect()}
    assert said(calls) == ["changed"] and got["b.pdf"].endswith("changed") and "one" in got["a.pdf"]
    assert go()[0].count() == 2 and said(calls) == []  # the newest version counts
    (place / "docs" / "c.pdf").write_text("broken")
    got, failed = go()
    assert got.count() == 2 and [r["path"][-5:] for r in failed.collect()] == ["c.pdf"] and said(calls) == ["broken"]
    go()
    assert said(calls) == ["broken"]  # failures are tried again


def test_layouts_reach_chunks(spark, place):
    (place / "docs" / "n.md").write_text("# N\nbody")
    (place / "docs" / "c.pdf").write_text("broken")
    pages = lambda content: ["page one", "", "page three"]
    jobs.chunk(spark, str(place / "docs"), str(place / "out"), layout=reader(str(place / "calls")), cache=str(place / "cache"), pdf=pages)
    got = {r["chunk_id"]: (r["page"], r["section_path"], r["text"]) for r in files.chunks(spark, str(place / "out")).collect()}
    assert got == {
        "a__c0000": (1, ["T"], "one ISO 9001"), "a__c0001": (2, ["", "U"], "two"), "a__c0002": (4, [], "four"), "b__c0000": (1, [], "plain"),
        "c__c0000": (1, [], "page one"), "c__c0001": (3, [], "page three"), "n__c0000": (None, ["N"], "body"),
    }
    said(place / "calls")
    jobs.chunk(spark, str(place / "docs"), str(place / "out2"), pdf=pages)
    assert {r["doc_id"] for r in files.chunks(spark, str(place / "out2")).collect()} == {"a", "b", "c", "n"} and said(place / "calls") == []
    (place / "docs" / "a.txt").write_text("same name")
    with pytest.raises(ValueError, match="more than one file"):
        jobs.chunk(spark, str(place / "docs"), str(place / "out3"), pdf=pages)
    with pytest.raises(ValueError, match="cache"):
        jobs.chunk(spark, str(place / "docs"), str(place / "out4"), layout=pages)


def test_an_older_row_does_not_count(spark):
    t = "timestamp'2024-01-0{} 00:00:00'"
    files_ = spark.sql(f"select 'x' path, {t.format(3)} modified union all select 'y', {t.format(3)} union all select 'z', {t.format(3)}")
    cache = spark.sql(f"select 'x' path, {t.format(1)} modified, 'old' markdown union all select 'x', {t.format(3)}, 'new' union all select 'y', {t.format(2)}, 'old'")
    assert {r["path"]: r["markdown"] for r in layouts.current(files_, cache).collect()} == {"x": "new", "y": None, "z": None}
