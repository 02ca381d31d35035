"""Documents to chunks: the split that fits, and a greedy merge with overlap.

A text up to `size` characters is one chunk (none if blank). A longer one is split by the first of several separators that
leaves all parts shorter than `size` (blank lines, sentence ends, lines, white space, characters), and parts are joined by
a space up to `size`; each next chunk begins with the last `overlap` characters of the one before. A chunk can so reach
size + overlap. Null texts have no chunk.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import dims
from ..functions.text import chunk_id, references, strip

# Separators in order of preference.
SEPARATORS = (r"\n\n+", r"(?<=[。．.!?！？])\s+", r"\n", r"\s+")
_SPLITS = tuple(map(re.compile, SEPARATORS))
SIZE, OVERLAP = 800, 100


def _parts(text: str, size: int) -> list[str]:
    """The parts by the first separator that leaves all of them shorter than size; characters if none does."""
    for pattern in _SPLITS:
        found = list(filter(None, pattern.split(text)))
        if found and len(max(found, key=len)) < size:
            return found
    return list(text)


def _cut(text: str | None, size: int, overlap: int) -> list[str] | None:
    """The chunks of one text; its parts are read once."""
    if text is None or len(text) <= size:
        return text if text is None else [text] * bool(text.strip(dims.SPACES))
    chunks: list[str] = []
    room = ""  # the chunk that is being filled
    for part in _parts(text, size):
        if len(room) + len(part) < size:  # with a space between
            before = room
        else:
            chunks += filter(None, (room,))
            before = chunks[-1][-overlap:] if chunks and overlap else ""
        room = f"{before} {part}".strip(dims.SPACES) if before else part
    return chunks + list(filter(None, (room,)))


def pieces_of(texts: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """The chunks of each text of an array, as an array of arrays. A Python kernel: a fold in Spark's array functions copies what it
    has so far for each part. Rows come a few at a time, as texts may be long: a batch of Arrow has 10,000 of them whatever their length."""

    @F.udf("array<array<string>>", useArrow=False)
    def run(row: list[str | None] | None) -> list | None:
        return None if row is None else [_cut(text, size, overlap) for text in row]

    return run(texts)


def pieces(text: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """The chunks of a text, as an array."""
    return pieces_of(F.array(text), size, overlap)[0]


def sections(text: Column) -> Column:
    """Markdown sections: array of (path, body). Headings are lines of 1 to 6 marks and a title; bodies that are blank are
    left out; a text without any body is one section with an empty path. A heading is read line by line."""
    empty = F.array().cast("array<string>")
    entry = "array<struct<path:array<string>,body:string>>"

    def close(s: Column) -> Column:
        return F.when(strip(s["body"]) == "", s["out"]).otherwise(F.concat(s["out"], F.array(F.struct(s["path"].alias("path"), s["body"].alias("body")))))

    def step(s: Column, line: Column) -> Column:
        marks = F.length(F.regexp_extract(line, r"^(#{1,6})\s+\S", 1))
        title = strip(F.regexp_replace(line, r"^#{1,6}\s+", ""))
        kept = F.slice(s["path"], 1, F.least(F.size(s["path"]), marks - 1))
        path = F.concat(kept, F.array_repeat(F.lit(""), F.greatest(marks - 1 - F.size(kept), F.lit(0)).cast("int")), F.array(title))
        more = F.when(s["body"] == "", line).otherwise(F.concat(s["body"], F.lit("\n"), line))
        return F.when(marks > 0, F.struct(close(s).alias("out"), path.alias("path"), F.lit("").alias("body"))).otherwise(
            F.struct(s["out"].alias("out"), s["path"].alias("path"), more.alias("body"))
        )

    start = F.struct(F.array().cast(entry).alias("out"), empty.alias("path"), F.lit("").alias("body"))
    found = F.aggregate(F.split(text, "\n"), start, step, close)
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.struct(empty.alias("path"), text.alias("body"))))


def layout_pages(markdown: Column) -> Column:
    """Pages of layout Markdown: array of (page, text), cut at page breaks. A page number in a comment counts; other pages
    count on from the one before; blank pages are left out."""

    def step(s: Column, part: Column) -> Column:
        said = F.regexp_extract(part, r'<!--\s*PageNumber="(\d+)"\s*-->', 1)
        page = F.when(said != "", F.try_to_number(said, F.lit("999999999")).cast("int")).otherwise(s["next"])
        body = strip(F.regexp_replace(part, r'<!--\s*PageNumber="[^"]*"\s*-->', ""))
        return F.when(body == "", s).otherwise(
            F.struct(F.concat(s["out"], F.array(F.struct(page.alias("page"), body.alias("text")))).alias("out"), (page + 1).alias("next"))
        )

    start = F.struct(F.array().cast("array<struct<page:int,text:string>>").alias("out"), F.lit(1).alias("next"))
    return F.aggregate(F.split(markdown, r"<!--\s*PageBreak\s*-->"), start, step, lambda s: s["out"])


def running(rows: DataFrame, *order: Column) -> DataFrame:
    """rows with `position` counted from 0 through each document, in this order."""
    return rows.withColumn("position", F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)) - 1)


def headings(html: Column) -> Column:
    """The headings of a page in order, as an array of structs (level, title): what stands between the tags, without tags."""
    found = F.regexp_extract_all(html, F.lit("(?is)<h[1-6][^>]*>.*?</h[1-6]>"), F.lit(0))
    title = lambda h: F.regexp_replace(F.regexp_replace(h, "<[^>]*>", ""), r"^\s+|\s+$", "")
    return F.transform(found, lambda h: F.struct(F.regexp_extract(h, "<h([1-6])", 1).cast("int").alias("level"), title(h).alias("title")))


def chunk_documents(docs: DataFrame, size: int = SIZE, overlap: int = OVERLAP, markdown: bool = False, patterns: Iterable[str] = ()) -> DataFrame:
    """chunk_id, doc_id, page, text, position, section_path, references of docs (doc_id, text and, if there is one, page).

    Positions run through all pages of a document, in page order, so that its chunk ids are unique. patterns: more forms of
    references, as `patterns` finds them.
    """
    page = F.col("page").cast("int") if "page" in docs.columns else F.lit(None).cast("int")
    parts = sections(F.col("text")) if markdown else F.array(F.struct(F.array().cast("array<string>").alias("path"), F.col("text").alias("body")))
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", page.alias("page"), parts.alias("parts"))
    rows = rows.withColumn("cuts", pieces_of(F.col("parts.body"), size, overlap))
    cut = F.flatten(F.zip_with("parts", "cuts", lambda s, cuts: F.transform(cuts, lambda p: F.struct(s["path"].alias("section_path"), p.alias("text")))))
    rows = rows.select("doc_id", "page", F.posexplode(cut).alias("position", "chunk"))
    if "page" in docs.columns:  # the chunks of one document
        rows = running(rows, F.col("page").asc_nulls_last(), F.col("position"))
    return rows.select(
        chunk_id(F.col("doc_id"), F.col("position")).alias("chunk_id"), "doc_id", "page", F.col("chunk.text").alias("text"), "position",
        F.col("chunk.section_path").alias("section_path"),
        references(F.concat(F.col("chunk.text"), F.lit(" "), F.array_join("chunk.section_path", " ")), patterns).alias("references"),
    )


def windows(docs: DataFrame, size: int = SIZE, step: int = SIZE - OVERLAP) -> DataFrame:
    """doc_id, position, text: overlapping windows of characters, for texts whose structure does not matter."""
    n = F.greatest(F.lit(1), F.ceil((F.length("text") - (size - step)) / step)).cast("int")
    rows = docs.where(F.length("text") > 0).select("doc_id", "text", F.explode(F.sequence(F.lit(0), n - 1)).alias("position"))
    return rows.select("doc_id", "position", F.substr("text", F.col("position") * step + 1, F.lit(size)).alias("text"))
