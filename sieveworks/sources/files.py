"""Documents, chunks and items in files."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.chunking import chunk_documents, layout_pages
from ..session import path_of


def stem(path: Column) -> Column:
    """The name of a file without folder and last extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def documents(spark: SparkSession, place: str) -> DataFrame:
    """path, doc_id, format and text of all .txt and .md files below a folder; cached layouts (*.di.md) are no documents.

    Raises ValueError if two files would have the same doc_id, their stem.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{txt,md}").load(place)
    docs = raw.where(~F.col("path").endswith(".di.md")).select(
        "path", stem(F.col("path")).alias("doc_id"), F.regexp_extract("path", r"\.(\w+)$", 1).alias("format"), F.decode("content", "UTF-8").alias("text")
    )
    twice = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").head(1)
    if twice:
        raise ValueError(f"more than one file is called {twice[0]['doc_id']}")
    return docs


def pdf_pages(spark: SparkSession, place: str, extract: Callable[[bytes], list[str]]) -> DataFrame:
    """doc_id, page, text of the PDF files below a folder. extract gives a file's page texts; a file that it can't read has none."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(place)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, content in zip(pdf["doc_id"], pdf["content"], strict=True):
                rows += [(doc, i, text) for i, text in enumerate(extract(content), 1) if text and text.strip()]
            yield pd.DataFrame(rows, columns=["doc_id", "page", "text"])

    return raw.select(stem(F.col("path")).alias("doc_id"), "content").mapInPandas(run, "doc_id string, page int, text string")


def layout_documents(docs: DataFrame) -> DataFrame:
    """doc_id, page, text of layout Markdown; a text without a page is page 1."""
    pages = layout_pages(F.col("text"))
    one = F.array(F.struct(F.lit(1).alias("page"), F.col("text").alias("text")))
    return docs.select("doc_id", F.explode(F.when(F.size(pages) > 0, pages).otherwise(one)).alias("p")).select("doc_id", "p.page", "p.text")


def write_chunks(docs: DataFrame, out: str, size: int, overlap: int, patterns: Iterable[str] = (), pages: DataFrame | None = None, layouts: DataFrame | None = None) -> DataFrame:
    """Chunks of documents, replaced in one folder; returns doc_id and count.

    pages: doc_id, page, text of files without headings. layouts: the same as layout Markdown, each page cut into sections.
    Raises ValueError if two of these tables have a document of one name.
    """
    cut = [(docs.where("format = 'md'"), True), (docs.where("format <> 'md'"), False), (pages, False), (layouts, True)]
    cut = [(rows, markdown) for rows, markdown in cut if rows is not None]
    if len(cut) > 2:
        names = [rows.select("doc_id").distinct() for rows in (docs, pages, layouts) if rows is not None]
        twice = reduce(DataFrame.unionByName, names).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").head(1)
        if twice:
            raise ValueError(f"more than one file is called {twice[0]['doc_id']}")
    parts = [chunk_documents(rows, size, overlap, markdown=markdown, patterns=patterns) for rows, markdown in cut]
    reduce(DataFrame.unionByName, parts).write.mode("overwrite").json(out)
    return chunks(docs.sparkSession, out).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


def chunks(spark: SparkSession, place: str) -> DataFrame:
    return spark.read.schema(schemas.CHUNK).json(place)


def qa(spark: SparkSession, place: str | list[str]) -> DataFrame:
    """Items; a line that is no JSON object ends the read with an error."""
    return schemas.with_defaults(spark.read.schema(schemas.QA).option("mode", "FAILFAST").json(place))


def qa_lenient(spark: SparkSession, place: str | list[str], track: str = "all") -> tuple[DataFrame, DataFrame]:
    """Valid items of a track with their file as `source`, and the number of skipped lines of each file."""
    rows = spark.read.schema(schemas.QA + ", _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(place)
    rows = rows.withColumn("source", F.col("_metadata.file_name"))
    rows = schemas.with_defaults(rows).withColumn("problems", schemas.problems())
    bad = F.col("_corrupt").isNotNull() | (F.size("problems") > 0)
    good = rows.where(~bad).drop("_corrupt", "problems")
    kg = F.col("kg_query_type").isNotNull() | F.col("kg_novelty").isNotNull()
    if track != "all":
        good = good.where(kg if track == "kg_poc" else ~kg)
    return good, rows.where(bad).groupBy("source").agg(F.count(F.lit(1)).alias("skipped"))


def write_qa(items: DataFrame, out: str) -> None:
    """Replace a folder of items. Raises ValueError if they are read from it."""
    place = path_of(items.sparkSession, out)[1]
    for name in items.inputFiles():
        read = path_of(items.sparkSession, name)[1]
        if read == place or read.startswith(f"{place}/"):
            raise ValueError(f"{out} holds the input")
    items.write.mode("overwrite").json(out)


def newest(spark: SparkSession, pattern: str) -> str:
    """The last path in order of names that matches a glob pattern."""
    system, _ = path_of(spark, pattern)
    found = system.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern))
    if not found:
        raise FileNotFoundError(pattern)
    return max(str(f.getPath()) for f in found)


def patterns(spark: SparkSession, place: str) -> list[str]:
    """Regular expressions of a pattern file that both Python and Spark can compile; an unreadable file has none."""
    import re

    out = []
    try:
        body = json.loads("\n".join(r["value"] for r in spark.read.text(place, wholetext=True).collect()))
    except ValueError:
        return out
    for entry in body.get("patterns", []):
        try:
            re.compile(entry.get("regex") or "")
        except re.error:
            continue
        if entry.get("regex"):
            out.append(entry["regex"])
    return out
