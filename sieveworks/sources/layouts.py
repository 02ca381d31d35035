"""Layouts of PDF files from a reading service, kept in a table of versions.

The table has a row for each file and version that was read (path, time of the file's last change, Markdown). A file's newest row
counts if it is not older than the file; only other files are read. Rows are added in folders of their own and never changed, so
jobs that run side by side read a file twice at worst.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import entries

CACHE = "path string, modified timestamp, markdown string"


def _files(spark: SparkSession, place: str) -> DataFrame:
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(place)
    return raw.select("path", F.col("modificationTime").alias("modified"), "content")


def current(files: DataFrame, cache: DataFrame) -> DataFrame:
    """files (path, modified) with `markdown` of the newest row of the cache (CACHE) for the path; null if that is older than the file."""
    newest = cache.groupBy("path").agg(F.max(F.struct("modified", "markdown")).alias("c"))
    fresh = F.when(F.col("c.modified") >= F.col("modified"), F.col("c.markdown"))
    return files.join(newest, "path", "left").withColumn("markdown", fresh).drop("c")


def layouts(spark: SparkSession, place: str, cache: str, read: Callable[[bytes], str], at_once: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(path, markdown) of all PDF files below a folder, and the paths of those that could not be read.

    read gives a file's Markdown; a file for which it fails is not kept, and is tried again by the next run. at_once bounds the
    tasks that call it.
    """

    def known() -> DataFrame:
        folders = entries(spark, cache)
        return spark.read.schema(CACHE).parquet(*folders) if folders else spark.createDataFrame([], CACHE)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, modified, content in zip(pdf["path"], pdf["modified"], pdf["content"], strict=True):
                try:
                    rows.append((path, modified, read(content)))
                except Exception:  # one file that can't be read does not stop the others
                    rows.append((path, modified, None))
            yield pd.DataFrame(rows, columns=["path", "modified", "markdown"])

    here = _files(spark, place)
    missing = current(here.select("path", "modified"), known()).where("markdown is null").select("path")
    todo = here.join(missing, "path", "left_semi")  # contents are read of these alone
    got = (todo.repartition(at_once) if at_once else todo).select("path", "modified", "content").mapInPandas(run, CACHE)
    got.where("markdown is not null").write.parquet(f"{cache.rstrip('/')}/{uuid.uuid4().hex}")
    rows = current(here.select("path", "modified"), known())
    return rows.where("markdown is not null").select("path", "markdown"), rows.where("markdown is null").select("path")
