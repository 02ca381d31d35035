"""Helpers that the operators of this subpackage share: shared storage, bounded samples, distributed ranks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where it is unset, a local session gets a temporary one; on a
    cluster that would be another folder on each machine, so it is an error there."""
    conf = spark.sparkContext.getConf()
    place = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.sieveworks.shared.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        place = "file://" + tempfile.mkdtemp(prefix="sieveworks-")
        spark.conf.set("spark.sieveworks.shared.dir", place)
    return place


#: Set while a working table is written: the shuffle files of that write are deleted at its end, as no later query reads them.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and no executor holds the only copy."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sieveworks/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_SHUFFLES)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what materialise() has written for these frames. Nothing that is still to be computed may read them."""
    for df in frames:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(conf).delete(path, True)


def documents(df: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (and the named columns) of a table that may have others besides."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def unused(df: DataFrame, name: str) -> str:
    """name, or one like it, that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_ids(df: DataFrame) -> DataFrame:
    """documents(df) with doc_id as text: pandas would turn whole numbers beside a null into rounded ones."""
    return documents(df).withColumn("doc_id", F.col("doc_id").cast("string"))


def long_ids(df: DataFrame) -> DataFrame:
    return df.withColumn("doc_id", F.col("doc_id").cast("long"))


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def bounded_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About `bound` rows at most, chosen by a hash of the key, or all of them where there are no more.

    The share is set from an exact count, so the expected size never passes the bound whatever the input's size.
    """
    n = df.count()
    if n <= bound:
        return df
    share = int(bound / n * (1 << 31))
    return df.where(F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1 << 31)) < share)


def global_rank(df: DataFrame, keys: list[str], bucket: Column, order: list[Column], name: str) -> DataFrame:
    """A gapless 0-based rank in each group of `keys`, ordered by (bucket, order), without a whole group in one task.

    Rows are ranked in each (keys, bucket) and moved up by the number of rows in the buckets before theirs.
    """
    ranked = df.withColumn("_b", bucket).withColumn(
        "_r", F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(*order)) - 1
    )
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.withColumn("_b", bucket).groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_o", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return ranked.join(offsets, [*keys, "_b"]).withColumn(name, (F.col("_r") + F.col("_o")).cast("long")).drop("_b", "_r", "_o")


def by_chars(batches: Iterator[pd.DataFrame], column: str = "text", limit: int = 1 << 20) -> Iterator[pd.DataFrame]:
    """The same rows in frames of about `limit` characters (one row at least), so that arrays over texts stay small."""
    for pdf in batches:
        if len(pdf):
            part = pdf[column].str.len().fillna(0).to_numpy(dtype="int64").cumsum() // limit
            cuts = [0, *(i + 1 for i in range(len(part) - 1) if part[i] != part[i + 1]), len(pdf)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield pdf.iloc[a:b]


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
