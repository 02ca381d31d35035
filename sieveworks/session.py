"""A Spark session with the settings that the operators are written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "sieveworks", **conf: str) -> SparkSession:
    """Adaptive execution, ANSI casts, UTC and Arrow; any setting can be given as spark_sql_x_y=..."""
    builder = SparkSession.builder.appName(name)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("_", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def path_of(spark: SparkSession, place: str):
    """The file system of a path, and the path's full name."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, system.makeQualified(path).toString()


def exists(spark: SparkSession, place: str) -> bool:
    system, name = path_of(spark, place)
    return system.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name))


def entries(spark: SparkSession, place: str) -> list[str]:
    """What a folder holds, in order of names, without what Spark's readers skip; nothing where there is no folder."""
    system, name = path_of(spark, place)
    found = system.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{name}/[!_.]*"))
    return sorted(str(f.getPath()) for f in found or ())


def delete(spark: SparkSession, place: str) -> None:
    """Delete a folder with all that is in it, if there is one."""
    system, name = path_of(spark, place)
    system.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name), True)


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which driver and executors share. A local session without one gets a temporary
    folder; on a cluster that would be another one on each machine, so it is an error there."""
    place = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sieveworks.folder", None)
    if not place:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        place = "file://" + tempfile.mkdtemp(prefix="sieveworks-")
        spark.conf.set("spark.sieveworks.folder", place)
    return place


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder once and read back."""
    place = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)
