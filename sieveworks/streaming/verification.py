"""Verification that survives a crash: items land in files, each file is a micro-batch, and a batch that is done stays done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..session import entries, exists

#: Below the folder of results; readers skip it.
STATE = "_state"


def land(items: DataFrame, landing: str, batch: int, files: int = 1_000) -> int:
    """Write items, in order of their ids, to files of `batch` each at most; how many items there were. A task writes about
    `files` files one after the other, or as many as hold 100,000 items, so that they are also read in about that order."""
    n = items.count()
    if n:
        dealt = items.repartitionByRange(-(-n // max(batch, min(batch * files, 100_000))), "qa_id").sortWithinPartitions("qa_id")
        dealt.write.option("maxRecordsPerFile", batch).mode("append").json(landing)
    return n


def verify_stream(spark: SparkSession, landing: str, out: str, checkpoint: str, verify: Callable[[DataFrame], DataFrame], files: int = 16) -> StreamingQuery:
    """Start a query that verifies the items of each new file below `landing` and writes them under `out`, by batch.

    A batch that is run again after a failure replaces its own folder, so that every item is written once.
    """
    rows = spark.readStream.schema(schemas.QA).option("maxFilesPerTrigger", files).json(landing)

    def write(batch: DataFrame, number: int) -> None:
        items = schemas.with_defaults(batch).persist()  # read several times
        try:
            verify(items).write.mode("overwrite").json(f"{out}/batch={number}")
        finally:
            items.unpersist()

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def unverified(qa: DataFrame, done: DataFrame) -> DataFrame:
    """Items that have no verification yet: where a job resumes."""
    return qa.join(done.select("qa_id").distinct(), "qa_id", "left_anti")


def verify_new(qa: DataFrame, out: str, verify: Callable[[DataFrame], DataFrame], batch: int = 200, most: int = 16) -> int:
    """Verify those items that `out` lacks, in batches; how many there were.

    Items land in files of `batch` each. A micro-batch takes as many files as leave `most` micro-batches for all that has landed, so
    that what each has to search (vectors, earlier replies) is searched `most` times at most, however many the items are.

    What an earlier run has landed and not finished is finished first. The files, and the stream's progress, are below `out`
    too, so that results and progress are kept or deleted together.
    """
    spark = qa.sparkSession
    landing, progress = f"{out}/{STATE}/landing", f"{out}/{STATE}/progress"
    run = lambda: verify_stream(spark, landing, out, progress, verify, files=max(1, -(-len(entries(spark, landing)) // most))).awaitTermination()
    if exists(spark, landing):
        run()
    todo = unverified(qa, spark.read.schema("qa_id string").json(out)) if entries(spark, out) else qa
    n = land(todo, landing, batch)
    if n:
        run()
    return n
