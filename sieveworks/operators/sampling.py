"""Seeded samples that do not depend on the order of rows or on how they are dealt out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .partners import hashed


def bottom_k(rows: DataFrame, id_column: str, k: int, keys: tuple[str, ...] = (), seed: int = 42) -> DataFrame:
    """rows with `pick` (1 to k): of each group of `keys` (of all rows without keys) the k with the least hashes of seed and id.

    This is a uniform sample without replacement of k rows, or all of a group that has fewer. Samples of parts of a group
    merge to that of the whole, and so it is taken: each task keeps its k least for each group before the shuffle (Spark plans a
    limit of a rank as one on both sides of it, up to spark.sql.optimizer.windowGroupLimitThreshold), and no group is sorted
    whole. Ids that are equal are taken in no order; null keys are a group.
    """
    parts = [F.col(key) for key in keys] or [F.lit(0)]
    order = Window.partitionBy(*parts).orderBy(hashed(F.lit(str(seed)), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), id_column)
    return rows.withColumn("pick", F.row_number().over(order)).where(F.col("pick") <= k)


def prefix(rows: DataFrame, size: Column, most: int, order: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """rows with `cum`, the sizes added up in order, as long as that is `most` at most: of each group of keys, or of all rows.

    Sizes are 1 or more. Without keys only the first `most` rows in order are looked at, as no further one can fit.
    """
    if not keys:
        rows = rows.orderBy(*order).limit(most)
    parts = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return rows.withColumn("cum", F.sum(size).over(parts.orderBy(*order))).where(F.col("cum") <= most)
