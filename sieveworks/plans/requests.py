"""Requests for new items: which cells to fill, and in what order."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import dims
from ..functions import rules
from ..operators.partners import hashed

Cell = tuple[str, str]


def parse_mix(spec: str) -> list[tuple[str, str, int]]:
    """Cells and counts of a mix such as "multi_hop:unknown_term=5, aggregation:unknown_relation=3".

    Raises ValueError on an entry of another form, an unknown value, a count that is no positive integer, or an empty mix.
    """
    out = []
    for entry in filter(None, (x.strip() for x in spec.split(","))):
        cell, eq, count = entry.partition("=")
        kind, colon, novelty = (x.strip() for x in cell.partition(":"))
        if not eq or not colon:
            raise ValueError(f"{entry!r} is not of the form query_type:novelty=N")
        if kind not in dims.KG_QUERY_TYPES or novelty not in dims.KG_NOVELTY:
            raise ValueError(f"unknown cell {kind}:{novelty}")
        if not count.strip().isdigit() or int(count) < 1:
            raise ValueError(f"{count.strip()!r} is not a positive count")
        out.append((kind, novelty, int(count)))
    if not out:
        raise ValueError("the mix is empty")
    return out


def _order(seed: int, *key) -> bytes:
    return hashlib.sha1(repr((seed, *key)).encode()).digest()


def cells(n: int, mix: list[tuple[str, str, int]] | None = None, seed: int = 42) -> list[Cell]:
    """n cells: those of the mix, cut or filled up from its cells, else an equal split over all cells; the order is by hash."""
    if mix:
        queue = [(a, b) for a, b, count in mix for _ in range(count)]
        queue = [c for _, c in sorted((_order(seed, i, c), c) for i, c in enumerate(queue))][:n]
        pool = [(a, b) for a, b, _ in mix]
        more = [pool[int.from_bytes(_order(seed, "more", i)[:4], "big") % len(pool)] for i in range(n - len(queue))]
        return queue + more
    every = [(a, b) for a in dims.KG_QUERY_TYPES for b in dims.KG_NOVELTY]
    extra = sorted(every, key=lambda c: _order(seed, "rest", c))[: n % len(every)]
    queue = every * (n // len(every)) + extra
    return [c for _, _, c in sorted((_order(seed, i, c), i, c) for i, c in enumerate(queue))]


def split_cells(total: DataFrame, seed: int = 42) -> DataFrame:
    """kg_query_type, kg_novelty, copy and draw: an equal split of n requests (total: one row, column n) over all cells.

    What is left over goes to one cell each, by the hash of its name; draw is the hash in whose order requests are taken.
    """
    spark = total.sparkSession
    cell = dims.domain(spark, "kg_query_type", dims.KG_QUERY_TYPES).drop("ord").crossJoin(F.broadcast(dims.domain(spark, "kg_novelty", dims.KG_NOVELTY).drop("ord")))  # fixed domains
    name = F.concat_ws(":", "kg_query_type", "kg_novelty")
    turn = F.row_number().over(Window.orderBy(hashed(F.lit(f"{seed}:rest"), name)))  # of as many rows as there are cells
    every = len(dims.KG_QUERY_TYPES) * len(dims.KG_NOVELTY)
    n = cell.withColumn("turn", turn).crossJoin(F.broadcast(total.select("n")))  # one row
    n = n.withColumn("copies", F.floor(F.col("n") / every) + F.when(F.col("turn") <= F.col("n") % every, 1).otherwise(0))
    return copies_of(n, seed)


def copies_of(mix: DataFrame, seed: int = 42) -> DataFrame:
    """kg_query_type, kg_novelty, copy and draw: as many requests of each cell as its `copies` says."""
    rows = mix.where("copies > 0").select("kg_query_type", "kg_novelty", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))).alias("copy"))
    return rows.withColumn("draw", hashed(F.lit(str(seed)), "kg_query_type", "kg_novelty", F.col("copy").cast("string")))


def requests(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """request_id and aspect of n requests: all aspects in turn, each turn in the order of a hash."""
    names = [a for a, _, _ in dims.ASPECT_ROWS]
    turns = [sorted(names, key=lambda a, t=t: _order(seed, t, a)) for t in range(-(-n // len(names)))]
    return spark.createDataFrame([(i, a) for i, a in enumerate([a for t in turns for a in t][:n])], "request_id int, aspect string")


def kg_requests(spark: SparkSession, queue: list[Cell]) -> DataFrame:
    """request_id, aspect, kg_query_type and kg_novelty of a queue of cells; the aspect chooses the anchors."""
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(queue)], "request_id int, kg_query_type string, kg_novelty string")
    return rows.withColumn("aspect", rules.kg_aspect(F.col("kg_query_type"), F.col("kg_novelty")))
