"""Exact cosine search and pairing of vectors.

A few queries are broadcast and multiplied with batches of the corpus; many are dealt out in groups, as is the corpus, and all pairs
of groups meet in the executors. Only the best candidates of each pair leave it, and no vector of a large set passes the
driver. Null and empty vectors are left out of a corpus; a zero vector stays zero there, and is an error among queries, as are
vectors of another width.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Queries that are broadcast, and vectors of a side that meet in a task; queries and rows of the corpus that are multiplied at once.
BLOCK, ASKED, STEP = 4096, 256, 2048
#: Where a side would be more than GROUPS groups, a group has more vectors, up to so many NUMBERS in all: each is sent to fewer tasks.
GROUPS, NUMBERS = 32, 1 << 20


def unit(name: str):
    """A column of vectors, scaled to length one; a zero vector stays."""
    norm = F.sqrt(F.aggregate(name, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.transform(name, lambda x: F.when(norm == 0, F.lit(0.0)).otherwise(x.cast("double") / norm))


def _normal(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norm == 0, 1, norm)


def _best(queries: tuple, corpus: tuple, k: int, least: float | None, same: bool, floor: np.ndarray) -> tuple:
    """query, id, label and sim of those rows of one part of a corpus that can be among the k nearest of some queries; both as (ids,
    unit vectors, labels, codes of labels). floor: for each query the rounded similarity of the k-th best row known so far, or -inf."""
    (qid, q, _, qcode), (ids, vectors, labels, codes) = queries, corpus
    if vectors.shape[1] != q.shape[1]:
        raise ValueError("vectors differ in width")
    # single precision tells which pairs to look at; unit vectors err by less than slack
    sims, slack = q.astype(np.float32) @ vectors.T.astype(np.float32), (q.shape[1] + 8) * 2.0**-22
    own = np.flatnonzero(np.isin(ids, qid))
    if len(own):
        sims[:, own] = np.where(qid[:, None] == ids[own][None, :], -np.inf, sims[:, own])
    if same:
        np.putmask(sims, qcode[:, None] == codes[None, :], -np.inf)
    top, last, bound = sims.max(1), len(ids) - k, floor if least is None else np.maximum(floor, least)
    if last > 0 and np.isneginf(floor).any():
        bound = np.maximum(bound, top if k == 1 else np.partition(sims, last, 1)[:, last])
    bound = (bound - slack).astype(np.float32)
    rows = np.flatnonzero((top >= bound) & np.isfinite(top))
    sims = sims[rows]
    i, j = np.divmod(np.flatnonzero((sims >= bound[rows, None]) & np.isfinite(sims)), len(ids))
    i, sim = rows[i], np.empty(len(i))
    for at in range(0, len(i), STEP):
        sim[at : at + STEP] = np.einsum("ij,ij->i", q[i[at : at + STEP]], vectors[j[at : at + STEP]])
    keep = np.round(sim, 9) >= floor[i]  # also all that tie with the k-th
    if least is not None:
        keep &= sim >= least
    i, j, sim = i[keep], j[keep], sim[keep]
    return qid[i], ids[j], labels[j], sim


def _arrays(pdf: pd.DataFrame, asked: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    widths = {len(v) for v in pdf["vec"]}
    if len(widths) > 1:
        raise ValueError("vectors differ in width")
    vectors = np.empty((len(pdf), *widths), np.float64)
    for i, v in enumerate(pdf["vec"]):  # row by row: a list of lists of Python floats is many times as large
        vectors[i] = v
    if asked and (np.linalg.norm(vectors, axis=1) == 0).any():
        raise ValueError("a query has a zero vector")
    return pdf["id"].to_numpy(), _normal(vectors), pdf["label"].to_numpy()


def _parts(arrays: tuple, size: int) -> Iterator[tuple]:
    """Parts of `size` rows of arrays of one length."""
    for at in range(0, len(arrays[0]), size):
        yield tuple(a[at : at + size] for a in arrays)


def _cut(rows: tuple, k: int) -> tuple:
    """Of (query, id, label, sim) the k best of each query, ties by id."""
    query, ids, _, sim = rows
    order = np.lexsort((ids, -np.round(sim, 9), query))
    place = np.arange(len(order))
    first = np.concatenate([[True], query[order][1:] != query[order][:-1]])[: len(order)]
    keep = order[place - np.maximum.accumulate(np.where(first, place, 0)) < k]
    return tuple(c[keep] for c in rows)


def _found(queries: tuple, corpus: tuple, k: int, least: float | None, same: bool) -> Iterator[pd.DataFrame]:
    """The k best rows of a part of a corpus for each query, some queries at a time: ASKED by STEP similarities are held at once."""
    codes = np.unique(np.concatenate([queries[2], corpus[2]]), return_inverse=True)[1]
    codes = codes.astype(np.min_scalar_type(int(codes.max(initial=0))))  # small numbers are compared faster
    queries, corpus = (*queries, codes[: len(queries[0])]), (*corpus, codes[len(queries[0]) :])
    for asked in _parts(queries, ASKED):
        best, floor = None, np.full(len(asked[0]), -np.inf)
        for part in _parts(corpus, STEP):
            rows = _best(asked, part, k, least, same, floor)
            if best is None or len(rows[0]):
                best = _cut(rows if best is None else tuple(map(np.concatenate, zip(best, rows, strict=True))), k)
                first, end = np.searchsorted(best[0], asked[0]), np.searchsorted(best[0], asked[0], "right")
                full = end - first >= k
                floor[full] = np.round(best[3][first[full] + k - 1], 9)
        yield pd.DataFrame(dict(zip(("query", "id", "label", "sim"), best, strict=True)))


def nearest(corpus: DataFrame, queries: DataFrame, k: int, *, least: float | None = None, same: bool = False, block: int | None = None) -> DataFrame:
    """query, id, label, sim, rank: each query's k most similar rows of the corpus, ties by id.

    corpus: id, vec, label. queries: id, vec, label. With `same` only rows of another label count. A query never finds
    itself (the row with its id). least: similarities below it do not count. k of 0 or less finds nothing.

    Up to `block` queries are broadcast and the corpus stays where it is. More are dealt out in groups of about that size (of more
    where `block` is not given and there are many), and so is the corpus; each pair of groups meets alone, and a task holds no more
    than two groups at once.
    """
    schema = "query long, id long, label long, sim double"
    corpus = corpus.select(F.col("id").cast("long").alias("id"), "vec", F.col("label").cast("long").alias("label")).where(F.size("vec") > 0)
    queries = queries.select(F.col("id").cast("long").alias("id"), "vec", F.col("label").cast("long").alias("label"))
    if same:  # no label is neither the same nor another
        corpus, queries = corpus.where("label is not null"), queries.where("label is not null")
    n, width = queries.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first() if k > 0 else (0, 0)
    if not n:
        return corpus.sparkSession.createDataFrame([], schema + ", rank int")
    if n <= (block or BLOCK):
        shared = corpus.sparkSession.sparkContext.broadcast(_arrays(queries.toPandas(), asked=True))  # `block` rows at most

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for at in range(0, len(pdf), STEP):
                    yield from _found(shared.value, _arrays(pdf.iloc[at : at + STEP]), k, least, same)

        found = corpus.mapInPandas(run, schema)
    else:
        m = corpus.count()
        block = block or max(BLOCK, min(-(-max(n, m) // GROUPS), NUMBERS // max(width, 1)))
        across, down = -(-n // block), -(-m // block) or 1

        def meet(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            if not len(asked) or not len(rows):
                return pd.DataFrame({"query": [], "id": [], "label": [], "sim": []})
            return pd.concat(_found(_arrays(asked.rename(columns={"asked": "vec"}), asked=True), _arrays(rows), k, least, same), ignore_index=True)

        of = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        # the two sides may come of one table, and a cogroup tells its columns apart by their origin
        left = queries.select((F.col("id") + 0).alias("id"), F.transform("vec", lambda x: x).alias("asked"), (F.col("label") + 0).alias("label"), of(across).alias("across"), every(down).alias("down"))
        right = corpus.select("*", every(across).alias("across"), of(down).alias("down"))
        found = left.groupBy("across", "down").cogroup(right.groupBy("across", "down")).applyInPandas(meet, schema)
    order = Window.partitionBy("query").orderBy(F.round("sim", 9).desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def uniqueness(vectors: DataFrame, block: int | None = None) -> DataFrame:
    """id and 1 - the largest cosine to any other row (never below 0); null where there is one row only."""
    best = nearest(vectors, vectors, 1, block=block).select(F.col("query").alias("id"), "sim")
    n = vectors.count()
    value = F.when(F.lit(n > 1), 1 - F.greatest(F.coalesce("sim", F.lit(0.0)), F.lit(0.0)))
    return vectors.select("id").join(best, "id", "left").select("id", value.alias("uniqueness"))
