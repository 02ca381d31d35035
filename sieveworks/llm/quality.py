"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated by isotonic steps.

Each whole text becomes a few statistics (lengths, shares of character classes, repetition). They are standardised with
the training rows' mean and deviation and mapped to RFF features that approximate a Gaussian kernel; each task sums its
part of the normal equations, the sums are solved once (RFF x RFF, fixed size), and the ridge scores are calibrated by
pool-adjacent-violators over BINS score bins.

Null texts count as empty; empty texts have all statistics zero and are scored like any other. Repeated labels of a
document count once (the largest wins), null labels are left out. With no label every score is 0.5. Extra columns are
ignored. Every document is scored, and all labelled rows of the learning folds are used. A null doc_id stays null, has no
label and is in the fold of the empty text; repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_chars, fold, long_ids, materialise, table, text_ids
from .textvec import code_points, word_hashes

RFF = 192
RIDGE = 1e-3
BINS = 400
STATS = 16


def _classes(size: int = 65536) -> np.ndarray:
    """1 lower letter, 2 upper letter, 3 digit, 4 white space, 5 sentence mark, 6 other mark, 7 line end."""
    out = np.full(size, 6, np.uint8)
    for c in range(size):
        x = chr(c)
        out[c] = 1 if x.isalpha() and not x.isupper() else 2 if x.isupper() else 3 if x.isdigit() else 7 if x == "\n" else 4 if x.isspace() else 5 if x in ".,;:'\"?()-" else 6
    return out


def statistics(texts: list[str | None], classes: np.ndarray) -> np.ndarray:
    """One row of STATS numbers for each text."""
    points, starts = code_points(texts)
    kind = classes[np.minimum(points, len(classes) - 1)]
    sizes = np.diff(np.concatenate([starts, [len(points)]])) - 1
    n = np.maximum(sizes, 1)
    share = [np.add.reduceat((kind == c).astype(np.float32), starts).astype(float) for c in range(1, 8)]
    share[3] -= 1  # the space before each text
    same = np.add.reduceat(np.concatenate([[0], (points[1:] == points[:-1]) & (kind[1:] != 4)]).astype(np.float32), starts)
    spaced = [" ".join((x or "").split()) for x in texts]
    words, counts = word_hashes(spaced)
    out = np.zeros((len(texts), STATS))
    at = 0
    for i, c in enumerate(counts):
        w = words[at : at + c]
        at += c
        if c:
            uniq, times = np.unique(w, return_counts=True)
            pairs = np.unique(w[1:] ^ (w[:-1] * np.uint64(3))) if c > 1 else w
            out[i, :5] = len(uniq) / c, times.max() / c, len(pairs) / max(1, c - 1), np.log1p(c), (w[1:] == w[:-1]).mean() if c > 1 else 0
            lines = [y for x in (texts[i] or "").split("\n") if (y := x.strip())]
            out[i, 5] = len(set(lines)) / len(lines) if lines else 1
    out[:, 6] = np.log1p(sizes)
    out[:, 7] = n / np.maximum(counts, 1)
    for j, x in enumerate(share):
        out[:, 8 + j] = x / n
    out[:, 7] = np.minimum(out[:, 7], 50)
    out[:, 15] = same / n
    return out


def features(docs: DataFrame) -> DataFrame:
    """doc_id and its statistics, one pass over the texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classes = _classes()
        for pdf in by_chars(batches):
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "stats": list(statistics(pdf["text"].tolist(), classes).astype(np.float32))})

    return long_ids(text_ids(docs).mapInPandas(run, "doc_id string, stats array<float>"))


def _map(stats: np.ndarray, mean: np.ndarray, dev: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    rng = np.random.default_rng(7)
    z = np.clip((stats - mean) / dev, -6, 6)
    freq, phase = rng.normal(0, 0.35, (STATS, RFF)), rng.uniform(0, 2 * np.pi, RFF)
    return np.hstack([np.cos(z @ freq + phase) * np.sqrt(2 / RFF), np.ones((len(z), 1))])


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Non-decreasing values closest to y in weighted squares, by pooling adjacent violators; x is sorted already."""
    pools: list[list[float]] = []
    for value, weight in zip(y, n, strict=True):
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(k), v) for v, _, k in pools])


def train(stats: DataFrame, labels: DataFrame, label: str, learn: Column) -> tuple | None:
    """Mean, deviation, ridge weights, and the calibration's steps; None without labels."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & learn)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    rows = materialise(stats.join(known, "doc_id").select("stats", "y"), "quality-train")
    moments = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(STATS)],
        *[F.stddev_pop(F.col("stats")[i].cast("double")).alias(f"d{i}") for i in range(STATS)],
    ).first()
    if not moments["n"]:
        return None
    mean = np.array([moments[f"m{i}"] for i in range(STATS)], float)
    dev = np.maximum(np.array([moments[f"d{i}"] for i in range(STATS)], float), 1e-6)

    def normal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, rhs = np.zeros((RFF + 1, RFF + 1)), np.zeros(RFF + 1)
        for pdf in batches:
            z = _map(np.stack(pdf["stats"].to_numpy()), mean, dev)
            gram += z.T @ z
            rhs += z.T @ pdf["y"].to_numpy()
        yield pd.DataFrame({"row": np.arange(RFF + 1, dtype=np.int32), "sums": [r.tolist() for r in np.column_stack([gram, rhs])]})

    add = rows.mapInPandas(normal, "row int, sums array<double>").select("row", F.posexplode("sums").alias("col", "v"))
    cells = add.groupBy("row", "col").agg(F.sum("v").alias("v")).toPandas()  # (RFF+1) x (RFF+2), whatever the input
    both = np.zeros((RFF + 1, RFF + 2))
    both[cells["row"], cells["col"]] = cells["v"]
    weights = np.linalg.solve(both[:, :-1] + RIDGE * moments["n"] * np.eye(RFF + 1) / RFF, both[:, -1])

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            raw = np.clip(_map(np.stack(pdf["stats"].to_numpy()), mean, dev) @ weights, -0.5, 1.5)
            yield pd.DataFrame({"bin": ((raw + 0.5) / 2 * BINS).astype("int32"), "y": pdf["y"]})

    got = rows.mapInPandas(binned, "bin int, y double").groupBy("bin").agg(F.avg("y").alias("y"), F.count("y").alias("n")).toPandas().sort_values("bin")
    steps = isotonic(got["bin"].to_numpy(), got["y"].to_numpy(), got["n"].to_numpy().astype(float))
    return mean, dev, weights, (got["bin"].to_numpy() + 0.5) / BINS * 2 - 0.5, steps


def _score(stats: np.ndarray, model: tuple | None) -> np.ndarray:
    if model is None or not len(stats):
        return np.full(len(stats), 0.5)
    mean, dev, weights, x, y = model
    return np.clip(np.interp(np.clip(_map(stats, mean, dev) @ weights, -0.5, 1.5), x, y), 0, 1)


def score(stats: DataFrame, model: tuple | None) -> DataFrame:
    """doc_id and score (0 to 1)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf[["doc_id"]].assign(score=_score(np.stack(pdf["stats"].to_numpy()), model))

    return long_ids(stats.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(run, "doc_id string, score double"))


def keep(docs: DataFrame, labels: DataFrame, learn: Column, least: float) -> DataFrame:
    """The rows of docs, all columns, with a score of `least` or more. Rows are judged one by one, whatever their ids."""
    model = train(materialise(features(docs), "quality-stats"), labels, "quality", learn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _classes()
        for batch in batches:
            texts = pd.DataFrame({"text": batch.column("text").to_pylist()}, dtype=object)
            good = [_score(statistics(part["text"].tolist(), classes).astype(np.float32), model) >= least for part in by_chars([texts])]
            yield batch.filter(pa.array(np.concatenate(good) if good else [], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """doc_id and quality score of every document."""
    stats = materialise(features(docs), "quality-stats")
    return score(stats, train(stats, labels, "quality", learn))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: fold 1 of 3 is held out; all documents are scored."""
    scored = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
