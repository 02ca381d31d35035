"""Toxicity: a linear classifier over hashed character n-grams, scaled by naive Bayes log-count ratios.

A document's features are the n-grams of its distinct words (with word borders): in how many of them each occurs, over the
square root of the number of distinct words. The log ratio of each n-gram's smoothed share of all n-grams of toxic training
rows to that of clean ones scales it; logistic weights are fitted on the scaled features until the loss stands still. All
training rows are fitted at once, TRAIN_ROWS bounds their number; every document is scored on its whole text.

Null and empty texts have no feature and get the score of the intercept. Repeated labels of a document count once
(the largest label wins), null labels are left out. With labels of one class only, or none, every score is that share
(0 if there is none). A null doc_id stays null, has no label and is in the fold of the empty text; repeated rows are scored
each. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, by_chars, documents, fold, long_ids, materialise, table, text_ids
from .textvec import char_ngrams, code_points

TRAIN_ROWS = 6_000
BITS = 18
ORDERS = (3, 4, 5)
#: Tasks that encode and count the training rows.
TASKS = 8
#: Steps at most; fitting ends before where a step changes the loss by less than STILL of it.
STEPS, STILL, RIDGE = 150, 1e-4, 1e-4
#: Added to each n-gram's count before the ratio is taken.
SMOOTH = 1.0
_WORD = re.compile(r"[^\W\d_]+")


def _words(text: str | None) -> str:
    """The distinct lower-case words of a text, each between spaces; their order has no meaning."""
    return " ".join(dict.fromkeys(_WORD.findall(text.lower()))) if text else ""


def _features(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each order the bucket of each n-gram, 0 for those that cross from a word to the next; where texts begin; and the
    number of distinct words of each text."""
    words = [_words(x) for x in texts]
    points, starts = code_points([x + " " for x in words])
    space = points == 32
    out = []
    for n in ORDERS:
        grams = char_ngrams(points, n, BITS)
        crosses = np.zeros(len(points), bool)
        for i in range(1, n - 1):
            crosses[:-i] |= space[i:]
        crosses[-(n - 1) :] = True
        out.append(np.where(crosses, 0, grams | 1))
    return out, starts, np.fromiter((x.count(" ") + 1 if x else 0 for x in words), np.int64, len(words))


def _sparse(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """The buckets of each text, as often as they occur, and its number of distinct words."""
    grams, starts, words = _features(texts)
    ends = np.append(starts[1:], len(grams[0]))
    rows = [np.concatenate([g[a:b] for g in grams]) for a, b in zip(starts, ends, strict=True)]
    return [r[r > 0].astype(np.int32) for r in rows], words


def logistic(starts: np.ndarray, idx: np.ndarray, x: np.ndarray, y: np.ndarray, size: int) -> tuple[np.ndarray, float, bool]:
    """Weights and intercept of a logistic regression with a ridge penalty, and whether the loss came to stand still.

    Accelerated gradient steps. The matrix is given row by row, from `starts`, as columns idx and entries x; no row is empty.
    """
    n = len(y)
    order = np.argsort(idx, kind="stable").astype(np.int32)
    column = idx[order]
    new = np.concatenate([[True], column[1:] != column[:-1]])
    begin = np.flatnonzero(new)
    used = column[begin]
    at = np.empty(len(idx), np.int32)
    at[order] = np.cumsum(new, dtype=np.int32) - 1
    by_row = np.repeat(np.arange(n, dtype=np.int32), np.diff(np.append(starts, len(idx))))[order]
    by_x = x[order]
    del order, column, new
    forward = lambda v: np.add.reduceat(v.astype(np.float32)[at] * x, starts, dtype=np.float64)
    back = lambda r: np.add.reduceat(r.astype(np.float32)[by_row] * by_x, begin, dtype=np.float64) / n
    side, top = np.random.default_rng(5).normal(size=len(used)), 0.0
    for _ in range(12):  # the largest eigenvalue, which bounds the step
        side = back(forward(side))
        top = float(np.linalg.norm(side))
        if not top:
            break
        side /= top
    step = 1 / (1.1 * top / 4 + RIDGE + 0.25)
    w, last = np.zeros(len(used)), np.zeros(len(used))
    b = was = float(np.log(y.mean() / (1 - y.mean())))
    loss, restart, still = np.inf, 0, False
    for t in range(STEPS):
        m = (t - restart) / (t - restart + 3)
        v, c = w + m * (w - last), b + m * (b - was)
        z = forward(v) + c
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        now = float(np.mean(np.logaddexp(0, z) - y * z) + RIDGE / 2 * (v @ v))
        last, was = w, b
        w = v - step * (back(p - y) + RIDGE * v)
        b = c - step * float((p - y).mean())
        if still := abs(loss - now) < STILL * now:
            break
        if now > loss:
            restart = t + 1
        loss = now
    out = np.zeros(size)
    out[used] = w
    return out, b, still


def train(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Weights for each bucket (ratio times logistic weight) and intercept. TASKS tasks encode and count the sample, and one
    fits it: `rows` documents at most, by their n-grams."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & learn)
    known = bounded_sample(known.groupBy("doc_id").agg(F.max("y").alias("y")), "doc_id", rows)
    sample = documents(docs).join(F.broadcast(known), "doc_id").repartition(TASKS, F.xxhash64("doc_id"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in by_chars(batches):
            idx, words = _sparse(pdf["text"].tolist())
            yield pd.DataFrame({"y": (pdf["y"].to_numpy() > 0).astype(float), "words": words, "idx": [x.tobytes() for x in idx]})

    rows_df = materialise(sample.mapInPandas(encode, "y double, words long, idx binary"), "toxic-features")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, n = np.zeros((2, 1 << BITS)), np.zeros(2)
        for pdf in batches:
            for y in (0, 1):
                part = [np.frombuffer(x, np.int32) for x in pdf["idx"][pdf["y"] == y]]
                if part:
                    sums[y] += np.bincount(np.concatenate(part), minlength=1 << BITS)
                    n[y] += len(part)
        sums[:, 0] = n
        yield pd.DataFrame({"sums": [sums.tobytes()]})

    sums = rows_df.repartition(TASKS).mapInPandas(count, "sums binary").collect()  # TASKS vectors of fixed size
    counts = sum((np.frombuffer(r["sums"]).reshape(2, -1) for r in sums), np.zeros((2, 1 << BITS)))
    n_clean, n_toxic = counts[:, 0]
    counts[:, 0] = 0
    if n_toxic == 0 or n_clean == 0:
        return np.zeros(1 << BITS, np.float32), 30.0 if n_toxic else -30.0
    seen = counts.sum(0) > 0
    rate = (counts + SMOOTH) / (counts.sum(1, keepdims=True) + SMOOTH * seen.sum())
    ratio = np.where(seen, np.log(rate[1] / rate[0]), 0)
    shared = docs.sparkSession.sparkContext.broadcast(ratio.astype(np.float32))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        lens, idx, x = [], [], []
        for packed, words in zip(pdf["idx"], pdf["words"], strict=True):
            at, times = np.unique(np.append(np.frombuffer(packed, np.int32), 0), return_counts=True)  # bucket 0: no n-gram
            lens.append(len(at))
            idx.append(at.astype(np.int32))
            x.append((times * shared.value[at] / np.sqrt(max(words, 1))).astype(np.float32))
        y = pdf["y"].to_numpy(copy=True)
        del pdf
        starts, idx, x = np.cumsum([0, *lens[:-1]]), np.concatenate(idx), np.concatenate(x)
        size = float(np.sqrt(np.add.reduceat(x * x, starts).mean())) or 1.0
        w, b, _ = logistic(starts, idx, x / np.float32(size), y, 1 << BITS)
        return pd.DataFrame({"w": [(w / size).astype(np.float32).tobytes()], "b": [b]})

    fitted = rows_df.withColumn("part", F.lit(0)).groupBy("part").applyInPandas(fit, "w binary, b double").first()
    return (np.frombuffer(fitted["w"], np.float32) * ratio).astype(np.float32), float(fitted["b"])


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id and score of every document."""
    w, b = model
    shared = docs.sparkSession.sparkContext.broadcast(w)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = shared.value
        for pdf in by_chars(batches):
            grams, starts, words = _features(pdf["text"].tolist())
            total = sum(np.add.reduceat(w[g], starts, dtype=np.float64) for g in grams)
            z = total / np.sqrt(np.maximum(words, 1)) + b
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "score": 1 / (1 + np.exp(-np.clip(z, -30, 30)))})

    return long_ids(text_ids(docs).mapInPandas(run, "doc_id string, score double"))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: fold 2 of 4 is held out; all documents are scored."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), "toxic", fold("doc_id", 4) != 2)
    return score(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
