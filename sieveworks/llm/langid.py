"""Language identification: multinomial naive Bayes over hashed character n-grams.

The counts come from a bounded sample of documents with a language (TRAIN_ROWS), summed in Spark; the log-probability
matrix (languages x 2^BITS, fixed size) is broadcast, and batches of whole texts are scored in numpy. N-grams that reach
from one text of a batch into the next do not count, so a text has one score in any company.

Null texts and texts without a letter give `und` with score 0. Rows with null language are never learned from. Ties go
to the language that comes first by name. With no labelled row at all every text is `und`. A null doc_id stays null and is in the fold of the empty text. Other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, by_chars, documents, fold, long_ids, table, text_ids
from .textvec import char_ngrams, code_points, letter_table

TRAIN_ROWS = 30_000
BITS = 15
ORDERS = (2, 3)
_LETTER = re.compile(r"[^\W\d_]")


#: The bucket after all others: n-grams that reach into the next text.
_NONE = 1 << BITS


def _grams(texts: list[str | None], letters: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The buckets of each order's n-grams of all texts, each text between spaces, and where the texts begin."""
    points, starts = code_points([(x or "") + " " for x in texts])
    low = letters[np.minimum(points, len(letters) - 1)]
    ends = np.append(starts[1:], len(points))
    out = []
    for n in ORDERS:
        grams = char_ngrams(low, n, BITS)
        for back in range(1, n):
            grams[np.maximum(ends - back, starts)] = _NONE
        out.append(grams)
    return out, starts


def train(docs: DataFrame, learn: Column, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities, orders x languages x 2^BITS, from the rows where `learn` holds."""
    labelled = documents(docs, "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & learn)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, sums = letter_table(), {}
        for pdf in by_chars(batches):
            for lang, part in pdf.groupby("lang"):
                grams, _ = _grams(part["text"].tolist(), letters)
                got = np.stack([np.bincount(g, minlength=_NONE + 1)[:_NONE] for g in grams])
                sums[lang] = sums[lang] + got if lang in sums else got
        if sums:
            for lang, got in sums.items():
                order, gram = np.nonzero(got)
                yield pd.DataFrame({"lang": lang, "ord": order.astype("int32"), "gram": gram.astype("int32"), "n": got[order, gram]})

    sample = bounded_sample(labelled, "doc_id", rows)
    counts = (
        sample.repartition(8, F.xxhash64("doc_id"))
        .mapInPandas(count, "lang string, ord int, gram int, n long")
        .groupBy("lang", "ord", "gram").agg(F.sum("n").alias("n"))
        .toPandas()
    )  # at most languages x orders x 2^BITS rows
    langs = sorted(counts["lang"].unique())
    seen = np.zeros((len(ORDERS), len(langs), 1 << BITS))
    at = {x: i for i, x in enumerate(langs)}
    seen[counts["ord"].to_numpy(), counts["lang"].map(at).to_numpy(dtype=np.int64), counts["gram"].to_numpy()] = counts["n"].to_numpy()
    seen += 0.5
    return langs, np.log(seen / seen.sum(axis=2, keepdims=True)).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """doc_id, lang_pred and score (the probability of that language per character, tempered by the text's length)."""
    langs, logs = model
    shared = docs.sparkSession.sparkContext.broadcast(np.concatenate([logs, np.zeros((*logs.shape[:2], 1), np.float32)], 2))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, logs = letter_table(), shared.value
        for pdf in by_chars(batches):
            texts = pdf["text"].tolist()
            known = np.array([bool(x and langs and _LETTER.search(x)) for x in texts], bool)
            best, sure = np.full(len(texts), "und", object), np.zeros(len(texts))
            if langs and len(texts):
                grams, starts = _grams(texts, letters)
                total = np.stack([sum(np.add.reduceat(logs[i, k][g], starts, dtype=np.float64) for i, g in enumerate(grams)) for k in range(len(langs))], 1)
                sizes = np.diff(np.concatenate([starts, [len(grams[0])]]))
                total /= np.sqrt(sizes)[:, None]  # neighbouring n-grams are not independent
                top = total.argmax(1)
                odds = np.exp(total - total.max(1, keepdims=True))
                best[known] = np.array(langs, object)[top[known]]
                sure[known] = (odds.max(1) / odds.sum(1))[known]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "lang_pred": best, "score": sure})

    return long_ids(text_ids(docs).mapInPandas(score, "doc_id string, lang_pred string, score double"))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: fold 2 of 4 is held out; all documents are predicted."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, fold("doc_id", 4) != 2)
    return predict(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
