"""Canonical exact fingerprints: Unicode compatibility form, case and white space folded, then a 128-bit xxhash.

Documents with equal digests are compared by their canonical bytes (their smallest and largest in each bucket, which are
gathered by partial aggregates); where a bucket holds different bytes, the fingerprint gets the rank of its bytes.

Each document is also held against an edited copy of itself and against the next document, in descending doc_id (rows
with one doc_id by a hash of the text; null ids last). Documents are sorted by range over the cluster; a range's last
document meets the first one of the range after it, one document a range. Likeness is 1 where canonical bytes are equal,
else 0: an exact digest has no degrees. Null texts count as empty. A table of one row is its own next document. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, documents, materialise, table


def canonical(text: str) -> bytes:
    """The bytes that equal texts share: compatibility form, case folded, white space as single spaces."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    else:
        text = text.lower()
    return " ".join(text.split()).encode("utf-8", "surrogatepass")


def digest(data: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(data)


def _digests(docs: DataFrame) -> DataFrame:
    """doc_id, mark and the digest of the canonical bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "mark": pdf["mark"], "fingerprint": [digest(canonical(x)) for x in pdf["text"]]})

    found = docs.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(run, "doc_id string, mark long, fingerprint string")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


class _Pairs:
    """Makes a row of each document and the one after it. Both are tuples (doc_id, text, canonical bytes, more); `more`
    says whether the bytes go with the row, as those of digests in `wanted` do."""

    columns = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "bytes", "edited_bytes")

    def __init__(self, wanted: frozenset[str]):
        self.wanted, self.pack = wanted, zstandard.ZstdCompressor(level=3)

    def row(self, this: tuple, after: tuple) -> tuple:
        doc, before, its, more = this
        n = len(before)
        edited = before[: n - n // 2] + after[1][: n // 2]
        new = canonical(edited)
        mark, new_mark = digest(its), digest(new)
        sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        clash = mark == new_mark and its != new
        own, others = more or clash or mark in self.wanted, clash or new_mark in self.wanted
        return doc, n, sha, mark, new_mark, float(its == new), float(its == after[2]), self.pack.compress(its) if own else None, self.pack.compress(new) if others else None


_RESULT = "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, bytes binary, edited_bytes binary"


def _paired(docs: DataFrame, flags: DataFrame, wanted: frozenset[str]) -> DataFrame:
    """The rows of all documents. flags: (doc_id, mark) of those whose bytes go with them."""
    rows = docs.select(F.lit(1).alias("seq"), "doc_id", "mark", "text")
    rows = rows.unionByName(flags.select(F.lit(0).alias("seq"), "doc_id", "mark", F.lit(None).cast("string").alias("text")))
    order = [F.col("doc_id").desc_nulls_last(), F.col("mark")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, "seq", "text").withColumn("doc_id", F.col("doc_id").cast("string"))

    columns, none = (*_Pairs.columns, "part", "end", "text", "more"), (None,) * 4

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of all documents but the task's last one; the task's first and last text, with the task's number."""
        pairs, part = _Pairs(wanted), TaskContext.get().partitionId()
        edge = lambda doc, *more: (doc, *(None,) * (len(_Pairs.columns) - 1), part, *more)
        held = flagged = None
        for pdf in batches:
            out = []
            for seq, doc, mark, text in zip(pdf["seq"], pdf["doc_id"], pdf["mark"], pdf["text"], strict=True):
                if seq == 0:
                    flagged = (doc, mark)
                    continue
                this = (doc, text, canonical(text), flagged == (doc, mark))
                out.append(edge(None, 0, text, False) if held is None else (*pairs.row(held, this), *none))
                held = this
            yield pd.DataFrame(out, columns=columns, dtype=object)
        if held is not None:
            yield pd.DataFrame([edge(held[0], 1, held[1], held[3])], columns=columns, dtype=object)

    found = materialise(dealt.mapInPandas(run, f"{_RESULT}, part int, end int, text string, more boolean"), "fingerprints")
    parts = sorted(r["part"] for r in found.where("end = 0").select("part").collect())  # the tasks that had rows
    follows = found.sparkSession.createDataFrame([(p, parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)], "part int, after int")
    firsts = found.where("end = 0").select(F.col("part").alias("after"), F.col("text").alias("after_text"))
    lasts = found.where("end = 1").select("part", "doc_id", "text", "more").join(follows, "part").join(firsts, "after")  # a row a task

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = _Pairs(wanted)
        for pdf in batches:
            out = [
                pairs.row((doc, text, canonical(text), more), (None, after, canonical(after), False))
                for doc, text, more, after in zip(pdf["doc_id"], pdf["text"], pdf["more"], pdf["after_text"], strict=True)
            ]
            yield pd.DataFrame(out, columns=_Pairs.columns, dtype=object)

    out = found.where("end is null").select(*_Pairs.columns).unionByName(lasts.mapInPandas(close, _RESULT))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""
    docs = documents(docs).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("mark", F.xxhash64("text"))
    marks = materialise(_digests(docs), "fingerprint-digests")
    shared = marks.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fingerprint")
    shared = materialise(shared, "fingerprint-shared")
    twice = materialise(marks.join(shared, "fingerprint").select("doc_id", "mark"), "fingerprint-twice").distinct()
    out = _paired(docs, twice, frozenset())

    # bytes are compared inside equal buckets: their least and greatest, by partial aggregates
    known = lambda df: df.select("fingerprint", "bytes").unionByName(df.select(F.col("edited_fingerprint").alias("fingerprint"), F.col("edited_bytes").alias("bytes")))
    ends = known(out).where(F.col("bytes").isNotNull()).groupBy("fingerprint").agg(F.min("bytes").alias("lo"), F.max("bytes").alias("hi"))
    odd = [r["fingerprint"] for r in ends.where("lo <> hi").select("fingerprint").collect()]  # 128-bit collisions: none to be expected
    discard(marks, shared)
    if not odd:
        return out.drop("bytes", "edited_bytes")
    out = _paired(docs, twice, frozenset(odd))
    given = known(out).where(F.col("fingerprint").isin(odd)).distinct()
    ranks = given.withColumn("rank", F.row_number().over(Window.partitionBy("fingerprint").orderBy("bytes")))
    for mark, data in (("fingerprint", "bytes"), ("edited_fingerprint", "edited_bytes")):
        own = ranks.select(F.col("fingerprint").alias(mark), F.col("bytes").alias(data), "rank")
        out = out.join(own, [mark, data], "left").withColumn(mark, F.concat(mark, F.coalesce(F.concat(F.lit("-"), F.col("rank")), F.lit("")))).drop(data, "rank")
    return out


def query(spark, sf_dir: str) -> DataFrame:
    """op4: all documents."""
    return fingerprint(table(spark, sf_dir, "documents"))
