"""Operators over question-answer items and the chunks that they rest on."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import plain_doc_id, squeeze
from .partners import within


def resolve_anchors(quotes: DataFrame, chunks: DataFrame) -> DataFrame:
    """qa_id, quote_no, doc_id, page, chunk_id, text: the chunk that each quote rests on.

    quotes: qa_id, quote_no, doc_id, page, quote. chunks: chunk_id, doc_id, page, ord, text. Candidates come from the first
    of these that has any: same document and page (null pages are equal); the document that a chunk id names, and page; the
    chunk of that id; any chunk of the document. Of them the first (by ord) that contains the quote, white space aside,
    else the first. Quotes without a candidate are left out. One join on the document finds all of these.
    """
    q = quotes.select("qa_id", "quote_no", F.col("doc_id").alias("said"), F.col("page").alias("said_page"), squeeze(F.col("quote")).alias("needle"))
    q = q.withColumn("base", plain_doc_id(F.col("said")))
    keys = q.withColumn("key", F.explode(F.array_distinct(F.array("said", "base"))))
    c = chunks.select("chunk_id", "doc_id", "page", "ord", "text")
    met = keys.join(c, keys["key"] == c["doc_id"])
    same_page = F.col("page").eqNullSafe(F.col("said_page"))
    prio = (
        F.when((F.col("doc_id") == F.col("said")) & same_page, 1)
        .when((F.col("doc_id") == F.col("base")) & same_page, 2)
        .when(F.col("chunk_id") == F.col("said"), 3)
        .when(F.col("doc_id") == F.col("base"), 4)
    )
    met = met.withColumn("prio", prio).where("prio is not null")
    hit = (F.col("needle") != "") & F.contains(squeeze(F.col("text")), F.col("needle"))
    # the least (prio, not hit, ord) of a quote, by a partial aggregate: no quote's candidates are sorted in one place
    best = F.min(F.struct("prio", (~hit).alias("miss"), "ord", "doc_id", "page", "chunk_id", "text"))
    return met.groupBy("qa_id", "quote_no").agg(best.alias("b")).select("qa_id", "quote_no", "b.doc_id", "b.page", "b.chunk_id", "b.text")


def grounding(quotes: DataFrame, anchors: DataFrame) -> DataFrame:
    """qa_id and the share of its quotes that its anchors' joined text has, white space aside; 0 without an anchor."""
    joined = anchors.groupBy("qa_id", "chunk_id").agg(F.min("quote_no").alias("quote_no"), F.first("text").alias("text"))
    blob = joined.groupBy("qa_id").agg(F.array_sort(F.collect_list(F.struct("quote_no", "text"))).alias("parts"))
    blob = blob.select("qa_id", F.array_join(F.transform("parts", lambda p: squeeze(p["text"])), "").alias("blob"))
    needle = squeeze(F.col("quote"))
    hit = F.coalesce((needle != "") & F.contains(F.col("blob"), needle), F.lit(False))
    return quotes.join(blob, "qa_id", "left").groupBy("qa_id").agg((F.sum(hit.cast("int")) / F.count(F.lit(1))).alias("rationale_grounded"))


def retrieval_hits(quotes: DataFrame, retrieved: DataFrame) -> DataFrame:
    """qa_id, hit_doc, hit_chunk. retrieved: qa_id, rank, chunk_id, doc_id, text. Quotes may straddle chunk borders."""
    got = retrieved.groupBy("qa_id").agg(
        F.collect_set("doc_id").alias("docs"), F.collect_set("chunk_id").alias("ids"), F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("parts")
    )
    blob = F.array_join(F.transform("parts", lambda p: squeeze(p["text"])), "")
    rows = quotes.join(got.withColumn("blob", blob), "qa_id", "left")
    needle = squeeze(F.col("quote"))
    doc = F.array_contains("docs", plain_doc_id(F.col("doc_id"))) | F.array_contains("ids", F.col("doc_id"))
    return rows.groupBy("qa_id").agg(
        F.max(F.coalesce(doc, F.lit(False))).alias("hit_doc"), F.max(F.coalesce((needle != "") & F.contains(F.col("blob"), needle), F.lit(False))).alias("hit_chunk")
    )


def remote_partners(chunks: DataFrame, gap: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, position, partner: for each chunk one of its document that stands `gap` or more places off, by hash.

    Positions of a document are 0 to n - 1, so the partner is computed and no pairs are formed. Chunks without one are left out.
    """
    n = chunks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    rows = chunks.select("doc_id", "position").join(n, "doc_id")
    before = F.greatest(F.col("position") - (gap - 1), F.lit(0))
    after = F.greatest(F.col("n") - F.col("position") - gap, F.lit(0))
    number = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "doc_id", "position").cast("binary")), 1, 8), 16, 10).cast("long")
    pick = F.pmod(number, F.nullif(before + after, F.lit(0)))
    partner = F.when(pick < before, pick).otherwise(F.col("position") + gap + pick - before)
    return rows.where(before + after > 0).select("doc_id", "position", partner.cast("int").alias("partner"))


def followed_references(chunks: DataFrame) -> DataFrame:
    """chunk_id, ref, target: for each reference of a chunk the first other chunk (by id) that has it, or a longer one around it.

    chunks: chunk_id, refs. So `JIS B 1083` leads to a chunk that names `JIS B 1083-1` only. Which of the distinct references
    hold which is found through their substrings; an inverted index keeps the first two holders of each, which serve all others.
    """
    held = chunks.select("chunk_id", F.explode(F.array_distinct("refs")).alias("ref")).where("ref <> ''")
    parts = within(held.select("ref").distinct())
    has = held.withColumnRenamed("ref", "whole").join(parts, "whole")
    first = has.groupBy("ref").agg(F.min("chunk_id").alias("first"), F.max("chunk_id").alias("last"))
    second = has.join(first.where("first <> last"), "ref").where("chunk_id <> first").groupBy("ref").agg(F.min("chunk_id").alias("second"), F.min("first").alias("first"))
    target = F.when(F.col("chunk_id") == F.col("first"), F.col("second")).otherwise(F.col("first"))
    return held.join(second, "ref").select("chunk_id", "ref", target.alias("target"))


def latest(events: DataFrame, key: str, order: Iterable[Column]) -> DataFrame:
    """The last event of each key: a review log becomes the state of its items."""
    return events.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def distribution(items: DataFrame, column: str, values: DataFrame, name: str) -> DataFrame:
    """Each value of a fixed domain, its count (0 if none) and its share of all items, those outside the domain included."""
    counts = items.groupBy(F.col(column).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    total = items.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("total"))
    rows = values.join(counts, name, "left").crossJoin(F.broadcast(total))  # one row
    return rows.select(name, "ord", F.coalesce("n", F.lit(0)).alias("n"), F.round(F.coalesce("n", F.lit(0)) / F.col("total"), 6).alias("ratio"))


def crosstab(items: DataFrame, left: tuple[str, DataFrame], right: tuple[str, DataFrame]) -> DataFrame:
    """Counts of all cells of two fixed domains, zeros included."""
    (a, da), (b, db) = left, right
    cells = da.select(a).crossJoin(F.broadcast(db.select(b)))  # fixed domains
    counts = items.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    return cells.join(counts, [a, b], "left").select(a, b, F.coalesce("n", F.lit(0)).alias("n"))
