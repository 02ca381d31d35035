"""Report tables over items: targets, coverage, verdicts, reviews and knowledge.

Each takes rows with the columns that it names and groups by fixed domains or makes one row, so that only partial counts
are shuffled. An empty table gives counts of zero; a share of nothing is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims


def share(part: Column, whole: Column) -> Column:
    return F.round(part / F.greatest(whole, F.lit(1)), 6)


def band(value: Column, low: float, high: float) -> Column:
    return F.when(value < low, "short").when(value > high, "over").otherwise("ok")


def target_gaps(items: DataFrame) -> DataFrame:
    """kind, level, gap: how far the shares of retrieval_level and answer_level are from their targets."""
    every = F.greatest(F.count(F.lit(1)), F.lit(1))
    rows = [
        F.struct(F.lit(kind).alias("kind"), F.lit(level).alias("level"), F.round(F.count_if(F.col(kind) == level) / every - target, 6).alias("gap"))
        for kind, targets in (("retrieval_level", dims.TARGET_RETRIEVAL), ("answer_level", dims.TARGET_ANSWER))
        for level, target in targets.items()
    ]
    return items.agg(F.array(*rows).alias("a")).select(F.explode("a").alias("a")).select("a.*")


def abstention(items: DataFrame) -> DataFrame:
    """n, ratio and status of the items whose category is Abstention."""
    n = F.count_if(F.col("category") == "Abstention")
    got = items.agg(n.alias("n"), (n / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("r"))
    return got.select("n", F.round("r", 6).alias("ratio"), band(F.col("r"), *dims.TARGET_ABSTENTION).alias("status"))


def aspect_coverage(by_aspect: DataFrame) -> DataFrame:
    """aspect, category, n, status of all aspects. by_aspect: a row for each item and aspect."""
    n = by_aspect.groupBy("aspect").agg(F.count(F.lit(1)).alias("n"))
    rows = dims.aspects(by_aspect.sparkSession).join(n, "aspect", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    status = F.when(F.col("n") >= dims.ASPECT_LEAST, "reached").when(F.col("n") > 0, "some").otherwise("none")
    return rows.select("aspect", "category", "n", status.alias("status"))


def category_coverage(by_aspect: DataFrame) -> DataFrame:
    """category, aspects, some (with an item), reached (with enough), missing (names of the rest, in report order)."""
    order = dims.aspects(by_aspect.sparkSession).select("aspect", "ord")
    rows = aspect_coverage(by_aspect).join(order, "aspect")
    missing = F.array_sort(F.collect_list(F.when(F.col("n") == 0, F.struct("ord", "aspect"))))  # 25 rows
    return rows.groupBy("category").agg(
        F.count(F.lit(1)).alias("aspects"), F.count_if(F.col("n") > 0).alias("some"), F.count_if(F.col("status") == "reached").alias("reached"),
        F.array_join(F.transform(missing, lambda x: x["aspect"]), ",").alias("missing"),
    )


def histogram(rows: DataFrame, value: str, least: float) -> DataFrame:
    """bin, passed, n: ten equal bins from the least to the largest value, split by a threshold; all in bin 0 where values are equal."""
    rows = rows.where(F.col(value).isNotNull())
    ends = rows.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    binned = rows.crossJoin(F.broadcast(ends))  # one row
    part = F.try_divide(F.col(value) - F.col("lo"), F.col("hi") - F.col("lo"))
    number = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.lit(9), F.floor(part * 10))).cast("int")
    return binned.select(number.alias("bin"), (F.col(value) >= least).alias("passed")).groupBy("bin", "passed").agg(F.count(F.lit(1)).alias("n"))


def verdicts_by_aspect(by_aspect: DataFrame) -> DataFrame:
    """aspect, n, a count of each verdict and no_match_rate, over verified items."""
    count = {v: F.count_if(F.col("answer_match") == v) for v in dims.VERDICTS}
    n = F.count(F.lit(1))
    return by_aspect.where("answer_match is not null").groupBy("aspect").agg(
        n.alias("n"), *[c.alias(v) for v, c in count.items()], F.round(count["no_match"] / n, 6).alias("no_match_rate"))


#: Items that pass both judged gates; one without a verdict on leakage passes that one.
_CLEARED = "answerability >= 4 and not (leakage <=> 'fail')"


def kpis(items: DataFrame) -> DataFrame:
    """One row of counts."""
    counts = {
        "scored": "answerability is not null", "pending": "review_status = 'pending'", "accepted": "review_status = 'accepted'",
        "rejected": "review_status = 'rejected'", "verified": "answer_match is not null", "rag_pass": "answer_match = 'match'", "cleared": _CLEARED,
    }
    return items.agg(F.count(F.lit(1)).alias("total"), F.countDistinct("doc_id").alias("n_docs"), *[F.expr(f"count_if({c})").alias(n) for n, c in counts.items()])


def scorecard(items: DataFrame) -> DataFrame:
    """One row: total and its place in the pilot's size, shares of reviewed items, of scored ones that clear, of verified ones that match."""
    n = F.count(F.lit(1))
    of = lambda c: F.count_if(F.expr(c))
    return items.agg(
        n.alias("total"), band(n, *dims.PILOT_SIZE).alias("size"), share(of("review_status in ('accepted', 'edited', 'rejected')"), n).alias("review_rate"),
        share(of(_CLEARED), F.count("answerability")).alias("quality_rate"), share(of("answer_match = 'match'"), F.count("answer_match")).alias("rag_rate"),
    )


def verification_counts(items: DataFrame) -> DataFrame:
    """One row: verified items, their verdicts, and what retrieval hit."""
    hits = ("retrieval_hit_doc", "retrieval_hit_chunk", "retrieval_hit")
    return items.agg(
        F.count("answer_match").alias("verified"), *[F.count_if(F.col("answer_match") == v).alias(v) for v in dims.VERDICTS], *[F.count_if(h).alias(h) for h in hits]
    )


def knowledge_matrix(items: DataFrame) -> DataFrame:
    """Counts of all cells of query type and novelty, and of those that a model alone does not know, zeros included."""
    spark, cell = items.sparkSession, ["kg_query_type", "kg_novelty"]
    n = items.dropna(subset=cell).groupBy(cell).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("llm_knowledge") == "unknown").alias("unknown"))
    cells = dims.domain(spark, cell[0], dims.KG_QUERY_TYPES).drop("ord").crossJoin(F.broadcast(dims.domain(spark, cell[1], dims.KG_NOVELTY).drop("ord")))  # fixed domains
    return cells.join(n, cell, "left").fillna(0, ["n", "unknown"])


def knowledge_counts(items: DataFrame) -> DataFrame:
    """One row: probed items, those known and unknown, and the share unknown."""
    probed = F.count("llm_knowledge")
    unknown = F.count_if(F.col("llm_knowledge") == "unknown")
    return items.agg(probed.alias("probed"), F.count_if(F.col("llm_knowledge") == "known").alias("known"), unknown.alias("unknown"), share(unknown, probed).alias("unknown_rate"))


def candidates(items: DataFrame) -> DataFrame:
    """Items for the knowledge track: answerable as far as is known, and not answered by retrieval."""
    return items.where("(answerability is null or answerability >= 4) and answer_match = 'no_match'")


def gate_counts(reasons: DataFrame) -> DataFrame:
    """total, kept, dropped and the share that is kept, of items with their array of reasons."""
    kept = F.count(F.when(F.size("reasons") == 0, 1))
    n = F.count(F.lit(1))
    return reasons.agg(n.alias("total"), kept.alias("kept"), (n - kept).alias("dropped"), F.round(kept / F.greatest(n, F.lit(1)), 6).alias("ratio"))
