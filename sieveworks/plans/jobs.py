"""Jobs from files to files: chunk, filter, verify, probe, review and reports."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims, schemas
from ..functions import rules
from ..functions.text import is_unable, page_blocks, parsed, qa_id, unseen_terms
from ..operators import asking, items, reports, sampling, similarity
from ..sources import files, layouts


def chunk(
    spark: SparkSession, docs: str, out: str, size: int = 800, overlap: int = 100, patterns: Iterable[str] = (),
    layout: Callable[[bytes], str] | None = None, cache: str | None = None, pdf: Callable[[bytes], list[str]] | None = None,
) -> DataFrame:
    """Chunks of all documents of a folder; doc_id and number of chunks.

    PDF files are read by `layout` if it is given (file to layout Markdown, kept in the folder `cache`); those that it can't
    read, or all without it, by `pdf` (file to page texts) if that is given; else they are left out.
    """
    pages = laid = None
    if layout:
        if not cache:
            raise ValueError("layouts are kept in a folder: name one as the cache")
        got, failed = layouts.layouts(spark, docs, cache, layout)
        laid = files.layout_documents(got.select(files.stem(F.col("path")).alias("doc_id"), F.col("markdown").alias("text")))
    if pdf:
        pages = files.pdf_pages(spark, docs, pdf)
        if layout:
            pages = pages.join(failed.select(files.stem(F.col("path")).alias("doc_id")), "doc_id", "left_semi")
    return files.write_chunks(files.documents(spark, docs), out, size, overlap, patterns, pages, laid)


def embed(chunks: DataFrame, embedder: Callable, out: str) -> None:
    """chunk_id and vec of all chunks, replaced in one folder. Raises ValueError if a chunk's vector can't be had."""
    asking.embedded(chunks.select("chunk_id", "text"), embedder, "text", "vec").select("chunk_id", "vec").write.mode("overwrite").parquet(out)
    if chunks.sparkSession.read.parquet(out).where("vec is null").head(1):
        raise ValueError("some chunks have no vector")


def _quotes(qa: DataFrame) -> DataFrame:
    rows = qa.select("qa_id", F.posexplode("rationale").alias("quote_no", "r"))
    return rows.select("qa_id", "quote_no", "r.doc_id", "r.page", F.col("r.text").alias("quote"))


def _ordered(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("ord", F.struct("doc_id", "position", "chunk_id"))


def judged(qa: DataFrame, chunks: DataFrame, client: asking.Client, model: str, prompts: dict[str, str], replies: str, embed: Callable | None = None) -> DataFrame:
    """items with all filter scores. Replies are kept in the folder `replies` by model and prompt: a later run, as with other
    thresholds or more items, asks only what is new."""
    quotes = _quotes(qa)
    anchors = items.resolve_anchors(quotes, _ordered(chunks))
    blocks = anchors.groupBy("qa_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("quote_no", "text"))), lambda x: x["text"]), "\n\n").alias("anchors"))
    prompts_df = asking.judge_prompts(
        qa.join(blocks, "qa_id", "left").select("qa_id", "question", "answer", F.array_join(F.transform("rationale", lambda r: r["text"]), "\n").alias("rationale_text"), "anchors"), prompts
    )
    scores = asking.collated(asking.answered(prompts_df, client, model, "prompt", "reply", replies).select("qa_id", "perspective", "reply"))
    out = asking.scored(qa.drop("filter_scores"), scores).join(items.grounding(quotes, anchors), "qa_id", "left")
    out = out.withColumn("rationale_grounded", F.coalesce("rationale_grounded", F.lit(0.0)))
    if embed is None:
        return out.withColumn("uniqueness", F.lit(None).cast("double"))
    vectors = asking.embedded(qa.select("qa_id", "question"), embed, "question", "vec").where("vec is not null")
    vectors = vectors.select(F.xxhash64("qa_id").alias("id"), "vec", F.lit(0).alias("label"), "qa_id")
    return out.join(similarity.uniqueness(vectors).join(vectors.select("id", "qa_id"), "id").drop("id"), "qa_id", "left")


def gate(rows: DataFrame, **rules_given) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and dropped ones with their reasons. Conditions on retrieval are void if no row has been verified."""
    verification = F.col("rag_verification") if "rag_verification" in rows.columns else F.lit(None)
    some = rows.agg((F.count(verification) > 0).alias("_some"))
    fields = ("answer_match", "retrieval_hit_doc", "retrieval_hit_chunk", "retrieval_hit")
    wide = rows.withColumns({f: F.col(f"rag_verification.{f}") for f in fields}) if "rag_verification" in rows.columns else rows
    reasons = rules.reject_reasons(verified=F.col("_some"), **rules_given)
    wide = wide.crossJoin(F.broadcast(some)).withColumn("reasons", reasons).drop("_some")  # one row
    return wide.where(F.size("reasons") == 0), wide.where(F.size("reasons") > 0)


def retrieve(qa: DataFrame, chunks: DataFrame, vectors: DataFrame, embed: Callable, k: int = 5) -> DataFrame:
    """qa_id, rank, chunk_id, doc_id, page, section_path, text of each question's k nearest chunks. vectors: chunk_id, vec.

    Raises ValueError if a chunk has no vector or a vector no chunk.
    """
    odd = chunks.select("chunk_id").join(vectors.select("chunk_id", "vec"), "chunk_id", "full_outer").where("vec is null")
    stale = vectors.join(chunks, "chunk_id", "left_anti")
    if odd.head(1) or stale.head(1):
        raise ValueError("vectors and chunks differ")
    asked = asking.embedded(qa.select("qa_id", "question"), embed, "question", "vec").where("vec is not null")
    queries = asked.select(F.xxhash64("qa_id").alias("id"), "vec", F.lit(0).alias("label"), "qa_id")
    corpus = vectors.select(F.xxhash64("chunk_id").alias("id"), "vec", F.lit(0).alias("label"), "chunk_id")
    found = similarity.nearest(corpus, queries, k)
    named = found.join(queries.select(F.col("id").alias("query"), "qa_id"), "query").join(corpus.select("id", "chunk_id"), "id")
    return named.select("qa_id", "rank", "chunk_id").join(chunks, "chunk_id").select("qa_id", "rank", "chunk_id", "doc_id", "page", "section_path", "text")


def verify(qa: DataFrame, retrieved: DataFrame, client: asking.Client, models: tuple[str, str], prompts: dict[str, str], replies: str, k: int = 5, batch: int = 10_000) -> DataFrame:
    """qa_id and rag_verification of each item: what was found, what the model answered from it, and what the judge says.

    The judge is asked only about answers that say something; all replies are kept in the folder `replies` by model and prompt,
    those of `batch` prompts at a time.
    """
    hits = items.retrieval_hits(_quotes(qa), retrieved)
    block = F.array_sort(F.collect_list(F.struct("rank", "chunk_id", "page", "section_path", "text")))
    found = retrieved.groupBy("qa_id").agg(block.alias("found"))
    rows = qa.select("qa_id", "question", "answer").join(found, "qa_id", "left")
    prompt = asking.rendered(prompts["RAG_ANSWER"], chunks_block=page_blocks(F.col("found")), question=F.col("question"))
    rows = rows.withColumn("prompt", F.when(F.col("found").isNotNull(), prompt))
    rows = asking.answered(rows, client, models[0], "prompt", "reply", replies, batch=batch)
    said = F.coalesce(F.trim(parsed(F.col("reply"), "answer string")["answer"]), F.lit(""))
    rows = rows.withColumn("rag_answer", said).drop("prompt", "reply")
    judge = asking.rendered(prompts["JUDGE"], ground_truth=F.col("answer"), candidate=F.col("rag_answer"))
    rows = rows.withColumn("prompt", F.when(~is_unable(F.col("rag_answer")), judge))
    rows = asking.verdicts(asking.answered(rows, client, models[1], "prompt", "judge_reply", replies, batch=batch)).join(hits, "qa_id", "left")
    doc, part = (F.coalesce(c, F.lit(False)) for c in ("hit_doc", "hit_chunk"))
    return rows.select(
        "qa_id",
        F.struct(
            F.lit(k).alias("top_k"), F.coalesce(F.transform("found", lambda x: x["chunk_id"]), F.array().cast("array<string>")).alias("retrieved_chunk_ids"),
            doc.alias("retrieval_hit_doc"), part.alias("retrieval_hit_chunk"), (doc | part).alias("retrieval_hit"), "rag_answer", "answer_match", "judge_raw",
            F.lit(models[0]).alias("rag_model"), F.lit(models[1]).alias("judge_model"), F.current_timestamp().cast("timestamp_ntz").alias("verified_at"),
        ).alias("rag_verification"),
    )


def probe(qa: DataFrame, client: asking.Client, models: tuple[str, str], prompts: dict[str, str], replies: str) -> DataFrame:
    """qa_id and llm_knowledge: whether a model answers an item without any document."""
    asked = qa.select("qa_id", "answer", asking.rendered(prompts["PROBE"], question=F.col("question")).alias("prompt"))
    rows = asking.answered(asked, client, models[0], "prompt", "reply", replies)
    rows = rows.withColumn("candidate", parsed(F.col("reply"), "answer string")["answer"]).drop("prompt")
    judge = asking.rendered(prompts["JUDGE"], ground_truth=F.col("answer"), candidate=F.col("candidate"))
    blank = F.coalesce(F.trim("candidate").isin("", "不明"), F.lit(True))
    rows = asking.answered(rows.withColumn("prompt", F.when(~blank, judge)), client, models[1], "prompt", "judge_reply", replies)
    return asking.knowledge(rows).select("qa_id", "llm_knowledge")


def request_values(requests: DataFrame, few_shot: str = "[]") -> dict[str, Column]:
    """What a generation prompt can name: the anchors, the first of them, the aspect and its category, the cell, and seeds as JSON."""
    column = lambda name: F.col(name) if name in requests.columns else F.lit(None).cast("string")
    first = F.get("anchors", F.lit(0))
    page = F.coalesce(first["page"].cast("string"), F.lit("null"))
    category = F.lit(None).cast("string")
    for name, aspects in dims.ASPECTS.items():
        category = F.when(column("aspect").isin(*aspects), name).otherwise(category)
    return {
        "chunks_block": page_blocks(F.col("anchors")), "anchor_chunks_block": page_blocks(F.col("anchors")), "key": F.col("key"), "few_shot": F.lit(few_shot),
        "doc_id": first["doc_id"], "page": page, "page_or_null": page, "chunk_id": first["chunk_id"],
        "aspect": column("aspect"), "category": category, "aspect_json": F.to_json(F.array(column("aspect"))), "category_json": F.to_json(F.array(category)),
        "kg_query_type": column("kg_query_type"), "kg_novelty": column("kg_novelty"),
    }


def generate(requests: DataFrame, client: asking.Client, model: str, template: str, replies: str, version: str = "unknown", few_shot: str = "[]") -> tuple[DataFrame, DataFrame]:
    """Accepted items and rejected replies with a reason, for requests (request_id, key, anchors: array of chunk structs, and, if
    they have them, aspect, kg_query_type and kg_novelty).

    A reply must be a JSON object with question, answer and rationale; an item with long terms that its anchors lack is rejected.
    Cell, retrieval level and retrieval flags are those of the request and its anchors, whatever the reply says.
    """
    spark = requests.sparkSession
    prompt = asking.rendered(template, **request_values(requests, few_shot))
    asking.ask(requests.withColumn("prompt", prompt), client, model, "prompt", "reply").drop("prompt").write.mode("overwrite").parquet(replies)
    rows = spark.read.parquet(replies)
    known = F.array_join(F.transform("anchors", lambda c: c["text"]), "")
    n, docs = F.size("anchors"), F.size(F.array_distinct(F.transform("anchors", lambda c: c["doc_id"])))
    places = F.transform("anchors", lambda c: c["position"])
    gap = F.when(docs == 1, F.array_max(places) - F.array_min(places)).otherwise(0)
    longest = F.array_max(F.transform("anchors", lambda c: F.length(c["text"])))
    cell = [c for c in ("kg_query_type", "kg_novelty") if c in rows.columns]
    rows = rows.withColumn("b", parsed(F.col("reply"), schemas.GENERATED)).select("request_id", "key", "anchors", "reply", *cell, "b.*").withColumns({
        "new_terms": unseen_terms(F.concat_ws(" ", "question", "answer"), known),
        "retrieval_level": rules.retrieval_level(n, docs, gap),
        "retrieval_difficulty": schemas.flag_struct("retrieval_difficulty", rules.retrieval_flags(n, docs, gap, longest)),
        "qa_id": qa_id(F.transform("anchors", lambda c: c["chunk_id"]), F.col("key"), F.col("question")),
        "generation": F.struct(F.lit(model).alias("model"), F.lit(version).alias("prompt_version"), F.current_timestamp().cast("timestamp_ntz").alias("generated_at")),
    })
    rows = schemas.with_defaults(schemas.as_items(rows))
    odd = F.exists(schemas.problems(), lambda p: p.endswith("_domain"))
    reason = (
        F.when(F.col("question").isNull() | F.col("answer").isNull() | F.col("rationale").isNull(), "no item in the reply")
        .when(odd, "outside the domain")
        .when(F.size("new_terms") > 0, "terms that the anchors lack")
    )
    rows = rows.withColumn("reason", reason)
    return rows.where("reason is null").drop("reason", "reply", "new_terms"), rows.where("reason is not null").select("request_id", "reason", "reply", "new_terms")


def reviewed(qa: DataFrame, events: DataFrame) -> DataFrame:
    """items with the last decision on each: status, reviewer, time, and the edited texts. events: as schemas.REVIEW_EVENT."""
    last = events.groupBy("qa_id").agg(F.max(F.struct("reviewed_at", "status", "reviewer", "question", "answer")).alias("e"))
    rows = qa.join(last, "qa_id", "left")
    edited = F.col("e.status") == "edited"
    return rows.withColumns({
        "question": F.when(edited, F.coalesce("e.question", "question")).otherwise(F.col("question")),
        "answer": F.when(edited, F.coalesce("e.answer", "answer")).otherwise(F.col("answer")),
        "review_status": F.coalesce("e.status", "review_status"),
        "reviewed_by": F.coalesce("e.reviewer", "reviewed_by"),
        "reviewed_at": F.coalesce("e.reviewed_at", "reviewed_at"),
    }).drop("e")


def pattern_sample(chunks: DataFrame, most: int = 12_000) -> str:
    """The text of the first chunks, in order, that fit in `most` characters; the first overflow ends it.

    A chunk with a place of `most` or more can't fit, so only chunks of the first documents by id are looked at.
    """
    rows = sampling.prefix(chunks, F.length("text"), most, ["doc_id", "position"]).orderBy("doc_id", "position").collect()
    return "\n\n".join(f"### {r['doc_id']}\n{r['text']}" for r in rows)


def accepted_patterns(entries: list[dict], sample: str, share: float = 0.05) -> list[dict]:
    """Those of a model's patterns that compile, occur in the sample, and cover no more than a share of it (if it has 500 characters)."""
    import re

    out = []
    for entry in entries:
        try:
            found = [m.group(0) for m in re.finditer(entry.get("regex") or "(?!)", sample)]
        except (re.error, TypeError):
            continue
        if found and any(found) and (len(sample) < 500 or sum(map(len, found)) <= share * len(sample)):
            out.append(entry)
    return out


def stats(qa: DataFrame) -> dict[str, DataFrame]:
    """The report tables of a set of items."""
    spark = qa.sparkSession
    f = schemas.flat(qa).withColumnsRenamed({"category_primary": "category", "rag_answer_match": "answer_match", "rag_retrieval_hit": "retrieval_hit"})
    hits = qa.select("qa_id", *[F.col(f"rag_verification.{h}").alias(h) for h in ("answer_match", "retrieval_hit_doc", "retrieval_hit_chunk", "retrieval_hit")])
    by_aspect = f.select("*", F.explode("aspect_list").alias("aspect"))
    domain = lambda name, values: dims.domain(spark, name, values)
    reasons = f.select(F.explode(rules.reject_reasons()).alias("reason")).where("reason <> 'rationale_grounded'")
    bins = {"answerability": dims.ANSWERABILITY_LEAST, "grounding": dims.GROUNDING_LEAST, "uniqueness": round(1 - dims.UNIQUENESS_MOST, 6)}
    return {
        "levels": items.distribution(f, "retrieval_level", domain("level", dims.LEVELS), "level"),
        "answer_levels": items.distribution(f, "answer_level", domain("level", dims.LEVELS), "level"),
        "target_gaps": reports.target_gaps(f),
        "categories": items.distribution(f, "category", domain("category", dims.CATEGORIES), "category"),
        "abstention": reports.abstention(f),
        "status": items.distribution(f, "review_status", domain("status", dims.REVIEW_STATUS), "status"),
        "cells": items.crosstab(f, ("category", domain("category", dims.CATEGORIES)), ("retrieval_level", domain("retrieval_level", dims.LEVELS))),
        "aspects": reports.aspect_coverage(by_aspect),
        "coverage": reports.category_coverage(by_aspect),
        "verdicts": reports.verdicts_by_aspect(by_aspect),
        "verification": reports.verification_counts(hits),
        "reasons": reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason"),
        "documents": f.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")),
        "kpis": reports.kpis(f),
        "scorecard": reports.scorecard(f),
        "kg": reports.knowledge_matrix(f),
        "knowledge": reports.knowledge_counts(f),
        "kg_candidates": reports.candidates(f).select("qa_id", "doc_id"),
        **{f"histogram_{name}": reports.histogram(f, name, least) for name, least in bins.items()},
    }
