"""Declared schemas of chunks and items, and the checks of their domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import dims

CHUNK = "chunk_id string, doc_id string, page int, text string, position int, section_path array<string>, references array<string>"
_FLAGS = {
    "reasoning_complexity": ("multi_step", "quantitative", "negation", "cause_effect", "comparison", "temporal"),
    "retrieval_difficulty": (
        "multi_doc", "multi_chunk", "low_locality", "remote_reference", "doc_volume_large", "chunk_size_large",
        "abstraction_discrepancy", "vocabulary_mismatch",
    ),
    "source_structure": ("tables_charts", "complex_layout", "specific_area_ref", "logical_nesting", "large_enumeration", "redundancy"),
}


def _flags(name: str) -> str:
    more = ",output_type:string" if name == "reasoning_complexity" else ""
    return f"{name} struct<" + ",".join(f"{f}:boolean" for f in _FLAGS[name]) + more + ">"


VERIFICATION = (
    "struct<top_k:int,retrieved_chunk_ids:array<string>,retrieval_hit_doc:boolean,retrieval_hit_chunk:boolean,"
    "retrieval_hit:boolean,rag_answer:string,answer_match:string,judge_raw:string,rag_model:string,judge_model:string,verified_at:timestamp_ntz>"
)
QA = ", ".join(
    [
        "qa_id string, question string, answer string, rationale array<struct<doc_id:string,page:int,text:string>>",
        "category array<string>, aspect array<string>",
        *[_flags(n) for n in _FLAGS],
        "explainability struct<evidence_strictness:string>",
        "retrieval_level string, answer_level string, difficulty_rationale string, business_scenario string",
        "kg_query_type string, kg_novelty string, llm_knowledge string",
        f"rag_verification {VERIFICATION}",
        "generation struct<model:string,prompt_version:string,generated_at:timestamp_ntz>",
        "filter_scores struct<answerability:double,leakage:string,grounding:double,uniqueness:double,difficulty_match:string,rationale_grounded:double>",
        "review_status string, reviewed_by string, reviewed_at timestamp_ntz",
    ]
)
#: What a model's reply may hold of an item; the rest of QA is known from the request.
GENERATED = ", ".join(
    [
        "question string, answer string, rationale array<struct<doc_id:string,page:int,text:string>>, category array<string>, aspect array<string>",
        _flags("reasoning_complexity"), _flags("source_structure"), "explainability struct<evidence_strictness:string>",
        "answer_level string, difficulty_rationale string, business_scenario string",
    ]
)
REVIEW_EVENT = "qa_id string, status string, reviewer string, reviewed_at timestamp_ntz, question string, answer string"


def with_defaults(qa: DataFrame) -> DataFrame:
    """Missing lists become empty, missing flags false, a missing status pending."""
    out = qa.withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in ("category", "aspect")})
    for name, flags in _FLAGS.items():
        fields = [F.coalesce(F.col(name)[f], F.lit(False)).alias(f) for f in flags]
        if name == "reasoning_complexity":
            fields.append(F.coalesce(F.col(name)["output_type"], F.lit("none")).alias("output_type"))
        out = out.withColumn(name, F.struct(*fields))
    return out.withColumn("review_status", F.coalesce("review_status", F.lit("pending")))


def flag_struct(name: str, known: dict[str, Column]) -> Column:
    """The flags of a group as a struct: those that are known, and false for the others."""
    return F.struct(*[known.get(f, F.lit(False)).alias(f) for f in _FLAGS[name]])


def as_items(rows: DataFrame) -> DataFrame:
    """rows with the columns of QA: those they lack are null, those that they have keep their values."""
    fields = rows.sparkSession.createDataFrame([], QA).schema
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in rows.columns})


def problems() -> Column:
    """What is wrong with an item, as an array of names: missing fields and values outside their domains."""
    c = F.col
    within = lambda x, values: x.isNull() | x.isin(*values)
    names = [a for a, _, _ in dims.ASPECT_ROWS]
    tests = {
        **{f: c(f).isNull() for f in ("qa_id", "question", "answer", "rationale", "retrieval_level", "answer_level")},
        "retrieval_level_domain": ~within(c("retrieval_level"), dims.LEVELS),
        "answer_level_domain": ~within(c("answer_level"), dims.LEVELS),
        "aspect_domain": F.size(F.array_except(c("aspect"), F.array(*[F.lit(a) for a in names]))) > 0,
        "category_domain": F.size(F.array_except(c("category"), F.array(*[F.lit(a) for a in dims.CATEGORIES]))) > 0,
        "output_type_domain": ~within(c("reasoning_complexity.output_type"), dims.OUTPUT_TYPES),
        "evidence_domain": ~within(c("explainability.evidence_strictness"), dims.EVIDENCE),
        "kg_query_type_domain": ~within(c("kg_query_type"), dims.KG_QUERY_TYPES),
        "kg_novelty_domain": ~within(c("kg_novelty"), dims.KG_NOVELTY),
        "llm_knowledge_domain": ~within(c("llm_knowledge"), dims.KNOWLEDGE),
        "leakage_domain": ~within(c("filter_scores.leakage"), dims.LEAKAGE),
        "difficulty_match_domain": ~within(c("filter_scores.difficulty_match"), dims.DIFFICULTY_MATCH),
        "answer_match_domain": ~within(c("rag_verification.answer_match"), dims.VERDICTS),
        "review_status_domain": ~within(c("review_status"), dims.REVIEW_STATUS),
    }
    return F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]))


def checked(qa: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid items with their defaults, and rejected ones with the array `problems`."""
    rows = with_defaults(qa).withColumn("problems", problems())
    return rows.where(F.size("problems") == 0).drop("problems"), rows.where(F.size("problems") > 0)


def flat(qa: DataFrame) -> DataFrame:
    """The report view of items: first of the lists, document of the first quote, scores and verdicts."""
    score, rag = "filter_scores", "rag_verification"
    return qa.select(
        "qa_id", "question", "answer",
        F.coalesce(F.get("category", F.lit(0)), F.lit("unknown")).alias("category_primary"), F.array_join("category", ", ").alias("category_all"),
        F.coalesce(F.get("aspect", F.lit(0)), F.lit("unknown")).alias("aspect_primary"), F.col("aspect").alias("aspect_list"),
        F.get("rationale", F.lit(0))["doc_id"].alias("doc_id"), F.coalesce(F.size("rationale"), F.lit(0)).alias("n_rationale"),
        "retrieval_level", "answer_level", "kg_query_type", "kg_novelty", "llm_knowledge", "review_status",
        *[F.col(f"{score}.{f}").alias(f) for f in ("answerability", "leakage", "grounding", "uniqueness", "difficulty_match", "rationale_grounded")],
        F.col(f"{rag}.answer_match").alias("rag_answer_match"), F.col(f"{rag}.retrieval_hit").alias("rag_retrieval_hit"),
        F.when(F.col("kg_query_type").isNotNull() | F.col("kg_novelty").isNotNull(), "kg_poc").otherwise("general").alias("track"),
    )


def tags(qa: DataFrame) -> DataFrame:
    """qa_id and the names of its true flags, its output type unless none, and its evidence."""
    parts = [F.when(F.col(n)[f], F.lit(f)) for n, fs in _FLAGS.items() for f in fs]
    parts.append(F.when(F.col("reasoning_complexity.output_type") != "none", F.col("reasoning_complexity.output_type")))
    parts.append(F.col("explainability.evidence_strictness"))
    return qa.select("qa_id", F.array_join(F.array_compact(F.array(*parts)), ", ").alias("tags"))
