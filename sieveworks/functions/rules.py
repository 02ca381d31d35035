"""Column functions over judged items: difficulty, gates, aspects, tracks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dims
from .text import has_any


def level_rank(level: Column) -> Column:
    """0, 1, 2 for the three levels; null for others."""
    out = F.when(level == dims.LEVELS[0], 0)
    for i, name in enumerate(dims.LEVELS[1:], 1):
        out = out.when(level == name, i)
    return out


def difficulty_match(declared: Column, measured: Column) -> Column:
    d, m = level_rank(declared), level_rank(measured)
    return F.when(m == d, "aligned").when(m < d, "too_easy").when(m > d, "too_hard")


def retrieval_level(n_chunks: Column, n_docs: Column, gap: Column) -> Column:
    """How hard it is to find an item's anchors, from their number, their documents, and the widest gap in one document."""
    return F.when(n_chunks <= 1, "Easy").when((n_docs >= 2) | (gap >= 10), "Hard").otherwise("Medium")


def retrieval_flags(n_chunks: Column, n_docs: Column, gap: Column, longest: Column) -> dict[str, Column]:
    return {
        "multi_doc": n_docs >= 2,
        "multi_chunk": n_chunks >= 2,
        "low_locality": gap >= 3,
        "remote_reference": gap >= 10,
        "chunk_size_large": longest >= 1200,
    }


def is_kg(query_type: Column, novelty: Column) -> Column:
    return query_type.isNotNull() | novelty.isNotNull()


def kg_aspect(query_type: Column, novelty: Column) -> Column:
    """The aspect whose anchors fit a cell of query type and novelty."""
    return (
        F.when(query_type == "single_fact", "quantitative_calc")
        .when(query_type.isin("multi_hop", "traceability") | novelty.isin("unknown_relation", "procedural_relation"), "reference_follow")
        .when(query_type == "aggregation", "multi_source_integration")
        .otherwise("reference_follow")
    )


def count_of(text: Column, part: str) -> Column:
    """Non-overlapping occurrences."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def aspect_fits(text: Column, section_path: Column, refs: Column) -> dict[str, Column]:
    """For each aspect (and reference_follow) whether a chunk can serve as its anchor."""
    table = has_any(text, dims.TABLE_MARKERS)
    figure = has_any(text, dims.FIGURE_HINTS)
    compared = has_any(text, dims.COMPARISON_HINTS)
    calc = (F.regexp_count(text, F.lit(dims.NUMBER)) >= 2) & compared
    rules = {
        "standards_reference": F.exists(refs, lambda r: r.rlike("^(?:JIS|ISO|IEC|ASME)")),
        "quantitative_calc": calc,
        "negation": has_any(text, dims.NEGATION_HINTS),
        "causal": has_any(text, dims.CAUSAL_HINTS),
        "temporal": has_any(text, dims.TEMPORAL_HINTS),
        "comparison_conditional": compared,
        "numeric_inclusion": calc,
        "simple_table": table,
        "complex_form": has_any(text, ("rowspan", "colspan")) | (table & (count_of(text, "\n|") >= 4)),
        "concept_diagram": has_any(text, dims.DIAGRAM_HINTS) | figure,
        "flowchart": has_any(text, dims.FLOW_HINTS),
        "chart_graph": has_any(text, dims.CHART_HINTS) | figure,
        "complex_layout": F.size(section_path) >= 2,
        "large_enumeration": F.regexp_count(text, F.lit("(?m)" + dims.LIST_LINE)) >= 5,
        "reference_follow": F.size(refs) > 0,
    }
    every = [a for a, _, _ in dims.ASPECT_ROWS] + ["reference_follow"]
    return {a: rules.get(a, F.lit(True)) for a in every}


def reject_reasons(
    *, answerability_least: float = dims.ANSWERABILITY_LEAST, grounding_least: float = dims.GROUNDING_LEAST, uniqueness_most: float = dims.UNIQUENESS_MOST,
    rationale_least: float = dims.RATIONALE_LEAST, leakage: bool = True, reject_too_easy: bool = False,
    rag_fail: bool = False, rag_hit: bool = False, rationale_retrieved: bool = False, verified: Column | None = None,
) -> Column:
    """Why an item is dropped, in order; a null score never drops one. Columns: the scores, answer_match and the hit flags.

    The three conditions on retrieval count only where `verified` holds (some item of the batch has been verified).
    """
    if rag_fail and rag_hit:
        raise ValueError("rag_fail and rag_hit exclude each other")
    c = F.col
    tests = [
        (c("answerability") < answerability_least, "answerability"),
        ((c("leakage") == "fail") & F.lit(leakage), "leakage"),
        (c("grounding") < grounding_least, "grounding"),
        (c("uniqueness") < 1.0 - uniqueness_most, "uniqueness"),
        (c("rationale_grounded") < rationale_least, "rationale_grounded"),
    ]
    if reject_too_easy:
        tests.append((c("difficulty_match") == "too_easy", "difficulty_match"))
    on = F.lit(True) if verified is None else verified
    if rag_fail:
        tests.append((on & (c("answer_match") != "no_match"), "rag_match"))
    if rag_hit:
        tests.append((on & (c("answer_match") != "match"), "rag_no_match"))
    if rationale_retrieved:
        legacy = ~c("retrieval_hit_chunk") & ~c("retrieval_hit_doc") & c("retrieval_hit")
        tests.append((on & c("answer_match").isNotNull() & ~c("retrieval_hit_chunk") & ~legacy, "not_retrieved"))
    return F.array_compact(F.array(*[F.when(test, name) for test, name in tests]))
