"""Fixed dimensions and default marker lists of evaluation sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The categories and their aspects, in report order.
CATEGORIES = ("Integration", "Reasoning", "Logic", "Figure", "Abstention")
ASPECTS = {
    "Integration": ("multi_source_integration", "multi_doc_reference", "remote_reference", "standards_reference"),
    "Reasoning": ("quantitative_calc", "multi_hop", "negation", "causal", "temporal", "comparison_conditional"),
    "Logic": ("synonym_interpretation", "numeric_inclusion", "concept_inclusion", "vocabulary_mismatch", "abstraction_gap"),
    "Figure": ("simple_table", "complex_form", "concept_diagram", "flowchart", "chart_graph", "complex_layout", "large_enumeration"),
    "Abstention": ("insufficient_evidence", "contradictory_evidence", "fragmented_chunk"),
}
LEVELS = ("Easy", "Medium", "Hard")
LEAKAGE = ("pass", "fail")
DIFFICULTY_MATCH = ("aligned", "too_easy", "too_hard")
REVIEW_STATUS = ("pending", "accepted", "edited", "rejected")
EVIDENCE = ("no-evidence", "hier-ref", "coord-ref", "multi-ref")
OUTPUT_TYPES = ("summary", "trans", "list", "none")
VERDICTS = ("match", "partial", "no_match")
KG_QUERY_TYPES = ("single_fact", "multi_hop", "aggregation", "traceability", "negation_exhaustive")
KG_NOVELTY = ("unknown_term", "unknown_relation", "procedural_relation")
KNOWLEDGE = ("known", "unknown")

# Targets and thresholds of the reports and gates.
TARGET_RETRIEVAL = {"Easy": 0.375, "Medium": 0.375, "Hard": 0.25}
TARGET_ANSWER = {"Easy": 0.175, "Medium": 0.625, "Hard": 0.2}
TARGET_ABSTENTION = (0.10, 0.15)
PILOT_SIZE = (30, 50)
ASPECT_LEAST = 3
ANSWERABILITY_LEAST = 4.0
GROUNDING_LEAST = 4.0
UNIQUENESS_MOST = 0.92
RATIONALE_LEAST = 0.5

# Hint words and markers that make a chunk fit an aspect.
TABLE_MARKERS = ("|---", "| ---", "<table", "<tr", "<td")
FLOW_HINTS = ("フロー", "手順", "ステップ", "→", "▼", "(1)", "(2)", "①", "②")
CHART_HINTS = ("グラフ", "チャート", "折れ線", "棒グラフ", "円グラフ", "推移")
FIGURE_HINTS = ("![", "<img", "<figure", "図1", "図2", "図3", "Fig.", "Figure")
DIAGRAM_HINTS = ("構成図", "ブロック図", "概念図", "組織図")
COMPARISON_HINTS = ("以上", "以下", "未満", "超え", "より", "に対し", "倍", "%")
CAUSAL_HINTS = ("ため", "により", "原因", "結果", "ことから", "ゆえ")
TEMPORAL_HINTS = ("まず", "次に", "最後に", "後", "前", "までに", "経過", "順序")
NEGATION_HINTS = ("ない", "禁止", "除く", "適用しない", "してはならない")
LIST_LINE = r"^\s*(?:[-*・]|\p{Nd}+[.)]|[①-⑳])"
NUMBER = r"\p{Nd}+(?:\.\p{Nd}+)?"

# Identifiers of standards, and parts of regulations.
REFERENCES = (
    r"JIS\s*[A-Z]\s*\d{4}(?:-\d+)?",
    r"ISO\s*\d{4,5}(?:-\d+)?",
    r"IEC\s*\d{4,5}",
    r"ASME\s*[A-Z]+(?:\.\d+)?",
    r"第\s*\d+\s*章",
    r"第\s*\d+\s*節",
    r"第\s*\d+\s*条",
    r"第\s*\d+\s*項",
    r"別表\s*\d+",
    r"附属書\s*[A-Z]",
    r"\d+\.\d+(?:\.\d+)?\s*項",
)
SPECIFIC_REFERENCE = r"第\d+条|別表|附属書|第\d+章"

# Answers that say there is no answer, after the marks are taken off.
UNABLE = (
    "回答不能", "不明", "わからない", "分からない", "判断できない", "判断できません", "該当なし", "回答できません",
    "記載なし", "情報なし", "記述なし", "文書からは特定できません", "文書からは特定できない", "answernotavailable",
    "notavailable", "unknown",
)
UNABLE_MARKS = " 　。、．，「」『』\"'.,"
#: White space as Unicode has it, for trimming.
SPACES = "".join(map(chr, (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)))

ASPECT_ROWS = [(a, c, i) for i, (c, a) in enumerate((c, a) for c in CATEGORIES for a in ASPECTS[c])]


def aspects(spark: SparkSession) -> DataFrame:
    """aspect, category and ord: 25 rows."""
    return spark.createDataFrame(ASPECT_ROWS, "aspect string, category string, ord int")


def domain(spark: SparkSession, name: str, values: tuple[str, ...]) -> DataFrame:
    """A column of fixed values, with their order."""
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{name} string, ord int")
