"""Items for the report queries, derived from the conversation, document and label tables.

A user turn and the assistant turn after it are question and answer; the document that an item rests on, its aspect,
levels, track and verdicts follow from its number, and its scores from the document's labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims, schemas
from ..functions import rules
from ..functions.text import qa_id


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per question: ids, texts, quote, dimensions, scores and verdicts."""
    turns = read(spark, sf_dir, "conversations")
    users = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    replies = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    qa = users.join(replies, ["conv_id", "turn"]).withColumn("k", F.col("conv_id") * 8 + F.col("turn"))
    docs = read(spark, sf_dir, "documents")
    total = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    labels = read(spark, sf_dir, "labels")
    k = F.col("k")
    qa = qa.crossJoin(F.broadcast(total)).withColumn("doc_id", F.pmod(k * 31, F.col("n_docs")))  # one row
    qa = qa.join(docs.select("doc_id", F.substring("text", 11, 60).alias("start")), "doc_id").join(labels, "doc_id", "left")
    kg = F.pmod(k, F.lit(4)) == 3
    verified = F.pmod(k, F.lit(7)) != 0
    names = tuple(a for a, _, _ in dims.ASPECT_ROWS)
    qa = qa.select(
        "k", "question", "answer", "doc_id",
        F.when(F.pmod(k, F.lit(5)) == 0, F.reverse("start")).otherwise(F.col("start")).alias("quote"),
        _pick(names, F.pmod(k * 7, F.lit(25))).alias("aspect"),
        _pick(dims.LEVELS, F.pmod(k, F.lit(3))).alias("retrieval_level"),
        _pick(dims.LEVELS, F.pmod(k * 5 + 1, F.lit(3))).alias("answer_level"),
        _pick(dims.LEVELS, F.pmod(k.cast("long") * 3 + F.col("doc_id"), F.lit(3))).alias("measured_level"),
        F.when(kg, _pick(dims.KG_QUERY_TYPES, F.pmod(k.cast("long") * 3, F.lit(5)))).alias("kg_query_type"),
        F.when(kg, _pick(dims.KG_NOVELTY, F.pmod(k.cast("long") * 2, F.lit(3)))).alias("kg_novelty"),
        F.when(kg & (F.pmod(k, F.lit(8)) == 3), "unknown").when(kg, "known").alias("llm_knowledge"),
        F.when(F.col("quality") == 1, 5.0).when(F.col("quality") == 0, 2.0).alias("answerability"),
        F.when(F.col("toxic") == 1, "fail").when(F.col("toxic") == 0, "pass").alias("leakage"),
        F.when(F.col("quality").isNotNull(), F.pmod(k, F.lit(5)) + 1.0).alias("grounding"),
        F.when(F.pmod(k, F.lit(11)) != 0, F.round(F.pmod(k * 13, F.lit(100)) / 100.0, 2)).alias("uniqueness"),
        F.when(F.pmod(k, F.lit(5)) == 0, 0.0).otherwise(1.0).alias("rationale_grounded"),
        F.when(verified, _pick(dims.VERDICTS, F.pmod(k * 11, F.lit(3)))).alias("answer_match"),
        F.when(verified, F.pmod(k, F.lit(2)) == 0).alias("retrieval_hit_doc"),
        F.when(verified, F.pmod(k, F.lit(6)) == 0).alias("retrieval_hit_chunk"),
        _pick(dims.REVIEW_STATUS, F.pmod(k * 3 + 1, F.lit(4))).alias("review_status"),
    )
    return qa.withColumns({
        "retrieval_hit": F.col("retrieval_hit_doc") | F.col("retrieval_hit_chunk"),
        "qa_id": qa_id(F.array(F.concat(F.col("doc_id").cast("string"), F.lit("__c0000"))), F.coalesce("kg_query_type", "aspect"), F.col("question")),
        "category": _category(),
        "track": F.when(rules.is_kg(F.col("kg_query_type"), F.col("kg_novelty")), "kg_poc").otherwise("general"),
        "difficulty_match": rules.difficulty_match(F.col("answer_level"), F.col("measured_level")),
    })


def qa_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same items with the columns of item files, and their number k; what they have no value for is null."""
    rows = items(spark, sf_dir)
    got = {
        "rationale": F.array(F.struct(F.col("doc_id").cast("string").alias("doc_id"), F.lit(1).alias("page"), F.col("quote").alias("text"))),
        "category": F.array("category"), "aspect": F.array("aspect"),
        "filter_scores": F.struct("answerability", "leakage", "grounding", "uniqueness", "difficulty_match", "rationale_grounded"),
        "rag_verification": F.when(F.col("answer_match").isNotNull(), F.struct("answer_match", "retrieval_hit_doc", "retrieval_hit_chunk", "retrieval_hit")),
    }
    fields = spark.createDataFrame([], schemas.QA).schema
    return rows.select("k", *[got.get(f.name, F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields])


def _category():
    out = F.lit(None).cast("string")
    for category in dims.CATEGORIES:
        out = F.when(F.col("aspect").isin(*dims.ASPECTS[category]), category).otherwise(out)
    return out


def _list(values: tuple[str, ...]) -> str:
    return "[" + ",".join(f"'{v}'" for v in values) + "]"


def _case(column: str) -> str:
    return "CASE " + " ".join(f"WHEN {column} IN ({','.join(repr(a) for a in dims.ASPECTS[c])}) THEN '{c}'" for c in dims.CATEGORIES) + " END"


#: The same items in SQL, as a WITH clause that ends in `qa`.
QA_SQL = f"""
WITH q0 AS (
  SELECT u.conv_id*8+u.turn AS k, u.text AS question, a.text AS answer
  FROM conversations u JOIN conversations a ON a.conv_id=u.conv_id AND a.turn=u.turn+1 AND a.role='assistant' WHERE u.role='user'
), q1 AS (SELECT q0.*, (k*31) % (SELECT count(*) FROM documents) AS doc_id FROM q0),
q2 AS (SELECT q1.*, substr(d.text,11,60) AS start, l.quality, l.toxic, (k%4=3) AS kg, (k%7<>0) AS verified
  FROM q1 JOIN documents d USING (doc_id) LEFT JOIN labels l USING (doc_id)),
q3 AS (SELECT k, question, answer, doc_id, CASE WHEN k%5=0 THEN reverse(start) ELSE start END AS quote,
  {_list(tuple(a for a, _, _ in dims.ASPECT_ROWS))}[(k*7)%25+1] AS aspect,
  {_list(dims.LEVELS)}[k%3+1] AS retrieval_level, {_list(dims.LEVELS)}[(k*5+1)%3+1] AS answer_level, {_list(dims.LEVELS)}[(k*3+doc_id)%3+1] AS measured_level,
  CASE WHEN kg THEN {_list(dims.KG_QUERY_TYPES)}[(k*3)%5+1] END AS kg_query_type,
  CASE WHEN kg THEN {_list(dims.KG_NOVELTY)}[(k*2)%3+1] END AS kg_novelty,
  CASE WHEN kg AND k%8=3 THEN 'unknown' WHEN kg THEN 'known' END AS llm_knowledge,
  CASE quality WHEN 1 THEN 5.0::DOUBLE WHEN 0 THEN 2.0::DOUBLE END AS answerability,
  CASE toxic WHEN 1 THEN 'fail' WHEN 0 THEN 'pass' END AS leakage,
  CASE WHEN quality IS NOT NULL THEN (k%5+1)::DOUBLE END AS grounding,
  CASE WHEN k%11<>0 THEN round(((k*13)%100)/100.0::DOUBLE,2) END AS uniqueness,
  CASE WHEN k%5=0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS rationale_grounded,
  CASE WHEN verified THEN {_list(dims.VERDICTS)}[(k*11)%3+1] END AS answer_match,
  CASE WHEN verified THEN k%2=0 END AS retrieval_hit_doc, CASE WHEN verified THEN k%6=0 END AS retrieval_hit_chunk,
  {_list(dims.REVIEW_STATUS)}[(k*3+1)%4+1] AS review_status FROM q2),
qa AS (SELECT *, retrieval_hit_doc OR retrieval_hit_chunk AS retrieval_hit,
  'auto_' || substr(sha1(doc_id || '__c0000' || '::' || coalesce(kg_query_type,aspect) || '::' || question),1,8) AS qa_id,
  {_case('aspect')} AS category,
  CASE WHEN kg_query_type IS NOT NULL OR kg_novelty IS NOT NULL THEN 'kg_poc' ELSE 'general' END AS track,
  CASE WHEN answer_level=measured_level THEN 'aligned'
       WHEN list_position({_list(dims.LEVELS)},measured_level) < list_position({_list(dims.LEVELS)},answer_level) THEN 'too_easy' ELSE 'too_hard' END AS difficulty_match
  FROM q3)
"""
