"""Language and embedding models behind injected clients.

A client is any callable that can be pickled: client(prompt, model) -> reply text, or embed(texts) -> vectors. Replies are
written to a table before anything is computed from them (`answered`), so that no question is asked twice, whether a plan or a
job runs again.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions import rules
from ..functions.text import is_unable, parsed
from ..session import delete, entries

Client = Callable[[str, str], str]
PERSPECTIVES = ("ANSWERABILITY", "LEAKAGE", "GROUNDING", "DIFFICULTY_MATCH")


def retried(call: Callable[[], str], attempts: int = 6, first: float = 2.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """The result of a call, tried again with growing pauses; the last error is raised."""
    for i in range(attempts):
        try:
            return call()
        except Exception:
            if i == attempts - 1:
                raise
            sleep(min(most, first * 2**i))
    raise AssertionError


def ask(rows: DataFrame, client: Client, model: str, prompt: str, reply: str, attempts: int = 6, at_once: int | None = None) -> DataFrame:
    """rows with the reply to each prompt; null where the prompt is null or the client fails for good.

    at_once bounds the tasks that call the client.
    """
    schema = rows.withColumn(reply, F.lit(None).cast("string")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text in pdf[prompt]:
                try:
                    out.append(None if text is None else retried(lambda t=text: client(t, model), attempts))
                except Exception:  # a reply that can't be had is a null; the others count
                    out.append(None)
            yield pdf.assign(**{reply: out})

    return (rows.repartition(at_once) if at_once else rows).mapInPandas(run, schema)


REPLIES = "digest string, model string, prompt string, reply string"


def digest(model: str, prompt: Column) -> Column:
    """What a reply is kept under: a hash of the model's name and the prompt."""
    return F.sha2(F.concat(F.lit(f"{len(model)}:{model}:"), prompt), 256)


def answered(rows: DataFrame, client: Client, model: str, prompt: str, reply: str, store: str, attempts: int = 6, at_once: int | None = None, batch: int = 10_000) -> DataFrame:
    """rows with the reply to each prompt, as `ask` gives them, out of the folder `store`; what it lacks is asked first and added.

    Replies are kept by model and prompt: a prompt that several rows share is asked once, one that an earlier run has asked is not
    asked again, and a failure is no reply and is asked again by the next run. Prompts are asked in batches and the replies of
    each are on disk, in a folder of their own, before the next begins, so a run that dies loses those of one batch. The store may
    be shared by jobs and is read once in a call, for the prompts of these rows; if it holds several replies for one prompt, as two
    runs at once may have added them, the least counts.
    """
    spark = rows.sparkSession
    key = "_digest"
    rows = rows.withColumn(key, digest(model, F.col(prompt)))
    store = store.rstrip("/")
    # Spark's readers skip names that begin with an underscore
    place = f"{store}/_asked/{uuid.uuid4().hex}"
    waiting, known, left = (f"{place}/{name}" for name in ("prompts", "known", "left"))
    # a file is asked by one task: of each batch every task gets a share, but not less than 100 prompts
    share = min(batch, max(100, -(-batch // spark.sparkContext.defaultParallelism)))
    prompts = lambda *places: spark.read.schema("digest string, prompt string").parquet(*places)
    todo = rows.where(F.col(prompt).isNotNull()).groupBy(F.col(key).alias("digest")).agg(F.min(prompt).alias("prompt"))
    todo.write.option("maxRecordsPerFile", share).parquet(waiting)
    found, rest = [], waiting
    # by name: Spark takes two reads of one folder for the same, whatever was added to it in between
    if kept := entries(spark, store):
        old = spark.read.schema(REPLIES).parquet(*kept).join(prompts(waiting).select("digest"), "digest", "left_semi")
        old.groupBy("digest").agg(F.min("reply").alias("reply")).write.parquet(known)
        found, rest = [known], left
        lacking = prompts(waiting).join(spark.read.schema("digest string").parquet(known), "digest", "left_anti")
        lacking.write.option("maxRecordsPerFile", share).parquet(left)
    counts = prompts(rest).groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    for names in shares(sorted((r["name"], r["n"]) for r in counts.collect()), batch):
        got = ask(prompts(*[f"{rest}/{name}" for name in names]), client, model, "prompt", "reply", attempts, at_once).where("reply is not null")
        found.append(f"{store}/{uuid.uuid4().hex}")
        got.select("digest", F.lit(model).alias("model"), "prompt", "reply").write.parquet(found[-1])
    for done in (waiting, left):
        delete(spark, done)
    if not found:
        return rows.withColumn(reply, F.lit(None).cast("string")).drop(key)
    replies = spark.read.schema("digest string, reply string").parquet(*found)  # one for each prompt
    return rows.join(replies.select(F.col("digest").alias(key), F.col("reply").alias(reply)), key, "left").drop(key)


def shares(counts: list[tuple[str, int]], most: int) -> list[list[str]]:
    """The names of (name, n), in order, in groups whose n add up to `most` at most; one that is larger stands alone."""
    out: list[list[str]] = []
    total = 0
    for name, n in counts:
        if not out or total + n > most:
            out.append([])
            total = 0
        out[-1].append(name)
        total += n
    return out


def embedded(rows: DataFrame, embed: Callable[[list[str]], list[list[float]]], text: str, vector: str, batch: int = 256) -> DataFrame:
    """rows with a vector of each text; null for all of a batch that fails."""
    schema = rows.withColumn(vector, F.lit(None).cast("array<double>")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                try:
                    got = [list(map(float, v)) for v in embed(part[text].tolist())]
                except Exception:
                    got = [None] * len(part)
                yield part.assign(**{vector: got})

    return rows.mapInPandas(run, schema)


def rendered(template: str, **values: Column) -> Column:
    """A template with {name} replaced by columns; names that are not given stay, and doubled braces become single ones. What is put
    in is not scanned again."""
    token = re.compile(r"\{\{|\}\}" + "".join(rf"|\{{({re.escape(x)})\}}" for x in values))
    parts, at = [], 0
    for m in token.finditer(template):
        name = next(filter(None, m.groups()), None)
        parts += [F.lit(template[at : m.start()]), F.coalesce(values[name].cast("string"), F.lit("")) if name else F.lit(m[0][0])]
        at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def sections(markdown: str) -> dict[str, str]:
    """The `## [NAME]` blocks of a prompt file, each up to the next one, a rule, or the end."""
    out: dict[str, list[str]] = {}
    name = None
    for line in markdown.splitlines():
        if line.startswith("## [") and line.rstrip().endswith("]"):
            name = line.rstrip()[4:-1]
            out[name] = []
        elif line.strip() == "---":
            name = None
        elif name is not None:
            out[name].append(line)
    return {k: "\n".join(v).strip() for k, v in out.items()}


def front_matter(markdown: str) -> tuple[dict[str, str], str]:
    """The `key: value` lines between the rules at a file's top, and the rest."""
    if not markdown.startswith("---\n") or "\n---" not in markdown[4:]:
        return {}, markdown
    head, _, body = markdown[4:].partition("\n---")
    pairs = (line.partition(":") for line in head.splitlines() if ":" in line)
    return {k.strip(): v.strip() for k, _, v in pairs}, body.lstrip("\n")


def judge_prompts(items: DataFrame, prompts: dict[str, str]) -> DataFrame:
    """qa_id, perspective, prompt: one row for each perspective that has a prompt. items: qa_id, question, answer, rationale_text, anchors."""
    rows = None
    for name in PERSPECTIVES:
        if name in prompts:
            part = items.select("qa_id", F.lit(name).alias("perspective"), rendered(prompts[name] + "\n\n{question}\n{answer}\n{rationale}\n{anchors}", question=F.col("question"), answer=F.col("answer"), rationale=F.col("rationale_text"), anchors=F.col("anchors")).alias("prompt"))
            rows = part if rows is None else rows.unionByName(part)
    return rows


def collated(replies: DataFrame) -> DataFrame:
    """qa_id, answerability, leakage, grounding, measured_level of the replies (qa_id, perspective, reply); null where a reply
    is missing or not in its domain."""
    got = parsed(F.col("reply"), "answerability string, leakage string, grounding string, answer_level string")
    rows = replies.withColumn("r", got)
    of = lambda name, value: F.max(F.when(F.col("perspective") == name, value))
    return rows.groupBy("qa_id").agg(
        of("ANSWERABILITY", F.expr("try_cast(r.answerability as double)")).alias("answerability"),
        of("LEAKAGE", F.when(F.col("r.leakage").isin(*dims.LEAKAGE), F.col("r.leakage"))).alias("leakage"),
        of("GROUNDING", F.expr("try_cast(r.grounding as double)")).alias("grounding"),
        of("DIFFICULTY_MATCH", F.when(F.col("r.answer_level").isin(*dims.LEVELS), F.col("r.answer_level"))).alias("measured_level"),
    )


def scored(items: DataFrame, judged: DataFrame) -> DataFrame:
    """items (qa_id, answer_level) with the judged scores and difficulty_match; the declared level stays beside the measured one."""
    rows = items.join(judged, "qa_id", "left").withColumn("declared_level", F.col("answer_level"))
    rows = rows.withColumn("difficulty_match", rules.difficulty_match(F.col("declared_level"), F.col("measured_level")))
    return rows.withColumn("answer_level", F.coalesce("measured_level", "answer_level"))


def verdicts(rows: DataFrame) -> DataFrame:
    """rows with answer_match and judge_raw, from rag_answer and the judge's reply (judge_reply): an answer that says there is
    none, a failed judge or a verdict outside the domain is no_match; what the judge said is kept."""
    said = F.lower(F.trim(parsed(F.col("judge_reply"), "match string")["match"]))
    raw = F.when(is_unable(F.col("rag_answer")), None).otherwise(said)
    return rows.withColumn("judge_raw", raw).withColumn("answer_match", F.when(F.col("judge_raw").isin(*dims.VERDICTS), F.col("judge_raw")).otherwise("no_match"))


def knowledge(rows: DataFrame) -> DataFrame:
    """rows with llm_knowledge, from the candidate answer and the judge's reply: unknown unless the judge says known."""
    said = F.lower(F.trim(parsed(F.col("judge_reply"), "match string")["match"]))
    blank = F.coalesce(F.trim("candidate").isin("", "不明"), F.lit(True))
    return rows.withColumn("llm_knowledge", F.when(~blank & (said == "known"), "known").otherwise("unknown"))
