"""Commands over files: python -m sieveworks COMMAND ..."""

from __future__ import annotations

import argparse
import importlib
import json
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dims, schemas
from .operators import anchors, asking, reports, sampling
from .plans import jobs, requests
from .session import session
from .sources import files
from .streaming.verification import verify_new


def _client(path: str):
    """A model client given as module:name."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def _text(spark, path: str) -> str:
    return "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="sieveworks")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *options: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        for option in options:
            p.add_argument(f"--{option}", required=True, dest="source" if option == "in" else option.replace("-", "_"))
        return p

    p = command("chunk", "docs", "out")
    p.add_argument("--chunk-size", type=int, default=800)
    p.add_argument("--chunk-overlap", type=int, default=100)
    p.add_argument("--patterns", help="a folder that the command patterns has written")
    p.add_argument("--layout", help="module:name of a callable: PDF file -> layout Markdown")
    p.add_argument("--layout-cache", help="the folder in which layouts are kept; a file is read again when it has changed")
    p.add_argument("--pdf", help="module:name of a callable: PDF file -> page texts, for files without a layout")
    command("embed", "chunks", "embed", "out")
    p = command("patterns", "chunks", "prompt", "client", "model", "out")
    p.add_argument("--max-chars", type=int, default=12_000)
    p = command("generate", "chunks", "prompt", "client", "model", "replies", "out")
    p.add_argument("--n", type=int, default=10)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--track", choices=("general", "kg_poc"), default="general")
    p.add_argument("--vectors", help="a folder that the command embed has written; without it no anchors are neighbours")
    p.add_argument("--batch", default=time.strftime("%Y%m%d_%H%M%S"), help="batches stand side by side below the output folder")
    p.add_argument("--seeds", help="a JSON file with an array of examples, three of which are named in the prompts")
    p.add_argument("--mix", help="query_type:novelty=N, ... for the kg_poc track")
    p = command("filter", "in", "chunks", "prompts", "client", "model", "replies", "out")
    p.add_argument("--embed", help="module:name of a callable: texts -> vectors; without it uniqueness is not scored")
    p.add_argument("--answerability-least", type=float, default=dims.ANSWERABILITY_LEAST)
    p.add_argument("--grounding-least", type=float, default=dims.GROUNDING_LEAST)
    p.add_argument("--uniqueness-most", type=float, default=dims.UNIQUENESS_MOST)
    p.add_argument("--rationale-least", type=float, default=dims.RATIONALE_LEAST)
    p.add_argument("--skip-leakage", action="store_true")
    _conditions(p)
    _conditions(command("gate", "in", "out"))
    p = command("verify", "in", "chunks", "vectors", "prompts", "client", "embed", "replies", "out")
    p.add_argument("--models", nargs=2, required=True, metavar=("ANSWER", "JUDGE"))
    p.add_argument("--top-k", type=int, default=5)
    p.add_argument("--batch-size", type=int, default=200, help="items in a file that lands, and prompts whose replies are kept together; a run verifies and writes the files in 16 micro-batches at most")
    p = command("probe", "in", "prompts", "client", "replies", "out")
    p.add_argument("--models", nargs=2, required=True, metavar=("PROBE", "JUDGE"))
    command("review", "in", "events", "out")
    p = command("stats", "in", "out")
    p.add_argument("--track", choices=("general", "kg_poc", "all"), default="all")
    args = parser.parse_args(argv)
    if getattr(args, "rag_fail", False) and args.rag_hit:
        parser.error("--rag-fail and --rag-hit exclude each other")
    return args


def _conditions(p: argparse.ArgumentParser) -> None:
    for flag in ("reject-too-easy", "rag-fail", "rag-hit", "rationale-retrieved"):
        p.add_argument(f"--{flag}", action="store_true")


SCORES = ("answerability", "leakage", "grounding", "uniqueness", "difficulty_match", "rationale_grounded")


def _gate(args: argparse.Namespace, rows: DataFrame, columns: list[str], **more) -> None:
    scored = rows.withColumn("filter_scores", F.struct(*SCORES))
    kept, dropped = jobs.gate(scored, reject_too_easy=args.reject_too_easy, rag_fail=args.rag_fail, rag_hit=args.rag_hit, rationale_retrieved=args.rationale_retrieved, **more)
    files.write_qa(kept.select(*columns), f"{args.out}/kept")
    reports.gate_counts(kept.select("reasons").unionByName(dropped.select("reasons"))).write.mode("overwrite").json(f"{args.out}/counts")
    files.write_qa(dropped.select(*columns, "reasons"), f"{args.out}/dropped")  # with their scores: another gate can take them back


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = session()
    if args.command == "chunk":
        more = files.patterns(spark, args.patterns) if args.patterns else ()
        layout, pdf = (_client(x) if x else None for x in (args.layout, args.pdf))
        jobs.chunk(spark, args.docs, args.out, args.chunk_size, args.chunk_overlap, more, layout, args.layout_cache, pdf).show(50, False)
    elif args.command == "embed":
        jobs.embed(files.chunks(spark, args.chunks), _client(args.embed), args.out)
    elif args.command == "patterns":
        chunks = files.chunks(spark, args.chunks)
        sample = jobs.pattern_sample(chunks, args.max_chars)
        reply = asking.retried(lambda: _client(args.client)(_text(spark, args.prompt).replace("{sample}", sample), args.model))
        found = jobs.accepted_patterns(json.loads(reply).get("patterns", []), sample)
        about = {"model": args.model, "discovered_at": time.strftime("%Y-%m-%dT%H:%M:%S"), "n_chunks": chunks.count(), "sample_chars": len(sample)}
        body = json.dumps(about | {"patterns": found}, ensure_ascii=False)
        spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("overwrite").text(args.out)
    elif args.command == "generate":
        cells = requests.cells(args.n, requests.parse_mix(args.mix) if args.mix else None, args.seed)
        rows = requests.requests(spark, args.n, args.seed) if args.track == "general" else requests.kg_requests(spark, cells)
        vectors = spark.read.parquet(args.vectors) if args.vectors else None
        sets = anchors.anchor_sets(rows, files.chunks(spark, args.chunks), vectors, seed=args.seed)
        if args.track == "kg_poc":
            sets = sets.drop("key").join(rows.select("request_id", "kg_query_type", "kg_novelty", F.col("kg_query_type").alias("key")), "request_id")
        meta, body = asking.front_matter(_text(spark, args.prompt))
        seeds = json.loads(_text(spark, args.seeds)) if args.seeds else []
        seeds = [seeds[r["i"]] for r in sampling.bottom_k(spark.range(len(seeds)).withColumnRenamed("id", "i"), "i", 3, seed=args.seed).orderBy("pick").collect()]
        good, bad = jobs.generate(
            sets.where("miss is null or miss <> 'partner'").drop("miss"), _client(args.client), args.model, body, args.replies,
            meta.get("prompt_version", "unknown"), json.dumps(seeds, ensure_ascii=False, indent=2))
        good.drop("anchors").write.json(f"{args.out}/accepted/batch={args.batch}")
        bad.write.json(f"{args.out}/rejected/batch={args.batch}")
        misses = sets.groupBy("aspect").agg(F.count(F.lit(1)).alias("requests"), *[F.count(F.when(F.col("miss") == m, 1)).alias(f"{m}_misses") for m in ("partner", "compat")])
        misses.coalesce(1).write.json(f"{args.out}/misses/batch={args.batch}")
    elif args.command == "filter":
        qa = files.qa(spark, args.source)
        embed = _client(args.embed) if args.embed else None
        rows = jobs.judged(qa, files.chunks(spark, args.chunks), _client(args.client), args.model, asking.sections(_text(spark, args.prompts)), args.replies, embed)
        _gate(args, rows, qa.columns, leakage=not args.skip_leakage, answerability_least=args.answerability_least, grounding_least=args.grounding_least,
              uniqueness_most=args.uniqueness_most, rationale_least=args.rationale_least)
    elif args.command == "gate":
        qa = files.qa(spark, args.source)
        _gate(args, qa.select("*", *[f"filter_scores.{f}" for f in SCORES]), qa.columns)
    elif args.command == "verify":
        qa, chunks = files.qa(spark, args.source), files.chunks(spark, args.chunks)
        vectors, prompts = spark.read.parquet(args.vectors), asking.sections(_text(spark, args.prompts))

        def verified(batch: DataFrame) -> DataFrame:
            found = jobs.retrieve(batch, chunks, vectors, _client(args.embed), args.top_k)
            return batch.drop("rag_verification").join(jobs.verify(batch, found, _client(args.client), tuple(args.models), prompts, args.replies, args.top_k, args.batch_size), "qa_id")

        print(f"{verify_new(qa, args.out, verified, args.batch_size)} items were new")
    elif args.command == "probe":
        qa = files.qa(spark, args.source)
        known = jobs.probe(qa, _client(args.client), tuple(args.models), asking.sections(_text(spark, args.prompts)), args.replies)
        files.write_qa(qa.drop("llm_knowledge").join(known, "qa_id"), args.out)
    elif args.command == "review":
        files.write_qa(jobs.reviewed(files.qa(spark, args.source), spark.read.schema(schemas.REVIEW_EVENT).json(args.events)), args.out)
    else:
        qa, skipped = files.qa_lenient(spark, args.source, args.track)
        skipped.show(50, False)
        for name, report in jobs.stats(qa).items():
            report.coalesce(1).write.mode("overwrite").json(f"{args.out}/{name}")


if __name__ == "__main__":
    main()
