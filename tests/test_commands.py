from __future__ import annotations

import json
import sys

import pytest
from pyspark import cloudpickle

import sieveworks.__main__ as cli
from sieveworks.plans import requests

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors can't import this file


def model(prompt, name):
    if "patterns" in prompt:
        return json.dumps({"patterns": [{"regex": r"No\\.\\d+".replace("\\\\", "\\")}]})
    if "GENERATE" in prompt:
        return '{"question": "q?", "answer": "a", "rationale": [{"doc_id": "a", "page": null, "text": "plain"}], "aspect": [], "answer_level": "Easy"}'
    return '{"answerability": 5, "leakage": "pass", "grounding": 5, "answer_level": "Easy", "answer": "24 V", "match": "known"}'


def embed(texts):
    return [[float(len(t)), 1.0] for t in texts]


@pytest.fixture
def run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "_client", lambda path: globals()[path])
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.txt").write_text("plain text No.12 rated 24 V " + "and more words " * 60)
    (tmp_path / "prompts.md").write_text("## [ANSWERABILITY]\nA\n## [LEAKAGE]\nL\n## [GROUNDING]\nG\n## [DIFFICULTY_MATCH]\nD\n## [PROBE]\n{question}\n## [JUDGE]\n{candidate}\n## [RAG_ANSWER]\n{question} {chunks_block}\n")
    (tmp_path / "gen.md").write_text("GENERATE {key}\n{chunks_block}")
    (tmp_path / "pat.md").write_text("patterns in {sample}")
    flags = {"reasoning_complexity": {}, "retrieval_difficulty": {}, "source_structure": {}, "explainability": {}}
    qa = [dict(qa_id=f"q{i}", question=f"question {i}", answer="24 V", rationale=[{"doc_id": "a", "page": None, "text": t}], category=[], aspect=[], retrieval_level="Easy", answer_level="Easy", **flags) for i, t in enumerate(["rated 24 V", "nowhere"])]
    (tmp_path / "qa.jsonl").write_text("\n".join(map(json.dumps, qa)))
    at = lambda name: str(tmp_path / name)
    cli.main(["chunk", "--docs", at("docs"), "--out", at("chunks")])
    return lambda *args: cli.main([at(a[1:]) if a.startswith("@") else a for a in args]), at


def test_commands(spark, run):
    go, at = run
    read = lambda name: spark.read.json(at(name)).collect()
    go("patterns", "--chunks", "@chunks", "--prompt", "@pat.md", "--client", "model", "--model", "m", "--out", "@patterns")
    assert json.loads(spark.read.text(at("patterns")).first()["value"])["patterns"]
    go("generate", "--chunks", "@chunks", "--prompt", "@gen.md", "--client", "model", "--model", "m", "--replies", "@r0", "--out", "@raw", "--n", "4")
    few = len(read("raw/accepted"))  # requests that find no partner are left out
    assert 1 <= few <= 4
    go("embed", "--chunks", "@chunks", "--embed", "embed", "--out", "@embedded")
    assert spark.read.parquet(at("embedded")).count() == spark.read.json(at("chunks")).count()
    go("generate", "--chunks", "@chunks", "--vectors", "@embedded", "--prompt", "@gen.md", "--client", "model", "--model", "m", "--replies", "@r01", "--out", "@raw", "--n", "4", "--batch", "second")
    assert len(read("raw/accepted")) >= 2 * few and {r["batch"] for r in read("raw/accepted")} > {"second"}
    go("generate", "--chunks", "@chunks", "--prompt", "@gen.md", "--client", "model", "--model", "m", "--replies", "@r00", "--out", "@raw2", "--n", "3", "--track", "kg_poc", "--mix", "multi_hop:unknown_term=2")
    assert not spark.read.text(at("raw2/accepted")).count()  # one chunk has no partner
    go("filter", "--in", "@qa.jsonl", "--chunks", "@chunks", "--prompts", "@prompts.md", "--client", "model", "--model", "m", "--replies", "@r1", "--out", "@filtered")
    kept, dropped = read("filtered/kept"), read("filtered/dropped")
    assert [r["qa_id"] for r in kept] == ["q0"] and dropped[0]["reasons"] == ["rationale_grounded"] and kept[0]["filter_scores"]["answerability"] == 5
    go("gate", "--in", "@filtered/kept", "--out", "@gated", "--reject-too-easy")
    assert [r["qa_id"] for r in read("gated/kept")] == ["q0"]
    go("probe", "--in", "@qa.jsonl", "--prompts", "@prompts.md", "--client", "model", "--models", "a", "b", "--replies", "@r2", "--out", "@probed")
    assert {r["llm_knowledge"] for r in read("probed")} == {"known"}
    chunks = spark.read.json(at("chunks"))
    chunks.selectExpr("chunk_id", "array(1D, 0D) as vec").write.parquet(at("vectors"))
    go("verify", "--in", "@qa.jsonl", "--chunks", "@chunks", "--vectors", "@vectors", "--prompts", "@prompts.md", "--client", "model", "--embed", "embed", "--models", "a", "b", "--replies", "@r3", "--out", "@verified")
    got = {r["qa_id"]: r["rag_verification"] for r in read("verified")}
    go("verify", "--in", "@qa.jsonl", "--chunks", "@chunks", "--vectors", "@vectors", "--prompts", "@prompts.md", "--client", "model", "--embed", "embed", "--models", "a", "b", "--replies", "@r4", "--out", "@verified")
    assert len(read("verified")) == 2
    assert got["q0"]["retrieval_hit_chunk"] and got["q0"]["answer_match"] == "no_match" and got["q0"]["judge_raw"] == "known"
    go("stats", "--in", "@qa.jsonl", "--out", "@stats")
    assert len(read("stats/cells")) == 15
    assert {r["batch"] for r in read("raw/accepted")}
    with pytest.raises(ValueError, match="holds the input"):
        go("gate", "--in", "@filtered/kept", "--out", "@filtered")
    go("chunk", "--docs", "@docs", "--out", "@chunks2", "--patterns", "@patterns")
    assert "No.12" in read("chunks2")[0]["references"]
    with pytest.raises(SystemExit):
        go("gate", "--in", "x", "--out", "y", "--rag-fail", "--rag-hit")


def test_requests(spark):
    rows = requests.requests(spark, 30).collect()
    assert len({r["aspect"] for r in rows[:25]}) == 25 and len(rows) == 30
    got = requests.kg_requests(spark, [("single_fact", "unknown_term"), ("aggregation", "unknown_term"), ("aggregation", "unknown_relation")]).collect()
    assert [r["aspect"] for r in got] == ["quantitative_calc", "multi_source_integration", "reference_follow"]
