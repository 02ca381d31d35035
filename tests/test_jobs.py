from __future__ import annotations

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sieveworks import schemas
from sieveworks.operators import asking
from sieveworks.plans import jobs, requests
from sieveworks.sources import files
from sieveworks.operators import sampling
from sieveworks.streaming.verification import unverified, verify_new, verify_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors can't import this file


def item(qa_id="q1", **more):
    flags = {"reasoning_complexity": {"multi_step": True}, "retrieval_difficulty": {}, "source_structure": {}, "explainability": {"evidence_strictness": "multi-ref"}}
    base = dict(qa_id=qa_id, question=f"what {qa_id}", answer="24 V", rationale=[{"doc_id": "a", "page": None, "text": "rated 24 V"}], category=["Reasoning"], aspect=["causal"], retrieval_level="Easy", answer_level="Hard")
    return base | flags | more


def write(path, *rows):
    path.mkdir(parents=True, exist_ok=True)
    (path / "part.jsonl").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in rows))
    return str(path)


@pytest.fixture(scope="module")
def chunks(spark):
    return spark.createDataFrame([("a__c0000", "a", None, "it is rated 24 V here", 0, [], []), ("b__c0000", "b", None, "other", 0, [], [])], schemas.CHUNK)


def test_files_and_chunks(spark, tmp_path):
    docs = tmp_path / "docs"
    (docs / "sub").mkdir(parents=True)
    (docs / "a.txt").write_text("plain text ISO 9001")
    (docs / "sub" / "b.md").write_text("# T\nbody")
    (docs / "c.pdf.di.md").write_text("cached")
    got = {r["doc_id"]: r["n"] for r in jobs.chunk(spark, str(docs), str(tmp_path / "out")).collect()}
    assert got == {"a": 1, "b": 1}
    (docs / "sub" / "a.md").write_text("again")
    with pytest.raises(ValueError):
        files.documents(spark, str(docs))


def test_lenient_reads_count_what_they_skip(spark, tmp_path):
    place = write(tmp_path / "qa", item(), item("q2", aspect=["nonsense"]), "{not json", item("q3", kg_query_type="multi_hop", kg_novelty="unknown_term", aspect=[]))
    good, skipped = files.qa_lenient(spark, place)
    assert {r["qa_id"] for r in good.collect()} == {"q1", "q3"} and skipped.first()["skipped"] == 2
    assert [r["qa_id"] for r in files.qa_lenient(spark, place, "kg_poc")[0].collect()] == ["q3"]
    with pytest.raises(Exception):
        files.qa(spark, place).collect()


def client(prompt, model):
    if prompt.startswith("A"):
        return '{"answerability": 5}'
    if prompt.startswith("L"):
        return 'so: {"leakage": "pass"}'
    if prompt.startswith("G"):
        return '{"grounding": "no number"}'
    return '```json\n{"answer_level": "Easy"}\n```'


def test_judging_and_gate(spark, tmp_path, chunks):
    qa = files.qa(spark, write(tmp_path / "qa", item(), item("q2", rationale=[{"doc_id": "a", "page": None, "text": "invented"}])))
    prompts = {"ANSWERABILITY": "A", "LEAKAGE": "L", "GROUNDING": "G", "DIFFICULTY_MATCH": "D"}
    rows = jobs.judged(qa, chunks, client, "m", prompts, str(tmp_path / "replies"), embed=lambda texts: [[1.0, float(len(t))] for t in texts])
    got = {r["qa_id"]: r for r in rows.collect()}
    assert got["q1"]["answerability"] == 5 and got["q1"]["leakage"] == "pass" and got["q1"]["grounding"] is None
    assert got["q1"]["difficulty_match"] == "too_easy" and got["q1"]["declared_level"] == "Hard" and got["q1"]["answer_level"] == "Easy"
    assert got["q1"]["rationale_grounded"] == 1 and got["q2"]["rationale_grounded"] == 0 and got["q1"]["uniqueness"] < 0.08
    kept, dropped = jobs.gate(rows.withColumn("uniqueness", F.lit(None).cast("double")), rag_hit=True)
    assert [r["qa_id"] for r in kept.collect()] == ["q1"] and dropped.first()["reasons"] == ["rationale_grounded"]


def answer(prompt, model):
    if prompt.startswith("RAG"):
        return '{"answer": "24 V"}' if "q1" in prompt else '{"answer": "不明"}' if "q2" in prompt else (_ for _ in ()).throw(RuntimeError("down"))
    return '{"match": "Match"}'


def test_verify(spark, tmp_path, chunks, monkeypatch):
    monkeypatch.setattr(asking, "retried", lambda call, attempts: call())
    qa = files.qa(spark, write(tmp_path / "qa", item("q1"), item("q2"), item("q3")))
    vectors = spark.createDataFrame([("a__c0000", [1.0, 0.0]), ("b__c0000", [0.0, 1.0])], "chunk_id string, vec array<double>")
    found = jobs.retrieve(qa, chunks, vectors, lambda texts: [[1.0, 0.1]] * len(texts), 1)
    prompts = {"RAG_ANSWER": "RAG {question}\n{chunks_block}", "JUDGE": "{ground_truth} {candidate}"}
    got = {r["qa_id"]: r["rag_verification"] for r in jobs.verify(qa, found, lambda p, m: answer(p, m), ("m", "j"), prompts, str(tmp_path / "r"), 1).collect()}
    assert (got["q1"]["answer_match"], got["q1"]["judge_raw"], got["q1"]["retrieval_hit_chunk"]) == ("match", "match", True)
    assert (got["q2"]["answer_match"], got["q2"]["judge_raw"]) == ("no_match", None)
    assert got["q1"]["retrieved_chunk_ids"] == ["a__c0000"]
    with pytest.raises(ValueError):
        jobs.retrieve(qa, chunks, vectors.limit(1), lambda texts: [], 1)


def test_probe(spark, tmp_path):
    qa = files.qa(spark, write(tmp_path / "qa", item("q1"), item("q2")))
    say = lambda p, m: ('{"answer": "x"}' if "q1" in p else '{"answer": ""}') if p.startswith("P") else '{"match": "known"}'
    got = jobs.probe(qa, say, ("m", "j"), {"PROBE": "P {question}", "JUDGE": "J {candidate}"}, str(tmp_path / "r"))
    assert {r["qa_id"]: r["llm_knowledge"] for r in got.collect()} == {"q1": "known", "q2": "unknown"}


def test_generate(spark, tmp_path):
    anchors = "array<struct<chunk_id:string,doc_id:string,page:int,section_path:array<string>,text:string,position:int>>"
    rows = spark.createDataFrame([(i, "causal", [("a__c0000", "a", 1, ["x"], "定格 24 V", 0)]) for i in range(3)], f"request_id int, key string, anchors {anchors}")
    good = '{"question": "q", "answer": "24 V", "rationale": [{"doc_id": "a", "page": 1, "text": "24 V"}], "aspect": ["causal"], "answer_level": "Easy"}'
    say = lambda p, m: good if "key0" in p else good.replace("24 V", "コンデンサー") if "key1" in p else "sorry"
    rows = rows.withColumn("key", F.concat(F.lit("key"), "request_id"))
    ok, bad = jobs.generate(rows, say, "m", "{key} {chunks_block}", str(tmp_path / "r"))
    row = ok.first()
    assert row["request_id"] == 0 and row["qa_id"].startswith("auto_") and row["retrieval_level"] == "Easy"
    assert {r["request_id"]: r["reason"] for r in bad.collect()} == {1: "terms that the anchors lack", 2: "no item in the reply"}


def test_generated_items_carry_cell_flags_and_origin(spark, tmp_path):
    anchors = "array<struct<chunk_id:string,doc_id:string,page:int,section_path:array<string>,text:string,position:int>>"
    pair = [("a__c0000", "a", None, ["x"], "定格 24 V", 0), ("a__c0012", "a", 2, [], "y" * 1300, 12)]
    rows = spark.createDataFrame([(1, "multi_hop", pair, "causal", "multi_hop", "unknown_term")], f"request_id int, key string, anchors {anchors}, aspect string, kg_query_type string, kg_novelty string")
    template = "{{{key}}} {doc_id} {page} {chunk_id} {aspect_json} {category_json} {kg_query_type}/{kg_novelty} {few_shot} {other} {{x}}"
    seen = tmp_path / "calls"
    seen.mkdir()
    reply = {"question": "q", "answer": "24 V", "rationale": [], "aspect": ["causal"], "kg_query_type": "single_fact", "reasoning_complexity": {"multi_step": True}, "answer_level": "Easy"}
    say = counting(str(seen))
    ok, bad = jobs.generate(rows, lambda p, m: (say(p, m), json.dumps(reply))[1], "m", template, str(tmp_path / "r"), "v3", '["seed"]')
    row = ok.first()
    assert said(seen) == ['m {multi_hop} a null a__c0000 ["causal"] ["Reasoning"] multi_hop/unknown_term ["seed"] {other} {x}']
    assert (row["kg_query_type"], row["kg_novelty"], row["retrieval_level"], row["review_status"]) == ("multi_hop", "unknown_term", "Hard", "pending")
    assert row["generation"]["model"] == "m" and row["generation"]["prompt_version"] == "v3" and row["generation"]["generated_at"]
    flags = row["retrieval_difficulty"].asDict()
    assert {f for f in flags if flags[f]} == {"multi_chunk", "low_locality", "remote_reference", "chunk_size_large"} and len(flags) == 8
    assert row["reasoning_complexity"]["multi_step"] and not row["source_structure"]["redundancy"] and bad.count() == 0
    odd = dict(reply, category=["Nonsense"])
    ok, bad = jobs.generate(rows, lambda p, m: json.dumps(odd), "m", template, str(tmp_path / "r2"))
    assert ok.count() == 0 and bad.first()["reason"] == "outside the domain"


def test_review_and_reports(spark, tmp_path):
    qa = files.qa(spark, write(tmp_path / "qa", item("q1"), item("q2")))
    log = spark.createDataFrame([("q1", "edited", "r", "new?", None, 1), ("q1", "accepted", "r", None, None, 2), ("q2", "edited", "r", "new?", None, 1)], "qa_id string, status string, reviewer string, question string, answer string, t int")
    log = log.withColumn("reviewed_at", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,t)"))
    got = {r["qa_id"]: (r["review_status"], r["question"]) for r in jobs.reviewed(qa, log).collect()}
    assert got == {"q1": ("accepted", "what q1"), "q2": ("edited", "new?")}
    reports = jobs.stats(qa)
    assert {n: d.count() for n, d in reports.items()}["cells"] == 15 and reports["aspects"].where("n > 0").count() == 1
    assert schemas.tags(qa).first()["tags"] == "multi_step, multi-ref"


def test_stream_writes_each_item_once(spark, tmp_path):
    write(tmp_path / "in", item("q1"), item("q2"))
    go = lambda: verify_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), lambda df: df.select("qa_id", "question"))
    go().awaitTermination()
    (tmp_path / "in" / "late.jsonl").write_text(json.dumps(item("q3")))
    go().awaitTermination()
    done = spark.read.json(str(tmp_path / "out"))
    assert sorted(r["qa_id"] for r in done.collect()) == ["q1", "q2", "q3"]
    assert unverified(files.qa(spark, str(tmp_path / "in")), done).count() == 0


def test_mix_and_cells():
    mix = requests.parse_mix("multi_hop:unknown_term=3, aggregation:unknown_relation=2")
    assert sorted(requests.cells(5, mix)) == sorted([("multi_hop", "unknown_term")] * 3 + [("aggregation", "unknown_relation")] * 2)
    assert len(set(requests.cells(15))) == 15 and len(requests.cells(7, mix)) == 7 and len(requests.cells(2, mix)) == 2
    for bad in ("", "x", "multi_hop:unknown_term", "multi_hop:unknown_term=0", "multi_hop:odd=1", "multi_hop:unknown_term=a"):
        with pytest.raises(ValueError):
            requests.parse_mix(bad)


def test_prompt_files_and_patterns():
    meta, body = asking.front_matter("---\nversion: v1:2\n---\n# t\n## [A]\none\n---\n## [B]\ntwo {x}\n")
    assert meta == {"version": "v1:2"} and asking.sections(body) == {"A": "one", "B": "two {x}"}
    entries = [{"regex": r"No\.\d+"}, {"regex": "["}, {"regex": "zzz"}, {"regex": "."}]
    assert jobs.accepted_patterns(entries, "see No.12 " + "x" * 600) == [{"regex": r"No\.\d+"}]


def test_retries():
    calls = []

    def fail():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError
        return "ok"

    assert asking.retried(fail, sleep=lambda s: None) == "ok"
    with pytest.raises(RuntimeError):
        asking.retried(lambda: (_ for _ in ()).throw(RuntimeError()), 2, sleep=lambda s: None)


def counting(calls, reply="yes", dies_at=None):
    """A client that leaves a file for each call; one that dies takes its task with it."""

    def say(prompt, model):
        import os
        import uuid

        if dies_at is not None and prompt == dies_at:
            raise SystemExit
        with open(os.path.join(calls, uuid.uuid4().hex), "w") as f:
            f.write(f"{model} {prompt}")
        if reply is None:
            raise RuntimeError("down")
        return f"{reply} {prompt}"

    return say


def said(calls):
    return sorted(p.read_text() for p in calls.iterdir())


def test_replies_are_kept_by_model_and_prompt(spark, tmp_path):
    calls, store = tmp_path / "calls", str(tmp_path / "store")
    calls.mkdir()
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "")], "id int, p string")
    ask = lambda rows, client, model="m", **more: {r["id"]: r["r"] for r in asking.answered(rows, client, model, "p", "r", store, 1, **more).collect()}
    assert ask(rows, counting(str(calls), None)) == dict.fromkeys(range(1, 6))  # failures are not kept
    assert len(said(calls)) == 3
    want = {1: "yes a", 2: "yes b", 3: "yes a", 4: None, 5: "yes "}
    assert ask(rows, counting(str(calls))) == want and len(said(calls)) == 6
    assert ask(rows, counting(str(calls), "no")) == want and len(said(calls)) == 6
    more = rows.union(spark.createDataFrame([(6, "c")], "id int, p string"))
    assert ask(more, counting(str(calls), "no")) == want | {6: "no c"} and len(said(calls)) == 7
    assert ask(rows, counting(str(calls), "other"), "n")[1] == "other a" and len(said(calls)) == 10
    assert ask(rows.limit(0), counting(str(calls))) == {}


def test_a_job_that_dies_keeps_the_replies_of_its_batches(spark, tmp_path):
    calls, store = tmp_path / "calls", str(tmp_path / "store")
    calls.mkdir()
    rows = spark.createDataFrame([(i, f"p{i}") for i in range(12)], "id int, p string")
    with pytest.raises(Exception):
        asking.answered(rows, counting(str(calls), dies_at="p7"), "m", "p", "r", store, 1, batch=1)
    folders = [str(p) for p in (tmp_path / "store").iterdir() if p.name[0] not in "_."]
    before = {x["prompt"] for x in spark.read.parquet(*folders).collect()} if folders else set()
    for p in calls.iterdir():
        p.unlink()
    got = asking.answered(rows, counting(str(calls)), "m", "p", "r", store, 1, batch=1).collect()
    assert {r["id"]: r["r"] for r in got} == {i: f"yes p{i}" for i in range(12)}
    assert set(said(calls)) == {f"m p{i}" for i in range(12)} - {f"m {x}" for x in before}


def test_replies_are_read_for_the_asked_prompts_only(spark, tmp_path):
    calls, store = tmp_path / "calls", str(tmp_path / "store")
    calls.mkdir()
    rows = lambda *prompts: spark.createDataFrame([(p,) for p in prompts], "p string")
    ask = lambda rows, **more: asking.answered(rows, counting(str(calls)), "m", "p", "r", store, 1, **more)
    names = [f"p{i}" for i in range(250)]
    assert ask(rows(*names), batch=100).count() == 250
    folders = lambda: {p.name for p in (tmp_path / "store").iterdir() if p.name[0] not in "_."}
    old = folders()
    assert len(old) >= 3 and len(said(calls)) == 250
    got = ask(rows("p3", "new", "p3", "p4"))
    assert sorted((r["p"], r["r"]) for r in got.collect()) == [("new", "yes new"), ("p3", "yes p3"), ("p3", "yes p3"), ("p4", "yes p4")]
    assert not any(f"/{name}/" in f for f in got.inputFiles() for name in old) and len(folders() - old) == 1
    assert len(said(calls)) == 251
    spark.createDataFrame([(r["d"], "m", "p5", "a") for r in rows("p5").select(asking.digest("m", F.col("p")).alias("d")).collect()], asking.REPLIES).write.parquet(f"{store}/other")
    assert [r["r"] for r in ask(rows("p5", "p5")).collect()] == ["a", "a"]  # the least of two
    assert asking.shares([("a", 2), ("b", 2), ("c", 1), ("d", 9), ("e", 1)], 4) == [["a", "b"], ["c"], ["d"], ["e"]] and asking.shares([], 4) == []


def test_micro_batches_stay_few(spark, tmp_path):
    """However many files land, a run takes them in 16 micro-batches at most, and all items are there once."""
    qa, out = files.qa(spark, write(tmp_path / "qa", *[item(f"q{i}") for i in range(50)])), str(tmp_path / "out")
    batches = lambda: len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("batch=")])
    assert verify_new(qa.where("qa_id < 'q3'"), out, lambda df: df, batch=1) == 23 and 1 < batches() <= 16
    first = batches()
    assert verify_new(qa, out, lambda df: df, batch=1) == 27 and first < batches() <= first + 16
    assert sorted(r["qa_id"] for r in spark.read.json(out).collect()) == sorted(f"q{i}" for i in range(50))
    assert verify_new(qa, out, lambda df: df, batch=1) == 0


def test_other_thresholds_ask_nothing(spark, tmp_path, chunks):
    calls = tmp_path / "calls"
    calls.mkdir()
    qa = files.qa(spark, write(tmp_path / "qa", item(), item("q2")))
    prompts = {"ANSWERABILITY": "A", "LEAKAGE": "L"}
    go = lambda qa: jobs.judged(qa, chunks, counting(str(calls)), "m", prompts, str(tmp_path / "replies")).count()
    assert go(qa) == 2 and len(said(calls)) == 4
    assert go(qa) == 2 and len(said(calls)) == 4
    assert go(qa.union(files.qa(spark, write(tmp_path / "more", item("q3"))))) == 3 and len(said(calls)) == 6


def test_verification_survives_a_crash(spark, tmp_path, chunks):
    """A client dies at one of ten items: what was done before stays, and the next run asks for the rest only."""
    calls = tmp_path / "calls"
    calls.mkdir()
    place, out = write(tmp_path / "qa", *[item(f"q{i}") for i in range(10)]), str(tmp_path / "out")
    retrieved = spark.createDataFrame([(f"q{i}", 1, "a__c0000", "a", None, [], "it is rated 24 V here") for i in range(12)], "qa_id string, rank int, chunk_id string, doc_id string, page int, section_path array<string>, text string")
    prompts = {"RAG_ANSWER": "{question}", "JUDGE": "{candidate}"}

    def verify(client):
        def run(batch):
            found = retrieved.join(batch.select("qa_id"), "qa_id")
            return batch.drop("rag_verification").join(jobs.verify(batch, found, client, ("m", "j"), prompts, str(tmp_path / "replies")), "qa_id")

        return run

    with pytest.raises(Exception):
        verify_new(files.qa(spark, place), out, verify(counting(str(calls), dies_at="what q7")), batch=1)
    done = {r["qa_id"] for r in spark.read.json(out).collect()}
    assert "q7" not in done and len(done) >= 6
    asked = said(calls)
    assert {f"m what {x}" for x in done} <= set(asked)
    n = verify_new(files.qa(spark, place), out, verify(counting(str(calls))), batch=1)
    again = spark.read.json(out).collect()
    assert n == 0 and sorted(r["qa_id"] for r in again) == sorted(f"q{i}" for i in range(10))
    assert len(said(calls)) == len(set(said(calls))) == 10  # nothing was asked twice
    write(tmp_path / "qa2", item("q3"), item("q11"))
    assert verify_new(files.qa(spark, [place, str(tmp_path / "qa2")]), out, verify(counting(str(calls))), batch=4) == 1
    assert len(said(calls)) == 11 and spark.read.json(out).count() == 11


def test_samples_are_the_least_hashes(spark):
    rows = spark.createDataFrame([(i, "a" if i % 3 else "b" if i % 2 else None) for i in range(300)], "id long, lang string")
    got = sampling.bottom_k(rows.repartition(7), "id", 5, ("lang",))
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()  # each task keeps its own least first
    import hashlib

    want = set()
    for lang in ("a", "b", None):
        ids = [r["id"] for r in rows.collect() if r["lang"] == lang]
        best = sorted(ids, key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())[:5]
        want |= {(lang, i, n) for n, i in enumerate(best, 1)}
    assert {(r["lang"], r["id"], r["pick"]) for r in got.collect()} == want
    assert sampling.bottom_k(rows, "id", 3).count() == 3 and sampling.bottom_k(rows.limit(0), "id", 3, ("lang",)).count() == 0
    assert sampling.bottom_k(rows, "id", 1000).count() == 300
