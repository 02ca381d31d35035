from __future__ import annotations

import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sieveworks.operators import similarity
from sieveworks.plans import catalog

SCHEMA = "id long, vec array<double>, label long"


def rows_of(n, width=5, seed=1):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-2, 3, (n, width)).astype(float)  # few values: many ties
    vectors[:, 0] += 5
    return [(i, v.tolist(), i % 4) for i, v in enumerate(vectors)]


def brute(corpus, queries, k, least=None, same=False):
    out = []
    unit = lambda v: np.array(v) / (np.linalg.norm(v) or 1)
    for q, v, label in queries:
        sims = [(-round(float(unit(v) @ unit(w)), 9), i) for i, w, other in corpus if w and i != q and not (same and other == label)]
        out += [(q, i, rank) for rank, (s, i) in enumerate(sorted(x for x in sims if least is None or -x[0] >= least)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [1000, 40, 7])
@pytest.mark.parametrize("k,least,same", [(1, None, False), (3, 0.9, True), (500, None, False)])
def test_groups_give_what_a_broadcast_gives(spark, block, k, least, same):
    rows = rows_of(90) + [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 5, 2)]
    corpus, queries = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows[:60], SCHEMA)
    got = similarity.nearest(corpus, queries, k, least=least, same=same, block=block)
    assert sorted((r["query"], r["id"], r["rank"]) for r in got.collect()) == brute(rows, rows[:60], k, least, same)


@pytest.mark.parametrize("block", [None, 8])
def test_uniqueness(spark, block):
    rows = [(i, v, 0) for i, v, _ in rows_of(50, 8)] + [(50, rows_of(50, 8)[0][1], 0)]
    got = {r["id"]: r["uniqueness"] for r in similarity.uniqueness(spark.createDataFrame(rows, SCHEMA), block).collect()}
    v = np.array([r[1] for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    sims = v @ v.T
    np.fill_diagonal(sims, 0)
    assert len(got) == 51 and all(abs(got[i] - (1 - max(sims[i].max(), 0))) < 1e-12 for i in got) and got[50] < 1e-12
    assert similarity.uniqueness(spark.createDataFrame(rows[:1], SCHEMA), block).first()["uniqueness"] is None


@pytest.mark.parametrize("block", [100, 2])
def test_wrong_vectors_are_errors(spark, block):
    rows = rows_of(9)
    corpus = spark.createDataFrame(rows, SCHEMA)
    for bad in ((99, [0.0] * 5, 0), (99, [1.0], 0)):
        with pytest.raises(Exception, match="zero vector|differ in width"):
            similarity.nearest(corpus, spark.createDataFrame([*rows[:5], bad], SCHEMA), 2, block=block).collect()
    assert similarity.nearest(corpus, corpus.limit(0), 2, block=block).count() == 0 and similarity.nearest(corpus, corpus, 0).count() == 0
    assert similarity.nearest(corpus.limit(0), corpus, 2, block=block).count() == 0


def test_few_similarities_are_held_at_once():
    """A task's memory does not grow with the product of its two sides, and copies of one vector leave k rows a query."""
    n, m = 3_000, 12_000
    rng = np.random.default_rng(3)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    corpus = unit(np.concatenate([rng.normal(size=(m // 2, 8)), np.ones((m // 2, 8))]))
    tracemalloc.start()
    got = pd.concat(similarity._found((np.arange(n) + m, unit(np.ones((n, 8))), np.zeros(n, int)), (np.arange(m), corpus, np.ones(m, int)), 5, None, True))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6 < n * m * 8
    first = m // 2
    assert len(got) == 5 * n and set(got["id"]) == set(range(first, first + 5))


def test_every_vector_has_its_neighbour_of_another_label(spark, tmp_path):
    rows = rows_of(70)
    table = spark.createDataFrame([*rows, (70, rows[0][1], None), (71, None, 1)], "vec_id long, embedding array<double>, label long").select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"), F.col("label").cast("int").alias("label"))
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    got = catalog.neighbour_pairs_distinct(spark, str(tmp_path)).collect()
    assert sorted((r["query"], r["id"], 1) for r in got) == brute(rows, rows, 1, 0.1, True) and len(got) == 70


def test_what_is_known_of_other_parts_changes_no_result(monkeypatch):
    """Parts of all sizes, ties with the k-th and queries that find fewer than k."""
    rows = rows_of(60, 3, 4) + [(90 + i, [-9.0, 0, 0], 5) for i in range(3)]
    unit = np.array([v for _, v, _ in rows]) / np.linalg.norm([v for _, v, _ in rows], axis=1, keepdims=True)
    arrays = np.array([r[0] for r in rows]), unit, np.array([r[2] for r in rows])
    for step in (1, 4, 17, 100):
        monkeypatch.setattr(similarity, "STEP", step)
        monkeypatch.setattr(similarity, "ASKED", 7)
        for k, least, same in ((1, None, True), (1, 0.1, True), (4, 0.5, False), (40, None, True)):
            found = pd.concat(similarity._found(arrays, arrays, k, least, same))
            place = found.groupby("query").cumcount() + 1
            assert sorted(zip(found["query"], found["id"], place, strict=True)) == brute(rows, rows, k, least, same)
