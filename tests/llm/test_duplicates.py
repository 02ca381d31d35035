from __future__ import annotations

import numpy as np
import pytest

from sieveworks.llm import neardup, passages
from sieveworks.llm.textvec import single_spaced


def words(rng, n):
    return ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n)]


def edited(rng, text, k):
    out = list(text)
    for i in rng.choice(len(out), k, replace=False):
        out[i] = "zz" + str(rng.integers(10**6))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    base = words(rng, 120)
    out = [" ".join(base), " ".join(base).upper(), "  ".join(base)]
    out += [" ".join(edited(rng, base, k)) for k in (1, 1, 1, 1, 2, 2, 2, 9, 30)]
    chain = words(rng, 400)
    out += [" ".join(chain[i : i + 300]) for i in (0, 12, 24, 36, 48)]
    out += [" ".join(words(rng, 80)) for _ in range(12)]
    out += ["", None, "   ", "one two", "one two", "One  Two", "three", "x " * 3000, "x " * 2990]
    return list(enumerate(out))


def groups(rows, idf):
    """Groups by comparing all pairs."""
    texts = {i: single_spaced(t) for i, t in rows}
    sets = {i: neardup.shingle_sets([t]) for i, t in texts.items()}
    top = {i: i for i, _ in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and texts[a] and texts[b]:
                (ka, ta, _), (kb, tb, _) = sets[a], sets[b]
                wa, wb = dict(zip(ka.tolist(), ta * idf(ka), strict=True)), dict(zip(kb.tolist(), tb * idf(kb), strict=True))
                common = sum(min(wa[k], wb[k]) for k in wa.keys() & wb.keys())
                if common >= neardup.SIMILARITY * (sum(wa.values()) + sum(wb.values()) - common):
                    x, y = find(a), find(b)
                    top[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


@pytest.mark.parametrize("small", [neardup.SMALL_SHINGLES, 1])
def test_near_duplicates(spark, rows, small, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL_SHINGLES", small)
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, key int")
    got = {r["doc_id"]: r["group_id"] for r in neardup.near_duplicates(df).collect()}
    assert got == groups(rows, neardup.fit_idf(neardup.documents(df)))
    assert got[1] == got[2] == got[3] == 0 and got[12] == got[16] and got[34] == 32 and got[37] == 36 and got[30] == 30


def test_copies_in_a_large_group_are_found(spark):
    """Copies with one word of 25 edited, in one large group."""
    rng = np.random.default_rng(8)
    base = words(rng, 150)
    rows = [(0, " ".join(base))] + [(i, " ".join(edited(rng, base, 6))) for i in range(1, 40)]
    rows += [(i, " ".join(words(rng, 12))) for i in range(40, 400)]
    rows += [(i, " ".join(base[:30] + words(rng, 60))) for i in range(400, 405)]  # a passage in common is no copy
    got = {r["doc_id"]: r["group_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 0 if i < 40 else i for i, _ in rows}


def test_edits_weigh_more_than_what_a_group_shares():
    def of(first, shared):
        keys = np.arange(first, first + 100).astype(np.uint64)
        w = np.where((keys >= 100 - shared) & (keys < 100), 1.0, 9.0).astype(np.float32)
        return keys, w, float(w.sum())

    for shared, near in ((70, True), (60, False)):
        a, b = of(0, shared), of(100 - shared, shared)
        assert (neardup._alike(a, b) is not None) == near and len(neardup.joined([(1, a), (2, b), (3, a)])) == (2 if near else 1)
    assert neardup._alike(a, (a[0], a[1] * 3, a[2] * 3)) is None  # the same keys, but far more of them


def test_a_bucket_is_joined_as_by_all_pairs():
    rng = np.random.default_rng(4)
    for _ in range(25):
        group = []
        for i in range(int(rng.integers(2, 40))):
            keys = np.sort(rng.choice(60, int(rng.integers(25, 60)), replace=False)).astype(np.uint64)
            w = np.where(keys % 3 == 0, 2.0, 1.0).astype(np.float32)
            group.append((i, (keys, w, float(w.sum()))))
        top = list(range(len(group)))
        for a in range(len(group)):
            for b in range(a):
                if neardup._alike(group[a][1], group[b][1]) is not None and top[a] != top[b]:
                    top = [top[b] if t == top[a] else t for t in top]
        got = list(range(len(group)))
        for a, b, sim in neardup.joined(group):
            assert abs(sim - neardup._alike(group[a][1], group[b][1])) < 1e-9
            got = [got[b] if t == got[a] else t for t in got]
        assert [got.index(t) for t in got] == [top.index(t) for t in top]


def test_keep_one(spark, rows):
    df = spark.createDataFrame([(i, t, 0) for i, t in rows] + [(0, rows[0][1], 0), (0, "another version of it", 0)], "doc_id long, text string, key int")
    kept = sorted(r["doc_id"] for r in neardup.keep_one(df).collect())
    want = groups(rows, neardup.fit_idf(neardup.documents(df)))
    assert kept == sorted(set(want.values())) and neardup.keep_one(df).columns == df.columns
    assert neardup.near_duplicates(df.where("doc_id > 99")).count() == 0


def test_samples_agree_as_often_as_sets_do():
    rng = np.random.default_rng(1)
    keys = rng.integers(1 << 62, size=900).astype(np.uint64)
    a, b = keys[:600], keys[200:800]
    wa, wb = np.full(600, 2.0, np.float32), np.full(600, 2.0, np.float32)
    wb[:100] = 5
    got = neardup.samples(np.concatenate([a, b]), np.concatenate([wa, wb]), np.array([600, 600]), 1500, 1)
    want = (400 * 2) / (1200 + 1500 - 800)
    assert abs((got[0] == got[1]).mean() - want) < 0.05


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 99), (99, 98), (7, 7)] + [(200, i) for i in range(201, 240)]
    got = {r["id"]: r["label"] for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == 98 and got[239] == 200


def matches(docs, size):
    """(doc, start, end, first doc, first start): windows of `size` words that a document of a smaller id has too, with the
    first place that has them; windows in a row that lie alike in both are one match, matches that touch one stretch."""
    first, out = {}, set()
    for doc in sorted(docs):
        w = docs[doc]
        at = {}
        for j in range(len(w) - size + 1):
            d, i = first.setdefault(tuple(w[j : j + size]), (doc, j))
            if d < doc:
                at[j] = (d, i)
        if at and w in [docs[d] for d in docs if d < doc]:
            d = min(d for d in docs if docs[d] == w)
            out.add((doc, 0, len(w), d, 0))
            continue
        for j in at:
            d, i = at[j]
            if at.get(j - 1) != (d, i - 1):
                k = j
                while at.get(k + 1) == (d, i + k + 1 - j):
                    k += 1
                out.add((doc, j, k + size, d, i))
    stretches = []
    for doc, a, b, d, i in sorted(out, key=lambda x: (x[0], x[3], x[1], x[2], x[4])):
        last = stretches[-1] if stretches else (None,) * 5
        if last[0] == doc and last[3] == d and a <= last[2]:
            stretches[-1] = (doc, last[1], max(b, last[2]), d, last[4])
        else:
            stretches.append((doc, a, b, d, i))
    return set(stretches)


def covered(docs, found):
    out = {i: np.zeros(len(w), bool) for i, w in docs.items()}
    for doc, a, b, *_ in found:
        out[doc][a:b] = True
    return out


def as_set(found):
    return {(r["doc_id"], r["start"], r["end"], r["first_doc_id"], r["first_start"]) for r in found}


def test_passages(spark):
    rng = np.random.default_rng(9)
    passage, long = words(rng, 55), words(rng, 300)
    docs = {i: words(rng, 120) for i in range(30)}
    for i in range(5, 20):
        at = int(rng.integers(100))
        docs[i][at:at] = passage[: 49 + i % 7]
    for i in (3, 21, 22):
        docs[i] = docs[i][:40] + long + docs[i][40:]
    docs[23] = long[40:200]
    docs[24] = words(rng, 10) + passage[:30] + words(rng, 10)  # shorter than what counts
    docs[25] = ["same"] * 400
    docs[26] = words(rng, 49)
    docs[27], docs[28] = list(docs[26]), list(docs[0])
    rows = [(i, " ".join(w), 1, "x") for i, w in docs.items()] + [(50, None, 1, "x"), (51, "", 1, "x"), (60, " ".join(docs[0]), 1, "x"), (60, " ".join(docs[0]), 1, "x"), (None, " ".join(docs[0]), 1, "x")]
    docs[60] = docs[0]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, of_doc string")
    found = passages.repeats(df).collect()
    want = matches(docs, passages.LEAST)
    assert as_set(found) == want and len(found) == len(want) and len({x[0] for x in want}) > 15
    got = covered(docs, want)
    clean = {r["doc_id"]: r for r in passages.remove(df, passages.repeats(df)).collect()}
    assert clean[5]["text"] == " ".join(w for w, g in zip(docs[5], got[5], strict=True) if not g) and clean[28]["text"] == "" and clean[25]["text"] == " ".join(docs[25])
    left = " ".join(w for w, g in zip(docs[10], got[10], strict=True) if not g)
    assert clean[10]["text"] == left and clean[10]["n_chars"] == len(left) and clean[50]["text"] is None
    assert clean[None]["text"] == " ".join(docs[0]) and clean[1]["n_chars"] == 1 and clean[1]["of_doc"] == "x"
    assert passages.repeats(df.where("doc_id > 99")).count() == 0
    assert passages.remove(df.where("doc_id > 99"), passages.repeats(df.where("doc_id > 99"))).count() == 0


def test_passages_of_many_shapes(spark):
    """Few different words, so that passages overlap, nest and repeat inside documents; and one key over many tasks."""
    rng = np.random.default_rng(17)
    pool = [words(rng, 70) for _ in range(6)]
    docs = {}
    for i in range(120):
        out = []
        for _ in range(int(rng.integers(0, 5))):
            p = pool[int(rng.integers(len(pool)))]
            a = int(rng.integers(0, 30))
            out += p[a : a + int(rng.integers(20, 70))] + words(rng, int(rng.integers(0, 4)))
        docs[i * 3] = out
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        df = spark.createDataFrame([(i, "  ".join(w)) for i, w in docs.items()], "doc_id long, text string").repartition(7)
        assert as_set(passages.repeats(df).collect()) == matches(docs, passages.LEAST)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_passages_of_versions(spark):
    rng = np.random.default_rng(3)
    a, b = words(rng, 80), words(rng, 200)
    rows = [(1, " ".join(b)), (2, " ".join(a + b[:60])), (2, " ".join(words(rng, 5) + b[100:170])), (2, " ".join(a))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_set(passages.repeats(df).collect()) == {(2, 80, 140, 1, 0), (2, 5, 75, 1, 100)}
    assert sorted(len(r["text"].split()) for r in passages.remove(df, passages.repeats(df)).collect()) == [5, 80, 80, 200]


def test_every_window_keeps_a_suffix_by_its_content():
    rng = np.random.default_rng(2)
    w = rng.integers(1 << 62, size=500).astype(np.uint64)
    at = passages.chosen(w)
    assert len(at) == 451 and all(s <= p < s + passages.SPAN for s, p in enumerate(at.tolist()))
    shifted = np.concatenate([w[:3], w])
    assert (passages.chosen(shifted)[3:] == at + 3).all()
    assert (passages.heads_of(shifted, at + 3) == passages.heads_of(w, at)).all()
    assert not len(passages.chosen(w[:49])) and len(passages.chosen(w[:50])) == 1


def test_suffixes_are_sorted_and_compared_word_by_word():
    """Against suffixes as lists of words, of two alike documents, so that neighbours share 0 to HEAD words."""
    rng = np.random.default_rng(6)
    alphabet = np.unique(rng.integers(1 << 62, size=400).astype(np.uint64) << np.uint64(1) >> np.uint64(56)) << np.uint64(56)
    base = rng.choice(alphabet[:5], 300)
    near = base.copy()
    near[[40, 44, 90, 150, 152, 230]] = alphabet[7]
    words = np.concatenate([base, near])
    at = np.concatenate([np.arange(300 - passages.HEAD + 1), 300 + np.arange(300 - passages.HEAD + 1)])
    heads = passages.heads_of(words, at)
    said = [tuple((words[a : a + passages.HEAD] >> np.uint64(56)).tolist()) for a in at.tolist()]
    order = np.lexsort(heads.T[::-1])
    prefix = lambda x, y: next((i for i, (a, b) in enumerate(zip(x, y, strict=True)) if a != b), passages.HEAD)
    got = passages.shared_words(heads[order[:-1]], heads[order[1:]]).tolist()
    assert got == [prefix(said[a], said[b]) for a, b in zip(order[:-1], order[1:], strict=True)]
    assert len(set(got)) > 10 and got.count(passages.HEAD) == len(at) - len(set(said))
    assert passages.heads_of(words[:5], np.zeros(0, np.int64)).shape == (0, len(passages.HEADS))


@pytest.mark.parametrize("tasks", [1, 5])
def test_a_key_that_two_windows_share_hides_no_holder(spark, tasks):
    """The first hash is the same for all windows: the second one alone tells them apart, over one task or many."""
    rows = [(7, k, doc, spot) for k in range(4) for doc in range(k, 40, 3) for spot in (k, k + 100)]
    df = spark.createDataFrame(rows, "key long, key2 long, doc_id long, spot long")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    try:
        got = {tuple(r) for r in passages._matched(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == {(doc, spot, k, k) for _, k, doc, spot in rows if doc > k}


def test_frequencies_of_all_shingles_are_exact(spark, rows, monkeypatch):
    monkeypatch.setattr(neardup, "CHUNK_CHARS", 3000)
    monkeypatch.setattr(neardup, "RANGE_SHINGLES", 700)
    df = neardup.documents(spark.createDataFrame(rows + [(99, rows[3][1])], "doc_id long, text string"))
    texts = {i: single_spaced(t).split() for i, t in rows + [(99, rows[3][1])]}
    grams = {i: {tuple(w[j : j + neardup.WORDS]) for j in range(max(1, len(w) - neardup.WORDS + 1))} if w else set() for i, w in texts.items()}
    count = {}
    for x in grams.values():
        for g in x:
            count[g] = count.get(g, 0) + 1
    marks, n = neardup.signatures(df)
    got = {r["doc_id"]: sorted(neardup._unpack_frequencies(r["seen"], r["shingles"]).tolist()) for r in marks.collect()}
    assert n == len(texts) and got == {i: sorted(count[g] for g in x) for i, x in grams.items()}
    table = neardup.fit_idf(df)
    for i, t in rows:
        want = sorted(np.log((1 + n) / count[g]) + 1 for g in grams[i])
        assert np.allclose(sorted(table(neardup.shingle_sets([single_spaced(t)])[0])), want)


def test_documents_of_very_many_shingles(spark):
    long = [f"w{i}" for i in range(400_000)]
    near = long[:200_000] + ["another"] + long[200_001:]
    df = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(near)), (3, " ".join(long[::-1]))], "doc_id long, text string")
    assert {r["doc_id"]: r["group_id"] for r in neardup.near_duplicates(df).collect()} == {1: 1, 2: 1, 3: 3}


def test_rare_shingles_weigh_what_their_frequency_says(spark):
    """Alike by the true IDF (0.86), not where rare shingles share the IDF of more frequent ones (0.78)."""
    run = lambda name, n: [f"{name}{i}" for i in range(n)]
    rows = [(i, " ".join(run(f"own{i}x", 40_000) + run("left", 64) + run("right", 64))) for i in range(18)]
    rows += [(50, " ".join(run("rare", 304) + run("left", 64))), (51, " ".join(run("rare", 304) + run("right", 64)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["group_id"] for r in neardup.near_duplicates(df).collect()}
    assert got == {i: i for i in range(18)} | {50: 50, 51: 50}
