"""Passages that repeat across documents, by a sparse suffix array.

Suffixes are kept at content-selected places only: the minimiser (least hash of K words) of every SPAN places in a row. A
window of LEAST words keeps the suffix at the minimiser of its first SPAN places, so equal windows, wherever they stand,
keep suffixes at the same place within them, with HEAD = LEAST - SPAN + 1 words of the window to the right.

1. The kept suffixes are sorted over the cluster word by word, a byte of each word's hash standing for the word: as equal
   words have equal bytes, suffixes that share their first HEAD words come together, and no collision can part them. Each
   is compared to its neighbours by the number of words that they share; those that share HEAD words with no other
   document are done with.
2. The others are extended to the left and right to every window of LEAST words that keeps them. These windows are sorted
   by two hashes of 64 bits, and each is compared to its neighbours: it matches the first of the equal ones, which is that
   of the least doc_id (then place). Matched windows in a row that lie alike in both documents are one match, and matches of
   one document that overlap or touch are one stretch.
3. The words of every match are compared in full. Keys only propose; no match rests on a hash alone, and only windows that
   agree in both hashes could hide each other's holder.

So a document's matches are exactly its windows of LEAST words that a document of a smaller doc_id has too, with their exact
ends, and each match names the first holder. Sorting is by range of (key, doc_id, place), so a passage in a third of all
documents spans many tasks; what a range's first key owes to the range before is one row for each range. What is joined to
texts grows with them and is never broadcast.

Documents whose whole text another document of a smaller doc_id has too need no suffixes: the text is one match.

Words are the white-space separated parts of the whole text; case and marks count. The passage stays in the document with
the least doc_id and is reported for the others; a passage that repeats inside one document only is left alone. Rows with
a null doc_id have no place in the order: they neither hold nor get a match. Null and short texts have no passage.
Repeated rows count once; rows that share a doc_id but not a text are versions of one document, told apart by `version`
(a hash of the text) and not matched with each other. Extra columns are kept by `remove`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import by_chars, discard, documents, materialise, table, unused
from .textvec import mix64, powers, word_hashes, word_shingles

LEAST, K, SPAN = 50, 8, 22
HEAD = LEAST - SPAN + 1
#: The first HEAD words of a suffix as bytes, eight in each of these numbers (the last is filled up with zeros).
HEADS = [f"head{i}" for i in range(-(-HEAD // 8))]
#: A window's two hashes.
KEYS = ["key", "key2"]
#: A spot is a version in the upper and a word's place in the lower 32 bits.
_PLACE = (1 << 32) - 1
_WORD = re.compile(r"\S+")


def _words(texts: list[str | None]) -> list[np.ndarray]:
    """Word hashes of each text."""
    spaced = [" ".join(x.split()) if x else "" for x in texts]
    words, counts = word_hashes(spaced)
    ends = np.cumsum(counts)
    return [words[e - c : e] for e, c in zip(ends, counts, strict=True)]


def chosen(words: np.ndarray) -> np.ndarray:
    """For each window of LEAST words the place of the suffix that it keeps: the (first) least K-gram of its first SPAN places."""
    if len(words) < LEAST:
        return np.zeros(0, np.int64)
    grams = word_shingles(words, K)[: len(words) - HEAD + 1]
    return np.lib.stride_tricks.sliding_window_view(grams, SPAN).argmin(1) + np.arange(len(words) - LEAST + 1)


def runs_of(words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the `size` words from each place."""
    up, down = powers(len(words) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)], dtype=np.uint64)])
    return mix64((sums[at + size] - sums[at]) * down[at])


def heads_of(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first HEAD words from each place, a byte each, as numbers (places x HEADS) in whose order suffixes are sorted."""
    out = np.zeros((len(at), 8 * len(HEADS)), np.uint8)
    if len(at):
        out[:, :HEAD] = np.lib.stride_tricks.sliding_window_view((words >> np.uint64(56)).astype(np.uint8), HEAD)[at]
    return out.view(">i8").astype(np.int64)


def shared_words(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words (HEAD at most) the suffixes in the rows of a and b have in common from their beginning."""
    differ = np.ascontiguousarray(a ^ b, ">i8").view(np.uint8).reshape(len(a), 8 * len(HEADS)) != 0
    return np.where(differ.any(1), differ.argmax(1), HEAD)


def keys_of(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the window of LEAST words at each place, the second over other hashes of the words."""
    return runs_of(words, at, LEAST).view(np.int64), runs_of(mix64(words ^ np.uint64(0x5851F42D4C957F2D)), at, LEAST).view(np.int64)


def _version(text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit((1 << 31) - 1))


def _ints(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *parts])


def _marks(docs: DataFrame) -> DataFrame:
    """doc_id, version, digest of the words, their number, and the kept suffixes: their first HEAD words, and places."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in by_chars(batches):
            out = []
            for words in _words(pdf["text"].tolist()):
                at = np.unique(chosen(words))
                out.append((xxhash.xxh3_128_digest(words.tobytes()), len(words), at.astype(np.int32), *heads_of(words, at).T.copy()))
            frame = pd.DataFrame(dict(zip(["digest", "words", "places", *HEADS], zip(*out, strict=True), strict=True)))
            yield frame.assign(doc_id=pdf["doc_id"].to_numpy(), version=pdf["version"].to_numpy())[names]

    schema = "doc_id long, version long, digest binary, words int, places array<int>, " + ", ".join(f"{x} array<long>" for x in HEADS)
    names = ["doc_id", "version", "digest", "words", "places", *HEADS]
    return docs.select("doc_id", "text", _version(F.col("text")).alias("version")).mapInPandas(run, schema)


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of suffixes in their order (equal ones by doc_id, spot) those that share HEAD words with one of another document. The
    first and the last suffix of the task may have such neighbours in the tasks next to it: those equal to them are kept. At
    most one document's suffixes that are equal are held back."""
    n = len(HEADS)
    held, first, many_last = None, None, None
    for pdf in batches:
        if not len(pdf):
            continue
        rows = pdf[[*HEADS, "doc_id", "spot"]].to_numpy()
        first = rows[0, :n] if first is None else first
        rows = rows if held is None else np.concatenate([held, rows])
        starts = np.flatnonzero(np.concatenate([[True], shared_words(rows[:-1, :n], rows[1:, :n]) < HEAD]))
        sizes = np.diff(np.append(starts, len(rows)))
        heads = rows[starts, :n]
        many = (rows[starts, n] != rows[starts + sizes - 1, n]) | (heads == first).all(1)
        if many_last is not None:
            many |= (heads == many_last).all(1)
        many_last = heads[-1] if many[-1] else None
        held = None if many[-1] else rows[starts[-1] :]
        good = rows[np.repeat(many, sizes)]
        yield pd.DataFrame({"doc_id": good[:, n], "spot": good[:, n + 1]})
    if held is not None:
        yield pd.DataFrame({"doc_id": held[:, n], "spot": held[:, n + 1]})


def _in_order(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows sorted over the whole cluster by (keys, doc_id, spot), a range in each task."""
    order = (*keys, "doc_id", "spot")
    return rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)


def _windows(texts: DataFrame) -> DataFrame:
    """Both keys, doc_id and spot of every window of LEAST words that keeps one of the suffixes at `places`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in by_chars(batches):
            keys, keys2, ids, spots = [], [], [], []
            for doc, version, words, places in zip(pdf["doc_id"], pdf["version"], _words(pdf["text"].tolist()), pdf["places"], strict=True):
                at = np.flatnonzero(np.isin(chosen(words), np.asarray(places, np.int64)))
                key, key2 = keys_of(words, at)
                keys.append(key)
                keys2.append(key2)
                ids.append(np.full(len(at), doc, np.int64))
                spots.append(at + (int(version) << 32))
            yield pd.DataFrame({"key": _ints(keys), "key2": _ints(keys2), "doc_id": _ints(ids), "spot": _ints(spots)})

    return texts.mapInPandas(run, "key long, key2 long, doc_id long, spot long")


def _first_holders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each row of an order of (keys, doc_id, spot) with the first row of its keys, where that is of another document.

    All rows of the task's first keys are given, with `part`, the task's number: those keys may have begun in an earlier
    task. Two more rows without a doc_id say which are the task's first and last keys (`last`), and their first rows here.
    """
    part = TaskContext.get().partitionId()
    first = now = None
    for pdf in batches:
        if not len(pdf):
            continue
        key, key2, doc, spot = (pdf[c].to_numpy() for c in (*KEYS, "doc_id", "spot"))
        if now is None:
            first = now = (key[0], key2[0], doc[0], spot[0])
        starts = np.concatenate([[True], (key[1:] != key[:-1]) | (key2[1:] != key2[:-1])])
        at = np.maximum.accumulate(np.where(starts, np.arange(len(key)), 0))
        holder, place = doc[at], spot[at]
        own = (key == now[0]) & (key2 == now[1])
        holder[own], place[own] = now[2], now[3]
        now = (key[-1], key2[-1], holder[-1], place[-1])
        early = (key == first[0]) & (key2 == first[1])
        good = early | (holder < doc)
        frame = pd.DataFrame({"doc_id": doc, "spot": spot, "first_doc": holder, "first_spot": place})[good].astype({"doc_id": "Int64"})
        yield frame.assign(part=pd.array(np.where(early[good], part, -1), "Int32"), key=0, key2=0, last=False)
    if now is not None:
        ends = pd.DataFrame([first, now], columns=[*KEYS, "first_doc", "first_spot"]).assign(doc_id=pd.array([None, None], "Int64"), spot=0, part=part, last=[False, True])
        yield ends.astype({"part": "Int32"})[["doc_id", "spot", "first_doc", "first_spot", "part", *KEYS, "last"]]


def _matched(windows: DataFrame) -> DataFrame:
    """doc_id, spot, first_doc, first_spot: windows that a document of a smaller doc_id has too, and the first that has it."""
    schema = "doc_id long, spot long, first_doc long, first_spot long, part int, key long, key2 long, last boolean"
    windows = materialise(windows, "passages-windows")
    found = materialise(_in_order(windows, KEYS).mapInPandas(_first_holders, schema), "passages-holders")
    discard(windows)
    owed, before = [], None
    ends: dict[int, dict] = {}
    for r in found.where("doc_id is null").collect():  # two rows for each task of the sort
        ends.setdefault(r["part"], {})[r["last"]] = r
    for part in sorted(ends):
        first, last = ends[part][False], ends[part][True]
        opens, closes = (first["key"], first["key2"]), (last["key"], last["key2"])
        holder = before[1] if before is not None and before[0] == opens else (first["first_doc"], first["first_spot"])
        owed.append((part, *holder))
        before = (closes, holder if closes == opens else (last["first_doc"], last["first_spot"]))
    owed_df = found.sparkSession.createDataFrame(owed, "part int, doc long, at long")
    rows = found.where("doc_id is not null").join(F.broadcast(owed_df), "part", "left")  # a row for each task of the sort
    out = rows.select("doc_id", "spot", F.coalesce("doc", "first_doc").alias("first_doc"), F.when(F.col("doc").isNull(), F.col("first_spot")).otherwise(F.col("at")).alias("first_spot"))
    out = out.where("first_doc < doc_id")
    out.written_to = found.written_to
    return out


def _in_runs(matched: DataFrame) -> DataFrame:
    """Matches of whole runs of windows: doc_id, version, starts, n (words), first_doc, first_version, first_start. starts has
    all places of the document that match the same n words of the holder: a text that repeats itself has many."""
    place = lambda spot: F.col(spot).bitwiseAND(F.lit(_PLACE))
    rows = matched.select(
        "doc_id", F.shiftright("spot", 32).alias("version"), place("spot").alias("at"),
        "first_doc", F.shiftright("first_spot", 32).alias("first_version"), place("first_spot").alias("first_at"),
    )
    group = ["doc_id", "version", "first_doc", "first_version"]
    rows = rows.withColumn("shift", F.col("at") - F.col("first_at"))
    islands = rows.withColumn("island", F.col("at") - F.dense_rank().over(Window.partitionBy(*group, "shift").orderBy("at")))
    found = islands.groupBy(*group, "shift", "island").agg(F.min("at").cast("int").alias("start"), (F.max("at") + LEAST - F.min("at")).cast("int").alias("n"))
    found = found.withColumn("first_start", (F.col("start") - F.col("shift")).cast("int"))
    same = found.groupBy(*group, "first_start", "n").agg(F.sort_array(F.collect_set("start")).alias("starts"))
    return same.select("doc_id", "version", "starts", "n", "first_doc", "first_version", "first_start")


def _joined_up(starts: list[int], n: int) -> list[list[int]]:
    """[start, end] of the stretches that n words from each of the sorted starts make."""
    out: list[list[int]] = []
    for a in starts:
        if out and a <= out[-1][1]:
            out[-1][1] = a + n
        else:
            out.append([a, a + n])
    return out


def _same_words(found: DataFrame, texts: DataFrame) -> DataFrame:
    """doc_id, version, start, end, first_doc, first_version, first_start of those of `found` whose words are equal in both
    documents."""
    need = F.struct("starts", "n", "first_doc", "first_version", "first_start")
    own = found.select("doc_id", "version", need.alias("need"))
    none = [F.lit(None).cast(t).alias(n) for n, t in (("first_doc", "long"), ("first_version", "long"), ("first_start", "int"))]
    theirs = found.select(F.col("first_doc").alias("doc_id"), F.col("first_version").alias("version"), F.struct(F.array("first_start").alias("starts"), "n", *none).alias("need"))
    wanted = own.unionByName(theirs).groupBy("doc_id", "version").agg(F.collect_set("need").alias("needs"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "version", "starts", "ends", "n", "first_doc", "first_version", "first_start", "words"]
        for pdf in by_chars(batches):
            rows = []
            for doc, version, text, needs in zip(pdf["doc_id"], pdf["version"], pdf["text"], pdf["needs"], strict=True):
                words = text.split()
                for x in needs:
                    n, places = x["n"], {}
                    for a in x["starts"]:  # places with other words than the first one's, if keys have lied, go apart
                        places.setdefault(tuple(words[a : a + n]), []).append(int(a))
                    for said, starts in places.items():
                        a, b = zip(*_joined_up(starts, n), strict=True)
                        rows.append((doc, version, a, b, n, x["first_doc"], x["first_version"], x["first_start"], " ".join(said)))
                    if len(rows) >= 2_000:
                        yield pd.DataFrame(rows, columns=names, dtype=object)
                        rows = []
            yield pd.DataFrame(rows, columns=names, dtype=object)

    schema = "doc_id long, version long, starts array<int>, ends array<int>, n int, first_doc long, first_version long, first_start int, words string"
    cut = texts.join(wanted.hint("merge"), ["doc_id", "version"]).select("doc_id", "version", "text", "needs").mapInPandas(run, schema)
    cut = materialise(cut, "passages-words")
    key = ["first_doc", "first_version", "first_start", "n"]
    first = cut.where("first_doc is null").select(F.col("doc_id").alias("first_doc"), F.col("version").alias("first_version"), F.col("starts")[0].alias("first_start"), "n", F.col("words").alias("theirs"))
    equal = cut.where("first_doc is not null").join(first, key).where("words = theirs")
    spans = equal.select("doc_id", "version", *key[:3], F.explode(F.arrays_zip("starts", "ends")).alias("x"))
    out = materialise(spans.select("doc_id", "version", *key[:3], F.col("x.starts").alias("start"), F.col("x.ends").alias("end")).distinct(), "passages-matches")
    discard(cut)
    return out


def _stretches(found: DataFrame) -> DataFrame:
    """Matches with one holder that overlap or touch, as in texts that repeat themselves, as one stretch."""
    group = ["doc_id", "version", "first_doc", "first_version"]
    order = Window.partitionBy(*group).orderBy("start", "end", "first_start")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parted = found.withColumn("new", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int")).withColumn("stretch", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = parted.groupBy(*group, "stretch").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min(F.struct("start", "first_start"))["first_start"].alias("first_start"))
    return out.select("doc_id", "version", "start", "end", (F.col("end") - F.col("start")).alias("n_words"), F.col("first_doc").alias("first_doc_id"), "first_start")


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, version, start, end (words), n_words, first_doc_id, first_start: the passages of each document that a document
    of a smaller id has too, and where the first match of each begins there."""
    docs = documents(docs).where("doc_id is not null and text is not null")
    marks = materialise(_marks(docs), "passages-marks")
    firsts = marks.where(F.col("words") >= LEAST).groupBy("digest", "words").agg(F.min(F.struct("doc_id", "version")).alias("first"), F.max("doc_id").alias("hi"))
    firsts = materialise(firsts.where("hi > first.doc_id").select("digest", "words", "first"), "passages-firsts")
    copies = marks.select("doc_id", "version", "digest", "words").join(firsts, ["digest", "words"]).where("doc_id > first.doc_id")
    copies = materialise(copies.select("doc_id", "version", "words", F.col("first.doc_id").alias("first_doc"), F.col("first.version").alias("first_version")).distinct(), "passages-copies")

    live = marks.where(F.size("places") > 0).join(copies, ["doc_id", "version"], "left_anti")
    suffixes = live.select("doc_id", "version", F.explode(F.arrays_zip("places", *HEADS)).alias("x"))
    suffixes = suffixes.select(*(F.col(f"x.{h}").alias(h) for h in HEADS), "doc_id", (F.shiftleft("version", 32) + F.col("x.places")).alias("spot"))
    suffixes = materialise(suffixes, "passages-suffixes")
    discard(marks, firsts)
    shared = _in_order(suffixes, HEADS).mapInPandas(_shared, "doc_id long, spot long")
    spots = shared.groupBy("doc_id", F.shiftright("spot", 32).alias("version")).agg(F.collect_set(F.col("spot").bitwiseAND(F.lit(_PLACE))).alias("places"))
    ends = copies.select("doc_id", "version").unionByName(copies.select(F.col("first_doc").alias("doc_id"), F.col("first_version").alias("version"))).distinct()
    wanted = spots.join(ends.withColumn("copy", F.lit(True)), ["doc_id", "version"], "full_outer").select("doc_id", "version", "places")
    texts = docs.withColumn("version", _version(F.col("text"))).join(wanted.hint("merge"), ["doc_id", "version"])
    texts = materialise(texts.select("doc_id", "version", "text", F.coalesce("places", F.array().cast("array<long>")).alias("places")), "passages-texts")
    discard(suffixes)

    matched = _matched(_windows(texts.where(F.size("places") > 0)))
    whole = copies.select("doc_id", "version", F.array(F.lit(0)).alias("starts"), F.col("words").alias("n"), "first_doc", "first_version", F.lit(0).alias("first_start"))
    found = materialise(_in_runs(matched).unionByName(whole), "passages-found")
    discard(matched, copies)
    out = _same_words(found, texts)
    discard(found, texts)
    return _stretches(out)


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the words of the spans (start, end); what stands between them stays as it is."""
    places = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    out, at = [], 0
    for a, b in sorted(spans):
        lo, hi = places[a][0], places[b][0] if b < len(places) else len(text)
        out.append(text[at : max(at, lo)])
        at = max(at, hi)
    return "".join([*out, text[at:]]).strip()


def remove(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs, all columns, without the found passages in text; n_chars, if there is such a column, follows a changed text."""
    doc, version, cut = (unused(docs, x) for x in ("of_doc", "of_version", "cut"))
    spans = found.groupBy(F.col("doc_id").alias(doc), F.col("version").alias(version)).agg(F.collect_set(F.struct("start", "end")).alias(cut))
    joined = docs.join(spans.hint("merge"), (docs["doc_id"] == spans[doc]) & (_version(docs["text"].cast("string")) == spans[version]), "left").drop(doc, version)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(cut).to_pylist()
            batch = batch.drop_columns([cut])
            if any(s is not None for s in spans):
                at = batch.schema.get_field_index("text")
                texts = [x if s is None else cut_words(x, [(y["start"], y["end"]) for y in s]) for x, s in zip(batch.column(at).to_pylist(), spans, strict=True)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                if (at := batch.schema.get_field_index("n_chars")) >= 0:
                    sizes = [n if s is None else len(x) for n, x, s in zip(batch.column(at).to_pylist(), texts, spans, strict=True)]
                    batch = batch.set_column(at, batch.schema.field(at), pa.array(sizes).cast(batch.schema.field(at).type))
            yield batch

    return joined.mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op2: all documents."""
    return repeats(table(spark, sf_dir, "documents"))
