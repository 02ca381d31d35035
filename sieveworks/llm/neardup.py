"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

Shingles are runs of five words (lower case). A shingle's weight is its count in the document times its IDF. The document
frequency of every shingle is counted exactly over all documents: chunks of documents send their distinct shingles, each
with its count in the chunk, to ranges of hashes, which send the sums back to the chunks. A shingle that many documents
have comes once from a chunk, so no range is larger than the others, and no list of shingles passes the driver. Each document gets
BANDS x ROWS consistent samples, banded; in each bucket of a band documents are compared to representatives, and every
comparison is verified exactly: near copies have a weighted Jaccard similarity of SIMILARITY or more, or at least COMMON of
their distinct shingles in common. Both count, for what many copies share has a low IDF and what an edit makes has the highest:
the larger a group of copies, the less alike its members are by weight. One edited word changes five shingles, so copies in which
one word of ten is another have a similarity of 0.4 or so. Verified links are joined into groups.

In a bucket, all members are compared to some of them; those that are unlike these are compared to the ones that were like
them, and so on, until every member is linked or has been held against every other that could link it. So members are
linked as if all pairs had been compared, but a bucket of alike documents takes a comparison or so each. Buckets that fit
in a task are joined there; larger ones in rounds over the cluster. Of buckets with the same members one is joined.

Documents with equal folded texts are one class, and only classes are compared. Texts without a word (null, empty, blank)
are never alike: each stands alone. Texts of under five words have one shingle, the whole text. Repeated rows of a
document fall in its class. Rows that share a doc_id but not a text count as versions of one document and share a group.
The document with the smallest doc_id represents its group. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_chars, discard, documents, materialise, table
from .textvec import mix64, single_spaced, word_hashes, word_shingles

WORDS = 5
SIMILARITY, COMMON = 0.4, 0.5
BANDS, ROWS = 16, 2
#: Characters of the documents that count their shingles together, and about how many shingles are summed in one task.
CHUNK_CHARS, RANGE_SHINGLES = 1 << 21, 4_000_000
HOT_SHARE = 1 / 500
#: Buckets of up to so many shingles (times members: steps of a nanosecond or so) are joined in one task; larger ones in
#: rounds over the cluster, by REPS members a round.
SMALL_SHINGLES, SMALL_WORK, REPS = 4_000_000, 8_000_000_000, 6


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of folded texts one after the other (sorted in each text), their counts, and how many each text has."""
    words, counts = word_hashes(texts)
    n = len(words)
    every, valid = np.zeros(n, np.uint64), np.ones(n, bool)
    if n >= WORDS:
        every[: n - WORDS + 1] = word_shingles(words, WORDS)
    ends = np.cumsum(counts)
    starts = ends - counts
    for back in range(1, WORDS):  # runs that would reach into the next text
        valid[(ends - back)[counts >= back]] = False
    for i in np.flatnonzero((counts > 0) & (counts < WORDS)):  # short texts: one shingle, the whole
        valid[starts[i]] = True
        every[starts[i]] = word_shingles(words[starts[i] : ends[i]], WORDS)[0]
    keys = every[valid]
    lens = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    ends = np.cumsum(lens)
    for a, b in zip((ends - lens).tolist(), ends.tolist(), strict=True):
        keys[a:b].sort()
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    first[(ends - lens)[lens > 0]] = True
    at = np.flatnonzero(first)
    sums = np.concatenate([[0], np.cumsum(first)])
    return keys[at], np.diff(np.append(at, len(keys))), sums[ends] - sums[ends - lens]


def idf_of(documents: int, frequency: np.ndarray) -> np.ndarray:
    """IDF of shingles that so many of the documents have."""
    return np.log((1 + documents) / frequency).astype(np.float32) + np.float32(1)


class Idf:
    """IDF of shingles by a table: `known` (sorted) have their own frequency, all others are in one document."""

    def __init__(self, documents: int, known: np.ndarray, frequency: np.ndarray):
        self.documents, self.known, self.frequency = documents, known, frequency

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), np.int64)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
            hit = self.known[at] == keys
            out[hit] = self.frequency[at[hit]]
        return idf_of(self.documents, out)


@functools.cache
def gamma_tables(size: int = 1 << 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quantiles of the Gamma(2, 1) distribution, their inverses and logarithms."""
    x = np.concatenate([np.geomspace(1e-4, 1, 20_000), np.linspace(1, 25, 40_000)[1:]])
    gamma = np.interp((np.arange(size) + 0.5) / size, 1 - (1 + x) * np.exp(-x), x)
    return gamma.astype(np.float32), (1 / gamma).astype(np.float32), np.log(gamma).astype(np.float32)


#: Shingles that are sampled at a time, so that the arrays stay in the processor's cache.
_AT_ONCE = 1 << 14


def samples(keys: np.ndarray, weights: np.ndarray, lens: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes (texts x bands) of consistent weighted samples; rows of texts without shingles have no meaning."""
    out = np.zeros((len(lens), bands), np.uint64)
    ends = np.cumsum(lens)
    full = np.flatnonzero(lens)
    log_s = np.log(weights).astype(np.float32)
    part = (ends[full] - lens[full]) // _AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(full)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        some = full[a:b]
        if len(some):
            lo, hi = ends[some[0]] - lens[some[0]], ends[some[-1]]
            out[some] = _sampled(keys[lo:hi], log_s[lo:hi], lens[some], bands, rows)
    return out


def _sampled(keys: np.ndarray, log_s: np.ndarray, lens: np.ndarray, bands: int, rows: int) -> np.ndarray:
    gamma, inverse, log_gamma = gamma_tables()
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)
    owner = np.repeat(np.arange(len(starts)), lens)
    out = np.zeros((len(lens), bands), np.uint64)
    rng = np.random.default_rng(11)
    for band in range(bands):
        got = np.full(len(starts), band, np.uint64)
        for _ in range(rows):
            # a shingle is a mixed hash already: one product more gives each function its own three numbers
            h = (keys ^ rng.integers(1 << 63, dtype=np.uint64)) * (rng.integers(1 << 63, dtype=np.uint64) << np.uint64(1) | np.uint64(1))
            i = (h >> np.uint64(48)).astype(np.intp)
            r = gamma[i]
            low = (h >> np.uint64(16)).astype(np.uint32)
            beta = (low & np.uint32(0xFFFF)).astype(np.float32)
            beta *= np.float32(1 / 65536)
            t = np.floor(log_s * inverse[i] + beta)
            log_a = log_gamma[(low >> np.uint32(16)).astype(np.intp)] - r * (t - beta + np.float32(1))
            least = np.flatnonzero(log_a == np.minimum.reduceat(log_a, starts)[owner])
            first = least[np.searchsorted(owner[least], np.arange(len(starts)))]
            got = mix64(got * np.uint64(31) + keys[first] + t[first].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[:, band] = got
    return out


def _folded(pdf: pd.DataFrame) -> list[str]:
    return [single_spaced(x) for x in pdf["text"]]


def fit_idf(docs: DataFrame) -> Idf:
    """The IDF of all shingles as one table on the driver, for tables that are small enough; near_duplicates has no need of it."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in by_chars(batches):
            keys, n = np.unique(shingle_sets(_folded(pdf))[0], return_counts=True)
            yield pd.DataFrame({"shingle": keys.view(np.int64), "n": n})

    got = docs.mapInPandas(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1").toPandas()
    keys = got["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return Idf(docs.count(), keys[order], got["n"].to_numpy()[order])


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes as their steps, first bytes of all first: those compress."""
    return np.diff(keys, prepend=np.zeros(1, np.uint64)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack_keys(packed: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def _pack_frequencies(n: np.ndarray) -> bytes:
    """A bit for each number, set where it is 2 or more, and those numbers."""
    return np.packbits(n > 1).tobytes() + n[n > 1].astype("<u4").tobytes()


def _unpack_frequencies(packed: bytes, size: int) -> np.ndarray:
    bits = np.frombuffer(packed, np.uint8, -(-size // 8))
    out = np.ones(size, np.int64)
    out[np.unpackbits(bits, count=size).astype(bool)] = np.frombuffer(packed, "<u4", offset=len(bits))
    return out


def _cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of the ranges of hashes begins in sorted keys, and where the last ends."""
    return np.searchsorted((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), np.arange(ranges + 1))


def chunks(docs: DataFrame) -> DataFrame:
    """The documents as chunks of about CHUNK_CHARS characters: chunk (a number), docs, words, size and body (ids and folded texts)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in by_chars(batches, limit=CHUNK_CHARS):
            texts = _folded(pdf)
            body = pickle.dumps((pdf["doc_id"].to_numpy(), texts), 5)
            yield pd.DataFrame({"docs": [len(texts)], "words": [sum(x.count(" ") + 1 for x in texts)], "size": [len(body)], "body": [pa.compress(body, "zstd", asbytes=True)]})

    parts = docs.mapInPandas(run, "docs long, words long, size long, body binary").withColumn("chunk", F.monotonically_increasing_id())
    return materialise(parts, "neardup-chunks")


def _opened(body: bytes, size: int) -> tuple[np.ndarray, list[str]]:
    return pickle.loads(pa.decompress(body, size, "zstd", asbytes=True))


def frequencies(parts: DataFrame, ranges: int) -> DataFrame:
    """chunk, part and seen: in how many of all documents each distinct shingle of the chunk is, by ranges of hashes."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf[["chunk", "size", "body"]].itertuples():
                _, texts = _opened(row.body, row.size)
                keys, n = np.unique(_shingles(texts)[0], return_counts=True)
                cuts = _cuts(keys, ranges)
                full = np.flatnonzero(np.diff(cuts))
                yield pd.DataFrame({
                    "chunk": np.full(len(full), row.chunk), "part": full.astype(np.int32),
                    "keys": [_pack_keys(keys[cuts[i] : cuts[i + 1]]) for i in full], "n": [_pack_frequencies(n[cuts[i] : cuts[i + 1]]) for i in full],
                })

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [_unpack_keys(x) for x in pdf["keys"]]
        n = np.concatenate([_unpack_frequencies(x, len(k)) for x, k in zip(pdf["n"], keys, strict=True)])
        ends = np.cumsum([len(k) for k in keys])
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(at, n).astype(np.int64)[at]
        return pd.DataFrame({"chunk": pdf["chunk"], "part": pdf["part"], "seen": [_pack_frequencies(x) for x in np.split(sums, ends[:-1])]})

    sent = parts.select("chunk", "size", "body").mapInPandas(send, "chunk long, part int, keys binary, n binary")
    return sent.groupBy("part").applyInPandas(total, "chunk long, part int, seen binary")


def _shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """shingle_sets of many texts, by about a million characters at a time."""
    part = np.cumsum([len(x) for x in texts]) // (1 << 20)
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    return tuple(np.concatenate(x) for x in zip(*(shingle_sets(texts[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)), strict=True))


def _digest(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def signatures(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, key (digest of the folded text; null without a word), its number of shingles, in how many documents each of
    them is (seen), and the band hashes; and the number of documents."""
    parts = chunks(docs)
    sums = parts.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    n, ranges = sums["docs"] or 0, -(-(sums["words"] or 0) // RANGE_SHINGLES) or 1
    back = frequencies(parts, ranges).groupBy("chunk").agg(F.collect_list(F.struct("part", "seen")).alias("parts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf[["size", "body", "parts"]].itertuples():
                ids, texts = _opened(row.body, row.size)
                keys, times, lens = _shingles(texts)
                own, at = np.unique(keys, return_inverse=True)
                cuts, seen = _cuts(own, ranges), np.ones(len(own), np.int64)
                for x in row.parts if row.parts is not None else []:
                    a, b = cuts[x["part"]], cuts[x["part"] + 1]
                    seen[a:b] = _unpack_frequencies(x["seen"], b - a)
                seen = seen[at]
                got = samples(keys, times * idf_of(n, seen), lens, BANDS, ROWS) if len(keys) else np.zeros((len(texts), BANDS), np.uint64)
                yield pd.DataFrame({
                    "doc_id": ids, "key": [_digest(x) if x else None for x in texts], "shingles": lens,
                    "seen": [_pack_frequencies(x) for x in np.split(seen, np.cumsum(lens)[:-1])], "bands": list(got.view(np.int64)),
                })

    marks = parts.join(back, "chunk", "left").select("size", "body", "parts")
    marks = materialise(marks.mapInPandas(run, "doc_id long, key binary, shingles long, seen binary, bands array<long>"), "neardup-marks")
    discard(parts)
    return marks, n


def _by_hot(left: DataFrame, right: DataFrame, on: str, n: int, how: str = "inner") -> DataFrame:
    """left joined to right, which has a row per key and their number `size`: keys with a large share of the n rows, few
    by that definition, by broadcast, and the others by a shuffle."""
    hot = right.where(F.col("size") > max(50, n * HOT_SHARE))
    names = F.broadcast(hot.select(on))
    rest = right.where(F.col("size") <= max(50, n * HOT_SHARE))
    few = left.join(F.broadcast(hot), on, "inner")
    return few.unionByName(left.join(names, on, "left_anti").join(rest, on, how))


def _alike(a: tuple[np.ndarray, np.ndarray, float], b: tuple[np.ndarray, np.ndarray, float]) -> float | None:
    """The weighted Jaccard similarity of two sets (keys, weights, sum of weights), if they are near copies: if it is SIMILARITY or
    more, or at least COMMON of all their keys are common and their sums differ no more than that of such sets can."""
    least = SIMILARITY * (1 - 1e-6)
    if min(a[2], b[2]) < least * max(a[2], b[2]):
        return None
    _, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = float(np.minimum(a[1][x], b[1][y]).sum(dtype=np.float64))
    both = a[2] + b[2] - common
    return common / both if common >= least * both or len(x) >= COMMON * (len(a[0]) + len(b[0]) - len(x)) else None


def _weighted(pdf: pd.DataFrame, n_docs: int) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """The weighted shingle set of each row's folded text, of which `seen` has the document frequencies."""
    keys, times, lens = shingle_sets(pdf["text"].tolist())
    weights = times * idf_of(n_docs, np.concatenate([_unpack_frequencies(x, n) for x, n in zip(pdf["seen"], lens, strict=True)]))
    ends = np.cumsum(lens)
    return [(keys[e - n : e], weights[e - n : e], float(weights[e - n : e].sum(dtype=np.float64))) for e, n in zip(ends, lens, strict=True)]


def verify(pairs: DataFrame, texts: DataFrame, n_docs: int) -> DataFrame:
    """a, b and similarity of those pairs that are near copies.

    texts has id, text (folded) and seen. Each a is sent once for every SALT of its partners and compared to them in a stream.
    """
    salted = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(32)).cast("int").alias("salt"))
    right = salted.join(texts, salted["b"] == texts["id"]).select("a", "salt", "b", "text", "seen")
    left = salted.select("a", "salt").distinct().join(texts, F.col("a") == texts["id"]).select("a", "salt", F.lit(None).cast("long").alias("b"), "text", "seen")
    dealt = left.unionByName(right).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, mine = None, None
        for pdf in by_chars(batches):
            out = []
            for a, salt, b, own in zip(pdf["a"], pdf["salt"], pdf["b"], _weighted(pdf, n_docs), strict=True):
                if pd.isna(b):
                    held, mine = (a, salt), own
                elif held == (a, salt) and (sim := _alike(mine, own)) is not None:
                    out.append((a, int(b), sim))
            yield pd.DataFrame(out, columns=["a", "b", "similarity"])

    return dealt.mapInPandas(run, "a long, b long, similarity double")


def joined(group: list[tuple[int, tuple[np.ndarray, np.ndarray, float]]]) -> list[tuple[int, int, float]]:
    """Links (a, b, similarity) of the members of one bucket. Each step holds one member against all that wait, at once:
    its weights are laid out by shingle, and the smaller weights are summed for each waiting member."""
    if len(group) < 2:
        return []
    ids = [i for i, _ in group]
    sets = [x for _, x in group]
    _, spots = np.unique(np.concatenate([k for k, _, _ in sets]), return_inverse=True)
    ends = np.cumsum([len(k) for k, _, _ in sets])
    places = np.split(spots, ends[:-1])
    weights = [w.astype(np.float64) for _, w, _ in sets]
    sums, sizes = np.array([x[2] for x in sets]), np.array([len(k) for k, _, _ in sets])
    dense = np.zeros(int(spots.max()) + 1)
    least = SIMILARITY * (1 - 1e-6)
    out, linked, waiting = [], [], np.arange(1, len(group))
    at = 0
    packed = None  # the waiting members that the arrays below hold
    while len(waiting):
        if packed is None or len(waiting) < 0.7 * len(packed):
            packed = waiting
            flat, flat_w = np.concatenate([places[i] for i in packed]), np.concatenate([weights[i] for i in packed])
            starts = np.concatenate([[0], np.cumsum([len(places[i]) for i in packed])[:-1]])
        dense[places[at]] = weights[at]
        held = dense[flat]
        common = np.add.reduceat(np.minimum(held, flat_w), starts)
        shared = np.add.reduceat((held > 0).astype(np.int64), starts)
        dense[places[at]] = 0
        both = sums[at] + sums[packed] - common
        near = (shared >= COMMON * (sizes[at] + sizes[packed] - shared)) & (np.minimum(sums[at], sums[packed]) >= least * np.maximum(sums[at], sums[packed]))
        hit = np.isin(packed, waiting) & ((common >= least * both) | near)
        out += [(ids[at], ids[i], float(c / d)) for i, c, d in zip(packed[hit], common[hit], both[hit], strict=True)]
        linked += packed[hit].tolist()
        waiting = np.setdiff1d(waiting, packed[hit], assume_unique=True)
        if linked:
            at = linked.pop()
        elif len(waiting):
            at, waiting = int(waiting[0]), waiting[1:]
    return out


def _small_buckets(members: DataFrame, texts: DataFrame, n_docs: int) -> DataFrame:
    """Links of the members of buckets that fit in a task: a, b, similarity."""
    dealt = members.select("bucket", "id").join(texts, "id").repartition("bucket").sortWithinPartitions("bucket", "id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, group = None, []
        for pdf in by_chars(batches):
            out = []
            for bucket, at, own in zip(pdf["bucket"], pdf["id"], _weighted(pdf, n_docs), strict=True):
                if bucket != held:
                    out += links_of(group)
                    held, group = bucket, []
                group.append((at, own))
            yield pd.DataFrame(out, columns=["a", "b", "similarity"])
        yield pd.DataFrame(links_of(group), columns=["a", "b", "similarity"])

    def links_of(group: list) -> list[tuple[int, int, float]]:
        if len(group) == 2:
            sim = _alike(group[0][1], group[1][1])
            return [] if sim is None else [(group[0][0], group[1][0], sim)]
        return joined(group)

    return dealt.mapInPandas(run, "a long, b long, similarity double")


def _large_buckets(members: DataFrame, texts: DataFrame, n_docs: int, n: int) -> list[DataFrame]:
    """Links of the members of buckets of any size, in rounds over the whole cluster: in each, all that wait are compared to
    up to REPS members, those that have been linked but not compared before any others."""
    order = F.struct(F.xxhash64("id").alias("h"), "id")
    slot = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(REPS))
    state = members.select("bucket", "id", F.lit(0).alias("state"))  # 0 waits, 1 is linked, 2 has been compared to all that wait
    found: list[DataFrame] = []
    while True:
        state = materialise(state, "neardup-state")
        sums = state.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("size"),
            F.count_if(F.col("state") == 0).alias("waiting"),
            F.array_compact(F.array(*[F.min(F.when((F.col("state") == 1) & (slot == i), order))["id"] for i in range(REPS)])).alias("linked"),
            F.array_compact(F.array(*[F.min(F.when((F.col("state") == 0) & (slot == i), order))["id"] for i in range(REPS)])).alias("next"),
        )
        sums = materialise(sums.where("waiting > 0 and (waiting > 1 or size(linked) > 0)"), "neardup-sums")
        left = sums.agg(F.sum(F.col("waiting") * F.col("size")).alias("n")).first()["n"] or 0
        last = left <= n
        if last:  # few comparisons are left in all: the waiting members against all others of their buckets, at once
            live = state.join(sums.select("bucket"), "bucket", "left_semi")
            other = live.where("state < 2").select("bucket", F.col("id").alias("a"), F.col("state").alias("s"))
            pairs = live.where("state = 0").join(other, "bucket").where("a <> id and (s = 1 or a < id)").select("a", F.col("id").alias("b")).distinct()
        else:
            reps = F.when(F.size("linked") > 0, F.col("linked")).otherwise(F.col("next")).alias("reps")
            live = materialise(_by_hot(state, sums.select("bucket", "size", reps), "bucket", n), "neardup-round")
            pairs = live.where("state = 0").select("bucket", "id", F.explode("reps").alias("a")).where("a <> id").select("a", F.col("id").alias("b")).distinct()
        pairs = materialise(pairs, "neardup-pairs")
        if pairs.isEmpty():
            return found
        good = materialise(verify(pairs, texts, n_docs), "neardup-links")
        found.append(good)
        discard(pairs)
        if last:
            return found
        hits = good.select(F.col("b").alias("id"), F.col("a")).groupBy("id").agg(F.collect_set("a").alias("hits"))  # REPS of each bucket at most
        state = live.join(hits, "id", "left").select(
            "bucket", "id",
            F.when(F.array_contains("reps", F.col("id")), 2)
            .when((F.col("state") == 0) & F.coalesce(F.arrays_overlap("hits", "reps"), F.lit(False)), 1)
            .otherwise(F.col("state")).alias("state"),
        )


def links(members: DataFrame, texts: DataFrame, n_docs: int, n: int) -> DataFrame:
    """Verified links of the members (bucket, id, shingles) of all buckets, enough of them to join what any link would join."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.sum("shingles").alias("shingles"))
    small = (F.col("shingles") <= SMALL_SHINGLES) & (F.col("shingles") * F.col("size") <= SMALL_WORK)
    known = sizes.withColumn("small", small).drop("shingles")
    dealt = materialise(_by_hot(members, known, "bucket", n), "neardup-dealt")
    found = [materialise(_small_buckets(dealt.where("small"), texts, n_docs), "neardup-links")]
    large = dealt.where("not small").select("bucket", "id")
    if not large.isEmpty():
        found += _large_buckets(large, texts, n_docs, n)
    out = materialise(reduce(DataFrame.unionByName, found).distinct(), "neardup-links")
    discard(dealt, *found)
    return out


def components(edges: DataFrame) -> DataFrame:
    """id and the smallest id that its links lead to, for every id with a link. edges: a, b."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = materialise(both, "components-edges")
    labels = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "id"), "components-labels")
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        less = labels.join(near, labels["id"] == near["a"]).select("id", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        less = materialise(less, "components-step")
        discard(labels)
        # a label's own label is smaller still: jump there
        up = less.select(F.col("id").alias("up"), F.col("label").alias("top"))
        new = less.join(up, less["label"] == up["up"], "left").select("id", "was", F.least("label", F.coalesce("top", "label")).alias("label"))
        new = materialise(new, "components-labels")
        discard(less)
        labels = new.select("id", "label")
        labels.written_to = new.written_to
        if new.where("label <> was").isEmpty():
            return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, class_id (least doc_id with an equal folded text) and group_id."""
    return _grouped(docs)[0]


def _grouped(docs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """near_duplicates(docs) and the working tables that it still reads."""
    docs = documents(docs)
    marks, n_docs = signatures(docs)
    classes = marks.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("size"), F.first("bands").alias("bands"), F.first("shingles").alias("shingles"), F.first("seen").alias("seen"))
    classes = materialise(classes, "neardup-classes")
    n = classes.count()
    cells = classes.select(F.explode("bands").alias("bucket"), F.col("class_id").alias("id"), "shingles")
    cells = cells.groupBy("bucket", "id").agg(F.max("shingles").alias("shingles"))
    # buckets with the same members, as those of a pair in several bands, are one: told by their size and 128 bits of its ids' hashes
    marked = [F.bit_xor(F.xxhash64("id", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    shared = cells.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), *marked).where("size > 1")
    shared = shared.groupBy("size", "mark0", "mark1").agg(F.min("bucket").alias("bucket")).select("bucket", "size")
    members = materialise(_by_hot(cells, shared, "bucket", n).select("bucket", "id", "shingles"), "neardup-members")
    # folded texts of the documents that stand for a class in some bucket
    ids = members.select("id").distinct().join(classes.select(F.col("class_id").alias("id"), F.hex("key").alias("hex"), "seen"), "id")

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in by_chars(batches):
            texts = _folded(pdf)
            ok = [_digest(x).hex().upper() == h for x, h in zip(texts, pdf["hex"], strict=True)]
            yield pd.DataFrame({"id": pdf["id"].to_numpy()[ok], "text": [x for x, y in zip(texts, ok, strict=True) if y], "seen": pdf["seen"].to_numpy()[ok]})

    texts = docs.join(ids.hint("merge"), docs["doc_id"] == ids["id"]).select("id", "hex", "seen", "text").mapInPandas(kept, "id long, text string, seen binary")
    texts = materialise(texts.dropDuplicates(["id"]), "neardup-texts")
    edges = links(members, texts, n_docs, n)
    discard(texts, members)
    labels = components(edges)
    named = classes.join(labels, classes["class_id"] == labels["id"], "left").select("key", "size", "class_id", F.coalesce("label", "class_id").alias("group_id"))
    named = materialise(named, "neardup-groups")
    discard(classes, edges, labels)
    out = _by_hot(marks.where("key is not null").select("doc_id", "key"), named, "key", n).select("doc_id", "class_id", "group_id")
    alone = marks.where("key is null").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("group_id"))
    return out.unionByName(alone), [marks, named]


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that represent their group; of repeated rows of one doc_id the first text stays."""
    found, used = _grouped(docs)
    groups = materialise(found, "neardup-result")
    discard(*used)
    stay = groups.where("doc_id is null or doc_id = group_id").select(F.col("doc_id").alias("_stay")).distinct()
    kept = docs.join(stay.hint("merge"), docs["doc_id"].eqNullSafe(stay["_stay"]), "left_semi")
    twice = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and doc_id is not null").select("doc_id")
    if twice.isEmpty():
        return kept
    once = kept.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(twice, "doc_id", "left_anti").unionByName(once)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))
