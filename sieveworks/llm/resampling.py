"""Resampling of documents by importance towards a target distribution, over hashed word features.

Features are all runs of one and two consecutive words. Each task builds a trie of the words it meets: a node stands for a word
after the words on its path, and holds its count and its CRC state, from which the CRCs of its children go on. A task's bucket
totals are summed over the cluster to one row a bucket. With them each bucket gets a gain, how much likelier the target
holds it than the documents do, and documents are scored by walking the trie with the gains of its nodes. Nodes of the second
level are counted out after each batch of texts, and a trie of NODES words is begun anew, so a task's memory is bounded.

A document's score is the floored mean gain of its features plus Gumbel noise that a hash of its id decides; the documents
with the highest scores are a sample without replacement in which the weights are the odds. They are ranked over the cluster:
rows in buckets of scores, moved up by the counts of the buckets above.

Null texts have no features, and weight 0. A null id takes part as the empty string, and comes last among equal scores.
Repeated rows are scored and ranked each. Empty tables give no rows; without target texts all gains follow from the documents
alone. Only A to Z are lower-cased. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_chars, global_rank, materialise, table

BUCKETS = 10_000
#: Documents with fewer words are never drawn; so many in a hundred of the others are.
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Words of a task's trie before it is begun anew.
NODES = 1_000_000
#: Neighbouring scores that are ranked in one group.
RANKED = 8

#: Digits, lower-case letters and all beyond ASCII, as UTF-8.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class Words(dict):
    """Numbers of words, in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Trie:
    """A task's words and, for one batch of texts at a time, the words that follow them.

    The root's children are kept from batch to batch, each with its CRC. The nodes below them are made for each batch, sorted by
    (parent, word), each with its count; its CRC goes on from its parent's: what a further word does to a CRC depends on the
    word's CRC and length only, so the CRCs of all nodes are made at once, from a table for each length.
    """

    def __init__(self):
        self.ids = Words()
        self.crcs = np.zeros(0, np.uint32)  # of the word alone
        self.tails = np.zeros(0, np.uint32)  # of the word after a space
        self.sizes = np.zeros(0, np.int64)  # which table shifts a CRC past the space and the word
        self.lengths: dict[int, int] = {}
        self.shifts = np.zeros((0, 4, 256), np.uint32)

    def __len__(self) -> int:
        return len(self.ids)

    def _grow(self) -> None:
        new = list(itertools.islice(self.ids, len(self.crcs), None))
        if not new:
            return
        fill = lambda f, kind: np.fromiter(map(f, new), kind, len(new))
        self.crcs = np.concatenate([self.crcs, fill(zlib.crc32, np.uint32)])
        self.tails = np.concatenate([self.tails, fill(lambda w: zlib.crc32(w, zlib.crc32(b" ")), np.uint32)])
        tables = [shift_table(n + 1) for n in dict.fromkeys(map(len, new)) if n not in self.lengths and self.lengths.setdefault(n, len(self.lengths)) >= 0]
        if tables:
            self.shifts = np.concatenate([self.shifts, np.stack(tables)])
        self.sizes = np.concatenate([self.sizes, fill(lambda w: self.lengths[len(w)], np.int64)])

    def walk(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For a batch of texts: the CRC of each word in order; the CRCs of the nodes of depth 2 and their counts; the node of each
        pair in order (one less than words in each text with words); and how many words each text has."""
        found = [_WORD.findall(x.lower()) for x in texts]
        n = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(map(self.ids.__getitem__, itertools.chain.from_iterable(found)), np.int64, int(n.sum()))
        self._grow()
        if not len(ids):
            return np.zeros(0, np.uint32), np.zeros(0, np.uint32), ids, ids, n
        within = np.ones(len(ids), bool)
        within[np.cumsum(n)[n > 0] - n[n > 0]] = False  # a text's first word follows none
        pairs, which, counts = np.unique((ids[:-1] << 32 | ids[1:])[within[1:]], return_inverse=True, return_counts=True)
        parent, word = self.crcs[pairs >> 32], pairs & 0xFFFFFFFF
        crcs, table = self.tails[word], self.sizes[word]
        for i in range(4):
            crcs ^= self.shifts[table, i, parent >> np.uint32(8 * i) & np.uint32(255)]
        return self.crcs[ids], crcs, counts, which, n


def shift_table(n: int) -> np.ndarray:
    """What n more bytes make of each byte of a CRC: four tables of 256. The CRC of two strings is the first one's, shifted by the
    second's length, xor the second's."""
    zeros = bytes(n)
    bits = [zlib.crc32(zeros, 1 << i) ^ zlib.crc32(zeros) for i in range(32)]
    out = np.zeros((4, 256), np.uint32)
    for i, x in enumerate(bits):
        part, bit = out[i // 8], 1 << i % 8
        part[bit : 2 * bit] = part[:bit] ^ np.uint32(x)
    return out


def _bytes(df: DataFrame) -> DataFrame:
    return df.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))


def totals(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket and n: how often all texts hold a feature of the bucket. One row a bucket at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, trie = np.zeros(buckets, np.int64), Trie()
        for pdf in by_chars(batches):
            words, nodes, counts, _, _ = trie.walk(pdf["text"].tolist())
            sums += np.bincount(words % buckets, minlength=buckets)
            np.add.at(sums, nodes % buckets, counts)
            if len(trie) > NODES:
                trie = Trie()
        some = np.flatnonzero(sums)
        yield pd.DataFrame({"bucket": some, "n": sums[some]})

    return _bytes(df.select("text")).mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """A gain for each bucket, from the totals of both sides."""
    big, small = float(sum(documents.values()) + buckets), float(sum(target.values()) + buckets)
    return [math.floor(1000 * math.log((target.get(b, 0) + 1.0) * big / ((documents.get(b, 0) + 1.0) * small))) for b in range(buckets)]


def weights(docs: DataFrame, gain: list[int]) -> DataFrame:
    """doc_id, n_words, n_features and weight of each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie, of = Trie(), np.array(gain, np.int64)
        for pdf in by_chars(batches):
            words, nodes, _, which, n = trie.walk(pdf["text"].tolist())
            m = np.maximum(n - 1, 0)
            total = np.zeros(len(n), np.int64)
            for values, each in ((of[words % len(of)], n), (of[nodes % len(of)][which], m)):
                sums = np.concatenate([[0], np.cumsum(values)])
                ends = np.cumsum(each)
                total += sums[ends] - sums[ends - each]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "n_words": n, "n_features": n + m, "weight": total // np.maximum(n + m, 1)})
            if len(trie) > NODES:
                trie = Trie()

    rows = _bytes(docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text"))
    return rows.mapInPandas(run, "doc_id string, n_words long, n_features long, weight long").withColumn("doc_id", F.col("doc_id").cast("long"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a hash of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is null where it is not drawn."""
    read = lambda df: {r["bucket"]: r["n"] for r in totals(df).collect()}  # noqa: E731  BUCKETS rows at most
    scored = weights(docs, gains(read(docs), read(target))).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = materialise(scored, "resampling-scores")
    able = scored.where(F.col("n_words") >= LEAST_WORDS)
    drawn = able.count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = global_rank(able, [], F.floor(-F.col("score") / RANKED), order, "place")
    ranked = ranked.select("doc_id", "n_features", "weight", "score", F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank"))
    rest = scored.where(F.col("n_words") < LEAST_WORDS).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)


def query(spark, sf_dir: str) -> DataFrame:
    """op12: all documents, towards the texts of `benchmark`."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# crc32 of each distinct feature by its bytes
SQL = f"""
with crc_table as (
    select list(v order by b) as t from (
        select b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) as v
        from (select unnest(range(256)) as b)
    )
),
docs as (select row_number() over () as k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
items as (select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
held as (
    select k, f, count(*) as n from (
        select k, unnest(w) as f from docs
        union all select k, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from docs
    ) group by k, f
),
wanted as (
    select f, count(*) as n from (
        select unnest(w) as f from items
        union all select unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from items
    ) group by f
),
hashed as (
    select f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::bigint)),
        lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) % {BUCKETS} as bucket
    from (select f, hex(encode(f)) as x from (select f from held union select f from wanted)), crc_table
),
s as (select bucket, sum(n) as n from held join hashed using (f) group by bucket),
t as (select bucket, sum(n) as n from wanted join hashed using (f) group by bucket),
sums as (select coalesce((select sum(n) from s), 0)::double as big, coalesce((select sum(n) from t), 0)::double as small),
gain as (
    select b as bucket, floor(1000 * ln((coalesce(t.n, 0)::double + 1) * (big + {BUCKETS}) / ((coalesce(s.n, 0)::double + 1) * (small + {BUCKETS}))))::bigint as g
    from (select unnest(range({BUCKETS})) as b), sums left join s on s.bucket = b left join t on t.bucket = b
),
summed as (select k, sum(n)::bigint as n, sum(n * g)::bigint as total from held join hashed using (f) join gain using (bucket) group by k),
scored as (
    select d.k, doc_id, len(w) as words, coalesce(n, 0) as n_features, coalesce(total // n - case when total % n < 0 then 1 else 0 end, 0)::bigint as weight,
        floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as noise
    from docs d left join summed x on x.k = d.k
),
placed as (
    select *, weight + noise as score, case when words >= {LEAST_WORDS} then row_number() over (partition by words >= {LEAST_WORDS} order by weight + noise desc, doc_id nulls last) end as place,
        count(*) filter (words >= {LEAST_WORDS}) over () * {PERCENT} // 100 as drawn
    from scored
)
select doc_id, n_features::bigint as n_features, weight, score, case when place <= drawn then place end as rank from placed
"""
