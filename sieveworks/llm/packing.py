"""Best-two-fit packing of token sequences.

Documents become ids (with a separator), longer ones than `length` are cut, and whole pieces are packed as they are. The
rest are packed by the histogram of their lengths: a bin is filled greedily (largest first), then its smallest document
is replaced by two unpacked documents that fit the widened gap more tightly. Lengths are at most 2048, so the plan is
made on counts of lengths and not on documents: each block of documents (BLOCK of them, dealt by a hash) makes its own
plan in one task, and documents take the plan's places by their rank among those of their length.

Null and empty texts give the separator alone. Repeated rows and texts are packed like any other, a piece each; rows of
one doc_id are told apart by their order (text). A null doc_id stays null. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_chars, long_ids, materialise, table, text_ids

LENGTH = 2048
SEPARATOR = 0
#: Documents that are planned together; bins that a block leaves open waste less than one bin in a thousand.
BLOCK = 20_000
VOCABULARY = "word_bpe_49k.json"
#: Words that an encoder keeps, about 200 bytes each.
_CACHED = 800_000
_PIECE = re.compile(r"[a-z]+")
#: Letters and then ASCII punctuation: the splitter parts them, whatever stands around.
_TAILED = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]+)")


def byte_letters() -> list[str]:
    """The character that a byte-level vocabulary has for each byte: itself if it prints, else the next one above 255."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


class WordEncoder:
    """ids of texts by a tokenizers file whose normaliser and splitter never look across white space.

    Each distinct white-space separated word is encoded once and kept; words of plain letters go straight to the model.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.ids: dict[str, bytes] = {}
        self.letters = dict(enumerate(byte_letters()))

    def _word(self, word: str) -> bytes:
        low = word.lower() if word.isascii() else word
        if _PIECE.fullmatch(low):
            ids = [x.id for x in self.model.tokenize(low)]
        elif word.isalpha() and max(word) < "\u0250" and (low := word.lower()).isalpha():
            # composed Latin letters: the normaliser only lowers them, and they are one word for the splitter
            ids = [x.id for x in self.model.tokenize(low.encode().decode("latin-1").translate(self.letters))]
        elif tailed := _TAILED.fullmatch(word):
            return b"".join([self.ids.get(x) or self.ids.setdefault(x, self._word(x)) for x in tailed.groups()])
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        known = self.ids
        words = text.replace("\n", " ").split(" ")
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            if len(known) > _CACHED:
                known.clear()
            out = []
            for w in words:
                got = known.get(w)
                if got is None:
                    got = known[w] = self._word(w)
                out.append(got)
            return b"".join(out)


def best_two_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of items' indices. Greedy filling, largest first; then the smallest item gives way to two that fit tighter."""
    by: dict[int, list[int]] = {}
    for i in np.argsort(lengths, kind="stable"):
        by.setdefault(int(lengths[i]), []).append(int(i))
    sizes = sorted(by)

    def take(size: int) -> int:
        i = by[size].pop()
        if not by[size]:
            del by[size]
            sizes.pop(bisect_right(sizes, size) - 1)
        return i

    def put(size: int, i: int) -> None:
        if size not in by:
            by[size] = []
            insort(sizes, size)
        by[size].append(i)

    bins = []
    while sizes:
        inside, gap = [], capacity
        while sizes and (k := bisect_right(sizes, gap)):
            size = sizes[k - 1]
            inside.append((size, take(size)))
            gap -= size
        if gap and sizes and len(inside) > 1:
            small, at = inside[-1]
            wide, best = gap + small, (small, 0, 0)
            # two unpacked sizes with a sum in (small, wide], as large as can be: two pointers over the sizes
            a, b = 0, bisect_right(sizes, wide) - 1
            while a <= b:
                total = sizes[a] + sizes[b]
                if total > wide:
                    b -= 1
                    continue
                if total > best[0] and (a != b or len(by[sizes[a]]) > 1):
                    best = (total, sizes[a], sizes[b])
                    if total == wide:
                        break
                if a == b:
                    break
                a += 1
            if best[1]:
                inside[-1:] = [(best[2], take(best[2])), (best[1], take(best[1]))]
                put(small, at)
        bins.append([i for _, i in inside])
    return bins


def pieces(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, copy, piece, start, length, ids_crc32 (and the ids' separator counted in)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = WordEncoder(path)
        end = np.array([SEPARATOR], "<u4").tobytes()
        for pdf in by_chars(batches):
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                ids = (encoder.encode(text) if text else b"") + end
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    rows.append((doc, k, k * length, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return long_ids(text_ids(docs).mapInPandas(run, "doc_id string, piece int, start long, length long, ids_crc32 long"))


def pack(rows: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """Adds sequence_id and offset. Whole pieces have a sequence to themselves; the others are packed block by block."""
    rows = materialise(rows, "packing-pieces")
    blocks = max(1, round(rows.where(F.col("length") < length).count() / block))
    seed = F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.monotonically_increasing_id())

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable", ignore_index=True, na_position="last")
        lengths = pdf["length"].to_numpy()
        seq, off = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for k, inside in enumerate(best_two_fit(lengths, length)):
            seq[inside] = k
            off[inside] = np.concatenate([[0], np.cumsum(lengths[inside])[:-1]])
        return pdf[["doc_id", "piece", "start", "length", "ids_crc32"]].assign(sequence_id=seq * 2 * blocks + 2 * pdf["block"].to_numpy(), offset=off)

    schema = "doc_id string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    part = rows.where(F.col("length") < length).withColumn("block", F.pmod(seed, F.lit(blocks)))
    packed = long_ids(part.withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("block").applyInPandas(plan, schema))
    whole = rows.where(F.col("length") >= length).select("*", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(whole)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def query(spark, sf_dir: str) -> DataFrame:
    """op9: all documents, sequences of at most 2048 tokens."""
    return pack(pieces(table(spark, sf_dir, "documents"), vocabulary()))
