"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared by their letters and digits: lower case, everything else folded to one space. An item of m characters
may be found with up to k = floor(ERROR_RATE * m) edits, whatever its length; an end of the occurrence that lies inside a
word of the text counts as one edit more. So items of a few words (k = 0) are found as whole words only. The item is split
into k + 1 pieces: an occurrence with at most k edits leaves one piece intact, so exact piece hits (one automaton over all
pieces) give every candidate place, and each that shares enough trigrams with the item is verified by Myers' bit-parallel
edit distance. Between characters of scripts that are written without spaces any place may be a word's border.

The items are broadcast only while they are under MAX_ITEM_CHARS characters in all; larger sets are matched in blocks of
that size, one pass over the documents each, so no item is dropped: one block is held at a time. Only null items and those
without a letter or digit can match nothing; null and empty documents contain nothing. Equal items are each reported. A
document that holds an item several times gives one row, of its best place (ties: the first).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import by_chars, discard, long_ids, materialise, table, text_ids

ERROR_RATE = 0.08
MAX_ITEM_CHARS = 4_000_000
_OTHER = re.compile(r"[\W_]+")
#: Letters of scripts without spaces between words: Thai to Lao, Burmese, Khmer, kana, ideographs.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def fold_text(text: str) -> str:
    return _OTHER.sub(" ", text.lower()).strip()


def budget(length: int, rate: float) -> int:
    return int(rate * length)


def split_pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length, with their places."""
    n, parts = len(item), k + 1
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def is_border(text: str, at: int) -> bool:
    """Whether a word of the folded text can begin or end at this place."""
    if at <= 0 or at >= len(text):
        return True
    a, b = text[at - 1], text[at]
    return a == " " or b == " " or bool(_UNSPACED.match(a) or _UNSPACED.match(b))


def best_match(masks: dict[str, int], m: int, text: str, lo: int, hi: int, most: int) -> tuple[int, int] | None:
    """Least number of edits (an end inside a word is one) between the pattern and any substring of text[lo:hi], and where
    that substring ends in text; None if above `most`.

    Myers' bit vectors, in Python's integers of any width; masks has the pattern's places of each character. The row above
    the pattern, what it costs to begin at a place, is 0 at borders and 1 elsewhere: its steps enter at the lowest bit.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    before = 0 if is_border(text, lo) else 1
    pv, mv, score = full, 0, m + before
    best, end = most + 1, -1
    get = masks.get
    for j in range(lo, hi):
        eq = get(text[j], 0)
        cost = 0 if is_border(text, j + 1) else 1
        step, before = cost - before, cost
        xv = eq | mv
        if step < 0:
            eq |= 1
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1 | (step > 0)) & full
        mh = (mh << 1 | (step < 0)) & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score + cost < best:
            best, end = score + cost, j + 1
            if not best:
                break
    return (best, end) if end >= 0 else None


def whole_words(item: str, text: str, lo: int, hi: int) -> int:
    """Where the item first stands in text[lo:hi] between two borders of words, or -1."""
    at = text.find(item, lo, hi)
    while at >= 0 and not (is_border(text, at) and is_border(text, at + len(item))):
        at = text.find(item, at + 1, hi)
    return at


Q = 3


def _grams(text: str) -> list[str]:
    return [text[i : i + Q] for i in range(len(text) - Q + 1)]


class Matcher:
    """Finds all of its items in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            folded = fold_text(text or "")
            if not folded:
                continue
            k, masks = budget(len(folded), rate), {}
            for i, c in enumerate(folded):
                masks[c] = masks.get(c, 0) | 1 << i
            for at, piece in split_pieces(folded, k):
                pieces.setdefault(piece, []).append((len(self.items), at))
            grams = _grams(folded)
            # an edit spoils Q of an item's Q-grams at most: a window with fewer of them can't hold the item
            self.items.append((item_id, folded, k, masks, grams, len(grams) - k * Q))
        self.auto = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.auto.add_word(piece, (len(piece), places))
        if len(self.auto):
            self.auto.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, edits, from, to) of each item in the folded text; from is the earliest place its window allows."""
        if not len(self.auto):
            return []
        windows: dict[int, list[list[int]]] = {}
        out = []
        for end, (size, places) in self.auto.iter(text):
            for item, at in places:
                _, folded, k, *_ = self.items[item]
                lo = max(0, end + 1 - size - at - k)
                hi = end + 1 - size - at + len(folded) + k
                spans = windows.setdefault(item, [])
                if spans and lo <= spans[-1][1] - len(folded) + k:
                    spans[-1][0], spans[-1][1] = min(lo, spans[-1][0]), max(hi, spans[-1][1])
                else:
                    spans.append([lo, hi])
        for item, spans in windows.items():
            item_id, folded, k, masks, grams, least = self.items[item]
            best = None
            for lo, hi in spans:
                hi = min(hi, len(text))
                exact = whole_words(folded, text, lo, hi)
                if exact < 0 and (not k or least > 0 and sum(map(set(_grams(text[lo:hi])).__contains__, grams)) < least):
                    continue
                got = (0, exact + len(folded)) if exact >= 0 else best_match(masks, len(folded), text, lo, hi, k if best is None else best[0] - 1)
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], max(0, got[1] - len(folded)), got[1])
                    if not best[0]:
                        break
            if best:
                out.append((item_id, *best))
        return out


def _blocks(items: DataFrame) -> list[DataFrame]:
    """All items (item_id, text) in parts of about MAX_ITEM_CHARS characters at most."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // MAX_ITEM_CHARS) or 1
    return [items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) for block in range(blocks)]


def _shared(block: DataFrame):
    """A block's items as a broadcast."""
    return block.sparkSession.sparkContext.broadcast([(r["item_id"], r["text"]) for r in block.orderBy("item_id", "text").collect()])


#: The matcher that this worker process made last: the tasks of one block share it.
_made: dict[str, Matcher] = {}


def _matcher(shared, name: str, rate: float) -> Matcher:
    if name not in _made:
        _made.clear()
        _made[name] = Matcher(shared.value, rate)
    return _made[name]


def matches(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """doc_id, item_id, edits, and where in the folded text: one row for each document and item that it contains."""
    docs = text_ids(docs).where(F.col("text").isNotNull())
    blocks, out = _blocks(items), None
    for block in blocks:
        shared, name = _shared(block), uuid.uuid4().hex

        def run(batches: Iterator[pd.DataFrame], shared=shared, name=name) -> Iterator[pd.DataFrame]:
            matcher = _matcher(shared, name, rate)
            for pdf in by_chars(batches):
                rows = [(doc, *m) for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True) for m in matcher.find(fold_text(text))]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "edits", "start", "end"])

        found = long_ids(docs.mapInPandas(run, "doc_id string, item_id long, edits int, start int, end int"))
        if len(blocks) > 1:  # what a block has found is written before the next one is read
            found = materialise(found, "decontam-found")
            shared.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The rows of docs, all columns, whose text contains no item. Rows are judged one by one, whatever their ids."""
    blocks, written = _blocks(items), None
    for block in blocks:
        shared, name = _shared(block), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared, name, rate)
            for batch in batches:
                clean = [not (x and matcher.find(fold_text(x))) for x in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if len(blocks) > 1:
            docs, before = materialise(docs, "decontam-kept"), written
            shared.destroy()
            if before is not None:
                discard(before)
            written = docs
    return docs


def query(spark, sf_dir: str) -> DataFrame:
    """op10: all documents against the whole benchmark."""
    found = matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    best = Window.partitionBy("doc_id", "item_id").orderBy("edits", "start")
    return found.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")
