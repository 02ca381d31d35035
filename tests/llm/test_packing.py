from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sieveworks.llm import packing


@pytest.fixture(scope="module")
def encoder():
    return packing.WordEncoder(packing.vocabulary())


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t.,!?'\"-abcXYZéßİΣς日本1２½́ 　<|>"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_are_the_tokenizer_s(encoder, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_special_strings(encoder):
    for text in ("a<|endoftext|>b", "it's don't we'll x'", "End. <|startoftext|> Go!"):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 19), max_size=60))
def test_plan_places_every_item_once(lengths):
    bins = packing.best_two_fit(np.array(lengths, np.int64), 20)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 20 for b in bins)
    assert len(bins) <= max(1, 2 * sum(lengths) // 20 + 1)


def test_two_replace_the_smallest():
    lengths = [12, 6, 5, 3, 14]  # greedy would fill 14 + 6, then 12 + 5 + 3; all is full
    assert len(packing.best_two_fit(np.array(lengths), 20)) == 2
    assert sorted(map(len, packing.best_two_fit(np.array([10, 7, 6, 4, 13]), 20))) == [2, 3]


def test_pack(spark, encoder):
    texts = [None, "", "word " * 5000, "short one", "short one", "x"] + [f"some words number {i} " * (i % 40) for i in range(150)]
    df = spark.createDataFrame([(i % 154, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, piece string")
    rows = packing.pack(packing.pieces(df, packing.vocabulary()), block=50).toPandas()
    ids = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    assert rows["length"].sum() == sum(map(len, ids))
    for _, bin_ in rows.groupby("sequence_id"):
        bin_ = bin_.sort_values("offset")
        assert bin_["length"].sum() <= 2048 and bin_["offset"].tolist() == [0, *bin_["length"].cumsum()[:-1]]
    one = rows[rows.doc_id == 2].sort_values("piece")
    assert one["length"].tolist() == [2048, 2048, 905] and one["start"].tolist() == [0, 2048, 4096]
    assert one["ids_crc32"].tolist()[0] == zlib.crc32(np.array(ids[2][:2048], "<u4").tobytes())
    assert rows.sequence_id.nunique() <= rows["length"].sum() / 2048 * 1.1 + 4
    assert packing.pack(packing.pieces(df.where("doc_id < 0"), packing.vocabulary())).count() == 0
