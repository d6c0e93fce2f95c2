"""Encoding, decoding and packing beside the libraries themselves."""

import zlib

import brute
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickloom.llm import packing, queries, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = [
    "", " ", "  two  spaces ", "a b", "it's the dog's, we'll see\n\n\tthere  ", "naïve çédille 𝒳 👩‍👩‍👧 نص", "<|endoftext|> x", "x" * 3000,
    " lead", "trail ", "a b  c\x1cd\x85e", "1234 5.6e7 #$%^", "\n\n\n", "word\n next", "ab " * 4000,
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, None, "y"), (3, "a b", None), (3, "a b", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)


def test_digests(docs, library):
    got = sorted((tuple(r) for r in tokens.token_digests(docs, PATH, PATTERN).collect()), key=repr)
    want = []
    for r in docs.collect():
        ids = library(r.text or "")
        want.append((r.doc_id, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(r.text or "")))
    assert got == sorted(want, key=repr)


def test_all_characters(library):
    encoder = tokens.Encoder(PATH, PATTERN)
    for begin in range(0, 0x110000, 1 << 14):
        text = " ".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in range(begin, begin + (1 << 14), 7) if not 0xD800 <= c < 0xE000)
        assert encoder.encode(text).tolist() == library(text)


def test_packing_ids_are_the_library_s(library):
    encoder = packing._encoder(RANKS, PATTERN)
    for text in TEXTS:
        assert encoder.encode_to_numpy(text, disallowed_special=()).tolist() == library(text)


def test_offsets_cover_the_text(docs):
    for r in tokens.encode(docs, PATH, PATTERN, offsets=True).where("doc_id is not null and doc_id <> 3").collect():
        text = TEXTS[r.doc_id]
        assert len(r.starts) == len(r.ids) == len(r.ends)
        if text:
            assert r.starts[0] == 0 and r.ends[-1] == len(text)
            assert all(b in (e, e - 1) for b, e in zip(r.starts[1:], r.ends))  # a character may be split


def test_decoding_unknown_and_split(spark):
    df = spark.createDataFrame([(1, [None, 99_999_999, -5, 64]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: (bytes(r.decoded), r.decoded_text) for r in tokens.decode(df, PATH, characters=True).collect()}
    one = tokens.vocabulary(PATH)[64]
    assert got == {1: (one, one.decode()), 2: (b"", ""), 3: (b"", "")}


def test_cache_is_bounded(monkeypatch, library):
    monkeypatch.setattr(tokens, "HELD_PIECES", 10)
    encoder = tokens.Encoder(PATH, PATTERN)
    text = " ".join(f"word{i % 37}" for i in range(500))
    assert encoder.encode(text).tolist() == library(text)
    assert len(encoder.spaced) <= 10


def check(rows, texts, library, capacity=2048):
    frame = pd.DataFrame([r.asDict() for r in rows])
    for doc, part in frame.groupby("doc_id"):
        ids = np.array([*library(texts[doc]), 1], "<u4")
        at = 0
        for r in part.sort_values("start").itertuples():
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for _, part in frame.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *part.length.cumsum()[:-1]] and part.length.sum() <= capacity


def test_packing(spark, library):
    texts = {i: t for i, t in enumerate(TEXTS)} | {100 + i: "short text" for i in range(50)}
    df = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, length int").repartition(4)
    got = packing.pack(packing.pieces_of(df, RANKS, PATTERN)).collect()
    check(got, texts, library)
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)


def test_packing_query_with_added_tokens(spark, tmp_path):
    """The query's ids are those of the library as its file sets it up, also where added tokens stand."""
    token = "<|endoftext|>"
    texts = dict(enumerate([*TEXTS, token, f"a {token} b", f"{token}{token}  x\n{token}", f"<|endof{token}text|>", f"don{token}'t"]))
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    unaltered = Tokenizer.from_file(PATH)
    got = queries.op9_packing(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == set(texts)
    check(got, texts, lambda text: unaltered.encode(text, add_special_tokens=False).ids)


def test_packing_nulls_and_none(spark):
    df = spark.createDataFrame([(None, None), (1, None), (1, None)], "doc_id long, text string")
    got = packing.pack(packing.pieces_of(df, RANKS, PATTERN)).collect()
    assert [(r.length, r.doc_tokens) for r in got] == [(1, 1)] * 3 and {r.offset for r in got} == {0, 1, 2}
    assert packing.pack(packing.pieces_of(df.limit(0), RANKS, PATTERN)).count() == 0


def test_plan_holds_the_histogram():
    rng = np.random.default_rng(2)
    for _ in range(20):
        capacity = int(rng.choice([16, 100, 2048]))
        histogram = {int(n): int(c) for n, c in zip(rng.integers(1, capacity + 1, 40), rng.integers(1, 5000, 40))}
        packs = packing.plan_packs(histogram, capacity)
        used = {}
        for count, pattern in packs:
            assert count > 0 and sum(n * t for n, t in pattern.items()) <= capacity
            for n, t in pattern.items():
                used[n] = used.get(n, 0) + count * t
        assert used == histogram
    assert packing.plan_packs({100: 40}, 2048) == [(2, {100: 20})]
