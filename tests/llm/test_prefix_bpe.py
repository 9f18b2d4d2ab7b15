"""Rank-based byte-level BPE against the tiktoken library."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF
from martloom.llm import prefix_bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, ids string, n_tokens string"


@pytest.fixture(scope="module")
def mine():
    return prefix_bpe.RankEncoder(PATH)


@pytest.fixture(scope="module")
def library(mine):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=mine.ranks, special_tokens={})


def _encoded(mine, texts):
    flat, ends = mine.encode_texts(pa.array(texts, pa.string()))
    return [flat[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]


ODD = [
    "", " ", None, "a  b \n\n c\t d  x <|endoftext|>", "\x1c\x1d a\x85b   c", "日本語 😀 don't I'LL we'll", "x" * 3000, "  \n  \n", " a", "a ",
    "a\n b", "a \nb", "a　 b", " " * 500, "é" * 50, "'S's 'T", "aaaaaaaaaaaaaaaaaaa", "12345 67.8e9\r\n\r\n", "​﻿ ​",
]


def test_odd_texts(mine, library):
    assert _encoded(mine, ODD) == [library.encode_ordinary(t or "") for t in ODD]


def test_every_letter(mine, library):
    every = [c for c in [*range(0x3400), *range(0xA000, 0x11000), *range(0x1F000, 0x20000)] if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}x" for c in every[i : i + 200]) for i in range(0, len(every), 200)]
    assert _encoded(mine, texts) == [library.encode_ordinary(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.text("ab c\n\t'séd<=- 日", max_size=40)), max_size=6))
def test_any_texts(texts):
    one = prefix_bpe.encoder(PATH)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=one.ranks, special_tokens={})
    assert _encoded(one, texts) == [library.encode_ordinary(t) for t in texts]


def test_tokens_side_by_side(mine, library):
    make = random.Random(0)
    tokens = list(mine.ranks)
    texts = [b"".join(make.choice(tokens) for _ in range(6)).decode("utf-8", "replace") for _ in range(5_000)]
    assert _encoded(mine, texts) == [library.encode_ordinary(t) for t in texts]


def test_a_very_long_word(mine, library):
    make = random.Random(1)
    text = "".join(make.choices("abcdefghijklmnop", k=300_000))
    assert _encoded(mine, [text]) == [library.encode_ordinary(text)]


def test_appends_and_edits(mine):
    one_match = tiktoken.Encoding("one", pat_str=r"(?s).+", mergeable_ranks=mine.ranks, special_tokens={})
    make, made, whole = random.Random(2), 0, 0
    for _ in range(60):
        text = "".join(make.choices("abcdeéth in=-", k=make.randrange(900)))
        table = prefix_bpe.PrefixTable(mine, text.encode())
        for _ in range(5):
            i = make.randrange(len(text) + 1)
            j, new = min(len(text), i + make.randrange(9)), "".join(make.choices("abdé-=", k=make.randrange(9)))
            made += table.replace(len(text[:i].encode()), len(text[:j].encode()), new.encode())
            text = text[:i] + new + text[j:]
            whole += len(text.encode())
            assert table.ids() == one_match.encode_ordinary(text)
        table.append(b"tail of it")
        assert table.ids() == one_match.encode_ordinary(text + "tail of it")
        size = len(text.encode()) // 2
        assert b"".join(mine.tokens[i] for i in table.ids(size)) == table.raw[:size]
    assert made < whole


def test_remembered_parts_are_bounded(mine, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "CACHE_BYTES", 2_000)
    monkeypatch.setattr(prefix_bpe, "PAIRS", 50)
    texts = [[f"word{i}x{j} more" for j in range(20)] for i in range(20)]
    found = [_encoded(mine, t) for t in texts]
    assert len(mine._seen) < 200 and found[0] == _encoded(mine, texts[0])
    mine.forget()
    assert not mine._seen and found[7] == _encoded(mine, texts[7])


def test_query_equals_the_library(spark, library):
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.op11_prefix_bpe(spark, SF).collect()
    assert len(found) == len(rows)
    for r in found:
        ids = library.encode_ordinary(rows[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(rows[r["doc_id"]].encode()).hexdigest()


def test_rows_and_columns(spark, library):
    rows = [(i, t, "old", "x") for i, t in enumerate(ODD)] + [(None, "a", None, None), (1, " ", None, None), (None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    coded = prefix_bpe.decode(prefix_bpe.encode(docs, PATH), PATH)
    assert sorted(coded.columns) == ["decoded", "doc_id", "ids", "n_tokens", "text"]
    for r in coded.collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    assert sorted(str(r[0]) for r in prefix_bpe.rank_digests(docs, PATH).collect()) == sorted(str(r[0]) for r in rows)
    assert prefix_bpe.rank_digests(docs.limit(0), PATH).collect() == []
