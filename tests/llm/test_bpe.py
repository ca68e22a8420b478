import hashlib
import os

import numpy as np
import pytest

from ebbtide.llm import bpe

from .fixtures import empty, odd_rows, table

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")
HARD = ["aaaa aaaa" * 40, "\x1c x\x85y   \n\n z ", " don't I'LL 12345 ٣٤ 漢字かな 😀😀  \t\r\n", "x" * 5000, "<|endoftext|>"]


@pytest.fixture(scope="module")
def codec():
    return bpe.public_codec()


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def test_as_the_library(codec, library):
    memo = bpe._Memo(codec)
    for text in HARD + [t or "" for _, t, _ in odd_rows()]:
        ids = np.frombuffer(codec.encode(text, memo), "<u4").tolist()
        assert ids == library.encode_ordinary(text)
        assert codec.decode(codec.encode(text, memo)) == text.encode()


def test_hypothesis(codec, library):
    from hypothesis import given, settings, strategies as st

    memo = bpe._Memo(codec)

    @settings(max_examples=200, deadline=None)
    @given(st.text(st.characters(codec="utf-8", max_codepoint=0x2FFF)))
    def check(text):
        assert np.frombuffer(codec.encode(text, memo), "<u4").tolist() == library.encode_ordinary(text)

    check()


def test_perfect_hash():
    keys = [os.urandom(6) for _ in range(3000)]
    h = bpe.PerfectHash(keys)
    assert sorted(h.slot(k) for k in keys) == list(range(len(keys)))
    assert [h.slot(k) for k in keys] == h.slot_of.tolist()


def test_forgets_when_full(codec, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    memo = bpe._Memo(codec)
    assert codec.decode(codec.encode("one two three four five six seven", memo)) == b"one two three four five six seven"
    assert len(memo) <= 3


def test_operators(spark, codec, library):
    rows = odd_rows() + [(100 + i, t, None) for i, t in enumerate(HARD)]
    docs = table(spark, rows)
    want = sorted(
        (
            str(i),
            len(ids := library.encode_ordinary(t or "")),
            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((t or "").encode()).hexdigest(),
        )
        for i, t, _ in rows
    )
    got = bpe.round_trip(docs, codec).collect()
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in got) == want
    encoded = bpe.encode(docs, codec)
    assert sorted((str(r["doc_id"]), bytes(r["bytes"]).decode()) for r in bpe.decode(encoded, codec).collect()) == sorted(
        (str(i), t or "") for i, t, _ in rows
    )
    assert bpe.round_trip(empty(spark), codec).collect() == []
