"""Byte-level BPE against the public library, and an exact round trip."""

import random

import numpy as np
import pytest

from riskmart.llm import bpe

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def coders():
    with open(PATH, "rb") as f:
        content = f.read()
    ranks = bpe.read_ranks(content)
    return bpe.coder(content, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_random_texts(coders):
    own, other = coders
    rng = random.Random(1)
    parts = ["a", "b", "e", "the", "é", "ñ", " ", "  ", "\n", "\t", "1", "23", "'s", "!!", "Ω", "日本", "😀", "\x1c", "\x85", "\xa0", "ing",
             "tion", "ß", "́", "²", "x" * 5, "<|endoftext|>"]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        ids = own.encode(text)
        assert ids_of(ids) == other.encode_ordinary(text), repr(text)
        assert own.decode(ids).decode() == text


def test_long_runs(coders):
    own, other = coders
    for text in ("a" * 5000, "ab" * 3000, " " * 4000, "\n" * 3000 + "x", "é" * 2000, "aé" * 1500):
        assert ids_of(own.encode(text)) == other.encode_ordinary(text)


def test_small_store(coders, monkeypatch):
    own, other = coders
    monkeypatch.setattr(bpe, "KEPT", 3)
    text = " ".join(f"word{i} word{i % 3}" for i in range(50))
    assert ids_of(own.encode(text)) == other.encode_ordinary(text)


def test_other_patterns(coders):
    """Matches that run over spaces: texts are not cut there."""
    ranks = coders[0].ranks
    rng = random.Random(2)
    for pattern in (r"\S+ \S+|\s|\S+", r"[a-z ]+|.", r"\s*\S+|\s+"):
        own, other = bpe.Coder(ranks, pattern), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for _ in range(60):
            text = " ".join(rng.choice(["the", "a", "word", "é", "12", ""]) for _ in range(rng.randint(0, 9)))
            assert ids_of(own.encode(text)) == other.encode_ordinary(text), (pattern, text)


def test_long_segments_are_not_kept(coders):
    own, other = coders
    text = " ".join("x1-" * 3000 + str(i) for i in range(5))
    before = len(own.segments)
    assert ids_of(own.encode(text)) == other.encode_ordinary(text) and len(own.segments) == before
    assert bpe.CUTS_AT_SPACES == P.PATTERN


def test_frames(spark, coders):
    rows = [(1, "Ab, cd  ef"), (None, "Ab, cd  ef"), (2, None), (2, ""), (3, "日本 語")]
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, DECODED string, ids int")
    got = bpe.encode(docs, PATH, P.PATTERN).collect()
    want = [(i, coders[1].encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    assert sorted(map(str, [(r.doc_id, r.ids, bytes(r.decoded)) for r in got])) == sorted(map(str, want))
    assert bpe.encode_digests(docs, PATH, P.PATTERN).where("n_tokens = 0").count() == 2
    assert bpe.encode_digests(docs.limit(0), PATH, P.PATTERN).collect() == []
