"""Packing against a bin-by-bin best fit, and pieces against the public library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskmart.llm import packing
from riskmart.llm.packing import Bins
from riskmart.llm.word_pieces import Vocabulary, vocabulary

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def words():
    with open(PATH, encoding="utf-8") as f:
        return vocabulary(f.read())


def one_by_one(lengths, bins):
    """Bins as lists of lengths: each piece alone, longest first, to the bin the rule likes best."""
    sizes, weights, out = bins.sizes, np.array(bins.weights, float), []
    for n in sorted(lengths, reverse=True):
        demand, best = np.array([n, 1, n * n]), None
        for k, b in enumerate(out):
            free = sizes - np.array([sum(b), len(b), sum(x * x for x in b)])
            if (free >= demand).all():
                left = free / sizes
                cost = ((left - demand / sizes) ** 2) @ weights if bins.rule == "norm" else -(left * (demand / sizes)) @ weights
                if best is None or cost < best[0] - 1e-12:
                    best = cost, k
        if best is None:
            out.append([n])
        else:
            out[best[1]].append(n)
    return out


def filled(counts, bins):
    """Bins as lists of (offset, length) by the plan."""
    out = defaultdict(list)
    for length, low, high, first, per_bin, used in packing.plan(counts, bins):
        for rank in range(low, high):
            out[first + (rank - low) // per_bin].append((used + (rank - low) % per_bin * length, length))
    return out


@pytest.mark.parametrize("bins", [Bins(100), Bins(100, rule="dot"), Bins(100, documents=3), Bins(100, attention=2500, weights=(1, 0, 2)),
                                  Bins(100, documents=5, attention=4000, rule="dot", weights=(1, 1, 3))])
def test_plan_is_best_fit(bins):
    rng = random.Random(11)
    for _ in range(40):
        top = int(min(100, (bins.attention or 10000) ** 0.5))
        lengths = [rng.choice([rng.randint(1, top), 7, 25, top]) for _ in range(rng.randint(0, 120))]
        got = filled(Counter(lengths), bins)
        assert sorted(got) == list(range(len(got)))
        for own in got.values():
            own.sort()
            assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
            own = [n for _, n in own]
            assert (np.array([sum(own), len(own), sum(n * n for n in own)]) <= bins.sizes).all()
        assert sorted(n for own in got.values() for _, n in own) == sorted(lengths)
        assert sorted(sorted(n for _, n in own) for own in got.values()) == sorted(map(sorted, one_by_one(lengths, bins)))


def test_plan_of_very_many_pieces():
    rng = random.Random(3)
    counts = {n: rng.randint(1, 10 ** 9) for n in range(1, 4097)}
    steps = packing.plan(counts, Bins())
    total = sum(n * c for n, c in counts.items())
    bins = max(first + -(-(high - low) // per) for _, low, high, first, per, _ in steps)
    assert len(steps) < 5 * 4096 and bins <= 1.01 * total / 4096 + 1


def test_limits():
    with pytest.raises(ValueError):
        packing.plan({11: 1}, Bins(100, attention=100))
    with pytest.raises(ValueError):
        packing.plan({11: 1}, Bins(100, rule="first"))
    assert packing.plan({}, Bins()) == []


def test_ids_are_the_library_s(words):
    rng = random.Random(1)
    parts = ["a", "B", "é", "É", "œ", "Œ", "İ", "the", "'s", "'S", "'t", "'re", "'ll", "'", "''", "...", "12", "3", " ", "  ", "\n", "\t",
             "\x85", "\xa0", "\x1c", "ß", "ſ", "×", "÷", "Σ", "日本", "😀", "é", "́", "<|endoftext|>", "<|", "||", "x" * 70, "=" * 80,
             "don", "ve", "l", "ǆ", "ǅ", "ŉ", "²", "½", "ª", "Ÿ", "I", "ı", "\r\n", "\x7f", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    for _ in range(2):  # the second time all pieces are known
        ids, bounds = words.encode(pa.array(texts))
        for i, e in enumerate(words.library.encode_batch(texts, add_special_tokens=False)):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == e.ids, repr(texts[i])


def test_small_store(words, monkeypatch):
    monkeypatch.setattr("riskmart.llm.word_pieces.KEPT", 5)
    own = Vocabulary(words.library.to_str())
    for text in ("one two three four", "five six seven", "one two é", "", "   "):
        ids, _ = own.encode(pa.array([text]))
        assert ids.tolist() == words.library.encode(text, add_special_tokens=False).ids


def test_frames(spark, words):
    rng = random.Random(6)
    say = lambda n: " ".join(rng.choice(["alpha", "be", "gamma's", "12", "é"]) for _ in range(n))
    rows = [(i, say(rng.choice([1, 3, 20, 60]))) for i in range(200)] + [(None, say(5)), (3, None), (3, ""), (4, say(900)), (4, say(900))]
    rows += [(900 + k, rows[0][1]) for k in range(60)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, LENGTH int, offset int").repartition(6)
    bins = Bins(64)
    got = packing.digests(docs, PATH, bins).collect()
    want = []
    for i, text in rows:
        ids = [*words.library.encode(text or "", add_special_tokens=False).ids, 1]
        want += [(i, k, s, len(ids[s:s + 64]), zlib.crc32(np.array(ids[s:s + 64], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 64))]
    assert sorted(map(str, [tuple(r)[:5] for r in got])) == sorted(map(str, want))
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 64
    plain = one_by_one([r.length for r in got], bins)
    assert len(sequences) == len(plain)
    whole = packing.pieces(docs, PATH, 64)
    assert whole.where(F.size("ids") != F.col("length")).isEmpty() and whole.count() == len(want)
    assert packing.digests(docs.limit(0), PATH, bins).collect() == []


def test_bad_lengths(spark):
    for n in (0, 65, None):
        with pytest.raises(ValueError):
            packing.packed(spark.createDataFrame([(1, n)], "doc_id long, length long"), Bins(64))
