"""Periodic runs against a search of every period at every place."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest

from riskmart.llm import runs
from riskmart.llm.queries import planted

DOCS = "doc_id long, text string, RUNS string, n_words int"


def brute(words, least_words=6, least_periods=4):
    """(start, length, period): for each period ascending the maximal stretches no smaller period has."""
    n, known = len(words), {}
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least_words, least_periods * q):
                known.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in known.items())


def collapse(words, found):
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def say(rng, n, names):
    return [rng.choice(names) for _ in range(n)]


def texts(rng):
    for _ in range(150):
        out = []
        for _ in range(rng.randint(0, 6)):
            piece = say(rng, rng.randint(1, 12), ["a", "b", "é"][:rng.randint(1, 3)])
            out += piece * rng.randint(1, 9) + piece[:rng.randint(0, len(piece))] + say(rng, rng.randint(0, 5), ["x", "y", "a"])
        yield out


def test_tiles_against_brute_force():
    rng = random.Random(5)
    for words in texts(rng):
        hashes = np.array([hash(w) & (1 << 62) - 1 | 1 for w in words], np.uint64)
        found = runs._fragments(hashes, np.array([0, len(words)]), lambda _: [w.encode() for w in words])
        held = {(f["start"], f["stop"] - f["start"], f["period"]) for f in found.get(0, [])}
        for start, length, period in brute(words):
            if length < 64 * period:  # within one group of tiles, or part of it
                assert any(p == period and s >= start and s + n <= start + length for s, n, p in held)


@pytest.mark.parametrize("span", [1, 2, 64])
def test_random_texts(spark, monkeypatch, span):
    monkeypatch.setattr(runs, "SPAN", span)
    rng = random.Random(7)
    rows = [(i, (rng.choice([" ", "\n", " \t "])).join(w), "x", 1) for i, w in enumerate(texts(rng))]
    rows += [(None, "a a a a a a", "x", 1), (3, rows[3][1], "x", 1), (3, rows[3][1], "x", 1), (500, None, "x", 1), (501, " \n", "x", 1),
             (502, " ".join("word" for _ in range(3000)), "x", 1),
             (503, " ".join(f"w{k % 700}" for k in range(2900)), "x", 1), (504, "a a " * 9, "x", 1)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = runs.collapsed(docs).collect()
    want = []
    for i, text, *_ in rows:
        words = [w for w in (text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
        found = brute(words)
        want.append((i, len(words), found, collapse(words, found)))
    assert sorted(map(str, [(r.doc_id, r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.kept) for r in got])) == sorted(map(str, want))
    if span == 64:
        shown = {r.doc_id: r for r in runs.digests(docs).collect()}
        for i, _, found, kept in want:
            r = shown[i]
            assert r.n_runs == len(found)
            assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
            assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
            best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
            assert (r.start, r.length, r.period) == best
            assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)


def test_edited_order(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(say(rng, rng.randint(0, 90), [f"w{k}" for k in range(40)])), "", 0) for i in range(120)]
    got = {r.doc_id: r for r in runs.collapsed(spark.createDataFrame(rows, DOCS), edit=planted).collect()}
    held = 0
    for i, text, *_ in rows:
        words = text.split()
        order = planted(i, len(words))
        words = words if order is None else [words[k] for k in order]
        found = brute(words)
        held += len(found)
        assert [(x.start, x.length, x.period) for x in got[i].runs] == found
        assert got[i].kept == collapse(words, found)
    assert held


def test_long_text_in_linear_time(spark):
    rows = [(1, "a " * 60000, "", 0), (2, " ".join(f"w{k % 9001}" for k in range(45000)), "", 0)]
    got = {r.doc_id: r for r in runs.digests(spark.createDataFrame(rows, DOCS)).collect()}
    assert (got[1].start, got[1].length, got[1].period, got[1].n_runs) == (0, 60000, 1, 1)
    assert (got[2].start, got[2].length, got[2].period, got[2].exponent_milli) == (0, 45000, 9001, 4999)


def test_limits_and_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert runs.digests(docs).collect() == []
    with pytest.raises(ValueError):
        runs.collapsed(docs, least_periods=3)
    five = runs.collapsed(spark.createDataFrame([(1, "a b " * 4 + "c", "", 0)], DOCS), least_periods=5).collect()[0]
    assert five.runs == [] and five.kept == "a b " * 4 + "c"
