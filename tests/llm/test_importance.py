"""Importance resampling against plain sums and sorts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from riskmart.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, SCORE int, rank string"


def grams(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    found = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), Counter(zlib.crc32(f.encode()) % 10000 for f in found)


def brute(rows, target, share=25, least=20):
    s, t = Counter(), Counter()
    for _, text in rows:
        s += grams(text)[1]
    for text in target:
        t += grams(text)[1]
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    out = []
    for i, text in rows:
        n_words, counts = grams(text)
        n = sum(counts.values())
        weight = sum(gain[b] * c for b, c in counts.items()) // n if n else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n_words, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    line = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, r in enumerate(line[:share * len(line) // 100], 1):
        r[5] = place
    return out


def test_checksums():
    rng = random.Random(1)
    words = [bytes(rng.choice(b"abz09\xc3\xa9") for _ in range(rng.choice([1, 2, 3, 7, 63, 64, 65, 66, 200]))) for _ in range(400)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    begin = np.cumsum(size + 1) - size - 1
    follows = np.array([k % 5 > 0 for k in range(len(words))])
    one, two = importance.checksums(data, begin, begin + size, follows)
    assert one.tolist() == [zlib.crc32(w) for w in words]
    assert two.tolist() == [zlib.crc32(a + b" " + b) for k, (a, b) in enumerate(zip(words, words[1:]), 1) if k % 5]


def test_planes_are_exact():
    rng = np.random.default_rng(3)
    for low, high in ((-30000, 30000), (-5, 1), (0, 3), (-1, 0), (7, 8)):
        gain = rng.integers(low, high, 777)
        counts = rng.integers(0, 5, (40, 777)) * rng.integers(0, 900, (40, 777)) // 300
        counts[3] = 0
        counts[4, 5] = 70000
        assert importance.weighed(counts.astype(np.int32), importance.gain_planes(gain)).tolist() == (counts @ gain).tolist()


def test_random_texts(spark):
    rng = random.Random(4)
    names = [f"w{k}" for k in range(300)] + ["é", "Ünï", "x" * 90, "A1"]
    say = lambda n: rng.choice([" ", ", ", "--"]).join(rng.choice(names) for _ in range(n))
    rows = [(i, say(rng.randint(0, 80))) for i in range(300)] + [(None, say(30)), (None, say(30)), (7, None), (8, ""), (900, say(9000))]
    rows += [(1000 + k % 3, rows[0][1]) for k in range(9)]
    target = [say(40) for _ in range(20)] + [None]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], DOCS).repartition(5)
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = importance.resampled(docs, goal)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    got, want = [tuple(r) for r in got.collect()], [tuple(r) for r in brute(rows, target)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    ranks = sorted(r[5] for r in got if r[5])
    assert ranks == list(range(1, len(ranks) + 1))


def test_one_score_over_many_rows(spark):
    text = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(None, text, 0, "")] * 400 + [(5, text, 0, "")] * 100, DOCS).repartition(7)
    got = importance.resampled(docs, docs.limit(1)).collect()
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert ranks == list(range(1, 126))


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", 0, "")], DOCS), spark.createDataFrame([], "text string")
    assert [(r.n_features, r["rank"]) for r in importance.resampled(docs, items).collect()] == [(3, None)]
    assert importance.resampled(docs.limit(0), items).collect() == []
