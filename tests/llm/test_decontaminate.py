"""Decontamination against a window-by-window search."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from riskmart.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, N_HIT int"
ITEMS = "item_id long, text string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text, items, window=13):
    words = WORD.findall(lowered(text))
    hit, names = set(), set()
    for item, body in items:
        own = WORD.findall(lowered(body))
        n = min(window, len(own))
        for j in range(len(own) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i:i + n] == own[j:j + n]:
                    hit |= set(range(i, i + n))
                    names.add("" if item is None else str(item))
    return len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def found(docs, items):
    out = decontaminate.marks(docs, items, keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256)).collect()


def test_random_texts(spark):
    rng = random.Random(3)
    vocabulary = ["a", "B", "é", "日本", "x1", "the"]
    say = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(i, say(rng.choice([0, 2, 5, 9, 13, 14, 20, 30]))) for i in range(12)] + [(None, say(15)), (3, say(14)), (4, None)]
    docs = []
    for i in range(120):
        text = say(rng.randint(0, 30)) + (rng.choice(items)[1] or "") + say(rng.randint(0, 20))
        docs.append((i, text, 1))
    docs += [(7, None, 1), (None, "", 1), (7, docs[7][1], 1), (900, say(3000), 1)]
    got = found(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS))
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *brute(t, items))) for i, t, _ in docs)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", 0)], DOCS), spark.createDataFrame([], ITEMS)
    assert [tuple(r)[:4] for r in found(docs, items)] == [(1, 2, 0, 0)]
    assert found(docs.limit(0), items) == []


def test_spans_are_cut(spark):
    body = " ".join(f"w{i}" for i in range(13))
    rest = " ".join(f"r{i}" for i in range(400))
    docs = spark.createDataFrame([(1, f"é {body}. {rest}", 5), (2, body, 5), (3, rest, 5), (4, None, 5)], DOCS)
    kept = decontaminate.without_spans(docs, spark.createDataFrame([(1, body.upper())], ITEMS))
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(1, f"é . {rest}", 5), (3, rest, 5), (4, "", 5)]
