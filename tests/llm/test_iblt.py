"""Sketches: differences and likeness against counting paragraphs; edited versions against a plain loop."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from riskmart.llm import iblt


def pieces(text):
    return Counter(p for p in re.split(r"\n|(?<=[.!?]) ", text) if p)


def alike(a, b):
    p, q = pieces(a), pieces(b)
    total = sum(p.values()) + sum(q.values())
    return 2 * sum((p & q).values()) / total if total else 1.0


def some(rng, n):
    return "".join(rng.choice(["ab. ", "x y", "\n", "! ", "q", "  ", "é"]) for _ in range(n))


def test_differences_come_back():
    rng = random.Random(1)
    a = [some(rng, rng.randint(0, 60)) for _ in range(300)] + ["", "x\n" * 500, "\n".join(map(str, range(3000)))]
    b = [x if rng.random() < .3 else x[:len(x) // 2] + some(rng, 20) for x in a[:300]] + ["", "", "\n".join(map(str, range(1500, 4000)))]
    one, two = (iblt.paragraph_keys(pa.array(x)) for x in (a, b))
    row, key, sign = iblt.differences(one, two)
    for i in range(len(a)):
        own, other = (set(k[f[i]:f[i + 1]].tolist()) for k, f in (one, two))
        assert set(key[(row == i) & (sign == 1)].tolist()) == own - other
        assert set(key[(row == i) & (sign == -1)].tolist()) == other - own
    assert np.allclose(iblt.likeness(one, two), [alike(x, y) for x, y in zip(a, b)])


def test_edited_versions(spark):
    rng = random.Random(2)
    rows = [(i, some(rng, rng.randint(0, 40))) for i in rng.sample(range(5000), 150)] + [(6000, None), (6001, ""), (-4, "日本. é")]
    docs = spark.createDataFrame([(i, t, 9, 1) for i, t in rows], "doc_id long, text string, edge int, PART int").repartition(3)
    texts = [(i, t or "") for i, t in sorted(rows, reverse=True)]
    want = {}
    for k, (i, t) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        want[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), round(alike(t, edited), 9), round(alike(t, after), 9))
    found = iblt.edited_versions(docs).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in found} == want and len(found) == len(want)
    prints = {r.doc_id: r.fingerprint for r in iblt.fingerprints(docs).collect()}
    assert prints == {r.doc_id: r.fingerprint for r in found}
    assert prints[6000] == prints[6001]
    again = spark.createDataFrame([(r.doc_id, edited_of(texts, r.doc_id)) for r in found], "doc_id long, text string")
    assert {r.doc_id: r.fingerprint for r in iblt.fingerprints(again).collect()} == {r.doc_id: r.edited_fingerprint for r in found}


def edited_of(texts, doc_id):
    k = next(k for k, (i, _) in enumerate(texts) if i == doc_id)
    t, after = texts[k][1], texts[(k + 1) % len(texts)][1]
    return t[:len(t) - len(t) // 2] + after[:len(t) // 2]


def test_few_rows_and_ties(spark):
    schema = "doc_id long, text string"
    assert iblt.edited_versions(spark.createDataFrame([], schema)).collect() == []
    one = iblt.edited_versions(spark.createDataFrame([(1, "abcd")], schema)).collect()
    assert [r.edited_sha256 for r in one] == [hashlib.sha256(b"abab").hexdigest()]
    rows = iblt.edited_versions(spark.createDataFrame([(1, "same"), (1, "same"), (None, "x"), (None, None)], schema)).collect()
    assert len(rows) == 4 and {r.near_next for r in rows if r.doc_id == 1} <= {0.0, 1.0}
