"""Near duplicates against all pairs; components against a union-find."""

import random
import re

import numpy as np

from riskmart.llm import jaccard_join
from riskmart.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def roots(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        parent[root(a)] = root(b)
    return [root(i) for i in range(n)]


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    at = roots(len(rows), links)
    least = {}
    for (i, _), r in zip(rows, at):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [(i, len(s), (least.get(r) if s else i)) for (i, _), s, r in zip(rows, sets, at)]


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "Of", "é"]) if rng.random() < 0.3 else f"w{rng.randrange(4000)}"
    bases = [[word() for _ in range(rng.choice([3, 5, 6, 9, 30, 80, 200]))] for _ in range(40)]
    line = [word() for _ in range(12)]
    rows = []
    for i in range(320):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
            at = rng.randrange(len(words) + 1)
            words[at:at + rng.randint(0, 2)] = [word() for _ in range(rng.randint(0, 2))]
        if rng.random() < 0.3:
            words += line
        rows.append((1000 - i if i % 3 else i, rng.choice([" ", "\n", "  "]).join(words)))
    # a chain of small steps whose ends are not alike
    chain = [f"c{k}" for k in range(60)]
    for i in range(30):
        rows.append((2000 + i, " ".join(chain)))
        chain = chain[2:] + [f"d{i}", f"e{i}"]
    return rows + [(None, rows[0][1]), (None, "alone here"), (5, None), (6, ""), (7, " \n"), (7, " \n"), (8, rows[3][1]), (8, rows[3][1])]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, node int, DID string").repartition(4)


def test_components_of_all_pairs(spark):
    for seed in (1, 2, 3):
        rows = corpus(seed)
        got = jaccard_join.labelled(frame(spark, rows)).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows)))


def test_pairs_of_different_components_are_compared(spark, monkeypatch):
    """Without any link from leaders, the fragments' counts alone must find every pair."""
    rows = corpus(4)
    whole, calls = jaccard_join._linked, []

    def linked(pairs, sets):
        calls.append(pairs)
        return whole(pairs, sets).where("false") if len(calls) == 1 else whole(pairs, sets)
    monkeypatch.setattr(jaccard_join, "_linked", linked)
    got = jaccard_join.labelled(frame(spark, rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows)))


def test_one_row_stays(spark):
    rows = corpus(5)
    docs = frame(spark, rows)
    kept = jaccard_join.deduplicated(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    want = brute(rows)
    groups = {("", c) if n else ("x", k) for k, (_, n, c) in enumerate(want)}
    assert len(got) == len(groups)
    assert sorted(i for i, t in got if shingles(t) and i is not None) == sorted({c for _, n, c in want if n and c is not None})


def variants(n, seed):
    """Texts that differ from one text of 200 words in five words each: about 0.59 alike, so hardly any two are linked."""
    rng = random.Random(seed)
    base = [f"t{k}" for k in range(200)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(200), 5):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    return rows


def test_rows_made_grow_with_the_entries_of_a_template(spark, monkeypatch):
    made, whole = {}, jaccard_join.written

    def counted(df, label):
        out = whole(df, label)
        made.setdefault(label, []).append(out.count())
        return out
    monkeypatch.setattr(jaccard_join, "written", counted)
    for n in (100, 200, 400):
        made.clear()
        rows = variants(n, n)
        got = jaccard_join.labelled(frame(spark, rows)).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows)))
        assert max(x for counts in made.values() for x in counts) <= 16 * n + 100, made  # 8 fragments and 2 rows a node
        assert made["ngram-open"][0] <= n


def test_bitmaps_bound_overlaps():
    rng = random.Random(3)
    for _ in range(300):
        pool = [rng.getrandbits(64) for _ in range(rng.choice([3, 50, 900, 6000]))]
        a, b = (np.array(sorted(rng.sample(pool, rng.randint(1, len(pool)))), np.uint64) for _ in range(2))
        x, y = (np.frombuffer(jaccard_join.bitmap(s), np.uint64) for s in (a, b))
        assert len(np.intersect1d(a, b)) <= (len(a) + len(b) - int(np.bitwise_count(x ^ y).sum())) // 2


def test_very_long_texts(spark):
    rng = random.Random(9)
    long = [f"w{rng.randrange(50000)}" for _ in range(30000)]
    near = [w if rng.random() > 0.02 else "new" for w in long]
    rows = [(3, " ".join(long)), (2, " ".join(near)), (1, " ".join(long[:12000])), (4, "a " * 20000)]
    got = jaccard_join.labelled(frame(spark, rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows)))


def test_empty_table(spark):
    assert jaccard_join.labelled(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(400 + i, 401 + i) for i in range(40)] + [(500, 500)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    at = roots(600, links)
    nodes = sorted({x for p in links for x in p})
    assert sorted(got) == nodes
    assert len({(at[x], got[x]) for x in nodes}) == len({at[x] for x in nodes}) == len(set(got.values()))
