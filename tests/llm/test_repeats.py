"""Substring removal, by bytes and by words, against a search of every window."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from riskmart.llm import repeats, suffix_dedup, suffix_tree


def brute(rows, tokens, length, join):
    """(id, tokens, removed, runs, digest) per row; a null id counts as the largest."""
    size = lambda i: (1 << 63) - 1 if i is None else i
    least = {}
    for i, text in rows:
        own = tokens(text or "")
        for j in range(len(own) - length + 1):
            key = tuple(own[j:j + length])
            least[key] = min(least.get(key, size(i)), size(i))
    out = []
    for i, text in rows:
        own = tokens(text or "")
        gone = [False] * len(own)
        for j in range(len(own) - length + 1):
            if least[tuple(own[j:j + length])] < size(i):
                gone[j:j + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(own), sum(gone), spans, hashlib.sha256(join([x for x, g in zip(own, gone) if not g])).hexdigest()))
    return out


def corpus(seed, sep=""):
    rng = random.Random(seed)
    say = lambda n: sep.join(rng.choice(["ab", "é", "x ", "the", "\n", "日本", "q", "of "]) for _ in range(n))
    pool = [say(rng.randint(20, 120)) for _ in range(12)]
    rows = []
    for i in range(150):
        text = sep.join(rng.choice([say(rng.randint(0, 60)), p, p[rng.randrange(len(p)):], p[:rng.randrange(len(p))]])
                        for p in rng.choices(pool, k=rng.randint(0, 3)))
        rows.append((rng.choice([i, 1000 - i, -i]), text))
    rows += [(None, pool[0]), (None, pool[0]), (None, None), (5, ""), (5, pool[1]), (5, pool[1]), (3, pool[1] * 2)]
    rows += [(2000, "aa" * 3000), (2001, "a" * 700), (1999, " ".join(["of"] * 400)), (2002, " ".join(["of"] * 300))]
    return rows + [(3000 + i, f"{say(3)}{sep}{pool[2]}{sep}{say(2)}") for i in range(200)]  # a passage in many contexts


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, did int, TEXT_KEY string").repartition(5)


def test_bytes(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        got = suffix_dedup.digests(frame(spark, rows)).collect()
        want = brute(rows, lambda t: list(t.encode()), 50, bytes)
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_words(spark):
    for seed in (3, 4):
        rows = corpus(seed, " ")
        got = suffix_tree.digests(frame(spark, rows)).collect()
        want = brute(rows, lambda t: re.findall(r"[^\x20\x09-\x0D]+", t), 13, lambda w: " ".join(w).encode())
        assert sorted(map(str, map(tuple, got))) == sorted(str((a, b, c, e)) for a, b, c, _, e in want)


def test_many_contexts_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 2)
    rows = corpus(5)
    found = repeats._find(suffix_dedup.BYTES, 3)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([9 if i is None else i for i, _ in rows]), pa.array(range(len(rows))),
                                        pa.array([t or "" for _, t in rows])], names=["did", "text_key", "text"])
    kinds = [k for b in found(iter([batch])) for k in b.column("kind").to_pylist()]
    assert repeats._EDGE in kinds and repeats._PACKED in kinds


def batch_of(rows):
    return pa.RecordBatch.from_arrays([pa.array([9 if i is None else i for i, _ in rows]), pa.array(range(len(rows))),
                                       pa.array([t or "" for _, t in rows])], names=["did", "text_key", "text"])


def edges_of(w, parts, buckets):
    """Edges that steps 1 and 2 make of tables of rows, a task each: (row's key, place, gram hash)."""
    found = [b for part in parts for b in repeats._find(w, buckets)(iter([batch_of(part)]))]
    rows = pa.Table.from_batches(found).sort_by("bucket")
    met = pa.Table.from_batches(list(repeats._meet(w, buckets)(iter(rows.to_batches()))))
    edges = [r for r in met.select(["text_key", "kind", "a", "b"]).to_pylist() if r["kind"] == repeats._EDGE]
    return [(r["text_key"], at, g % (1 << 64)) for r in edges for at, g in zip(r["a"], r["b"])]


def test_edges_keep_whole_grams(monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 2)
    for w, sep in ((suffix_dedup.BYTES, ""), (suffix_tree.WORDS, " ")):
        rows = corpus(8, sep)
        edges = edges_of(w, [rows[i::3] for i in range(3)], 7)
        raw, first = w.tokens(pa.array([t or "" for _, t in rows]))
        _, every, _ = repeats.anchors(w, raw, first)
        assert {g for _, _, g in edges} <= set(every.tolist())
        to = np.bincount(repeats._bucket(np.unique(np.array([g for _, _, g in edges], np.uint64)), 7), minlength=7)
        assert to.min() > 0 and to.max() < 0.4 * to.sum()


def test_many_contexts_over_several_tasks(spark, monkeypatch):
    for name, value in (("HOT", 3), ("HELD_ANCHORS", 50), ("HELD_CONTEXTS", 1 << 12), ("BLOCK", 1 << 11)):
        monkeypatch.setattr(repeats, name, value)
    for seed in (9, 10):
        rows = corpus(seed)
        got = suffix_dedup.digests(frame(spark, rows)).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows, lambda t: list(t.encode()), 50, bytes)))
        rows = corpus(seed, " ")
        got = suffix_tree.digests(frame(spark, rows)).collect()
        want = brute(rows, lambda t: re.findall(r"[^\x20\x09-\x0D]+", t), 13, lambda w: " ".join(w).encode())
        assert sorted(map(str, map(tuple, got))) == sorted(str((a, b, c, e)) for a, b, c, _, e in want)


def test_copies_in_one_document_meet_a_smaller_one_elsewhere(spark):
    rng = random.Random(11)
    for digests, sep, want in (
            (suffix_dedup.digests, "", lambda rows: brute(rows, lambda t: list(t.encode()), 50, bytes)),
            (suffix_tree.digests, " ", lambda rows: [(a, b, c, e) for a, b, c, _, e in brute(rows, str.split, 13, lambda w: " ".join(w).encode())])):
        passage = sep.join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40))
        often = sep.join([passage] * (repeats.HOT + 36))
        for rows in ([(5, often), (3, passage)], [(5, often), (3, passage), (7, passage), (2, "x"), (4, often)]):
            docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(len(rows), "doc_id")
            got = digests(docs).collect()
            assert sorted(map(tuple, got)) == sorted(want(rows))


def test_suffix_sort():
    rng = random.Random(6)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    raw = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.array(list(map(len, strings)))
    begin = np.cumsum(sizes) - sizes
    at = np.array([rng.randrange(n) for n in sizes])
    order, agreed = suffix_dedup.sorted_suffixes(raw, begin, sizes, begin + at, sizes - at, np.zeros(300, np.int64), 64)
    own = [strings[k][at[k]:] for k in order]
    assert own == sorted(own)
    of = np.array([rng.randrange(9) for _ in at])
    split, _ = suffix_dedup.sorted_suffixes(raw, begin, sizes, begin + at, sizes - at, of, 64)
    assert [(of[k], strings[k][at[k]:]) for k in split] == sorted((g, s[a:]) for g, s, a in zip(of, strings, at))
    assert agreed.tolist() == [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(own, own[1:])]


def test_partitions_split_large_prefixes_only():
    rng = random.Random(7)
    raw = np.array([rng.randrange(3) for _ in range(4000)], np.uint64)
    start = np.arange(3900)
    groups = list(suffix_tree.partitions(raw, start, 13, most=200))
    assert sorted(np.concatenate(groups).tolist()) == start.tolist() and max(map(len, groups)) <= 200
    owner = {int(s): k for k, g in enumerate(groups) for s in g}
    words = {}
    for s in start.tolist():
        words.setdefault(tuple(raw[s:s + 13]), set()).add(owner[s])
    assert all(len(x) == 1 for x in words.values())


def test_empty_tables_and_texts_cut(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.digests(empty).collect() == [] and suffix_tree.digests(empty).collect() == []
    body = "é" * 30
    docs = spark.createDataFrame([(1, body, 4), (2, f"a{body}b", 4), (3, None, 4)], "doc_id long, text string, n_chars int")
    assert sorted(map(tuple, suffix_dedup.cleaned(docs).collect())) == [(1, body, 30), (2, "ab", 2), (3, "", 0)]
    assert [r.kept for r in suffix_dedup.removed(docs, keep=["doc_id"]).orderBy("doc_id").collect()] == [body.encode(), b"ab", b""]
