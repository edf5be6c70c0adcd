"""Toxicity: folding, exceptions, held-out rows, edge cases."""

import random
import zlib

from riskmart.llm import toxicity


def corpus(seed=1, n=1200):
    rng = random.Random(seed)
    clean = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}ord" for i in range(200)]
    rows = []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.randint(1, 3)):
                bad = rng.choice(["vilename", "grimlox" + rng.choice(["ing", "ed", "er", "s"])])
                bad = rng.choice([bad, bad, bad.upper(), bad.replace("i", "1").replace("e", "3"), bad.replace("e", "е").replace("o", "ο"), bad[:3] + "​" + bad[3:]])
                words.insert(rng.randrange(len(words) + 1), bad + rng.choice(["", ",", "!"]))
        elif rng.random() < 0.1:
            at = rng.randrange(len(words))
            words[at:at] = ["saint", "vilename"]
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, 0.5, 7) for i, t, _ in rows], "doc_id long, text string, score double, Text int")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_folding():
    assert toxicity.folded("1D10T, ïdіot​!").split() == ["idiot", "idiot"]
    assert toxicity.folded("CL0WN $cum").split() == ["ciown", "scum"]


def test_matcher_against_a_plain_scan():
    """Every place of every term by string comparison, without those inside a phrase of the exceptions."""
    rng = random.Random(3)
    words = ["ab", "abc", "bad", "bader", "saint", "b", "c"]
    for _ in range(300):
        weights = {t: rng.random() for t in rng.sample([f" {w} " for w in words] + [f" {w}" for w in ("ba", "abc", "b")], 4)}
        phrases = [f" {a} {b} " for a, b in rng.sample([(a, b) for a in words for b in words], rng.randint(0, 3))]
        lexicon = toxicity.Lexicon(weights, phrases)
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))
        plain = f" {text} " if text else " "
        inside = [(i, i + len(p)) for p in phrases for i in range(len(plain)) if plain.startswith(p, i)]
        want = [w for t, w in weights.items() for i in range(len(plain)) if plain.startswith(t, i)
                and not any(a <= i and i + len(t) <= b for a, b in inside)]
        n, hits, weight = lexicon.scorer()(text)
        assert (n, hits) == (len(text.split()), len(want)) and abs(weight - sum(want)) < 1e-9


def test_score_is_the_calibrated_measure(spark):
    """Scores of whole frames against the plain formula over a plain count."""
    import math
    lexicon = toxicity.Lexicon({" bad ": 2.0, " wors": 1.5}, [" not bad "], (-2.0, 0.7, 0.4))
    texts = ["bad", "not bad at all", "worst bad day", "", None, "fine " * 300 + "bad", "not bad bad"]
    counted = {"bad": (1, 2.0), "not bad at all": (4, 0.0), "worst bad day": (3, 3.5), "": (0, 0.0), None: (0, 0.0),
               "fine " * 300 + "bad": (301, 2.0), "not bad bad": (3, 2.0)}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in toxicity.score(docs, lexicon, keep=["doc_id"]).collect():
        n, w = counted[texts[r.doc_id]]
        p = 1 / (1 + math.exp(-(-2.0 + 0.7 * math.log1p(w) + 0.4 * math.log1p(100 * w / (n + 20)))))
        assert abs(r.score - p) < 1e-12 and r.predicted == (p >= 0.3) and r.n_words == n


def test_held_out_rows(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    lexicon = toxicity.fit(docs, labels)
    assert " viiename " in lexicon.weights and any(" grimiox".startswith(t) or t.startswith(" grimiox") for t in lexicon.weights)
    assert " saint viiename " in lexicon.exceptions
    got = {r.doc_id: r for r in toxicity.score(docs, lexicon, keep=["doc_id"]).collect()}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 200
    assert sum(got[i].predicted == y for i, y in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_held_out_labels_are_not_used(spark):
    rows = corpus(2, 400)
    docs, labels = frames(spark, rows)
    turned = labels.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - toxic, toxic) toxic")
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, turned)


def test_edges(spark):
    docs, labels = frames(spark, corpus(3, 300))
    lexicon = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(None, "vilename vilename"), (1, None), (1, ""), (2, "vilename " * 20000), (2, "a" * 300000)], "doc_id long, text string")
    got = toxicity.score(odd, lexicon, keep=["doc_id"]).collect()
    assert [r.predicted for r in got] == [1, 0, 0, 1, 0] and got[1].score == got[2].score
    assert toxicity.score(odd.limit(0), lexicon).collect() == []
    assert toxicity.fit(docs.limit(0), labels) == toxicity.Lexicon() == toxicity.fit(docs, labels.limit(0))
    kept = toxicity.accepted(docs.union(docs.limit(1)), lexicon)
    assert kept.columns == docs.columns
    bad = {r.doc_id for r in toxicity.score(docs, lexicon, keep=["doc_id"]).where("predicted = 1").collect()}
    left = {r[0] for r in kept.collect()}
    assert bad and not bad & left and len(left) == 300 - len(bad)
