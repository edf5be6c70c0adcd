"""Toxicity by a weighted lexicon: folded text, Aho-Corasick matches, exception phrases, length-normalised score."""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, functions as F

from riskmart.llm.common import bounded_sample, per_text, pick
from riskmart.session import written

#: Labelled rows that the lexicon and the calibration learn from at most: a sample by id hash.
LABELLED_ROWS = 20_000
#: A stem is a beginning of a word with so many letters.
STEMS = range(3, 10)
#: Documents that must show a term before it is considered.
LEAST_DOCUMENTS = 3
LARGEST_WEIGHT = 8.0

# --- fixed values: letters, digits and signs that stand in for a Latin letter -----------------
CYRILLIC = dict(zip("авекмнорстухіјѕьԁһӏ", "abekmhopctyxijsbdhl"))
GREEK = dict(zip("αβεικνορτυχω", "abeikvoptuxw"))
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "|": "i",
         "ı": "i", "ø": "o", "ł": "l", "đ": "d"}
ZERO_WIDTH = "­​‌‍⁠﻿"
# -----------------------------------------------------------------------------------------------


class Folding(dict):
    """Translation table: look-alikes and accents become the plain letter, what is no letter a space.

    ``1`` may stand for i or l, so l folds to i as well."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if c in ZERO_WIDTH or unicodedata.combining(c):
            out = ""
        else:
            plain = unicodedata.normalize("NFKD", c).lower()
            plain = "".join(x for x in plain if not unicodedata.combining(x))
            plain = "".join(CYRILLIC.get(x) or GREEK.get(x) or SIGNS.get(x) or x for x in plain).replace("l", "i")
            out = "".join(x if x.isalnum() else " " for x in plain)
        self[code] = out
        return out


FOLDING = Folding()


def folded(text: str) -> str:
    """The text between spaces, folded; a run of several separators stays one or more spaces."""
    return f" {text.lower().translate(FOLDING)} "


def terms(text: str) -> set[str]:
    """Whole words (with the space after them) and their stems, each after a space."""
    out = set()
    for w in set(folded(text).split()):
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in STEMS if n < len(w))
    return out


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    #: Phrases inside which a term does not count.
    exceptions: list[str] = field(default_factory=list)
    coefficients: tuple[float, ...] = (-3.0, 0.0, 0.0)

    def matcher(self):
        automaton = ahocorasick.Automaton()
        for term, w in self.weights.items():
            automaton.add_word(term, (len(term), w))
        for phrase in self.exceptions:
            automaton.add_word(phrase, (len(phrase), None))
        automaton.make_automaton()
        return automaton

    def scorer(self):
        """Per text: (words, matches that count, their weight)."""
        automaton = self.matcher()

        def score(text: str) -> tuple[int, int, float]:
            plain = re.sub(" {2,}", " ", folded(text))
            n = max(plain.count(" ") - 1, 0)
            if not self.weights:
                return n, 0, 0.0
            found, spared = [], []
            for last, (length, w) in automaton.iter(plain):
                (spared if w is None else found).append((last + 1 - length, last + 1, w))
            if spared:
                spared.sort()
                starts, furthest = [a for a, _, _ in spared], list(accumulate((b for _, b, _ in spared), max))
                # of the phrases that begin no later, the one that reaches furthest decides
                found = [x for x in found if not (k := bisect_right(starts, x[0])) or furthest[k - 1] < x[1]]
            return n, len(found), float(sum(w for _, _, w in found))
        return score


def measures(n_words: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """What the calibration sees: a constant, the total weight, and the weight by length."""
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(100 * weight / (n_words + 20))], 1)


def calibrated(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, ...]:
    """Logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (p - y) + ridge * beta
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(bend, slope)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(beta.tolist())


def _gain(pos: float, neg: float, n_pos: float, n_neg: float) -> float:
    """Log-likelihood ratio of a term that is commoner among the positive documents, else 0."""
    if pos * n_neg <= neg * n_pos:
        return 0.0
    p = (pos + neg) / (n_pos + n_neg)
    part = lambda k, n: (k * math.log(k / n) if k else 0) + ((n - k) * math.log((n - k) / n) if n > k else 0)
    whole = part(pos + neg, n_pos + n_neg) if 0 < p < 1 else 0.0
    return 2 * (part(pos, n_pos) + part(neg, n_neg) - whole)


def choose(counts: dict[str, tuple[int, int]], n_pos: int, n_neg: int) -> dict[str, float]:
    """The terms whose tie to the label is beyond chance among so many, with log odds as weights. Of terms one of
    which begins another, the most telling stays; among equals the longest."""
    limit = 2 * math.log(max(len(counts), 1)) + 6
    ranked = sorted(((_gain(p, n, n_pos, n_neg), len(t), t) for t, (p, n) in counts.items()), reverse=True)
    out: dict[str, float] = {}
    for gain, _, term in ranked:
        if gain <= limit:
            break
        if any(term.startswith(t) or t.startswith(term) for t in out):
            continue
        p, n = counts[term]
        weight = math.log((p + 0.5) / (n_pos + 1)) - math.log((n + 0.5) / (n_neg + 1))
        if weight >= 1:
            out[term] = min(weight, LARGEST_WEIGHT)
    return out


def _counted(rows: DataFrame, make) -> DataFrame:
    """(term, pos, neg): documents per term, summed within each task before the shuffle."""
    def run(batches):
        pos, neg = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                (pos if toxic else neg).update(make(text))
        import pyarrow as pa
        keys = list(pos.keys() | neg.keys())
        for i in range(0, len(keys), 50_000):
            part = keys[i:i + 50_000]
            yield pa.RecordBatch.from_pydict({"term": pa.array(part, pa.string()), "pos": pa.array([pos[k] for k in part], pa.int64()),
                                              "neg": pa.array([neg[k] for k in part], pa.int64())})
    return (rows.mapInArrow(run, "term string, pos long, neg long").groupBy("term")
            .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS) -> DataFrame:
    """(text, toxic) of at most ``limit`` labelled rows; never those whose crc32(doc_id as text) mod 4 is 2."""
    chosen = (pick(labels, doc_id="doc_id", toxic="toxic").where("doc_id is not null and toxic is not null")
              .where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2")
              .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    chosen = bounded_sample(chosen, "doc_id", limit)
    texts = pick(docs, doc_id="doc_id", text="text").where("text is not null")
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS) -> Lexicon:
    """Lexicon, exception phrases and calibration from the labelled rows outside the held-out fourth.

    Without toxic or without other rows the lexicon is empty and the score is the same low one for all."""
    spark = docs.sparkSession
    rows = written(training_rows(docs, labels, limit), "toxicity-sample")  # of bounded size, read by every step
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = sum(n for t, n in sizes.items() if t), sizes.get(0, 0)
    if not n_pos or not n_neg:
        return Lexicon()
    least = max(LEAST_DOCUMENTS, n_pos // 500)
    candidates = {r["term"]: r["pos"] for r in
                  _counted(rows.where("toxic <> 0"), terms).where(F.col("pos") >= least).collect()}
    known = spark.sparkContext.broadcast(frozenset(candidates))
    against = {r["term"]: r["neg"] for r in
               _counted(rows.where("toxic = 0"), lambda text: terms(text) & known.value).collect()}
    lexicon = Lexicon(choose({t: (p, against.get(t, 0)) for t, p in candidates.items()}, n_pos, n_neg))
    if not lexicon.weights:
        return lexicon
    held = spark.sparkContext.broadcast(lexicon)
    near = {r["term"]: (r["pos"], r["neg"]) for r in
            _counted(rows, lambda text: phrases(text, held.value)).where(F.col("neg") >= LEAST_DOCUMENTS).collect()}
    # a phrase that other documents use freely, unlike the term by itself
    lexicon.exceptions = sorted(p for p, (pos, neg) in near.items() if (pos + 0.5) / (n_pos + 1) <= (neg + 0.5) / (n_neg + 1))
    held = spark.sparkContext.broadcast(lexicon)

    def measured(batches):
        import pyarrow as pa
        score = held.value.scorer()
        for batch in batches:
            found = [score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.float64()),
                                              batch.column("toxic")], names=["n", "w", "toxic"])
    seen = rows.mapInArrow(measured, "n long, w double, toxic int").collect()
    x = measures(np.array([r["n"] for r in seen]), np.array([r["w"] for r in seen]))
    lexicon.coefficients = calibrated(x, np.array([float(r["toxic"] != 0) for r in seen]))
    return lexicon


def phrases(text: str, lexicon: Lexicon) -> set[str]:
    """Two-word phrases around the lexicon's terms."""
    words = folded(text).split()
    out = set()
    for i, w in enumerate(words):
        whole = f" {w} "
        if any(whole.startswith(t) for t in (whole, *[f" {w[:n]}" for n in STEMS if n < len(w)]) if t in lexicon.weights):
            out.update(f" {a} {b} " for a, b in ((words[i - 1] if i else "", w), (w, words[i + 1] if i + 1 < len(words) else "")) if a and b)
    return out


def score(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` and score (0 to 1), predicted (score >= 0.3), n_words, n_matches, match_weight.

    The text alone decides. Empty and null texts get the score of a text without matches; equal texts get
    equal scores; each row is scored by itself."""
    held = docs.sparkSession.sparkContext.broadcast(lexicon)

    def work():
        own = held.value.scorer()
        beta = np.array(held.value.coefficients)

        def run(texts):
            found = [own(t.as_py()) for t in texts]
            n, k, w = (np.array(c) for c in zip(*found))
            p = 1 / (1 + np.exp(-np.clip(measures(n, w) @ beta, -30, 30)))
            return p, (p >= 0.3).astype(np.int32), n, k, w
        return run

    return per_text(docs, work, {"score": "double", "predicted": "int", "n_words": "long", "n_matches": "long",
                                 "match_weight": "double"}, text_col, keep)


def accepted(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, their columns as they were."""
    held = docs.sparkSession.sparkContext.broadcast(lexicon)

    def work():
        own = held.value.scorer()
        beta = np.array(held.value.coefficients)

        def run(texts):
            n, _, w = (np.array(c) for c in zip(*[own(t.as_py()) for t in texts]))
            return (1 / (1 + np.exp(-np.clip(measures(n, w) @ beta, -30, 30))) < 0.3,)
        return run

    return per_text(docs, work, {}, text_col, choose=True)
