"""Quality grades by cumulative-link regression: one weight vector over hashed text, ordered thresholds."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskmart.llm.common import LOWER, SPACES, bounded_sample, byte_codes, per_text, pick, stream, word_bounds, word_hashes

#: Labelled rows that the regression is fitted on at most: a sample by id hash.
LABELLED_ROWS = 8_000
#: Weights for words, and for each measure of a text's shape as many as it has steps.
WORD_WEIGHTS, STEPS = 1 << 14, 12
SHAPES = ("length", "distinct", "repeated", "upper", "digits", "signs", "lines", "word_length")


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, value, first entry of each text): words by their share, shapes as one step each."""
    data, bounds = stream(texts)
    lower = LOWER[data]
    begin, end, first = word_bounds(lower, bounds, ~SPACES)
    n, rows = np.diff(first), np.repeat(np.arange(len(first) - 1), np.diff(first))
    hashes = word_hashes(lower, begin, end, byte_codes(11))
    per = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds])
    size = np.maximum(np.diff(bounds), 1)
    order = np.lexsort((hashes, rows))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(rows[order]) != 0) | (hashes[order][1:] != hashes[order][:-1])
    distinct = np.bincount(rows[order][fresh], minlength=len(n))
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    words = np.maximum(n, 1)
    shape = {"length": np.log2(words) / 16, "distinct": distinct / words,
             "repeated": np.bincount(rows[again], minlength=len(n)) / words,
             "upper": per((data >= 65) & (data <= 90)) / size, "digits": 4 * per((data >= 48) & (data <= 57)) / size,
             "signs": 2 * per(((data >= 33) & (data <= 47)) | ((data >= 58) & (data <= 64)) | (data >= 123) & (data < 127)) / size,
             "lines": 20 * per(data == 10) / size,
             "word_length": np.bincount(rows, end - begin, minlength=len(n)) / words / 16}
    index, value, owner = [], [], []
    buckets = (hashes >> np.uint64(50)).astype(np.int64)
    counts = np.bincount(rows * WORD_WEIGHTS + buckets) if len(n) * WORD_WEIGHTS < 1 << 24 else None
    if counts is None:
        keys, c = np.unique(rows * WORD_WEIGHTS + buckets, return_counts=True)
    else:
        keys = np.flatnonzero(counts)
        c = counts[keys]
    index.append(keys % WORD_WEIGHTS)
    owner.append(keys // WORD_WEIGHTS)
    value.append(np.sqrt(c / words[owner[0]]))
    for i, name in enumerate(SHAPES):
        step = np.clip((shape[name] * STEPS).astype(np.int64), 0, STEPS - 1)
        index.append(WORD_WEIGHTS + i * STEPS + step)
        owner.append(np.arange(len(n)))
        value.append(np.ones(len(n)))
    index, value, owner = map(np.concatenate, (index, value, owner))
    order = np.argsort(owner, kind="stable")
    return index[order], value[order], np.searchsorted(owner[order], np.arange(len(n) + 1))


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades

    def tails(self, lean: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k; falls with k, as the thresholds rise."""
        return 1 / (1 + np.exp(-np.clip(lean[:, None] - self.thresholds[None, :], -30, 30)))


def fit_rows(index: np.ndarray, value: np.ndarray, first: np.ndarray, grade: np.ndarray, grades: int,
             ridge: float = 2e-3, steps: int = 300) -> Ordinal:
    """Maximum penalised likelihood by Adam over all rows. Thresholds are a start and positive gaps, so they stay
    ordered whatever the weights are."""
    n, size = len(grade), WORD_WEIGHTS + len(SHAPES) * STEPS
    owner = np.repeat(np.arange(n), np.diff(first))
    share = np.clip([np.mean(grade > k) for k in range(grades - 1)], 1e-3, 1 - 1e-3) if n else np.full(grades - 1, .5)
    start = -np.log(share / (1 - share))
    param = np.concatenate([np.zeros(size), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(param), np.zeros_like(param)
    for t in range(1, steps + 1) if n else ():
        w, gaps = param[:size], np.exp(param[size + 1:])
        theta = param[size] + np.concatenate([[0], np.cumsum(gaps)])
        lean = np.bincount(owner, w[index] * value, minlength=n)
        edge = np.concatenate([[-40.0], theta, [40.0]])
        cdf = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        low, high = cdf(edge[grade] - lean), cdf(edge[grade + 1] - lean)
        p = np.maximum(high - low, 1e-12)
        d_low, d_high = low * (1 - low) / p / n, high * (1 - high) / p / n  # of -log p: +d_low at the lower edge, -d_high
        slope = np.zeros_like(param)
        slope[:size] = np.bincount(index, value * (d_high - d_low)[owner], minlength=size) + ridge * w / 10
        at_edge = np.bincount(grade, d_low, minlength=grades + 1)[:grades + 1] - np.bincount(grade + 1, d_high, minlength=grades + 1)
        d_theta = at_edge[1:grades]
        slope[size] = d_theta.sum()
        slope[size + 1:] = gaps * np.cumsum(d_theta[::-1])[::-1][1:]
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope ** 2
        param = param - 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    gaps = np.exp(param[size + 1:])
    return Ordinal(param[:size], param[size] + np.concatenate([[0], np.cumsum(gaps)]))


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from the two marks: 0 poor, 1 good but toxic, 2 good. That order is an assumption: the labels hold
    no graded ratings, and a good text that is toxic is taken to be worth more than a poor one and less than a clean one.
    Rows without id or quality are left out; of several rows of an id the lowest grade counts."""
    found = pick(labels, doc_id="doc_id", quality="quality", toxic="toxic").where("doc_id is not null and quality is not null")
    return (found.selectExpr("doc_id", "case when quality = 0 then 0 when coalesce(toxic, 0) <> 0 then 1 else 2 end grade")
            .groupBy("doc_id").agg(F.min("grade").alias("grade")))


def fit(docs: DataFrame, ratings: DataFrame, grades: int = 3, limit: int = LABELLED_ROWS) -> Ordinal:
    """Fit on at most ``limit`` rated rows (doc_id, grade); without any, all weights are 0. Null ids match nothing, a rating
    counts for each row of its id, and columns beside ids and texts are not looked at."""
    chosen = bounded_sample(ratings, "doc_id", limit)
    rows = pick(docs, doc_id="doc_id", text="text").join(F.broadcast(chosen), "doc_id").select("text", "grade")

    def run(batches):
        for batch in batches:
            texts = batch.column("text").fill_null("")
            index, value, first = features(texts)
            cut = first[1:-1]
            yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array([x.tobytes() for x in np.split(index.astype("<i4"), cut)], pa.binary()),
                                              pa.array([x.tobytes() for x in np.split(value.astype("<f4"), cut)], pa.binary())],
                                             names=["grade", "i", "v"])
    seen = rows.mapInArrow(run, "grade int, i binary, v binary").collect()
    index = np.frombuffer(b"".join(bytes(r["i"]) for r in seen), "<i4").astype(np.int64)
    value = np.frombuffer(b"".join(bytes(r["v"]) for r in seen), "<f4").astype(np.float64)
    first = np.concatenate([[0], np.cumsum([len(r["i"]) // 4 for r in seen])]).astype(np.int64)
    return fit_rows(index, value, first, np.array([r["grade"] for r in seen], np.int64), grades)


def grade(docs: DataFrame, model: Ordinal, least: int | None = None, probability: float = 0.5, text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """``keep`` and expected_grade, tails (P(grade > k) for each k), selected (P(grade >= least) >= probability).

    Empty and null texts have no words and get what their shape alone gives; equal texts get equal grades."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    least = len(model.thresholds) if least is None else least

    def work():
        own = held.value

        def run(texts):
            index, value, first = features(texts)
            lean = np.add.reduceat(own.weights[index] * value, first[:-1])
            tails = own.tails(lean)
            return tails.sum(1), tails.tolist(), tails[:, least - 1] >= probability
        return run

    return per_text(docs, work, {"expected_grade": "double", "tails": "array<double>", "selected": "boolean"}, text_col, keep)
