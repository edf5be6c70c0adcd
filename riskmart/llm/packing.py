"""Packing of token sequences: best fit over vectors of capacities, planned on counts per length and dealt out by rank."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskmart.llm.common import blocks, documents
from riskmart.llm.word_pieces import vocabulary
from riskmart.session import written


@dataclass(frozen=True)
class Bins:
    """Capacities of a sequence: tokens, documents, and the sum of squared lengths, which is what attention within
    documents costs. ``rule`` is ``norm`` (least weighted norm of what stays free) or ``dot`` (greatest weighted product
    of demand and what is free); ``weights`` belong to the three capacities, each taken as a share of its size."""

    tokens: int = 4096
    documents: int | None = None
    attention: int | None = None
    rule: str = "norm"
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)

    @property
    def sizes(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens ** 2], np.int64)


class _Open:
    """Bins with room, as ranges of neighbours with equal contents: what is used, the first bin, how many."""

    def __init__(self) -> None:
        self.used, self.first, self.many, self.n = np.zeros((64, 3), np.int64), np.zeros(64, np.int64), np.zeros(64, np.int64), 0

    def add(self, used: np.ndarray, first: int, many: int) -> None:
        if self.n == len(self.many):
            self.used, self.first, self.many = (np.concatenate([a, np.zeros_like(a)]) for a in (self.used, self.first, self.many))
        self.used[self.n], self.first[self.n], self.many[self.n] = used, first, many
        self.n += 1

    def drop_empty(self) -> None:
        live = np.flatnonzero(self.many[:self.n])
        for a in (self.used, self.first, self.many):
            a[:len(live)] = a[live]
        self.n = len(live)

    def take(self, at: int, bins: int) -> None:
        self.first[at] += bins
        self.many[at] -= bins

    def best(self, demand: np.ndarray, sizes: np.ndarray, weights: np.ndarray, rule: str) -> int | None:
        """The entry that the rule likes best of those with room for ``demand``; the first bins on a tie."""
        free = sizes - self.used[:self.n]
        fits = np.flatnonzero((self.many[:self.n] > 0) & (free >= demand).all(axis=1))
        if not len(fits):
            return None
        left = free[fits] / sizes
        if rule == "norm":
            cost = ((left - demand / sizes) ** 2) @ weights
        else:
            cost = -(left * (demand / sizes)) @ weights
        return int(fits[np.lexsort((self.first[fits], cost))[0]])


def plan(counts: dict[int, int], bins: Bins) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from_rank, upto_rank, first_bin, per_bin, offset): piece number ``r`` of its length, ``from_rank`` <= r <
    ``upto_rank``, goes to bin ``first_bin + (r - from_rank) div per_bin``, behind ``offset`` tokens and earlier ones.

    Longest pieces first, each to the bin that the rule likes best among those with room in every capacity, a new one if
    there is none. Bins of equal contents are one entry, and equal pieces go to them at one stroke, as they would one by
    one: by the norm a bin that has taken a piece is liked best until it is full; by the product the next of its kind is.
    So work and memory depend on the number of lengths, not of pieces."""
    if bins.rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {bins.rule}")
    sizes, weights = bins.sizes, np.array(bins.weights, float)
    out, open_, opened = [], _Open(), 0
    for length in sorted(counts, reverse=True):
        demand, left, rank = np.array([length, 1, length * length], np.int64), counts[length], 0
        if left and (length < 1 or (demand > sizes).any()):
            raise ValueError(f"a piece of {length} tokens exceeds a capacity")
        open_.drop_empty()
        while left:
            at = open_.best(demand, sizes, weights, bins.rule)
            if at is None:
                used, first, each = np.zeros(3, np.int64), opened, int((sizes // demand).min())
                have = -(-left // each)
                opened += have
            else:
                used, first, have = open_.used[at].copy(), int(open_.first[at]), int(open_.many[at])
                each = int(((sizes - used) // demand).min()) if bins.rule == "norm" else 1
            whole = min(have, left // each)
            rest = left - whole * each if whole < have else 0
            if at is not None:
                open_.take(at, whole + (rest > 0))
            for taken, pieces in ((whole, each), (int(rest > 0), rest)):
                if taken:
                    out.append((length, rank, rank + taken * pieces, first, pieces, int(used[0])))
                    open_.add(used + pieces * demand, first, taken)
                    first, rank, left = first + taken, rank + taken * pieces, left - taken * pieces
    return out


def pieces(docs: DataFrame, tokenizer: str, longest: int, id_col: str = "doc_id", text_col: str = "text",
           end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, ids): the tokens of every whole text and ``end_id``, in pieces of ``longest`` tokens but the last.

    A null text is the empty one, which is a single ``end_id``. Rows are independent of each other; null ids, ties and
    equal rows give their own pieces; further columns are ignored. The vocabulary file is read on the driver and broadcast."""
    return _pieces(docs, tokenizer, longest, id_col, text_col, end_id, "ids array<int>", lambda ids: ids.astype(np.int32))


def _pieces(docs, tokenizer, longest, id_col, text_col, end_id, column, shape) -> DataFrame:
    with open(tokenizer, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        words = vocabulary(content.value)
        for block in blocks(batches):
            ids, bounds = words.encode(block.column("text").combine_chunks())
            rows = []
            for doc_id, low, high in zip(block.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                own = np.append(ids[low:high], end_id)
                rows += [(doc_id, k, start, min(longest, len(own) - start), shape(own[start:start + longest]))
                         for k, start in enumerate(range(0, len(own), longest))]
            kind = pa.list_(pa.int32()) if column.endswith("array<int>") else pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), [pa.int64(), pa.int32(), pa.int64(), pa.int64(), kind])],
                names=["doc_id", "piece", "start", "length", column.split()[0]])

    return documents(docs, id_col, text_col).mapInArrow(run, f"doc_id long, piece int, start long, length long, {column}")


def packed(parts: DataFrame, bins: Bins = Bins()) -> DataFrame:
    """The rows of ``parts`` with ``sequence_id`` and ``offset``: which sequence takes the row's ``length`` tokens, and where.

    Sequences are numbered from 0 without gaps, and so are the tokens of each. A length that exceeds a capacity, is null or
    below 1 is an error. Rows may be equal; those of one length are interchangeable. Of all the input the driver gets one
    count per length and partition of the sort, and the plan has some entries per length (there are at most
    ``bins.tokens`` lengths), so it is broadcast. Ranks within a length come from a sort by ranges, so a length that a
    third of all rows has is spread like any other."""
    rows = written(parts.select("*", F.monotonically_increasing_id().alias("uid")), "packing-pieces")
    if not rows.where(f"length is null or length < 1 or length > {bins.tokens}").isEmpty():
        raise ValueError(f"lengths must be from 1 to {bins.tokens}")
    sorted_ = written(rows.repartitionByRange("length", "uid").sortWithinPartitions("length", "uid").select(
        "*", F.monotonically_increasing_id().alias("place")).drop("uid"), "packing-order")
    part = F.shiftright("place", 33)
    found = sorted_.groupBy(part.alias("part"), "length").agg(F.count("*").alias("n"), F.min("place").alias("place")).collect()
    counts: dict[int, int] = {}
    starts = []
    for r in sorted(found, key=lambda r: (r.part, r.length)):
        starts.append((r.part, r.length, r.place - counts.get(r.length, 0)))
        counts[r.length] = counts.get(r.length, 0) + r.n
    spark = rows.sparkSession
    ranks = spark.createDataFrame(starts, "part long, length long, base long")
    steps = spark.createDataFrame(plan(counts, bins), "length long, low long, high long, first long, per_bin long, used long")
    ranked = sorted_.withColumn("part", part).join(F.broadcast(ranks), ["part", "length"]).withColumn("rank", F.expr("place - base"))
    placed = ranked.join(F.broadcast(steps), "length").where("rank >= low and rank < high")
    return placed.select(*parts.columns, F.expr("first + (rank - low) div per_bin").alias("sequence_id"),
                         F.expr("used + (rank - low) % per_bin * length").alias("offset"))


def digests(docs: DataFrame, tokenizer: str, bins: Bins = Bins(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): as ``pieces`` and ``packed``, with a checksum for the ids."""
    return packed(_pieces(docs, tokenizer, bins.tokens, id_col, text_col, 1, "ids_crc32 long",
                          lambda ids: zlib.crc32(ids.astype("<u4").tobytes())), bins)
