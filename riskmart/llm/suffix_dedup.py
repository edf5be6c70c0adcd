"""Byte-level removal of repeated substrings by a hash-compared suffix sort."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskmart.llm.common import byte_codes, powers, stream
from riskmart.llm.repeats import Windows, cut_texts, leaders, runs

LENGTH, GRAM = 50, 24


class Suffixes:
    """Suffixes of short strings that lie one after another in ``raw``; they end with their string.

    Prefix polynomial hashes (powers count from each string's begin) tell whether two stretches are equal, so binary
    search finds how far two suffixes agree, and the byte after that compares them."""

    def __init__(self, raw: np.ndarray, begin: np.ndarray, sizes: np.ndarray, codes: np.ndarray, most: int) -> None:
        self.raw, self.steps = raw, int(most).bit_length()
        up, self.down = powers(int(sizes.max(initial=0)) + 1)
        self.prefix, self.local = np.zeros(len(raw) + 1, np.uint64), np.zeros(len(raw) + 1, np.uint16)
        step = 1 << 11  # strings at a time, as a frequent gram may bring very many
        for lo in range(0, len(begin), step):
            b, n = begin[lo:lo + step], sizes[lo:lo + step]
            a, z = int(b[0]), int(b[-1] + n[-1])
            local = np.arange(a, z) - np.repeat(b, n)
            self.local[a:z] = local
            np.cumsum(codes[raw[a:z]] * up[local], out=self.prefix[a + 1:z + 1])
            self.prefix[a + 1:z + 1] += self.prefix[a]

    def agree(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at i and j, ``most`` at most."""
        prefix, low, high = self.prefix, np.zeros(len(i), np.int64), most.copy()
        at_i, at_j, scale_i, scale_j = prefix[i], prefix[j], self.down[self.local[i]], self.down[self.local[j]]
        for _ in range(self.steps):
            mid = (low + high + 1) >> 1
            same = (prefix[i + mid] - at_i) * scale_i == (prefix[j + mid] - at_j) * scale_j
            low = np.where(same, mid, low)
            high = np.where(same, high, np.maximum(mid - 1, low))
        return low

    def beyond(self, i: np.ndarray, j: np.ndarray, size_i: np.ndarray, size_j: np.ndarray) -> np.ndarray:
        """Negative, 0 or positive as the suffix at i is less than, equal to or greater than that at j."""
        most = np.minimum(size_i, size_j)
        agreed = self.agree(i, j, most)
        whole = agreed == most
        last = len(self.raw) - 1
        a = self.raw[np.minimum(i + agreed, last)].astype(np.int64)
        b = self.raw[np.minimum(j + agreed, last)].astype(np.int64)
        return np.where(whole, size_i - size_j, a - b)

    def sort(self, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes within each group: mergesort from the bottom, in which every suffix finds its rank in
        the other run of its pair by binary search. Groups done drop out."""
        order, width = np.argsort(group, kind="stable"), 1
        fresh = runs(group[order]) if len(order) else np.zeros(0, bool)
        first = np.flatnonzero(fresh)
        total = np.diff(np.append(first, len(order)))
        first, total = np.repeat(first, total), np.repeat(total, total)
        every = np.flatnonzero(total > 1)
        while len(every):
            base = first[every] + (every - first[every]) // (2 * width) * (2 * width)
            stop = first[every] + total[every]
            mid, end = np.minimum(base + width, stop), np.minimum(base + 2 * width, stop)
            second = every >= mid
            low, high = np.where(second, base, mid), np.where(second, mid, end)
            other = low.copy()
            open_ = np.flatnonzero(low < high)
            while len(open_):
                at = (low[open_] + high[open_]) >> 1
                x, y = order[every[open_]], order[at]
                diff = self.beyond(start[x], start[y], size[x], size[y])
                after = np.where(second[open_], diff >= 0, diff > 0)  # equal ones keep their order
                low[open_] = np.where(after, at + 1, low[open_])
                high[open_] = np.where(after, high[open_], at)
                open_ = open_[low[open_] < high[open_]]
            place = every - np.where(second, mid, base) + low - other + base
            merged = order.copy()
            merged[place] = order[every]
            order, width = merged, width * 2
            every = np.flatnonzero(total > width)
        return order

    def neighbours(self, start: np.ndarray, size: np.ndarray, order: np.ndarray, group: np.ndarray) -> np.ndarray | None:
        """Common extension of each suffix with the next in order, -1 across groups; None if a hash collision shows in
        the bytes."""
        i, j = start[order[:-1]], start[order[1:]]
        same = group[order[:-1]] == group[order[1:]]
        agreed = np.full(len(i), -1)
        agreed[same] = self.agree(i[same], j[same], np.minimum(size[order[:-1]], size[order[1:]])[same])
        for lo in range(0, len(i), 1 << 16):
            n = np.maximum(agreed[lo:lo + (1 << 16)], 0)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            if (self.raw[np.repeat(i[lo:lo + (1 << 16)], n) + step] != self.raw[np.repeat(j[lo:lo + (1 << 16)], n) + step]).any():
                return None
        return agreed


def sorted_suffixes(raw: np.ndarray, begin: np.ndarray, sizes: np.ndarray, start: np.ndarray, length: np.ndarray,
                    group: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common extension with the next) within groups, with other codes as long as a collision shows."""
    seed = 31
    while True:
        suffixes = Suffixes(raw, begin, sizes, byte_codes(seed), most)
        order = suffixes.sort(start, length, group)
        agreed = suffixes.neighbours(start, length, order, group)
        if agreed is not None:
            return order, agreed
        seed += 1


def settle(raw: np.ndarray, begin: np.ndarray, left: np.ndarray, end: np.ndarray, did: np.ndarray, group: np.ndarray,
           length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(context, offset) of each window, ``offset`` bytes left of its context's anchor, that a smaller document has.

    Two suffix sorts, rightward from the anchors and leftward from them, among the contexts of each gram, and the extensions
    between neighbours cut the contexts into classes at each depth; a window is the same in two contexts if they share its class rightward at
    ``length - offset`` and leftward at ``offset``."""
    n = len(begin)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    group = np.unique(group, return_inverse=True)[1]
    total, size, anchor = len(raw), end - begin, begin + left
    room = np.minimum(end - anchor, length)
    right, agreed_right = sorted_suffixes(raw, begin, size, anchor, room, group, length)
    backward, agreed_left = sorted_suffixes(raw[::-1].copy(), (total - end)[::-1], size[::-1], total - anchor, left, group, length)
    by_id = np.argsort(did, kind="stable")
    which, offsets = [], []
    to_right, to_left = np.empty(n, np.int64), np.empty(n, np.int64)
    for offset in range(length - gram + 1):
        to_right[right] = np.concatenate([[0], np.cumsum(agreed_right < length - offset)])
        to_left[backward] = np.concatenate([[0], np.cumsum(agreed_left < offset)])
        valid = by_id[((left >= offset) & (room >= length - offset))[by_id]]
        key = to_right[valid] * (n + 1) + to_left[valid]
        order = np.argsort(key, kind="stable")
        own = did[valid[order]]
        later = own > leaders(own, runs(key[order])) if len(own) else np.zeros(0, bool)
        which.append(valid[order][later])
        offsets.append(np.full(later.sum(), offset))
    return np.concatenate(which), np.concatenate(offsets)


def _codes(raw: np.ndarray) -> np.ndarray:
    return byte_codes(17)[raw]


BYTES = Windows(LENGTH, GRAM, stream, _codes, "u1", settle)


def _counted(raw: np.ndarray, first: np.ndarray, gone: np.ndarray, shown) -> tuple:
    """Per text: bytes, bytes removed, maximal removed runs, and what ``shown`` makes of the bytes kept."""
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    at = first[:-1][first[:-1] < len(gone)]
    begins[at] = gone[at]  # a run ends with its text
    begun, lost = (np.concatenate([[0], np.cumsum(x)]) for x in (begins, gone))
    kept = [shown(raw[a:b].tobytes() if lost[a] == lost[b] else raw[a:b][~gone[a:b]].tobytes()) for a, b in zip(first[:-1], first[1:])]
    return np.diff(first), lost[first[1:]] - lost[first[:-1]], begun[first[1:]] - begun[first[:-1]], kept


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` and n_bytes, n_removed, n_spans, kept (the remaining bytes).

    A byte goes if a 50-byte string over it also starts in a document with a smaller id, judged on the input.
    Null and empty texts have no bytes; texts under 50 bytes never lose any; of repeated rows with one id, and of rows
    whose ids are null, none loses to another; a null id counts as larger than all others."""
    return cut_texts(docs, BYTES, lambda texts, raw, first, gone: _counted(raw, first, gone, bytes),
                     {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept": "binary"}, id_col, text_col, keep)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    def make(texts, raw, first, gone):
        return _counted(raw, first, gone, lambda kept: hashlib.sha256(kept).hexdigest())
    return cut_texts(docs, BYTES, make, {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string"}, keep=["doc_id"])


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The same columns; from the texts the repeated bytes are cut, and what is left of a character cut apart. The number
    of characters follows where there is such a column."""
    extra = {text_col: "string"} | ({length_col: "long"} if length_col in docs.columns else {})

    def make(texts, raw, first, gone):
        kept = _counted(raw, first, gone, lambda x: x.decode("utf-8", "ignore"))[-1]
        return kept, [len(t) for t in kept]
    out = cut_texts(docs, BYTES, make, extra, id_col, text_col)
    if length_col not in docs.columns or dict(docs.dtypes)[length_col] == "bigint":
        return out
    at = docs.columns.index(length_col)  # back to the type it had
    inner = out.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return inner.withColumn(f"c{at}", F.col(f"c{at}").cast(docs.schema[at].dataType)).toDF(*docs.columns)
