"""Benchmark decontamination: texts stream through a generalised suffix automaton of the test items."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskmart.llm.common import (ALNUM, LOWER, byte_codes, per_text, pick, prefix_hash, span_hash, stream, word_bounds,
                                 word_hashes)

WINDOW = 13
#: Bytes of item text that one automaton takes; more items are dealt to further automata.
AUTOMATON_BYTES = 8 << 20


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, begin and end (bytes) of each word of the block, and each text's first word."""
    data, bounds = stream(texts)
    data = LOWER[data]
    begin, end, first = word_bounds(data, bounds, ALNUM)
    return word_hashes(data, begin, end, byte_codes()), begin, end, first


class Automaton:
    """Every run of words of the items is a path from the root; ``window`` words matched make a hit, fewer only
    where they are a whole shorter item."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int = WINDOW) -> None:
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[str]] = [set()]     # items with a prefix that ends here
        shortest = window
        for item, words in items:
            if not words:
                continue
            state = 0
            for w in words:
                state = self._extend(state, w)
                self.ends[state].add(item)
            shortest = min(shortest, len(words))
        self.below: list[list[int]] = [[] for _ in self.link]
        for state, up in enumerate(self.link):
            if up >= 0:
                self.below[up].append(state)
        self.whole: dict[int, dict[int, set[str]]] = {}  # state -> length -> short items that are this run
        for item, words in items:
            if 0 < len(words) < window:
                state = 0
                for w in words:
                    state = self.next[state][w]
                self.whole.setdefault(state, {}).setdefault(len(words), set()).add(item)
        self.nearest = [-1] * len(self.link)  # the first state upwards, itself included, that ends short items
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            up = self.link[state]
            self.nearest[state] = state if state in self.whole else self.nearest[up] if up >= 0 else -1
        self._items: dict[int, frozenset[str]] = {}
        #: hashes of all runs of as many words as the shortest hit has: what a text must hold to be streamed
        self.gram = shortest
        self.grams = [span_hash(prefix_hash(np.array(words, np.uint64)), i, i + shortest)
                      for _, words in items if len(words) >= shortest
                      for i in [np.arange(len(words) - shortest + 1)]]
        self.grams = np.unique(np.concatenate(self.grams)) if self.grams else np.zeros(0, np.uint64)
        self.sieve = np.zeros(1 << max(16, len(self.grams).bit_length() + 4), bool)
        self.sieve[self.grams & np.uint64(len(self.sieve) - 1)] = True

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, state: int, word: int) -> int:
        """The state of the run that ends ``state``'s longest run followed by ``word``, cut loose from longer ones."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        own = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = own
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = own
            state = self.link[state]
        return own

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        state, at = self._new(self.length[last] + 1, 0, {}), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self._split(at, word)
        return state

    def items_at(self, state: int) -> frozenset[str]:
        """The items that hold the run of this state."""
        if state not in self._items:
            found, open_ = set(), [state]
            while open_:
                s = open_.pop()
                found |= self.ends[s]
                open_ += self.below[s]
            self._items[state] = frozenset(found)
        return self._items[state]

    def hits(self, words: list[int]):
        """(first word, end, items) of every window and short item in the run of words."""
        state, matched, window = 0, 0, self.window
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if w not in self.next[state]:
                continue
            state = self.next[state][w]
            matched += 1
            if matched >= window:
                s = state
                while self.length[self.link[s]] >= window:
                    s = self.link[s]
                yield i + 1 - window, i + 1, self.items_at(s)
            s = self.nearest[state]
            while s > 0:
                for n, items in self.whole[s].items():
                    if n <= matched:
                        yield i + 1 - n, i + 1, items
                s = self.nearest[self.link[s]]

    def runs(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of words, each within one text, that can hold a hit."""
        g = self.gram
        if len(hashes) < g or not len(self.grams):
            return []
        out, step = [], 1 << 16
        text_end = np.repeat(first[1:], np.diff(first))
        for lo in range(0, len(hashes) - g + 1, step):
            n = min(step, len(hashes) - g + 1 - lo)
            at = np.arange(n)
            h = span_hash(prefix_hash(hashes[lo:lo + n + g - 1]), at, at + g)
            at = at[self.sieve[h & np.uint64(len(self.sieve) - 1)]]
            h = h[at]
            place = np.minimum(np.searchsorted(self.grams, h), len(self.grams) - 1)
            at = at[self.grams[place] == h] + lo
            out.append(at[at + g <= text_end[at]])
        at = np.concatenate(out)
        if not len(at):
            return []
        fresh = np.ones(len(at), bool)
        fresh[1:] = (np.diff(at) > 1) | (text_end[at[1:]] != text_end[at[:-1]])
        begins = at[fresh]
        ends = at[np.append(np.flatnonzero(fresh)[1:] - 1, len(at) - 1)] + g
        return list(zip(begins.tolist(), ends.tolist()))


def automata(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> list[Automaton]:
    """One automaton per ``AUTOMATON_BYTES`` of item texts, dealt by hash; each part is fetched by itself.

    Items are the stated query set of this operator. A null id is the empty name."""
    found = pick(items, item=id_col, text=text_col).select(
        F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    total = found.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = total // AUTOMATON_BYTES + 1
    out = []
    for part in range(parts):
        rows = found.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part).distinct().collect()
        rows.sort()
        hashes, _, _, first = words_of(pa.array([r["text"] for r in rows], pa.string()))
        words = hashes.tolist()
        out.append(Automaton([(r["item"], words[first[i]:first[i + 1]]) for i, r in enumerate(rows)], window))
    return out


def marks(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """``keep`` and n_words, n_hit, items (array<string>, sorted), spans (array<long>: begin, end, begin, ... in bytes).

    A word is hit inside any occurrence of ``window`` consecutive item words, or of a whole shorter item. Spans
    are maximal runs of hit words. Null and empty texts have no words; items without words match nothing; equal
    items count as one; rows are independent, so ties and repeated rows get a row each."""
    held = [docs.sparkSession.sparkContext.broadcast(a) for a in automata(items, window)]

    def work():
        return lambda texts: _marked(texts, [b.value for b in held])

    return per_text(docs, work, {"n_words": "long", "n_hit": "long", "items": "array<string>", "spans": "array<long>"},
                    text_col, keep)


def _marked(texts: pa.Array, held: list[Automaton]):
    hashes, begin, end, first = words_of(texts)
    hit, items = np.zeros(len(hashes) + 1, bool), [set() for _ in range(len(texts))]
    for automaton in held:
        for lo, hi in automaton.runs(hashes, first):
            row = int(np.searchsorted(first, lo, "right")) - 1
            for a, b, names in automaton.hits(hashes[lo:hi].tolist()):
                hit[lo + a:lo + b] = True
                items[row] |= names
    total = np.concatenate([[0], np.cumsum(hit)])
    data_bounds = stream(texts)[1]
    spans: list[list[int]] = [[] for _ in range(len(texts))]
    for row in np.flatnonzero(total[first[1:]] > total[first[:-1]]):
        lo, hi = first[row], first[row + 1]
        edge = np.diff(np.concatenate([[0], hit[lo:hi].astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
            spans[row] += [int(begin[lo + a] - data_bounds[row]), int(end[lo + b - 1] - data_bounds[row])]
    return (np.diff(first), total[first[1:]] - total[first[:-1]], [sorted(x) for x in items], spans)


def contaminated(share: int = 20) -> str:
    """SQL: some word is hit and at least one in ``share`` words is."""
    return f"n_hit > 0 and {share} * n_hit >= n_words"


def without_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text",
                  share: int = 20) -> DataFrame:
    """The documents, less those whose coverage reaches the limit; from the others the hit spans are cut."""
    held = [docs.sparkSession.sparkContext.broadcast(a) for a in automata(items, window)]

    def work():
        def cut(texts):
            n_words, n_hit, _, spans = _marked(texts, [b.value for b in held])
            data, bounds = stream(texts)
            kept = []
            for row, own in enumerate(spans):
                at, parts = int(bounds[row]), []
                for lo, hi in zip(own[::2], own[1::2]):
                    parts.append(data[at:bounds[row] + lo].tobytes())
                    at = int(bounds[row]) + hi
                kept.append(b"".join([*parts, data[at:bounds[row + 1]].tobytes()]).decode())
            return (n_hit == 0) | (share * n_hit < n_words), kept
        return cut

    return per_text(docs, work, {text_col: "string"}, text_col, choose=True)




def uncontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", share: int = 20) -> DataFrame:
    """The documents whose coverage stays below the limit, unchanged."""
    held = [docs.sparkSession.sparkContext.broadcast(a) for a in automata(items, window)]

    def work():
        def judged(texts):
            n_words, n_hit, _, _ = _marked(texts, [b.value for b in held])
            return ((n_hit == 0) | (share * n_hit < n_words),)
        return judged

    return per_text(docs, work, {}, text_col, choose=True)
