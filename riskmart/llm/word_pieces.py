"""Ids of a word-end BPE vocabulary for whole blocks of texts: equal pieces once, all pieces merged side by side."""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from riskmart.llm.common import LOWER, SPACES, byte_codes, prefix_hash, span_hash, stream

#: Pieces with more bytes go to the library.
LONGEST = 64
#: Ids of known pieces that a worker keeps; beyond that it begins anew.
KEPT = 1 << 22
_NONE = np.int32(2 ** 31 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 18
LETTER, DIGIT, OTHER = 1, 2, 3

_KIND = np.full(256, OTHER, np.uint8)
_KIND[SPACES] = 0
_KIND[97:123] = LETTER
_KIND[65:91] = LETTER
_KIND[128:] = LETTER
_KIND[48:58] = DIGIT
#: Bytes that only the library reads: control codes, and characters outside of ASCII and U+00C0 to U+024F.
_ODD = np.zeros(256, bool)
_ODD[:32] = _ODD[127] = _ODD[0xC2] = _ODD[0xCA:] = True
_ODD[SPACES] = False


def _two_byte_lowers() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of the letters U+00C0 to U+024F, by code point, and which code points there are the library's."""
    low, odd = np.arange(0x250), np.zeros(0x250, bool)
    for c in range(0xC0, 0x250):
        small = chr(c).lower()
        odd[c] = len(small) > 1 or not 0xC0 <= ord(small) < 0x250 or not unicodedata.category(chr(c)).startswith("L")
        if not odd[c]:
            low[c] = ord(small)
    return low, odd


_LOW, _LOW_ODD = _two_byte_lowers()


def byte_names() -> list[str]:
    """The printable character that stands for each byte: itself where it is one, else the next from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Of a tokenizer file whose merges work on bytes in lower case and mark the last byte of a piece.

    Pieces are runs of letters, single digits, runs of other signs, and the English endings behind an apostrophe. Parts
    between white space with characters outside of Latin, and very long pieces, go to the library as they are."""

    def __init__(self, content: str) -> None:
        model = json.loads(content)["model"]
        self.library = Tokenizer.from_str(content)
        self.library.encode_special_tokens = True  # a special token's text is ordinary text
        ids, end = model["vocab"], model["end_of_word_suffix"]
        self.inner = np.array([ids[c] for c in byte_names()], np.int32)
        self.last = np.array([ids[c + end] for c in byte_names()], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.keys = np.full(1 << _SLOTS, -1, np.int64)
        self.ranks = np.full(1 << _SLOTS, _NONE, np.int32)
        for rank, (a, b) in enumerate(pairs):
            key = ids[a] << 20 | ids[b]
            slot = int(self._slot(np.array([key]))[0])
            while self.keys[slot] not in (-1, key):
                slot = slot + 1 & (1 << _SLOTS) - 1
            if self.keys[slot] == -1:
                self.keys[slot], self.ranks[slot] = key, rank
        self._forget()

    def _forget(self) -> None:
        """Known pieces: their hashes, in order, and which of the known ids are theirs."""
        self.hashes, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.places, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _SPREAD >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair."""
        keys = left.astype(np.int64) << 20 | right
        slot = self._slot(keys)
        seen, out = self.keys[slot], self.ranks[slot].copy()
        out[seen != keys] = _NONE
        open_ = np.flatnonzero((seen != keys) & (seen != -1))
        while len(open_):  # another pair has the slot: the next one
            slot[open_] = slot[open_] + 1 & (1 << _SLOTS) - 1
            seen = self.keys[slot[open_]]
            same = seen == keys[open_]
            out[open_[same]] = self.ranks[slot[open_[same]]]
            open_ = open_[~same & (seen != -1)]
        return out

    def _merge(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces in one array, and where each piece's begin and how many there are.

        In each round every piece has its first pair of least rank merged; those without any leave."""
        start = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(start - begin, size)
        sign = self.inner[data[at]]
        final = start + size - 1
        sign[final] = self.last[data[begin + size - 1]]
        rank = np.full(len(sign), _NONE, np.int32)
        rank[:-1] = self._rank(sign[:-1], sign[1:])
        rank[final] = _NONE
        piece, ids, places, counts, done = np.arange(len(size)), [], np.zeros(len(size), np.int64), np.zeros(len(size), np.int64), 0
        while len(piece):
            start = np.cumsum(size) - size
            least = np.minimum.reduceat(rank, start)
            over = least == _NONE
            if over.any():
                gone = np.repeat(over, size)
                ids.append(sign[gone])
                counts[piece[over]] = size[over]
                places[piece[over]] = done + np.cumsum(size[over]) - size[over]
                done += len(ids[-1])
                sign, rank = sign[~gone], rank[~gone]
                piece, size, least = piece[~over], size[~over], least[~over]
                if not len(piece):
                    break
            owner = np.repeat(np.arange(len(size)), size)
            hit = np.flatnonzero(rank == least[owner])
            hit = hit[np.r_[True, owner[hit[1:]] != owner[hit[:-1]]]]  # one in each piece
            sign[hit] = self.merged[least]
            stays = np.ones(len(sign), bool)
            stays[hit + 1] = False
            sign, owner = sign[stays], owner[stays]
            rank[hit] = rank[hit + 1]  # whether the joined one is the last
            rank = rank[stays]
            hit -= np.arange(len(hit))
            size = size - 1
            for left in (hit, hit[hit > 0] - 1):
                left = left[left + 1 < len(sign)]
                left = left[owner[left] == owner[left + 1]]
                rank[left] = self._rank(sign[left], sign[left + 1])
            ends = np.cumsum(size) - 1
            rank[ends] = _NONE
        return np.concatenate(ids) if ids else np.zeros(0, np.int32), places, counts

    def _pieces(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lowered bytes, begin and end of each piece in the stream, and whether only the library can read it."""
        n, data = len(raw), LOWER[raw]
        odd = _ODD[raw]
        two = np.flatnonzero((raw >= 0xC3) & (raw <= 0xC9))
        code = (raw[two].astype(np.int64) & 31) << 6 | raw[two + 1] & 63
        low = _LOW[code]
        data[two], data[two + 1] = 0xC0 | low >> 6, 0x80 | low & 63
        odd[two[_LOW_ODD[code]]] = True
        kind, first = _KIND[data], np.zeros(n + 3, bool)
        first[bounds] = True
        inside = kind > 0
        start = inside.copy()
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT) | first[1:n]
        quote = np.flatnonzero((data == 39) & start)
        if len(quote):
            after = np.pad(data, (0, 3))
            a, b = after[quote + 1], after[quote + 2]
            own = ~first[quote + 1]
            one = own & np.isin(a, np.frombuffer(b"stmd", np.uint8))
            both = own & ~first[quote + 2] & (((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108))
            for ending, length in ((quote[one], 2), (quote[both], 3)):
                start[ending + 1] = False
                rest = ending + length
                rest = rest[rest < n]
                start[rest] |= inside[rest]
        if odd.any():
            word = inside.copy()
            word[1:] &= ~inside[:-1] | first[1:n]
            begins = np.flatnonzero(word)
            strange = np.zeros(len(begins), bool)
            strange[np.searchsorted(begins, np.flatnonzero(odd), "right") - 1] = True
            covered = strange[np.maximum(np.cumsum(word) - 1, 0)] & inside
            start[covered] = word[covered]
        marks = np.flatnonzero(start | ~inside)
        mine = np.flatnonzero(start[marks])
        begin, end = marks[mine], np.append(marks, n)[mine + 1]
        if not odd.any():
            return data, begin, end, end - begin > LONGEST
        large = np.r_[0, np.cumsum(odd)]
        return data, begin, end, (large[end] > large[begin]) | (end - begin > LONGEST)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's begin (one more entry than texts)."""
        raw, bounds = stream(texts)
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
        data, begin, end, strange = self._pieces(raw, bounds)
        if not len(begin):
            return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
        hashes = span_hash(prefix_hash(byte_codes()[data]), begin, end)
        order = np.argsort(hashes)
        fresh = np.r_[True, hashes[order[1:]] != hashes[order[:-1]]]
        same = np.empty(len(order), np.int64)
        same[order] = np.cumsum(fresh) - 1
        one = order[fresh]  # of equal pieces
        self._learn(hashes[one], raw, data, begin[one], end[one], strange[one])
        known = np.searchsorted(self.hashes, hashes[one])[same]
        n = self.counts[known]
        until = np.r_[0, np.cumsum(n)]
        at = np.arange(int(until[-1])) + np.repeat(self.places[known] - until[:-1], n)
        return self.ids[at], until[np.searchsorted(begin, bounds)]

    def _learn(self, hashes, raw, data, begin, end, strange) -> None:
        """Make the pieces, given by their hashes in order, known ones."""
        if len(self.ids) > KEPT:
            self._forget()
        at = np.searchsorted(self.hashes, hashes)
        inside = at < len(self.hashes)
        new = np.flatnonzero(~inside | (np.append(self.hashes, hashes[:1])[at] != hashes))
        if not len(new):
            return
        begin, end, strange = begin[new], end[new], strange[new]
        places, counts = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        plain, others = np.flatnonzero(~strange), np.flatnonzero(strange)
        ids, places[plain], counts[plain] = self._merge(data, begin[plain], end[plain] - begin[plain])
        if len(others):
            found = self.library.encode_batch([raw[begin[i]:end[i]].tobytes().decode() for i in others], add_special_tokens=False)
            counts[others] = [len(f.ids) for f in found]
            places[others] = len(ids) + np.cumsum(counts[others]) - counts[others]
            ids = np.concatenate([ids, *[np.array(f.ids, np.int32) for f in found]])
        self.places = np.insert(self.places, at[new], places + len(self.ids))
        self.counts = np.insert(self.counts, at[new], counts)
        self.hashes = np.insert(self.hashes, at[new], hashes[new])
        self.ids = np.concatenate([self.ids, ids])


@lru_cache(maxsize=1)
def vocabulary(content: str) -> Vocabulary:
    """One per worker process."""
    return Vocabulary(content)
