"""Byte-level BPE encoding and decoding by longest matches, without a merge loop over each word."""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from riskmart.llm.common import KINDS, documents

#: Segments and pieces whose ids a worker keeps, of so many characters at most; the store is emptied when full, so memory
#: stays bounded.
KEPT, SHORT = 400_000, 64
#: Fixed value: the pattern of which is known that no match runs from another character into a space, so that texts may be
#: cut before single spaces.
CUTS_AT_SPACES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Coder:
    """Encoder and decoder for one vocabulary of ranks.

    A token sequence is what the merges make of a text if each two neighbours are compatible: the merges of
    their joined bytes give just these two. So encoding takes the longest token at each place and steps back
    to shorter ones where neighbours clash; places found to lead nowhere are marked and never tried again."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern, self.cuts = ranks, regex.compile(pattern), pattern == CUTS_AT_SPACES
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.parts = {}  # token -> the two tokens whose merge it is
        self.matcher = ahocorasick.Automaton()
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            halves = self.merged(token, rank)
            if len(halves) == 2:
                self.parts[rank] = halves
            if len(halves) <= 2:  # any other token never comes from merges
                self.matcher.add_word(token.decode("latin-1"), rank)
        self.matcher.make_automaton()
        self.lengths = {i: len(b) for b, i in ranks.items()}
        self.widest = max(self.lengths.values())
        #: token -> the longest other token that it begins with
        self.shorter = {rank: short for token, rank in ranks.items() if (short := next(
            (r for k in range(len(token) - 1, 0, -1)
             if (r := self.matcher.get(token[:k].decode("latin-1"), None)) is not None), None)) is not None}
        self.compatible = lru_cache(maxsize=1 << 20)(self._compatible)
        self.pieces: dict[str, bytes] = {}
        self.segments: dict[str, bytes] = {}

    def merged(self, data: bytes, below: int) -> tuple[int, ...]:
        """The merges by rank, of ranks lower than ``below`` only: the definition, used once per token."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return tuple(self.ranks[p] for p in parts)

    def _compatible(self, left: int, right: int) -> bool:
        """Whether no merge crosses the seam: undo the merges beside it, latest first; a pair at the seam
        that merges earlier than what was just undone would have been merged instead."""
        undone = len(self.ranks) + 256
        while True:
            across = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            # to the left of the seam merges of equal rank come first, to the right they come last
            if across is not None and across < undone:
                return False
            split_left, split_right = self.parts.get(left), self.parts.get(right)
            if split_left and (left > right or not split_right):
                undone, left = left, split_left[1]
            elif split_right:
                undone, right = right + 1, split_right[0]
            else:
                return True

    def longest(self, text: str, at: int) -> int:
        """The longest token that begins there."""
        length = self.matcher.longest_prefix(text[at:at + self.widest])  # of the trie's path, maybe past the last key
        while (rank := self.matcher.get(text[at:at + length], None)) is None:
            length -= 1
        return rank

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one match of the pattern."""
        raw = piece.encode("utf-8")
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        text, n, at, dead = raw.decode("latin-1"), len(raw), 0, set()
        lengths, shorter, compatible = self.lengths, self.shorter, self.compatible
        path = [rank for _, rank in self.matcher.iter_long(text)]  # the longest at each place: often right
        if all(map(compatible, path, path[1:])):
            return path
        path = []
        token = self.longest(text, 0)
        while at < n:
            while token is not None and (at + lengths[token] in dead or path and not compatible(path[-1], token)):
                token = shorter.get(token)
            if token is None:  # no token leads on from here, whichever way this place was reached
                dead.add(at)
                token = path.pop()
                at -= lengths[token]
                token = shorter.get(token)
            else:
                path.append(token)
                at += lengths[token]
                token = self.longest(text, at) if at < n else None
        return path

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers.

        Where the pattern's matches never run from a non-space into a space, a text may be cut before each
        single space and the parts looked up; with two spaces in a row the cut could fall inside a match."""
        if not self.cuts or "  " in text:
            return b"".join([self._piece(p) for p in self.pattern.findall(text)])
        head, *rest = text.split(" ")
        out = [self._segment(head)] if head else []
        known = self.segments
        for part in rest:
            ids = known.get(part)
            out.append(self._spaced(part) if ids is None else ids)
        return b"".join(out)

    def _spaced(self, part: str) -> bytes:
        ids = self._segment(" " + part)
        if len(part) <= SHORT:
            if len(self.segments) >= KEPT:
                self.segments.clear()
            self.segments[part] = ids
        return ids

    def _segment(self, segment: str) -> bytes:
        return b"".join([self._piece(p) for p in self.pattern.findall(segment)])

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = np.array(self.encode_piece(piece), "<u4").tobytes()
            if len(piece) <= SHORT:
                if len(self.pieces) >= KEPT:
                    self.pieces.clear()
                self.pieces[piece] = ids
        return ids

    def decode(self, ids: bytes) -> bytes:
        """Bytes of ids as ``encode`` returns them."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


@lru_cache(maxsize=2)
def coder(content: bytes, pattern: str) -> Coder:
    """One coder per worker process and vocabulary."""
    return Coder(read_ranks(content), pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded binary) of every whole text.

    A null text is the empty one: no ids, no bytes. Rows are independent: repeated rows, ties and null ids
    give a row each; further columns are ignored. The vocabulary file is read once, on the driver (its size is
    that of the vocabulary), and broadcast."""
    return _mapped(docs, ranks_path, pattern, id_col, text_col, "doc_id long, ids array<int>, decoded binary",
                   lambda ids, back: (np.frombuffer(ids, "<i4"), back))


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): as ``encode``, with digests for the two sequences."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, ranks_path, pattern, id_col, text_col, schema,
                   lambda ids, back: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()))


def _mapped(docs, ranks_path, pattern, id_col, text_col, schema, shape) -> DataFrame:
    with open(ranks_path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    names = [c.split()[0] for c in schema.split(", ")]
    types = [KINDS[c.split()[1]] for c in schema.split(", ")]

    def run(batches):
        own = coder(content.value, pattern)
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                ids = own.encode(text.as_py())
                rows.append(shape(ids, own.decode(ids)))
            columns = [batch.column("doc_id"), *[pa.array(c, t) for c, t in
                                                 zip(zip(*rows) if rows else [[]] * (len(names) - 1), types[1:])]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return documents(docs, id_col, text_col).mapInArrow(run, schema)
