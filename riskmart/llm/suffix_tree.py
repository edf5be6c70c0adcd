"""Word-level removal of repeated passages by prefix-partitioned suffix trees."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskmart.llm.common import SPACES, byte_codes, stream, word_bounds, word_hashes
from riskmart.llm.repeats import Windows, cut_texts, leaders, runs

LENGTH, GRAM = 13, 5
#: Suffixes of one subtree at most, unless they agree over the whole window.
SUBTREE = 1 << 18


def partitions(raw: np.ndarray, start: np.ndarray, depth: int, most: int = SUBTREE):
    """Groups of suffixes that a subtree each is built of: those with one prefix stay together, and the prefix gets
    longer, a word at a time, only where a group is too large. Small neighbours share a group."""
    open_ = [(np.arange(len(start)), 0)]
    while open_:
        own, shared = open_.pop()
        if len(own) <= most or shared == depth:
            yield own
            continue
        word = raw[start[own] + shared]
        own = own[order := np.argsort(word, kind="stable")]
        begins = np.append(np.flatnonzero(runs(word[order])), len(own))
        at = 0
        for lo, hi in zip(begins[:-1], begins[1:]):
            if hi - lo > most:
                if lo > at:
                    yield own[at:lo]
                open_.append((own[lo:hi], shared + 1))
                at = hi
            elif hi - at > most:
                yield own[at:lo]
                at = lo
        if at < len(own):
            yield own[at:]


def deep_nodes(raw: np.ndarray, start: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Builds one subtree from the root down, a word at a time: the nodes of each depth are the parts into which the next
    word splits those above. A part with one suffix is a leaf and leaves the tree; what is there at ``depth`` are the
    deep internal nodes. Returns suffixes and their node numbers."""
    own, node = np.arange(len(start)), np.zeros(len(start), np.int64)
    for at in range(depth):
        order = np.lexsort((raw[start[own] + at], node))
        own, node = own[order], node[order]
        fresh = runs(node, raw[start[own] + at])
        node = np.cumsum(fresh) - 1
        inner = (np.bincount(node) > 1)[node] if len(node) else np.zeros(0, bool)
        own, node = own[inner], node[inner]
    return own, node


def settle(raw: np.ndarray, begin: np.ndarray, left: np.ndarray, end: np.ndarray, did: np.ndarray, _group: np.ndarray,
           length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(context, offset) of each window, ``offset`` words left of its context's anchor, that a smaller document has:
    a window repeats if its deep node holds a suffix of a smaller document."""
    which, offset = [], []
    for o in range(length - gram + 1):
        valid = np.flatnonzero((left >= o) & (end - begin - left >= length - o))
        which.append(valid)
        offset.append(np.full(len(valid), o))
    which, offset = np.concatenate(which), np.concatenate(offset)
    start = begin[which] + left[which] - offset
    found = []
    for group in partitions(raw, start, length):
        own, node = deep_nodes(raw, start[group], length)
        own = group[own]
        order = np.lexsort((did[which[own]], node))
        own, node = own[order], node[order]
        ids = did[which[own]]
        if len(own):
            found.append(own[ids > leaders(ids, runs(node))])
    found = np.concatenate(found) if found else np.zeros(0, np.int64)
    return which[found], offset[found]


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word as the token, and each text's first."""
    data, bounds = stream(texts)
    begin, end, first = word_bounds(data, bounds, ~SPACES)
    return word_hashes(data, begin, end, byte_codes(19)), first


def _codes(raw: np.ndarray) -> np.ndarray:
    return raw


#: Contexts carry half of each word's hash: thirteen of them in a row are more than enough to tell windows apart.
WORDS = Windows(LENGTH, GRAM, words_of, _codes, "<u4", settle)


def _kept(texts: pa.Array, first: np.ndarray, gone: np.ndarray, shown) -> tuple:
    """Per text: words, words removed, and what ``shown`` makes of the kept words joined by one space."""
    lost = np.concatenate([[0], np.cumsum(gone)])
    data, bounds = stream(texts)
    out = []
    for row, (a, b) in enumerate(zip(first[:-1], first[1:])):
        words = data[bounds[row]:bounds[row + 1]].tobytes().split()  # at the six ASCII white-space characters
        if lost[a] != lost[b]:
            words = [x for x, cut in zip(words, gone[a:b].tolist()) if not cut]
        out.append(shown(b" ".join(words)))
    return np.diff(first), lost[first[1:]] - lost[first[:-1]], out


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` and n_words, n_removed, kept (the remaining words joined by one space).

    A word goes if a window of 13 words over it also starts in a document with a smaller id, judged on the input. Null
    and empty texts have no words; texts under 13 words never lose any; of repeated rows with one id, and of rows whose
    ids are null, none loses to another; a null id counts as larger than all others."""
    return cut_texts(docs, WORDS, lambda texts, raw, first, gone: _kept(texts, first, gone, bytes.decode),
                     {"n_words": "long", "n_removed": "long", "kept": "string"}, id_col, text_col, keep)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256)."""
    return cut_texts(docs, WORDS, lambda texts, raw, first, gone: _kept(texts, first, gone, lambda x: hashlib.sha256(x).hexdigest()),
                     {"n_words": "long", "n_removed": "long", "kept_sha256": "string"}, keep=["doc_id"])
