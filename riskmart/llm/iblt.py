"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.taskcontext import TaskContext

from riskmart.llm.common import byte_codes, documents, mixed, stream, word_hashes
from riskmart.session import written

HASHES = 3
#: Cells of a stored sketch; it gives back about two differences for three cells.
CELLS = 18
_KEY, _CHECK = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949D7C7509E6557)


def paragraph_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Digest of each paragraph of a block of texts, and each text's first one.

    A paragraph ends at a line feed or at a space after ``.``, ``!`` or ``?``. The second paragraph of equal
    content in a text has a digest of its own, and so on, so that sketches hold each with its number of times."""
    data, bounds = stream(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    stops = (data == 46) | (data == 33) | (data == 63)
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    inside = data != 10
    inside[1:] &= (data[1:] != 32) | ~stops[:-1] | first[1:-1]  # a text's first space follows nothing
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    keys, starts = word_hashes(data, begin, end, byte_codes(23)), np.searchsorted(begin, bounds)
    rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((keys, rows))
    same = np.zeros(len(keys), bool)
    same[1:] = (np.diff(rows[order]) == 0) & (keys[order][1:] == keys[order][:-1])
    place = np.arange(len(keys))
    nth = np.empty(len(keys), np.int64)
    nth[order] = place - np.maximum.accumulate(np.where(same, 0, place))
    return mixed(keys + nth.astype(np.uint64) * _KEY), starts


def cells_of(keys: np.ndarray, cells: int) -> np.ndarray:
    """A cell in each third of the sketch, a row per key. Another size gives other places."""
    part = cells // HASHES
    return np.stack([i * part + (mixed(keys + np.uint64(i * 1_000_003 + cells)) % np.uint64(part)).astype(np.int64)
                     for i in range(HASHES)], 1)


def sketches(keys: np.ndarray, first: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text and cell: number of keys, their sum and the sum of their checks (both modulo 2**64)."""
    n = len(first) - 1
    rows = np.repeat(np.arange(n), np.diff(first))
    at = (rows[:, None] * cells + cells_of(keys, cells)).ravel()
    counts = np.bincount(at, minlength=n * cells).astype(np.int64)
    sums, checks = np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64)
    np.add.at(sums, at, np.repeat(keys, HASHES))
    np.add.at(checks, at, np.repeat(mixed(keys ^ _CHECK), HASHES))
    return counts.reshape(n, cells), sums.reshape(n, cells), checks.reshape(n, cells)


def peeled(counts: np.ndarray, sums: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Peels differences of sketches, all rows at once.

    Returns (row, key, sign) of each recovered digest, sign 1 where it is in the first version only, and for each
    row whether it came out whole. The arrays are used up."""
    n, cells = counts.shape
    rows, keys, signs = [], [], []
    while True:
        sign = counts.astype(np.uint64)  # -1 is 2**64 - 1, its own inverse
        key = sums * sign
        pure = (np.abs(counts) == 1) & (mixed(key ^ _CHECK) * sign == checks)
        r, c = np.nonzero(pure)
        if not len(r):
            break
        k, s = key[r, c], counts[r, c]
        order = np.lexsort((k, r))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (np.diff(r[order]) != 0) | (k[order][1:] != k[order][:-1])
        pick = order[fresh]
        r, k, s = r[pick], k[pick], s[pick]
        rows.append(r)
        keys.append(k)
        signs.append(s)
        at = (r[:, None] * cells + cells_of(k, cells)).ravel()
        step = np.repeat(s, HASHES)
        np.subtract.at(counts.reshape(-1), at, step)
        np.subtract.at(sums.reshape(-1), at, np.repeat(k * s.astype(np.uint64), HASHES))
        np.subtract.at(checks.reshape(-1), at, np.repeat(mixed(k ^ _CHECK) * s.astype(np.uint64), HASHES))
        if sum(map(len, rows)) > n * cells * 4:  # a false pure cell set off a cycle; the rows concerned stay unpeeled
            break
    whole = ~(counts.any(1) | sums.any(1) | checks.any(1))
    flat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return flat(rows, np.int64), flat(keys, np.uint64), flat(signs, np.int64), whole


def select_rows(keys: np.ndarray, first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and firsts of some of the texts."""
    sizes = np.diff(first)[rows]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(first[:-1][rows] - starts[:-1], sizes) + np.arange(starts[-1])
    return keys[at], starts


def differences(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], cells: int = CELLS):
    """(row, digest, sign) of what differs between two versions of each text: sketches subtracted and peeled; rows that
    do not come out are sketched anew with twice the cells, until all have."""
    left = np.arange(len(a[1]) - 1)
    out = []
    while len(left):
        one, two = (sketches(*select_rows(*x, left), cells) for x in (a, b))
        r, k, s, whole = peeled(*(x - y for x, y in zip(one, two)))
        done = whole[r]
        out.append((left[r[done]], k[done], s[done]))
        left = left[~whole]
        cells *= 2
    return tuple(map(np.concatenate, zip(*out))) if out else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Twice the shared paragraphs by all of both; 1 where neither has any."""
    total = np.diff(a[1]) + np.diff(b[1])
    differing = np.bincount(differences(a, b)[0], minlength=len(total))
    return np.where(total > 0, (total - differing) / np.maximum(total, 1), 1.0)


def printed(keys: np.ndarray, first: np.ndarray) -> list[str]:
    """The sketch as text: per cell 2 bytes of number, 8 of sum, 2 of check."""
    counts, sums, checks = sketches(keys, first)
    packed = np.zeros(counts.shape, [("n", "<u2"), ("s", "<u8"), ("c", "<u2")])
    packed["n"], packed["s"], packed["c"] = counts & 0xFFFF, sums, checks & np.uint64(0xFFFF)
    return [base64.b64encode(row.tobytes()).decode() for row in packed]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of each whole text; null and empty texts have no paragraphs, equal texts are equal."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(printed(*paragraph_keys(batch.column("text"))), pa.string())],
                                             names=["doc_id", "fingerprint"])
    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _compared(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
    """The result's columns for texts and the texts after them."""
    edited = [t[:len(t) - len(t) // 2] + x[:len(t) // 2] for t, x in zip(texts, following)]
    own, changed, after = (paragraph_keys(pa.array(x, pa.large_string())) for x in (texts, edited, following))
    return [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()), pa.array(printed(*own), pa.string()),
            pa.array(printed(*changed), pa.string()), pa.array(likeness(own, changed)), pa.array(likeness(own, after))]


def edited_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text and against the next document, by descending doc_id (RESULT's columns).

    Nulls: a null text is the empty one; a null id comes last. Of rows with one id the order is that of the hash of
    their texts, of equal rows any. The last row is followed by the first, a sole row by itself. No rows give none.

    The rows are dealt by range and sorted, so a row's next one is beside it, except at the end of a partition: those
    rows (two per partition at most) keep their text, and meet by partition number."""
    spark = docs.sparkSession
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    dealt = documents(docs, id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        part = TaskContext.get().partitionId()
        edge = lambda ids, text, kind: pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *[pa.nulls(1, t) for t in (pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())],
             pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([text], pa.string())],
            names=[*NAMES, "edge", "part", "text"])
        ids, texts, began = [], [], False
        for batch in batches:
            for row_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if not began:
                    yield edge([row_id], text, 1)
                    began = True
                ids.append(row_id)
                texts.append(text)
                if sum(map(len, texts)) > 2 << 20 if len(texts) % 64 == 0 else len(text) > 2 << 20:
                    n = len(ids) - 1
                    if n:
                        yield _full(_compared(ids[:-1], texts[:-1], texts[1:]), n)
                        del ids[:-1], texts[:-1]
        if len(ids) > 1:
            yield _full(_compared(ids[:-1], texts[:-1], texts[1:]), len(ids) - 1)
        if ids:
            yield edge(ids[-1:], texts[-1], 2)

    def _full(columns, n):
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.zeros(n), pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())],
                                          names=[*NAMES, "edge", "part", "text"])

    def at_edges(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(_compared(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "after"))), names=NAMES)

    made = written(dealt.mapInArrow(run, f"{RESULT}, edge int, part int, text string"), "edited-versions")
    parts = sorted(r["part"] for r in made.where("edge = 1").select("part").collect())
    following = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    heads = made.where("edge = 1").select(F.col("part").alias("next_part"), F.col("text").alias("after"))
    last = made.where("edge = 2").join(following, "part").join(heads, "next_part").select("doc_id", "text", "after")
    return made.where("edge = 0").select(*NAMES).unionByName(last.mapInArrow(at_edges, RESULT))
