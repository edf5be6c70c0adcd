"""Periodic runs: overlapping tiles per octave of periods, solved one by one and stitched per document and period."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskmart.llm.common import SPACES, blocks, byte_codes, documents, powers, prefix_hash, stream, word_bounds, word_hashes
from riskmart.session import written

LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Neighbouring tiles whose fragments are put together where they are solved; what crosses is stitched after the shuffle.
SPAN = 64

Edit = Callable[[int | None, int], np.ndarray | None]
_FRAGMENTS = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]))
_RUNS = "array<struct<start: long, length: long, period: long>>"


def z_values(s: list[int], upto: int) -> list[int]:
    """Entry d, for d below ``upto``: how far ``s[d:]`` agrees with ``s`` from its start."""
    n, z, left, right = len(s), [0] * upto, 0, 0
    for d in range(1, upto):
        k = min(right - d, z[d - left]) if d < right else 0
        while d + k < n and s[k] == s[d + k]:
            k += 1
        if d + k > right:
            left, right = d, d + k
        z[d] = k
    return z


def solve(tile: list[int], at: int, octave: int) -> list[tuple[int, int, int]]:
    """(period, start, stop) of each stretch of the tile whose smallest period is ``octave`` to ``2 * octave - 1`` and
    that holds the boundary ``at`` with a period and two octaves behind it.

    Two Z-functions meet at the boundary: over what follows it, how far words a period apart agree forwards, and over
    what precedes it, read from right to left, how far they agree backwards. A stretch that a smaller period also has
    reaches as far with that period, since it is longer than both together."""
    upto = min(2 * octave, len(tile) - at)
    ahead = z_values(tile[at:], upto)
    hits = [d for d in range(1, upto) if ahead[d] >= 2 * octave]
    if not hits or hits[-1] < octave:
        return []
    before = tile[:at][::-1]
    behind = z_values([*before, -1, *tile[:at + upto][::-1]], at + 1 + upto)
    found, seen = [], set()
    for d in hits:
        ends = at - min(at, behind[at + 1 + upto - d]), at + d + ahead[d]
        if ends not in seen:
            seen.add(ends)
            if d >= octave:
                found.append((d, *ends))
    return found


def tiles(hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(octave, text, boundary) of the tiles that can hold a run, octave by octave.

    A boundary lies at each multiple of the octave Q. A run of period q, Q <= q < 2Q, and 4q words or more holds one in
    its first Q words, and behind it the same 2Q words twice, q apart. So each place is compared with the one boundary
    that is Q to 2Q - 1 words before it, by the hash of 2Q words: no run is missed, and a tile that equal hashes bring in
    for nothing is found out when it is solved."""
    prefix, (_, down) = prefix_hash(hashes), powers(len(hashes))
    sizes, octave = np.diff(first), 1
    while len(texts := np.flatnonzero(sizes >= max(LEAST_WORDS, LEAST_PERIODS * octave))):
        width = 2 * octave
        count = sizes[texts] - 3 * octave + 1
        before = np.cumsum(count) - count
        place = np.arange(int(count.sum())) - np.repeat(before - octave, count)  # in its text, from the octave on
        x = place + np.repeat(first[texts], count)
        boundary = x - (place & (octave - 1)) - octave
        gram = (prefix[width:] - prefix[:-width]) * down[:len(hashes) + 1 - width]
        hit = np.flatnonzero(gram[x] == gram[boundary])
        if len(hit):
            boundary = np.unique(boundary[hit])
            yield octave, np.searchsorted(first, boundary, "right") - 1, boundary
        octave = width


def _fragments(hashes: np.ndarray, first: np.ndarray, words: Callable[[int], list[bytes]]) -> dict[int, list[dict]]:
    """Per text the solved stretches, those of ``SPAN`` neighbouring tiles put together; words are compared as bytes."""
    numbered: dict[int, list[int]] = {}
    found: dict[int, list[dict]] = {}
    for octave, texts, boundaries in tiles(hashes, first):
        last: dict[tuple[int, int, int], dict] = {}
        for text, boundary in zip(texts.tolist(), (boundaries - first[texts]).tolist()):
            if text not in numbered:
                names: dict[bytes, int] = {}
                numbered[text] = [names.setdefault(w, len(names)) for w in words(text)]
            low = max(0, boundary - octave)
            for period, start, stop in solve(numbered[text][low:boundary + 5 * octave], boundary - low, octave):
                start, stop = start + low, stop + low
                key = text, period, boundary // (octave * SPAN)
                known = last.get(key)
                if known and start <= known["stop"] - period:
                    known["stop"] = max(known["stop"], stop)
                else:
                    last[key] = {"period": period, "start": start, "stop": stop}
                    found.setdefault(text, []).append(last[key])
    return found


def _tiled(docs: DataFrame, edit: Edit | None, digest: bool) -> DataFrame:
    """(uid, doc_id, n_words, words, kept, fragments) per text: ``kept`` is the result of a text without fragments and
    ``words`` the text of the others."""
    shape = (lambda raw: hashlib.sha256(raw).hexdigest()) if digest else bytes.decode

    def run(batches):
        codes = byte_codes()
        for block in blocks(batches):
            ids = block.column("doc_id").to_pylist()
            data, bounds = stream(block.column("text"))
            begin, end, first = word_bounds(data, bounds, ~SPACES)
            hashes = word_hashes(data, begin, end, codes)
            orders = {}
            for i, doc_id in enumerate(ids if edit else []):
                order = edit(doc_id, int(first[i + 1] - first[i]))
                if order is not None:
                    orders[i] = order
                    hashes[first[i]:first[i + 1]] = hashes[first[i] + order]
            raw = data.tobytes()

            def words(i):
                own = raw[bounds[i]:bounds[i + 1]].split()
                return [own[k] for k in orders[i].tolist()] if i in orders else own

            found = _fragments(hashes, first, words)
            joined = [b" ".join(words(i)) for i in range(len(ids))]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(np.diff(first), pa.int64()),
                pa.array([t.decode() if i in found else None for i, t in enumerate(joined)], pa.string()),
                pa.array([None if i in found else shape(t) for i, t in enumerate(joined)], pa.string()),
                pa.array([found.get(i, []) for i in range(len(ids))], _FRAGMENTS)],
                names=["doc_id", "n_words", "words", "kept", "fragments"])

    schema = ("doc_id long, n_words long, words string, kept string, "
              "fragments array<struct<period: long, start: long, stop: long>>")
    found = docs.mapInArrow(run, schema)
    return written(found.select(F.monotonically_increasing_id().alias("uid"), "*"), "run-fragments")


def _stitched(fragments: DataFrame, least_words: int, least_periods: int) -> DataFrame:
    """(uid, runs): fragments of one text and period that share a period or more are one stretch."""
    own = Window.partitionBy("uid", "period").orderBy("start", "stop")
    before = F.max("stop").over(own.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("start") > before - F.col("period"), F.lit(True)).cast("int")
    parts = fragments.withColumn("apart", apart).withColumn("part", F.sum("apart").over(own))
    whole = parts.groupBy("uid", "period", "part").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    whole = whole.withColumn("length", F.col("stop") - F.col("start")).where(
        F.col("length") >= F.greatest(F.lit(least_words), least_periods * F.col("period")))
    return whole.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))


def without(words: list[bytes], runs: list[dict]) -> list[bytes]:
    """The words outside of all runs and those of a run's first period that no other run drops."""
    gone = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        gone[r["start"] + r["period"]] += 1
        gone[r["start"] + r["length"]] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def _collapsed(tiled: DataFrame, runs: DataFrame, digest: bool) -> DataFrame:
    shape = (lambda raw: hashlib.sha256(raw).hexdigest()) if digest else bytes.decode

    def run(batches):
        for batch in batches:
            texts, runs = batch.column("words").to_pylist(), batch.column("runs").to_pylist()
            kept = [shape(b" ".join(without(t.encode().split(b" "), r))) for t, r in zip(texts, runs)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), batch.column("runs"),
                                              pa.array(kept, pa.string())], names=["doc_id", "n_words", "runs", "kept"])

    none = F.from_json(F.lit("[]"), _RUNS)
    held = F.size("fragments") > 0
    open_ = tiled.where(held).join(runs, "uid", "left").select("doc_id", "n_words", "words", F.coalesce("runs", none).alias("runs"))
    plain = tiled.where(~held).select("doc_id", "n_words", none.alias("runs"), "kept")
    return plain.unionByName(open_.mapInArrow(run, f"doc_id long, n_words long, runs {_RUNS}, kept string"))


def collapsed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
              least_periods: int = LEAST_PERIODS, edit: Edit | None = None, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, runs, kept) of every whole text, its words being what white space (ASCII) parts.

    ``runs`` are the stretches of at least ``least_words`` words and ``least_periods`` (4 or more) times their smallest
    period that no neighbouring word extends, as (start, length, period) in that order; ``kept`` is the text without
    the words that some run holds after its first period, joined by one space, or with ``digest`` its SHA-256.
    ``edit(doc_id, n)`` may give the words another order (word numbers, repeats allowed) before anything else.

    A null text is the empty one, with no words, no runs and an empty ``kept``. Rows are independent of each other:
    equal rows, ties and null ids give a row each; further columns, whatever their names, are ignored. Work and memory
    of a task grow with the words of its longest text times the number of octaves, and never with their square."""
    if least_periods < LEAST_PERIODS or least_words < 1:
        raise ValueError(f"runs hold {LEAST_PERIODS} periods or more and a word")
    tiled = _tiled(documents(docs, id_col, text_col), edit, digest)
    fragments = tiled.where(F.size("fragments") > 0).select("uid", F.inline("fragments"))
    return _collapsed(tiled, _stitched(fragments, least_words, least_periods), digest)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit: Edit | None = None) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256): as ``collapsed``; the run
    shown is the one with the greatest length by period (ties: smallest start, then period), four nulls without any."""
    found = collapsed(docs, id_col, text_col, edit=edit, digest=True)
    # a fraction is greater if it is so multiplied out: exact, unlike a quotient
    best = F.expr("aggregate(runs, cast(null as struct<start: long, length: long, period: long>), (b, r) -> "
                  "case when b is null or r.length * b.period > b.length * r.period then r else b end)")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return (found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "kept")
            .select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2("lines", 256).alias("runs_sha256"), F.col("kept").alias("collapsed_sha256")))
