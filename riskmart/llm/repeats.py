"""Windows of tokens that also start in a document with a smaller id: what the two substring deduplications share.

A window is ``length`` consecutive tokens of one document. In each window the smallest of its grams of ``gram``
tokens (by hash) marks an anchor, so equal windows have equal anchors, and only about two positions in
``length - gram + 2`` are anchors. An anchor's context is everything the windows around it can hold.

1. Anchors are found in each task. Of those with equal contexts only the ones of the smallest document leave the
   task; for the others the whole context repeats. So copies are settled where they lie.
2. The rest meet by gram. Equal contexts are settled again. A gram in several contexts is an *edge* of repeats.
3. The contexts of edges, and only these, are cut from the texts and meet by gram. ``settle`` finds, for each of the
   windows of an edge, whether a smaller document has it.

All three steps look at the input alone. Grams that one task has very many contexts of (``HOT``) go to step 3 straight
away, and only ``HOT`` of them to step 2, marked, which sends what is left of that gram to step 3; in step 3 each task settles
its own edges first and passes on those with windows that are still open. So what one frequent gram sends is bounded
per task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskmart.llm.common import KINDS, blocks, mixed, pick, prefix_hash, shown, span_hash
from riskmart.session import written

HOT = 64
#: Anchors, and bytes of contexts, that a task holds before it sends them on.
HELD_ANCHORS, HELD_CONTEXTS = 150_000, 1 << 20
#: Text that is looked at at once, and buckets per shuffle partition: what a task holds at a time.
BLOCK, FINER, SETTLED = 1 << 19, 2, 1 << 12
_SPAN, _FULL, _EDGE, _PACKED = 1, 2, 3, 4


@dataclass(frozen=True)
class Windows:
    length: int
    gram: int
    #: A string array to raw tokens and each row's first token.
    tokens: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
    #: Raw tokens to 64-bit codes.
    codes: Callable[[np.ndarray], np.ndarray]
    kind: str
    #: (raw, begin, left, end, id, gram hash) of contexts to (context, offset left of the anchor) of repeated windows.
    settle: Callable[..., tuple[np.ndarray, np.ndarray]]

    @property
    def before(self) -> int:
        return self.length - self.gram


def sliding(f, x: np.ndarray, width: int) -> np.ndarray:
    """f over each run of ``width`` entries."""
    size = 1
    while size * 2 <= width:
        x = f(x[:-size], x[size:])
        size *= 2
    return f(x[:len(x) - (width - size)], x[width - size:]) if size < width else x


def anchors(w: Windows, raw: np.ndarray, first: np.ndarray, step: int = 1 << 17) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, gram hash, context hash) of each anchor, in order; steps of bounded size with enough overlap."""
    n, width = len(raw), w.length - w.gram + 1
    places, grams, contexts = [], [], []
    for lo in range(0, n, step):
        a, b = max(0, lo - 2 * w.length), min(n, lo + step + 2 * w.length)
        if b - a < w.length:
            continue
        rows = np.searchsorted(first, np.arange(a, b), "right")
        start, end = first[rows - 1] - a, first[rows] - a
        prefix = prefix_hash(w.codes(raw[a:b]))
        at = np.arange(b - a - w.gram + 1)
        g = span_hash(prefix, at, at + w.gram) | np.uint64(1)
        least = sliding(np.minimum, g, width)
        least[np.arange(len(least)) + w.length > end[:len(least)]] = 0  # the window leaves its document
        room = np.zeros(len(g) + width - 1, np.uint64)
        room[width - 1:width - 1 + len(least)] = least
        p = np.flatnonzero(sliding(np.maximum, room, width) == g)
        p = p[(p >= lo - a) & (p < lo - a + step)]
        begin, stop = np.maximum(start[p], p - w.before), np.minimum(end[p], p + w.length)
        c = mixed(span_hash(prefix, begin, stop) + (p - begin).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        places.append(p + a)
        grams.append(g[p])
        contexts.append(c)
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(places), np.concatenate(grams), np.concatenate(contexts)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys begins, in sorted arrays."""
    fresh = np.ones(len(keys[0]), bool)
    if len(fresh) > 1:
        fresh[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return fresh


def leaders(values: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """For each entry the value at the beginning of its run."""
    return values[np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))]


def merged(begin: np.ndarray, end: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of spans within each row."""
    order = np.lexsort((begin, row))
    begin, end, row = begin[order], end[order], row[order]
    if not len(begin):
        return begin, end, row
    # rows lie far apart on one line, so spans of different rows never touch
    shift = row.astype(np.int64) << 40
    far = np.maximum.accumulate(end + shift)
    fresh = np.ones(len(begin), bool)
    fresh[1:] = (begin + shift)[1:] > far[:-1]
    last = np.append(np.flatnonzero(fresh)[1:] - 1, len(begin) - 1)
    return begin[fresh], far[last] - shift[last], row[fresh]


SCHEMA = "bucket int, did long, text_key long, kind int, a array<long>, b array<long>, packed binary"
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def _per_row(kind: int, dids, keys, row, a, b, buckets: int) -> pa.RecordBatch:
    """A row per document, with lists of a and b; ``row`` indexes dids and keys."""
    order = np.argsort(row, kind="stable")
    row, a, b = row[order], a[order], b[order]
    begins = np.flatnonzero(runs(row)) if len(row) else np.zeros(0, np.int64)
    offsets = pa.array(np.append(begins, len(row)), pa.int32())
    own = row[begins]
    n = len(own)
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int64))) for x in (a, b)]
    return pa.RecordBatch.from_arrays(
        [pa.array((dids[own] % buckets).astype(np.int32)), pa.array(dids[own]), pa.array(keys[own]), pa.array(np.full(n, kind, np.int32)),
         *lists, pa.nulls(n, pa.binary())], names=_NAMES)


def _packed(buckets: np.ndarray, blobs: list[bytes]) -> pa.RecordBatch:
    n = len(blobs)
    none = pa.nulls(n, pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(buckets.astype(np.int32)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                                       pa.array(np.full(n, _PACKED, np.int32)), none, none, pa.array(blobs, pa.binary())], names=_NAMES)


def _short(h: np.ndarray) -> bytes:
    """The low five bytes of each hash."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _long(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel().astype(np.uint64)


def _bucket(g: np.ndarray, buckets: int) -> np.ndarray:
    return ((g >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _find(w: Windows, buckets: int):
    """Step 1: texts to settled spans, known edges and packed anchors."""
    def send(parts):
        dids, keys = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        sizes = np.cumsum([0, *[len(p[0]) for p in parts]])
        row = np.concatenate([p[2] + s for p, s in zip(parts, sizes)])
        at, g, c, begin, end = (np.concatenate([p[i] for p in parts]) for i in range(3, 8))
        did = dids[row]
        order = np.argsort(did, kind="stable")
        order = order[np.argsort((g ^ (c * np.uint64(0x9FB21C651E98DF25)))[order], kind="stable")]
        fresh = runs(g[order], c[order])
        settled = np.zeros(len(row), bool)
        settled[order] = did[order] > leaders(did[order], fresh)
        if settled.any():
            yield _per_row(_SPAN, dids, keys, *(lambda b, e, r: (r, b, e))(*merged(begin[settled], end[settled], row[settled])), buckets)
        left = np.flatnonzero(~settled)
        order = left[np.argsort(did[left], kind="stable")]
        order = order[np.argsort(g[order], kind="stable")]
        fresh = runs(g[order])
        starts = np.flatnonzero(fresh)
        size = np.diff(np.append(starts, len(order)))
        hot = np.zeros(len(row), bool)
        if len(size) and size.max() > HOT:
            place = np.arange(len(order)) - np.repeat(starts, size)
            every = order[np.repeat(size > HOT, size)]
            yield _per_row(_EDGE, dids, keys, row[every], at[every], g[every].view(np.int64), buckets)
            hot[every] = True
            left = np.sort(order[place < HOT])
        to = _bucket(g[left], buckets)
        left, to = left[o := np.argsort(to, kind="stable")], to[o]
        starts = np.flatnonzero(runs(to)) if len(to) else np.zeros(0, np.int64)
        blobs = []
        for lo, hi in zip(starts, np.append(starts[1:], len(to))):
            part = left[lo:hi]
            docs = np.flatnonzero(runs(row[part]))
            head = np.array([len(docs), len(part)], "<u4").tobytes()
            own = row[part[docs]]
            blobs.append(b"".join([head, dids[own].astype("<i8").tobytes(), keys[own].astype("<i8").tobytes(),
                                   np.diff(np.append(docs, len(part))).astype("<u4").tobytes(), at[part].astype("<u4").tobytes(),
                                   g[part].astype("<u8").tobytes(), np.packbits(hot[part]).tobytes(), _short(c[part])]))
        yield _packed(to[starts], blobs)

    def run(batches):
        parts, held = [], 0
        for block in blocks(batches, BLOCK):
            raw, first = w.tokens(block.column("text"))
            p, g, c = anchors(w, raw, first)
            row = np.searchsorted(first, p, "right") - 1
            begin = np.maximum(first[row], p - w.before)
            end = np.minimum(p, first[row + 1] - w.length) + w.length
            dids, keys = (block.column(n).to_numpy() for n in ("did", "text_key"))
            base = first[row]
            parts.append((dids, keys, row, p - base, g, c, begin - base, end - base))
            held += len(p)
            if held >= HELD_ANCHORS:
                yield from send(parts)
                parts, held = [], 0
        if held:
            yield from send(parts)
    return run


def by_bucket(batches, work):
    """Rows that come sorted by bucket: the packed ones of each bucket go to ``work`` together, the others pass through."""
    pa.set_memory_pool(pa.system_memory_pool())
    packed, at = [], None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        kind = table.column("kind").to_numpy()
        if (kind != _PACKED).any():
            yield from table.filter(pa.array(kind != _PACKED)).to_batches()
        rows = table.filter(pa.array(kind == _PACKED))
        for bucket, blob in zip(rows.column("bucket").to_pylist(), rows.column("packed")):
            if bucket != at and packed:
                yield from work(packed)
                packed = []
            at = bucket
            packed.append(blob.as_py())
    if packed:
        yield from work(packed)


def _meet(w: Windows, buckets: int):
    """Step 2: anchors of a bucket to settled anchors and edges; what is settled passes through."""
    def met(packed):
        dids, keys, counts, at, g, sent, c = [], [], [], [], [], [], []
        for blob in packed:
            docs, n = np.frombuffer(blob, "<u4", 2)
            o = 8
            for out, kind, size in ((dids, "<i8", docs), (keys, "<i8", docs), (counts, "<u4", docs), (at, "<u4", n), (g, "<u8", n)):
                out.append(np.frombuffer(blob, kind, size, o))
                o += out[-1].nbytes
            o += (bits := (n + 7) // 8)
            sent.append(np.unpackbits(np.frombuffer(blob, np.uint8, bits, o - bits), count=n).astype(bool))
            c.append(_long(blob[o:]))
        packed.clear()
        dids, keys, counts, at, g, sent, c = map(np.concatenate, (dids, keys, counts, at, g, sent, c))
        row = np.repeat(np.arange(len(dids)), counts)
        did = dids[row]
        order = np.lexsort((did, c, g))
        g_s, c_s, did_s = g[order], c[order], did[order]
        fresh = runs(g_s, c_s)
        done = did_s > leaders(did_s, fresh)
        full = order[done]
        if len(full):
            for lo in range(0, len(full), 1 << 20):
                part = full[lo:lo + (1 << 20)]
                yield _per_row(_FULL, dids, keys, row[part], at[part], at[part], buckets)
        new_g = runs(g_s)
        group = np.cumsum(new_g) - 1
        contexts = np.bincount(group, fresh)
        least, most = (np.full(len(contexts), v) for v in (np.iinfo(np.int64).max, np.iinfo(np.int64).min))
        np.minimum.at(least, group[~done], did_s[~done])
        np.maximum.at(most, group[~done], did_s[~done])
        # step 3 has contexts of a hot gram that are not here, so all others of that gram go there too
        hot = np.bincount(group, sent[order]) > 0
        edge = order[~done & ~sent[order] & (hot | (contexts > 1) & (least < most))[group]]
        if len(edge):
            yield _per_row(_EDGE, dids, keys, row[edge], at[edge], g[edge].view(np.int64), buckets)
    return lambda batches: by_bucket(batches, met)


def _context_bytes(w: Windows, raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    sizes = end - begin
    starts = np.cumsum(sizes) - sizes
    return raw[np.repeat(begin - starts, sizes) + np.arange(sizes.sum())]


def _spans_of(w: Windows, contexts: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, context) of repeated windows, and which contexts have windows that are still open.

    Grams are settled some thousands of contexts at a time, those of one gram together."""
    raw, left, size = contexts["raw"], contexts["left"], contexts["size"]
    begin = np.cumsum(size) - size
    part = (contexts["g"] % np.uint64(999_983) % np.uint64(len(left) // SETTLED + 1)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.append(np.flatnonzero(runs(part[order])), len(order)) if len(order) else np.zeros(1, np.int64)
    spans, closed = [(np.zeros(0, np.int64),) * 3], np.zeros(len(left), np.int64)
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        own = order[lo:hi]
        own_begin = np.cumsum(size[own]) - size[own]
        which, offset = w.settle(_context_bytes(w, raw, begin[own], begin[own] + size[own]), own_begin, left[own],
                                 own_begin + size[own], contexts["did"][own], contexts["g"][own])
        closed[own] = np.bincount(which, minlength=len(own))
        start = contexts["at"][own[which]] - offset
        spans.append(merged(start, start + w.length, own[which]))
    windows = np.minimum(left, w.before) - np.maximum(0, w.length - (size - left)) + 1
    return (*map(np.concatenate, zip(*spans)), closed < windows)


_FIELDS = (("did", "<i8"), ("key", "<i8"), ("g", "<u8"), ("at", "<u4"), ("left", "u1"), ("size", "u1"))


def _cut(w: Windows, buckets: int):
    """Step 3a: texts with their edges to contexts; of grams with many contexts here, the task settles what it can."""
    def send(parts):
        contexts = {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}
        begin = np.cumsum(contexts["size"]) - contexts["size"]
        _, gram, number = np.unique(contexts["g"], return_inverse=True, return_counts=True)
        many = np.flatnonzero(number[gram] > HOT)
        open_ = np.ones(len(gram), bool)
        if len(many):
            own = {n: contexts[n][many] for n in contexts if n != "raw"}
            own["raw"] = _context_bytes(w, contexts["raw"], begin[many], begin[many] + own["size"])
            start, end, which, open_[many] = _spans_of(w, own)
            if len(which):
                yield _per_row(_SPAN, own["did"], own["key"], which, start, end, buckets)
        at = np.flatnonzero(open_)
        to = _bucket(contexts["g"][at], buckets)
        at, to = at[o := np.argsort(to, kind="stable")], to[o]
        starts = np.flatnonzero(runs(to)) if len(to) else np.zeros(0, np.int64)
        blobs = []
        for lo, hi in zip(starts, np.append(starts[1:], len(to))):
            part = at[lo:hi]
            raw = _context_bytes(w, contexts["raw"], begin[part], begin[part] + contexts["size"][part])
            blobs.append(b"".join([np.array([len(part)], "<u4").tobytes(), *[contexts[n][part].astype(k).tobytes() for n, k in _FIELDS], raw.astype(w.kind).tobytes()]))
        yield _packed(to[starts], blobs)

    def run(batches):
        parts, held = [], 0
        for block in blocks(batches, BLOCK):
            raw, first = w.tokens(block.column("text"))
            lists = block.column("a").combine_chunks()
            at = lists.flatten().to_numpy()
            g = block.column("b").combine_chunks().flatten().to_numpy().view(np.uint64)
            row = np.repeat(np.arange(block.num_rows), lists.value_lengths().to_numpy())
            p = at + first[row]
            begin, end = np.maximum(first[row], p - w.before), np.minimum(first[row + 1], p + w.length)
            dids, keys = (block.column(n).to_numpy() for n in ("did", "text_key"))
            parts.append({"did": dids[row], "key": keys[row], "at": at, "g": g, "left": p - begin, "size": end - begin,
                          "raw": _context_bytes(w, raw, begin, end)})
            held += parts[-1]["raw"].nbytes
            if held >= HELD_CONTEXTS:
                yield from send(parts)
                parts, held = [], 0
        if held:
            yield from send(parts)
    return run


def _settle(w: Windows, buckets: int):
    """Step 3b: contexts of a bucket to repeated spans; what is settled passes through."""
    def settled(packed):
        parts = []
        for blob in packed:
            n, o, part = int(np.frombuffer(blob, "<u4", 1)[0]), 4, {}
            for name, dtype in _FIELDS:
                part[name] = np.frombuffer(blob, dtype, n, o).astype(np.uint64 if name == "g" else np.int64)
                o += n * np.dtype(dtype).itemsize
            part["raw"] = np.frombuffer(blob, w.kind, offset=o)
            parts.append(part)
        contexts = {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}
        start, end, which, _ = _spans_of(w, contexts)
        if len(which):
            yield _per_row(_SPAN, contexts["did"], contexts["key"], which, start, end, buckets)
    return lambda batches: by_bucket(batches, settled)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns as c0, c1, ... and did (a null id counts as larger than every other), text_key and text."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id = F.col(f"c{names.index(id_col)}").cast("long")
    text = F.coalesce(F.col(f"c{names.index(text_col)}").cast("string"), F.lit(""))
    inner = inner.withColumn("did", F.coalesce(doc_id, F.lit((1 << 63) - 1))).withColumn("text", text)
    return inner.withColumn("text_key", F.xxhash64("text"))


def repeated(rows: DataFrame, w: Windows) -> DataFrame:
    """Of the ``keyed`` rows, per key what repeats: (did, text_key, begins, ends, fulls).

    ``begins`` and ``ends`` are token spans, ``fulls`` anchors all of whose windows repeat. Windows of one id, or of
    several rows with one id, never repeat one another."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = FINER * parts
    rows = rows.select("did", "text_key", "text")

    def gathered(df):
        return df.repartition(parts, "bucket").sortWithinPartitions("bucket")
    found = rows.mapInArrow(_find(w, buckets), SCHEMA)
    met = written(gathered(found).mapInArrow(_meet(w, buckets), SCHEMA), "anchors")
    edges = (met.where(f"kind = {_EDGE}").groupBy("did", "text_key")
             .agg(F.flatten(F.collect_list("a")).alias("a"), F.flatten(F.collect_list("b")).alias("b")))
    cut = (rows.join(edges, ["did", "text_key"]).select("did", "text_key", "text", "a", "b")
           .mapInArrow(_cut(w, buckets), SCHEMA))
    settled = written(gathered(cut).mapInArrow(_settle(w, buckets), SCHEMA), "edges")
    every = met.where(f"kind <> {_EDGE}").unionByName(settled)
    lists = [F.flatten(F.collect_list(F.expr(f"if(kind = {kind}, {c}, array())"))).alias(name)
             for name, kind, c in (("begins", _SPAN, "a"), ("ends", _SPAN, "b"), ("fulls", _FULL, "a"))]
    return every.groupBy("did", "text_key").agg(*lists)


def cut_texts(docs: DataFrame, w: Windows, make, extra: dict[str, str], id_col: str = "doc_id", text_col: str = "text",
              keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all where None) and ``extra`` (name: type), which ``make`` gets from a block of texts, their
    tokens' firsts and, per token, whether it is covered. Names of ``extra`` replace columns of the same name."""
    names = docs.columns if keep is None else keep
    docs = docs if keep is None else pick(docs, **{c: c for c in dict.fromkeys([*keep, id_col, text_col])})
    rows, n = keyed(docs, id_col, text_col), len(names)
    joined = rows.join(repeated(rows, w), ["did", "text_key"], "left").select(
        *[f"c{i}" for i in range(n)], "text", *[F.coalesce(c, F.expr("array()").cast("array<long>")).alias(c) for c in ("begins", "ends", "fulls")])
    schema = ", ".join([*[f"c{i} {joined.schema[i].dataType.simpleString()}" for i in range(n)],
                        *[f"x{i} {kind}" for i, kind in enumerate(extra.values())]])

    def run(batches):
        for block in blocks(batches, BLOCK // 2):
            texts = block.column("text").combine_chunks()
            raw, first = w.tokens(texts)
            made = make(texts, raw, first, covered(w, first, *(block.column(c) for c in ("begins", "ends", "fulls"))))
            arrays = [*[block.column(i).combine_chunks() for i in range(n)],
                      *[pa.array(x, KINDS[kind]) for x, kind in zip(made, extra.values())]]
            yield pa.RecordBatch.from_arrays(arrays, names=[*[f"c{i}" for i in range(n)], *[f"x{i}" for i in range(len(extra))]])

    return joined.mapInArrow(run, schema).select(*shown(names, extra))


def covered(w: Windows, first: np.ndarray, begins: pa.ListArray, ends: pa.ListArray, fulls: pa.ListArray) -> np.ndarray:
    """For each token of a block whether a repeated window covers it."""
    n = int(first[-1])
    mark = np.zeros(n + 1, np.int64)

    def flat(lists):
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        sizes = lists.value_lengths().fill_null(0).to_numpy()
        return lists.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(lists)), sizes)
    for x, row, sign in ((*flat(begins), 1), (*flat(ends), -1)):
        mark += sign * np.bincount(x + first[row], minlength=n + 1)
    p, row = flat(fulls)
    p = p + first[row]
    mark += np.bincount(np.maximum(first[row], p - w.before), minlength=n + 1)
    mark -= np.bincount(np.minimum(p, first[row + 1] - w.length) + w.length, minlength=n + 1)
    return np.cumsum(mark)[:-1] > 0
