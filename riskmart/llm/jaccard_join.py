"""Near duplicates by n-gram Jaccard: the global n-gram order is cut into fragments, overlaps counted in each and summed.

The order is by how frequent n-grams are in the whole corpus, rare ones first. Two alike sets share at least
``alpha`` = 3/7 of their sizes' sum, so from the place of their k-th common n-gram to the end of either set there are
``alpha - k + 1`` or more, and their first ``shared`` common n-grams lie among the first ``prefix(n)`` of each.
Candidates are pairs with so many n-grams placed so.

1. ``_sets``: size and digest of each document's set, and how often n-grams occur (a count sketch of fixed size).
   Documents with equal sets are one node from here on.
2. ``_prefixes`` and ``_lists``: prefixes meet by n-gram. In each list every node is paired with two leaders at most: the
   one with the fewest rarer n-grams, which is nearest to what the list has in common, and the least node.
   ``_gather`` brings a node's n-grams and leaders together; nodes with too few shared n-grams drop out. The
   best-supported leaders are compared exactly, and what links is merged into components.
3. ``_open``: the lists again, now with components: nodes with candidates of another component in enough lists stay.
   ``_apart``: their lists once more, with a bitmap of each whole set. A bit that one of two sets has and the other has not
   is an n-gram that they do not share, so the bits that differ bound the overlap from above; a candidate pair of
   different components is only sent on, and compared exactly, if that bound reaches the overlap asked for. Variants of one
   template that are not alike, whose prefixes all meet, end here without a row.

``_linked`` compares: overlaps are counted in each fragment of the order and summed per pair. So a pair is left out only
if its prefixes rule it out or if its documents hang together by other links. A group of
near copies is linked through leaders, not by all its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskmart.llm.common import (LOWER, SPACES, blocks, byte_codes, mixed, prefix_hash, span_hash, stream, word_bounds,
                                 word_hashes)
from riskmart.llm.components import components
from riskmart.llm.repeats import _long, _short, keyed, runs
from riskmart.session import written

SHINGLE = 5
#: Likeness asked for, in hundredths.
LIKENESS = 75
#: The count sketch has so many cells, the order is cut into so many fragments.
SKETCH_BITS, CHUNK, FRAGMENT_BITS = 20, 1 << 14, 3
#: Prefix entries that a task holds before it sends them on, and candidate pairs that it looks at together.
HELD, PAIRS = 1_500_000, 1 << 18
#: Bits of a set's bitmap; n-grams of the corpus to a bucket of lists.
BITS, BUCKET_GRAMS = 2048, 1 << 20


def shared(n):
    """Common n-grams that are looked for, n the smaller size."""
    return 1 + n // 32


def prefix(n):
    """So many n-grams of a set of n can be among its first common ones with any other."""
    return n - (LIKENESS * n + 99) // 100 + shared(n)


def possible(size_i, place_i, size_j, place_j):
    """Whether a common n-gram at these places (from 0) can be among the first ones of two alike sets."""
    alpha = (LIKENESS * (size_i + size_j) + 99 + LIKENESS) // (100 + LIKENESS)
    return np.minimum(size_i - place_i, size_j - place_j) + shared(np.minimum(size_i, size_j)) - 1 >= alpha


def sets_of(texts: pa.Array) -> list[np.ndarray]:
    """The distinct n-gram hashes of each text, ascending; all words as one n-gram where there are fewer."""
    data, bounds = stream(texts)
    data = LOWER[data]
    begin, end, first = word_bounds(data, bounds, ~SPACES)
    words = word_hashes(data, begin, end, byte_codes(29))
    n, sizes = len(words), np.diff(first)
    grams = np.empty(max(n - SHINGLE + 1, 0), np.uint64)
    for lo in range(0, len(grams), 1 << 16):
        at = np.arange(min(1 << 16, len(grams) - lo))
        grams[lo:lo + len(at)] = span_hash(prefix_hash(words[lo:lo + len(at) + SHINGLE - 1]), at, at + SHINGLE)
    out = []
    for a, size in zip(first.tolist(), sizes.tolist()):
        if size >= SHINGLE:
            out.append(np.unique(grams[a:a + size - SHINGLE + 1]))
        else:
            own = prefix_hash(words[a:a + size])
            out.append(span_hash(own, np.zeros(1, np.int64), np.full(1, size)) if size else np.zeros(0, np.uint64))
    return out


def digest(own: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that depend on the set alone; the first names the node."""
    first, second = mixed(own * np.uint64(0x9E6C63D0876A9A47)), mixed(own ^ np.uint64(0xC2B2AE3D27D4EB4F))
    return tuple(int(x.sum(dtype=np.uint64).astype(np.int64)) for x in (first, second))


def _sets(batches):
    """(did, text_key, n, node, check) per text, and at the end the task's counts in chunks (cell, counts)."""
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    names = ["did", "text_key", "n", "node", "check", "cell", "counts"]
    for block in blocks(batches):
        found = sets_of(block.column("text").combine_chunks())
        if found:
            counts += np.bincount((np.concatenate(found) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
        digests = [digest(s) for s in found]
        n = len(found)
        yield pa.RecordBatch.from_arrays(
            [block.column("did").combine_chunks(), block.column("text_key").combine_chunks(), pa.array([len(s) for s in found], pa.int64()),
             pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()), pa.nulls(n, pa.int32()),
             pa.nulls(n, pa.binary())], names=names)
    chunks = [(i, c) for i, c in enumerate(np.split(counts, len(counts) // CHUNK)) if c.any()]
    n = len(chunks)
    yield pa.RecordBatch.from_arrays([*[pa.nulls(n, pa.int64())] * 5, pa.array([i for i, _ in chunks], pa.int32()),
                                      pa.array([c.astype("<i8" if c.max() >> 31 else "<i4").tobytes() for _, c in chunks], pa.binary())], names=names)


def _added(batches):
    """Chunks of counts summed per cell range."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for cell, blob in zip(batch.column("cell").to_pylist(), batch.column("counts").to_pylist()):
            own = np.frombuffer(blob, "<i8" if len(blob) == 8 * CHUNK else "<i4").astype(np.int64)
            total[cell] = total[cell] + own if cell in total else own
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([c.tobytes() for c in total.values()], pa.binary())],
                                     names=["cell", "counts"])


def _ranks(made: DataFrame) -> np.ndarray:
    """Place of each cell in the order of counts; the chunks of all tasks meet, the sum of fixed size is fetched."""
    chunks = made.where("cell is not null").select("cell", "counts")
    rows = chunks.repartition("cell").mapInArrow(_added, "cell int, counts binary").collect()
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in rows:
        counts[r["cell"] * CHUNK:(r["cell"] + 1) * CHUNK] = np.frombuffer(r["counts"], "<i8")
    ranks = np.empty(len(counts), np.uint32)
    ranks[np.argsort(counts, kind="stable")] = np.arange(len(counts), dtype=np.uint32)
    return ranks


def ordered(own: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The set as numbers in the global order: rank of the cell, then the rest of the hash. One to one."""
    low = np.uint64(64 - SKETCH_BITS)
    return np.sort((ranks[own >> low].astype(np.uint64) << low) | (own & ((np.uint64(1) << low) - np.uint64(1))))


_PACKED = "bucket int, packed binary"


def _pack(buckets: int, nodes, sizes, labels, row, token, place, bitmaps=None):
    """Entries dealt by n-gram: per bucket the nodes with size, label and bitmap if any, and five bytes and the place per entry."""
    to = (token % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    to, row, token, place = to[order], row[order], token[order], place[order]
    starts = np.flatnonzero(runs(to)) if len(to) else np.zeros(0, np.int64)
    blobs = []
    for lo, hi in zip(starts, np.append(starts[1:], len(to))):
        docs = np.flatnonzero(runs(row[lo:hi]))
        own = row[lo:hi][docs]
        blobs.append(b"".join([np.array([len(docs), hi - lo], "<u4").tobytes(), nodes[own].astype("<i8").tobytes(), sizes[own].astype("<i8").tobytes(),
                               labels[own].astype("<i8").tobytes(), np.diff(np.append(docs, hi - lo)).astype("<u4").tobytes(),
                               b"" if bitmaps is None else bitmaps[own].tobytes(),
                               place[lo:hi].astype("<u4").tobytes(), _short(token[lo:hi] // np.uint64(buckets))]))
    return pa.RecordBatch.from_arrays([pa.array(to[starts].astype(np.int32)), pa.array(blobs, pa.binary())], names=["bucket", "packed"])


def _unpack(batches, with_bitmaps: bool = False):
    """(token, node, size, label, place, at) of a partition's entries, sorted by token, size and node, and the bitmaps, of
    which ``at`` is the entry's."""
    parts, bitmaps, held = [[], [], [], [], [], []], [], 0
    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("packed").to_pylist()):
            docs, n = np.frombuffer(blob, "<u4", 2).tolist()
            o, table = 8, []
            for kind in ("<i8", "<i8", "<i8", "<u4"):
                table.append(np.frombuffer(blob, kind, docs, o))
                o += table[-1].nbytes
            if with_bitmaps:
                bitmaps.append(np.frombuffer(blob, "<u8", docs * (BITS // 64), o).reshape(docs, -1))
                o += bitmaps[-1].nbytes
            parts[4].append(np.frombuffer(blob, "<u4", n, o).astype(np.int64))
            parts[0].append(_long(blob[o + 4 * n:]) | np.uint64(bucket << 40))
            for out, column in zip(parts[1:4], table):
                out.append(np.repeat(column, table[3]))
            parts[5].append(np.repeat(np.arange(held, held + docs), table[3]))
            held += docs
    if not parts[0]:
        return None
    columns = list(map(np.concatenate, parts))
    order = np.lexsort((columns[1], columns[2], columns[0]))
    columns = [c[order] for c in columns]
    one = runs(columns[0], columns[1])  # a node comes once per task that has a copy
    return [c[one] for c in columns], np.concatenate(bitmaps) if bitmaps else None


def _prefixes(ranks, buckets: int):
    def run(batches):
        nodes, sizes, row, token, place, held, seen = [], [], [], [], [], 0, set()

        def send():
            own = [np.array(nodes, np.int64), np.array(sizes, np.int64)]
            return _pack(buckets, *own, own[0], np.concatenate(row), mixed(np.concatenate(token)) >> np.uint64(8), np.concatenate(place))
        for block in blocks(batches):
            for own in sets_of(block.column("text").combine_chunks()):
                if not len(own):
                    continue
                node = digest(own)[0]
                if node in seen:
                    continue
                seen.add(node)
                first = ordered(own, ranks.value)[:prefix(len(own))]
                row.append(np.full(len(first), len(nodes)))
                token.append(first)
                place.append(np.arange(len(first)))
                nodes.append(node)
                sizes.append(len(own))
                held += len(first)
                if held >= HELD:
                    yield send()
                    nodes, sizes, row, token, place, held, seen = [], [], [], [], [], 0, set()
        if held:
            yield send()
    return run


_PAIRS = "a long, b long, na long, nb long, n long"


def _counted(a, b, na, nb) -> tuple[np.ndarray, ...]:
    """Distinct pairs and how often each occurs."""
    order = np.lexsort((b, a))
    a, b, na, nb = a[order], b[order], na[order], nb[order]
    at = np.flatnonzero(runs(a, b)) if len(a) else np.zeros(0, np.int64)
    return a[at], b[at], na[at], nb[at], np.diff(np.append(at, len(a)))


def _lists(parts: int):
    """Lists of at least two nodes to packed entries, and to pairs of leader and member with the number of lists in this
    fragment, once for each way to choose leaders; dealt by node and by member."""
    def run(batches):
        entries = _unpack(batches)
        if entries is None:
            return
        token, node, size, _, place, _ = entries[0]
        group = np.cumsum(runs(token)) - 1
        key = (group << 32) | size
        low, many = _reach(key, group, size, place)
        at = np.arange(len(key))
        several = many - ((low <= at) & (at < low + many)) > 0  # some other entry than itself
        token, node, size, group, place = (x[several] for x in (token, node, size, group, place))
        if not len(token):
            return
        fresh = runs(group)
        starts, nth = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        pairs = []
        for kind, by in ((1, (node, place, group)), (2, (node, group))):
            leader = np.lexsort(by)[starts][nth]
            at = np.flatnonzero((node[leader] != node) & possible(size[leader], place[leader], size, place))
            found = _counted(node[leader[at]], node[at], size[leader[at]], size[at])
            pairs.append((np.full(len(found[0]), kind), *found))
        pairs = [np.concatenate(x) for x in zip(*pairs)]
        entries = (node, size, token.astype(np.int64), place)
        to = [(mixed(x.astype(np.uint64)) % np.uint64(parts)).astype(np.int64) for x in (node, pairs[2])]
        orders = [np.argsort(x, kind="stable") for x in to]
        cuts = [np.searchsorted(x[o], np.arange(parts + 1)) for x, o in zip(to, orders)]
        buckets, blobs = [], []
        for k in range(parts):
            own = [o[c[k]:c[k + 1]] for o, c in zip(orders, cuts)]
            if len(own[0]):
                buckets.append(k)
                blobs.append(b"".join([np.array([len(x) for x in own], "<i8").tobytes(),
                                       *[x[o].astype("<i8").tobytes() for columns, o in zip((entries, pairs), own) for x in columns]]))
        yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "packed"])
    return run


_GATHERED = "kind int, a long, b long, na long, nb long, tokens array<long>, places array<long>"


def _gather(batches):
    """Kind 0: a node, its size, its n-grams in lists and their places. Kind 1: a leader worth comparing and its member."""
    names = [c.split()[0] for c in _GATHERED.split(", ")]
    parts: list[list] = [[] for _ in range(10)]
    for batch in batches:
        for blob in batch.column("packed").to_pylist():
            columns = np.frombuffer(blob, "<i8")
            n, m = columns[:2]
            cuts = np.cumsum([2, n, n, n, n, m, m, m, m, m, m])
            for out, lo, hi in zip(parts, cuts[:-1], cuts[1:]):
                out.append(columns[lo:hi])
    if not parts[0]:
        return
    node, size, token, place, kind, a, b, na, nb, count = map(np.concatenate, parts)
    order = np.argsort(node, kind="stable")
    begins = np.flatnonzero(runs(node[order]))
    number = np.diff(np.append(begins, len(order)))
    # a node can only be alike to one that shares as many n-grams as the smallest fitting partner asks for
    enough = number >= shared((LIKENESS * size[order[begins]] + 99) // 100)
    order = order[np.repeat(enough, number)]
    ends = np.concatenate([[0], np.cumsum(number[enough])])
    own, n = order[ends[:-1]], int(enough.sum())
    lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x[order])) for x in (token, place)]
    none = pa.nulls(n, pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), pa.array(node[own]), none, pa.array(size[own]), none, *lists], names=names)
    order = np.lexsort((b, a, kind))
    begins = np.flatnonzero(runs(kind[order], a[order], b[order])) if len(order) else np.zeros(0, np.int64)
    total = np.add.reduceat(count[order], begins) if len(begins) else begins
    at = order[begins]
    # leaders only save comparisons, so those with little support need none now
    worth = (2 * total >= shared(np.minimum(na[at], nb[at]))) & np.isin(b[at], node[own])
    at, total = at[worth], total[worth]
    best = np.lexsort((a[at], total, b[at], kind[at]))
    last = np.append(np.flatnonzero(runs(kind[at][best], b[at][best]))[1:] - 1, len(best) - 1) if len(best) else best
    at = at[best][last]
    n = len(at)
    yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), *[pa.array(x[at]) for x in (a, b, na, nb)],
                                      *[pa.nulls(n, pa.list_(pa.int64()))] * 2], names=names)


def _reach(key, group, size, place):
    """The first entry of the list that is not too small for each entry, and how many are of fitting size from there (itself
    perhaps among them). An entry's place bounds its partner's size, see ``possible``."""
    low = np.searchsorted(key, (group << 32) | (LIKENESS * size + 99) // 100)
    most = np.minimum(100 * size // LIKENESS, ((100 + LIKENESS) * (size - place + shared(size) - 1)) // LIKENESS - size)
    high = np.searchsorted(key, (group << 32) | np.maximum(most, 0), "right")
    return low, high - low


def _dealt(buckets: int, with_bitmaps: bool = False):
    """(node, n, label, tokens, places, bitmap) to packed entries."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("tokens")
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            token = lists.flatten().to_numpy().astype(np.uint64)
            # the bucket and the 40 bits that _unpack put together, taken apart again
            token = (token & np.uint64((1 << 40) - 1)) * np.uint64(buckets) + (token >> np.uint64(40))
            bitmaps = np.frombuffer(b"".join(batch.column("bitmap").to_pylist()), "<u8").reshape(batch.num_rows, -1) if with_bitmaps else None
            yield _pack(buckets, *(batch.column(c).to_numpy() for c in ("node", "n", "label")), row, token,
                        batch.column("places").flatten().to_numpy(), bitmaps)
    return run


def _candidates(entries):
    """Pairs of entries of one list that can be alike and are of different components, some at a time."""
    token, node, size, label, place, _ = entries
    group = np.cumsum(runs(token)) - 1
    # per list the label of most entries: pairs are drawn from the other entries only
    order = np.lexsort((label, group))
    g, l_ = group[order], label[order]
    at = np.flatnonzero(runs(g, l_))
    count = np.diff(np.append(at, len(g)))
    best = np.lexsort((count, g[at]))
    last = np.append(np.flatnonzero(runs(g[at][best]))[1:] - 1, len(best) - 1)
    most = l_[at][best][last]  # ascending by list
    minor = label != most[group]
    low, many = _reach((group << 32) | size, group, size, place)
    rows = np.flatnonzero(minor & (many > 0))
    reach = np.cumsum(many[rows])
    lo = 0
    while lo < len(rows):
        hi = max(lo + 1, int(np.searchsorted(reach, (reach[lo - 1] if lo else 0) + PAIRS, "right")))
        part = rows[lo:hi]
        width = many[part]
        i = np.repeat(part, width)
        j = np.repeat(low[part] - (np.cumsum(width) - width), width) + np.arange(width.sum())
        ok = (label[i] != label[j]) & possible(size[i], place[i], size[j], place[j])
        yield i[ok], j[ok]
        lo = hi


def _open(batches):
    """(node, n): in how many lists of this partition a node has a candidate of another component."""
    unpacked = _unpack(batches)
    if unpacked is None:
        return
    entries, _ = unpacked
    met = np.zeros(len(entries[1]), bool)
    for i, j in _candidates(entries):
        met[i] = met[j] = True
    node, n = np.unique(entries[1][met], return_counts=True)
    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(n)], names=["node", "n"])


def _apart(batches):
    """The candidate pairs of different components whose bitmaps let them be alike, with the lists that hold both."""
    unpacked = _unpack(batches, True)
    if unpacked is None:
        return
    entries, bitmaps = unpacked
    _, node, size, _, _, own = entries
    for i, j in _candidates(entries):
        both = size[i] + size[j]
        differ = np.bitwise_count(bitmaps[own[i]] ^ bitmaps[own[j]]).sum(axis=1, dtype=np.int64)
        ok = (100 + LIKENESS) * ((both - differ) // 2) >= LIKENESS * both
        i, j = i[ok], j[ok]
        swap = node[i] > node[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        yield pa.RecordBatch.from_arrays(list(map(pa.array, _counted(node[i], node[j], size[i], size[j]))), names=["a", "b", "na", "nb", "n"])


def bitmap(own: np.ndarray) -> bytes:
    """The bits that the n-grams of a set hash to."""
    bits = np.zeros(BITS, bool)
    bits[(mixed(own) % np.uint64(BITS)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _fragments(ranks):
    """(node, text) to (node, fragment, tokens, bitmap): the set in pieces of the global order, its bitmap with the first."""
    def run(batches):
        for block in blocks(batches):
            nodes, pieces, values, ends, bitmaps = block.column("node").to_pylist(), [], [], [0], []
            own_nodes = []
            for node, found in zip(nodes, sets_of(block.column("text").combine_chunks())):
                own = ordered(found, ranks.value)
                piece = (own >> np.uint64(64 - FRAGMENT_BITS)).astype(np.int64)
                at = np.flatnonzero(runs(piece))
                own_nodes += [node] * len(at)
                pieces.append(piece[at])
                ends += (ends[-1] + np.append(at[1:], len(own))).tolist()
                values.append(own.view(np.int64))
                bitmaps += [bitmap(found), *[None] * (len(at) - 1)]
            if own_nodes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own_nodes, pa.int64()), pa.array(np.concatenate(pieces).astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values))), pa.array(bitmaps, pa.binary())],
                    names=["node", "fragment", "tokens", "bitmap"])
    return run


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, na, nb) that are alike: overlaps counted per fragment, then summed."""
    one, two = (sets.select(F.col("node").alias(c), "fragment", F.col("tokens").alias(f"of_{c}")) for c in ("a", "b"))
    partial = (pairs.select("a", "b", "na", "nb").join(one, "a").join(two, ["b", "fragment"])
               .select("a", "b", "na", "nb", F.size(F.array_intersect("of_a", "of_b")).alias("n")))
    return (partial.groupBy("a", "b", "na", "nb").agg(F.sum("n").alias("n"))
            .where(f"100 * n >= {LIKENESS} * (na + nb - n)").select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The ``keyed`` rows, and per key (did, text_key): n_shingles and component_id, the smallest id of the component.

    Null and empty texts have no n-grams and stand alone, each with its own id. Rows with equal sets belong together
    whatever their ids. A component of null ids alone has a null id (the largest number inside); of repeated rows each
    gets the same result."""
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    texts = rows.select("did", "text_key", "text")
    made = written(texts.mapInArrow(_sets, "did long, text_key long, n long, node long, check long, cell int, counts binary"), "ngram-sets")
    own = made.where("cell is null").select("did", "text_key", "n", "node", "check")
    nodes = own.where("n > 0").groupBy("node").agg(F.min(F.struct("did", "text_key")).alias("first"), F.min("check").alias("c0"),
                                                   F.max("check").alias("c1"))
    nodes = written(nodes, "ngram-nodes")
    grams = own.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), grams // BUCKET_GRAMS)
    if not nodes.where("c0 <> c1").isEmpty():
        raise ValueError("two different n-gram sets share a 64-bit digest")
    ranks = spark.sparkContext.broadcast(_ranks(made))
    lists = written(texts.mapInArrow(_prefixes(ranks, buckets), _PACKED).repartition(buckets, "bucket")
                    .mapInArrow(_lists(buckets), _PACKED).repartition(buckets, "bucket").mapInArrow(_gather, _GATHERED), "ngram-lists")
    listed = lists.where("kind = 0").select(F.col("a").alias("node"), F.col("na").alias("n"), "tokens", "places")
    pick_text = listed.select("node").join(nodes.select("node", "first.did", "first.text_key"), "node")
    sets = written(texts.join(pick_text, ["did", "text_key"]).dropDuplicates(["did", "text_key"]).select("node", "text")
                   .mapInArrow(_fragments(ranks), "node long, fragment int, tokens array<long>, bitmap binary"), "ngram-fragments")
    stars = lists.where("kind = 1").select("a", "b", "na", "nb").distinct()
    links = written(_linked(stars, sets), "ngram-links")
    labels = components(links)
    labelled = listed.join(labels, "node", "left").select("node", "n", F.coalesce("label", "node").alias("label"), "tokens", "places")
    met = (labelled.mapInArrow(_dealt(buckets), _PACKED).repartition(buckets, "bucket").mapInArrow(_open, "node long, n long")
           .groupBy("node").agg(F.sum("n").alias("met")))
    # as many lists as the smallest fitting partner asks for
    still = written(labelled.join(met, "node").where(f"met >= 1 + ({LIKENESS} * n + 99) div 100 div 32").drop("met")
                    .join(sets.where("bitmap is not null").select("node", "bitmap"), "node"), "ngram-still-open")
    open_ = (still.mapInArrow(_dealt(buckets, True), _PACKED).repartition(buckets, "bucket").mapInArrow(_apart, _PAIRS)
             .groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum("n").alias("n"))
             .where("n >= 1 + least(na, nb) div 32"))
    more = written(_linked(written(open_, "ngram-open"), sets), "ngram-more-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    grouped = nodes.select("node", "first.did").join(labels, "node").groupBy("label").agg(F.min("did").alias("component"))
    by_node = labels.join(grouped, "label").select("node", "component")
    alone = nodes.select("node", F.col("first.did").alias("least"))
    by_node = written(alone.join(by_node, "node", "left").select("node", F.coalesce("component", "least").alias("component")), "ngram-components")
    found = own.dropDuplicates(["did", "text_key"]).join(by_node, "node", "left").select(
        "did", "text_key", F.col("n").alias("n_shingles"),
        F.nullif(F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("did")), F.lit((1 << 63) - 1)).alias("component_id"))
    return rows, found


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row."""
    rows, found = near_duplicates(docs, id_col, text_col)
    at = docs.columns.index(id_col)
    return (rows.select(F.col(f"c{at}").cast("long").alias("doc_id"), "did", "text_key").join(found, ["did", "text_key"])
            .select("doc_id", "n_shingles", "component_id"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same columns; of each component one row, that with its smallest id.

    Rows without n-grams all stay. Of rows that share that id, and of components without any id, one stays."""
    rows, found = near_duplicates(docs, id_col, text_col)
    kept = found.where("n_shingles > 0").withColumn("of", F.coalesce("component_id", F.lit((1 << 63) - 1))).where("did = of")
    one = kept.groupBy("of").agg(F.min("text_key").alias("text_key")).select(F.col("of").alias("did"), "text_key")
    few = found.where("n_shingles = 0").select("did", "text_key", F.lit(False).alias("once"))
    chosen = one.select("did", "text_key", F.lit(True).alias("once")).unionByName(few)
    joined = rows.join(chosen, ["did", "text_key"])
    single = joined.where("once").dropDuplicates(["did", "text_key"]).unionByName(joined.where("not once"))
    return single.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
