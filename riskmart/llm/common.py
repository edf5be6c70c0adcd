"""Column picking, Arrow streams and rolling hashes that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskmart.session import ship, tune

#: Odd multiplier of the polynomial hashes and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Rows that go to Python at once; a batch holds whole texts.
BATCH_ROWS = 200


def prepared(spark: SparkSession) -> SparkSession:
    """Join settings, the package on the executors, and Arrow batches of few rows, since a row holds a whole text."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return tune(spark)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``name=source``: the named columns alone, matched exactly and by position, so that further columns
    whose names differ in case only do not clash. The first of equal names counts."""
    place = {}
    for i, c in enumerate(df.columns):
        place.setdefault(c, i)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{place[source]}").alias(name) for name, source in columns.items()])


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with text never null."""
    found = pick(docs, doc_id=id_col, text=text_col)
    return found.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def bounded_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """About ``limit`` rows at most, chosen by the hash of ``key``; all where there are no more. Each task decides on its
    own rows, so nothing is sorted or gathered for it."""
    n = df.count()
    if n <= limit:
        return df
    scale = 1 << 40
    return df.where(F.pmod(F.xxhash64(key), F.lit(scale)) < int(limit * scale / n))


def stream(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column as one array, and where each row begins (one more entry than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit hash over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and INVERSE**i modulo 2**64 for i up to n."""
    have = _powers.get("up")
    if have is None or len(have) <= n:
        size = max(n + 1, 1 << 16)
        for name, base in (("up", BASE), ("down", INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"], _powers["down"]


def prefix_hash(tokens: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes: entry i covers the first i tokens (uint64)."""
    up, _ = powers(len(tokens))
    out = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(tokens * up[:len(tokens)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of tokens[begin:end] for arrays of positions, the length mixed in."""
    _, down = powers(len(prefix))
    h = (prefix[end] - prefix[begin]) * down[begin]
    return mixed(h + (end - begin).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def byte_codes(seed: int = 7) -> np.ndarray:
    """A random odd 64-bit code for each byte."""
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)


#: Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
#: A-Z as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]`: digits, a-z and whatever is not ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def word_bounds(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word in the stream, and for each row the index of its first word (one entry more).

    Words never cross rows. The separators are ASCII, so UTF-8 sequences are never cut."""
    n = len(data)
    if n == 0:
        zero = np.zeros(0, np.int64)
        return zero, zero, np.zeros(len(bounds), np.int64)
    inside = is_word[data]
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:n]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return begin, end, np.searchsorted(begin, bounds)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """64-bit hash of each word; works through the stream in blocks of bounded size."""
    out, step = np.empty(len(begin), np.uint64), 1 << 15
    for i in range(0, len(begin), step):
        b, e = begin[i:i + step], end[i:i + step]
        lo = b[0]
        prefix = prefix_hash(codes[data[lo:e[-1]]])
        out[i:i + step] = span_hash(prefix, b - lo, e - lo)
    return out


def blocks(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.Table]:
    """Neighbouring batches cut anew into tables of about ``size`` bytes of text (column ``text``), whole rows each."""
    pa.set_memory_pool(pa.system_memory_pool())  # gives back what a worker no longer needs
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        _, bounds = stream(table.column("text"))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + size, "right")) - 1)
            yield table.slice(start, stop - start)
            start = stop


KINDS = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
         "binary": pa.binary(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()),
         "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64())}


def shown(names: list[str], extra: dict[str, str]) -> list:
    """Columns c0, c1, ... under their names and x0, x1, ... under those of ``extra``, in place of a column of that name."""
    made = list(extra)
    return [*[F.col(f"x{made.index(c)}" if c in extra else f"c{i}").alias(c) for i, c in enumerate(names)],
            *[F.col(f"x{i}").alias(c) for i, c in enumerate(made) if c not in names]]


def per_text(docs: DataFrame, work, extra: dict[str, str], text_col: str = "text", keep: list[str] | None = None,
             size: int = 4 << 20, choose: bool = False) -> DataFrame:
    """The columns ``keep`` (all where None, under their own names) and those that ``work`` makes of the texts.

    ``work`` is called once per task and returns a function from a string array without nulls (a block of whole
    texts) to one list per entry of ``extra`` (name: type). With ``choose`` it returns one more list before these,
    of booleans, and only rows with true stay. A null text goes in as the empty one; the kept column stays null.
    Names of ``extra`` replace kept columns of the same name."""
    own = docs if keep is None else pick(docs, **{c: c for c in dict.fromkeys([*keep, text_col])})
    names = docs.columns if keep is None else keep
    n = len(names)
    at = own.columns.index(text_col)
    inner = own.toDF(*[f"c{i}" for i in range(len(own.columns))])
    inner = inner.select(*[f"c{i}" for i in range(n)], F.coalesce(F.col(f"c{at}").cast("string"), F.lit("")).alias("text"))
    schema = ", ".join([*[f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(inner.schema[:n])],
                        *[f"x{i} {kind}" for i, kind in enumerate(extra.values())]])
    labels = [*[f"c{i}" for i in range(n)], *[f"x{i}" for i in range(len(extra))]]

    def run(batches):
        do = work()
        for block in blocks(batches, size):
            found = list(do(block.column("text").combine_chunks()))
            chosen = pa.array(found.pop(0)) if choose else None
            made = [pa.array(x, KINDS[kind]) for x, kind in zip(found, extra.values())]
            out = pa.RecordBatch.from_arrays([*[block.column(i).combine_chunks() for i in range(n)], *made], names=labels)
            yield out.filter(chosen) if choose else out

    return inner.mapInArrow(run, schema).select(*shown(names, extra))
