"""Importance resampling towards a target: hashed n-gram counts as bit planes, weighed by bit-sliced gains."""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskmart.llm.common import ALNUM, LOWER, blocks, documents, pick, stream, word_bounds
from riskmart.session import written

BUCKETS = 10000
LEAST_WORDS = 20
SHARE = 25
SEED = 7
#: Texts whose dense bucket counts are held at once.
ROWS = 256
#: Words longer than this have their checksums taken one by one.
LONG = 64


@lru_cache(maxsize=1)
def _crc_steps() -> np.ndarray:
    """What a CRC-32 register takes up for each value of its low byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def checksums(data: np.ndarray, begin: np.ndarray, end: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of each word, and of the word before it, a space and the word; the latter where ``follows`` only.

    All words advance by a byte at once, the long ones first in line, so that those at work are a slice. The checksum of
    two joined strings is that of the first, advanced over as many zero bytes as the second has, xor that of the second."""
    steps, size = _crc_steps(), end - begin
    line = np.argsort(-np.minimum(size, LONG + 1), kind="stable")
    long = int(np.searchsorted(-size[line], -LONG, "left"))
    at, register = begin[line], np.full(len(line), 0xFFFFFFFF, np.uint32)
    left = np.searchsorted(-size[line], -np.arange(LONG + 1), "left")  # how many words have more bytes than this
    for k in range(LONG):
        n = int(left[k])
        if n <= long:
            break
        own = register[long:n]
        register[long:n] = (own >> 8) ^ steps[(own ^ data[at[long:n] + k]) & 255]
    one = np.empty(len(line), np.uint32)
    one[line] = ~register
    for w in line[:long].tolist():
        one[w] = zlib.crc32(data[begin[w]:end[w]])
    spaced = ~one
    spaced = ~((spaced >> 8) ^ steps[(spaced ^ 32) & 255])
    previous = np.zeros(len(line), np.uint32)
    previous[1:] = spaced[:-1]
    register = previous[line]
    for k in range(LONG):
        n = int(left[k])
        if n <= long:
            break
        own = register[long:n]
        register[long:n] = (own >> 8) ^ steps[own & 255]
    two = np.empty(len(line), np.uint32)
    two[line] = register
    two ^= one
    for w in line[:long].tolist():
        two[w] = zlib.crc32(data[begin[w]:end[w]], int(previous[w]))
    return one, two[follows]


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of each run of one or two words, in the order of the texts, and each text's number of words."""
    data, bounds = stream(texts)
    data = LOWER[data]
    begin, end, first = word_bounds(data, bounds, ALNUM)
    words = np.diff(first)
    text = np.repeat(np.arange(len(words)), words)
    follows = np.ones(len(text), bool)
    follows[first[:-1][words > 0]] = False
    one, two = checksums(data, begin, end, follows)
    return np.concatenate([text, text[follows]]), np.concatenate([one, two]) % np.uint32(buckets), words


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts, a row per bucket that holds a feature: each task sends its sums only."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for block in blocks(batches):
            total += np.bincount(features(block.column("text").combine_chunks(), buckets)[1], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["bucket", "n"])

    texts = pick(docs, text=text_col).select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket, in thousandths of the logarithm of how much likelier the target has it; ``buckets``, a
    parameter and no matter of the input, bounds what reaches the driver."""
    both = source.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    counts = np.zeros((2, buckets), np.int64)
    for bucket, s, t in both.groupBy("bucket").agg(F.sum("s"), F.sum("t")).toLocalIterator():
        counts[:, bucket] = s, t
    s, t = counts.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def sliced(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1)
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def gain_planes(gain: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(power, plane): signed numbers are sums of their bits' powers of two, the highest of them negative."""
    width = int(max(gain.max(initial=0), ~gain.min(initial=0))).bit_length()
    planes = [(1 << k, sliced((gain >> k & 1).astype(bool)[None])[0]) for k in range(width)]
    return [*planes, (-(1 << width), sliced((gain < 0)[None])[0])]


def weighed(counts: np.ndarray, planes: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Sum of count times gain for each row of dense counts: a bit of the counts meets a bit of the gains as the AND of
    two planes, its ones are counted, and powers of two add them up: exact, without a product."""
    total, rows, bit = np.zeros(len(counts), np.int64), np.arange(len(counts)), 0
    most = counts.max(axis=1, initial=0)
    while len(rows := rows[most[rows] >> bit > 0]):  # texts that have a count of so many bits
        plane = sliced((counts[rows] >> bit & 1).astype(bool))
        for power, gain in planes:
            total[rows] += (power << bit if power > 0 else -(-power << bit)) * np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
        bit += 1
    return total


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) per text: the mean gain of its features, rounded down; 0 without any."""
    buckets, content = len(gain), gain.tolist()

    def run(batches):
        planes = gain_planes(np.array(content, np.int64))
        for block in blocks(batches):
            text, bucket, words = features(block.column("text").combine_chunks(), buckets)
            n_features = np.bincount(text, minlength=len(words))
            order = np.argsort(text, kind="stable")
            text, bucket, until = text[order], bucket[order], np.r_[0, np.cumsum(n_features)]
            sums = np.zeros(len(words), np.int64)
            for low in range(0, len(words), ROWS):
                high = min(low + ROWS, len(words))
                own = slice(until[low], until[high])
                cells = (text[own] - low) * buckets + bucket[own]
                counts = np.bincount(cells, minlength=(high - low) * buckets).astype(np.int32).reshape(high - low, buckets)
                sums[low:high] = weighed(counts, planes)
            yield pa.RecordBatch.from_arrays([
                block.column("doc_id").combine_chunks(), pa.array(words.astype(np.int64)), pa.array(n_features.astype(np.int64)),
                pa.array(sums // np.maximum(n_features, 1))], names=["doc_id", "n_words", "n_features", "weight"])

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
              share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every text of ``docs``: ``rank`` counts those drawn, from 1.

    Features are runs of one or two words, repeats counted, hashed into ``buckets``. A text's weight is its mean gain
    towards ``target``; its score adds noise of the Gumbel law that ``seed`` and the id decide, so the ``share`` per cent
    of highest scores among texts of ``least_words`` words are a draw without replacement in proportion to the weights.

    A null or empty text has no words, weight 0 and no rank. A null id draws its noise as the text ``null`` and comes
    last among equal scores; rows equal in id and score are ranked one after the other. Empty tables, of documents or
    targets, are counted as such: no rows, or gains of the corpus alone. Further columns, whatever their names, are ignored.

    The driver gets ``buckets`` sums and a row per partition; ranks come from a sort by ranges of scores, so no task gets
    more rows of one score than of another."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text, buckets), buckets)
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256),
                               1, 8), 16, 10).cast("double")
    score = F.col("weight") + F.floor(-1000 * F.ln(-F.ln((noise + 0.5) / 4294967296.0)))
    scored = written(weights(docs, gain, id_col, text_col).select(
        F.monotonically_increasing_id().alias("uid"), "*", score.alias("score")), "importance-scores")
    enough = F.col("n_words") >= least_words
    line = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("uid")]
    # the number of a row in a sorted partition, and above it that of the partition
    sorted_ = written(scored.where(enough).repartitionByRange(*line).sortWithinPartitions(*line).select(
        "*", F.monotonically_increasing_id().alias("place")), "importance-order")
    split = 1 << 33
    parts = sorted_.groupBy(F.expr(f"place div {split}").alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    drawn = share * sum(r.n for r in parts) // 100
    before, starts = 0, []
    for part, n in parts:
        starts.append((part, before))
        before += n
    offsets = sorted_.sparkSession.createDataFrame(starts, "part long, before long")  # a row per partition of the sort
    rank = F.col("before") + F.expr(f"place % {split}") + 1
    ranked = sorted_.withColumn("part", F.expr(f"place div {split}")).join(F.broadcast(offsets), "part").select(
        "doc_id", "n_words", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))
    return ranked.unionByName(scored.where(~enough).select(
        "doc_id", "n_words", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))
