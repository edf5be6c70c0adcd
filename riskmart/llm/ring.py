"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations alone."""

from __future__ import annotations

import math
import zlib

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskmart.llm.common import pick
from riskmart.session import written

#: The ring is cut into so many cells: the plan of all moves has about one row per cell at any input size.
CELLS = 1 << 16
VIRTUAL_NODES = 128
#: Copies of one row that a task lists at once.
CHUNK = 10_000

SIZES = "octet_length(text) + 8L"


def nodes(shards: int, virtual: int = VIRTUAL_NODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """(cell, shard) of each virtual node in ring order; a node's place depends on its shard and number alone."""
    return sorted((zlib.crc32(f"{shard}:{v}:{zlib.crc32(str(shard * 7919 + v).encode())}".encode()) % cells, shard)
                  for shard in range(shards) for v in range(virtual))


def moves(counts: dict[int, int], shards: int, slack: float = 0.0, cells: int = CELLS,
          virtual: int = VIRTUAL_NODES) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, last rank + 1, shard, first slot): where the keys of each cell go.

    The keys arrive in ring order. Each goes to the first virtual node at or after its cell whose shard is
    not full. With no slack the capacities sum up to the keys, so counts end at most one apart; with slack
    every shard takes up to ``(1 + slack) * keys / shards``, rounded up, and fewer keys move."""
    total = sum(counts.values())
    if slack:
        room = [math.ceil((1 + slack) * total / shards)] * shards
    else:
        room = [total // shards + (shard < total % shards) for shard in range(shards)]
    load, ring = [0] * shards, nodes(shards, virtual, cells)
    onward = list(range(len(ring)))  # the next virtual node with room, found with path halving

    def with_room(v: int) -> int:
        while room[ring[v][1]] == load[ring[v][1]]:
            if onward[v] == v:
                onward[v] = (v + 1) % len(ring)
            step = onward[v]
            if onward[step] != step:
                onward[v] = onward[step]
            v = step
        return v

    out, home = [], 0
    for cell in sorted(counts):
        while home < len(ring) and ring[home][0] < cell:
            home += 1
        rank, end, v = 0, counts[cell], home % len(ring)
        while rank < end:
            v = with_room(v)
            shard = ring[v][1]
            taken = min(end - rank, room[shard] - load[shard])
            out.append((cell, rank, rank + taken, shard, load[shard]))
            load[shard] += taken
            rank += taken
    return out


def shard(docs: DataFrame, shards: int, slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): one row per input row.

    A row's place on the ring is the hash of its id, size and text checksum, so that neither a null id nor one
    id on many rows heaps up. A null text has size 8 and checksum 0. Rows equal in all three are counted
    before the shuffle, ranked as one and listed again at the end in chunks; their slots are interchangeable.
    Other ties in a cell are ranked by id (nulls first), checksum and size. An empty table gives no rows.

    Only the counts per cell (``CELLS`` rows at most) reach the driver, and the plan of moves that is
    broadcast has at most one row per cell and one more per shard that fills up."""
    spark = docs.sparkSession
    found = pick(docs, doc_id=id_col, text=text_col).selectExpr(
        "cast(doc_id as long) doc_id", f"cast(coalesce({SIZES}, 8L) as long) size",
        "crc32(coalesce(cast(text as binary), X'')) text_crc32")
    places = written(found.selectExpr("*", f"cast(pmod(xxhash64(doc_id, text_crc32, size), {CELLS}) as int) cell")
                     .groupBy("cell", "doc_id", "text_crc32", "size").agg(F.count("*").alias("copies")), "ring")
    counts = {r["cell"]: r["n"] for r in places.groupBy("cell").agg(F.sum("copies").alias("n")).collect()}
    plan = _plan(spark, moves(counts, shards, slack))
    before = Window.partitionBy("cell").orderBy("doc_id", "text_crc32", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = (places.withColumn("first", F.coalesce(F.sum("copies").over(before), F.lit(0)))
              .withColumn("chunk", F.explode(F.expr(f"sequence(0L, (copies - 1) div {CHUNK})")))
              .withColumn("rank", F.explode(F.expr(
                  f"sequence(first + chunk * {CHUNK}, first + least(copies, (chunk + 1) * {CHUNK}) - 1)"))))
    return (ranked.join(F.broadcast(plan), "cell").where("rank >= from_rank and rank < to_rank")
            .selectExpr("doc_id", "size", "text_crc32", "'rows' law", "shard", "from_slot + rank - from_rank slot",
                        "cast(null as int) grown_shard"))


def _plan(spark: SparkSession, rows: list[tuple[int, int, int, int, int]]) -> DataFrame:
    return spark.createDataFrame(rows, "cell int, from_rank long, to_rank long, shard int, from_slot long")
