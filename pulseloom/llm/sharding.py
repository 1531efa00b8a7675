"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has many virtual nodes on a ring of 64-bit positions, and a key belongs to the next
node clockwise. Shards are full at a fixed number of rows. What a full shard cannot take goes on
to the next node clockwise, until a shard has room.

Which keys overflow is settled by counts alone: within an arc (the keys between two nodes) keys
stand in ring order, so the walk moves intervals of ranks, not keys. It runs on shards x nodes
counts, however many rows there are; each row then looks its rank up in the intervals.

With ``slack`` 0 the capacities add up to the number of rows, so shard sizes are at most one
apart (the law ``rows``). With more slack sizes may differ by that share and fewer keys move when
a shard is added.

Defined results
---------------
* A NULL text has no bytes; its size is the constant of 8. Its CRC-32 is 0, that of an empty text.
* NULL keys share one ring position and spread clockwise like any other hot key.
* Rows with equal keys stand in the order of their checksum; rows equal in that too are
  interchangeable. Which shard a row gets follows from the rows alone, not from their order,
  but for such equal rows.
* An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.functions.ordering import global_rank
from pulseloom.session import materialise

#: Bytes that a row takes besides its text.
ROW_BYTES = 8


def ring(shards: int, nodes: int) -> tuple[list[int], list[int]]:
    """Sorted positions of all virtual nodes, and the shard of each. A shard's nodes depend on it alone."""
    placed = sorted(
        (int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big", signed=True), s)
        for s in range(shards)
        for v in range(nodes)
    )
    return [p for p, _ in placed], [s for _, s in placed]


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows a shard takes at most; without slack they add up to ``rows``."""
    if slack:
        return [-int(-rows * (1 + slack) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(counts: Sequence[int], owners: Sequence[int], capacity: Sequence[int]) -> list[tuple[int, int, int, int, int]]:
    """Intervals (arc, first rank, end rank, shard, first slot) that hold every key once.

    All keys try the node of their own arc first, then all that are left the next one, and so on.
    """
    used = [0] * len(capacity)
    pieces = []
    waiting = [(arc, 0, n) for arc, n in enumerate(counts) if n]
    for step in range(len(owners)):
        left = []
        for arc, low, high in waiting:
            shard = owners[(arc + step) % len(owners)]
            take = min(capacity[shard] - used[shard], high - low)
            if take:
                pieces.append((arc, low, low + take, shard, used[shard]))
                used[shard] += take
            if low + take < high:
                left.append((arc, low + take, high))
        waiting = left
        if not waiting:
            break
    return pieces


def assign(docs: DataFrame, shards: int, nodes: int = 128, slack: float = 0.0, key: str = "doc_id") -> DataFrame:
    """key, size, text_crc32, shard and a gapless slot within the shard, per row."""
    spark = docs.sparkSession
    positions, owners = ring(shards, nodes)

    @F.pandas_udf("int")
    def arc_of(position: pd.Series) -> pd.Series:
        """The first node at or after a position; past the last one the ring starts again."""
        found = np.searchsorted(np.array(positions, dtype=np.int64), position.to_numpy())
        return pd.Series((found % len(positions)).astype(np.int32))

    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col(key).alias("_key"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
        F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("ring")).alias("_position"),
    )
    rows = materialise(rows.withColumn("_arc", arc_of("_position")), "ring")
    counts = [0] * len(owners)
    for arc, n in rows.groupBy("_arc").count().collect():  # shards x nodes at most
        counts[arc] = n
    starts = np.concatenate([[0], np.cumsum(counts)]).tolist()
    pieces = walk(counts, owners, capacities(starts[-1], shards, slack))
    plan = spark.createDataFrame(
        [(a, starts[a] + low, starts[a] + high, s, slot) for a, low, high, s, slot in pieces],
        "_arc int, _low long, _high long, shard int, _slot long",
    )
    # The arc that wraps round the end of the ring holds both ends; its order is by position too.
    ranked = global_rank(rows, [F.col(c) for c in ("_arc", "_position", "_key", "text_crc32")], "_rank", start=-1)
    inside = [ranked["_arc"] == plan["_arc"], ranked["_rank"] >= plan["_low"], ranked["_rank"] < plan["_high"]]
    # At most two intervals per node, plus one per shard that fills up within an arc.
    placed = ranked.join(F.broadcast(plan), inside)
    slot = (F.col("_slot") + F.col("_rank") - F.col("_low")).alias("slot")
    return placed.select(F.col("_key").alias(key), "size", "text_crc32", "shard", slot)


def nearest_node(positions: Sequence[int], position: int) -> int:
    """The arc of one position, as ``assign`` finds it."""
    return bisect.bisect_left(positions, position) % len(positions)
