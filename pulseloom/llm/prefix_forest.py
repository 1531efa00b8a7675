"""Approximate nearest neighbours by a hash-prefix forest.

Each tree hashes a vector to a long bit string, one random hyperplane per bit, and keeps the
strings as a sorted array. A query finds its longest prefix match in every tree and then ascends
in all trees together: prefixes get shorter by one bit at a time, and with them the ranges of the
sorted arrays longer, until the ranges hold enough candidates. Candidates are ranked by their
exact cosine.

Vectors are dealt by hash to shards of about ``SHARD_ROWS``, and every shard has a forest of its
own, so a task holds one shard and one block of queries. A search takes all candidates of the
last level, however many they are.

Equal vectors are one entry of the index, with the smallest ids that a result can need; a vector
that a third of all rows share costs one entry.

Defined results
---------------
* Vectors that are NULL, zero, or hold NULL or non-finite components take no part, neither do
  vectors of another length than the most common one (of equally common ones, the shorter).
* Ties go to the smaller id. Fewer candidates than asked for are all returned.
* Rows that repeat an id and its vector count once. NULL ids take no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseloom.session import materialise

TREES, BITS = 64, 32
SHARD_ROWS = 8192
#: Queries that a task searches at a time.
QUERY_BLOCK = 2048
#: Prefixes are shortened until the ranges of all trees hold this share of the shard's rows, and as many as are asked for.
EFFORT = 0.6


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id and vector (doubles) of the rows that take part."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite).where(squares > 0)
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (sizes["n"] if sizes else 0))


@dataclass(frozen=True)
class Forest:
    """classes: vector, class (its smallest id) and ids (the smallest); shards: one row per forest."""

    classes: DataFrame
    shards: DataFrame
    count: int
    neighbours: int


def hyperplanes(dimension: int) -> np.ndarray:
    """[tree, dimension, bit], the same everywhere."""
    return np.random.default_rng(20240607).standard_normal((TREES, dimension, BITS))


def hash_strings(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """[tree, row]: the bit string of each vector as a number, first bit highest."""
    weights = (1 << np.arange(BITS - 1, -1, -1, dtype=np.uint64)).astype(np.uint64)
    return np.stack([((vectors @ p > 0) * weights).sum(axis=1, dtype=np.uint64) for p in planes])


def build(vectors: DataFrame, neighbours: int) -> Forest:
    """Index usable vectors for searches of up to ``neighbours``; written to the shared folder."""
    place = F.dense_rank().over(Window.partitionBy("vector").orderBy("id"))
    # Each task keeps its smallest ids of a vector before the shuffle.
    nearest = vectors.withColumn("_place", place).where(F.col("_place") <= neighbours + 1)
    classes = nearest.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    classes = materialise(classes.withColumn("class", F.col("ids")[0]), "vectors")
    count = max(1, -(-classes.count() // SHARD_ROWS))

    def grow(table: pa.Table) -> pa.Table:
        matrix = np.stack(table.column("vector").to_numpy())
        keys = hash_strings(matrix, hyperplanes(matrix.shape[1]))
        order = np.argsort(keys, axis=1, kind="stable").astype(np.int32)
        blobs = [matrix.tobytes(), table.column("class").to_numpy().tobytes()]
        blobs += [np.take_along_axis(keys, order, axis=1).tobytes(), order.tobytes()]
        names = ["shard", "vectors", "classes", "keys", "orders"]
        return pa.table([table.column("shard").slice(0, 1), *[pa.array([b], pa.binary()) for b in blobs]], names)

    dealt = classes.select("class", "vector", F.pmod(F.xxhash64("class", "vector"), F.lit(count)).cast("int").alias("shard"))
    schema = "shard int, vectors binary, classes binary, keys binary, orders binary"
    shards = materialise(dealt.groupBy("shard").applyInArrow(grow, schema), "forest")
    return Forest(classes, shards, count, neighbours)


def _ranges(keys: np.ndarray, query_keys: np.ndarray, wanted: float) -> tuple[np.ndarray, np.ndarray]:
    """Per tree and query the range of the sorted array that the ascent ends at."""
    trees, queries = query_keys.shape
    low, high = np.zeros((trees, queries), np.int64), np.zeros((trees, queries), np.int64)
    going = np.arange(queries)
    for length in range(BITS, -1, -1):
        drop = np.uint64(BITS - length)
        first = (query_keys[:, going] >> drop) << drop
        last = first + np.uint64((1 << int(drop)) - 1)
        for t in range(trees):
            low[t, going] = np.searchsorted(keys[t], first[t], "left")
            high[t, going] = np.searchsorted(keys[t], last[t], "right")
        going = going[(high[:, going] - low[:, going]).sum(axis=0) < wanted]
        if not len(going):
            break
    return low, high


def search(forest: Forest, queries: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found for each query (id, vector), itself left out.

    Queries are vectors of the index.
    """
    wanted = forest.neighbours
    asked = queries.join(forest.classes.select("vector", "class"), "vector").select(F.col("id").alias("query_id"), "class", "vector")
    asked = materialise(asked.distinct(), "queries")
    distinct = asked.select("class", "vector").distinct()
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def look(index: pa.Table, block: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], []]
        if index.num_rows and block.num_rows:
            row = {n: index.column(n)[0].as_py() for n in ("vectors", "classes", "keys", "orders")}
            own = np.frombuffer(row["classes"], np.int64)
            matrix = np.frombuffer(row["vectors"], np.float64).reshape(len(own), -1)
            keys = np.frombuffer(row["keys"], np.uint64).reshape(TREES, -1)
            orders = np.frombuffer(row["orders"], np.int32).reshape(TREES, -1)
            norms = np.sqrt((matrix * matrix).sum(axis=1))
            points, names = np.stack(block.column("vector").to_numpy()), block.column("class").to_numpy()
            low, high = _ranges(keys, hash_strings(points, hyperplanes(points.shape[1])), max(EFFORT * len(own), (wanted + 1) * TREES))
            for q, (point, name) in enumerate(zip(points, names, strict=True)):
                taken = np.zeros(len(own), bool)
                for t in range(TREES):
                    taken[orders[t, low[t, q] : high[t, q]]] = True
                near = np.flatnonzero(taken)
                scores = (matrix[near] @ point) / (norms[near] * math.sqrt(point @ point))
                if len(near) > wanted + 1:
                    least = np.partition(scores, -wanted - 1)[-wanted - 1]
                    near, scores = near[scores >= least], scores[scores >= least]
                best = np.lexsort((own[near], -scores))[: wanted + 1]
                for column, values in zip(found, (np.full(len(best), name), own[near][best], scores[best]), strict=True):
                    column.append(values)
        columns = [np.concatenate(c) if c else np.empty(0, k) for c, k in zip(found, (np.int64, np.int64, np.float64), strict=True)]
        return pa.table(columns, ["class", "near", "score"])

    block = F.pmod(F.xxhash64("class", F.lit("block")), F.lit(blocks)).cast("int").alias("block")
    shard = F.explode(F.sequence(F.lit(0), F.lit(forest.count - 1))).alias("shard")
    dealt = distinct.select("class", "vector", block, shard)
    copies = forest.shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = copies.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block"))
    found = pairs.applyInArrow(look, "class long, near long, score double")

    def best(frame: DataFrame, key: str, name: str, n: int) -> DataFrame:
        order = Window.partitionBy(key).orderBy(F.desc("score"), name)
        return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    # Of a class only its smallest ids can be among the nearest, and one of them may be the query.
    found = best(found, "class", "near", wanted + 1)
    members = forest.classes.select(F.col("class").alias("near"), F.explode("ids").alias("vec_id"))
    found = best(found.join(members, "near").select("class", "vec_id", "score"), "class", "vec_id", wanted + 1)
    found = asked.select("query_id", "class").join(found.drop("rank"), "class").where("vec_id <> query_id")
    return best(found, "query_id", "vec_id", wanted).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, neighbours: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Index all rows and search for those that ``is_query`` (a condition on ``id``) picks."""
    rows = usable(vectors, key, vector)
    return search(build(rows, neighbours), rows.where(is_query))
