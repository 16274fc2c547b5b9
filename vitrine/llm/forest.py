"""Nearest neighbours from a hash-prefix forest.

Each tree gives every vector a long hash string: its sides of 32 random hyperplanes through the mean. A tree is the
table of vectors sorted by hash string, cut into packed blocks of consecutive entries; rows that share a prefix of any
length are neighbours in it. Every query starts at one depth in all trees, at which a range is a block or two of evenly
spread vectors, and compares with the blocks it meets there; bits behind that depth only sort. The distance found so far tells how probable it is that a true neighbour shares a prefix of ``x`` bits
with it in no tree; the query then jumps, in all trees at once, to the longest prefix length at which that is less
than ``MISS``, and compares with every block of those ranges. Ranges are met by an equality join on (tree, length,
prefix), so no row is paired with rows outside them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from vitrine.llm.store import stored

TREES, BITS = 12, 32
BLOCK = 2048          # vectors of a packed block
MISS = 0.03           # probability of missing a neighbour as far as the last one found
QUERIES_AT_ONCE = 4096
SEED = 71


def usable(column: str, dimension: int | None = None) -> Column:
    """Vectors without nulls and non-finite components that are not zero (and have ``dimension`` components)."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    out = F.col(column).isNotNull() & finite & F.exists(column, lambda x: x != 0)
    return out if dimension is None else out & (F.size(column) == dimension)


def _planes(dimension: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dimension, TREES * BITS))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def hash_strings(vectors: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Hash string of each vector in each tree, as an integer of ``BITS`` bits, first hyperplane first."""
    side = ((vectors - mean) @ _planes(len(mean)) > 0).reshape(len(vectors), TREES, BITS)
    return (side * (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))).sum(axis=2)


def _mean(vectors: DataFrame, dimension: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = _matrix(batch.column("embedding"), dimension).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimension)), pa.array(total)], ["i", "total"])

    sums = vectors.select("embedding").mapInArrow(run, "i long, total double").groupBy("i").agg(F.sum("total").alias("t"))
    return sums.orderBy("i").toPandas()["t"].to_numpy(float) / vectors.count()


def _in_trees(vectors: DataFrame, mean: np.ndarray, dtype: str) -> DataFrame:
    """One row for each vector and tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                data = _matrix(part.column("embedding"), len(mean))
                keys, n = hash_strings(data, mean), len(data)
                packed = [v.tobytes() for v in data.astype(dtype)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(TREES, dtype=np.int32), n)), pa.array(keys.ravel()),
                     pa.array(np.repeat(part.column("vec_id").to_numpy(zero_copy_only=False), TREES)),
                     pa.array([p for p in packed for _ in range(TREES)], pa.binary())],
                    ["tree", "key", "vec_id", "vector"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, "tree int, key long, vec_id long, vector binary")


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive entries of a sorted tree, packed."""
    tree, rows = None, []

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"tree": tree, "low": rows[0][0], "high": rows[-1][0], "n": len(rows),
              "ids": np.array([r[1] for r in rows], np.int64).tobytes(), "vectors": b"".join(r[2] for r in rows)}],
            pa.schema([("tree", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("n", pa.int32()),
                       ("ids", pa.binary()), ("vectors", pa.binary())]))

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("tree", "key", "vec_id", "vector")]
        for t, key, vec_id, vector in zip(*columns, strict=True):
            if rows and (t != tree or len(rows) == BLOCK):
                yield block()
                rows = []
            tree = t
            rows.append((key, vec_id, vector))
    if rows:
        yield block()


FOUND = "query_id long, vec_id long, score double, angle double"


def nearest_in_block(ids: np.ndarray, data: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, mean: np.ndarray,
                     k: int) -> list[np.ndarray]:
    """For each query its k nearest of the block, itself left out: query, vector, distance, angle seen from the mean.

    Rows with one vec_id are one candidate, at their smallest distance.
    """
    order = np.argsort(ids, kind="stable")
    ids, data = ids[order], data[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    squares = (data ** 2).sum(axis=1)
    out: list[list[np.ndarray]] = [[], [], [], []]
    for at in range(0, len(queries), 256):
        q, q_ids = queries[at:at + 256], query_ids[at:at + 256]
        rough = (q ** 2).sum(axis=1)[:, None] + squares[None, :] - 2 * q @ data.T
        rough[np.isnan(rough)] = np.inf
        rough[q_ids[:, None] == ids[None, :]] = np.inf
        least = rough if len(first) == len(ids) else np.minimum.reduceat(rough, first, axis=1)
        limit = np.partition(least, k - 1, axis=1)[:, k - 1] if len(first) > k else np.full(len(q), np.inf)
        slack = 1e-9 * ((q ** 2).sum(axis=1) + squares.max())
        for i in range(len(q)):
            near = np.flatnonzero((rough[i] <= limit[i] + slack[i]) & (ids != q_ids[i]))
            distance = np.sqrt(np.cumsum((data[near] - q[i]) ** 2, axis=1)[:, -1])  # summed in order of components
            best = np.lexsort((distance, ids[near]))
            best = best[np.append(True, ids[near[best[1:]]] != ids[near[best[:-1]]])] if len(best) else best
            best = best[np.lexsort((ids[near[best]], distance[best]))][:k]
            near, distance = near[best], distance[best]
            x, y = q[i] - mean, data[near] - mean
            size = np.linalg.norm(x) * np.linalg.norm(y, axis=1)
            cosine = np.divide(y @ x, size, out=np.ones(len(near)), where=size > 0)
            for column, values in zip(out, (np.full(len(near), q_ids[i]), ids[near], distance,
                                            np.arccos(np.clip(cosine, -1, 1))), strict=True):
                column.append(values)
    return [np.concatenate(c) if c else np.zeros(0) for c in out]


def _compare(blocks: DataFrame, met: DataFrame, queries: DataFrame, mean: np.ndarray, dtype: str, k: int) -> DataFrame:
    """The k nearest that each query finds in the blocks it meets (``met``: query_id, block)."""
    salts = max(1, math.ceil(queries.count() / QUERIES_AT_ONCE))
    salt = F.pmod(F.xxhash64("query_id"), F.lit(salts)).cast("int")
    asked = stored(met.distinct().join(queries, "query_id").select("block", "query_id", "embedding", salt.alias("salt")), "asked")
    copies = blocks.select("block", "ids", "vectors", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))

    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score", "angle"]
        if not block.num_rows or not queries.num_rows:
            return pa.table([pa.array([], pa.int64())] * 2 + [pa.array([], pa.float64())] * 2, names)
        ids = np.frombuffer(block["ids"][0].as_buffer(), np.int64)
        data = np.frombuffer(block["vectors"][0].as_buffer(), dtype).reshape(len(ids), -1).astype(np.float64)
        asked = _matrix(queries["embedding"].combine_chunks(), data.shape[1])
        q, v, d, a = nearest_in_block(ids, data, queries["query_id"].to_numpy(), asked, mean, k)
        return pa.table([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(d, pa.float64()),
                         pa.array(a, pa.float64())], names)

    found = copies.groupBy("block", "salt").cogroup(asked.groupBy("block", "salt")).applyInArrow(run, FOUND)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"), F.min("angle").alias("angle")) \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


RESULT = "query_id long, rank int, vec_id long, score double"


def nearest(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the k nearest rows to each row where ``is_query``.

    ``vectors`` has vec_id and embedding (array of float or double). Rows with a null vec_id, and vectors that are null,
    zero, hold null or non-finite components or are not of the commonest length (the shorter of two as common) take no
    part. Ties go to the smaller vec_id. Rows with one vec_id count as one candidate, at their smallest distance, and
    none of them is its own neighbour. An empty table gives no row. Results are approximate: raise ``TREES`` or lower
    ``MISS`` for more recall.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["embedding"].dataType.elementType
    dtype = "<f4" if isinstance(kind, T.FloatType) else "<f8"
    clean = vectors.where(F.col("vec_id").isNotNull() & usable("embedding"))
    common = clean.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return spark.createDataFrame([], RESULT)
    dimension = common["n"]
    clean = clean.where(F.size("embedding") == dimension).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding",
                                                                 is_query.alias("is_query"))
    # Repeated rows would lie side by side in every tree and fill whole blocks.
    clean = stored(clean.groupBy("vec_id", "embedding").agg(F.max("is_query").alias("is_query")), "vectors")
    mean = _mean(clean, dimension)
    blocks = stored(_in_trees(clean, mean, dtype)
                    .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "tree", "key", "vec_id")
                    .sortWithinPartitions("tree", "key", "vec_id")
                    .mapInArrow(_to_blocks, "tree int, low long, high long, n int, ids binary, vectors binary")
                    .withColumn("block", F.monotonically_increasing_id()), "forest")
    entries = blocks.agg(F.sum("n")).first()[0] / TREES
    deepest = min(BITS, math.ceil(math.log2(max(2, entries / BLOCK))) + 3)  # beyond it a range is one or two blocks

    def prefix(key: str) -> Column:
        return F.expr(f"shiftright({key}, {BITS} - depth)")

    depths = F.explode(F.sequence(F.lit(0), F.lit(deepest))).alias("depth")
    directory = blocks.select("block", "tree", "low", "high", depths) \
        .select("block", "tree", "depth", F.explode(F.sequence(prefix("low"), prefix("high"))).alias("prefix"))
    queries = stored(clean.where("is_query").select(F.col("vec_id").alias("query_id"), "embedding"), "queries")
    strings = stored(queries.mapInArrow(_query_strings(mean), "query_id long, tree int, key long"), "strings")

    def met(asked: DataFrame) -> DataFrame:
        return asked.withColumn("prefix", prefix("key")).join(directory, ["tree", "depth", "prefix"]).select("query_id", "block")

    down = _compare(blocks, met(strings.withColumn("depth", F.lit(deepest))), queries, mean, dtype, k)
    seen = down.groupBy("query_id").agg(F.max("angle").alias("angle"), F.count("*").alias("n"))
    shared = 1 - F.col("angle") / math.pi  # probability that a hyperplane leaves both on one side
    needed = F.floor(F.lit(math.log(1 - MISS ** (1 / TREES))) / F.log(shared))
    depth = F.when((F.col("n") < k) | (shared <= 0), 0).when(shared >= 1, deepest) \
        .otherwise(F.least(F.lit(deepest), F.greatest(F.lit(0), needed))).cast("int")
    climbed = stored(seen.select("query_id", depth.alias("depth")), "depths")
    up = _compare(blocks, met(strings.join(climbed, "query_id")), queries, mean, dtype, k)
    return up.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _query_strings(mean: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = hash_strings(_matrix(batch.column("embedding"), len(mean)), mean)
            ids = batch.column("query_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, TREES)), pa.array(np.tile(np.arange(TREES, dtype=np.int32), len(ids))),
                 pa.array(keys.ravel())], ["query_id", "tree", "key"])
    return run
