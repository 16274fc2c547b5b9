"""Hard negatives by a secondary sort.

Anchors are a stated set of rows; every row is scored against every anchor in blocks, by integer matrix products inside
tasks. A block keeps, for each of its anchors, only what can be in the result: its best rows of the anchor's label in a
first pass, and, once the positives are known, its best rows of other labels in each positive's window of scores. Every
kept pair is packed into one key (anchor, descending score, id). The keys are shuffled by anchor and sorted within
partitions; an iterator then streams over them: a row of the anchor's label opens a window, a row of another label goes
to all open windows it falls into, and an anchor holds no more than its windows and a few rows of one score at a time.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.llm.store import stored

BLOCK_BYTES = 16 << 20   # vectors of a block; half as many anchors meet it in one group
SCORES_AT_ONCE = 2 << 20
POSITIVES = NEGATIVES = 5
LOW, WHOLE = 80, 100     # a window: LOW * positive <= WHOLE * negative <= WHOLE * positive
SCALE = 256
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_SIGN = np.uint64(1 << 63)


def pack(anchor: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> pa.Array:
    """Keys whose byte order is (anchor, descending score, id)."""
    words = [np.asarray(x, np.int64).view(np.uint64) ^ _SIGN for x in (anchor, score, vec_id)]
    words[1] = ~words[1]
    data = np.stack(words, axis=1).astype(">u8").tobytes() if len(anchor) else b""
    return pa.Array.from_buffers(pa.binary(24), len(anchor), [None, pa.py_buffer(data)]).cast(pa.binary())


def unpack(key: bytes) -> tuple[int, int, int]:
    anchor, score, vec_id = (int.from_bytes(key[i:i + 8], "big") for i in (0, 8, 16))
    half = 1 << 63
    return anchor - half, half - 1 - score, vec_id - half


def open_windows(pairs: Iterable[tuple[bytes, bool]], negatives: int = NEGATIVES, low: int = LOW) -> Iterator[tuple]:
    """Result rows from (key, is positive), sorted by key."""
    anchor, score, windows, tied = None, None, [], []
    for key, is_positive in pairs:
        own, value, vec_id = unpack(key)
        if own != anchor:
            anchor, score, windows, tied = own, None, [], []
        if value != score:
            score, tied = value, []
            windows = [w for w in windows if w[2] < negatives and low * w[1] <= WHOLE * score]
        if is_positive:
            # A negative of the same score but a smaller id came before the positive and belongs to its window.
            window = [vec_id, score, 0]
            if low * score <= WHOLE * score:
                windows.append(window)
                for negative in tied:
                    window[2] += 1
                    yield anchor, vec_id, window[2], negative, score, score
            continue
        if len(tied) < negatives:
            tied.append(vec_id)
        for window in windows:
            if window[2] < negatives:
                window[2] += 1
                yield anchor, window[0], window[2], vec_id, window[1], score


def _matrix(column: pa.ChunkedArray, dimension: int, dtype) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype).reshape(len(column), dimension)


def _first(score: np.ndarray, vec_id: np.ndarray, chosen: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` first of the rows ``chosen`` by descending score, then id."""
    if len(chosen) > 4 * k:
        own = score[chosen]
        chosen = chosen[own >= np.partition(own, len(own) - k)[len(own) - k]]
    return chosen[np.lexsort((vec_id[chosen], -score[chosen]))][:k]


def _scores(rows: pa.Table, anchors: pa.Table, exact_float: bool) -> Iterator[tuple]:
    """For each anchor of a group: its number in the table, and the scores of all rows of the block."""
    dimension = rows["dim"][0].as_py()
    dtype = np.float64 if exact_float else np.int64
    block = _matrix(rows["v"], dimension, dtype).T
    asked = _matrix(anchors["v"], dimension, dtype)
    step = max(1, SCORES_AT_ONCE // block.shape[1])
    for a in range(0, len(asked), step):
        for i, scores in enumerate(asked[a:a + step] @ block):
            yield a + i, scores.astype(np.int64)


def _positives(exact_float: bool, k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and anchors.num_rows:
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            own_ids, own_labels = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
            for i, scores in _scores(rows, anchors, exact_float):
                best = _first(scores, ids, np.flatnonzero((labels == own_labels[i]) & (ids != own_ids[i])), k)
                found.append((np.full(len(best), own_ids[i]), scores[best], ids[best]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "score", "vec_id"])

    return run


def _negatives(exact_float: bool, k: int, low: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and anchors.num_rows:
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            own_ids, own_labels = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
            highs = anchors["positives"].to_pylist()
            for i, scores in _scores(rows, anchors, exact_float):
                windows = [(-(-low * p // WHOLE), p) for p in set(highs[i]) if low * p <= WHOLE * p]
                if not windows:
                    continue
                least, most = min(w[0] for w in windows), max(w[1] for w in windows)
                inside = np.flatnonzero((scores >= least) & (scores <= most) & (labels != own_labels[i]))
                own = scores[inside]
                best = [_first(scores, ids, inside[(own >= a) & (own <= b)], k) for a, b in windows]
                best = np.unique(np.concatenate(best))
                found.append((np.full(len(best), own_ids[i]), scores[best], ids[best]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table([pack(*columns), pa.array(np.zeros(len(columns[0]), bool))], ["key", "is_positive"])

    return run


def _usable(column: str) -> Column:
    return F.col(column).isNotNull() & F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW) -> DataFrame:
    """For each anchor and each of its positives the hardest negatives, by the inner product of integer vectors.

    ``vectors`` has vec_id, embedding (array of float or double) and label (integer); other columns are ignored. Each
    component x becomes floor(256 x). A row's score is its inner product with the anchor; higher scores come first, ties
    by smaller vec_id. Positives are the first ``positives`` other rows of the anchor's label. Negatives are the first
    ``negatives`` rows of other labels that score from ``low`` percent of the positive's score up to that score.
    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    Rows whose vec_id, label or vector is null, or whose vector holds a null or non-finite component, take no part. Of
    rows that share a vec_id the one with the smallest (label, vector) stands for all. Vectors of different lengths have
    no score. Anchors without positives, and positives without negatives (negative scores among them), give no row; an
    empty table gives none. Scores that could leave 64 bits raise ValueError.
    """
    spark = vectors.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.struct(F.col("label").cast("long").alias("label"), whole.alias("v")).alias("row"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    rows = stored(rows.groupBy("vec_id").agg(F.min("row").alias("row"), F.max("is_anchor").alias("is_anchor"))
                  .select("vec_id", "is_anchor", "row.label", "row.v", F.size("row.v").alias("dim")), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("anchors"), F.max("dim").alias("dim"),
                    F.max(F.greatest(F.array_max("v"), -F.array_min("v"))).alias("bound")).first()
    if not size["n"] or not size["anchors"]:
        return spark.createDataFrame([], RESULT)
    dimension, bound = max(1, size["dim"]), max(1, size["bound"] or 0)
    if dimension * bound ** 2 * WHOLE >= 1 << 63:
        raise ValueError(f"scores of {dimension} components up to {bound} leave 64 bits")
    exact_float = dimension * bound ** 2 < 1 << 53  # then products of doubles are exact integers
    most = max(1, BLOCK_BYTES // (8 * dimension))
    blocks = max(math.ceil(size["n"] / most), min(partitions, math.ceil(size["n"] / 1024)))
    groups = math.ceil(size["anchors"] / max(1, most // 2))

    def spread(count: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(count)).cast("int")

    def everyone(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    on = ["dim", "block", "group"]
    scored = rows.select("vec_id", "label", "v", "dim", spread(blocks, 1).alias("block"), everyone(groups).alias("group"))
    anchors = stored(rows.where("is_anchor").select("vec_id", "label", "v", "dim", spread(groups, 2).alias("group")), "anchors")

    def meet(asked: DataFrame, run, schema: str) -> DataFrame:
        return scored.groupBy(*on).cogroup(asked.withColumn("block", everyone(blocks)).groupBy(*on)).applyInArrow(run, schema)

    best = meet(anchors, _positives(exact_float, positives),
                "anchor_id long, score long, vec_id long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    chosen = stored(best.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= positives).drop("_place"),
                    "positives")
    highs = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list("score").alias("positives"))
    hard = meet(stored(anchors.join(highs, "vec_id"), "asked"),
                _negatives(exact_float, negatives, low), "key binary, is_positive boolean")
    opening = chosen.mapInArrow(_as_keys, "key binary, is_positive boolean")
    pairs = opening.unionByName(hard).rdd.map(lambda r: (bytes(r[0]), r[1]))
    by_anchor = pairs.repartitionAndSortWithinPartitions(partitions, lambda key: zlib.crc32(key[:8]))
    return spark.createDataFrame(by_anchor.mapPartitions(lambda part: open_windows(part, negatives, low)), RESULT,
                                 verifySchema=False)


def _as_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor_id", "score", "vec_id")]
        yield pa.RecordBatch.from_arrays([pack(*columns), pa.array(np.ones(len(batch), bool))], ["key", "is_positive"])
