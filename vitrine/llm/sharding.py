"""Shards by vector bin packing: bytes, tokens and rows are balanced together.

Rows with equal texts form a group, and a group goes to one shard. Loads are vectors (bytes, tokens, rows). Heavy groups
are placed one by one; all others are hashed into a fixed number of cells, which are placed like groups. Heaviest first,
each goes where the dot product of its load with the shard's residual capacity is highest. What the driver places is
bounded by the number of cells and by how many groups can be heavy, whatever the number of rows.
Only a group of more bytes than a shard may hold is dealt out, by its doc_ids, as no shard could take it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.store import numbered, stored, stored_in_order

SHARDS = 16
CELLS = 4096          # cells for light groups
HEAVY_SHARE = 64      # a heavy group has more than 1/64 of a shard's bytes, tokens or rows
WEIGHTS = (1.0, 0.25, 0.25)   # bytes, tokens, rows in the dot product


def pack(loads: np.ndarray, shards: int, weights: tuple[float, ...] = WEIGHTS) -> np.ndarray:
    """Shard of each load vector; capacities are equal shares of the sums."""
    share = loads / np.maximum(loads.sum(axis=0), 1) * shards * np.asarray(weights)
    residual = np.tile(np.asarray(weights, float), (shards, 1))
    out = np.zeros(len(loads), np.int32)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        out[i] = int(np.argmax(residual @ share[i]))
        residual[out[i]] -= share[i]
    return out


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of each row of ``docs`` (doc_id, text, ...).

    Size is the UTF-8 bytes of the text plus 1. A null text has no bytes and groups with the empty text. Rows may repeat;
    slots number a shard's rows from 0 in order of doc_id, null first. An empty table gives no row.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("group"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens")), "rows")
    loads = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = rows.agg(*loads).first()
    if not total["rows"]:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    heavy = F.lit(False)
    for name in ("bytes", "tokens", "rows"):
        heavy = heavy | (F.col(name) * shards * HEAVY_SHARE > (total[name] or 0))
    # At most 3 * shards * HEAVY_SHARE groups can be heavy, so both tables below are small by arithmetic.
    pieces = F.least("rows", F.ceil(F.col("bytes") * shards / F.lit(total["bytes"])))
    large = rows.groupBy("group").agg(*loads).where(heavy).select("group", pieces.alias("pieces"))
    piece = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("pieces"))
    cell = F.when(F.col("pieces").isNotNull(), F.concat(F.hex("group"), F.lit("-"), piece.cast("string"))) \
        .otherwise(F.pmod(F.xxhash64("group"), F.lit(CELLS)).cast("string"))
    celled = stored(rows.join(F.broadcast(large), "group", "left").select(
        "doc_id", "size", "text_crc32", "tokens", cell.alias("cell")), "cells")
    sums = celled.groupBy("cell").agg(*loads).orderBy("cell").toPandas()
    sums["shard"] = pack(sums[["bytes", "tokens", "rows"]].to_numpy(float), shards)
    placed = spark.createDataFrame(list(zip(sums["cell"], sums["shard"].tolist(), strict=True)), "cell string, shard int")
    ordered = stored_in_order(celled.join(F.broadcast(placed), "cell").select("doc_id", "size", "text_crc32", "shard"),
                              "shards", "shard", "doc_id")
    return numbered(ordered, "slot", "shard").select("doc_id", "size", "text_crc32", "shard", "slot")
