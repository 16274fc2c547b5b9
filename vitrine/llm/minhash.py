"""Near-duplicate documents with HyperMinHash sketches.

A document's set holds the 64-bit hashes of its distinct five-word shingles. The top bits of a hash choose one of 128
registers; a register keeps the smallest remainder of its bucket, compressed to the count of its leading zeros and the
ten mantissa bits behind them. Bands of four registers propose pairs; the Jaccard estimate of the registers, corrected
for chance collisions of compressed values, drops the clear misses; what is left is compared on full sets.

Pairs inside a hot bucket are never listed. Equal sets collapse first. Each bucket then links its members to its
most central member. Only where a bucket still spans several components are its members compared across those
components, in pairs of blocks of bounded size that give only the links found, so that no link between different texts is
lost to the shortcut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm import words as W
from vitrine.llm.arrow import emit_rows
from vitrine.llm.store import stored
from vitrine.operators.components import connected_components

SHINGLE = 5
PERCENT = 85                 # link where 100 * intersection >= PERCENT * union
REGISTER_BITS, MANTISSA_BITS = 7, 10
REGISTERS, BAND = 1 << REGISTER_BITS, 4
EMPTY = np.uint16(0xFFFF)
DEVIATIONS = 5               # an estimate so many standard deviations below the threshold is a clear miss
BLOCK = 1024                 # members of a bucket that are compared with as many others at a time


def shingle_sets(words: W.Words) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row; a row of fewer words is one shingle as a whole."""
    grams = W.grams(words.hash, SHINGLE)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            yield np.unique(grams[a:b - SHINGLE + 1])
        elif b > a:
            yield W.grams(words.hash[a:b], b - a, seed=37)
        else:
            yield np.zeros(0, np.uint64)


_edges = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(64 - REGISTER_BITS)


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set of hashes."""
    out = np.full(REGISTERS, EMPTY)
    if not len(hashes):
        return out
    at = np.searchsorted(hashes, _edges)
    least = hashes[np.minimum(at, len(hashes) - 1)]
    filled = (at < len(hashes)) & ((least >> np.uint64(64 - REGISTER_BITS)) == np.arange(REGISTERS, dtype=np.uint64))
    rest = ((least[filled] << np.uint64(REGISTER_BITS)) >> np.uint64(11))  # 53 bits, exact as a double
    zeros = (53 - np.frexp(rest.astype(np.float64))[1]).astype(np.uint64)
    mantissa = ((rest << zeros) >> np.uint64(52 - MANTISSA_BITS)) & np.uint64((1 << MANTISSA_BITS) - 1)
    out[filled] = ((zeros << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16)
    return out


_donors = np.argsort(W.constants(REGISTERS * REGISTERS, 53).reshape(REGISTERS, REGISTERS), axis=1)


def band_keys(matrix: np.ndarray) -> np.ndarray:
    """Band hashes, documents x bands; an empty register borrows from a fixed sequence of others."""
    filled = matrix != EMPTY
    full = matrix.copy()
    for i in np.flatnonzero(~filled.all(axis=1)):
        gaps = np.flatnonzero(~filled[i])
        choice = _donors[gaps]
        full[i, gaps] = matrix[i][choice[np.arange(len(gaps)), filled[i][choice].argmax(axis=1)]]
    packed = np.ascontiguousarray(full).view(np.uint64)
    return W.mix(packed * W.constants(packed.shape[1], 59)[None, :] + np.arange(packed.shape[1], dtype=np.uint64)[None, :])


def zero_counts(size: np.ndarray) -> np.ndarray:
    """Distribution of a register's leading zeros for sets of ``size`` elements, sets x counts."""
    zeros = np.arange(54)[None, :]
    each = np.maximum(size, 1)[:, None] / REGISTERS
    return (1 - 2.0 ** -(zeros + 1)) ** each - (1 - 2.0 ** -zeros) ** each


def may_link(x: np.ndarray, y: np.ndarray, size_x: np.ndarray, size_y: np.ndarray,
             zeros_x: np.ndarray, zeros_y: np.ndarray) -> np.ndarray:
    """False for pairs that sizes or the Jaccard estimate, corrected for chance collisions, rule out."""
    either = (x != EMPTY) | (y != EMPTY)
    used = np.maximum(either.sum(axis=-1), 1)
    agree = ((x == y) & either).sum(axis=-1) / used
    chance = (zeros_x * zeros_y).sum(axis=-1) / (1 << MANTISSA_BITS)
    estimate, goal = (agree - chance) / (1 - chance), PERCENT / 100
    near = estimate >= goal - DEVIATIONS * np.sqrt(goal * (1 - goal) / used)
    return near & (100 * np.minimum(size_x, size_y) >= PERCENT * np.maximum(size_x, size_y))


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest_1", pa.int64()), ("digest_2", pa.int64()),
                    ("registers", pa.binary())])


def _sketch(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    words = W.split(part.column("text"), W.SPACED, W.LOWER)
    size, one, two, regs = [], [], [], []
    for own in shingle_sets(words):
        size.append(len(own))
        one.append(int(own.sum(dtype=np.uint64).astype(np.int64)))
        two.append(int(W.mix(own + np.uint64(61)).sum(dtype=np.uint64).astype(np.int64)))
        regs.append(registers(own).tobytes() if len(own) else None)
    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(size, pa.int64()), pa.array(one, pa.int64()),
                                      pa.array(two, pa.int64()), pa.array(regs, pa.binary())], schema=SKETCH)


def _sets(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    words = W.split(part.column("text"), W.SPACED, W.LOWER)
    yield pa.RecordBatch.from_arrays([part.column("doc_id"),
                                      pa.array([own.tobytes() for own in shingle_sets(words)], pa.binary())],
                                     ["doc_id", "shingles"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            keys = band_keys(np.frombuffer(b"".join(part.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS))
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64).ravel()),
                                              pa.array(np.repeat(ids, keys.shape[1]))], ["band", "doc_id"])


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with both sketches, to the pairs worth a full comparison."""
    for batch in batches:
        sketch = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                  for c in ("regs_a", "regs_b")]
        size = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("size_a", "size_b")]
        near = pa.array(may_link(*sketch, *size, *(zero_counts(n) for n in size)))
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(near), batch.column("b").filter(near)], ["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with both sets, to the pairs that link."""
    for batch in batches:
        link = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            link.append(linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)))
        link = pa.array(link, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(link), batch.column("b").filter(link)], ["a", "b"])


def _link_blocks(key: tuple, table: pa.Table) -> pa.Table:
    """Links between different components of two blocks of a bucket.

    A pair belongs to the first band that its documents share, so it is compared in one bucket only. Components that a
    link has joined are not compared further.
    """
    band, first, second = (k.as_py() for k in key)
    ids, comps, blocks = (table[c].to_numpy() for c in ("doc_id", "comp", "block"))
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
    regs = np.stack([registers(x) for x in sets])
    keys, size = band_keys(regs).astype(np.int64), np.array([len(x) for x in sets])
    zeros = zero_counts(size)
    root = {c: c for c in comps.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    right, found = np.flatnonzero(blocks == second), []
    for i in np.flatnonzero(blocks == first).tolist():
        other = right[right > i] if first == second else right
        other = other[comps[other] != comps[i]]
        other = other[may_link(regs[i], regs[other], size[i], size[other], zeros[i], zeros[other])]
        shared = keys[i][None, :] == keys[other]
        other = other[keys[i][shared.argmax(axis=1)] == band] if len(other) else other
        for j in other.tolist():
            x, y = find(int(comps[i])), find(int(comps[j]))
            if x != y and linked(sets[i], sets[j]):
                root[y] = x
                found.append((int(ids[i]), int(ids[j])))
    return pa.table({"a": pa.array([max(f) for f in found], pa.int64()), "b": pa.array([min(f) for f in found], pa.int64())})


def _sets_of(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """Full shingle sets of the documents whose doc_id is in ``wanted``."""
    return stored(emit_rows(docs.join(wanted.distinct().hint("shuffle_hash"), "doc_id", "left_semi"),
                            "doc_id long, shingles binary", _sets), "sets")


def find_links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of all rows, representatives of equal sets with their component, links between representatives."""
    sketches = stored(emit_rows(docs, "doc_id long, n_shingles long, digest_1 long, digest_2 long, registers binary",
                                _sketch), "sketches")
    usable = sketches.where("n_shingles > 0 and doc_id is not null")
    # Equal sets: one representative, the smallest doc_id. (A doc_id of several rows stands once for each of its sets.)
    same = ["n_shingles", "digest_1", "digest_2"]
    reps = stored(usable.groupBy(*same).agg(F.min("doc_id").alias("doc_id"), F.any_value("registers").alias("registers")),
                  "representatives")
    bands = stored(reps.select("doc_id", "registers").mapInArrow(_bands, "band long, doc_id long"), "bands")
    crowds = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(bands.join(crowds, "band"), "shared")

    # A bucket's lead is its most central member: an unchanged original shares more, and fuller, buckets than its copies.
    central = shared.groupBy("doc_id").agg(F.sum("n").alias("crowd"))
    leads = shared.join(central, "doc_id").groupBy("band").agg(
        F.max(F.struct("crowd", (-F.col("doc_id")).alias("minus"))).alias("best")).select("band", (-F.col("best.minus")).alias("lead"))
    proposed = shared.join(leads, "band").where(F.col("doc_id") != F.col("lead")).select(
        F.greatest("doc_id", "lead").alias("a"), F.least("doc_id", "lead").alias("b")).distinct()

    def side(name: str) -> DataFrame:
        return reps.select(F.col("doc_id").alias(name), F.col("n_shingles").alias(f"size_{name}"),
                           F.col("registers").alias(f"regs_{name}"))

    near = stored(proposed.join(side("a"), "a").join(side("b"), "b").mapInArrow(_estimated, "a long, b long").distinct(), "pairs")
    sets = _sets_of(near.select(F.col("a").alias("doc_id")).unionByName(near.select(F.col("b").alias("doc_id"))), docs)
    links = stored(near.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
                   .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
                   .mapInArrow(_verified, "a long, b long").distinct(), "links")
    nodes = reps.select(F.col("doc_id").alias("id")).distinct()
    comps = stored(connected_components(nodes, links).withColumnRenamed("id", "doc_id"), "components")

    # Buckets that still span several components: compare across them, block against block.
    open_ = shared.join(comps, "doc_id")
    spans = open_.groupBy("band").agg(F.min("comp").alias("_x"), F.max("comp").alias("_y"), F.count("*").alias("_n")) \
        .where("_x < _y").select("band", F.ceil(F.col("_n") / BLOCK).alias("blocks"))
    members = stored(open_.join(spans, "band").select(
        "band", "doc_id", "comp", "blocks", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).alias("block")), "members")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    meeting = members.withColumn("other", other).select(
        "band", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "doc_id", "comp", "block")
    more = stored(meeting.join(_sets_of(members.select("doc_id"), docs), "doc_id").groupBy("band", "first", "second")
                  .applyInArrow(_link_blocks, "a long, b long"), "links")
    merged = comps if more.isEmpty() else connected_components(nodes, links.unionByName(more)).withColumnRenamed("id", "doc_id")
    return sketches, reps.join(merged, "doc_id"), links.unionByName(more)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    Words are ASCII-lower-cased runs without white space. Null and empty texts have no shingle and no link. Rows with
    equal texts link; rows that share a doc_id are one node of the graph. A null doc_id is not linked and is kept, with
    a null component.
    """
    sketches, reps, _ = find_links(docs.select("doc_id", "text"))
    same = ["n_shingles", "digest_1", "digest_2"]
    # Stored, so that adaptive execution can split the join where many rows have one set.
    of_set = stored(reps.groupBy(*same).agg(F.min("comp").alias("comp")), "sets-components")
    joined = sketches.drop("registers").join(of_set, same, "left")
    comp = F.coalesce("comp", "doc_id")
    return joined.select("doc_id", "n_shingles", comp.alias("component_id"),
                         F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, that of the smallest doc_id."""
    kept = near_duplicates(docs).where(F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.join(kept.hint("shuffle_hash"), "doc_id", "left_semi").unionByName(docs.where("doc_id is null")) \
        .select(*docs.columns)
