"""Exact substring deduplication by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of a document. Its minimiser is the smallest hash among its word pairs.
Consecutive windows with the same minimiser travel as one packed string to the minimiser's bucket, so a text is
sent less than three times in all, not once for each window. In its bucket the windows are unpacked and sorted;
equal windows stand together, and each one that does not belong to the smallest document of its run is repeated.

Before anything travels, each chunk of documents is treated like a bucket: windows that stand in a smaller document
of the same chunk are marked at once and stay behind. A passage that a third of all rows share therefore reaches its
bucket once for each chunk, not once for each row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm import words as W
from vitrine.llm.arrow import add_columns, emit_rows

WINDOW = 13
GRAM = 2                     # words of a minimiser
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 24 << 20      # text that a bucket holds on average, unpacked
NO_ID = (1 << 63) - 1        # stands for a null doc_id: larger than all others
COLUMNS = ("doc_id", "text_key", "first", "last")


def in_smaller_document(lane: np.ndarray, other_lane: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each window: does an equal one (in both 64-bit lanes) belong to a smaller document?"""
    out = np.zeros(len(lane), bool)
    order = np.argsort(lane)
    same = lane[order[1:]] == lane[order[:-1]]
    twice = np.zeros(len(lane), bool)
    twice[1:] |= same
    twice[:-1] |= same
    some = order[twice]
    some = some[np.lexsort((doc[some], other_lane[some], lane[some]))]
    if len(some):
        head = np.ones(len(some), bool)
        head[1:] = (lane[some[1:]] != lane[some[:-1]]) | (other_lane[some[1:]] != other_lane[some[:-1]])
        smallest = doc[some[head]][np.cumsum(head) - 1]
        out[some] = doc[some] > smallest
    return out


def minimisers(hashes: np.ndarray) -> np.ndarray:
    """Smallest word-pair hash of the window at each position."""
    least, width = W.grams(hashes, GRAM, seed=31), 1
    wanted = WINDOW - GRAM + 1
    while 2 * width <= wanted:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    rest = wanted - width
    return np.minimum(least[:len(least) - rest], least[rest:])


def as_ranges(doc: np.ndarray, key: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Runs of consecutive windows of one row, as columns doc, key, first, last."""
    order = np.lexsort((place, key, doc))
    doc, key, place = doc[order], key[order], place[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (place[1:] > place[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(doc)) - 1 if len(doc) else begin
    return [doc[begin], key[begin], place[begin], place[end]]


PACKED = pa.schema([("bucket", pa.int32()), ("marks", pa.binary()), ("head", pa.binary()), ("body", pa.binary())])


def _pack(buckets: int):
    """Chunk of documents to one row for each bucket: local marks, and the super-k-mers that travel there."""
    import zstandard

    def compute(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=3)
        words = W.split(part.column("text"), W.SPACED)
        position = np.flatnonzero(W.runs_inside(words, WINDOW))
        if not len(position):
            return
        row = words.row[position]
        place = position - words.first[row]
        doc = part.column("doc_id").to_numpy(zero_copy_only=False)[row]
        key = part.column("text_key").to_numpy(zero_copy_only=False)[row]
        lanes = [W.grams(words.hash, WINDOW, seed)[position] for seed in (41, 43)]
        copy = in_smaller_document(*lanes, doc)
        marks = as_ranges(doc[copy], key[copy], place[copy])

        position, doc, key, place = position[~copy], doc[~copy], key[~copy], place[~copy]
        least = minimisers(words.hash)[position]
        new = np.ones(len(position), bool)
        new[1:] = (position[1:] != position[:-1] + 1) | (least[1:] != least[:-1])
        begin = np.flatnonzero(new)
        windows = np.diff(np.append(begin, len(position)))
        bucket = (least[begin] % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        begin, windows, bucket = begin[order], windows[order], bucket[order]
        left, right = words.start[position[begin]].tolist(), words.end[position[begin] + windows + WINDOW - 2].tolist()
        text = words.data.tobytes()
        cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, int)
        rows = []
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(bucket)], strict=False):
            own = begin[a:b]
            head = np.concatenate([doc[own], key[own], place[own], windows[a:b]]).astype(np.int64).tobytes()
            body = b" ".join([text[x:y] for x, y in zip(left[a:b], right[a:b], strict=True)])
            rows.append((int(bucket[a]), None, small.compress(head), small.compress(body)))
        if len(marks[0]):
            rows.append((int(marks[0][0] % buckets), np.concatenate(marks).astype(np.int64).tobytes(), None, None))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PACKED, strict=True)],
                                         schema=PACKED) if rows else pa.RecordBatch.from_pylist([], PACKED)

    return compute


def _sort_bucket(table: pa.Table) -> pa.Table:
    """All super-k-mers of a bucket: unpack, sort the windows, mark those that stand in a smaller document."""
    import zstandard

    small = zstandard.ZstdDecompressor()
    found: list[list[np.ndarray]] = [[np.frombuffer(x, np.int64).reshape(4, -1)[i] for i in range(4)]
                                     for x in table["marks"].to_pylist() if x is not None]
    pieces = []
    for head, body in zip(table["head"], table["body"], strict=True):
        if not head.is_valid:
            continue
        doc, key, place, windows = np.frombuffer(small.decompress(head.as_py()), np.int64).reshape(4, -1)
        text = np.frombuffer(small.decompress(body.as_py()), np.uint8)
        hashes = W.split_bytes(text, np.array([0, len(text)]), W.SPACED).hash
        size = windows + WINDOW - 1
        run = np.repeat(np.arange(len(windows)), windows)
        inside = np.arange(len(run)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = (np.cumsum(size) - size)[run] + inside
        pieces.append([W.grams(hashes, WINDOW, 41)[at], W.grams(hashes, WINDOW, 43)[at],
                       doc[run], key[run], place[run] + inside])
    if pieces:
        lane, other, doc, key, place = (np.concatenate(x) for x in zip(*pieces, strict=True))
        copy = in_smaller_document(lane, other, doc)
        found.append(as_ranges(doc[copy], key[copy], place[copy]))
    columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
    return pa.table(dict(zip(COLUMNS, columns, strict=True)))


def _remove(part: pa.RecordBatch) -> dict[str, pa.Array]:
    words = W.split(part.column("text"), W.SPACED, hashed=False)
    text, kept, removed, spans = words.data.tobytes(), [], [], []
    for row, marks in enumerate(part.column("_marks").to_pylist()):
        a, b = int(words.first[row]), int(words.first[row + 1])
        keep = np.ones(b - a, bool)
        for mark in marks or ():
            keep[mark["first"]:mark["last"] + WINDOW] = False
        change = np.flatnonzero(np.diff(np.concatenate([[True], keep, [True]]).astype(np.int8)))
        spans.append([{"first": x, "last": y - 1} for x, y in zip(change[::2].tolist(), change[1::2].tolist(), strict=True)])
        left, right = words.start[a:b][keep].tolist(), words.end[a:b][keep].tolist()
        kept.append(b" ".join([text[x:y] for x, y in zip(left, right, strict=True)]).decode())
        removed.append(b - a - len(left))
    return {"n_words": pa.array(words.counts(), pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "kept_text": pa.array(kept, pa.string()),
            "removed": pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))}


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) without the words of windows that also start in a document with a smaller doc_id.

    Adds ``n_words``, ``n_removed``, ``kept_text`` (kept words joined by one space) and ``removed`` (word spans).
    Words are runs without ASCII white space. All windows are judged on the input. Null and empty texts and texts of
    fewer than 13 words lose nothing. A null doc_id counts as larger than all others; rows that share a doc_id take
    nothing from each other. Columns with the added names are replaced.
    """
    spark = docs.sparkSession
    ids = F.coalesce(docs["doc_id"], F.lit(NO_ID)).cast("long")
    # Rows that share a doc_id are told apart by their text; where none do, nothing more needs to travel.
    shared = not docs.groupBy(ids.alias("id")).count().where("count > 1").isEmpty()
    key = F.coalesce(F.xxhash64("text"), F.lit(0)) if shared else F.lit(0).cast("long")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(3 * total / BUCKET_BYTES))

    sent = emit_rows(docs.select(ids.alias("doc_id"), key.alias("text_key"), "text"),
                     "bucket int, marks binary, head binary, body binary", _pack(buckets), size=CHUNK_BYTES)
    marks = (sent.groupBy("bucket").applyInArrow(_sort_bucket, "doc_id long, text_key long, first long, last long")
             .groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
             .agg(F.collect_set(F.struct("first", "last")).alias("_marks")))
    keyed = docs.withColumns({"_id": ids, "_key": key})
    marked = keyed.join(marks.hint("shuffle_hash"), ["_id", "_key"], "left").drop("_id", "_key")
    return add_columns(marked, "n_words long, n_removed long, kept_text string, "
                               "removed array<struct<first: long, last: long>>", _remove).drop("_marks")
