"""Document fingerprints from improbable features.

A feature is a window of ``WINDOW`` bytes. Its entropy falls into one of ``LEVELS`` + 1 levels, and a first pass counts
how many windows of the whole corpus have each level: the fewer, the more improbable, the better its rank (windows of
little entropy, such as runs of one sign, come last: they tell nothing). Among ``AROUND`` neighbouring features the one
of the best rank, the leftmost of several, gets a vote; features with ``POPULAR`` votes are selected. Which features
these are depends on the bytes around them alone, so equal passages select equal features wherever they stand.

Selected features go in text order into Bloom filters of ``BITS`` bits, ``FEATURES`` in each; a full filter is followed
by the next in the chain. Two fingerprints are compared filter by filter: each filter of the shorter one meets its best
partner, and the overlap of their bits is normalised: what chance explains is 0, the smaller bit count is 1, and an
overlap within two standard deviations of chance counts as 0.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm import words as W
from vitrine.llm.arrow import add_columns
from vitrine.llm.store import stored

WINDOW = 32              # bytes of a feature
AROUND = 32              # features that compete
POPULAR = 8              # votes of a selected feature
LEVELS = 1000
LITTLE = LEVELS // 4     # entropy levels below tell nothing
BITS, INSERTS, FEATURES = 2048, 5, 160
CHUNK_BYTES = 1 << 20
PART_BYTES = 64 << 20
_UNIT = 1 << 20          # fixed point of entropies
_NEVER = np.int64(1 << 62)

_count = np.arange(WINDOW + 1, dtype=float)
_weighted = np.round(_count * np.log2(np.maximum(_count, 1)) * _UNIT).astype(np.int64)
_GAIN = np.diff(_weighted, prepend=0)   # what the c-th equal byte of a window adds
_MOST = int(_weighted[WINDOW])


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Entropy level of the window from each byte on."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    ahead, behind = np.ones(len(data), np.uint8), np.ones(len(data), np.uint8)
    for step in range(1, WINDOW):
        same = data[step:] == data[:-step]
        ahead[:-step] += same
        behind[step:] += same
    total = np.empty(n, np.int64)
    total[0] = _weighted[np.bincount(data[:WINDOW])].sum()
    # The next window loses its first byte, of which it held ``ahead`` equal ones, and gains one with ``behind`` equal.
    total[1:] = _GAIN[behind[WINDOW:]] - _GAIN[ahead[:n - 1]]
    return (_MOST - np.cumsum(total)) * LEVELS // _MOST


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([0, *map(len, texts)])
    return np.frombuffer(b"".join(texts), np.uint8), ends


def _windows(offsets: np.ndarray, total: int) -> np.ndarray:
    """Which bytes start a window inside their row."""
    inside = np.zeros(total + 1, np.int32)
    long = np.flatnonzero(np.diff(offsets) >= WINDOW)
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - WINDOW + 1, -1)
    return np.cumsum(inside)[:total] > 0


def level_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all texts have each entropy level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            for a, b in W.chunks(batch.column("text"), CHUNK_BYTES):
                data, offsets = W.text_bytes(batch.column("text").slice(a, b - a))
                levels = entropy_levels(data)
                counts += np.bincount(levels[_windows(offsets, len(data))[:len(levels)]], minlength=LEVELS + 1)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(counts[there])], ["level", "n"])

    out = np.zeros(LEVELS + 1, np.int64)
    for r in docs.select("text").mapInArrow(run, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect():
        out[r["level"]] = r["n"]
    return out


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each level, 0 the best: rare before frequent, more entropy before less, little entropy last."""
    level = np.arange(LEVELS + 1)
    out = np.empty(LEVELS + 1, np.int64)
    out[np.lexsort((-level, counts, level < LITTLE))] = level
    return out


def select(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Places of the selected features of rows that have at least ``WINDOW`` bytes each.

    Windows of competing features may hang over the ends of a row, so its first and last features get as many votes as
    others, and the best of all is always selected. No such window meets features of two rows: ``WINDOW`` - 1 bytes
    before the end of a row start none.
    """
    pad = AROUND - 1
    start = np.flatnonzero(_windows(offsets, len(data)))
    key = np.full(pad + len(data), _NEVER)
    key[pad + start] = (rank[entropy_levels(data)[start]] << np.int64(40)) | start
    least, width = key, 1
    while width < AROUND:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    return np.flatnonzero(np.bincount(least[least < _NEVER] & ((1 << 40) - 1)) >= POPULAR)


def fingerprints(texts: list[bytes], rank: np.ndarray) -> list[str]:
    """``features:filters`` of each text, the filters in base64."""
    long = np.flatnonzero(np.fromiter(map(len, texts), np.int64, len(texts)) >= WINDOW)
    data, offsets = joined([texts[i] for i in long])
    place = select(data, offsets, rank)
    row = long[np.searchsorted(offsets, place, side="right") - 1]
    code = data[place[:, None] + np.arange(WINDOW)].astype(np.uint64) + np.uint64(1)
    hashes = W.grams_of_rows(code, 61) if len(place) else np.zeros(0, np.uint64)
    short = [i for i, text in enumerate(texts) if 0 < len(text) < WINDOW]
    if short:  # a text shorter than a window is one feature
        own = [W.grams_of_rows((np.frombuffer(texts[i], np.uint8).astype(np.uint64) + np.uint64(1))[None], 61)[0] for i in short]
        row, hashes = np.append(row, short), np.append(hashes, np.array(own, np.uint64))
    # A repeated feature of a text counts once, at its first place.
    order = np.lexsort((np.arange(len(row)), hashes, row))
    fresh = np.ones(len(row), bool)
    fresh[order[1:]] = (row[order[1:]] != row[order[:-1]]) | (hashes[order[1:]] != hashes[order[:-1]])
    row, hashes = row[fresh], hashes[fresh]
    by_row = np.argsort(row, kind="stable")
    row, hashes = row[by_row], hashes[by_row]
    features = np.bincount(row, minlength=len(texts))
    filters = -(-features // FEATURES)
    base = np.cumsum(filters) - filters
    number = np.arange(len(row)) - np.repeat(np.cumsum(features) - features, features)
    bits = np.zeros((int(filters.sum()), BITS), bool)
    width = np.uint64(BITS.bit_length() - 1)
    for i in range(INSERTS):
        bits[base[row] + number // FEATURES, ((hashes >> (np.uint64(i) * width)) % np.uint64(BITS)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1)
    return [f"{features[i]}:{base64.b64encode(packed[base[i]:base[i] + filters[i]].tobytes()).decode()}"
            for i in range(len(texts))]


def _opened(fingerprint: str) -> tuple[int, np.ndarray]:
    features, _, filters = fingerprint.partition(":")
    return int(features), np.frombuffer(base64.b64decode(filters), np.uint8).reshape(-1, BITS // 8)


def _overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common bits of each filter of ``a`` with each filter of ``b``."""
    if len(a) * len(b) <= 64:
        return np.bitwise_count(a[:, None, :] & b[None, :, :]).sum(axis=2, dtype=np.int64)
    return (np.unpackbits(a, axis=1).astype(np.float32) @ np.unpackbits(b, axis=1).astype(np.float32).T).astype(np.int64)


def likeness(one: str, other: str) -> float:
    """Likeness of two fingerprints from 0 to 1; equal ones have 1."""
    if one == other:
        return 1.0
    (n, a), (m, b) = sorted((_opened(one), _opened(other)), key=lambda x: (x[0], x[1].tobytes()))
    if not n:
        return 0.0
    weight = np.minimum(FEATURES, n - FEATURES * np.arange(len(a)))
    in_a, in_b = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a, b))
    scores, block = np.zeros(len(a)), 512
    for i in range(0, len(a), block):
        for j in range(0, len(b), block):
            x, y = in_a[i:i + block, None].astype(float), in_b[None, j:j + block].astype(float)
            most, chance = np.minimum(x, y), x * y / BITS
            common = _overlap(a[i:i + block], b[j:j + block])
            share = np.where(chance < most, (common - chance) / np.maximum(most - chance, 1e-9), common == most)
            score = np.where((common > chance + 2 * np.sqrt(chance)) | (common == most), share, 0)
            scores[i:i + block] = np.maximum(scores[i:i + block], score.max(axis=1))
    return float(np.clip((scores * weight).sum() / weight.sum(), 0, 1))


def fingerprint_texts(docs: DataFrame, rank: np.ndarray | None = None) -> DataFrame:
    """``docs`` (text, ...) with ``fingerprint`` of each whole text.

    ``rank`` is the rank of each entropy level; without it, the levels of all texts of ``docs`` are counted. Only
    fingerprints made with the same ranks are comparable. Null and empty texts have the fingerprint ``0:``, texts shorter
    than a window one feature. Equal texts have equal fingerprints. Other columns pass through; one named
    ``fingerprint`` is replaced. An empty table gives no row.
    """
    rank = ranks(level_counts(docs)) if rank is None else rank

    def compute(part: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = [(t or "").encode() for t in part.column("text").to_pylist()]
        return {"fingerprint": pa.array(fingerprints(texts, rank), pa.string())}

    return add_columns(docs, "fingerprint string", compute, size=CHUNK_BYTES)


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [field.split()[0] for field in RESULT.split(", ")]


def edited(text: bytes, following: bytes) -> bytes:
    """The text with its last half of code points replaced by the first as many of the following one."""
    own = text.decode()
    half = len(own) // 2
    return (own[:len(own) - half] + following[:4 * half].decode(errors="ignore")[:half]).encode()


def _compared(ids: list, texts: list[bytes], prints: list[str], nexts: list[bytes], next_prints: list[str],
              rank: np.ndarray) -> list[list]:
    changed = [edited(a, b) for a, b in zip(texts, nexts, strict=True)]
    theirs = fingerprints(changed, rank)
    return [ids, [len(t.decode()) for t in texts], [hashlib.sha256(t).hexdigest() for t in changed], prints, theirs,
            [likeness(a, b) for a, b in zip(prints, theirs, strict=True)],
            [likeness(a, b) for a, b in zip(prints, next_prints, strict=True)]]


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    small = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for a, b in W.chunks(batch.column("text"), CHUNK_BYTES):
            texts = [(t or "").encode() for t in batch.column("text").slice(a, b - a).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a), pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()),
                 pa.array([small.compress(t) for t in texts], pa.binary())], ["doc_id", "tie", "body"])


_STORED = f"{RESULT}, part int, edge string, body binary"


def _in_order(rank: np.ndarray):
    """A sorted partition's rows, each compared with the row after it; its first and last rows also keep their text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        part, small = TaskContext.get().partitionId(), zstandard.ZstdDecompressor()

        def emit(columns: list[list], edge: str | None = None, body: bytes | None = None) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            n = len(columns[0])
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, t) for c, t in zip(columns, types, strict=True)), pa.array([part] * n, pa.int32()),
                 pa.array([edge] * n, pa.string()), pa.array([body] * n, pa.binary())], [*_NAMES, "part", "edge", "body"])

        last = None
        for batch in batches:
            for a, b in W.chunks(batch.column("body"), CHUNK_BYTES // 2):
                ids = batch.column("doc_id").slice(a, b - a).to_pylist()
                bodies = batch.column("body").slice(a, b - a).to_pylist()
                texts = [small.decompress(x) if x else b"" for x in bodies]
                prints = fingerprints(texts, rank)
                if last is None:
                    yield emit([[ids[0]], [None], [None], [prints[0]], [None], [None], [None]], "first", bodies[0])
                else:
                    ids, texts, prints = [last[0], *ids], [last[1], *texts], [last[2], *prints]
                last = ids[-1], texts[-1], prints[-1], bodies[-1]
                if len(ids) > 1:
                    yield emit(_compared(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:], rank))
        if last is not None:
            yield emit([[last[0]], [None], [None], [last[2]], [None], [None], [None]], "last", last[3])

    return run


def _across(rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        small = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                texts = [small.decompress(row[c]) for c in ("body", "next_body")]
                columns = _compared([row["doc_id"]], texts[:1], [row["fingerprint"]], texts[1:], [row["next_print"]], rank)
                types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _NAMES)

    return run


def compare_with_edits(docs: DataFrame, rank: np.ndarray | None = None) -> DataFrame:
    """Fingerprint of each whole text and of its edited text, and how alike they and the next text's fingerprint are.

    The next row is that of the next larger doc_id, null first; after the last row comes the first. Rows that share a
    doc_id follow each other in the order of their texts' MD5. The edited text has the last half of its code points
    (rounded down) replaced by the first as many, or all, of the next row's text. Null texts count as empty: two empty
    texts are alike (1), an empty one and another are not (0). An empty table gives no row, a table of one row compares
    it with itself. Columns besides doc_id and text are ignored.

    Only texts, compressed, travel, once: rows are sorted over partitions, each partition is read as a stream that holds
    two neighbouring rows, and only the rows at its ends are joined with those of the next partition. Filters of two very
    long texts are compared in blocks; that work grows with the product of their lengths.
    """
    spark = docs.sparkSession
    counts = level_counts(docs) if rank is None else None
    rank = ranks(counts) if rank is None else rank
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if counts is not None:
        parts = max(parts, math.ceil(int(counts.sum()) / PART_BYTES))
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_squeeze, "doc_id long, tie binary, body binary")
    ordered = packed.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    rows = stored(ordered.mapInArrow(_in_order(rank), _STORED), "fingerprints")
    firsts = rows.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("fingerprint").alias("next_print"),
                                                 F.col("body").alias("next_body"))
    used = sorted(r["next_part"] for r in firsts.select("next_part").collect())  # as many as there are partitions
    follow = spark.createDataFrame(list(zip(used, used[1:] + used[:1], strict=True)), "part int, next_part int")
    lasts = rows.where("edge = 'last'").select("doc_id", "fingerprint", "body", "part").join(follow, "part").join(firsts, "next_part")
    across = lasts.select("doc_id", "fingerprint", "body", "next_print", "next_body").mapInArrow(_across(rank), RESULT)
    return rows.where("edge IS NULL").select(*_NAMES).unionByName(across)
