"""Token ids as flat binary files with 64-bit document offsets.

Layout below one folder of the shared storage:

* ``part-00000.ids``: unsigned little-endian ids, two bytes each where the vocabulary fits, else four;
* ``part-00000.off``: unsigned 64-bit offsets into the ids of the part, one more than it has documents;
* ``part-00000.doc``: signed 64-bit doc_ids (``NO_ID`` for null);
* ``index.json``: id width, and documents, ids and base of each part. A base is the sum of ids of all parts before.

Parts are ranges of doc_id, so reading them in order gives ascending doc_ids. A task writes under a name of its own
attempt and renames at the end: a task that runs again replaces its files by equal ones.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.llm import words as W
from vitrine.llm.arrow import hand_back
from vitrine.session import scratch_path

END_ID = 1
NO_ID = -(1 << 63)
CACHE_WORDS = 800_000   # distinct pieces that a worker remembers before it starts anew


class WordEncoder:
    """Ids of texts, encoding each distinct piece of a word once.

    A lower-casing tokenizer of words splits at white space, and between letters and signs, before anything else, and
    treats every piece alike wherever it stands; so the ids of a text are those of its pieces in a row. Any other
    tokenizer gets whole texts.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        parts = json.loads(tokenizer_json)
        self.by_pieces = "Lowercase" in json.dumps(parts.get("normalizer")) and bool(parts["model"].get("end_of_word_suffix"))
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.begin, self.size, self.ids, self.used = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), \
            np.zeros(1 << 14, np.uint32), 0

    def _learn(self, hashes: list[int], texts: list[str]) -> None:
        encoded = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        size = np.array([len(e) for e in encoded], np.int64)
        n, total = len(self.known), int(size.sum())
        while n + len(size) > len(self.size):
            self.begin, self.size = np.concatenate([self.begin] * 2), np.concatenate([self.size] * 2)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids] * 2)
        self.begin[n:n + len(size)] = self.used + np.cumsum(size) - size
        self.size[n:n + len(size)] = size
        self.ids[self.used:self.used + total] = np.fromiter((i for e in encoded for i in e), np.uint32, total)
        self.used += total
        self.known.update(zip(hashes, range(n, n + len(size)), strict=True))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by ``end_id``, and the number of ids of each text."""
        if not self.by_pieces:
            encoded = self.tokenizer.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)
            ids = [[*e.ids, end_id] for e in encoded]
            return np.array([i for own in ids for i in own], np.uint32), np.array([len(own) for own in ids], np.int64)
        words = pieces(texts)
        distinct, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > CACHE_WORDS:
            self._clear()
        keys = distinct.tolist()
        new = [i for i, k in enumerate(keys) if k not in self.known]
        if new:
            text = words.data.tobytes()
            left, right = words.start[first[new]].tolist(), words.end[first[new]].tolist()
            self._learn([keys[i] for i in new], [text[a:b].decode() for a, b in zip(left, right, strict=True)])
        entry = np.fromiter((self.known[k] for k in keys), np.int64, len(keys))[which] if len(keys) else np.zeros(0, np.int64)
        size, begin = self.size[entry], self.begin[entry]
        total = int(size.sum())
        row = np.repeat(words.row, size)
        source = np.arange(total) + np.repeat(begin - (np.cumsum(size) - size), size)
        counts = np.bincount(row, minlength=words.rows) + 1
        out = np.full(total + words.rows, end_id, np.uint32)
        out[np.arange(total) + row] = self.ids[source]
        return out, counts


_CODES = np.arange(256)
_LETTER = ((_CODES >= 0x41) & (_CODES <= 0x5A)) | ((_CODES >= 0x61) & (_CODES <= 0x7A))
_SIGN = (_CODES > 0x20) & (_CODES < 0x7F) & ~_LETTER & ~((_CODES >= 0x30) & (_CODES <= 0x39)) & (_CODES != 0x27)


def pieces(texts: pa.Array) -> W.Words:
    """Words of a lower-casing tokenizer, cut further between ASCII letters and signs.

    Words with an apostrophe or with the beginning of a special token are not cut; only words of ASCII bytes are
    lower-cased, as a letter before a combining mark must reach the tokenizer as it is.
    """
    data, offsets = W.text_bytes(texts)
    if not len(data):
        return W.split_bytes(data, offsets, W.SPACED)
    inside = W.SPACED[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    run = np.cumsum(begins, dtype=np.int32)
    special = run[:-1][(data[:-1] == ord("<")) & (data[1:] == ord("|"))]
    whole, as_is = np.zeros(int(run[-1]) + 1, bool), np.zeros(int(run[-1]) + 1, bool)
    whole[run[data == 0x27]] = whole[special] = as_is[special] = True
    as_is[run[data >= 0x80]] = True
    letter, sign = _LETTER[data], _SIGN[data]
    cuts = np.zeros(len(data) + 1, bool)
    cuts[1:-1] = ((letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])) & ~whole[run[1:]]
    return W.split_bytes(np.where(as_is[run], data, W.LOWER[data]), offsets, W.SPACED, cuts=cuts)


class Folder:
    """A folder of token files."""

    def __init__(self, uri: str):
        self.uri = uri
        self.fs, self.path = pafs.FileSystem.from_uri(uri)

    def name(self, part: int, kind: str) -> str:
        return f"{self.path}/part-{part:05d}.{kind}"

    def publish(self, temporary: str, final: str) -> None:
        if self.fs.type_name != "local" and self.fs.get_file_info(final).type != pafs.FileType.NotFound:
            self.fs.delete_file(final)
        self.fs.move(temporary, final)

    def read(self, part: int, kind: str, dtype: str) -> np.ndarray:
        """A file as an array: mapped into memory where it is local, else read."""
        name = self.name(part, kind)
        if not self.fs.get_file_info(name).size:
            return np.zeros(0, dtype)
        if self.fs.type_name == "local":
            return np.memmap(name, dtype, "r")
        with self.fs.open_input_file(name) as f:
            return np.frombuffer(f.read(), dtype)

    def index(self) -> dict:
        with self.fs.open_input_stream(f"{self.path}/index.json") as f:
            return json.loads(f.read())


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, uri: str | None = None) -> str:
    """Write ``docs`` (doc_id, text) in ascending doc_id order and return the folder.

    A null text is empty and gives the end id alone; a null doc_id comes first; rows with one doc_id are in order of
    text. An empty table gives an index without parts. Only one row for each part comes to the driver.
    """
    spark = docs.sparkSession
    uri = uri or scratch_path(spark, "tokens")
    folder = Folder(uri)
    folder.fs.create_dir(folder.path, recursive=True)
    with open(tokenizer_path, encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_str(content.value).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    ordered = docs.select("doc_id", "text").repartitionByRange(_parts(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(_writer(uri, content, width, end_id), "part int, documents long, ids long") \
        .toPandas().sort_values("part")
    index = {"width": width, "end_id": end_id, "parts": [
        {"part": int(p), "documents": int(d), "ids": int(n), "base": int(b)}
        for p, d, n, b in zip(rows["part"], rows["documents"], rows["ids"], rows["ids"].cumsum() - rows["ids"], strict=True)]}
    with folder.fs.open_output_stream(f"{folder.path}/index.json") as f:
        f.write(json.dumps(index).encode())
    return uri


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _writer(uri: str, content, width: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder, task = Folder(uri), TaskContext.get()
        part, own = task.partitionId(), f".{task.taskAttemptId()}.tmp"
        files, documents, total = None, 0, 0
        hand_back()
        for batch in batches:
            encoder = W.worker_cache(f"words_{zlib.crc32(content.value.encode())}", lambda: WordEncoder(content.value))
            if files is None:
                files = {k: folder.fs.open_output_stream(folder.name(part, k) + own) for k in ("ids", "off", "doc")}
                files["off"].write(np.zeros(1, "<u8").tobytes())
            for a, b in W.chunks(batch.column("text")):
                piece = batch.slice(a, b - a)
                ids, counts = encoder.encode(piece.column("text"), end_id)
                files["ids"].write(ids.astype(f"<u{width}").tobytes())
                files["off"].write((total + np.cumsum(counts)).astype("<u8").tobytes())
                files["doc"].write(piece.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                documents, total = documents + len(counts), total + len(ids)
        if files:
            for kind, f in files.items():
                f.close()
                folder.publish(folder.name(part, kind) + own, folder.name(part, kind))
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([documents]), pa.array([total])],
                                             ["part", "documents", "ids"])
    return run


def read_token_files(spark: SparkSession, uri: str) -> DataFrame:
    """One row for each document: doc_id, start (ids of all documents before it), n_tokens, ids."""
    return _scan(spark, uri, "ids array<long>", lambda ids: pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())))


def token_digests(spark: SparkSession, uri: str) -> DataFrame:
    """Like ``read_token_files`` with ``ids_crc32``, of the ids as little-endian 32-bit integers, in place of the ids."""
    return _scan(spark, uri, "ids_crc32 long",
                 lambda ids: pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()))


def _scan(spark: SparkSession, uri: str, field: str, make) -> DataFrame:
    index = Folder(uri).index()
    schema = f"doc_id long, start long, n_tokens long, {field}"
    width, parts = index["width"], index["parts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = Folder(uri)
        for batch in batches:
            for entry in batch.to_pylist():
                ids = folder.read(entry["part"], "ids", f"<u{width}")
                offsets = np.asarray(folder.read(entry["part"], "off", "<u8")).astype(np.int64)
                doc = np.asarray(folder.read(entry["part"], "doc", "<i8"))
                for a in range(0, len(doc), 1024):
                    at = offsets[a:a + 1025]
                    own = doc[a:a + 1024]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int64(), mask=own == NO_ID), pa.array(entry["base"] + at[:-1]), pa.array(np.diff(at)),
                         make([ids[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])],
                        ["doc_id", "start", "n_tokens", field.split()[0]])

    rows = [(p["part"], p["base"]) for p in parts]
    listed = spark.createDataFrame(rows, "part int, base long").repartition(max(1, len(rows)))
    return listed.mapInArrow(run, schema)
