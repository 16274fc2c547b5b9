"""Benchmark decontamination with suffix arrays over shards of the training text.

Each shard (a few MB of documents) is cut into words and gets a suffix array: its suffixes in lexicographic
order of their word codes, cut at the window's length. Every suffix of a test item that fills a window is
binary-searched in every shard, which gives the places of the window; shorter matches are not reported.
Matches of neighbouring suffixes, and of adjoining passages of any items, join to longer spans. The array holds the suffixes that begin with a gram of
the test set: no other suffix can hold a window.

Test items travel to the tasks in blocks of bounded size; each block adds to what the blocks before it found.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm import words as W
from vitrine.llm.arrow import add_columns
from vitrine.llm.store import stored

WINDOW = 13
BLOCK_BYTES = 2 << 20   # test text that travels to the tasks at a time
SHARD_BYTES = 4 << 20
BLOCKS_IN_ONE_STAGE = 4
FIELDS = ("n_words long, spans array<struct<first: long, last: long>>, items array<string>, longest long")


@dataclass
class Suffixes:
    """Suffixes of a block's items that fill a window; a shorter item has one, the item itself."""

    code: np.ndarray      # suffix x window word hashes, 0 behind the end
    size: np.ndarray      # words of the suffix, the window of its item
    item: np.ndarray      # index into ids
    ids: list[str | None]
    heads: np.ndarray     # sorted gram hashes that these suffixes begin with
    head_words: int

    @staticmethod
    def of(table: pa.Table, window: int) -> Suffixes | None:
        words = W.split(table["text"].combine_chunks(), W.ALNUM, W.LOWER)
        if not len(words.row):
            return None
        needed = np.minimum(words.counts()[words.row], window)
        begins = np.flatnonzero(words.first[words.row + 1] - np.arange(len(words.row)) >= needed)
        size = needed[begins]
        padded = np.concatenate([words.hash, np.zeros(window, np.uint64)])
        code = padded[begins[:, None] + np.arange(window)[None, :]]
        code[np.arange(window)[None, :] >= size[:, None]] = 0
        n = min(4, int(size.min()))
        heads = np.unique(W.grams_of_rows(code[:, :n]))
        ids = [None if i is None else str(i) for i in table["item_id"].to_pylist()]
        return Suffixes(code, size, words.row[begins], ids, heads, n)


class SuffixArray:
    """Sorted suffixes of one shard, as far as they begin with a gram of the test set."""

    def __init__(self, words: W.Words, tests: Suffixes):
        n, depth = tests.head_words, tests.code.shape[1]
        heads = W.grams(words.hash, n)
        table = np.zeros(1 << 20, bool)
        table[tests.heads >> np.uint64(44)] = True
        places = np.flatnonzero(table[heads >> np.uint64(44)] & W.runs_inside(words, n))
        places = places[np.isin(heads[places], tests.heads)]
        padded = np.concatenate([words.hash, np.zeros(depth, np.uint64)])
        rows = np.concatenate([words.row, np.full(depth, -1)])
        columns = [np.where(rows[places + k] == words.row[places], padded[places + k], np.uint64(0))
                   for k in range(depth)]
        order = np.lexsort(columns[::-1])
        self.places, self.code = places[order], [c[order] for c in columns]

    def ranges(self, code: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longest match in words of each test suffix, and the range of suffixes that share it."""
        low, high = np.zeros(len(code), np.int64), np.full(len(code), len(self.places), np.int64)
        matched = np.zeros(len(code), np.int64)
        for k in range(code.shape[1]):
            live = np.flatnonzero((matched == k) & (size > k) & (low < high))
            if not len(live):
                break
            left = self._bound(k, code[live, k], low[live], high[live], False)
            right = self._bound(k, code[live, k], left, high[live], True)
            found = left < right
            low[live[found]], high[live[found]] = left[found], right[found]
            matched[live[found]] = k + 1
        return matched, low, high

    def _bound(self, k: int, value: np.ndarray, low: np.ndarray, high: np.ndarray, after: bool) -> np.ndarray:
        column = self.code[k]
        while True:
            live = low < high
            if not live.any():
                return low
            middle = (low + high) // 2
            probe = column[np.minimum(middle, len(column) - 1)]
            right = live & ((probe <= value) if after else (probe < value))
            low, high = np.where(right, middle + 1, low), np.where(live & ~right, middle, high)


def search_shard(words: W.Words, tests: Suffixes):
    """Place, length and item of every occurrence of a window, and the longest match at each suffix's place."""
    array = SuffixArray(words, tests)
    if not len(array.places):
        return (np.zeros(0, np.int64),) * 3
    matched, low, high = array.ranges(tests.code, tests.size)
    hit = np.flatnonzero(matched == tests.size)
    count = high[hit] - low[hit]
    pick = np.repeat(low[hit], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return array.places[pick], np.repeat(tests.size[hit], count), np.repeat(tests.item[hit], count)


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of word spans, in order; touching ones join."""
    out: list[list[int]] = []
    for x, y in sorted(spans):
        if out and x <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], y)
        else:
            out.append([x, y])
    return [(x, y) for x, y in out]


def _search(table: pa.Table, window: int, first: bool):
    """The pass of one block over a chunk of documents."""
    def compute(part: pa.RecordBatch) -> dict[str, pa.Array]:
        tests = Suffixes.of(table, window)
        words = W.split(part.column("text"), W.ALNUM, W.LOWER)
        if first:
            spans, items = [()] * part.num_rows, [()] * part.num_rows
        else:
            spans = [[(s["first"], s["last"]) for s in x] for x in part.column("_spans").to_pylist()]
            items = part.column("_items").to_pylist()
        if tests is not None and len(words.row):
            place, length, item = search_shard(words, tests)
            order = np.argsort(words.row[place], kind="stable")
            place, length, item = place[order], length[order], item[order]
            rows, begin = np.unique(words.row[place], return_index=True)
            for row, a, b in zip(rows, begin, [*begin[1:], len(place)], strict=False):
                at = place[a:b] - words.first[row]
                spans[row] = merge([*spans[row], *set(zip(at.tolist(), (at + length[a:b] - 1).tolist(), strict=True))])
                ids = {tests.ids[i] for i in np.unique(item[a:b])} - {None}
                items[row] = sorted(ids | set(items[row]))
        lists = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        return {"n_words": pa.array(words.counts(), pa.int64()),
                "spans": pa.array([[{"first": x, "last": y} for x, y in s] for s in spans], lists),
                "items": pa.array([list(i) for i in items], pa.list_(pa.string())),
                "longest": pa.array([max((y - x + 1 for x, y in s), default=0) for s in spans], pa.int64())}
    return compute


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with what of each text stands in ``benchmark`` (item_id, text).

    Adds ``n_words``, ``spans`` (merged word ranges covered by windows), ``items`` (sorted item ids with a
    window in the text) and ``longest`` (words of the longest span, which may join several items). Words are ASCII-lower-cased runs of letters,
    digits and non-ASCII bytes. Null and empty texts have no words; without items nothing is found; an item without
    words has no window; a null item id is searched but not named; columns of ``docs`` with these names are replaced.
    """
    tests = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).dropDuplicates()
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    found = docs
    for b in range(blocks):
        own = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).toArrow()
        before = found.withColumnsRenamed({"spans": "_spans", "items": "_items"}) if b else found
        found = add_columns(before, FIELDS, _search(own, window, b == 0), size=SHARD_BYTES)
        found = found.drop("_spans", "_items") if b else found
        if b % BLOCKS_IN_ONE_STAGE == BLOCKS_IN_ONE_STAGE - 1 and b < blocks - 1:
            found = stored(found, "decontaminate")
    return found


def hit_words():
    """Words of a text inside a span."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"] + 1)


def is_contaminated():
    return (hit_words() > 0) & (20 * hit_words() >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents of which less than a twentieth stands in the benchmark, with their columns unchanged."""
    names = docs.columns
    found = find_contamination(docs.select(F.struct(*[docs[c] for c in names]).alias("row"), "text"), benchmark)
    return found.where(~is_contaminated()).select("row.*")
