"""Periodic runs of words, by a dictionary of basic factors.

A basic factor is a stretch of 2^k words; the dictionary names, for each k, the factors that occur more than once in
their text. Factors of level k+1 are pairs of named factors of level k, so a level costs one sort of the places that are
still repeated. Successive occurrences at most half a factor apart form an arithmetic progression, whose difference is
the factor's own period. A run of period q, 2^k <= q < 2^(k+1), repeats the factor at its start q words later, within
twice the factor's length. Either both occurrences belong to the same progression, and then q is no smallest period, or
an end of one of two progressions is q words from a member of the other. Therefore each level proposes the distances
between members and ends of progressions that lie within twice the factor's length; at most three of them do on a side.

Proposed periods are extended to both sides by the dictionary itself, longest factors first, and deduplicated: of equal
stretches the smallest period stays.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm import words as W
from vitrine.llm.arrow import add_columns

LEAST = 12        # words of the shortest run
NEIGHBOURS = 3    # progressions on a side that can start or end within twice the factor's length
RUNS = "array<struct<start: long, length: long, period: long>>"


def basic_factors(key: np.ndarray, end: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each level: name of the factor at each place (-1: not repeated), and the repeated places by name, then place.

    ``key`` tells words of different rows apart; ``end`` is the end of each place's row.
    """
    levels, place, size = [], np.arange(len(key)), 1
    while len(place):
        order = np.argsort(key, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        group = np.cumsum(new) - 1
        often = np.bincount(group)[group] > 1
        if not often.any():
            break
        name = np.full(len(end), -1, np.int32)
        members = place[order[often]]
        name[members] = group[often]
        levels.append((name, members, group[often]))
        place = np.sort(members)
        place = place[place + 2 * size <= end[place]]
        place = place[name[place + size] >= 0]
        key = name[place].astype(np.int64) * len(end) + name[place + size]
        size *= 2
    return levels


def proposed(member: np.ndarray, group: np.ndarray, size: int) -> np.ndarray:
    """Distinct (period, place) rows proposed by the occurrences of a level's factors."""
    new = np.ones(len(member), bool)
    new[1:] = (group[1:] != group[:-1]) | (2 * (member[1:] - member[:-1]) > size)
    first = np.flatnonzero(new)
    chain = np.cumsum(new) - 1
    ends = member[first], member[np.append(first[1:], len(member)) - 1]
    owner = group[first]
    found = []
    for step in range(1, NEIGHBOURS + 1):
        for sign in (-step, step):
            other = chain + sign
            inside = (other >= 0) & (other < len(first))
            inside[inside] = owner[other[inside]] == group[inside]
            for side in ends:
                a, b = member[inside], side[other[inside]]
                left, period = np.minimum(a, b), np.abs(a - b)
                near = (period >= size) & (period < 2 * size)
                found.append(np.stack([period[near], left[near]], axis=1))
    pairs = np.concatenate(found)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    # Of places in a row that propose the same period, the first is enough: it extends over the others.
    keep = np.ones(len(pairs), bool)
    keep[1:] = (pairs[1:, 0] != pairs[:-1, 0]) | (pairs[1:, 1] > pairs[:-1, 1] + 1)
    return pairs[keep]


def _extend(levels: list, period: np.ndarray, place: np.ndarray, begin: np.ndarray, end: np.ndarray,
            step: int) -> np.ndarray:
    """How many words before (``step`` -1) or from (1) each place on equal those ``period`` words later."""
    reach = np.zeros(len(place), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        name, size = levels[level][0], 1 << level
        at = place + reach if step > 0 else place - reach - size
        inside = np.flatnonzero((at >= begin) & (at + period + size <= end))
        same = name[at[inside]]
        same = (same >= 0) & (same == name[at[inside] + period[inside]])
        reach[inside[same]] += size
    return reach


def runs_of(words: W.Words, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs in a chunk, by start and period; starts count from the chunk's first word."""
    begin, end = words.first[:-1][words.row], words.first[1:][words.row]
    row = words.row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    levels = basic_factors(W.mix(words.hash + row) if len(words.row) else np.zeros(0, np.uint64), end)
    pairs = [proposed(member, group, 1 << level) for level, (_, member, group) in enumerate(levels)]
    if not pairs:
        return np.zeros((0, 3), np.int64)
    period, place = np.concatenate(pairs).T
    after = _extend(levels, period, place, begin[place], end[place], 1)
    before = _extend(levels, period, place, begin[place], end[place], -1)
    start, length = place - before, before + after + period
    run = np.flatnonzero(length >= np.maximum(least, 2 * period))
    run = run[np.lexsort((period[run], length[run], start[run]))]
    same = np.zeros(len(run), bool)
    same[1:] = (start[run[1:]] == start[run[:-1]]) & (length[run[1:]] == length[run[:-1]])
    run = run[~same]
    run = run[np.lexsort((period[run], start[run]))]
    return np.stack([start[run], length[run], period[run]], axis=1)


def _columns(least: int):
    def compute(part: pa.RecordBatch) -> dict[str, pa.Array]:
        words = W.split(part.column("text"), W.SPACED)
        start, length, period = runs_of(words, least).T
        edge = np.zeros(len(words.row) + 1, np.int64)
        np.add.at(edge, start + period, 1)
        np.add.at(edge, start + length, -1)
        kept = np.flatnonzero(np.cumsum(edge)[:-1] == 0)
        text = words.data.tobytes()
        pieces = [text[a:b] for a, b in zip(words.start[kept].tolist(), words.end[kept].tolist(), strict=True)]
        cut = np.searchsorted(kept, words.first).tolist()
        bounds = np.searchsorted(start, words.first)
        first = words.first[np.searchsorted(words.first, start, side="right") - 1] if len(start) else start
        structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start - first, length, period)],
                                             ["start", "length", "period"])
        return {"n_words": pa.array(words.counts(), pa.int64()),
                "runs": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), structs),
                "collapsed": pa.array([b" ".join(pieces[a:b]).decode() for a, b in zip(cut, cut[1:], strict=False)], pa.string())}

    return compute


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` (text, ...) with the periodic runs of each whole text and the text without their repetitions.

    Adds ``n_words``, ``runs`` (start word from 0, length, smallest period, in words, by start and period) and
    ``collapsed``: the words that no run contains after its first period, joined by one space. Words are runs without
    ASCII white space, told apart by 64-bit hashes. A run has at least ``least`` words and two whole periods.
    Null and empty texts have no words and no run. Rows are independent: repeated rows repeat their result, an empty
    table gives no row, other columns pass through, and those with the added names are replaced. A text of n words takes
    about 4 n log2(n) bytes of memory where all of it repeats, far less elsewhere.
    """
    return add_columns(docs, f"n_words long, runs {RUNS}, collapsed string", _columns(least))


def longest_run() -> Column:
    """Struct (length, -start, -period) of the longest run, ties to the smallest start, then period; null without runs."""
    return F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))


def _repeat(part: pa.RecordBatch) -> dict[str, pa.Array]:
    words = W.split(part.column("text"), W.SPACED, hashed=False)
    text, out = words.data.tobytes(), part.column("text").to_pylist()
    for row, doc_id in enumerate(part.column("doc_id").to_pylist()):
        first, n = int(words.first[row]), int(words.first[row + 1] - words.first[row])
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is None or h % 10 or not n:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        place = np.arange(n)
        place[a:] = a + (place[a:] - a) % p
        left, right = words.start[first + place].tolist(), words.end[first + place].tolist()
        out[row] = b" ".join([text[x:y] for x, y in zip(left, right, strict=True)]).decode()
    return {"repeated": pa.array(out, pa.string())}


def with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) and ``repeated``: a tenth of the texts, chosen by doc_id, repeat a stretch to their end.

    With h the crc32 of the decimal doc_id and g = h // 10: where h % 10 is 0, each word i >= a = g % n becomes word
    a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8). Other texts, and rows without doc_id or words, stay as they are.
    """
    return add_columns(docs, "repeated string", _repeat)
