"""Periodic runs, fingerprints and hard negatives: brute force over whole small tables, and edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vitrine.llm import fingerprints, hard_negatives, periodic
from vitrine.llm import words as W
from vitrine.llm.oracles import OP13
from vitrine.llm.queries import QUERIES


def brute_runs(words, least=12):
    """(start, length, period) by comparing the words with themselves at each distance."""
    codes = {}
    w, smallest = np.array([codes.setdefault(x, len(codes)) for x in words]), {}
    for q in range(1, len(w) // 2 + 1):
        change = np.flatnonzero(np.diff(np.concatenate([[0], w[:-q] == w[q:], [0]]).astype(np.int8)))
        for a, b in zip(change[::2].tolist(), change[1::2].tolist(), strict=True):
            if b - a + q >= max(least, 2 * q):
                smallest.setdefault((a, b - a + q), q)
    return sorted(((a, n, q) for (a, n), q in smallest.items()), key=lambda r: (r[0], r[2]))


def test_runs_match_brute_force_on_words_over_few_letters():
    rng = random.Random(7)
    for _ in range(1500):
        rows = []
        for _ in range(rng.randint(1, 3)):
            size, letters = rng.randint(0, 70), rng.choice([1, 2, 2, 3])
            row = [rng.randrange(letters) for _ in range(rng.randint(0, 9))]
            while len(row) < size:
                row += row[-rng.randint(1, 9):] * rng.randint(1, 5) or [0]
                row += [rng.randrange(letters)] if rng.random() < 0.4 else []
            rows.append([f"x{v}" for v in row[:size]])
        least = rng.choice([2, 5, 12])
        words = W.split(pa.array([" ".join(r) for r in rows]), W.SPACED)
        want = [(start + int(words.first[i]), n, q) for i, r in enumerate(rows) for start, n, q in brute_runs(r, least)]
        assert [tuple(x) for x in periodic.runs_of(words, least).tolist()] == want


def test_periodic_query_matches_brute_force(spark, sf):
    got = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, sf).collect()}
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    assert len(got) == len(texts) and any(r["n_runs"] for r in got.values())
    for doc_id, text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        r = got[doc_id]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *(best or (None,) * 3))
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert r["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_periodic_edges(spark):
    docs = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (3, " \n ", "c"), (4, "u " * 50_000, "d"), (4, "u " * 50_000, "d"), (None, "a b " * 6, "e"),
         (5, "a b " * 5 + "a", "f"), (6, "été été " * 6, "g")], "doc_id long, text string, runs string")
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.find_runs(docs).collect()]
    assert sorted(got, key=str) == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), *[(4, 50_000, [(0, 50_000, 1)], "u")] * 2,
        (None, 12, [(0, 12, 2)], "a b"), (5, 11, [], "a b a b a b a b a b a"), (6, 12, [(0, 12, 1)], "été")], key=str)
    assert periodic.find_runs(docs.limit(0)).count() == 0
    assert periodic.with_repeats(docs).where("doc_id IS NULL AND repeated = text").count() == 1


def brute_features(text, rank):
    """Places of selected features, window by window."""
    def level(window):
        total = sum(int(fingerprints._weighted[c]) for c in Counter(window).values())
        return (fingerprints._MOST - total) * fingerprints.LEVELS // fingerprints._MOST

    n = len(text) - fingerprints.WINDOW + 1
    keys = [(int(rank[level(text[i:i + fingerprints.WINDOW])]), i) for i in range(n)]
    votes = Counter(min(keys[max(0, i):i + fingerprints.AROUND])[1] for i in range(1 - fingerprints.AROUND, n))
    return [i for i in range(n) if votes[i] >= fingerprints.POPULAR]


def test_features_match_brute_force(sf):
    texts = [(t or "").encode() for (t,) in duckdb.sql(f"SELECT text FROM '{sf}/documents.parquet' ORDER BY doc_id LIMIT 40").fetchall()]
    texts = [t[:3000] for t in texts if len(t) >= fingerprints.WINDOW] + [b"x" * 32, b"ab" * 100, bytes(range(97, 123)) * 3]
    data, offsets = fingerprints.joined(texts)
    rank = fingerprints.ranks(np.bincount(fingerprints.entropy_levels(data), minlength=fingerprints.LEVELS + 1))
    assert sorted(rank) == list(range(fingerprints.LEVELS + 1))
    assert rank[:fingerprints.LITTLE].min() > rank[fingerprints.LITTLE:].max()
    want = [int(offsets[i]) + p for i, t in enumerate(texts) for p in brute_features(t, rank)]
    assert fingerprints.select(data, offsets, rank).tolist() == want
    for text, found in zip(texts, fingerprints.fingerprints(texts, rank), strict=True):
        features = {text[p:p + fingerprints.WINDOW] for p in brute_features(text, rank)}
        assert int(found.partition(":")[0]) == len(features)
    both = fingerprints.fingerprints([texts[0], texts[1], texts[0] + texts[1]], rank)
    assert fingerprints.likeness(both[0], both[2]) > 0.9 and fingerprints.likeness(both[1], both[2]) > 0.9
    assert fingerprints.likeness(both[0], both[2]) == fingerprints.likeness(both[2], both[0])


def test_fingerprint_query(spark, sf):
    got = sorted(QUERIES["op12_fingerprints"](spark, sf).collect(), key=lambda r: r["doc_id"])
    texts = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()
    prints = {}
    for i, (r, (doc_id, text)) in enumerate(zip(got, texts, strict=True)):
        follower, half = texts[(i + 1) % len(texts)][1], len(text) // 2
        changed = text[:len(text) - half] + follower[:half]
        assert (r["doc_id"], r["n_chars"]) == (doc_id, len(text))
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert r["near_edited"] == fingerprints.likeness(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == fingerprints.likeness(r["fingerprint"], got[(i + 1) % len(got)]["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    long = [r for r in got if r["n_chars"] >= 500]
    assert sum(0.3 < r["near_edited"] for r in long) >= 0.95 * len(long)
    assert np.mean([r["near_next"] < 0.1 for r in long]) >= 0.9
    rank = fingerprints.ranks(fingerprints.level_counts(spark.read.parquet(f"{sf}/documents.parquet")))
    plain = fingerprints.fingerprints([t.encode() for _, t in texts], rank)
    assert plain == [r["fingerprint"] for r in got]


def test_fingerprint_edges(spark):
    long = " ".join(f"w{i % 977}x{i % 1009}" for i in range(60_000))
    docs = spark.createDataFrame([(3, long, 1), (None, "tiny", 1), (7, None, 2), (8, "", 2), (9, "one more text that follows", 3),
                                  (9, "one more text that follows", 3)], "doc_id long, text string, fingerprint int")
    rows = fingerprints.compare_with_edits(docs.repartition(3)).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == 6 and by_id[7]["fingerprint"] == by_id[8]["fingerprint"] == "0:" and by_id[7]["near_next"] == 1
    assert by_id[8]["near_next"] == 0 and by_id[3]["near_next"] == 0 and by_id[3]["n_chars"] == len(long)
    assert by_id[None]["edited_sha256"] == hashlib.sha256(("ti" + long[:2]).encode()).hexdigest()
    nines = [r for r in rows if r["doc_id"] == 9]
    assert sorted(r["near_next"] for r in nines) == [0, 1]
    assert fingerprints.compare_with_edits(docs.limit(0)).count() == 0
    alone = fingerprints.compare_with_edits(docs.where("doc_id = 3")).first()
    assert alone["near_next"] == 1 and alone["edited_fingerprint"]
    plain = fingerprints.fingerprint_texts(docs)
    assert plain.columns == ["doc_id", "text", "fingerprint"] and plain.where("doc_id = 7").first()["fingerprint"] == "0:"


def test_hard_negative_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got = QUERIES["op13_hard_negatives"](spark, sf)
    want = con.execute(OP13)
    columns = [c[0] for c in want.description]
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(want.fetchall())


def brute_negatives(rows, positives=5, negatives=5, low=80):
    out = []
    for anchor, label, v in rows:
        if anchor % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w, strict=True)), i, own) for i, own, w in rows if i != anchor))
        for p, pid, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= 100 * -p][:negatives]
            out += [(anchor, pid, k + 1, i, -p, -s) for k, (s, i, _) in enumerate(inside)]
    return sorted(out)


def test_hard_negatives_with_ties_and_small_blocks(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i * 25 - 1000, rng.randrange(3), [rng.randint(-2, 2) for _ in range(3)]) for i in range(240)]
    frame = spark.createDataFrame([(i, label, [x / 256 for x in v]) for i, label, v in rows],
                                  "vec_id long, label int, embedding array<double>").repartition(5)
    want = brute_negatives(rows)
    assert len(want) > 100
    for block in (hard_negatives.BLOCK_BYTES, 512):
        monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", block)
        assert sorted(tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % 100 == 0).collect()) == want


def test_hard_negative_edges(spark):
    big = [100.0] * 4
    rows = [(100, 1, big), (100, 1, big), (1, 1, big), (2, 2, big), (3, 2, [-100.0] * 4), (4, None, big), (None, 2, big), (5, 2, None),
            (6, 2, [1.0, None, 1.0, 1.0]), (7, 2, [float("nan")] * 4), (8, 2, [float("inf")] * 4), (9, 2, big[:3]), (10, 2, []),
            (200, 3, big), (300, 1, [0.0] * 4)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, anchor_id string")
    got = sorted(tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % 100 == 0).collect())
    top = 4 * 25600 ** 2
    # The zero vector scores 0 with every anchor: as an anchor its window holds the scores 0, as a positive likewise.
    assert got == [(100, 1, 1, 2, top, top), (100, 1, 2, 200, top, top),
                   *[(300, p, k + 1, n, 0, 0) for p in (1, 100) for k, n in enumerate((2, 3, 200))]]
    assert hard_negatives.mine(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert hard_negatives.mine(frame, F.lit(False)).count() == 0
    exact = spark.createDataFrame([(100, 1, [1e5, 1.0]), (1, 1, [1e5, 1.0]), (2, 2, [1e5, 0.99])], "vec_id long, label int, embedding array<double>")
    assert [tuple(r) for r in hard_negatives.mine(exact, F.col("vec_id") == 100).collect()] == [
        (100, 1, 1, 2, 25600000 ** 2 + 256 ** 2, 25600000 ** 2 + 256 * 253)]
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives.mine(exact.withColumn("embedding", F.transform("embedding", lambda x: x * 1e9)), F.lit(True))


def test_packed_keys_sort_like_their_parts():
    rng = random.Random(5)
    parts = [(rng.randint(-3, 3), rng.choice([-5, 0, 7, -(1 << 62), 1 << 62]), rng.randint(-4, 4)) for _ in range(300)]
    keys = hard_negatives.pack(*map(np.array, zip(*parts, strict=True))).to_pylist()
    assert [hard_negatives.unpack(k) for k in keys] == parts
    assert [hard_negatives.unpack(k) for k in sorted(keys)] == sorted(parts, key=lambda p: (p[0], -p[1], p[2]))
