"""Registered queries against SQL, brute force, or an exact round trip, over whole small tables."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from vitrine.llm import licences
from vitrine.llm.queries import ORACLES, QUERIES

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels"]


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def rows(spark, sf, name, key="doc_id"):
    return sorted((r.asDict() for r in QUERIES[name](spark, sf).collect()), key=lambda r: r[key])


def documents(oracle):
    return oracle.execute("SELECT doc_id, text, lang FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", ["op1_minhash", "op4_substrings", "op8_decontaminate", "op9_forest"])
def test_query_matches_sql(spark, sf, oracle, name):
    got = QUERIES[name](spark, sf).toPandas()
    want = oracle.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    order = [c for c in ("doc_id", "query_id", "rank") if c in got.columns]
    got, want = (x[sorted(x.columns)].sort_values(order).reset_index(drop=True) for x in (got, want))
    for column in got.columns:
        if column == "score":
            assert np.allclose(got[column], want[column], rtol=1e-12)
        else:
            assert got[column].astype(str).tolist() == want[column].astype(str).tolist(), column


def test_mixing_meets_its_targets(spark, sf, oracle):
    got = QUERIES["op2_mixing"](spark, sf).toPandas()
    domains = [c[2:] for c in got.columns if c.startswith("p_")]
    shares, tokens = got[[f"p_{d}" for d in domains]].to_numpy(), got["n_tokens"].to_numpy(float)
    assert len(got) == len(documents(oracle)) and np.allclose(shares.sum(axis=1), 1)
    assert (got["rate"] >= 0).all() and (np.abs(got["copies"] - got["rate"]) <= 1).all()
    totals = shares.T @ (tokens * got["rate"].to_numpy())
    from vitrine.llm.mixing import TARGETS
    weight = np.array([TARGETS[d] for d in domains])
    there = shares.T @ tokens
    goal = weight / weight.sum() * (there[weight > 0] / (weight / weight.sum())[weight > 0]).max()
    assert np.abs(totals - goal).max() <= 0.02 * goal.sum()
    # Plain projected gradient over the same numbers comes no closer than by a hundredth of the tokens.
    rate = np.full(len(tokens), goal.sum() / tokens.sum())
    matrix = shares * tokens[:, None]
    step = 1 / np.linalg.eigvalsh(matrix.T @ matrix)[-1]
    for _ in range(3000):
        rate = np.maximum(0, rate - step * matrix @ (matrix.T @ rate - goal))
    assert np.linalg.norm(totals - goal) <= np.linalg.norm(matrix.T @ rate - goal) + 1e-2 * goal.sum()


def test_licence_base_phrases_match_a_word_loop(spark, sf, oracle):
    phrases = [(tuple(words.split()), label) for words, label in licences.BASE]
    by_id = {r["doc_id"]: r for r in rows(spark, sf, "op3_licences")}
    for doc_id, text, _ in documents(oracle):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        hits = [(i, label) for i in range(len(words)) for p, label in phrases if tuple(words[i:i + len(p)]) == p]
        got = by_id[doc_id]
        assert got["n_words"] == len(words) and got["n_base"] == len(hits)
        assert got["first_word"] == (hits[0][0] if hits else None) and got["last_word"] == (hits[-1][0] if hits else None)
        assert got["base_labels"] == ",".join(sorted({x for _, x in hits}))
        assert set(filter(None, got["base_labels"].split(","))) <= set(got["labels"].split(",")) and 0 <= got["score"] <= 1


def test_language_of_held_out_documents(spark, sf, oracle):
    truth = {i: lang for i, _, lang in documents(oracle)}
    got = rows(spark, sf, "op5_language")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_pages_give_article_texts(spark, sf, oracle):
    got = {r["page_id"]: r for r in rows(spark, sf, "op6_wrappers", "page_id")}
    import html
    for page_id, page in oracle.execute("SELECT page_id, html FROM pages").fetchall():
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = re.split(r"<(?:/?h\d|/?p|br)>", article)
        want = " ".join(" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
        assert got[page_id]["text"] == " ".join(want.split())
        assert got[page_id]["n_chars"] == len(got[page_id]["text"])


def test_token_files_are_an_exact_round_trip(spark, sf, oracle):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got, start = rows(spark, sf, "op7_token_files"), 0
    for (doc_id, text, _), r in zip(documents(oracle), got, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (doc_id, start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_shards_are_balanced_and_keep_equal_texts_together(spark, sf, oracle):
    got, texts = rows(spark, sf, "op10_sharding"), {i: t for i, t, _ in documents(oracle)}
    shard_of, load = {}, Counter()
    for r in got:
        text = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(text) + 1 and r["text_crc32"] == zlib.crc32(text)
        assert shard_of.setdefault(text, r["shard"]) == r["shard"]
        load[r["shard"]] += r["size"]
    assert {r["law"] for r in got} == {"bytes"} and set(load) == set(range(16))
    assert max(load.values()) <= max(1.05 * sum(load.values()) / 16, max(r["size"] for r in got))
    for s in range(16):
        assert [r["slot"] for r in got if r["shard"] == s] == list(range(sum(r["shard"] == s for r in got)))


def test_forest_recall(spark, oracle):
    con = duckdb.connect()
    sf = "/root/testdata/sf0.1"
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = set(con.execute("SELECT query_id, vec_id FROM (" + ORACLES["op9_forest"] + ")").fetchall())
    got = {(r["query_id"], r["vec_id"]) for r in QUERIES["op9_forest"](spark, sf).collect()}
    assert len(got & want) >= 0.9 * len(want)


def test_pipeline_matches_plain_stages(spark, sf, oracle):
    """What each stage keeps, against brute force on what the stage before it kept."""
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, seen = docs.columns, []
    for _, stage in pipeline.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == names
        docs = spark.createDataFrame(out.toPandas(), docs.schema)
        seen.append({r["doc_id"]: r["text"] for r in docs.collect()})
    first = {i: t for i, t, _ in documents(oracle)}
    assert set(seen[0]) == {r["doc_id"] for r in QUERIES["op5_language"](spark, sf).collect()
                            if r["lang_pred"] != "und" and r["score"] >= 0.5}
    assert all(first[i] == t for i, t in seen[0].items())
    con = duckdb.connect()
    for before, after, oracle_name, keep in ((seen[0], seen[1], "op1_minhash", "kept"),
                                             (seen[1], seen[2], "op8_decontaminate", "NOT contaminated")):
        con.execute("CREATE OR REPLACE TABLE documents (doc_id BIGINT, text VARCHAR)")
        con.executemany("INSERT INTO documents VALUES (?, ?)", list(before.items()))
        con.execute(f"CREATE OR REPLACE VIEW benchmark AS SELECT * FROM '{sf}/benchmark.parquet'")
        assert set(after) == {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLES[oracle_name]}) WHERE {keep}").fetchall()}
    assert set(seen[3]) <= set(seen[2])
    final = pipeline.STAGES[4][1](spark, docs, sf).toPandas().sort_values("start")
    assert len(final) == docs.count() and final["doc_id"].is_monotonic_increasing
    assert (final["start"].to_numpy()[1:] == final["n_tokens"].cumsum().to_numpy()[:-1]).all()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
