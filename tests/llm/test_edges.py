"""Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns with clashing names."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import decontaminate, forest, language, licences, minhash, mixing, sharding, substrings, token_files, wrappers

LONG = " ".join(f"w{i % 977}x{i % 1009}" for i in range(60_000))
PHRASE = " ".join(f"common{i}" for i in range(40))
DOCS = [
    (5, f"one {PHRASE} two", "en", "x"), (3, f"three {PHRASE} four", "en", "x"), (7, None, "en", None), (8, "", None, "x"),
    (9, "   \n\t ", "de", "x"), (10, LONG, "en", "x"), (11, LONG, "en", "x"), (12, "a b", "fr", "x"), (13, "A B", "fr", "x"),
    (13, "A B", "fr", "x"), (None, f"{PHRASE} tail", "en", "x"), (14, "123 456 !!", None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_near_duplicates(docs, nothing):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()),
                 key=lambda r: (r[0] is None, r[0]))
    by_id = {r[0]: r for r in got}
    assert len(got) == len(DOCS)
    assert by_id[7][1:] == (0, 7, True) and by_id[8][1:] == (0, 8, True) and by_id[9][1:] == (0, 9, True)
    assert by_id[11][2:] == (10, False) and by_id[10][2:] == (10, True)
    assert by_id[12][1:] == (1, 12, True) and by_id[13][1:] == (1, 12, False)
    assert by_id[None][2:] == (None, True)
    assert by_id[5][2:] == (3, False)  # 38 shared shingles of 42 and 42: 38/46 is below 0.85 - unless the texts say otherwise
    assert minhash.near_duplicates(nothing).count() == 0


def test_keep_one_keeps_columns_and_null_ids(docs):
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(
        r["doc_id"] for r in minhash.near_duplicates(docs).where("kept and doc_id is not null").collect())
    assert kept.where("doc_id is null").count() == 1


def test_links_across_components_of_one_bucket_are_found(spark):
    """A chain of texts in which only neighbours are similar: no star around the smallest member finds all links."""
    base = [f"v{i}" for i in range(300)]
    texts = []
    for step in range(12):
        texts.append(" ".join(base))
        base = base[:step * 20 + 3] + [f"new{step}"] + base[step * 20 + 4:]
        base = base[:step * 20 + 13] + [f"other{step}"] + base[step * 20 + 14:]
    order = [7, 2, 11, 0, 9, 4, 1, 10, 3, 8, 6, 5]
    docs = spark.createDataFrame([(order[i], t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = minhash.near_duplicates(docs)

    def shingles(t):
        w = t.split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    sets, parent = [shingles(t) for t in texts], list(range(12))
    for i in range(12):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                parent = [parent[j] if p == parent[i] else p for p in parent]
    want = {order[i]: min(order[j] for j in range(12) if parent[j] == parent[i]) for i in range(12)}
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def test_registers_estimate_similarity():
    rng = np.random.default_rng(1)
    shared, a, b = (np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)) for n in (9000, 500, 500))
    x, y = (minhash.registers(np.unique(np.concatenate([shared, own]))) for own in (a, b))
    agree = float((x == y).mean())
    assert abs(agree - 0.9) < 0.12
    many, few = np.array([9500]), np.array([500])
    assert minhash.may_link(x[None], y[None], many, many, minhash.zero_counts(many), minhash.zero_counts(many))[0]
    assert not minhash.may_link(minhash.registers(a)[None], minhash.registers(b)[None], few, few,
                                minhash.zero_counts(few), minhash.zero_counts(few))[0]
    assert abs(minhash.zero_counts(few).sum() - 1) < 1e-9


def test_substrings(docs, nothing):
    got = {(r["doc_id"], r["text"]): r for r in substrings.remove_repeats(docs.withColumn("n_words", F.lit("clash"))).collect()}
    assert got[(3, DOCS[1][1])]["n_removed"] == 0
    assert got[(5, DOCS[0][1])]["n_removed"] == 40 and got[(5, DOCS[0][1])]["kept_text"] == "one two"
    assert got[(None, DOCS[10][1])]["kept_text"] == "tail"
    assert got[(11, LONG)]["kept_text"] == "" and got[(10, LONG)]["n_removed"] == 0 and got[(10, LONG)]["n_words"] == 60_000
    assert got[(7, None)]["kept_text"] == "" and got[(9, DOCS[4][1])]["n_words"] == 0
    assert [(s["first"], s["last"]) for s in got[(5, DOCS[0][1])]["removed"]] == [(1, 40)]
    assert substrings.remove_repeats(docs).count() == len(DOCS) and substrings.remove_repeats(nothing).count() == 0


def test_decontamination(spark, docs, nothing):
    items = spark.createDataFrame([("i1", PHRASE), ("i2", "A"), (None, "123 456"), ("i3", None), ("i4", ""), ("i1", PHRASE)],
                                  "item_id string, text string")
    for block in (decontaminate.BLOCK_BYTES, 64):
        found = decontaminate.find_contamination(docs, items, block_bytes=block).collect()
        got = {(r["doc_id"], r["text"]): r for r in found}
        assert len(found) == len(DOCS)
        assert got[(5, DOCS[0][1])]["items"] == ["i1"] and got[(5, DOCS[0][1])]["longest"] == 40
        assert [(s["first"], s["last"]) for s in got[(5, DOCS[0][1])]["spans"]] == [(1, 40)]
        assert got[(12, "a b")]["items"] == ["i2"] and got[(14, "123 456 !!")]["items"] == []
        assert got[(14, "123 456 !!")]["longest"] == 2 and got[(7, None)]["n_words"] == 0
    clean = decontaminate.decontaminate(docs.withColumn("spans", F.lit(1)), items)
    assert clean.columns == [*docs.columns, "spans"]
    assert sorted(r["doc_id"] for r in clean.collect()) == [7, 8, 9, 10, 11]
    assert decontaminate.find_contamination(nothing, items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == len(DOCS)


def test_mixing(spark, docs, nothing):
    none = spark.createDataFrame([], "doc_id long, domain string")
    mixed, domains = mixing.mix(docs, none)
    assert domains == ["all"] and {r["rate"] for r in mixed.collect()} == {1.0}
    one = spark.createDataFrame([(3, "high"), (5, None), (None, "low")], "doc_id long, domain string")
    assert mixing.resample(docs.withColumn("rate", F.lit("x")), one).columns == [*docs.columns, "rate"]
    two = spark.createDataFrame([(3, "high"), (5, "high"), (12, "toxic"), (13, "toxic"), (13, "toxic")], "doc_id long, domain string")
    mixed, domains = mixing.mix(docs, two)
    assert mixed.count() == len(DOCS) and set(domains) == {"high", "toxic"}
    assert mixing.mix(nothing, two)[0].count() == 0


def test_mixing_learns_from_both_beginnings_of_words(spark):
    row = mixing.with_tokens(spark.createDataFrame([("Abcdefg",)], "text string")).first()
    assert row["_words"] == ["abcdefg", "<3>abc", "<5>abcde"] and row["n_tokens"] == 1
    assert (mixing.FEATURES, mixing.ITERATIONS) == (1 << 17, 50)


def test_posteriors_are_a_plain_softmax(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["good", "fine", "calm", "bad", "vile", "dull"], 30, p=p))
             for p in ([.4, .3, .3, 0, 0, 0], [0, 0, 0, .4, .3, .3]) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "high" if i < 40 else "low") for i in range(80) if i % 2], "doc_id long, domain string")
    scored, domains = mixing.domain_posteriors(docs.withColumn("p_other", F.lit(7)), labelled)
    rows = scored.orderBy("doc_id").collect()
    assert domains == ["high", "low"] and rows[0]["p_other"] == 7 and rows[0]["n_tokens"] == 30
    assert all(abs(r["p_high"] + r["p_low"] - 1) < 1e-12 and (r["p_high"] > 0.5) == (r["doc_id"] < 40) for r in rows)
    found = mixing.Features(np.array([0, 0, 1]), np.array([5, 9, 5]), np.array([2, 1]))
    p = mixing.posteriors(found, 3, np.array([5, 9]), np.array([[1.0, 0.0], [0.0, 2.0]]), np.array([0.5, 0.0]))
    z = np.array([[1.5, 2.0], [1.5, 0.0], [0.5, 0.0]])
    assert np.allclose(p, np.exp(z) / np.exp(z).sum(axis=1, keepdims=True))


def test_whole_from_keeps_what_rounding_leaves_out(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * 20) for i in range(200)], "doc_id long, text string")
    labelled = spark.createDataFrame([(0, "high")], "doc_id long, domain string")
    import pytest as _pytest
    with _pytest.MonkeyPatch.context() as patch:
        patch.setattr(mixing, "fit_rates", lambda *a: mixing.Fit(0.6, np.ones(1), []))
        plain = [r["copies"] for r in mixing.mix(docs, labelled)[0].collect()]
        lifted = [r["copies"] for r in mixing.mix(docs, labelled, whole_from=0.5)[0].collect()]
    assert 0.45 < np.mean(plain) < 0.75 and set(lifted) == {1}


def test_hashed_features_are_those_of_the_definition(spark, sf):
    """Texts share a bucket as often as they share a listed feature, and in no other way (up to rare collisions)."""
    from collections import Counter

    import pyarrow as pa
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect()]
    texts += [None, "", " \n", "ÉTÉ Straße, d'accord... ÀÉ 12a!?", "A B C", "x x x x x x x", "MIXED Case word", LONG[:3000], "\u00a0a\u00a0b", "!!!"]
    listed = [r for r in mixing.with_tokens(spark.createDataFrame([(t,) for t in texts], "text string")).collect()]
    found = mixing.hashed_features(pa.array(texts, pa.string()))
    assert found.n_tokens.tolist() == [r["n_tokens"] for r in listed]
    bucket_of, clashes = {}, 0
    for i, r in enumerate(listed):
        want, got = Counter(r["_words"]), found.bucket[found.row == i]
        assert len(got) == sum(want.values())
        if len(want) == 1 == len(set(got.tolist())):
            bucket_of[next(iter(want))] = int(got[0])
    names = sorted({w for r in listed for w in r["_words"]})
    alone = mixing.hashed_features(pa.array([w for w in names if not w.startswith("<")], pa.string()))
    words = [w for w in names if not w.startswith("<")]
    for i, word in enumerate(words):
        own = alone.bucket[alone.row == i].tolist()
        bucket_of |= {word: own[0], f"<3>{word[:3]}": own[1], f"<5>{word[:5]}": own[2]}
    for i, r in enumerate(listed):
        want = Counter(bucket_of[w] for w in r["_words"] if w in bucket_of)
        got = Counter(found.bucket[found.row == i].tolist())
        clashes += sum((want - got).values())
        assert sum((got - want).values()) <= sum(w not in bucket_of for w in r["_words"])
    assert clashes == 0


def test_absent_documents_use_up_no_training_rows(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "TRAINING_ROWS", 4)
    labels = [(i, "low") for i in range(1000, 1200)] + [(7, "low"), (9, "low"), (3, "high"), (5, "high"), (12, "toxic"), (13, "toxic")]
    assert mixing.domain_posteriors(docs, spark.createDataFrame(labels, "doc_id long, domain string"))[1] == ["high", "toxic"]
    both = spark.createDataFrame([(3, "high"), (12, "toxic"), (12, "high")], "doc_id long, domain string")
    assert mixing.domain_posteriors(docs, both)[1] == ["high", "toxic"]


def test_licences(spark, nothing):
    texts = {1: "Licensed under the Apache License, Version 2.0.", 2: "gnu  GENERAL-public\nlicense v3 or later; MIT License",
             3: "permit licenses CC BYE", 4: None, 5: "", 6: "CC BY-NC-SA 4.0", 7: "é" * 10 + "mit license", 8: LONG + " mit license"}
    got = {r["doc_id"]: r for r in licences.scan_licences(
        spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("labels", F.lit(1))).collect()}
    assert got[1]["labels"] == "apache,apache-2.0" and (got[1]["first_word"], got[1]["last_word"]) == (3, 3)
    assert got[2]["base_labels"] == "gpl,mit" and "gpl-3" in got[2]["labels"] and got[2]["n_base"] == 2
    assert got[3]["labels"] == got[4]["labels"] == got[5]["labels"] == "" and got[5]["score"] == 0
    assert got[6]["labels"] == "cc-by,cc-by-nc-sa-4.0" and got[7]["n_base"] == 0 and got[8]["first_word"] == 60_000
    assert licences.scan_licences(nothing).count() == 0


def test_contained_detections_are_suppressed():
    inner, outer, apart = (licences.Detection(*x) for x in ((5, 9, "b", 4, 0.5), (0, 10, "a", 1, 0.9), (8, 14, "c", 4, 0.5)))
    assert licences.resolve([inner, outer, apart]) == [outer, apart]
    assert licences.resolve([inner, inner]) == [inner]


def test_language(spark, nothing):
    words = {"aa": "bara nabu karam tara", "zz": "woxi zuxo wizu xoz"}
    rows = [(i, " ".join([words[lang]] * 20), lang) for i, lang in enumerate(["aa", "zz"] * 8)]
    rows += [(100, None, "aa"), (101, "", None), (102, "12 34 --", "zz"), (103, words["aa"] * 3000, None), (103, words["aa"] * 3000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: r for r in language.identify(docs, F.col("doc_id") < 12).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows[:16])
    assert [got[i]["lang_pred"] for i in (100, 101, 102, 103)] == ["und", "und", "und", "aa"]
    assert got[100]["score"] == 0 and 0 <= got[103]["score"] <= 1
    kept = language.keep_identified(docs, F.col("doc_id") < 12)
    assert kept.columns == docs.columns and kept.count() == 18
    assert {r["lang_pred"] for r in language.identify(docs, F.lit(False)).collect()} == {"und"}
    assert language.identify(nothing, F.lit(True)).count() == 0


def test_code_switched_words_are_labelled():
    texts = ["bara nabu karam tara " * 20, "woxi zuxo wizu xoz " * 20]
    model = language.fit(texts, [0, 1], ["aa", "zz"], np.zeros((1 << language.LEXICON_BITS, 2)))
    assert language.word_labels(["bara karam nabu woxi wizu xoz"], model) == [["aa"] * 3 + ["zz"] * 3]
    assert model.move[0, 0] > model.move[0, 1]


PAGE = ("<html><head><title>T</title><script>x='</p>'</script></head><body><nav><ul><li>Home</li><li>About</li></ul></nav>"
        "<div class='cookie-notice'>Cookies!</div>{}<aside>side</aside><footer>foot</footer></body></html>")


def test_wrappers(spark):
    pages = [
        (1, "http://a.org/1", PAGE.format("<article><h1>One&amp;Two</h1><p>a  <b>b</b>c<br>d</p><div class=comments>no</div></article>")),
        (2, "http://A.org/2", PAGE.format("<article><h1>Other</h1><p>x<p>y&nbsp;z &lt;t&gt;</article>")),
        (3, None, None), (4, "nowhere", ""), (5, "http://b.org/", "plain text only"), (5, "http://b.org/", "plain text only"),
        (6, "http://c.org/", PAGE.format("<div id='content'>one</div><div class='ad'>buy</div>")),
        (7, "http://d.org/", PAGE.format("<article>" + "<p>word word</p>" * 3000 + "</article>")), (8, "http://e.org", "<p>cut <b class='"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit(7))
    got = [r.asDict() for r in wrappers.extract_text(df).collect()]
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert text[1] == "One&Two a bc d" and text[2] == "Other x y z <t>"
    assert text[3] == text[4] == "" and text[5] == "plain text only" and text[6] == "one" and text[8] == "cut"
    assert len(text[7]) == 3000 * 10 - 1
    assert wrappers.extract_text(df.limit(0)).count() == 0


def test_wrapper_inference_makes_slots_options_and_groups():
    page = wrappers.page_wrapper
    both = wrappers.align(page(wrappers.Stream("<ul><li>a</li><li>b</li></ul><p>same</p>")),
                          page(wrappers.Stream("<ul><li>c</li></ul><p>same</p><hr>")))
    assert both == [["tag", "ul"], ["rep", [["tag", "li"], ["text", None], ["tag", "/li"]]], ["tag", "/ul"],
                    ["tag", "p"], ["text", "same"], ["tag", "/p"], ["opt", [["tag", "hr"]]]]


def test_texts_of_the_template_go_without_names(spark):
    page = ("<div class=c1><ul><li>Home</li><li>News</li>{extra}</ul></div><div class=c2><h1>Title {i}</h1>{body}"
            "<p>Sign up for our letter.</p></div><div class=c3>" + "Buy now, this week only. " * 4 + "{i}</div>"
            "<div class=c4>We use biscuits on every page of ours.</div>")
    body = ["<p>First words.</p>", "<p>Second words.</p><p>More of them.</p>", "<p>Third.</p><ul><li>x1</li><li>y1</li></ul>", "<p>Fourth.</p>"]
    rows = [(i, "http://n.org/", page.format(i=i, body=b, extra="<li>Sport</li>" * (i % 2))) for i, b in enumerate(body)]
    rows += [(10 + i, "http://n.org/", rows[0][2]) for i in range(3)]
    rows += [(20 + i, "http://m.org/", f"<article><p>Own text of the page {i}.</p><p>Read it in the app.</p></article>") for i in range(3)]
    rows += [(30 + i, "http://copies.org/", f"<article><p>One long text that is the same on both pages.</p><p>{i}</p></article>") for i in range(2)]
    rows += [(40, "http://one.org/", "<div class=c1>Alone</div><div class=menu>Home</div>")]
    got = {r["page_id"]: r["text"] for r in wrappers.extract_text(
        spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    advert = ("Buy now, this week only. " * 4)
    assert got[0] == got[10] == got[11] == got[12] == f"Title 0 First words. {advert}0"
    assert got[1].replace("Sport ", "") == f"Title 1 Second words. More of them. {advert}1"
    assert got[2] == f"Title 2 Third. x1 y1 {advert}2"
    assert [got[20 + i] for i in range(3)] == [f"Own text of the page {i}." for i in range(3)]
    assert [got[30 + i] for i in range(2)] == [f"One long text that is the same on both pages. {i}" for i in range(2)]
    assert got[40] == "Alone"


def test_texts_alike_in_their_beginnings_are_told_apart():
    page = wrappers.page_wrapper
    one, two = (page(wrappers.Stream(f"<p>{'word ' * 20}{x}</p>")) for x in "ab")
    assert wrappers.align(one, two)[1] == ["text", None]


def test_token_files(spark, docs, nothing, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    uri = token_files.write_token_files(docs, path, uri=f"file://{tmp_path}/t")
    got = token_files.read_token_files(spark, uri).toPandas().sort_values("start")
    order = sorted(DOCS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    tokenizer = Tokenizer.from_file(path)
    for (doc_id, text, *_), (_, r) in zip(order, got.iterrows(), strict=True):
        assert list(r["ids"]) == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert (r["doc_id"] == doc_id) or (doc_id is None and np.isnan(r["doc_id"]))
    empty = token_files.write_token_files(nothing, path, uri=f"file://{tmp_path}/e")
    assert token_files.token_digests(spark, empty).count() == 0


def test_word_encoder_forgets_without_harm(monkeypatch):
    import public_tokenizers
    import pyarrow as pa

    monkeypatch.setattr(token_files, "CACHE_WORDS", 5)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        encoder = token_files.WordEncoder(f.read())
    texts = ["one two three", "Four FIVE six's", "one é ñ <|endoftext|>x", "", "two two two seven eight"]
    for text in texts * 2:
        ids, counts = encoder.encode(pa.array([text]), 1)
        assert ids.tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 1] and counts.tolist() == [len(ids)]


def test_sharding(spark, docs, nothing):
    got = sharding.shard(docs.withColumn("shard", F.lit("clash"))).toPandas()
    assert len(got) == len(DOCS) and got[got["doc_id"] == 7]["size"].tolist() == [1]
    for _, own in got.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    same = got[got["doc_id"] == 13]
    assert len(set(same["shard"])) == 1
    assert sharding.shard(nothing).count() == 0


def test_a_group_too_large_for_a_shard_is_dealt_out(spark):
    rows = [(i, "same text " * 50) for i in range(600)] + [(i, f"text {i} " * 60) for i in range(600, 1200)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    load = got.groupby("shard")["size"].sum()
    assert len(load) == 16 and load.max() <= 1.1 * load.sum() / 16


def test_forest(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((300, 8)))]
    rows += [(i, [1.0] * 8) for i in range(300, 320)] + [(400, None), (500, [0.0] * 8), (600, [float("nan")] * 8), (700, [1.0] * 3),
                                                        (800, [None] + [1.0] * 7), (None, [1.0] * 8), (900, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = forest.nearest(df, F.col("vec_id") % 100 == 0).toPandas()
    ok = {i: np.array(v) for i, v in rows[:320]}
    for q in (0, 100, 200, 300):
        want = sorted((float(np.sqrt(((ok[i] - ok[q]) ** 2).sum())), i) for i in ok if i != q)[:10]
        own = got[got["query_id"] == q].sort_values("rank")
        assert own["vec_id"].tolist() == [i for _, i in want] and np.allclose(own["score"], [d for d, _ in want])
    assert set(got["query_id"]) == {0, 100, 200, 300}
    assert forest.nearest(df.limit(0), F.lit(True)).count() == 0
    assert forest.nearest(df.where("vec_id < 4"), F.col("vec_id") == 0).count() == 3


def test_repeated_rows_crowd_out_no_neighbour(spark):
    rng = np.random.default_rng(5)
    plain = [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((60, 6)))]
    near = [(i, [x + 1e-3 * j for x in plain[i][1]]) for i in range(60) for j in range(12)]
    schema, columns = "vec_id long, embedding array<double>", ["query_id", "rank", "vec_id"]

    def of(rows):
        found = forest.nearest(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0).toPandas()
        return found.sort_values(columns[:2]).reset_index(drop=True)

    want, got = of(plain), of(plain * 12)
    assert len(want) == 30 and got[columns].equals(want[columns]) and np.allclose(got["score"], want["score"], rtol=1e-12)
    got = of(near)   # rows of one vec_id that differ a little
    assert got.groupby("query_id")["vec_id"].nunique().tolist() == [10, 10, 10]
    at = {i: np.array([v for j, v in near if j == i]) for i in range(60)}
    for q in (0, 20, 40):
        far = sorted((float(min(np.linalg.norm(at[i] - x, axis=1).min() for x in at[q])), i) for i in at if i != q)[:10]
        own = got[got["query_id"] == q]
        assert own["vec_id"].tolist() == [i for _, i in far] and np.allclose(own["score"], [d for d, _ in far])


def test_digest_of_kept_words_is_that_of_the_text(docs):
    row = substrings.remove_repeats(docs).where("doc_id = 5").select(
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("h")).first()
    assert row["h"] == hashlib.sha256(b"one two").hexdigest()
