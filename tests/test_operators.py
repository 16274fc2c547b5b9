"""Operators on small frames, checked against numpy or by hand."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from vitrine.operators import clean, features, metrics, ordering, reports, rules, scaling, scoring, splits, topk
from vitrine.sources import store_json, tables


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(params=["merged", "many slabs"])
def order_route(request, spark):
    """Run a test with few slabs of the ordering primitive and with many."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, str(request.param == "merged").lower())
    yield request.param
    spark.conf.unset(key)


def test_keep_first_uses_order(spark):
    df = frame(spark, [(1, 9, "late"), (1, 2, "early"), (2, 1, "only")], "k int, seq int, v string")
    got = {r.k: r.v for r in clean.keep_first(df, ["k"], ["seq"]).collect()}
    assert got == {1: "early", 2: "only"}


def test_dedup_plan_limits_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS seq")
    plan = clean.keep_first(df, ["k"], ["seq"])._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.rindex("WindowGroupLimit") > physical.index("Exchange")


def test_blank_urls_survive_unless_strict(spark):
    df = frame(spark, [("", 1), ("", 2), (None, 3), ("a", 4), ("a", 5)], "url string, seq int")
    assert sorted(r.seq for r in clean.dedup_by_url(df, ["seq"]).collect()) == [1, 2, 3, 4]
    assert sorted(r.seq for r in clean.dedup_by_url(df, ["seq"], strict=True).collect()) == [1, 3, 4]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), min_size=1, max_size=40), st.integers(1, 5))
def test_quantiles_match_numpy(spark, order_route, values, partitions):
    known = [v for v in values if v is not None]
    df = frame(spark, [(v,) for v in values], "v double").repartition(partitions)
    got = {r.prob: r.value for r in ordering.quantiles(df, ["v"], [0.0, 0.01, 0.5, 0.6, 1.0]).collect()}
    if not known:
        assert got == {}
    for prob, value in got.items():
        assert value == pytest.approx(np.quantile(known, prob), abs=1e-9)


def test_hot_group_spreads_over_slabs(spark, order_route):
    """One group with nearly all values still gets exact quantiles."""
    df = spark.range(5000).selectExpr("CASE WHEN id < 4990 THEN 'hot' ELSE 'cold' END AS g", "CAST(id AS double) AS v")
    got = {r.g: r.value for r in ordering.quantiles(df, ["v"], [0.5], by=["g"]).collect()}
    assert got == {"hot": 2494.5, "cold": 4994.5}


@pytest.mark.parametrize("values", [[1.0, None, 3.0, 10.0, None, None], [5.0, 5.0, None], [1.0, 2.0, 3.0, 4.0, None]])
def test_filled_quantiles(spark, order_route, values):
    df = frame(spark, [(v,) for v in values], "prix double")
    ranks = ordering.value_ranks(df, ["prix"])
    median = ordering.median_record(ranks, ["prix"])
    edges = ordering.filled_quantile_record(ranks, "prix", {"low": 0.1, "high": 0.85}, median.getField("prix"))
    got = spark.range(1).select(edges.alias("e")).select("e.*").first()
    known = [v for v in values if v is not None]
    full = [np.median(known) if v is None else v for v in values]
    assert got.low == pytest.approx(np.quantile(full, 0.1)) and got.high == pytest.approx(np.quantile(full, 0.85))


def test_row_positions_and_codes(spark, order_route):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id AS v")
    ranked = ordering.row_positions(df, ["g"], ["v"], "pos").collect()
    assert all(r.pos == r.v // 3 for r in ranked)
    words = frame(spark, [("b",), ("a",), ("Éa",), ("nan",), ("a",)], "w string")
    codes = {r.value: r.code for r in ordering.value_codes(words, ["w"]).collect()}
    assert codes == {"a": 0, "b": 1, "nan": 2, "Éa": 3}


def test_scalers(spark):
    df = frame(spark, [(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in scaling.scale_minmax(df, ["a", "b"]).orderBy("a").collect()] == [(0.0, 0.0), (1.0, 0.0)]
    z = scaling.zscore_columns(df, ["a", "b"]).orderBy("a").collect()
    assert [(r.z_a, r.z_b) for r in z] == [(-1.0, 0.0), (1.0, 0.0)]


def test_single_row_and_empty_score(spark):
    schema = "product_id int, rating double, nb_reviews int, prix double, en_stock int, categorie string"
    one = scoring.topk_score(frame(spark, [(1, 4.0, 10, 5.0, 1, "a")], schema)).first()
    assert one.topk_score == pytest.approx(0.15 + 0.15)
    assert topk.select_top_k(frame(spark, [], schema), 5).count() == 0


def test_ties_and_short_groups(spark):
    df = frame(spark, [(2, "a", 0.5), (1, "a", 0.5), (3, "b", 0.9)], "product_id int, g string, topk_score double")
    assert [(r.product_id, r["rank"]) for r in topk.rank_top(df, 2).orderBy("rank").collect()] == [(3, 1), (1, 2)]
    assert topk.rank_top_by(df, "g", 5, "r").count() == 3


def test_source_budget(spark):
    df = frame(spark, [("s", 1, 3), ("s", 2, 4), ("s", 3, 9), ("t", 1, 9)], "store string, cat_ord int, n int")
    got = sorted((r.store, r.cat_ord) for r in topk.source_budget(df, 5).collect())
    assert got == [("s", 1), ("s", 2), ("t", 1)]


def test_filter_is_pushed_to_the_scan(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet").selectExpr(
        "p_type AS categorie", "p_brand AS marque_vendeur", "p_name AS pays_shop", "p_name AS plateforme", "p_retailprice AS prix")
    chosen = reports.ProductFilter(categories=["PROMO"], price_range=(1, 2)).apply(part).select("prix")
    plan = chosen._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull" in plan and "p_type" in plan and "ReadSchema: struct<p_type:string,p_retailprice:double>" in plan


def test_rating_estimation_switch(spark):
    rows = [(1, 0.0, 0, 10.0, 1, 0.0, "x"), (2, 0.0, 0, 20.0, 0, 5.0, "best")]
    schema = "product_id int, rating double, nb_reviews int, prix double, en_stock int, remise_pct double, tags string"
    est = scoring.estimate_ratings(frame(spark, rows, schema)).collect()
    assert all(1.0 <= r.rating <= 5.0 and 0 <= r.nb_reviews <= 5000 for r in est)
    rated = frame(spark, rows + [(3, 2.0, 1, 1.0, 1, 0.0, "")], schema)
    assert [r.rating for r in scoring.estimate_ratings(rated).orderBy("product_id").collect()] == [0.0, 0.0, 2.0]


def test_encode_missing_label(spark):
    df = frame(spark, [("b",), (None,), ("a",)], "categorie string")
    got = {r.categorie: r.categorie_enc for r in features.encode_labels(df).collect()}
    assert got == {"a": 0, "b": 1, None: 2}


# --- rules -----------------------------------------------------------------

def test_rule_identities(spark):
    rng = np.random.default_rng(7)
    rows = [(g, f"i{k}") for g in range(200) for k in rng.choice(6, size=rng.integers(1, 6))]
    baskets = rules.build_baskets(frame(spark, rows, "g int, item string"), "g", "item")
    sets = {frozenset(r["items"]): 0 for r in baskets.collect()}
    truth = [set(r["items"]) for r in baskets.collect()]
    support = {r["items"]: r.support for r in rules.frequent_itemsets(baskets, 0.1).collect()}
    assert sets and all(s == pytest.approx(sum(set(k.split(", ")) <= t for t in truth) / len(truth), abs=1e-4) for k, s in support.items())
    assert all(support[k] <= support[x] for k in support for x in k.split(", "))
    for r in rules.association_rules(baskets, 0.1, 0.3, 0.5).collect():
        joint = support[", ".join(sorted(r.antecedents.split(", ") + [r.consequents]))]
        assert r.confidence == pytest.approx(joint / support[r.antecedents], abs=2e-3)
        assert r.lift == pytest.approx(r.confidence / support[r.consequents], abs=1e-2)


def test_rules_without_result(spark):
    baskets = rules.build_baskets(frame(spark, [(1, "a"), (2, "b"), (2, "b")], "g int, item string"), "g", "item")
    assert rules.frequent_itemsets(baskets, 0.9).count() == 0
    assert rules.association_rules(baskets, 0.9, 0.5).columns == ["antecedents", "consequents", "support", "confidence", "lift"]


# --- classification metrics and splits ---------------------------------------

def scored(spark, triples):
    return frame(spark, triples, "y int, pred int, prob double")


@pytest.mark.parametrize("triples, area", [
    ([(0, 0, 0.5), (1, 1, 0.5)], 0.5), ([(0, 0, 0.1), (1, 1, 0.9)], 1.0), ([(1, 1, 0.9), (1, 0, 0.2)], None)])
def test_auc_edges(spark, triples, area):
    assert metrics.auc_exact(scored(spark, triples)).first().auc == area


def test_auc_matches_pairs(spark, order_route):
    rng = np.random.default_rng(3)
    y, p = rng.integers(0, 2, 300), rng.integers(0, 12, 300) / 12.0
    pos, neg = p[y == 1], p[y == 0]
    truth = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    df = scored(spark, [(int(a), 0, float(b)) for a, b in zip(y, p)]).repartition(5)
    assert metrics.auc_exact(df).first().auc == pytest.approx(truth, abs=1e-6)
    curve = metrics.roc_curve(df).orderBy(F.col("threshold").desc_nulls_first()).collect()
    assert curve[0].tpr == 0.0 and (curve[-1].tpr, curve[-1].fpr) == (1.0, 1.0)
    assert sum((b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(curve, curve[1:])) == pytest.approx(truth, abs=1e-5)


def test_metrics_zero_division(spark):
    row = metrics.binary_metrics(scored(spark, [(1, 0, 0.1), (0, 0, 0.2)])).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (0.5, 0.0, 0.0, 0.0)
    assert {(r.actual, r.predicted): r.n for r in metrics.confusion_matrix(scored(spark, [(1, 0, 0.1)])).collect()} == \
        {(0, 0): 0, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_split_and_folds_are_exact_and_stable(spark, order_route):
    df = spark.range(997).selectExpr("id AS k", "CAST(id % 10 = 0 AS int) AS y")
    first = splits.stratified_split(df, "y", "k")
    again = splits.stratified_split(df.repartition(9), "y", "k")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    sizes = {r.y: (r.t, r.n) for r in first.groupBy("y").agg(F.sum("is_test").alias("t"), F.count("*").alias("n")).collect()}
    assert all(t == int(np.ceil(n / 5)) for t, n in sizes.values())
    folds = splits.stratified_folds(df, "y", "k").groupBy("y", "fold").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in folds if r.y == y]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


# --- sources -----------------------------------------------------------------

def test_shop_documents_edge_cases(spark):
    pages = [
        ('s', 1, '{"products":[{"id":1,"title":"A","variants":[],"options":[{"name":"Colour","values":[]}]},'
                 '{"id":2,"tags":["x","y"],"variants":[{"price":"8","compare_at_price":"10","inventory_quantity":-4}]},'
                 '{"id":3,"variants":[{"price":"oops"}]}]}'),
        ('s', 2, 'not json'),
    ]
    docs = frame(spark, pages, "store string, page int, body string")
    stores = frame(spark, [("http://s/", "s", "USA", "Home")], "url string, name string, pays string, cat string")
    rows = store_json.shop_rows(store_json.attach_store(store_json.shop_items(docs), stores))
    good = {r.product_id: r for r in store_json.accepted(rows).collect()}
    assert set(good) == {"1", "2"}
    assert (good["1"].prix, good["1"].couleur, good["1"].en_stock) == (0.0, "", 0)
    assert (good["2"].remise_pct, good["2"].prix_promo, good["2"].quantite_stock, good["2"].tags) == (20.0, 8.0, 0, "x; y")
    assert sorted(r.product_id for r in store_json.quarantined(rows).collect()) == ["", "3"]


def test_woo_availability(spark):
    body = ('[{"id":1,"price":"5","stock_quantity":2},{"id":2,"regular_price":"","price":"5","sale_price":"4","in_stock":false,'
            '"stock_quantity":9},{"id":3}]')
    docs = frame(spark, [("s", 1, body)], "store string, page int, body string")
    stores = frame(spark, [], "url string, name string, pays string, cat string")
    rows = {r.product_id: r for r in store_json.woo_rows(store_json.attach_store(store_json.woo_items(docs), stores)).collect()}
    assert [rows[k].en_stock for k in "123"] == [1, 0, 0]
    assert (rows["2"].remise_pct, rows["2"].prix_promo, rows["3"].categorie) == (20.0, 4.0, "Autre")


def test_store_without_collections(spark):
    docs = frame(spark, [("s", '{"collections":[{"handle":""}]}', "http://s/"), ("t", "{}", "http://t")],
                 "store string, body string, store_url string")
    got = sorted(r.category_url for r in store_json.shop_categories(docs).collect())
    assert got == ["http://s/products.json", "http://t/products.json"]


def test_missing_file_and_records(spark, tmp_path):
    assert tables.scan_or_empty(spark, str(tmp_path / "none.csv"), "asin string").count() == 0
    row = tables.records_to_frame(spark, [{"nom": "x", "prix": 2.0}]).first()
    assert (row.nom, row.prix, row.rating) == ("x", 2.0, None)


def test_import_defaults_and_limit(spark):
    df = frame(spark, [(1, "9.5", "True"), (2, "bad", "False")], "line_no int, price string, isBestSeller string")
    got = tables.import_external(df, "amazon_2023", ["line_no"]).orderBy("product_id").collect()
    assert [(r.product_id, r.prix, r.top_produit, r.plateforme) for r in got] == [("0", 9.5, 1, "Amazon"), ("1", 0.0, 0, "Amazon")]
    assert tables.import_external(df, "amazon_2023", ["line_no"], limit=1).count() == 1
