"""Damaged documents, out-of-range numbers, blank urls, text ids and the shared folder."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from vitrine import session
from vitrine.functions.numeric import steady_mean, truncate_int
from vitrine.operators import classify, clean, splits
from vitrine.sources import store_json, tables

STORES = [("https://a.example", "s", "FR", "Home")]


def shop_rows(spark, bodies):
    pages = spark.createDataFrame([("s", i, b) for i, b in enumerate(bodies)], "store string, page int, body string")
    items = store_json.shop_items(pages)
    stores = spark.createDataFrame(STORES, "url string, name string, pays string, cat string")
    return items, store_json.shop_rows(store_json.attach_store(items, stores))


def test_every_landed_item_is_accepted_or_quarantined(spark):
    good = '{"id": 1, "title": "t", "variants": [{"price": "2", "inventory_quantity": 1}]}'
    bodies = ['{"products": [' + good + "]}", '{"products": [' + good + "," + good[:12], None, '{"products": []}', "not json",
              '{"products": [null, {"id": 2, "variants": "x"}, {"id": 3, "variants": [{"price": "abc"}]}, '
              '{"id": 4, "variants": [{"price": "1", "inventory_quantity": 1e30}]}, ' + good + "]}"]
    items, rows = shop_rows(spark, bodies)
    assert items.count() == rows.count() == 9
    assert sorted(r.product_id for r in store_json.accepted(rows).collect()) == ["1", "1"]
    assert store_json.quarantined(rows).count() == 7
    reasons = {(r.page, r.pos): r.reason for r in store_json.faulty(items).collect()}
    assert reasons == {(1, 0): "unparsable document", (2, 0): "no document", (4, 0): "unparsable document",
                       (5, 0): "null item", (5, 1): "malformed item"}


def test_woo_counts_out_of_range_are_quarantined(spark):
    body = '[{"id": 1, "price": "2", "stock_quantity": "99999999999"}, {"id": 2, "price": "2", "rating_count": 7}, null]'
    pages = spark.createDataFrame([("s", 0, body), ("s", 1, body[:20])], "store string, page int, body string")
    stores = spark.createDataFrame(STORES, "url string, name string, pays string, cat string")
    rows = store_json.woo_rows(store_json.attach_store(store_json.woo_items(pages), stores))
    assert [(r.product_id, r.nb_reviews) for r in store_json.accepted(rows).collect()] == [("2", 7)]
    assert store_json.quarantined(rows).count() == 3


def test_large_numbers_do_not_end_a_job(spark):
    df = spark.createDataFrame([(1e30,), (None,), (3.9,)], "x double")
    assert [r.y for r in df.select(truncate_int(F.col("x")).alias("y")).collect()] == [0, 0, 3]
    raw = spark.createDataFrame([("a", "99999999999", "99999999999")], "product_id string, nb_reviews string, en_stock string")
    got = tables.import_external(raw, "amazon_2023", ["product_id"]).first()
    assert got.nb_reviews == 0 and got.en_stock is None


@pytest.mark.parametrize("dedup", [clean.dedup_by_url, clean.dedup_url_then_name_shop])
def test_rows_without_a_url_are_kept_whatever_the_order(spark, dedup):
    rows = [(f"n{i}", "s", url, seq) for i, (url, seq) in enumerate(
        [("", 1), ("", 1), (None, None), ("", None), ("u", 2), ("u", 1)])]
    df = spark.createDataFrame(rows, "nom string, marque_vendeur string, url string, seq int")
    assert sorted(r.nom for r in dedup(df, ["seq"]).collect()) == ["n0", "n1", "n2", "n3", "n5"]
    assert dedup(df, ["seq"], strict=True).count() < 5


def test_means_keep_small_and_large_values(spark):
    def mean(*values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return df.agg(steady_mean(F.col("x")).alias("m")).first().m

    assert mean(4e-7, 2e-7) == pytest.approx(3e-7) and mean(1e12, 3e12) == 2e12 and mean(1e300, 1e300) == 1e300
    assert mean(1.0, None, 2.5) == 1.75 and mean(None) is None


def test_text_ids_are_split_and_trained_on(spark):
    rows = [(f"p{i:03d}", i % 2, float(i % 2) * 3 + (i % 7) / 10) for i in range(120)]
    df = spark.createDataFrame(rows, "product_id string, y int, x double")
    split = splits.stratified_split(df, "y", "product_id").groupBy("y", "is_test").count().collect()
    assert {(r.y, r.is_test): r["count"] for r in split} == {(0, 1): 12, (0, 0): 48, (1, 1): 12, (1, 0): 48}
    folds = splits.stratified_folds(df, "y", "product_id").groupBy("y", "fold").count().collect()
    assert {r["count"] for r in folds} == {12}


def test_models_train_on_ingested_rows(spark, sf):
    from checks.q_models import training_frame

    frame = training_frame(spark, sf).withColumn("product_id", F.concat(F.lit("p-"), F.col("product_id").cast("string")))
    trained, row, names = classify.train_random_forest(frame, trees=5, depth=5)
    got = trained.predictions.agg(F.min("prob"), F.max("prob"), F.count("*")).first()
    assert 0 <= got[0] <= got[1] <= 1 and got[2] > 20 and row.first().auc > 0.6
    weights = classify.feature_importance(spark, trained, names)
    assert weights.agg(F.sum("importance")).first()[0] == pytest.approx(1) and weights.count() == len(names)


def test_a_cluster_must_name_its_shared_folder():
    def fake(master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("spark://host:7077"))
    session.shared_dir(fake("local[4]"))
