"""Saved artefacts on raw rows, failing sources, long choices and sparse baskets."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.fixtures import products, products_dirty
from vitrine.operators import reports, rules, scoring
from vitrine.operators.preparation import CataloguePreparation
from vitrine.plans import flows
from vitrine.session import scratch_path
from vitrine.sources import store_json

FRESH = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.ml.functions import vector_to_array
from vitrine.operators.classify import load_model
from vitrine.session import build_session
spark = build_session("local[2]", 2, "fresh")
scored = load_model(sys.argv[2]).transform(spark.read.parquet(sys.argv[3]))
scored.select("ingest_seq", "prediction", vector_to_array("probability")[1].alias("prob")).write.parquet(sys.argv[4])
"""


def test_artefact_scores_raw_rows_in_a_fresh_process(spark, sf):
    label = scoring.fixed_label(products(spark, sf)).select("product_id", "top_produit")
    raw = products_dirty(spark, sf)
    path, rows, out = (scratch_path(spark, n) for n in ("artefact", "raw", "scored"))
    run = flows.staged(raw.join(label, "product_id"), ["ingest_seq"], rounds=4, model_path=path)
    raw.write.parquet(rows)
    subprocess.run([sys.executable, "-c", FRESH, str(Path(__file__).resolve().parent.parent), path, rows, out],
                   check=True, timeout=180)
    here = run["artefact"].transform(raw).select("ingest_seq", "prediction", vector_to_array("probability")[1].alias("prob"))
    there = spark.read.parquet(out)
    assert there.count() == raw.count()
    assert sorted(map(tuple, here.collect())) == sorted(map(tuple, there.collect()))


def test_preparation_of_unseen_missing_and_absent(spark):
    train = spark.createDataFrame([(1, "a", "x", "1"), (2, "b", "x", "3"), (3, None, "x", "n/a")],
                                  "product_id int, categorie string, plateforme string, prix string")
    model = CataloguePreparation().fit(train)
    rows = spark.createDataFrame([(7, "b", "9"), (8, "new", "bad"), (9, None, None), (9, None, None)],
                                 "product_id int, categorie string, prix string")
    got = [(r.product_id, r.prix, r.categorie_enc, r.plateforme_enc) for r in model.transform(rows).orderBy("product_id").collect()]
    assert got == [(7, 9.0, 1, -1), (8, 2.0, -1, -1), (9, 2.0, 2, -1), (9, 2.0, 2, -1)]
    assert model.transform(rows.where("product_id < 0")).collect() == []


def source(spark, ids):
    rows = [(str(i), f"n{i}", "s", float(i), 4.0, 1, f"u{i}") for i in ids]
    return spark.createDataFrame(rows, "product_id string, nom string, marque_vendeur string, prix double, rating double, nb_reviews int, url string")


def test_a_failing_source_costs_only_itself(spark, tmp_path):
    (tmp_path / "broken.parquet").write_bytes(b"PAR1 no table PAR1")

    def late(frame):
        return frame.withColumn("prix", F.raise_error(F.lit("damaged")).cast("double"))

    openers = {"a": lambda: source(spark, [1, 2]), "path": lambda: spark.read.parquet(str(tmp_path / "none")),
               "file": lambda: spark.read.schema("product_id string").parquet(str(tmp_path / "broken.parquet")),
               "task": lambda: late(source(spark, [9])), "b": lambda: source(spark, [2, 3])}
    result, report = flows.consolidate_sources(spark, openers, ["product_id"])
    assert sorted((r.product_id, r.source_no) for r in result.collect()) == [("1", 0), ("2", 0), ("3", 4)]
    seen = {r.name: (r.status, r.n_rows, r.fault is None) for r in report.collect()}
    assert seen == {"a": ("read", 2, True), "b": ("read", 2, True), **{n: ("failed", None, False) for n in ("path", "file", "task")}}
    nothing, report = flows.consolidate_sources(spark, {"path": openers["path"]}, ["seq"])
    assert nothing.collect() == [] and report.count() == 1


def test_long_choices_are_semi_joined(spark):
    df = spark.createDataFrame([(i, f"s{i % 50000}") for i in range(300)] + [(300, None)], "id int, marque_vendeur string")
    chosen = [f"s{i}" for i in range(0, 20000, 2)]
    kept = reports.ProductFilter(shops=[*chosen, "s0"]).apply(df)
    assert sorted(r.id for r in kept.collect()) == list(range(0, 300, 2))
    assert "LeftSemi" in kept._jdf.queryExecution().optimizedPlan().toString()
    none = spark.createDataFrame([], "shop string")
    assert reports.ProductFilter(shops=none).apply(df).count() == 0
    assert reports.ProductFilter(shops=[]).apply(df).count() == 301
    short = reports.ProductFilter(shops=["s1"]).apply(df)
    assert "Join" not in short._jdf.queryExecution().optimizedPlan().toString() and short.count() == 1


def test_sparse_baskets(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None), (3, "c"), (3, None)], "g int, item string")
    vectors, vocabulary = rules.basket_vectors(df, "g", "item")
    assert sorted(map(tuple, vocabulary.collect())) == [("a", 0), ("b", 1), ("c", 2)]
    got = {r.g: r["items"] for r in vectors.collect()}
    assert {g: (v.size, v.indices.tolist(), v.values.tolist()) for g, v in got.items()} == \
        {1: (3, [0, 1], [1.0, 1.0]), 2: (3, [], []), 3: (3, [2], [1.0])}
    with pytest.raises(Exception):
        rules.basket_vectors(df, "g", "nothing")


def test_a_filter_does_not_parse_documents_again(spark):
    """The filter on accepted rows held 15 and 49 calls of the parser, one for each use of a field."""
    stores = spark.createDataFrame([("https://a.example/", "A", "FR", "Food")], "url string, name string, pays string, cat string")
    shop = '{"products":[{"id":1,"title":"x","variants":[{"price":"2.5","inventory_quantity":3,"available":true}]},null,{"id":2,"variants":[{"price":"?"}]}]}'
    woo = '[{"id":7,"name":"y","price":"4","rating_count":2,"stock_quantity":1},{"id":8,"price":"many"}]'

    def pages(*bodies):
        return spark.createDataFrame([("A", i, body) for i, body in enumerate(bodies)], "store string, page int, body string")

    for items, rows, bodies, kept, left in (
            (store_json.shop_items, store_json.shop_rows, (shop, None, "{broken"), ["1"], 4),
            (store_json.woo_items, store_json.woo_rows, (woo, "[]"), ["7"], 1)):
        ready = rows(store_json.attach_store(items(pages(*bodies)), stores))
        good = store_json.accepted(ready)
        plan = good._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") <= 4 and not any("from_json" in line for line in plan.splitlines() if "Filter" in line)
        assert [r["product_id"] for r in good.collect()] == kept and store_json.quarantined(ready).count() == left
