"""Registered queries against their SQL at the smallest scale, and for several partition counts."""

import pytest

from checks import load_all
from checks.compare import canonical, compare, oracle_connection
from checks.registry import ORACLES, QUERIES

load_all()

FAST = ["dedup_product_id", "dedup_url_then_name_shop", "dedup_union_url", "clean_products", "feature_engineering",
        "winsorize_price", "scale_zscore", "topk_score", "topk_by_category", "catalog_stats", "price_boxplot",
        "shop_performance", "market_context", "estimate_ratings", "shop_json_products", "woo_json_products",
        "normalize_category", "import_external", "consolidate", "frequent_itemsets", "association_rules",
        "stratified_split", "stratified_folds", "roc_curve_corners", "auc_exact", "class_report",
        "davies_bouldin", "silhouette_sq", "silhouette_exact", "top_products_json"]


@pytest.fixture(scope="module")
def oracle(sf):
    return oracle_connection(sf)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, sf, oracle, name):
    verdict, detail, *_ = compare(spark, oracle, sf, QUERIES[name], ORACLES[name])
    assert verdict == "ok", detail


@pytest.mark.parametrize("name", ["topk_by_category", "shop_performance", "stratified_split", "winsorize_price"])
def test_same_result_for_any_partitioning(spark, sf, name):
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    for partitions in ("1", "7", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        df = QUERIES[name](spark, sf)
        seen.append(canonical(df.columns, [tuple(r) for r in df.collect()]))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_contract(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
