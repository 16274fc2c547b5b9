"""Product catalogue views over the given star-schema tables.

The library works on a ``products`` frame; the given tables have none, so the
frame is derived from lineitem, orders, part, supplier and nation. One
application shares one persisted catalogue per data folder, as a dashboard
process shares its loaded table; persisted blocks lost with an executor are
rebuilt from the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.functions.numeric import half_even

_SHARED: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sale_order():
    """(day, order, line, supplier) as one 31-digit decimal.

    A struct would sort the same way, but its minimum has no hash aggregate and
    would sort all of lineitem by part; a decimal has a fixed-width buffer.
    """
    sale = F.unix_date(F.col("l_shipdate").cast("date")).cast("long") * F.lit(10 ** 13) + F.col("l_orderkey")
    line = F.col("l_linenumber").cast("long") * F.lit(10 ** 11) + F.col("l_suppkey")
    return sale.cast("decimal(20,0)") * F.lit(10 ** 13).cast("decimal(14,0)") + line.cast("decimal(20,0)")


def build_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part that was sold. Two shuffles of lineitem: order key, part key."""
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    sales = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    facts = sales.groupBy("l_partkey").agg(
        F.count("*").alias("n"),
        F.sum(F.when(F.col("l_returnflag") != "R", 1).otherwise(0)).alias("kept"),
        F.min("l_extendedprice").alias("low_price"),
        F.sum(F.rint(F.col("l_discount") * 100).cast("int")).alias("discount_points"),
        F.sum(F.when(F.col("l_shipdate").cast("date") >= F.lit("2001-01-01").cast("date"), F.col("l_quantity"))
              .otherwise(F.lit(0.0))).alias("quantity"),
        F.min(F.datediff("l_shipdate", "o_orderdate")).alias("days"),
        F.min("o_orderdate").alias("listed"),
        F.min(F.when(F.col("l_discount") >= 0.09, F.col("l_shipdate"))).alias("promoted"),
        F.min(_sale_order()).alias("first_sale"),
    )
    facts = facts.withColumn("first_seller", (F.col("first_sale") % F.lit(10 ** 11)).cast("long"))
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    joined = (facts.join(part, F.col("l_partkey") == F.col("p_partkey"))
              .join(supplier, F.col("first_seller") == F.col("s_suppkey"))
              .join(nation, F.col("s_nationkey") == F.col("n_nationkey")))
    price = F.floor("low_price") / 100.0
    discount = F.floor(F.col("discount_points") * 10.0 / F.col("n")) / 10.0
    size = (F.when(F.col("p_size") <= 12, "S").when(F.col("p_size") <= 25, "M")
            .when(F.col("p_size") <= 38, "L").otherwise("XL"))
    return joined.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("nom"),
        F.col("p_type").alias("categorie"),
        F.col("p_brand").alias("sous_categorie"),
        F.col("s_name").alias("marque_vendeur"),
        F.col("n_name").alias("pays_shop"),
        F.when(F.col("n_regionkey").isin(0, 1), "Shopify").otherwise("WooCommerce").alias("plateforme"),
        price.alias("prix"),
        half_even(price * (1.0 - discount / 100.0), 2).alias("prix_promo"),
        discount.alias("remise_pct"),
        (F.floor(F.col("kept") * 50.0 / F.col("n")) / 10.0).alias("rating"),
        F.col("n").cast("int").alias("nb_reviews"),
        (F.col("quantity") > 0).cast("int").alias("en_stock"),
        F.col("quantity").cast("int").alias("quantite_stock"),
        (F.abs("days") % 14 + 1).cast("int").alias("delai_livraison_j"),
        F.split("p_name", " ")[0].alias("couleur"),
        size.alias("taille"),
        F.col("listed").cast("date").alias("date_mise_en_ligne"),
        F.col("promoted").cast("date").alias("date_promotion"),
        F.concat(F.lit("http://"), F.lower("s_name"), F.lit("/"), F.col("p_partkey").cast("string")).alias("url"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")).alias("tags"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SHARED:
        _SHARED[key] = build_products(spark, sf_dir).persist()
    return _SHARED[key]


def products_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as text with deterministic damage, plus ``ingest_seq``."""
    base = products(spark, sf_dir)
    pid = F.col("product_id")

    def every(n: int, column):
        return F.when(pid % n == 0, column)

    clean = base.withColumn("ingest_seq", pid)
    copies = base.where(pid % 10 == 0).withColumns({
        "ingest_seq": pid + 1000000, "prix": F.col("prix") + 1.0})
    rows = clean.unionByName(copies)
    shared = F.concat(F.lit("http://shop/"), (pid - pid % 2).cast("string"))
    return rows.select(
        "product_id", "ingest_seq", "nom",
        F.when(pid % 19 != 0, F.col("categorie")).alias("categorie"),
        "marque_vendeur",
        F.when(pid % 23 != 0, F.col("pays_shop")).alias("pays_shop"),
        "plateforme", "couleur", "taille",
        F.coalesce(every(17, F.lit("n/a")), F.col("prix").cast("string")).alias("prix"),
        F.col("prix_promo").cast("string").alias("prix_promo"),
        "remise_pct",
        F.when(pid % 29 == 0, "7.5").when(pid % 31 == 0, "-1")
        .when(pid % 13 != 0, F.col("rating").cast("string")).alias("rating"),
        F.coalesce(every(37, F.lit("-3")), F.col("nb_reviews").cast("string")).alias("nb_reviews"),
        "en_stock",
        F.col("quantite_stock").cast("string").alias("quantite_stock"),
        F.col("delai_livraison_j").cast("string").alias("delai_livraison_j"),
        F.when(pid % 41 == 0, "").when(pid % 40 < 2, shared).otherwise(F.col("url")).alias("url"),
        "tags",
    )


def baskets(spark: SparkSession, sf_dir: str, item: str = "p_type") -> DataFrame:
    """(order, item) pairs of the sold parts; pruned to three columns."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col(item).alias("item"))
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "item")
