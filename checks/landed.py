"""Store documents derived from the catalogue, with planted edge cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .fixtures import products, table

def pid():
    return F.col("product_id")


def stores(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as stores."""
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    names = F.array(*[F.lit(c) for c in ("Beauty", "Fashion", "Sport", "Home", "Food")])
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("https://"), F.lower("s_name"), F.lit(".example/")).alias("url"),
        F.col("s_name").alias("name"), F.col("n_name").alias("pays"),
        F.element_at(names, F.col("n_regionkey") + 1).alias("cat"))


def _pages(items: DataFrame, opening: str, closing: str) -> DataFrame:
    """Pages of at most 250 items: identifiers are split in ranges of 250.

    The fixed partition count keeps the parsing that follows parallel, as a
    scan of landed files would be; the grouping reuses it.
    """
    width = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = items.withColumn("page", F.floor(pid() / 250).cast("int")).repartition(width, "store", "page")
    grouped = placed.groupBy("store", "page").agg(
        F.sort_array(F.collect_list(F.struct("product_id", "item"))).alias("items"))
    body = F.concat(F.lit(opening), F.array_join(F.col("items.item"), ","), F.lit(closing))
    return grouped.select("store", "page", body.alias("body"))


def shop_item_json(spark: SparkSession, sf: str) -> DataFrame:
    df = products(spark, sf)
    price = F.when(pid() % 97 == 0, "abc").otherwise(F.col("prix_promo").cast("string"))
    compare = F.when(pid() % 15 != 0, F.col("prix").cast("string"))
    one = F.struct(price.alias("price"), compare.alias("compare_at_price"),
                   F.col("quantite_stock").alias("inventory_quantity"), (F.col("en_stock") == 1).alias("available"))
    two = F.struct(F.lit("1.5").alias("price"), F.lit(None).cast("string").alias("compare_at_price"),
                   F.lit(3).alias("inventory_quantity"), F.lit(True).alias("available"))
    variants = F.when(pid() % 7 == 0, F.array().cast(
        "array<struct<price:string,compare_at_price:string,inventory_quantity:int,available:boolean>>")) \
        .when(pid() % 10 == 0, F.array(one, two)).otherwise(F.array(one))

    def option(name, value):
        return F.struct(name.alias("name"), F.array(value).alias("values"))

    color = option(F.when(pid() % 12 == 0, "Colour").otherwise("Color"), F.col("couleur"))
    size = option(F.lit("Size"), F.col("taille"))
    options = F.when(pid() % 13 == 0, F.lit(None)).when(
        pid() % 9 == 0, F.array(color, size, option(F.lit("SIZE"), F.lit("dup")))).otherwise(F.array(color, size))
    kind = (F.when(pid() % 16 == 0, "Men's Apparel").when(pid() % 18 == 0, "Gift Set").when(pid() % 20 == 0, "  ")
            .when(pid() % 21 == 0, "Slippers").otherwise(F.col("nom")))
    created = F.when(pid() % 25 != 0, F.concat(F.col("date_mise_en_ligne").cast("string"), F.lit("T08:00:00Z")))
    fields = [F.col("product_id").alias("id"), F.col("nom").alias("title"), kind.alias("product_type"),
              F.concat(F.lit("p-"), pid().cast("string")).alias("handle"),
              F.concat(F.lit("<p>"), "nom", F.lit("</p> <b>"), "couleur", F.lit("</b>")).alias("body_html"),
              created.alias("created_at"), variants.alias("variants"), options.alias("options")]
    listed = F.to_json(F.struct(*fields, F.split("tags", ", ").alias("tags")))
    texted = F.to_json(F.struct(*fields, F.col("tags").alias("tags")))
    return df.select(F.col("marque_vendeur").alias("store"), "product_id",
                     F.when(pid() % 11 == 0, listed).otherwise(texted).alias("item"))


def shop_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _pages(shop_item_json(spark, sf), '{"products":[', "]}")


def woo_pages(spark: SparkSession, sf: str) -> DataFrame:
    df = products(spark, sf)

    def named(*names):
        return F.array(*[F.struct(n.alias("name")) for n in names])

    attributes = F.array(
        F.struct(F.when(pid() % 12 == 0, "Color").otherwise("Couleur").alias("name"), F.array("couleur").alias("options")),
        F.struct(F.lit("Taille").alias("name"), F.array("taille").alias("options")))
    item = F.to_json(F.struct(
        F.col("product_id").alias("id"), F.col("nom").alias("name"),
        F.when(pid() % 8 == 0, "").otherwise(F.col("prix").cast("string")).alias("regular_price"),
        F.col("prix").cast("string").alias("price"),
        F.when(pid() % 3 == 0, "").otherwise(F.col("prix_promo").cast("string")).alias("sale_price"),
        F.when(pid() % 97 == 0, "many").otherwise(F.col("rating").cast("string")).alias("average_rating"),
        F.col("nb_reviews").alias("rating_count"),
        F.when(pid() % 5 != 0, F.col("en_stock") == 1).alias("in_stock"),
        F.col("quantite_stock").alias("stock_quantity"), F.col("url").alias("permalink"),
        F.concat(F.lit("<div>"), "nom", F.lit("</div>")).alias("description"),
        F.when(pid() % 7 == 0, F.array().cast("array<struct<name:string>>")).otherwise(named(F.col("categorie"))).alias("categories"),
        named(F.col("couleur"), F.col("taille"), F.col("plateforme"), F.lit("t4"), F.lit("t5"), F.lit("t6")).alias("tags"),
        attributes.alias("attributes")))
    return _pages(df.select(F.col("marque_vendeur").alias("store"), "product_id", item.alias("item")), "[", "]")


STORES_SQL = """stores AS (SELECT 'https://' || lower(s_name) || '.example/' AS url, s_name AS name, n_name AS pays,
  list_extract(['Beauty', 'Fashion', 'Sport', 'Home', 'Food'], n_regionkey + 1) AS cat
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
