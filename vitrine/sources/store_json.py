"""Landed store documents to catalogue rows.

Input frames carry one document per row: ``store`` (key), ``page`` and
``body`` (JSON text). A page is bounded by the store interface (250 or 100
items), so exploding it is safe. ``attach_store`` adds ``name``, ``pays``,
``cat`` and ``url`` of the store.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions.category import normalize_category
from ..functions.numeric import half_even, parse_number
from ..functions.pricing import effective_discount, promo_price
from ..functions.text import date_prefix, join_tags, store_url, strip_html, tag_list


def attach_store(df: DataFrame, stores: DataFrame, key: str = "store", store_key: str = "name") -> DataFrame:
    """Add the metadata of each record's store (left equi-join, planner's choice)."""
    meta = stores.select(F.col(store_key).alias("key__"), F.col("url").alias("store_url"),
                         F.col("name").alias("store_name"), F.col("pays").alias("store_pays"),
                         F.col("cat").alias("store_cat"))
    return df.join(meta, F.col(key) == F.col("key__"), "left").drop("key__")


def _blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def _amount(text: Column) -> Column:
    """Money or count text; blank is missing, anything else must be a number."""
    return F.when(~_blank(text), parse_number(text))


def first_option(options: Column, values: str, *names: str) -> Column:
    """First value of the first option name present; the last duplicate counts."""
    def last(name: str) -> Column:
        hits = F.filter(options, lambda option: F.lower(option["name"]) == name)
        return F.try_element_at(hits, F.lit(-1))[values]

    return F.coalesce(F.get(F.coalesce(*[last(n) for n in names]), F.lit(0)), F.lit(""))


def variant_stock(variants: Column) -> Column:
    """Units over all variants, not below 0; NULL where they are beyond any count."""
    def units(variant: Column) -> Column:
        value = F.coalesce(parse_number(variant["inventory_quantity"]), F.lit(0.0))
        return F.when(F.abs(value) < 2.0 ** 31, value).cast("long")

    listed = F.coalesce(F.transform(variants, units), F.array().cast("array<bigint>"))
    total = F.aggregate(listed, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.when(total.isNotNull(), F.greatest(total, F.lit(0).cast("long"))).try_cast("int")


def _count(text: Column) -> Column:
    """Count text as int, 0 where blank, NULL where malformed or out of range."""
    return F.when(_blank(text), 0).otherwise(_amount(text).try_cast("int"))


def variant_available(variants: Column) -> Column:
    """1 if any variant is available; missing counts as not available."""
    flag = F.exists(variants, lambda v: F.coalesce(F.lower(v["available"]) == "true", F.lit(False)))
    return F.coalesce(flag, F.lit(False)).cast("int")


def _parsed_once(text: Column) -> Column:
    """One row for each row; filters are not moved below an explode, so they don't parse the text again for each use."""
    return F.explode(F.array(text))


def explode_pages(pages: DataFrame, schema: str, items: str | None) -> DataFrame:
    """One row per item with its position, its text (``raw``) and what is wrong with it (``fault``, else NULL).

    ``schema`` is that of an item. A list of items without a name (``items`` None) is a bare array. A document that does
    not parse gives one row without an item, so that nothing landed gets lost: items of faultless rows, items with a fault
    and whole documents with a fault add up to what has landed. Empty lists give no row.
    """
    name = items or "items"
    body = F.col("body") if items else F.concat(F.lit('{"items":'), F.col("body"), F.lit("}"))
    outer = F.from_json(body, f"struct<{name}:array<string>,damaged__:string>", {"columnNameOfCorruptRecord": "damaged__"})
    rest = [c for c in pages.columns if c != "body"]
    opened = pages.select(*rest, "body", _parsed_once(outer).alias("outer"))
    broken = F.col("body").isNull() | F.col("outer.damaged__").isNotNull()
    whole = opened.where(broken).select(
        *rest, F.lit(0).alias("pos"), F.col("body").alias("raw"),
        F.when(F.col("body").isNull(), "no document").otherwise("unparsable document").alias("fault"))
    single = opened.where(~broken).select(*rest, F.posexplode(f"outer.{name}").alias("pos", "raw")).withColumn(
        "fault", F.when(F.col("raw").isNull(), "null item"))
    return _with_item(whole.unionByName(single), schema)


def _with_item(rows: DataFrame, schema: str) -> DataFrame:
    """Parse ``raw`` to ``item``; fields of another type than the schema's are a fault."""
    inner = f"{schema.strip()[:-1]},damaged__:string>"
    item = F.when(F.col("fault").isNull(), F.from_json("raw", inner, {"columnNameOfCorruptRecord": "damaged__"}))
    parsed = rows.select("*", _parsed_once(item).alias("item"))
    return parsed.withColumn("fault", F.coalesce("fault", F.when(F.col("item.damaged__").isNotNull(), "malformed item")))


def shop_items(pages: DataFrame) -> DataFrame:
    return explode_pages(pages, schemas.SHOP_ITEM, "products")


def shop_documents(docs: DataFrame) -> DataFrame:
    """Single-product documents; an empty envelope gives no row, one that does not parse a row with a fault."""
    outer = F.from_json("body", "struct<product:string,damaged__:string>", {"columnNameOfCorruptRecord": "damaged__"})
    broken = F.col("body").isNull() | F.col("outer.damaged__").isNotNull()
    rows = docs.select("*", _parsed_once(outer).alias("outer")).select(
        *[c for c in docs.columns if c != "body"], F.lit(0).alias("pos"),
        F.when(broken, F.col("body")).otherwise(F.col("outer.product")).alias("raw"),
        F.when(F.col("body").isNull(), "no document").when(broken, "unparsable document").alias("fault"))
    return _with_item(rows.where(F.col("raw").isNotNull() | F.col("fault").isNotNull()), schemas.SHOP_ITEM)


def woo_items(pages: DataFrame) -> DataFrame:
    return explode_pages(pages, schemas.WOO_ITEM, None)


def faulty(items: DataFrame) -> DataFrame:
    """Documents and items that can't be read, with the reason and the text that landed."""
    return items.where(F.col("fault").isNotNull()).select("store", "page", "pos", F.col("fault").alias("reason"), F.col("raw").alias("body"))


def shop_rows(items: DataFrame, double_discount: bool = False, tag_limit: int | None = None) -> DataFrame:
    """Items of the first store kind as catalogue rows, plus ``is_valid``.

    The promo price is the sale price; ``double_discount`` applies the percent
    to it once more, as the bulk collector does, which also keeps five tags
    (``tag_limit=5``). All tags are kept by default.
    """
    item = F.col("item")
    first = F.get(item["variants"], F.lit(0))
    # Parsed once here; the projection below only combines the results.
    items = items.withColumns({
        "price_text": first["price"], "compare_text": first["compare_at_price"],
        "price_value": _amount(first["price"]), "compare_value": _amount(first["compare_at_price"]),
        "stock_value": variant_stock(item["variants"])})
    price = F.coalesce(F.col("price_value"), F.lit(0.0))
    items = items.withColumn("percent", effective_discount(F.coalesce(F.col("compare_value"), price), price))
    percent = F.col("percent")
    promo = F.when(percent == 0, price).otherwise(promo_price(price, percent)) if double_discount else price
    valid = (_blank(F.col("price_text")) | F.col("price_value").isNotNull()) \
        & (_blank(F.col("compare_text")) | F.col("compare_value").isNotNull()) \
        & F.col("stock_value").isNotNull() & F.col("fault").isNull()
    return items.select(
        "store", "page", "pos",
        F.coalesce(item["id"], F.lit("")).alias("product_id"),
        F.coalesce(item["title"], F.lit("")).alias("nom"),
        normalize_category(item["product_type"], F.col("store_cat")).alias("categorie"),
        F.col("store_name").alias("marque_vendeur"),
        F.col("store_pays").alias("pays_shop"),
        F.lit(5).alias("anciennete_shop"),
        F.lit("Shopify").alias("plateforme"),
        price.alias("prix"), promo.alias("prix_promo"), percent.alias("remise_pct"),
        F.lit("USD").alias("devise"),
        F.lit(0.0).alias("rating"), F.lit(0).alias("nb_reviews"),
        variant_available(item["variants"]).alias("en_stock"),
        F.coalesce("stock_value", F.lit(0)).alias("quantite_stock"),
        F.lit(5).alias("delai_livraison_j"),
        first_option(item["options"], "values", "color", "colour").alias("couleur"),
        first_option(item["options"], "values", "size").alias("taille"),
        date_prefix(item["created_at"]).alias("date_mise_en_ligne"),
        F.lit(None).cast("date").alias("date_promotion"),
        store_url(F.col("store_url"), F.lit("/products/"), F.coalesce(item["handle"], F.lit(""))).alias("url"),
        strip_html(item["body_html"]).alias("description"),
        join_tags(tag_list(item["tags"]), tag_limit).alias("tags"),
        F.lit(0).alias("top_produit"), F.lit(0.0).alias("score_attractivite"),
        valid.alias("is_valid"),
    )


def woo_rows(items: DataFrame, tag_limit: int | None = None) -> DataFrame:
    """Items of the second store kind as catalogue rows, plus ``is_valid``; ``tag_limit`` as in ``shop_rows``."""
    item = F.col("item")
    list_text = F.when(~_blank(item["regular_price"]), item["regular_price"]).otherwise(item["price"])
    price = F.coalesce(_amount(list_text), F.lit(0.0))
    sale = F.coalesce(_amount(item["sale_price"]), price)
    stock = F.coalesce(_count(item["stock_quantity"]), F.lit(0))
    available = F.coalesce(F.lower(item["in_stock"]) == "true", stock > 0)
    texts = [list_text, item["sale_price"], item["average_rating"]]
    valid = F.col("fault").isNull() & _count(item["rating_count"]).isNotNull() & _count(item["stock_quantity"]).isNotNull()
    for text in texts:
        valid = valid & (_blank(text) | _amount(text).isNotNull())
    return items.select(
        "store", "page", "pos",
        F.coalesce(item["id"], F.lit("")).alias("product_id"),
        F.coalesce(item["name"], F.lit("")).alias("nom"),
        F.coalesce(F.get(item["categories"], F.lit(0))["name"], F.lit("Autre")).alias("categorie"),
        F.col("store_name").alias("marque_vendeur"),
        F.col("store_pays").alias("pays_shop"),
        F.lit(5).alias("anciennete_shop"),
        F.lit("WooCommerce").alias("plateforme"),
        price.alias("prix"), sale.alias("prix_promo"), effective_discount(price, sale).alias("remise_pct"),
        F.lit("EUR").alias("devise"),
        F.coalesce(_amount(item["average_rating"]), F.lit(0.0)).alias("rating"),
        F.coalesce(_count(item["rating_count"]), F.lit(0)).alias("nb_reviews"),
        available.cast("int").alias("en_stock"), stock.alias("quantite_stock"),
        F.lit(5).alias("delai_livraison_j"),
        first_option(item["attributes"], "options", "color", "couleur").alias("couleur"),
        first_option(item["attributes"], "options", "size", "taille").alias("taille"),
        F.coalesce(item["permalink"], F.lit("")).alias("url"),
        strip_html(item["description"]).alias("description"),
        join_tags(F.coalesce(item["tags"]["name"], F.array().cast("array<string>")), tag_limit).alias("tags"),
        F.lit(0).alias("top_produit"), F.lit(0.0).alias("score_attractivite"),
        valid.alias("is_valid"),
    )


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where("is_valid").drop("is_valid")


def quarantined(rows: DataFrame) -> DataFrame:
    """Malformed records; they stop neither their page nor their store."""
    return rows.where(~F.col("is_valid")).drop("is_valid")


def _opened_listing(docs: DataFrame, items: str | None, schema: str) -> DataFrame:
    """Category documents with ``listed`` (the parsed list) and ``fault``, NULL where the document can be read.

    An element of another type than the schema's makes its whole document faulty, as a list with a hole must not pass for
    a complete one.
    """
    name = items or "items"
    body = F.col("body") if items else F.concat(F.lit('{"items":'), F.col("body"), F.lit("}"))
    parsed = F.from_json(body, f"struct<{name}:{schema},damaged__:string>", {"columnNameOfCorruptRecord": "damaged__"})
    fault = F.when(F.col("body").isNull(), "no document").when(F.col("parsed__.damaged__").isNotNull(), "unparsable document")
    return docs.withColumn("parsed__", parsed).withColumns({"fault": fault, "listed": F.col(f"parsed__.{name}")}).drop("parsed__")


def _shop_listing(docs: DataFrame) -> DataFrame:
    return _opened_listing(docs, "collections", "array<struct<handle:string>>")


def _woo_listing(docs: DataFrame) -> DataFrame:
    return _opened_listing(docs, None, schemas.WOO_CATEGORIES)


def shop_categories(docs: DataFrame) -> DataFrame:
    """Collection addresses of each store; a store whose list is empty gets its full listing.

    A document that can't be read gives no address, least of all the full listing: see ``shop_category_faults``.
    """
    base = F.regexp_replace("store_url", "/+$", "")
    handles = F.filter(F.col("listed.handle"), lambda h: F.coalesce(h, F.lit("")) != "")
    rows = _shop_listing(docs).where(F.col("fault").isNull()).select(
        "store", base.alias("base"), F.explode_outer(handles).alias("handle"))
    path = F.when(F.col("handle").isNull(), F.lit("/products.json")).otherwise(
        F.concat(F.lit("/collections/"), F.col("handle"), F.lit("/products.json")))
    return rows.select("store", F.concat("base", path).alias("category_url"))


def woo_categories(docs: DataFrame) -> DataFrame:
    """Identifiers of the non-empty categories of each store; documents with a fault: see ``woo_category_faults``."""
    rows = _woo_listing(docs).where(F.col("fault").isNull()).select("store", F.explode("listed").alias("cat"))
    return rows.where(F.coalesce(F.col("cat.count"), F.lit(0)) > 0).select("store", F.col("cat.id").alias("category_id"))


def shop_category_faults(docs: DataFrame) -> DataFrame:
    """Category documents of the first store kind that can't be read, with the reason and the text that landed."""
    return _shop_listing(docs).where(F.col("fault").isNotNull()).select("store", F.col("fault").alias("reason"), "body")


def woo_category_faults(docs: DataFrame) -> DataFrame:
    """The same for the second store kind."""
    return _woo_listing(docs).where(F.col("fault").isNotNull()).select("store", F.col("fault").alias("reason"), "body")
