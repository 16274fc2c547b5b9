"""Schemas of the catalogue and of the landed store documents."""

from __future__ import annotations

from pyspark.sql import types as T

PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("nom", T.StringType()),
    T.StructField("categorie", T.StringType()),
    T.StructField("marque_vendeur", T.StringType()),
    T.StructField("pays_shop", T.StringType()),
    T.StructField("anciennete_shop", T.IntegerType()),
    T.StructField("plateforme", T.StringType()),
    T.StructField("prix", T.DoubleType()),
    T.StructField("prix_promo", T.DoubleType()),
    T.StructField("remise_pct", T.DoubleType()),
    T.StructField("devise", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("nb_reviews", T.IntegerType()),
    T.StructField("en_stock", T.IntegerType()),
    T.StructField("quantite_stock", T.IntegerType()),
    T.StructField("delai_livraison_j", T.IntegerType()),
    T.StructField("couleur", T.StringType()),
    T.StructField("taille", T.StringType()),
    T.StructField("date_mise_en_ligne", T.DateType()),
    T.StructField("date_promotion", T.DateType()),
    T.StructField("top_produit", T.IntegerType()),
    T.StructField("score_attractivite", T.DoubleType()),
])

# Scalars of store documents are read as text: a number where text is expected
# (or the reverse) then damages one field, not the record.
SHOP_ITEM = """struct<id:string,title:string,product_type:string,handle:string,body_html:string,
created_at:string,tags:string,
variants:array<struct<price:string,compare_at_price:string,inventory_quantity:string,available:string>>,
options:array<struct<name:string,`values`:array<string>>>>"""
SHOP_PAGE = f"struct<products:array<{SHOP_ITEM}>>"
SHOP_DOCUMENT = f"struct<product:{SHOP_ITEM}>"
SHOP_COLLECTIONS = "struct<collections:array<struct<handle:string>>>"

WOO_ITEM = """struct<id:string,name:string,regular_price:string,price:string,sale_price:string,
average_rating:string,rating_count:string,in_stock:string,stock_quantity:string,permalink:string,
description:string,categories:array<struct<name:string>>,tags:array<struct<name:string>>,
attributes:array<struct<name:string,options:array<string>>>>"""
WOO_PAGE = f"array<{WOO_ITEM}>"
WOO_CATEGORIES = "array<struct<id:string,count:long>>"

# External export columns and their catalogue names.
EXTERNAL_COLUMNS = {
    "amazon_2023": {
        "asin": "product_id",
        "title": "nom",
        "categoryName": "categorie",
        "boughtInLastMonth": "nb_reviews",
        "stars": "rating",
        "price": "prix",
        "isBestSeller": "top_produit",
    },
    "clothing_reviews": {
        "Clothing ID": "product_id",
        "Division Name": "categorie",
        "Class Name": "sous_categorie",
        "Rating": "rating",
        "Recommended IND": "top_produit",
    },
}

# Defaults of columns an external export lacks, in output order.
EXTERNAL_DEFAULTS = {
    "product_id": None,
    "nom": "Produit Inconnu",
    "categorie": "Autre",
    "marque_vendeur": "Kaggle Store",
    "pays_shop": "USA",
    "anciennete_shop": 5,
    "plateforme": None,
    "prix": 0.0,
    "prix_promo": 0.0,
    "remise_pct": 0.0,
    "devise": "USD",
    "rating": 0.0,
    "nb_reviews": 0,
    "en_stock": 1,
    "quantite_stock": 50,
    "delai_livraison_j": 5,
    "couleur": "",
    "taille": "",
    "url": "",
    "description": "",
    "tags": "",
    "top_produit": 0,
    "score_attractivite": 0.0,
}

# Product-type words per category; the order decides the first match.
CATEGORY_WORDS = {
    "Beauty": [
        "makeup", "cosmetic", "cosmetics", "skincare", "skin care", "skin-care", "lipstick", "lip", "lips",
        "foundation", "eyeshadow", "eye shadow", "blush", "concealer", "highlighter", "palette", "gloss", "liner",
        "mascara", "perfume", "fragrance", "nail", "nail polish", "serum", "moisturizer", "toner", "cleanser",
        "face mask", "face", "body care", "bath and body", "bath & body", "advent calendar", "gift set", "sample",
        "brush", "setting spray", "primer", "bronzer", "contour", "powder",
    ],
    "Fashion": [
        "apparel", "clothing", "clothes", "shirt", "t-shirt", "tee", "hoodie", "sweatshirt", "sweater", "jacket",
        "coat", "vest", "pants", "jeans", "trousers", "dress", "skirt", "top", "blouse", "romper", "jumpsuit",
        "shoes", "shoe", "flat", "sneaker", "sneakers", "boot", "boots", "sandal", "sandals", "loafer", "heel",
        "heels", "accessory", "accessories", "bracelet", "bracelets", "anklet", "anklets", "necklace", "ring",
        "earring", "earrings", "jewelry", "jewellery", "bag", "handbag", "hat", "cap", "beanie", "scarf", "belt",
        "wallet", "socks", "sock", "underwear", "womens", "mens", "kids", "bandana", "poncho", "cardigan",
    ],
    "Sport": [
        "sport", "sports", "yoga", "fitness", "outdoor", "outdoors", "hiking", "running", "training", "leggings",
        "athletic", "activewear", "sportswear", "cycling", "swim", "swimwear", "wetsuit", "pack", "backpack",
        "gear", "equipment", "water bottle", "hydration",
    ],
    "Home": [
        "home", "bedding", "sheet", "sheets", "pillow", "pillowcase", "towel", "duvet", "blanket", "comforter",
        "quilt", "mattress", "decor", "furniture", "rug", "candle", "kitchen", "bath", "shower",
    ],
    "Food": [
        "food", "coffee", "tea", "drink", "beverage", "supplement", "nutrition", "candy", "snack", "chocolate",
    ],
    "Electronics": [
        "electronics", "tech", "gadget", "device", "headphone", "speaker", "charger", "cable",
    ],
}

# Product types that say nothing about the category.
GENERIC_TYPES = [
    "bundle", "bundles", "gift set", "gift sets", "gift", "gifts", "sample", "samples", "set", "sets", "kit", "kits",
    "collection", "other", "misc", "miscellaneous", "product", "products", "item", "new", "sale", "clearance",
    "limited edition", "collaboration",
]
