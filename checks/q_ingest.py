"""Ingestion: landed documents, lookups, external exports, unions and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine import schemas
from vitrine.functions import text
from vitrine.functions.category import normalize_category
from vitrine.operators import clean
from vitrine.plans import flows
from vitrine.session import scratch_path
from vitrine.sources import store_json, tables

from . import landed
from .fixtures import products, table
from .landed import STORES_SQL, pid
from .oracle_views import PRODUCTS, np_round
from .q_scores import collector_cte
from .registry import ORACLES, query

_PRIO = [(w, c) for c, words in schemas.CATEGORY_WORDS.items() for w in words]
WORDS_SQL = "words(word, cat, prio) AS (VALUES " + ", ".join(
    f"('{w}', '{c}', {i})" for i, (w, c) in enumerate(_PRIO)) + ")"
GENERIC_SQL = ", ".join(f"'{g}'" for g in schemas.GENERIC_TYPES)


def category_cte(source, kind, fallback):
    """CTE ``mapped(product_id, category)``: exact word, else first contained word by priority."""
    return f"""{WORDS_SQL}, kinds AS (SELECT DISTINCT lower(trim({kind})) AS low FROM {source}),
hits AS (SELECT low, arg_min(w.cat, CASE WHEN w.word = low THEN -1 ELSE w.prio END) AS hit FROM kinds
  JOIN words w ON contains(low, w.word) WHERE low NOT IN ({GENERIC_SQL}) GROUP BY low),
mapped AS (SELECT s.product_id, coalesce(h.hit, s.{fallback}) AS category FROM {source} s
  LEFT JOIN hits h ON h.low = lower(trim(s.{kind})))"""


BASE = f"""{PRODUCTS}, {STORES_SQL}, typed AS (SELECT p.*, st.url AS store_url, st.cat AS store_cat,
  CASE WHEN product_id % 16 = 0 THEN 'Men''s Apparel' WHEN product_id % 18 = 0 THEN 'Gift Set' WHEN product_id % 20 = 0 THEN '  '
  WHEN product_id % 21 = 0 THEN 'Slippers' ELSE nom END AS kind
  FROM products p JOIN stores st ON st.name = p.marque_vendeur), {category_cte('typed', 'kind', 'store_cat')}"""

PRICE = "CASE WHEN product_id % 7 = 0 THEN 0e0 ELSE prix_promo END"
PERCENT = (f"CASE WHEN product_id % 7 <> 0 AND product_id % 15 <> 0 AND prix > prix_promo "
           f"THEN {np_round('(prix - prix_promo) / prix * 1e2', 1)} ELSE 0e0 END")
SHOP_SQL = f"""shop_rows AS (SELECT CAST(t.product_id AS VARCHAR) AS product_id, nom, m.category AS categorie, marque_vendeur, pays_shop,
  5 AS anciennete_shop, 'Shopify' AS plateforme, {PRICE.replace('product_id', 't.product_id')} AS prix,
  {PRICE.replace('product_id', 't.product_id')} AS prix_promo, {PERCENT.replace('product_id', 't.product_id')} AS remise_pct,
  'USD' AS devise, 0e0 AS rating, 0 AS nb_reviews,
  CASE WHEN t.product_id % 7 = 0 THEN 0 WHEN t.product_id % 10 = 0 THEN 1 ELSE en_stock END AS en_stock,
  CASE WHEN t.product_id % 7 = 0 THEN 0 WHEN t.product_id % 10 = 0 THEN quantite_stock + 3 ELSE quantite_stock END AS quantite_stock,
  5 AS delai_livraison_j, CASE WHEN t.product_id % 13 = 0 THEN '' ELSE couleur END AS couleur,
  CASE WHEN t.product_id % 13 = 0 THEN '' WHEN t.product_id % 9 = 0 THEN 'dup' ELSE taille END AS taille,
  CASE WHEN t.product_id % 25 <> 0 THEN date_mise_en_ligne END AS date_mise_en_ligne, CAST(NULL AS DATE) AS date_promotion,
  rtrim(store_url, '/') || '/products/p-' || t.product_id AS url, nom || '   ' || couleur AS description,
  replace(tags, ', ', '; ') AS tags, 0 AS top_produit, 0e0 AS score_attractivite, t.product_id AS pid
  FROM typed t JOIN mapped m ON m.product_id = t.product_id)"""
SHOP_COLS = [c for c in schemas.EXTERNAL_DEFAULTS] + ["date_mise_en_ligne", "date_promotion"]
GOOD = "WHERE NOT (pid % 97 = 0 AND pid % 7 <> 0)"


def shop(spark, sf):
    items = store_json.attach_store(store_json.shop_items(landed.shop_pages(spark, sf)), landed.stores(spark, sf))
    return store_json.shop_rows(items)


@query("shop_json_products", f"WITH {BASE}, {SHOP_SQL} SELECT {', '.join(SHOP_COLS)} FROM shop_rows {GOOD}")
def shop_json_products(spark, sf):
    return store_json.accepted(shop(spark, sf)).select(*SHOP_COLS)


@query("shop_json_quarantine", f"WITH {BASE}, {SHOP_SQL} SELECT product_id, nom FROM shop_rows WHERE pid % 97 = 0 AND pid % 7 <> 0")
def shop_json_quarantine(spark, sf):
    return store_json.quarantined(shop(spark, sf)).select("product_id", "nom")


def damaged_shop_pages(spark, sf):
    """The landed pages, and for each store a truncated page, a missing one and one with damaged items."""
    good = '{"id": 1, "title": "fine", "variants": [{"price": "2.5", "inventory_quantity": 3}]}'
    items = [good, "null", '{"id": 2, "variants": "none"}', '{"id": 3, "variants": {"price": "1"}}',
             '{"id": 4, "title": "many", "variants": [{"price": "1", "inventory_quantity": 99999999999}]}']
    bodies = [(9001, '{"products": [' + good + ", " + good[:20]), (9002, None), (9003, '{"products": [' + ", ".join(items) + "]}"),
              (9004, '{"products": []}')]
    planted = F.explode(F.array(*[F.struct(F.lit(p).alias("page"), F.lit(b).cast("string").alias("body")) for p, b in bodies]))
    stores = landed.stores(spark, sf).select(F.col("name").alias("store"), planted.alias("x")).select("store", "x.page", "x.body")
    return landed.shop_pages(spark, sf).unionByName(stores)


@query("page_quarantine", f"""WITH {STORES_SQL}, planted(page, pos, reason) AS (VALUES (9001, 0, 'unparsable document'),
(9002, 0, 'no document'), (9003, 1, 'null item'), (9003, 2, 'malformed item'), (9003, 3, 'malformed item'))
SELECT name AS store, page, pos, reason FROM stores, planted""")
def page_quarantine(spark, sf):
    return store_json.faulty(store_json.shop_items(damaged_shop_pages(spark, sf))).drop("body")


@query("page_accounting", f"""WITH {BASE}, {SHOP_SQL}, landed AS (SELECT count(*) AS n FROM shop_rows),
bad AS (SELECT count(*) AS n FROM shop_rows WHERE pid % 97 = 0 AND pid % 7 <> 0), shops AS (SELECT count(*) AS n FROM stores)
SELECT true AS is_valid, landed.n - bad.n + shops.n AS items FROM landed, bad, shops
UNION ALL SELECT false, bad.n + 6 * shops.n FROM bad, shops""")
def page_accounting(spark, sf):
    """Accepted and quarantined rows; together they are what landed. A stock beyond any count is quarantined."""
    pages = damaged_shop_pages(spark, sf)
    rows = store_json.shop_rows(store_json.attach_store(store_json.shop_items(pages), landed.stores(spark, sf)))
    return rows.groupBy("is_valid").agg(F.count("*").alias("items"))


@query("shop_json_double_discount", f"""WITH {BASE}, {SHOP_SQL} SELECT product_id, prix, CASE WHEN remise_pct = 0 THEN prix
ELSE {np_round('prix * (1e0 - remise_pct / 1e2)', 2)} END AS prix_promo, remise_pct FROM shop_rows {GOOD}""")
def shop_json_double_discount(spark, sf):
    items = store_json.attach_store(store_json.shop_items(landed.shop_pages(spark, sf)), landed.stores(spark, sf))
    rows = store_json.shop_rows(items, double_discount=True)
    return store_json.accepted(rows).select("product_id", "prix", "prix_promo", "remise_pct")


@query("single_product_documents", f"WITH {BASE}, {SHOP_SQL} SELECT product_id, nom, prix, url FROM shop_rows "
       f"{GOOD} AND pid % 6 <> 0")
def single_product_documents(spark, sf):
    """One document per product; every sixth document is an empty envelope."""
    wrapped = F.concat(F.lit('{"product":'), "item", F.lit("}"))
    docs = landed.shop_item_json(spark, sf).select(
        "store", F.lit(0).alias("page"), F.when(pid() % 6 == 0, "{}").otherwise(wrapped).alias("body"))
    items = store_json.attach_store(store_json.shop_documents(docs), landed.stores(spark, sf))
    return store_json.accepted(store_json.shop_rows(items)).select("product_id", "nom", "prix", "url")


W_PRICE = "prix"
W_SALE = "CASE WHEN product_id % 3 = 0 THEN prix ELSE prix_promo END"
WOO_SQL = f"""woo_rows AS (SELECT CAST(product_id AS VARCHAR) AS product_id, nom,
  CASE WHEN product_id % 7 = 0 THEN 'Autre' ELSE categorie END AS categorie, marque_vendeur, pays_shop, 5 AS anciennete_shop,
  'WooCommerce' AS plateforme, prix, {W_SALE} AS prix_promo,
  CASE WHEN product_id % 3 <> 0 AND prix > prix_promo THEN {np_round('(prix - prix_promo) / prix * 1e2', 1)} ELSE 0e0 END AS remise_pct,
  'EUR' AS devise, rating, nb_reviews, en_stock, quantite_stock, 5 AS delai_livraison_j, couleur, taille, url,
  nom AS description, couleur || '; ' || taille || '; ' || plateforme || '; t4; t5' AS tags, 0 AS top_produit,
  0e0 AS score_attractivite, product_id AS pid FROM products)"""
WOO_COLS = list(schemas.EXTERNAL_DEFAULTS)


def woo(spark, sf, tag_limit=None):
    items = store_json.attach_store(store_json.woo_items(landed.woo_pages(spark, sf)), landed.stores(spark, sf))
    return store_json.woo_rows(items, tag_limit)


@query("woo_json_products", f"WITH {PRODUCTS}, {WOO_SQL} SELECT {', '.join(WOO_COLS)} FROM woo_rows WHERE pid % 97 <> 0")
def woo_json_products(spark, sf):
    """As the bulk collector stores them: five tags."""
    return store_json.accepted(woo(spark, sf, tag_limit=5)).select(*WOO_COLS)


@query("woo_json_all_tags", f"WITH {PRODUCTS}, {WOO_SQL} SELECT product_id, tags || '; t6' AS tags FROM woo_rows WHERE pid % 97 <> 0")
def woo_json_all_tags(spark, sf):
    """Six tags, none of them lost."""
    return store_json.accepted(woo(spark, sf)).select("product_id", "tags")


@query("shop_json_all_tags", f"""WITH {BASE} SELECT CAST(product_id AS VARCHAR) AS product_id,
replace(tags, ', ', '; ') || '; ' || couleur || '; ' || taille || '; a; b; bestseller' AS tags FROM typed""")
def shop_json_all_tags(spark, sf):
    """Products of more than five tags, as text or as a list; the last one raises the estimated rating."""
    more = F.concat_ws(", ", "tags", "couleur", "taille", F.lit("a, b, bestseller"))
    listed = F.when(pid() % 2 == 0, F.to_json(F.struct(F.col("product_id").alias("id"), F.split(more, ", ").alias("tags")))) \
        .otherwise(F.to_json(F.struct(F.col("product_id").alias("id"), more.alias("tags"))))
    df = products(spark, sf).select(F.col("marque_vendeur").alias("store"), F.lit(1).alias("page"),
                                    F.concat(F.lit('{"products":['), listed, F.lit("]}")).alias("body"))
    rows = store_json.shop_rows(store_json.attach_store(store_json.shop_items(df), landed.stores(spark, sf)))
    return store_json.accepted(rows).select("product_id", "tags")


@query("woo_json_quarantine", f"WITH {PRODUCTS}, {WOO_SQL} SELECT product_id, nom FROM woo_rows WHERE pid % 97 = 0")
def woo_json_quarantine(spark, sf):
    return store_json.quarantined(woo(spark, sf)).select("product_id", "nom")


def planted(spark, sf, bodies):
    """For each store the bodies, with their page numbers."""
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("page"), F.lit(b).cast("string").alias("body")) for p, b in bodies]))
    return landed.stores(spark, sf).select(F.col("name").alias("store"), each.alias("x")).select("store", "x.page", "x.body")


def damaged_woo_pages(spark, sf):
    """The landed pages, and for each store a truncated page, a missing one, an object and one with damaged items."""
    good = '{"id": 1, "name": "fine", "price": "2.5", "stock_quantity": 3}'
    items = [good, "null", '{"id": 2, "categories": "none"}', '{"id": 3, "price": "1", "rating_count": 99999999999}']
    bodies = [(9001, "[" + good + ", " + good[:20]), (9002, None), (9003, "[" + ", ".join(items) + "]"), (9004, "[]"),
              (9005, '{"code": "rest_no_route"}')]
    return landed.woo_pages(spark, sf).unionByName(planted(spark, sf, bodies))


@query("woo_page_quarantine", f"""WITH {STORES_SQL}, planted(page, pos, reason) AS (VALUES (9001, 0, 'unparsable document'),
(9002, 0, 'no document'), (9003, 1, 'null item'), (9003, 2, 'malformed item'), (9005, 0, 'unparsable document'))
SELECT name AS store, page, pos, reason FROM stores, planted""")
def woo_page_quarantine(spark, sf):
    return store_json.faulty(store_json.woo_items(damaged_woo_pages(spark, sf))).drop("body")


@query("woo_page_accounting", f"""WITH {PRODUCTS}, {WOO_SQL}, {STORES_SQL}, landed AS (SELECT count(*) AS n, count(*) FILTER (pid % 97 = 0) AS bad
FROM woo_rows), shops AS (SELECT count(*) AS n FROM stores)
SELECT true AS is_valid, landed.n - bad + shops.n AS items FROM landed, shops
UNION ALL SELECT false, bad + 6 * shops.n FROM landed, shops""")
def woo_page_accounting(spark, sf):
    """Accepted and quarantined rows add up to what landed, of the second store kind too."""
    items = store_json.attach_store(store_json.woo_items(damaged_woo_pages(spark, sf)), landed.stores(spark, sf))
    return store_json.woo_rows(items).groupBy("is_valid").agg(F.count("*").alias("items"))


@query("list_categories", f"""WITH {PRODUCTS}, {STORES_SQL}, c AS (SELECT DISTINCT marque_vendeur, categorie FROM products)
SELECT marque_vendeur AS store, rtrim(url, '/') || '/collections/' || categorie || '/products.json' AS category_url
FROM c JOIN stores ON name = marque_vendeur WHERE categorie <> 'PROMO'
UNION ALL SELECT marque_vendeur, rtrim(url, '/') || '/products.json' FROM (SELECT DISTINCT marque_vendeur FROM c
WHERE marque_vendeur NOT IN (SELECT marque_vendeur FROM c WHERE categorie <> 'PROMO')) JOIN stores ON name = marque_vendeur""")
def list_categories(spark, sf):
    """Collections per store; the handle of one kind is blank and must be skipped."""
    handle = F.when(F.col("categorie") == "PROMO", "").otherwise(F.col("categorie"))
    docs = products(spark, sf).groupBy(F.col("marque_vendeur").alias("store")).agg(
        F.to_json(F.struct(F.collect_set(F.struct(handle.alias("handle"))).alias("collections"))).alias("body"))
    return store_json.shop_categories(store_json.attach_store(docs, landed.stores(spark, sf)))


@query("list_woo_categories", f"""WITH {PRODUCTS} SELECT marque_vendeur AS store, categorie AS category_id FROM products
GROUP BY ALL HAVING SUM(en_stock) > 2""")
def list_woo_categories(spark, sf):
    counts = products(spark, sf).groupBy("marque_vendeur", "categorie").agg(F.sum("en_stock").alias("n"))
    count = F.when(F.col("n") > 2, F.col("n")).otherwise(0)
    docs = counts.groupBy(F.col("marque_vendeur").alias("store")).agg(
        F.to_json(F.collect_list(F.struct(F.col("categorie").alias("id"), count.alias("count")))).alias("body"))
    return store_json.woo_categories(docs)


LISTINGS = [(1, '{"collections": [{"handle": "a"}, {"handle": ""}]}'), (2, '{"collections": [{"handle": "b"}, {"han'), (3, None),
            (4, '{"collections": []}'), (5, '{"collections": "soon"}'), (6, '{"collections": [{"handle": "c"}, 7]}')]
WOO_LISTINGS = [(1, '[{"id": "a", "count": 2}, {"id": "b", "count": 0}]'), (2, '[{"id": "c", "count": 4}, {"i'), (3, None), (4, "[]"),
                (5, '{"code": "rest_no_route"}'), (6, '[{"id": "d", "count": "many"}]')]


@query("category_quarantine", f"""WITH {STORES_SQL}, faults(reason, n) AS (VALUES ('unparsable document', 3), ('no document', 1))
SELECT name AS store, kind, reason, n::BIGINT AS documents FROM stores, faults, (VALUES ('shop'), ('woo')) k(kind)""")
def category_quarantine(spark, sf):
    """Category documents that are truncated, missing or of another shape, counted for each store and kind."""
    shops, woos = (planted(spark, sf, listed) for listed in (LISTINGS, WOO_LISTINGS))
    faults = store_json.shop_category_faults(shops).withColumn("kind", F.lit("shop")).unionByName(
        store_json.woo_category_faults(woos).withColumn("kind", F.lit("woo")))
    return faults.groupBy("store", "kind", "reason").agg(F.count("*").alias("documents"))


@query("category_accepted", f"""WITH {STORES_SQL}, found(kind, suffix) AS (VALUES ('shop', '/collections/a/products.json'),
('shop', '/products.json'), ('woo', 'a')) SELECT name AS store, CASE WHEN kind = 'shop' THEN rtrim(url, '/') || suffix ELSE suffix END AS category
FROM stores, found""")
def category_accepted(spark, sf):
    """What the same documents list; only an empty list stands for the full listing."""
    shops = store_json.attach_store(planted(spark, sf, LISTINGS), landed.stores(spark, sf))
    return store_json.shop_categories(shops).select("store", F.col("category_url").alias("category")).unionByName(
        store_json.woo_categories(planted(spark, sf, WOO_LISTINGS)).select("store", F.col("category_id").alias("category")))


@query("normalize_category", f"WITH {BASE} SELECT product_id, category FROM mapped")
def normalize_category_query(spark, sf):
    kind = (F.when(pid() % 16 == 0, "Men's Apparel").when(pid() % 18 == 0, "Gift Set").when(pid() % 20 == 0, "  ")
            .when(pid() % 21 == 0, "Slippers").otherwise(F.col("nom")))
    df = store_json.attach_store(products(spark, sf), landed.stores(spark, sf), key="marque_vendeur")
    return df.select("product_id", normalize_category(kind, F.col("store_cat")).alias("category"))


@query("attach_store", f"""WITH {PRODUCTS}, {STORES_SQL} SELECT product_id, url_s AS store_url, pays, cat FROM products
LEFT JOIN (SELECT name, url AS url_s, pays, cat FROM stores) ON name = marque_vendeur""")
def attach_store(spark, sf):
    df = store_json.attach_store(products(spark, sf), landed.stores(spark, sf), key="marque_vendeur")
    return df.select("product_id", "store_url", F.col("store_pays").alias("pays"), F.col("store_cat").alias("cat"))


@query("ingest_discount", f"""WITH {PRODUCTS} SELECT product_id, CASE WHEN product_id % 5 <> 0 AND prix > prix_promo
THEN {np_round('(prix - prix_promo) / prix * 1e2', 1)} ELSE 0e0 END AS remise_pct FROM products""")
def ingest_discount(spark, sf):
    from vitrine.functions.pricing import effective_discount
    compare = F.coalesce(F.when(pid() % 5 != 0, F.col("prix")), F.col("prix_promo"))
    return products(spark, sf).select("product_id", effective_discount(compare, F.col("prix_promo")).alias("remise_pct"))


@query("variant_options", f"WITH {BASE}, {SHOP_SQL} SELECT product_id, couleur, taille FROM shop_rows")
def variant_options(spark, sf):
    item = F.col("item")["options"]
    return store_json.shop_items(landed.shop_pages(spark, sf)).select(
        F.col("item")["id"].alias("product_id"),
        store_json.first_option(item, "values", "color", "colour").alias("couleur"),
        store_json.first_option(item, "values", "size").alias("taille"))


@query("variant_stock", f"WITH {BASE}, {SHOP_SQL} SELECT product_id, quantite_stock, en_stock FROM shop_rows")
def variant_stock(spark, sf):
    variants = F.col("item")["variants"]
    return store_json.shop_items(landed.shop_pages(spark, sf)).select(
        F.col("item")["id"].alias("product_id"), store_json.variant_stock(variants).alias("quantite_stock"),
        store_json.variant_available(variants).alias("en_stock"))


@query("normalize_tags", f"""WITH {PRODUCTS} SELECT product_id, array_to_string(list_slice(list_filter(list_transform(
string_split(tags || ', ' || taille || ',, ' || couleur || ' ,x,y,z', ','), lambda t: trim(t)), lambda t: t <> ''), 1, 5), '; ') AS tags FROM products""")
def normalize_tags(spark, sf):
    raw = F.concat("tags", F.lit(", "), "taille", F.lit(",, "), "couleur", F.lit(" ,x,y,z"))
    listed = F.to_json(F.split(raw, ","))
    mixed = F.when(pid() % 2 == 0, raw).otherwise(listed)
    return products(spark, sf).select("product_id", text.join_tags(text.tag_list(mixed), 5).alias("tags"))


@query("strip_html", """SELECT page_id, regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS plain
FROM pages""")
def strip_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.strip_html(F.col("html")).alias("plain"))


@query("product_url", f"""WITH {PRODUCTS}, {STORES_SQL} SELECT product_id, rtrim(st.url, '/') || '/products/' || replace(nom, ' ', '-')
AS link FROM products p JOIN stores st ON st.name = p.marque_vendeur""")
def product_url(spark, sf):
    df = store_json.attach_store(products(spark, sf), landed.stores(spark, sf), key="marque_vendeur")
    handle = F.replace(F.col("nom"), F.lit(" "), F.lit("-"))
    return df.select("product_id", text.store_url(F.col("store_url"), F.lit("/products/"), handle).alias("link"))


@query("date_prefix", """SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN CAST(ts AS DATE) END AS day FROM events""")
def date_prefix(spark, sf):
    stamp = F.when(F.col("event_id") % 10 != 0, F.col("ts").cast("string")).otherwise("soon")
    return table(spark, sf, "events").select("event_id", text.date_prefix(stamp).alias("day"))


# RE2 has no look-around: delimiters are doubled, matched with their neighbours, and restored.
def _abbr(expr):
    for word in text.ABBREVIATIONS:
        expr = (f"regexp_replace(regexp_replace({expr}, '(?i)(^|[^\\p{{L}}\\p{{N}}]){word}($|[^\\p{{L}}\\p{{N}}])', "
                f"'\\1{word}\\2', 'g'), '(?i)(^|[^\\p{{L}}\\p{{N}}]){word}($|[^\\p{{L}}\\p{{N}}])', '\\1{word}\\2', 'g')")
    return expr


PLAIN = r"trim(regexp_replace(regexp_replace(t, '[^\p{L}\p{N}\s\-]', ' ', 'g'), '\s+', ' ', 'g'))"
TITLE_CASE = ("array_to_string(list_transform(string_split(" + PLAIN + ", ' '), lambda w: CASE WHEN substr(w, 1, 1) = 'ß' "
              "THEN 'Ss' ELSE upper(substr(w, 1, 1)) END || lower(substr(w, 2))), ' ')")


@query("normalize_titles", f"""WITH d AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) || ' usb-c Led tv' AS t FROM pages)
SELECT page_id, rtrim(substr({_abbr(TITLE_CASE)}, 1, 60)) AS title FROM d""")
def normalize_titles(spark, sf):
    """Titles of the raw web pages."""
    raw = F.concat(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit(" usb-c Led tv"))
    return table(spark, sf, "pages").select("page_id", text.normalize_title(raw).alias("title"))


EXPORT = {"asin": "product_id", "title": "nom", "categoryName": "sous_categorie", "boughtInLastMonth": "nb_reviews",
          "stars": "rating", "price": "prix", "isBestSeller": "en_stock"}
EXT_COLS = list(schemas.EXTERNAL_DEFAULTS)


def export(spark, sf, columns=EXPORT):
    """An export in foreign column names, all text, with malformed prices."""
    df = products(spark, sf)
    out = {new: F.col(old).cast("string") for new, old in columns.items()}
    if "price" in out:
        out["price"] = F.when(pid() % 17 == 0, "n/a").otherwise(out["price"])
    return df.select(*[c.alias(n) for n, c in out.items()], F.lit("x").alias("extra"), pid().alias("line_no"))


EXT_SQL = """'Kaggle Store' AS marque_vendeur, 'USA' AS pays_shop, 5 AS anciennete_shop, {platform} AS plateforme,
0e0 AS prix_promo, 0e0 AS remise_pct, 'USD' AS devise, 1 AS en_stock, 50 AS quantite_stock, 5 AS delai_livraison_j,
'' AS couleur, '' AS taille, '' AS url, '' AS description, '' AS tags, 0e0 AS score_attractivite"""


@query("rename_external", f"""WITH {PRODUCTS} SELECT CAST(product_id AS VARCHAR) AS product_id, nom, sous_categorie AS categorie,
CAST(nb_reviews AS VARCHAR) AS nb_reviews, CAST(rating AS VARCHAR) AS rating, CAST(en_stock AS VARCHAR) AS top_produit FROM products""")
def rename_external(spark, sf):
    return tables.rename_external(export(spark, sf), "amazon_2023").select(
        "product_id", "nom", "categorie", "nb_reviews", "rating", "top_produit")


@query("import_external", f"""WITH {PRODUCTS} SELECT CAST(product_id AS VARCHAR) AS product_id, nom, sous_categorie AS categorie,
CASE WHEN product_id % 17 = 0 THEN 0e0 ELSE prix END AS prix, rating, nb_reviews, en_stock_0 AS top_produit,
{EXT_SQL.format(platform="'Amazon'")} FROM (SELECT * EXCLUDE (prix_promo, remise_pct, en_stock, quantite_stock, delai_livraison_j,
marque_vendeur, pays_shop, plateforme, couleur, taille, url, tags), en_stock AS en_stock_0 FROM products)""")
def import_external(spark, sf):
    """Written as CSV, scanned as text, then normalised."""
    path = tables.write_table(export(spark, sf), scratch_path(spark, "export"), "csv")
    raw = tables.scan_or_empty(spark, path, "asin string")
    return tables.import_external(raw, "amazon_2023", ["line_no"]).select(*EXT_COLS)


@query("fill_missing_columns", f"""WITH {PRODUCTS} SELECT CAST(row_number() OVER (ORDER BY product_id) - 1 AS VARCHAR) AS product_id,
'Produit Inconnu' AS nom, sous_categorie AS categorie, 0e0 AS prix, 0e0 AS rating, 0 AS nb_reviews, 0 AS top_produit,
{EXT_SQL.format(platform="'eCommerce'")} FROM (SELECT product_id, sous_categorie FROM products)""")
def fill_missing_columns(spark, sf):
    raw = export(spark, sf, {"Division Name": "sous_categorie"})
    return tables.import_external(raw, "clothing_reviews", ["line_no"]).select(*EXT_COLS)


@query("union_sources", f"""WITH {BASE}, {SHOP_SQL}, {WOO_SQL}, u AS (
SELECT product_id, nom, categorie, plateforme, prix, url, date_mise_en_ligne FROM shop_rows {GOOD}
UNION ALL SELECT product_id, nom, categorie, plateforme, prix, url, CAST(NULL AS DATE) FROM woo_rows WHERE pid % 97 <> 0)
SELECT * FROM u""")
def union_sources(spark, sf):
    both = tables.union_sources(store_json.accepted(shop(spark, sf)), store_json.accepted(woo(spark, sf)))
    return both.select("product_id", "nom", "categorie", "plateforme", "prix", "url", "date_mise_en_ligne")


@query("consolidate", f"""WITH {BASE}, {SHOP_SQL}, {WOO_SQL}, u AS (
SELECT 0 AS src, pid, product_id, nom, marque_vendeur, prix, rating, nb_reviews, url FROM shop_rows {GOOD}
UNION ALL SELECT 1, pid, product_id, nom, marque_vendeur, prix, rating, nb_reviews, url FROM woo_rows WHERE pid % 97 <> 0),
a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY src, pid) AS rn FROM u) WHERE rn = 1),
b AS (SELECT * FROM (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY nom, marque_vendeur ORDER BY src, pid) AS rn FROM a) WHERE rn = 1)
SELECT product_id, nom, marque_vendeur, prix, rating, nb_reviews, url FROM b""")
def consolidate(spark, sf):
    sources = [store_json.accepted(shop(spark, sf)), store_json.accepted(woo(spark, sf))]
    numbered = [s.withColumn("seq", F.col("product_id").cast("long")) for s in sources]
    return flows.consolidate(numbered, order=["seq"]).select(
        "product_id", "nom", "marque_vendeur", "prix", "rating", "nb_reviews", "url")


def openers(spark, sf):
    """Two stores that can be read, and between them a folder that does not exist."""
    def numbered(rows):
        return store_json.accepted(rows).withColumn("seq", F.col("product_id").cast("long"))

    missing = scratch_path(spark, "never-landed")
    return {"shop": lambda: numbered(shop(spark, sf)), "gone": lambda: spark.read.parquet(missing),
            "woo": lambda: numbered(woo(spark, sf))}


@query("consolidate_sources", ORACLES["consolidate"])
def consolidate_sources(spark, sf):
    """The other sources complete where one can't be read."""
    result, _ = flows.consolidate_sources(spark, openers(spark, sf), order=["seq"])
    return result.select("product_id", "nom", "marque_vendeur", "prix", "rating", "nb_reviews", "url")


@query("source_report", f"""WITH {BASE}, {SHOP_SQL}, {WOO_SQL}
SELECT 0 AS source_no, 'shop' AS name, 'read' AS status, (SELECT COUNT(*) FROM shop_rows {GOOD}) AS n_rows, false AS faulty
UNION ALL SELECT 1, 'gone', 'failed', NULL, true
UNION ALL SELECT 2, 'woo', 'read', (SELECT COUNT(*) FROM woo_rows WHERE pid % 97 <> 0), false""")
def source_report(spark, sf):
    _, report = flows.open_sources(spark, openers(spark, sf))
    return report.select("source_no", "name", "status", "n_rows", F.col("fault").isNotNull().alias("faulty"))


@query("ingest_flow", f"""WITH {BASE}, {SHOP_SQL}, {WOO_SQL}, u AS (
SELECT 0 AS src, pid, product_id, nom, prix, rating, nb_reviews, en_stock, url FROM shop_rows {GOOD}
UNION ALL SELECT 1, pid, product_id, nom, prix, rating, nb_reviews, en_stock, url FROM woo_rows WHERE pid % 97 <> 0),
d AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY src, pid) AS rn FROM u) WHERE rn = 1),
{collector_cte('d', 'c')}
SELECT product_id, plateforme_n AS source_no, score_attractivite, top_produit FROM (SELECT *, src AS plateforme_n FROM c)""")
def ingest_flow(spark, sf):
    sources = [store_json.accepted(shop(spark, sf)), store_json.accepted(woo(spark, sf))]
    numbered = [s.withColumn("seq", F.col("product_id").cast("long")) for s in sources]
    return flows.ingest(numbered, order=["seq"]).select(
        "product_id", "source_no", "score_attractivite", "top_produit")


@query("scan_products", f"""WITH {PRODUCTS} SELECT CAST(product_id AS VARCHAR) AS product_id, nom, categorie, prix, rating, nb_reviews,
en_stock, date_mise_en_ligne, date_promotion FROM products""")
def scan_products(spark, sf):
    """Catalogue written as CSV, then scanned with the declared schema."""
    df = products(spark, sf)
    known = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.PRODUCTS]
    path = tables.write_table(df.select(*known), scratch_path(spark, "catalogue"), "csv")
    return tables.scan_products(spark, path).select(
        "product_id", "nom", "categorie", "prix", "rating", "nb_reviews", "en_stock", "date_mise_en_ligne", "date_promotion")


@query("sink_roundtrip", f"WITH {PRODUCTS} SELECT product_id, plateforme, prix, date_promotion FROM products")
def sink_roundtrip(spark, sf):
    df = products(spark, sf).select("product_id", "plateforme", "prix", "date_promotion")
    path = tables.write_table(df, scratch_path(spark, "sink"), "parquet", partition_by=["plateforme"])
    return spark.read.parquet(path)
