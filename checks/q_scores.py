"""Scores, Top-K, labels and business reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import pricing, text
from vitrine.functions.numeric import half_even, steady_mean
from vitrine.operators import reports, scoring, topk

from .fixtures import products, table
from .oracle_views import PRODUCTS, mean, np_round, scored_view
from .registry import query

SCORED = f"{PRODUCTS}, {scored_view('products', 'scored')}"
SHOW = ["product_id", "nom", "categorie", "prix", "rating", "nb_reviews", "topk_score"]
SHOW_SQL = ", ".join(SHOW)


def scored(spark, sf):
    return scoring.topk_score(products(spark, sf))


@query("topk_score", f"WITH {SCORED} SELECT product_id, topk_score FROM scored")
def topk_score(spark, sf):
    return scored(spark, sf).select("product_id", "topk_score")


CUSTOM = {"rating": 0.5, "prix_inverse": 0.8}


@query("topk_score_custom", f"WITH {PRODUCTS}, {scored_view('products', 'scored', (0.5, 0, 0, 0.8, 0))} "
       "SELECT product_id, topk_score FROM scored")
def topk_score_custom(spark, sf):
    return scoring.topk_score(products(spark, sf), CUSTOM).select("product_id", "topk_score")


@query("topk_global", f"""WITH {SCORED} SELECT {SHOW_SQL},
CAST(row_number() OVER (ORDER BY topk_score DESC, product_id) AS INTEGER) AS rank
FROM scored ORDER BY topk_score DESC, product_id LIMIT 20""")
def topk_global(spark, sf):
    return topk.select_top_k(products(spark, sf), 20).select(*SHOW, "rank")


def _per(group, k, rank):
    return f"""WITH {SCORED} SELECT {SHOW_SQL}, marque_vendeur, CAST(rn AS INTEGER) AS {rank} FROM (
SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY topk_score DESC, product_id) AS rn FROM scored) WHERE rn <= {k}"""


@query("topk_by_category", _per("categorie", 5, "rank_in_category"))
def topk_by_category(spark, sf):
    return topk.select_top_k_by_category(products(spark, sf), 5).select(*SHOW, "marque_vendeur", "rank_in_category")


@query("topk_by_category_3", _per("categorie", 3, "rank_in_category"))
def topk_by_category_3(spark, sf):
    return topk.select_top_k_by_category(products(spark, sf), 3).select(*SHOW, "marque_vendeur", "rank_in_category")


@query("topk_by_shop", _per("marque_vendeur", 3, "rank_in_shop"))
def topk_by_shop(spark, sf):
    return topk.select_top_k_by_shop(products(spark, sf), 3).select(*SHOW, "marque_vendeur", "rank_in_shop")


STATS_SQL = f"""SELECT COUNT(*) AS nb_produits_total, COUNT(DISTINCT categorie) AS nb_categories,
COUNT(DISTINCT marque_vendeur) AS nb_shops, {np_round(mean('prix'), 2)} AS prix_moyen,
{np_round(mean('rating'), 2)} AS rating_moyen, {np_round(mean('en_stock') + ' * 100', 1)} AS pct_en_stock,
(SELECT {np_round('MIN(topk_score)', 4)} FROM best) AS top_k_score_min,
(SELECT {np_round(mean('topk_score'), 4)} FROM best) AS top_k_score_moyen FROM scored"""
BEST10 = "best AS (SELECT * FROM scored ORDER BY topk_score DESC, product_id LIMIT 10)"


@query("catalog_stats", f"WITH {SCORED}, {BEST10} {STATS_SQL}")
def catalog_stats(spark, sf):
    return reports.catalog_stats(scored(spark, sf), 10)


@query("topk_report", f"""WITH {SCORED} SELECT 'global' AS part, product_id, topk_score, CAST(rn AS INTEGER) AS position FROM
(SELECT *, row_number() OVER (ORDER BY topk_score DESC, product_id) AS rn FROM scored) WHERE rn <= 10
UNION ALL SELECT 'by_category', product_id, topk_score, CAST(rn AS INTEGER) FROM
(SELECT *, row_number() OVER (PARTITION BY categorie ORDER BY topk_score DESC, product_id) AS rn FROM scored) WHERE rn <= 5
UNION ALL SELECT 'by_shop', product_id, topk_score, CAST(rn AS INTEGER) FROM
(SELECT *, row_number() OVER (PARTITION BY marque_vendeur ORDER BY topk_score DESC, product_id) AS rn FROM scored) WHERE rn <= 1""")
def topk_report(spark, sf):
    from vitrine.plans.flows import topk_report as report
    parts = report(products(spark, sf), 10)
    pick = [("global", "rank"), ("by_category", "rank_in_category"), ("by_shop", "rank_in_shop")]
    frames = [parts[p].select(F.lit(p).alias("part"), "product_id", "topk_score", F.col(r).alias("position"))
              for p, r in pick]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("kpis", f"""WITH {PRODUCTS} SELECT COUNT(*) AS total_produits, {np_round(mean('prix'), 2)} AS prix_moyen,
{np_round(mean('rating'), 2)} AS note_moyenne, {np_round(mean('en_stock') + ' * 100', 1)} AS pct_en_stock,
CAST(SUM(nb_reviews) AS BIGINT) AS total_avis FROM products""")
def kpis(spark, sf):
    return reports.kpis(products(spark, sf))


@query("category_counts", f"WITH {PRODUCTS} SELECT categorie, COUNT(*) AS n FROM products GROUP BY categorie")
def category_counts(spark, sf):
    return reports.value_counts(products(spark, sf), "categorie")


@query("category_counts_top7", f"""WITH {PRODUCTS} SELECT sous_categorie, COUNT(*) AS n FROM products
GROUP BY sous_categorie ORDER BY n DESC, sous_categorie LIMIT 7""")
def category_counts_top7(spark, sf):
    return reports.value_counts(products(spark, sf), "sous_categorie", 7)


@query("shop_performance", f"""WITH {SCORED} SELECT marque_vendeur, {np_round(mean('topk_score'), 3)} AS score_moyen,
COUNT(product_id) AS nb_produits, {np_round(mean('rating'), 3)} AS rating_moyen FROM scored GROUP BY marque_vendeur""")
def shop_performance(spark, sf):
    return reports.shop_performance(scored(spark, sf))


@query("shop_competition", f"""WITH {SCORED} SELECT marque_vendeur, COUNT(product_id) AS nb_produits,
{np_round(mean('rating'), 2)} AS rating_moyen, {np_round(mean('prix'), 2)} AS prix_moyen,
{np_round(mean('topk_score'), 2)} AS score_moyen, CAST(SUM(nb_reviews) AS BIGINT) AS total_avis
FROM scored GROUP BY marque_vendeur""")
def shop_competition(spark, sf):
    return reports.shop_competition(scored(spark, sf))


@query("country_stats", f"""WITH {SCORED} SELECT pays_shop, COUNT(product_id) AS nb_produits,
{np_round(mean('topk_score'), 6)} AS score_moyen FROM scored GROUP BY pays_shop""")
def country_stats(spark, sf):
    return reports.country_stats(scored(spark, sf))


@query("rating_heatmap", f"""WITH {PRODUCTS} SELECT categorie,
{np_round(mean("CASE WHEN plateforme = 'Shopify' THEN rating END"), 2)} AS "Shopify",
{np_round(mean("CASE WHEN plateforme = 'WooCommerce' THEN rating END"), 2)} AS "WooCommerce"
FROM products GROUP BY categorie""")
def rating_heatmap(spark, sf):
    return reports.rating_heatmap(products(spark, sf), ["Shopify", "WooCommerce"])


@query("price_boxplot", f"""WITH {PRODUCTS}, q AS (SELECT categorie, quantile_cont(prix, 0.25) AS q1,
quantile_cont(prix, 0.5) AS median, quantile_cont(prix, 0.75) AS q3 FROM products GROUP BY categorie),
f AS (SELECT *, q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi FROM q)
SELECT p.categorie, {np_round('MAX(q1)', 4)} AS q1, {np_round('MAX(median)', 4)} AS median, {np_round('MAX(q3)', 4)} AS q3,
MIN(CASE WHEN prix BETWEEN lo AND hi THEN prix END) AS whisker_low,
MAX(CASE WHEN prix BETWEEN lo AND hi THEN prix END) AS whisker_high,
CAST(SUM(CASE WHEN prix BETWEEN lo AND hi THEN 0 ELSE 1 END) AS BIGINT) AS outliers
FROM products p JOIN f ON p.categorie = f.categorie GROUP BY p.categorie""")
def price_boxplot(spark, sf):
    return reports.price_boxplot(products(spark, sf))


def _best(group):
    return (f"(SELECT '{group}' AS dimension, {group} AS best, {np_round(mean('topk_score'), 6)} AS mean_score FROM scored "
            f"GROUP BY {group} ORDER BY {mean('topk_score')} DESC, {group} LIMIT 1)")


@query("top_groups", f"WITH {SCORED} {_best('categorie')} UNION ALL {_best('marque_vendeur')}")
def top_groups(spark, sf):
    return reports.top_groups(scored(spark, sf))


@query("topk_metrics", f"""WITH {SCORED}, best AS (SELECT * FROM scored ORDER BY topk_score DESC, product_id LIMIT 20)
SELECT COUNT(*) AS top_rows, {np_round(mean('topk_score'), 4)} AS avg_topk_score,
{np_round(mean('rating'), 4)} AS avg_rating_topk, {np_round(mean('prix'), 2)} AS avg_price_topk, 20 AS top_k,
(SELECT COUNT(*) FROM scored) AS nb_products_analyzed FROM best""")
def topk_metrics(spark, sf):
    return reports.topk_metrics(scored(spark, sf), 20)


@query("filter_options", f"""WITH {PRODUCTS} SELECT DISTINCT 'categorie' AS filter, categorie AS choice FROM products
UNION ALL SELECT DISTINCT 'marque_vendeur', marque_vendeur FROM products
UNION ALL SELECT DISTINCT 'pays_shop', pays_shop FROM products
UNION ALL SELECT DISTINCT 'plateforme', plateforme FROM products""")
def filter_options(spark, sf):
    return reports.filter_options(products(spark, sf))


@query("price_bounds", f"WITH {PRODUCTS} SELECT MIN(prix) AS prix_min, MAX(prix) AS prix_max FROM products")
def price_bounds(spark, sf):
    return reports.price_bounds(products(spark, sf))


CHOICE = reports.ProductFilter(categories=["ECONOMY", "PROMO"], platforms=["Shopify"],
                               countries=["NATION_0", "NATION_1", "NATION_5", "NATION_6", "NATION_10", "NATION_11"],
                               price_range=(20.0, 150.0), in_stock_only=True)


@query("filter_products", f"""WITH {SCORED} SELECT {SHOW_SQL} FROM scored WHERE categorie IN ('ECONOMY', 'PROMO')
AND plateforme = 'Shopify' AND pays_shop IN ('NATION_0', 'NATION_1', 'NATION_5', 'NATION_6', 'NATION_10', 'NATION_11')
AND prix BETWEEN 20 AND 150 AND en_stock = 1""")
def filter_products(spark, sf):
    return CHOICE.apply(scored(spark, sf)).select(*SHOW)


@query("filter_long_choice", f"""WITH {SCORED} SELECT {SHOW_SQL} FROM scored WHERE en_stock = 1
AND marque_vendeur IN (SELECT s_name FROM supplier WHERE s_acctbal > 0)""")
def filter_long_choice(spark, sf):
    """Shops chosen by a table: every supplier with a positive balance."""
    chosen = table(spark, sf, "supplier").where("s_acctbal > 0").select("s_name")
    return reports.ProductFilter(shops=chosen, in_stock_only=True).apply(scored(spark, sf)).select(*SHOW)


@query("market_context", f"""WITH {SCORED}
SELECT 'stats' AS section, 1 AS ord, '  nb_produits_total: ' || COUNT(*) AS line FROM scored
UNION ALL SELECT 'stats', 2, '  prix_moyen: ' || printf('%.2f', {np_round(mean('prix'), 2)}) FROM scored
UNION ALL SELECT 'stats', 3, '  rating_moyen: ' || printf('%.2f', {np_round(mean('rating'), 2)}) FROM scored
UNION ALL SELECT 'top', CAST(rn AS INTEGER), '  • ' || nom || ' | ' || categorie || ' | Prix: ' || printf('%.2f', prix)
  || ' | Note: ' || printf('%.1f', rating) || '/5 | ' || nb_reviews || ' avis | Shop: ' || marque_vendeur || ' (' || pays_shop || ')'
  FROM (SELECT *, row_number() OVER (ORDER BY topk_score DESC, product_id) AS rn FROM scored) WHERE rn <= 10
UNION ALL SELECT 'categories', CAST(rn AS INTEGER), '  ' || categorie || ': ' || n || ' produits' FROM
  (SELECT categorie, COUNT(*) AS n, row_number() OVER (ORDER BY COUNT(*) DESC, categorie) AS rn FROM scored GROUP BY categorie)
  WHERE rn <= 7""")
def market_context(spark, sf):
    return reports.market_context(scored(spark, sf))


@query("display_table", f"""WITH {SCORED} SELECT CAST(rn AS INTEGER) AS "Rang", nom AS "Produit", categorie AS "Catégorie",
marque_vendeur AS "Shop", pays_shop AS "Pays", prix AS "Prix", rating AS "Note", nb_reviews AS "Avis", topk_score AS "Score"
FROM (SELECT *, row_number() OVER (ORDER BY topk_score DESC, product_id) AS rn FROM scored) WHERE rn <= 20""")
def display_table(spark, sf):
    best = topk.rank_top(scored(spark, sf), 20)
    return reports.display(best, reports.TOP_LABELS)


@query("label_fixed_threshold", f"""WITH {PRODUCTS}, s AS (SELECT product_id, rating / 5e0 * 0.4e0
+ least(nb_reviews / 2000e0, 1e0) * 0.35e0 + CASE WHEN en_stock = 1 THEN 1e0 ELSE 0e0 END * 0.15e0 AS bare,
(1e0 - least(prix / 350e0, 1e0)) * 0.1e0 AS price_term FROM products)
SELECT product_id, CASE WHEN bare + price_term >= 0.55e0 THEN 1 ELSE 0 END AS top_produit,
{np_round('bare + price_term', 4)} AS score_attractivite, CASE WHEN bare >= 0.55e0 THEN 1 ELSE 0 END AS top_without_price,
{np_round('bare', 4)} AS score_without_price FROM s""")
def label_fixed_threshold(spark, sf):
    full = scoring.fixed_label(products(spark, sf))
    both = full.withColumns({"a": F.col("top_produit"), "b": F.col("score_attractivite")})
    return scoring.fixed_label(both, with_price=False).select(
        "product_id", F.col("a").alias("top_produit"), F.col("b").alias("score_attractivite"),
        F.col("top_produit").alias("top_without_price"), F.col("score_attractivite").alias("score_without_price"))


@query("label_quantile", f"""WITH {SCORED} SELECT product_id, topk_score,
CASE WHEN topk_score >= (SELECT quantile_cont(topk_score, 0.6) FROM scored) THEN 1 ELSE 0 END AS top_produit FROM scored""")
def label_quantile(spark, sf):
    df = scored(spark, sf).select("product_id", "topk_score")
    return scoring.quantile_label(df, "topk_score", 0.6)


def _mm(x):
    return f"(({x}) - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ())"


def collector_cte(source, name):
    raw = (f"0.35e0 * ({_mm('rating')}) + 0.25e0 * ({_mm('ln(1e0 + nb_reviews)')}) + 0.15e0 * CAST(en_stock AS DOUBLE)"
           f" + 0.25e0 * (1e0 - ({_mm('prix')}))")
    return (f"{name}_s AS MATERIALIZED (SELECT *, {np_round(raw, 4)} AS score_attractivite FROM {source}), "
            f"{name} AS (SELECT *, CASE WHEN score_attractivite >= (SELECT quantile_cont(score_attractivite, 0.6) "
            f"FROM {name}_s) THEN 1 ELSE 0 END AS top_produit FROM {name}_s)")


@query("collector_score", f"""WITH {PRODUCTS}, {collector_cte('products', 'collected')}
SELECT product_id, score_attractivite, top_produit FROM collected""")
def collector_score(spark, sf):
    return scoring.score_collected(products(spark, sf)).select("product_id", "score_attractivite", "top_produit")


def _u(seed):
    return f"((('0x' || substr(md5('{seed}|' || product_id), 1, 8))::BIGINT + 0.5e0) / 4294967296e0)"


def _normal(seed, mean, dev):
    return f"({mean}e0 + {dev}e0 * sqrt(-2e0 * ln({_u(seed + 'a')})) * cos(2e0 * pi() * {_u(seed + 'b')}))"


def estimated_cte(source, name):
    words = " OR ".join(f"contains(lower(tags), '{w}')" for w in text.QUALITY_WORDS)
    return f"""{name} AS MATERIALIZED (SELECT * REPLACE ({np_round(f'''least(greatest(
least(greatest({_normal('rating', '4.1', '0.4')}, 2.5e0), 5e0)
+ CASE WHEN coalesce(remise_pct, 0) > 0 THEN 0.05e0 + 0.15e0 * {_u('promo')} ELSE 0e0 END
- CASE WHEN coalesce(en_stock, 1) = 0 THEN 0.3e0 ELSE 0e0 END
+ CASE WHEN {words} THEN 0.15e0 ELSE 0e0 END, 1e0), 5e0)''', 1)} AS rating,
CAST(least(greatest(floor(exp({_normal('reviews', '4.5', '1.2')}))
+ floor(greatest(coalesce(prix, 0e0), 0e0) / ((SELECT max(greatest(coalesce(prix, 0e0), 0e0)) FROM {source}) + 1e-9) * 200), 0), 5000)
AS INTEGER) AS nb_reviews) FROM {source})"""


UNRATED = "unrated AS (SELECT * REPLACE (0e0 AS rating, 0 AS nb_reviews) FROM products)"


def unrated(spark, sf):
    return products(spark, sf).withColumns({"rating": F.lit(0.0), "nb_reviews": F.lit(0)})


@query("estimate_ratings", f"WITH {PRODUCTS}, {UNRATED}, {estimated_cte('unrated', 'est')} "
       "SELECT product_id, rating, nb_reviews FROM est")
def estimate_ratings(spark, sf):
    return scoring.estimate_ratings(unrated(spark, sf)).select("product_id", "rating", "nb_reviews")


@query("estimate_ratings_rated", f"WITH {PRODUCTS} SELECT product_id, rating, nb_reviews FROM products")
def estimate_ratings_rated(spark, sf):
    """One rated product switches the estimation off for all."""
    return scoring.estimate_ratings(products(spark, sf)).select("product_id", "rating", "nb_reviews")


@query("estimated_rating_summary", f"""WITH {PRODUCTS}, {UNRATED}, {estimated_cte('unrated', 'est')}
SELECT {np_round(mean('rating'), 4)} AS mean_rating, {np_round(mean('nb_reviews'), 4)} AS mean_reviews FROM est""")
def estimated_rating_summary(spark, sf):
    df = scoring.estimate_ratings(unrated(spark, sf))
    return df.agg(half_even(steady_mean(F.col("rating")), 4).alias("mean_rating"),
                  half_even(steady_mean(F.col("nb_reviews")), 4).alias("mean_reviews"))


@query("collected_unrated", f"""WITH {PRODUCTS}, {UNRATED}, {estimated_cte('unrated', 'est')}, {collector_cte('est', 'c')}
SELECT product_id, rating, nb_reviews, score_attractivite, top_produit FROM c""")
def collected_unrated(spark, sf):
    return scoring.score_collected(unrated(spark, sf)).select(
        "product_id", "rating", "nb_reviews", "score_attractivite", "top_produit")


@query("tag_quality_bonus", f"""WITH {PRODUCTS} SELECT product_id, CASE WHEN
{' OR '.join(f"contains(lower(tags), '{w}')" for w in text.QUALITY_WORDS)} THEN 0.15e0 ELSE 0e0 END AS bonus FROM products""")
def tag_quality_bonus(spark, sf):
    bonus = F.when(text.has_quality_word(F.col("tags")), F.lit(0.15)).otherwise(F.lit(0.0))
    return products(spark, sf).select("product_id", bonus.alias("bonus"))


ISO = ["USA", "CAN", "AUS", "FRA", "DEU", "ESP", "ITA", "GBR", "MAR", "ARE"]


@query("country_currency", f"""WITH {PRODUCTS}, c AS (SELECT product_id,
list_extract({ISO}, CAST(substr(pays_shop, 8) AS INTEGER) % 10 + 1) AS iso FROM products)
SELECT product_id, iso, CASE iso WHEN 'USA' THEN 'USD' WHEN 'CAN' THEN 'USD' WHEN 'AUS' THEN 'USD' WHEN 'FRA' THEN 'EUR'
WHEN 'DEU' THEN 'EUR' WHEN 'ESP' THEN 'EUR' WHEN 'ITA' THEN 'EUR' WHEN 'GBR' THEN 'GBP' WHEN 'MAR' THEN 'MAD' ELSE 'AED' END
AS devise FROM c""")
def country_currency(spark, sf):
    number = F.substring("pays_shop", 8, 10).cast("int") % 10 + 1
    iso = F.element_at(F.array(*[F.lit(c) for c in ISO]), number)
    df = products(spark, sf).select("product_id", iso.alias("iso"))
    return df.withColumn("devise", pricing.currency(F.col("iso")))


@query("promo_price", f"""WITH {PRODUCTS} SELECT product_id,
{np_round('prix * (1e0 - remise_pct / 1e2)', 2)} AS prix_promo FROM products""")
def promo_price(spark, sf):
    return products(spark, sf).select(
        "product_id", pricing.promo_price(F.col("prix"), F.col("remise_pct")).alias("prix_promo"))


CARD = ["nom", "categorie", "prix", "rating", "nb_reviews"]


@query("product_text", f"""WITH {PRODUCTS} SELECT product_id, '  • ' || nom || ' | ' || categorie || ' | Prix: ' || printf('%.2f', prix)
|| ' | Note: ' || printf('%.1f', rating) || '/5 | ' || nb_reviews || ' avis | Shop: ' || marque_vendeur || ' (' || pays_shop || ')' AS line,
'Produit : ' || nom || chr(10) || 'Catégorie : ' || categorie || chr(10) || 'Prix : ' || printf('%.2f', prix) || '€' || chr(10)
|| 'Note : ' || printf('%.1f', rating) || '/5 (' || nb_reviews || ' avis)' || chr(10) || 'Description : ' || tags AS card FROM products""")
def product_text(spark, sf):
    df = products(spark, sf)
    return df.select("product_id", text.product_line(*[F.col(c) for c in [*CARD, "marque_vendeur", "pays_shop"]]).alias("line"),
                     text.product_card(*[F.col(c) for c in [*CARD, "tags"]]).alias("card"))


@query("json_records", f"""WITH {SCORED} SELECT '{{"marque_vendeur":"' || marque_vendeur || '","nb_produits":' || COUNT(product_id)
|| ',"total_avis":' || CAST(SUM(nb_reviews) AS BIGINT) || '}}' AS record FROM scored GROUP BY marque_vendeur""")
def json_records(spark, sf):
    stats = reports.shop_competition(scored(spark, sf))
    return reports.json_records(stats, ["marque_vendeur", "nb_produits", "total_avis"])


@query("top_products_json", f"""WITH {SCORED}, b AS (SELECT * FROM scored ORDER BY topk_score DESC, product_id LIMIT 10)
SELECT '[' || string_agg('{{"nom":"' || nom || '","categorie":"' || categorie || '","prix":' || prix || ',"rating":' || rating
|| ',"nb_reviews":' || nb_reviews || '}}', ',' ORDER BY topk_score DESC, product_id) || ']' AS records FROM b""")
def top_products_json(spark, sf):
    """The ten best products as one JSON array (bounded by the report size)."""
    return reports.json_array(topk.rank_top(scored(spark, sf), 10), CARD, "rank")


@query("source_budget", f"""WITH {PRODUCTS}, c AS (SELECT marque_vendeur AS store, sous_categorie AS cat_ord, COUNT(*) AS n
FROM products GROUP BY ALL)
SELECT * FROM (SELECT *, CAST(coalesce(SUM(n) OVER (PARTITION BY store ORDER BY cat_ord
ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS seen_before FROM c) WHERE seen_before < 8""")
def source_budget(spark, sf):
    counts = products(spark, sf).groupBy(
        F.col("marque_vendeur").alias("store"), F.col("sous_categorie").alias("cat_ord")).agg(F.count("*").alias("n"))
    return topk.source_budget(counts, 8)
