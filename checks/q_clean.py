"""Scans, sinks, cleaning and feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import pricing
from vitrine.functions.numeric import half_even
from vitrine.operators import clean, features
from vitrine.operators.scaling import MinMax, scale_minmax, zscore_columns

from .fixtures import products, products_dirty, table
from .oracle_views import DIRTY, PRODUCTS, np_round
from .registry import query

NUM = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _num(c):
    return f"CASE WHEN regexp_matches({c}, '{NUM}') THEN CAST(trim({c}) AS DOUBLE) END"


FIRST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ingest_seq) AS rn FROM {src}) WHERE rn = 1"
MED = ["prix", "prix_promo", "rating", "nb_reviews", "quantite_stock", "delai_livraison_j"]

COERCED = DIRTY + f""", uniq AS MATERIALIZED ({FIRST.format(key='product_id', src='products_dirty')}),
num AS MATERIALIZED (SELECT * REPLACE ({', '.join(f'{_num(c)} AS {c}' for c in MED)}) FROM uniq),
med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in MED)} FROM num),
imp AS MATERIALIZED (SELECT num.* REPLACE ({', '.join(f'coalesce({c}, m_{c}) AS {c}' for c in MED)}) FROM num, med)"""

CLEANED = COERCED + """, edge AS (SELECT quantile_cont(prix, 0.01) AS lo, quantile_cont(prix, 0.99) AS hi FROM imp),
cleaned AS MATERIALIZED (SELECT imp.* REPLACE (
  coalesce(categorie, 'Inconnu') AS categorie, coalesce(pays_shop, 'Inconnu') AS pays_shop,
  least(greatest(prix, lo), hi) AS prix, least(greatest(rating, 0e0), 5e0) AS rating,
  greatest(nb_reviews, 0e0) AS nb_reviews) FROM imp, edge)"""

SEGMENT = """CASE WHEN prix IS NULL OR NOT prix > 0 THEN NULL WHEN prix <= 20 THEN 'Très_bas'
  WHEN prix <= 50 THEN 'Bas' WHEN prix <= 100 THEN 'Moyen' WHEN prix <= 200 THEN 'Haut' ELSE 'Premium' END"""
RATIO = f"CASE WHEN prix > 0 THEN {np_round('(prix - prix_promo) / prix', 3)} ELSE 0e0 END"
ENGAGE = np_round("rating * ln(1e0 + nb_reviews)", 3)
STOCK = f"CASE WHEN en_stock = 1 THEN {np_round('ln(1e0 + quantite_stock) / 1e1', 3)} ELSE 0e0 END"


def _enc(c):
    return f"CAST(dense_rank() OVER (ORDER BY coalesce({c}, 'nan')) - 1 AS INTEGER) AS {c}_enc"


FEATURED = CLEANED + f""", derived AS MATERIALIZED (SELECT *, {RATIO} AS ratio_remise, {SEGMENT} AS segment_prix,
  {ENGAGE} AS engagement, {STOCK} AS score_stock FROM cleaned),
featured AS MATERIALIZED (SELECT *, {_enc('categorie')}, {_enc('plateforme')}, {_enc('pays_shop')}, {_enc('segment_prix')}
  FROM derived)"""

CLEAN_COLS = ["product_id", "nom", "categorie", "pays_shop", *MED]


def _rounded(df, cols, digits=4):
    return df.withColumns({c: half_even(F.col(c), digits) for c in cols})


def _rsql(cols, digits=4):
    return ", ".join(f"{np_round(c, digits)} AS {c}" for c in cols)


@query("dedup_product_id", f"WITH {DIRTY} SELECT product_id, ingest_seq, prix FROM "
       f"({FIRST.format(key='product_id', src='products_dirty')})")
def dedup_product_id(spark, sf):
    df = products_dirty(spark, sf)
    return clean.keep_first(df.select("product_id", "ingest_seq", "prix"), ["product_id"], ["ingest_seq"])


FIRST_URL = f"""a AS ({FIRST.format(key='url', src="(SELECT * FROM products_dirty WHERE url <> '')")}),
b AS (SELECT * EXCLUDE (rn) FROM a UNION ALL BY NAME SELECT * FROM products_dirty WHERE coalesce(url, '') = '')"""
TWO_STAGES = ("product_id", "ingest_seq", "url", "nom", "marque_vendeur")


@query("dedup_url_then_name_shop", f"""WITH {DIRTY}, {FIRST_URL} SELECT {', '.join(TWO_STAGES)} FROM
({FIRST.format(key='nom, marque_vendeur', src='b')})""")
def dedup_url_then_name_shop(spark, sf):
    return clean.dedup_url_then_name_shop(products_dirty(spark, sf).select(*TWO_STAGES), ["ingest_seq"])


@query("dedup_url_then_name_shop_strict", f"""WITH {DIRTY}, a AS ({FIRST.format(key='url', src='products_dirty')}),
b AS (SELECT * EXCLUDE (rn) FROM a) SELECT {', '.join(TWO_STAGES)} FROM ({FIRST.format(key='nom, marque_vendeur', src='b')})""")
def dedup_url_then_name_shop_strict(spark, sf):
    """The blank url as one ordinary key."""
    df = products_dirty(spark, sf).select(*TWO_STAGES)
    return clean.dedup_url_then_name_shop(df, ["ingest_seq"], strict=True)


@query("dedup_union_url", f"""WITH {DIRTY} SELECT product_id, ingest_seq, url FROM products_dirty WHERE url = ''
UNION ALL SELECT product_id, ingest_seq, url FROM
({FIRST.format(key='url', src="(SELECT * FROM products_dirty WHERE url <> '')")})""")
def dedup_union_url(spark, sf):
    df = products_dirty(spark, sf).select("product_id", "ingest_seq", "url")
    return clean.dedup_by_url(df, ["ingest_seq"])


@query("dedup_union_url_strict", f"""WITH {DIRTY} SELECT product_id, ingest_seq, url FROM
({FIRST.format(key='url', src='products_dirty')})""")
def dedup_union_url_strict(spark, sf):
    df = products_dirty(spark, sf).select("product_id", "ingest_seq", "url")
    return clean.dedup_by_url(df, ["ingest_seq"], strict=True)


@query("dedup_report", f"""WITH {DIRTY} SELECT COUNT(*) AS rows_before, COUNT(DISTINCT product_id) AS rows_after,
COUNT(*) - COUNT(DISTINCT product_id) AS rows_removed FROM products_dirty""")
def dedup_report(spark, sf):
    rows = clean.dedup_report(products_dirty(spark, sf), ["product_id"])
    return rows


@query("coerce_numeric", f"""WITH {DIRTY} SELECT product_id, ingest_seq,
{', '.join(f'{_num(c)} AS {c}' for c in MED)} FROM products_dirty""")
def coerce_numeric(spark, sf):
    df = products_dirty(spark, sf).select("product_id", "ingest_seq", *MED)
    return clean.coerce_numeric(df, MED)


@query("impute_median", f"WITH {COERCED} SELECT product_id, {_rsql(MED)} FROM imp")
def impute_median(spark, sf):
    df = clean.keep_first(products_dirty(spark, sf), ["product_id"], ["ingest_seq"])
    df = clean.impute_median(clean.coerce_numeric(df, MED), MED)
    return _rounded(df.select("product_id", *MED), MED)


@query("impute_constant", f"""WITH {DIRTY} SELECT product_id, ingest_seq, coalesce(categorie, 'Inconnu') AS categorie,
coalesce(pays_shop, 'Inconnu') AS pays_shop FROM products_dirty""")
def impute_constant(spark, sf):
    df = products_dirty(spark, sf).select("product_id", "ingest_seq", "categorie", "pays_shop")
    return clean.impute_constant(df, clean.LABEL_COLUMNS, clean.UNKNOWN)


@query("winsorize_price", f"""WITH {PRODUCTS}, e AS (SELECT quantile_cont(prix, 0.01) AS lo,
quantile_cont(prix, 0.99) AS hi FROM products)
SELECT product_id, {np_round('least(greatest(prix, lo), hi)', 4)} AS prix FROM products, e""")
def winsorize_price(spark, sf):
    return _rounded(clean.winsorize(products(spark, sf).select("product_id", "prix")), ["prix"])


@query("clip_ranges", f"""WITH {DIRTY} SELECT product_id, ingest_seq, least(greatest({_num('rating')}, 0e0), 5e0) AS rating,
greatest({_num('nb_reviews')}, 0e0) AS nb_reviews FROM products_dirty WHERE rating IS NOT NULL
UNION ALL SELECT product_id, ingest_seq, NULL, greatest({_num('nb_reviews')}, 0e0) FROM products_dirty WHERE rating IS NULL""")
def clip_ranges(spark, sf):
    df = products_dirty(spark, sf).select("product_id", "ingest_seq", "rating", "nb_reviews")
    df = clean.coerce_numeric(df, ["rating", "nb_reviews"])
    return clean.clip_ranges(df, {"rating": (0, 5), "nb_reviews": (0, None)})


@query("clean_products", f"WITH {CLEANED} SELECT product_id, nom, categorie, pays_shop, {_rsql(MED)} FROM cleaned")
def clean_products(spark, sf):
    df = clean.clean_products(products_dirty(spark, sf), ["ingest_seq"])
    return _rounded(df.select(*CLEAN_COLS), MED)


@query("clean_consolidated", f"""WITH {DIRTY}, {FIRST_URL}, c AS ({FIRST.format(key='nom, marque_vendeur', src='b')})
SELECT product_id, coalesce({_num('prix')}, 0e0) AS prix, coalesce({_num('rating')}, 0e0) AS rating,
CAST(trunc(coalesce({_num('nb_reviews')}, 0e0)) AS INTEGER) AS nb_reviews FROM c""")
def clean_consolidated(spark, sf):
    df = clean.clean_consolidated(products_dirty(spark, sf), ["ingest_seq"])
    return df.select("product_id", "prix", "rating", "nb_reviews")


@query("clean_dashboard", f"""WITH {DIRTY} SELECT product_id, ingest_seq, coalesce({_num('prix')}, 0e0) AS prix,
least(greatest(coalesce({_num('rating')}, 0e0), 0e0), 5e0) AS rating,
CAST(trunc(coalesce({_num('nb_reviews')}, 0e0)) AS INTEGER) AS nb_reviews, en_stock FROM products_dirty""")
def clean_dashboard(spark, sf):
    df = clean.clean_dashboard(products_dirty(spark, sf))
    return df.select("product_id", "ingest_seq", "prix", "rating", "nb_reviews", "en_stock")


STAGED = [c for c in MED if c != "prix_promo"]


@query("clean_staged", f"WITH {COERCED} SELECT product_id, {_rsql(STAGED)} FROM imp")
def clean_staged(spark, sf):
    df = clean.clean_staged(products_dirty(spark, sf), ["ingest_seq"])
    return _rounded(df.select("product_id", *STAGED), STAGED)


@query("feat_discount_ratio", f"""WITH {PRODUCTS} SELECT product_id, {RATIO} AS ratio_remise,
{np_round('(prix - prix_promo) / CASE WHEN prix = 0 THEN 1e0 ELSE prix END', 3)} AS ratio_unit FROM products""")
def feat_discount_ratio(spark, sf):
    p, q = F.col("prix"), F.col("prix_promo")
    return products(spark, sf).select("product_id", pricing.discount_ratio(p, q).alias("ratio_remise"),
                                      pricing.discount_ratio_unit(p, q).alias("ratio_unit"))


@query("feat_price_segment", f"WITH {PRODUCTS} SELECT product_id, {SEGMENT} AS segment_prix FROM products")
def feat_price_segment(spark, sf):
    return products(spark, sf).select("product_id", pricing.price_segment(F.col("prix")).alias("segment_prix"))


@query("feat_engagement", f"WITH {PRODUCTS} SELECT product_id, {ENGAGE} AS engagement FROM products")
def feat_engagement(spark, sf):
    value = half_even(pricing.engagement(F.col("rating"), F.col("nb_reviews")), 3)
    return products(spark, sf).select("product_id", value.alias("engagement"))


@query("feat_stock_score", f"WITH {PRODUCTS} SELECT product_id, {STOCK} AS score_stock FROM products")
def feat_stock_score(spark, sf):
    return products(spark, sf).select(
        "product_id", pricing.stock_score(F.col("en_stock"), F.col("quantite_stock")).alias("score_stock"))


ENC = ["categorie", "plateforme", "pays_shop"]


@query("encode_labels", f"WITH {DIRTY} SELECT product_id, ingest_seq, {', '.join(_enc(c) for c in ENC)} FROM products_dirty")
def encode_labels(spark, sf):
    df = features.encode_labels(products_dirty(spark, sf), ENC)
    return df.select("product_id", "ingest_seq", *[f"{c}_enc" for c in ENC])


@query("encode_wide_labels", f"""WITH {PRODUCTS} SELECT product_id,
CAST(dense_rank() OVER (ORDER BY url) - 1 AS INTEGER) AS url_code FROM products""")
def encode_wide_labels(spark, sf):
    """Rank encoding of a column with as many values as rows (range partitioned route)."""
    from vitrine.operators.ordering import value_codes
    df = products(spark, sf).select("product_id", "url")
    codes = value_codes(df, ["url"])
    return df.join(codes, df["url"] == codes["value"]).select("product_id", F.col("code").alias("url_code"))


@query("feature_engineering", f"""WITH {FEATURED} SELECT product_id, ratio_remise, segment_prix, engagement, score_stock,
categorie_enc, plateforme_enc, pays_shop_enc, segment_prix_enc FROM featured""")
def feature_engineering(spark, sf):
    df = clean.clean_products(products_dirty(spark, sf), ["ingest_seq"])
    return features.feature_engineering(df).select(
        "product_id", "ratio_remise", "segment_prix", "engagement", "score_stock",
        "categorie_enc", "plateforme_enc", "pays_shop_enc", "segment_prix_enc")


ML = features.FEATURE_PRESETS["staged"]


@query("ml_features", f"""WITH {PRODUCTS}, e AS (SELECT *, {ENGAGE} AS engagement, {', '.join(_enc(c) for c in ENC)}
FROM products) SELECT product_id, {', '.join(f'coalesce(CAST({c} AS DOUBLE), 0e0) AS {c}' for c in ML)} FROM e""")
def ml_features(spark, sf):
    df = features.staged_features(products(spark, sf))
    return features.model_frame(df, "staged")[0]


SC = ["prix", "rating", "nb_reviews", "quantite_stock", "delai_livraison_j", "engagement"]


def _mm(c):
    return (f"({c} - min({c}) OVER ()) / (CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 1e0 "
            f"ELSE max({c}) OVER () - min({c}) OVER () END)")


@query("scale_minmax", f"""WITH {PRODUCTS}, e AS (SELECT product_id, prix, rating, CAST(nb_reviews AS DOUBLE) AS nb_reviews,
CAST(quantite_stock AS DOUBLE) AS quantite_stock, CAST(delai_livraison_j AS DOUBLE) AS delai_livraison_j,
{ENGAGE} AS engagement FROM products)
SELECT product_id, {', '.join(f'{np_round(_mm(c), 6)} AS {c}' for c in SC)} FROM e""")
def scale_minmax_query(spark, sf):
    df = products(spark, sf).withColumn(
        "engagement", half_even(pricing.engagement(F.col("rating"), F.col("nb_reviews")), 3))
    return _rounded(scale_minmax(df, SC).select("product_id", *SC), SC, 6)


@query("scale_log_minmax", f"""WITH {PRODUCTS}, e AS (SELECT product_id, ln(1e0 + nb_reviews) AS r, prix FROM products)
SELECT product_id, {np_round(_mm('r'), 6)} AS reviews_n, {np_round('1e0 - ' + _mm('prix'), 6)} AS prix_inv_n FROM e""")
def scale_log_minmax(spark, sf):
    df = products(spark, sf)
    scaled = MinMax(df, {"r": F.log1p(F.col("nb_reviews").cast("double")), "p": F.col("prix")})
    return scaled.frame.select("product_id", half_even(scaled["r"], 6).alias("reviews_n"),
                     half_even(F.lit(1.0) - scaled["p"], 6).alias("prix_inv_n"))


CL = ["prix", "rating", "nb_reviews", "quantite_stock", "delai_livraison_j", "remise_pct"]


@query("scale_zscore", f"""WITH {PRODUCTS} SELECT product_id, {', '.join(
    np_round(f'({c} - avg({c}) OVER ()) / (stddev_pop({c}) OVER ())', 4) + f' AS z_{c}' for c in CL)} FROM products""")
def scale_zscore(spark, sf):
    df = zscore_columns(products(spark, sf), CL)
    return _rounded(df.select("product_id", *[f"z_{c}" for c in CL]), [f"z_{c}" for c in CL])
