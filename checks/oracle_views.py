"""SQL text of the derived views, for the oracle side."""

PRODUCTS = """
sales AS (
  SELECT li.*, o.o_orderdate FROM lineitem li JOIN orders o ON li.l_orderkey = o.o_orderkey
), sellers AS (
  SELECT l_partkey AS k, l_suppkey AS seller FROM (
    SELECT l_partkey, l_suppkey, row_number() OVER (
      PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey) AS rn FROM sales)
  WHERE rn = 1
), facts AS (
  SELECT l_partkey, COUNT(*) AS n,
    SUM(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS kept,
    MIN(l_extendedprice) AS low_price,
    SUM(CAST(ROUND(l_discount * 100) AS INT)) AS discount_points,
    SUM(CASE WHEN l_shipdate >= TIMESTAMP '2001-01-01' THEN l_quantity ELSE 0 END) AS quantity,
    MIN(date_diff('day', o_orderdate, l_shipdate)) AS days,
    MIN(o_orderdate) AS listed,
    MIN(CASE WHEN l_discount >= 0.09 THEN l_shipdate END) AS promoted
  FROM sales GROUP BY l_partkey
), priced AS (
  SELECT *, FLOOR(low_price) / 1e2 AS prix,
    FLOOR(CAST(discount_points AS DOUBLE) * 1e1 / n) / 1e1 AS remise_pct FROM facts
), products AS MATERIALIZED (
  SELECT p_partkey AS product_id, p_name AS nom, p_type AS categorie, p_brand AS sous_categorie,
    s_name AS marque_vendeur, n_name AS pays_shop,
    CASE WHEN n_regionkey IN (0, 1) THEN 'Shopify' ELSE 'WooCommerce' END AS plateforme,
    prix, round_even(prix * (1e0 - remise_pct / 1e2) * 1e2, 0) / 1e2 AS prix_promo, remise_pct,
    FLOOR(CAST(kept AS DOUBLE) * 5e1 / n) / 1e1 AS rating, CAST(n AS INTEGER) AS nb_reviews,
    CASE WHEN quantity > 0 THEN 1 ELSE 0 END AS en_stock, CAST(quantity AS INTEGER) AS quantite_stock,
    CAST(ABS(days) % 14 + 1 AS INTEGER) AS delai_livraison_j,
    split_part(p_name, ' ', 1) AS couleur,
    CASE WHEN p_size <= 12 THEN 'S' WHEN p_size <= 25 THEN 'M' WHEN p_size <= 38 THEN 'L' ELSE 'XL' END AS taille,
    CAST(listed AS DATE) AS date_mise_en_ligne, CAST(promoted AS DATE) AS date_promotion,
    'http://' || lower(s_name) || '/' || p_partkey AS url, replace(p_name, ' ', ', ') AS tags
  FROM priced JOIN part ON l_partkey = p_partkey JOIN sellers ON k = l_partkey
    JOIN supplier ON s_suppkey = seller JOIN nation ON n_nationkey = s_nationkey
)"""

DIRTY = PRODUCTS + """, products_dirty AS MATERIALIZED (
  SELECT product_id, ingest_seq, nom, CASE WHEN product_id % 19 <> 0 THEN categorie END AS categorie,
    marque_vendeur, CASE WHEN product_id % 23 <> 0 THEN pays_shop END AS pays_shop, plateforme, couleur, taille,
    CASE WHEN product_id % 17 = 0 THEN 'n/a' ELSE CAST(prix AS VARCHAR) END AS prix,
    CAST(prix_promo AS VARCHAR) AS prix_promo, remise_pct,
    CASE WHEN product_id % 29 = 0 THEN '7.5' WHEN product_id % 31 = 0 THEN '-1'
         WHEN product_id % 13 <> 0 THEN CAST(rating AS VARCHAR) END AS rating,
    CASE WHEN product_id % 37 = 0 THEN '-3' ELSE CAST(nb_reviews AS VARCHAR) END AS nb_reviews,
    en_stock, CAST(quantite_stock AS VARCHAR) AS quantite_stock,
    CAST(delai_livraison_j AS VARCHAR) AS delai_livraison_j,
    CASE WHEN product_id % 41 = 0 THEN '' WHEN product_id % 40 < 2
         THEN 'http://shop/' || (product_id - product_id % 2) ELSE url END AS url, tags
  FROM (SELECT *, product_id AS ingest_seq FROM products
        UNION ALL BY NAME
        SELECT * REPLACE (prix + 1e0 AS prix), product_id + 1000000 AS ingest_seq
        FROM products WHERE product_id % 10 = 0)
)"""


def np_round(expr: str, digits: int) -> str:
    """Half-even rounding of the scaled double."""
    return f"(round_even(({expr}) * 1e{digits}, 0) / 1e{digits})"


def mean(expr: str) -> str:
    """Mean over a fixed-point sum."""
    return f"(CAST(SUM(CAST({expr} AS DECIMAL(18,6))) AS DOUBLE) / COUNT({expr}))"


def scored_view(source: str, name: str, weights=(0.35, 0.25, 0.15, 0.15, 0.10), engagement: str | None = None) -> str:
    """CTE ``name``: ``source`` plus ``engagement`` (unless given) and ``topk_score``."""
    e = engagement or "rating * ln(1e0 + nb_reviews)"
    wr, wn, ws, wp, we = (f"{w}::DOUBLE" for w in weights)

    def mm(x):
        return (f"(({x}) - min({x}) OVER ()) / (CASE WHEN max({x}) OVER () = min({x}) OVER () THEN 1e0 "
                f"ELSE max({x}) OVER () - min({x}) OVER () END)")

    score = (f"{wr} * ({mm('rating')}) + {wn} * ({mm('ln(1e0 + nb_reviews)')}) + {ws} * CAST(en_stock AS DOUBLE)"
             f" + {wp} * (1e0 - ({mm('prix')})) + {we} * ({mm('engagement')})")
    return (f"{name} AS MATERIALIZED (SELECT *, {np_round(score, 4)} AS topk_score "
            f"FROM (SELECT *, {e} AS engagement FROM {source}))")
