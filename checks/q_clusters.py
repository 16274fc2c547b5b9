"""Clustering, density, projection and cluster-metric queries."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from vitrine.functions.numeric import half_even
from vitrine.operators import cluster_metrics, clustering, components, dbscan, features, ward
from vitrine.operators.scaling import zscore_columns

from .fixtures import products, table
from .oracle_views import PRODUCTS, mean, np_round
from .q_clean import SEGMENT
from .registry import query

CL = clustering.CLUSTER_FEATURES
Z = [f"z_{c}" for c in CL]
ZS = PRODUCTS + ", z AS MATERIALIZED (SELECT *, " + ", ".join(
    f"(CAST({c} AS DOUBLE) - avg({c}) OVER ()) / (stddev_pop({c}) OVER ()) AS z_{c}" for c in CL) + f", {SEGMENT} AS segment_prix FROM products)"
DIST2 = " + ".join(f"(a.z_{c} - b.z_{c}) * (a.z_{c} - b.z_{c})" for c in CL)
NEAR = ZS + f""", pairs AS MATERIALIZED (SELECT a.product_id AS p, b.product_id AS q FROM z a JOIN z b ON {DIST2} <= 1e0),
core AS MATERIALIZED (SELECT p FROM pairs GROUP BY p HAVING COUNT(*) >= 15)"""
LABELS = NEAR + """, e AS MATERIALIZED (SELECT p AS a, q AS b FROM pairs WHERE p IN (FROM core) AND q IN (FROM core)),
reach(a, b) AS (SELECT a, a FROM (SELECT DISTINCT a FROM e) UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b),
comp AS (SELECT b AS p, MIN(a) AS c FROM reach GROUP BY b),
numbered AS (SELECT p, dense_rank() OVER (ORDER BY c) - 1 AS label FROM comp),
labels AS (SELECT product_id, CAST(CASE WHEN product_id IN (FROM core) THEN 1 ELSE 0 END AS INTEGER) AS is_core,
  CAST(coalesce((SELECT label FROM numbered n WHERE n.p = product_id),
  (SELECT MIN(label) FROM pairs JOIN numbered n ON n.p = pairs.q WHERE pairs.p = product_id), -1) AS INTEGER) AS dbscan_label FROM products)"""
LABELS = LABELS.replace("WITH", "")


@query("connected_components", """SELECT o_orderkey AS id, min(o_orderkey) OVER (PARTITION BY o_custkey) AS comp FROM orders""")
def connected_components(spark, sf):
    """Each customer's orders form a chain by date, in which order keys lie in no particular order."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    before = F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    edges = orders.select(F.col("o_orderkey").alias("a"), before.alias("b")).where("b is not null")
    return components.connected_components(orders.select(F.col("o_orderkey").alias("id")), edges)


def zframe(spark, sf):
    return zscore_columns(products(spark, sf), CL)


def dense(spark, sf):
    return dbscan.dbscan(zframe(spark, sf), "product_id", Z, eps=1.0, min_samples=15)


@query("dbscan_core", f"WITH {NEAR} SELECT p AS product_id FROM core")
def dbscan_core(spark, sf):
    return dense(spark, sf).where("is_core = 1").select("product_id")


@query("dbscan_labels", f"WITH RECURSIVE {LABELS} SELECT product_id, is_core, dbscan_label FROM labels")
def dbscan_labels(spark, sf):
    return dense(spark, sf).select("product_id", "is_core", "dbscan_label")


@query("dbscan_anomalies", f"""WITH RECURSIVE {LABELS} SELECT l.product_id, nom, categorie, prix, rating, nb_reviews
FROM labels l JOIN products p ON p.product_id = l.product_id WHERE dbscan_label = -1""")
def dbscan_anomalies(spark, sf):
    odd = dense(spark, sf).where("is_anomalie = 1").select("product_id")
    return products(spark, sf).join(odd, "product_id").select("product_id", "nom", "categorie", "prix", "rating", "nb_reviews")


@query("anomaly_summary", f"""WITH RECURSIVE {LABELS} SELECT COUNT(DISTINCT CASE WHEN dbscan_label <> -1 THEN dbscan_label END) AS n_clusters,
CAST(SUM(CASE WHEN dbscan_label = -1 THEN 1 ELSE 0 END) AS BIGINT) AS n_anomalies,
{np_round('SUM(CASE WHEN dbscan_label = -1 THEN 1 ELSE 0 END) * 1e2 / COUNT(*)', 1)} AS pct_anomalies FROM labels""")
def anomaly_summary(spark, sf):
    return dbscan.anomaly_summary(dense(spark, sf))


@query("name_clusters", f"""WITH {PRODUCTS}, g AS (SELECT *, CAST(nb_reviews % 3 AS INTEGER) AS cluster_kmeans FROM products),
r AS (SELECT cluster_kmeans, row_number() OVER (ORDER BY {mean('prix')}, cluster_kmeans) AS rn FROM g GROUP BY cluster_kmeans)
SELECT product_id, g.cluster_kmeans, list_extract(['Discount', 'Populaire', 'Premium'], rn) AS cluster_label FROM g JOIN r USING (cluster_kmeans)""")
def name_clusters(spark, sf):
    df = products(spark, sf).withColumn("cluster_kmeans", F.col("nb_reviews") % 3)
    return clustering.name_clusters(df).select("product_id", "cluster_kmeans", "cluster_label")


@query("cluster_profile", f"WITH {PRODUCTS} SELECT categorie, {', '.join(np_round(mean(c), 2) + f' AS {c}' for c in CL)} FROM products GROUP BY categorie")
def cluster_profile(spark, sf):
    return clustering.cluster_profile(products(spark, sf), "categorie")


CENT = ", ".join(f"AVG(z_{c}) AS c_{c}" for c in CL)
OWN = " + ".join(f"(z.z_{c} - k.c_{c}) * (z.z_{c} - k.c_{c})" for c in CL)
GAP = " + ".join(f"(a.c_{c} - b.c_{c}) * (a.c_{c} - b.c_{c})" for c in CL)


@query("davies_bouldin", f"""WITH {ZS}, k AS (SELECT segment_prix AS g, {CENT} FROM z GROUP BY segment_prix),
s AS (SELECT g, AVG(sqrt({OWN})) AS sc FROM z JOIN k ON k.g = z.segment_prix GROUP BY g),
w AS (SELECT a.g, MAX((sa.sc + sb.sc) / sqrt({GAP})) AS worst FROM k a JOIN k b ON a.g <> b.g JOIN s sa ON sa.g = a.g JOIN s sb ON sb.g = b.g GROUP BY a.g)
SELECT {np_round('AVG(worst)', 6)} AS davies_bouldin FROM w""")
def davies_bouldin(spark, sf):
    return cluster_metrics.davies_bouldin(segmented(spark, sf), "segment_prix", Z)


def segmented(spark, sf):
    from vitrine.functions.pricing import price_segment
    return zframe(spark, sf).withColumn("segment_prix", price_segment(F.col("prix")))


def sil(distance):
    return f"""WITH {ZS}, d AS (SELECT a.product_id AS p, a.segment_prix AS own, b.segment_prix AS g, SUM({distance}) AS total, COUNT(*) AS n
FROM z a JOIN z b ON TRUE GROUP BY ALL),
r AS (SELECT p, MAX(CASE WHEN own = g THEN n END) AS members, MAX(CASE WHEN own = g AND n > 1 THEN total / (n - 1) END) AS a,
MIN(CASE WHEN own <> g THEN total / n END) AS b FROM d GROUP BY p)
SELECT {np_round('AVG(CASE WHEN members <= 1 OR greatest(a, b) = 0 THEN 0e0 ELSE (b - a) / greatest(a, b) END)', 6)} AS silhouette FROM r"""


@query("silhouette_exact", sil(f"sqrt({DIST2})"))
def silhouette_exact(spark, sf):
    return cluster_metrics.silhouette(segmented(spark, sf), "product_id", "segment_prix", Z)


@query("silhouette_sq", sil(DIST2))
def silhouette_sq(spark, sf):
    return cluster_metrics.silhouette_squared(segmented(spark, sf), "segment_prix", Z)


def matrix(spark, sf, names=None):
    return clustering.feature_matrix(products(spark, sf), names)


@query("kmeans_segments")
def kmeans_segments(spark, sf):
    rows, _ = clustering.kmeans_segments(matrix(spark, sf)[0], 3)
    return rows.select("product_id", "cluster_kmeans", "cluster_label")


@query("kmeans_dashboard")
def kmeans_dashboard(spark, sf):
    rows, _ = clustering.kmeans_segments(matrix(spark, sf, clustering.DASHBOARD_FEATURES)[0], 4)
    return clustering.cluster_profile(rows, "cluster_kmeans", clustering.DASHBOARD_FEATURES)


@query("elbow")
def elbow(spark, sf):
    frame, scaled = matrix(spark, sf)
    return clustering.elbow(frame, scaled)


@query("hierarchical_segments")
def hierarchical_segments(spark, sf):
    return clustering.hierarchical_segments(matrix(spark, sf)[0], 3).select("product_id", "cluster_hierarch")


@query("ward_linkage")
def ward_linkage(spark, sf):
    return ward.Ward(matrix(spark, sf)[0]).linkage()


@query("pca_2d")
def pca_2d(spark, sf):
    frame, scaled = matrix(spark, sf)
    return clustering.pca_2d(frame, scaled)[0].select("product_id", "PC1", "PC2")


@query("pca_loadings")
def pca_loadings(spark, sf):
    frame, scaled = matrix(spark, sf)
    return clustering.pca_2d(frame, scaled)[1]
