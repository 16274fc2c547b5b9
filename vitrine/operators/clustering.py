"""Segmentation: k-means, Ward hierarchy, naming, profiles, PCA, elbow."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import half_even, steady_mean
from ..session import store_table
from .cluster_metrics import davies_bouldin, silhouette, silhouette_squared
from .coreset import Centres, fit_many, silhouettes, summary
from .features import assemble
from .scaling import zscore_columns
from .ward import LEAVES, Ward

# Clustering features, and the names of three segments by price.
CLUSTER_FEATURES = ["prix", "rating", "nb_reviews", "quantite_stock", "delai_livraison_j", "remise_pct"]
DASHBOARD_FEATURES = ["prix", "rating", "nb_reviews", "quantite_stock", "delai_livraison_j"]
SEGMENT_NAMES = ["Discount", "Populaire", "Premium"]
LLOYD_STEPS = 50


def feature_matrix(df: DataFrame, features: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Rows with z-scored columns and a vector; returns the scaled column names."""
    names = [c for c in (features or CLUSTER_FEATURES) if c in df.columns]
    scaled = [f"z_{c}" for c in names]
    return assemble(zscore_columns(df, names), scaled), scaled


def best_kmeans(matrix: DataFrame, k: int, restarts: int = 10, seed: int = 42, leaves: int = LEAVES) -> Centres:
    """Centres with the lowest inertia among ``restarts``.

    Restarts run on the clustering features of all rows; the best is then moved by Lloyd's step over all rows until
    its inertia no longer falls. An empty matrix is refused.
    """
    weights, centroids = summary(matrix, leaves)
    if not len(weights):
        raise ValueError("no rows to cluster")
    points = matrix.select(vector_to_array("features").alias("x"))
    last = fit_many(points, weights, centroids, [k], restarts, seed, LLOYD_STEPS)
    return Centres(last.centres[0], last.inertia()[0])


def kmeans_segments(matrix: DataFrame, k: int = 3, restarts: int = 10, seed: int = 42):
    """Matrix rows with ``cluster_kmeans`` and ``cluster_label``, plus the fitted centres."""
    matrix = store_table(matrix, "matrix")
    model = best_kmeans(matrix, k, restarts, seed)
    return name_clusters(model.transform(matrix, "cluster_kmeans"), "cluster_kmeans", k), model


def name_clusters(df: DataFrame, cluster: str = "cluster_kmeans", k: int = 3, price: str = "prix") -> DataFrame:
    """Add ``cluster_label``: three clusters are named by ascending mean price, others by id.

    The planner broadcasts the table of names by its size.
    """
    if k != len(SEGMENT_NAMES):
        return df.withColumn("cluster_label", F.col(cluster).cast("string"))
    means = df.groupBy(F.col(cluster).alias("id__")).agg(steady_mean(F.col(price)).alias("mean__"))
    rank = F.row_number().over(Window.orderBy("mean__", "id__"))
    named = means.select("id__", F.try_element_at(F.array(*[F.lit(n) for n in SEGMENT_NAMES]), rank).alias("name__"))
    joined = df.join(named, F.col(cluster) == F.col("id__"), "left")
    label = F.coalesce(F.col("name__"), F.col(cluster).cast("string"))
    return joined.withColumn("cluster_label", label).drop("id__", "name__")


def cluster_profile(df: DataFrame, cluster: str, features: list[str] | None = None) -> DataFrame:
    """Mean of every feature (and of the label if present) per cluster, 2 places."""
    names = [c for c in (features or CLUSTER_FEATURES) if c in df.columns]
    if "top_produit" in df.columns:
        names = [*names, "top_produit"]
    return df.groupBy(cluster).agg(*[half_even(steady_mean(F.col(c)), 2).alias(c) for c in names])


def elbow(matrix: DataFrame, scaled: list[str], k_max: int = 10, restarts: int = 10, seed: int = 42,
          exact: bool = False, key: str = "product_id", leaves: int = LEAVES, steps: int = 2) -> DataFrame:
    """Inertia and silhouette for k = 2..k_max, both over all rows.

    The rows are read once for their clustering features, on which all restarts of all k run, then once for each of
    at most ``steps`` Lloyd steps and twice to measure; every pass serves all k. The silhouette is the linear-time
    squared one unless ``exact`` asks for the Euclidean one, whose cost is quadratic. No rows give an empty table.
    """
    spark, schema = matrix.sparkSession, "k int, inertia double, silhouette double"
    matrix = store_table(matrix, "matrix")
    weights, centroids = summary(matrix, leaves)
    if not len(weights):
        return spark.createDataFrame([], schema)
    points, ks = matrix.select(vector_to_array("features").alias("x")), list(range(2, k_max + 1))
    last = fit_many(points, weights, centroids, ks, restarts, seed, steps)
    if exact:
        scores = [silhouette(Centres(c, i).transform(matrix), key, "cluster", scaled).first()[0]
                  for c, i in zip(last.centres, last.inertia())]
    else:
        scores = [round(s, 6) for s in silhouettes(points, last)]
    return spark.createDataFrame(list(zip(ks, last.inertia(), scores)), schema)


def hierarchical_segments(matrix: DataFrame, k: int = 3, leaves: int = LEAVES) -> DataFrame:
    """Bottom-up hierarchy (Ward) over all rows, cut into ``k`` clusters: ``cluster_hierarch``."""
    return Ward(matrix, leaves).label(matrix, k)


def pca_2d(matrix: DataFrame, scaled: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with ``PC1``, ``PC2``, and the table of loadings and variance shares.

    The sign is fixed so that the largest loading of a component is positive.
    """
    model = PCA(k=2, inputCol="features", outputCol="pc__").fit(matrix)
    loadings, shares = model.pc.toArray(), model.explainedVariance.toArray()
    signs = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(2)]
    pc = vector_to_array("pc__")
    rows = model.transform(matrix).withColumns({
        "PC1": pc[0] * F.lit(signs[0]), "PC2": pc[1] * F.lit(signs[1])}).drop("pc__")
    table = matrix.sparkSession.createDataFrame(
        [(f"PC{j + 1}", name, float(signs[j] * loadings[i, j]), float(shares[j]))
         for j in range(2) for i, name in enumerate(scaled)],
        "component string, feature string, loading double, variance_share double")
    return rows, table


def evaluate_clusters(labelled: DataFrame, cluster: str, scaled: list[str]) -> DataFrame:
    """One row: squared silhouette and Davies-Bouldin index."""
    index = davies_bouldin(labelled, cluster, scaled).scalar()
    return silhouette_squared(labelled, cluster, scaled).withColumn("davies_bouldin", index)
