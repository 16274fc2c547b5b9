"""Composed flows: reports, consolidation, ingestion and analysis."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from py4j.protocol import Py4JError

from ..operators import classify, clean, clustering, features, reports, rules, scoring, topk
from .. import schemas
from ..operators.dbscan import anomaly_summary, dbscan
from ..operators.preparation import CataloguePreparation
from ..session import drop_replaced, store_table
from ..sources.tables import union_sources, write_table


def topk_report(df: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """Global, per-category and per-shop selections plus statistics of one score."""
    scored = store_table(scoring.topk_score(df), "scored")
    return {
        "global": topk.rank_top(scored, k),
        "by_category": topk.rank_top_by(scored, "categorie", 5, "rank_in_category"),
        "by_shop": topk.rank_top_by(scored, "marque_vendeur", 1, "rank_in_shop"),
        "stats": reports.catalog_stats(scored, k),
    }


def number_sources(sources: list[DataFrame]) -> list[DataFrame]:
    """Tag every source with its place in the list, so "first" has a meaning after a union."""
    return [s.withColumn("source_no", F.lit(i)) for i, s in enumerate(sources)]


def consolidate(sources: list[DataFrame], order: list[str], sink: str | None = None) -> DataFrame:
    """Union of accepted records, two-stage dedup, types; optional CSV sink.

    Order of precedence: source list position, then ``order`` within a source.
    """
    merged = union_sources(*number_sources(sources))
    result = clean.clean_consolidated(merged, ["source_no", *order])
    return rules.with_sink(result, sink)


OPENED, FAILED = "read", "failed"
SOURCE_REPORT = "source_no int, name string, status string, n_rows long, fault string"


def open_sources(spark: SparkSession, openers: dict[str, Callable[[], DataFrame]]) -> tuple[list[DataFrame], DataFrame]:
    """Each source read on its own: (stored frames, report of one row a source).

    An opener gives the source's accepted rows. Opening and reading both happen here, and what is read is stored, so a
    missing path, a damaged file or a failing parser costs its own source only. Stored frames carry ``source_no``, their
    place among the openers, whichever of them failed.
    """
    frames, report = [], []
    for place, (name, opener) in enumerate(openers.items()):
        try:
            frame = store_table(opener().withColumn("source_no", F.lit(place)), "source")
        except (PySparkException, Py4JError, OSError, ValueError) as error:
            report.append((place, name, FAILED, None, f"{type(error).__name__}: {str(error).strip().splitlines()[0][:200]}"))
        else:
            frames.append(frame)
            report.append((place, name, OPENED, frame.count(), None))
    return frames, spark.createDataFrame(report, SOURCE_REPORT)


def consolidate_sources(spark: SparkSession, openers: dict[str, Callable[[], DataFrame]], order: list[str],
                        sink: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``consolidate`` over the sources that can be read: (result, report of all sources).

    With no readable source the result is an empty catalogue.
    """
    frames, report = open_sources(spark, openers)
    if not frames:
        empty = spark.createDataFrame([], schemas.PRODUCTS).withColumn("source_no", F.lit(0))
        frames = [empty.withColumns({c: F.lit(None).cast("string") for c in ["url", *order] if c not in empty.columns})]
    result = clean.clean_consolidated(union_sources(*frames), ["source_no", *order])
    return rules.with_sink(result, sink), report


def ingest(sources: list[DataFrame], order: list[str], strict: bool = False,
           sink: str | None = None) -> DataFrame:
    """Union, dedup by url, ratings if absent, score, label; optional CSV sink.

    Rows with and without a url go separate ways, and scoring needs several passes (facts, bounds, quantile) over few
    columns, so parsed rows and deduplicated rows are stored by column instead of parsing the documents again.
    """
    merged = store_table(union_sources(*number_sources(sources)), "merged")
    unique = store_table(clean.dedup_by_url(merged, ["source_no", *order], strict=strict), "unique")
    drop_replaced(merged, unique)
    result = scoring.score_collected(unique)
    return rules.with_sink(result, sink)


@dataclass
class ClusterRun:
    """Rows with every cluster column, and the small tables that describe them."""

    rows: DataFrame
    measure_elbow: Callable[[], DataFrame]
    profile: DataFrame
    quality: DataFrame
    loadings: DataFrame
    anomalies: DataFrame

    @cached_property
    def elbow(self) -> DataFrame:
        """Inertia and silhouette by number of clusters; many models are fitted, when it is first asked for."""
        return self.measure_elbow()


def full_clustering(df: DataFrame, key: str = "product_id", k: int = 3, k_max: int = 10, restarts: int = 10,
                    eps: float = 1.0, min_samples: int = 15) -> ClusterRun:
    """Elbow, k-means, hierarchy, density anomalies and projection of one stored matrix."""
    matrix, scaled = clustering.feature_matrix(df)
    matrix = store_table(matrix, "matrix")
    rows, _ = clustering.kmeans_segments(matrix, k, restarts)
    rows = clustering.hierarchical_segments(rows, k)
    density = dbscan(matrix, key, scaled, eps, min_samples)
    rows, loadings = clustering.pca_2d(rows.join(density.drop("is_core"), key), scaled)
    return ClusterRun(
        rows=rows.drop("features", *scaled), measure_elbow=lambda: clustering.elbow(matrix, scaled, k_max, restarts, key=key),
        profile=clustering.cluster_profile(rows, "cluster_kmeans"),
        quality=clustering.evaluate_clusters(rows, "cluster_kmeans", scaled),
        loadings=loadings, anomalies=anomaly_summary(density))


def preprocess(df: DataFrame, order: list[str]) -> DataFrame:
    """Clean and derive features; kept in executor storage for the later steps."""
    return features.feature_engineering(clean.clean_products(df, order)).persist()


def analyse(df: DataFrame, order: list[str], baskets: tuple[DataFrame, str, str] | None = None,
            steps: tuple[str, ...] = ("topk", "clustering", "classification", "association"),
            **options) -> dict[str, object]:
    """The batch analysis: each named step runs on one preprocessed frame.

    ``baskets`` is (pairs, group column, item column); without it the shops'
    categories are mined. ``options`` holds keyword arguments per step.
    """
    frame = preprocess(df, order)
    result: dict[str, object] = {"frame": frame}
    if "topk" in steps:
        result["topk"] = topk_report(frame, **options.get("topk", {}))
    if "clustering" in steps:
        result["clustering"] = full_clustering(frame, **options.get("clustering", {}))
    if "classification" in steps:
        result["classification"] = classify.run_full_classification(frame, **options.get("classification", {}))
    if "association" in steps:
        pairs, group, item = baskets or (frame, "marque_vendeur", "categorie")
        result["association"] = rules.run_association_analysis(pairs, group, item, **options.get("association", {}))
    return result


def staged(df: DataFrame, order: list[str], k: int = 20, rounds: int = 200,
           model_path: str | None = None) -> dict[str, object]:
    """Prepare once, then select the Top-K and train boosted trees on the same frame.

    ``artefact`` is one pipeline of the fitted preparation and the trees: it takes raw rows, and adds ``prediction`` and
    ``probability``. It is saved below ``model_path`` if one is given.
    """
    unique = clean.keep_first(df, ["product_id"], order)
    preparation = CataloguePreparation().fit(unique)
    frame = preparation.transform(unique).drop("features").persist()
    scored = scoring.topk_score(frame)
    trained, metrics, _ = classify.train_boosted_trees(frame, rounds=rounds, preset="staged", weighted=False)
    artefact = PipelineModel([preparation, *trained.model.stages])
    if model_path:
        classify.save_model(artefact, model_path)
    return {"topk": topk.rank_top(scored, k), "topk_metrics": reports.topk_metrics(scored, k), "model": trained,
            "artefact": artefact, "model_metrics": metrics.select("accuracy", "f1", "auc")}
