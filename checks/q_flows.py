"""Composed flows."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vitrine.operators import classify, clean, scoring
from vitrine.operators.preparation import CataloguePreparation, CataloguePreparationModel
from vitrine.plans import flows
from vitrine.session import scratch_path

from .fixtures import baskets, products, products_dirty
from .oracle_views import np_round, scored_view
from .q_clean import COERCED, ENGAGE, FEATURED, MED, STAGED, _num, _rounded, _rsql
from . import q_models  # noqa: F401  (registers the rules oracle used below)
from .registry import ORACLES, query

FLOW_SCORED = (FEATURED.replace("derived AS", "derived_0 AS").replace("FROM derived)", "FROM derived_0)")
               + ", " + scored_view("(SELECT * EXCLUDE (engagement), engagement AS e0 FROM featured)", "scored", engagement="e0"))


def labelled_dirty(spark, sf):
    """Damaged catalogue with the fixed label of its undamaged values."""
    label = scoring.fixed_label(products(spark, sf)).select("product_id", "top_produit")
    return products_dirty(spark, sf).join(label, "product_id")


@query("analysis_topk", f"""WITH {FLOW_SCORED} SELECT product_id, prix, rating, topk_score,
CAST(place AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (ORDER BY topk_score DESC, product_id) AS place FROM scored) WHERE place <= 10""")
def analysis_topk(spark, sf):
    """Clean, derive features, select: the Top-K step of the batch analysis."""
    result = flows.analyse(products_dirty(spark, sf), ["ingest_seq"], steps=("topk",))
    return result["topk"]["global"].select("product_id", "prix", "rating", "topk_score", "rank")


@query("full_clustering")
def full_clustering(spark, sf):
    run = flows.full_clustering(products(spark, sf))
    return run.rows.select("product_id", "cluster_kmeans", "cluster_label", "cluster_hierarch", "dbscan_label",
                           "is_anomalie", "PC1", "PC2")


@query("analysis_association", ORACLES["association_analysis"])
def analysis_association(spark, sf):
    pairs = (baskets(spark, sf), "l_orderkey", "item")
    return flows.analyse(products_dirty(spark, sf), ["ingest_seq"], pairs, steps=("association",))["association"]


_STAGED: dict = {}


def staged_run(spark, sf):
    """The staged flow with its artefact saved to the shared folder: (results, path), run once an application and scale."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STAGED:
        path = scratch_path(spark, "staged")
        _STAGED[key] = flows.staged(labelled_dirty(spark, sf), ["ingest_seq"], model_path=path), path
    return _STAGED[key]


@query("staged_flow")
def staged_flow(spark, sf):
    """Staged flow with the model saved to the shared folder; its metric row."""
    result, _ = staged_run(spark, sf)
    left = result["topk_metrics"].select("top_k", "avg_topk_score", "avg_rating_topk", "nb_products_analyzed")
    metrics = result["model_metrics"]
    return left.withColumns({c: metrics.select(c).scalar() for c in metrics.columns})


@query("staged_artifact")
def staged_artifact(spark, sf):
    """Raw catalogue rows, repeated ones included, scored by the saved artefact."""
    _, path = staged_run(spark, sf)
    scored = classify.load_model(path).transform(products_dirty(spark, sf))
    return scored.select("product_id", "ingest_seq", F.col("prediction").cast("int").alias("pred"),
                         vector_to_array("probability")[1].alias("prob"))


STAGED_ENC = ["categorie", "plateforme", "pays_shop"]
PREPARED = COERCED + f""", vocab AS (SELECT DISTINCT c, v FROM (SELECT unnest({STAGED_ENC}) AS c,
  unnest([coalesce(categorie, 'nan'), coalesce(plateforme, 'nan'), coalesce(pays_shop, 'nan')]) AS v FROM uniq)),
codes AS (SELECT c, v, CAST(row_number() OVER (PARTITION BY c ORDER BY v) - 1 AS INTEGER) AS code FROM vocab),
rawnum AS (SELECT * REPLACE ({', '.join(f'{_num(c)} AS {c}' for c in MED)}) FROM products_dirty),
ready AS (SELECT r.* REPLACE ({', '.join(f'coalesce({c}, m_{c}) AS {c}' for c in STAGED)}),
  {', '.join(f"(SELECT code FROM codes WHERE c = '{c}' AND v = coalesce(r.{c}, 'nan')) AS {c}_enc" for c in STAGED_ENC)} FROM rawnum r, med)"""


@query("staged_prepared", f"""WITH {PREPARED} SELECT product_id, ingest_seq, {_rsql(STAGED)}, CASE WHEN nb_reviews > -1 THEN {ENGAGE} END AS engagement,
{', '.join(f'{c}_enc' for c in STAGED_ENC)} FROM ready""")
def staged_prepared(spark, sf):
    """Raw rows through a preparation that was fitted on deduplicated rows, saved and loaded again.

    The staged flow does not clip counts; the engagement of a count below zero is missing.
    """
    raw = products_dirty(spark, sf)
    path = scratch_path(spark, "preparation")
    CataloguePreparation().fit(clean.keep_first(raw, ["product_id"], ["ingest_seq"])).write().save(path)
    ready = CataloguePreparationModel.load(path).transform(raw)
    return _rounded(ready.select("product_id", "ingest_seq", *STAGED, "engagement", *[f"{c}_enc" for c in STAGED_ENC]), STAGED)
