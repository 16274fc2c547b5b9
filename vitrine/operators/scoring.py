"""Composite scores, labels and rating estimation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import noise, pricing
from ..functions.numeric import clip, half_even
from ..functions.text import has_quality_word
from .ordering import quantile_record
from .scaling import MinMax, attach

# Default weights of the composite score.
DEFAULT_WEIGHTS = {"rating": 0.35, "nb_reviews": 0.25, "en_stock": 0.15,
                   "prix_inverse": 0.15, "engagement": 0.10}


def topk_score(df: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Add ``topk_score``. A missing weight counts 0; weights are not renormalised."""
    weights = weights or DEFAULT_WEIGHTS
    if "engagement" not in df.columns:
        df = df.withColumn("engagement", pricing.engagement(F.col("rating"), F.col("nb_reviews")))
    scaled = MinMax(df, {
        "rating": F.col("rating").cast("double"),
        "reviews": F.log1p(F.col("nb_reviews").cast("double")),
        "price": F.col("prix").cast("double"),
        "engagement": F.col("engagement"),
    })
    parts = {
        "rating": scaled["rating"],
        "nb_reviews": scaled["reviews"],
        "en_stock": F.col("en_stock").cast("double"),
        "prix_inverse": F.lit(1.0) - scaled["price"],
        "engagement": scaled["engagement"],
    }
    score = None
    for name, part in parts.items():
        term = F.lit(float(weights.get(name, 0))) * part
        score = term if score is None else score + term
    return scaled.frame.withColumn("topk_score", half_even(score, 4)).drop(scaled.BOUNDS)


def fixed_label(df: DataFrame, with_price: bool = True) -> DataFrame:
    """Label from the unrounded fixed-scale score; the stored score has 4 places."""
    raw = pricing.fixed_attractiveness(F.col("rating"), F.col("nb_reviews"), F.col("en_stock"),
                                       F.col("prix") if with_price else None)
    return df.withColumns({
        "top_produit": (raw >= pricing.FIXED_LABEL_THRESHOLD).cast("int"),
        "score_attractivite": half_even(raw, 4),
    })


def quantile_label(df: DataFrame, score: str, prob: float = 0.6, label: str = "top_produit") -> DataFrame:
    """Label 1 at or above the exact quantile of ``score``."""
    edge = quantile_record(df, {"edge": (score, prob)}).getField("edge")
    return df.withColumn(label, (F.col(score) >= edge).cast("int"))


def collector_score(df: DataFrame) -> DataFrame:
    """Score of freshly collected products, without its label."""
    scaled = MinMax(df, {
        "rating": F.coalesce(F.col("rating").cast("double"), F.lit(0.0)),
        "reviews": F.log1p(F.coalesce(F.col("nb_reviews").cast("double"), F.lit(0.0))),
        "price": F.coalesce(F.col("prix").cast("double"), F.lit(0.0)),
    })
    raw = (F.lit(0.35) * scaled["rating"] + F.lit(0.25) * scaled["reviews"]
           + F.lit(0.15) * F.col("en_stock").cast("double") + F.lit(0.25) * (F.lit(1.0) - scaled["price"]))
    return scaled.frame.withColumn("score_attractivite", half_even(raw, 4)).drop(scaled.BOUNDS)


def _estimated_rating(key: Column, discount: Column, in_stock: Column, tags: Column) -> Column:
    # N(4.1, 0.4) in [2.5, 5]; +U(0.05, 0.2) on discount; -0.3 sold out; +0.15 tag bonus.
    base = clip(noise.normal("rating", key, 4.1, 0.4), 2.5, 5.0)
    promo = F.when(F.coalesce(discount, F.lit(0.0)) > 0,
                   F.lit(0.05) + F.lit(0.15) * noise.uniform("promo", key)).otherwise(F.lit(0.0))
    sold_out = F.when(F.coalesce(in_stock, F.lit(1)) == 0, F.lit(0.3)).otherwise(F.lit(0.0))
    bonus = F.when(has_quality_word(tags), F.lit(0.15)).otherwise(F.lit(0.0))
    return half_even(clip(base + promo - sold_out + bonus, 1.0, 5.0), 1)


def _estimated_reviews(key: Column, price: Column, top_price: Column) -> Column:
    # lognormal(4.5, 1.2) plus 200 times the price share, in [0, 5000].
    share = clip(F.coalesce(price, F.lit(0.0)), 0.0) / (top_price + F.lit(1e-9))
    drawn = F.floor(noise.lognormal("reviews", key, 4.5, 1.2))
    return F.greatest(F.least(drawn + F.floor(share * 200.0), F.lit(5000)), F.lit(0)).cast("int")


def estimate_ratings(df: DataFrame, key: str = "product_id") -> DataFrame:
    """Fill ratings and review counts when no row of the frame has a rating.

    Whether to estimate is decided by one aggregate inside the plan. The noise
    is a function of the key, so it is the same for any partitioning.
    """
    facts = df.agg(F.struct(
        F.coalesce(F.max(F.col("rating").cast("double")), F.lit(0.0)).alias("best"),
        F.max(clip(F.coalesce(F.col("prix").cast("double"), F.lit(0.0)), 0.0)).alias("top_price"),
    ).alias("facts")).scalar()
    known = F.col("facts__")
    unrated = known["best"] == 0
    tags = F.col("tags") if "tags" in df.columns else F.lit("")
    rating = _estimated_rating(F.col(key), F.col("remise_pct"), F.col("en_stock"), tags)
    reviews = _estimated_reviews(F.col(key), F.col("prix"), known["top_price"])
    return attach(df, facts, "facts__").withColumns({
        "rating": F.when(unrated, rating).otherwise(F.col("rating")),
        "nb_reviews": F.when(unrated, reviews).otherwise(F.col("nb_reviews").cast("int")),
    }).drop("facts__")


def score_collected(df: DataFrame) -> DataFrame:
    """Ratings if absent, score, then the label on the rounded score."""
    return quantile_label(collector_score(estimate_ratings(df)), "score_attractivite", 0.6)
