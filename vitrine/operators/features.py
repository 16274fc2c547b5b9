"""Feature engineering, label encoding and model feature frames."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import pricing
from ..functions.numeric import half_even
from .ordering import value_codes

# Encoded columns and the three model feature presets.
ENCODED = ["categorie", "plateforme", "pays_shop", "segment_prix"]
FEATURE_PRESETS = {
    "analysis": ["prix", "rating", "nb_reviews", "quantite_stock", "delai_livraison_j", "remise_pct",
                 "engagement", "categorie_enc", "plateforme_enc", "pays_shop_enc"],
    "classification": ["prix", "rating", "nb_reviews", "quantite_stock", "delai_livraison_j", "remise_pct",
                       "en_stock", "categorie_enc", "plateforme_enc", "pays_shop_enc"],
    "staged": ["prix", "rating", "nb_reviews", "quantite_stock", "delai_livraison_j", "remise_pct",
               "en_stock", "categorie_enc", "plateforme_enc", "pays_shop_enc", "engagement"],
}
SCALED = ["prix", "rating", "nb_reviews", "quantite_stock", "delai_livraison_j", "engagement"]
MISSING_LABEL = "nan"


def _label_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING_LABEL))


def label_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Stored table (column, value, code) of the labels of the columns present; none of them gives no rows."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column string, value string, code int")
    return value_codes(df.select(*[_label_text(c).alias(c) for c in present]), present)


def with_codes(df: DataFrame, codes: DataFrame, columns: list[str], unseen: int | None = None) -> DataFrame:
    """Add ``<c>_enc`` out of a table of codes; labels it lacks get ``unseen``."""
    for column in columns:
        one = codes.where(F.col("column") == column).select(
            F.col("value").alias("label__"), F.col("code").alias(f"{column}_enc"))
        df = df.withColumn("text__", _label_text(column)).join(one, F.col("text__") == F.col("label__"), "left")
        df = df.drop("text__", "label__")
    if unseen is not None:
        df = df.fillna(unseen, [f"{c}_enc" for c in columns])
    return df


def encode_labels(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Add ``<c>_enc``: rank of the value among the sorted distinct values.

    A missing value is the literal class ``nan``, as text conversion makes it.
    """
    present = [c for c in (columns or ENCODED) if c in df.columns]
    return with_codes(df, label_codes(df, present), present)


def derive_features(df: DataFrame) -> DataFrame:
    """Discount ratio, price segment, engagement and stock score in one projection."""
    return df.withColumns({
        "ratio_remise": pricing.discount_ratio(F.col("prix"), F.col("prix_promo")),
        "segment_prix": pricing.price_segment(F.col("prix")),
        "engagement": half_even(pricing.engagement(F.col("rating"), F.col("nb_reviews")), 3),
        "score_stock": pricing.stock_score(F.col("en_stock"), F.col("quantite_stock")),
    })


def feature_engineering(df: DataFrame) -> DataFrame:
    return encode_labels(derive_features(df))


def staged_features(df: DataFrame) -> DataFrame:
    """Feature step of the staged flow: engagement, ratio by unit price, encodings."""
    featured = df.withColumns({
        "engagement": half_even(pricing.engagement(F.col("rating"), F.col("nb_reviews")), 3),
        "ratio_remise": pricing.discount_ratio_unit(F.col("prix"), F.col("prix_promo")),
    })
    return encode_labels(featured, ["categorie", "plateforme", "pays_shop"])


def model_frame(df: DataFrame, preset: str = "classification", key: str = "product_id",
                label: str | None = "top_produit") -> tuple[DataFrame, list[str]]:
    """Key, 0-filled features and label of a preset; only columns present are used."""
    names = [c for c in FEATURE_PRESETS[preset] if c in df.columns]
    tail = [F.col(label).cast("double").alias("label")] if label and label in df.columns else []
    frame = df.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names], *tail)
    return frame, names


def assemble(df: DataFrame, names: list[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=names, outputCol=output).transform(df)
