"""Cleaning: deduplication, coercion, imputation, clipping and presets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import clip, numeric_column, truncate_int
from .ordering import filled_quantile_record, median_record, quantile_record, value_ranks
from .scaling import attach

# Columns imputed with the median / with "Inconnu".
MEDIAN_COLUMNS = ["prix", "prix_promo", "rating", "nb_reviews", "quantite_stock", "delai_livraison_j"]
LABEL_COLUMNS = ["categorie", "marque_vendeur", "pays_shop", "couleur", "taille", "plateforme"]
UNKNOWN = "Inconnu"


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the earliest in ``order``.

    ``row_number() <= 1`` is limited per task before the shuffle, so a key that
    holds a third of all rows sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rn__", F.row_number().over(window)).where("rn__ = 1").drop("rn__")


def dedup_url_then_name_shop(df: DataFrame, order: list[str], shop: str = "marque_vendeur",
                             strict: bool = False) -> DataFrame:
    """First by url, then by (name, shop) among the survivors.

    Rows without a url are not taken for copies of each other unless ``strict``.
    """
    return keep_first(dedup_by_url(df, order, strict), ["nom", shop], order)


def dedup_by_url(df: DataFrame, order: list[str], strict: bool = False) -> DataFrame:
    """Deduplicate a union of sources by url.

    Rows without a url are all kept unless ``strict``, which treats the blank
    url as one ordinary key.
    """
    if strict:
        return keep_first(df, ["url"], order)
    blank = F.coalesce(F.col("url"), F.lit("")) == ""
    return keep_first(df.where(~blank), ["url"], order).unionByName(df.where(blank))


def dedup_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows before, rows after and rows removed by deduplication on ``keys``."""
    distinct = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return distinct.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
        (F.coalesce(F.sum("copies"), F.lit(0)) - F.count("*")).alias("rows_removed"),
    )


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns present become doubles, malformed values NULL."""
    return df.withColumns({c: numeric_column(df, c) for c in columns if c in df.columns})


def impute_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill NULLs with the exact column median (one shared ordering pass)."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    medians = quantile_record(df, {c: (c, 0.5) for c in present})
    return attach(df, medians, "medians__").withColumns(
        {c: F.coalesce(F.col(c), F.col("medians__")[c]) for c in present}).drop("medians__")


def impute_constant(df: DataFrame, columns: list[str], value) -> DataFrame:
    return df.fillna(value, subset=[c for c in columns if c in df.columns])


def winsorize(df: DataFrame, column: str = "prix", low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Clip a column at two of its own exact quantiles."""
    edges = quantile_record(df, {"low": (column, low), "high": (column, high)})
    edge = F.col("edges__")
    clipped = attach(df, edges, "edges__").withColumn(column, clip(F.col(column), edge["low"], edge["high"]))
    return clipped.drop("edges__")


def clip_ranges(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    return df.withColumns({
        c: clip(F.col(c), None if lo is None else float(lo), None if hi is None else float(hi))
        for c, (lo, hi) in bounds.items() if c in df.columns
    })


def clean_products(df: DataFrame, order: list[str]) -> DataFrame:
    """Dedup, coerce, impute, winsorise the price, clip ratings and reviews.

    The price is clipped at quantiles of the *imputed* price. Medians and those
    quantiles come from one ordering pass; the rest is a single projection.
    """
    numeric = coerce_numeric(keep_first(df, ["product_id"], order), MEDIAN_COLUMNS)
    present = [c for c in MEDIAN_COLUMNS if c in numeric.columns]
    ranks = value_ranks(numeric, present)
    medians = median_record(ranks, present)
    edges = filled_quantile_record(ranks, "prix", {"low": 0.01, "high": 0.99}, medians.getField("prix"))
    median, edge = F.col("medians__"), F.col("edges__")
    filled = {c: F.coalesce(F.col(c), median[c]) for c in present}
    filled["prix"] = clip(filled["prix"], edge["low"], edge["high"])
    filled["rating"] = clip(filled["rating"], 0.0, 5.0)
    filled["nb_reviews"] = clip(filled["nb_reviews"], 0.0)
    known = attach(attach(numeric, medians, "medians__"), edges, "edges__")
    cleaned = known.withColumns(filled).drop("medians__", "edges__")
    return impute_constant(cleaned, LABEL_COLUMNS, UNKNOWN)


def clean_consolidated(df: DataFrame, order: list[str]) -> DataFrame:
    """Cleaning of merged store records: two-stage dedup, 0-fill, integer reviews."""
    unique = dedup_url_then_name_shop(df, order)
    return unique.withColumns({
        "prix": F.coalesce(numeric_column(unique, "prix"), F.lit(0.0)),
        "rating": F.coalesce(numeric_column(unique, "rating"), F.lit(0.0)),
        "nb_reviews": truncate_int(numeric_column(unique, "nb_reviews")),
    })


def clean_dashboard(df: DataFrame) -> DataFrame:
    """Light cleaning before interactive use: 0-fill, clip, integer casts, no dedup."""
    return df.withColumns({
        "rating": clip(F.coalesce(numeric_column(df, "rating"), F.lit(0.0)), 0.0, 5.0),
        "nb_reviews": truncate_int(numeric_column(df, "nb_reviews")),
        "prix": F.coalesce(numeric_column(df, "prix"), F.lit(0.0)),
        "en_stock": numeric_column(df, "en_stock").try_cast("int"),
    })


def clean_staged(df: DataFrame, order: list[str]) -> DataFrame:
    """Cleaning of the staged flow: dedup and median fill of five columns, no clipping."""
    columns = [c for c in MEDIAN_COLUMNS if c != "prix_promo"]
    return impute_median(coerce_numeric(keep_first(df, ["product_id"], order), columns), columns)
