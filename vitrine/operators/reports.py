"""Business aggregates, filters and text reports over a (scored) catalogue."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.numeric import half_even, steady_mean
from ..functions.text import product_line
from ..session import store_table
from .ordering import quantiles
from .topk import rank_top


LONG_CHOICE = 200


@dataclass
class ProductFilter:
    """Interactive filter choices.

    A choice is a list, where an empty one means no restriction, or a one-column frame, where an empty one selects
    nothing. Up to ``LONG_CHOICE`` values are literals of one pushable predicate; longer lists and frames are stored
    and semi-joined, broadcast by their bytes or else shuffled with a Bloom filter where the session allows it.
    """

    categories: list[str] | DataFrame = field(default_factory=list)
    shops: list[str] | DataFrame = field(default_factory=list)
    countries: list[str] | DataFrame = field(default_factory=list)
    platforms: list[str] | DataFrame = field(default_factory=list)
    price_range: tuple[float, float] | None = None
    in_stock_only: bool = False

    def _choices(self) -> list[tuple[str, list[str] | DataFrame]]:
        return [("categorie", self.categories), ("marque_vendeur", self.shops),
                ("pays_shop", self.countries), ("plateforme", self.platforms)]

    def predicate(self) -> Column:
        """The pushable part; scores are not recomputed after filtering."""
        test = F.lit(True)
        for column, chosen in self._choices():
            if not _is_long(chosen) and chosen:
                test = test & F.col(column).isin(chosen)
        if self.price_range is not None:
            test = test & F.col("prix").between(*[float(p) for p in self.price_range])
        if self.in_stock_only:
            test = test & (F.col("en_stock") == 1)
        return test

    def apply(self, df: DataFrame) -> DataFrame:
        df = df.where(self.predicate())
        for column, chosen in self._choices():
            if _is_long(chosen):
                table = chosen if isinstance(chosen, DataFrame) else \
                    df.sparkSession.createDataFrame([(c,) for c in chosen], "choice__ string")
                table = store_table(table.toDF("choice__").distinct(), "choices")
                df = df.join(table, F.col(column) == F.col("choice__"), "left_semi")
        return df


def _is_long(chosen: list[str] | DataFrame) -> bool:
    return isinstance(chosen, DataFrame) or len(chosen) > LONG_CHOICE


def filter_options(df: DataFrame) -> DataFrame:
    """Distinct choices of each filter: rows of (filter, choice)."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("filter"), F.col(c).alias("choice"))
        for c in ("categorie", "marque_vendeur", "pays_shop", "plateforme")])).alias("p"))
    return pairs.select("p.filter", "p.choice").distinct()


def price_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("prix").alias("prix_min"), F.max("prix").alias("prix_max"))


def catalog_stats(scored: DataFrame, k: int = 10) -> DataFrame:
    """Global catalogue statistics with the score range of the k best products."""
    best = rank_top(scored, k).agg(F.struct(
        half_even(F.min("topk_score"), 4).alias("low"),
        half_even(steady_mean(F.col("topk_score")), 4).alias("mean")).alias("best")).scalar()
    return scored.agg(
        F.count("*").alias("nb_produits_total"),
        F.countDistinct("categorie").alias("nb_categories"),
        F.countDistinct("marque_vendeur").alias("nb_shops"),
        half_even(steady_mean(F.col("prix")), 2).alias("prix_moyen"),
        half_even(steady_mean(F.col("rating")), 2).alias("rating_moyen"),
        half_even(steady_mean(F.col("en_stock")) * 100, 1).alias("pct_en_stock"),
    ).withColumns({"top_k_score_min": best.getField("low"), "top_k_score_moyen": best.getField("mean")})


def kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_produits"),
        half_even(steady_mean(F.col("prix")), 2).alias("prix_moyen"),
        half_even(steady_mean(F.col("rating")), 2).alias("note_moyenne"),
        half_even(steady_mean(F.col("en_stock")) * 100, 1).alias("pct_en_stock"),
        F.sum("nb_reviews").alias("total_avis"),
    )


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts per value, most frequent first, ties in value order."""
    counts = df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), column)
    return counts.limit(top) if top else counts


def shop_performance(scored: DataFrame) -> DataFrame:
    return scored.groupBy("marque_vendeur").agg(
        half_even(steady_mean(F.col("topk_score")), 3).alias("score_moyen"),
        F.count("product_id").alias("nb_produits"),
        half_even(steady_mean(F.col("rating")), 3).alias("rating_moyen"),
    ).orderBy(F.col("score_moyen").desc(), "marque_vendeur")


def country_stats(scored: DataFrame) -> DataFrame:
    return scored.groupBy("pays_shop").agg(
        F.count("product_id").alias("nb_produits"), half_even(steady_mean(F.col("topk_score")), 6).alias("score_moyen"))


def shop_competition(df: DataFrame) -> DataFrame:
    """Per-shop statistics; without a score column the rating stands in."""
    score = "topk_score" if "topk_score" in df.columns else "rating"
    return df.groupBy("marque_vendeur").agg(
        F.count("product_id").alias("nb_produits"),
        half_even(steady_mean(F.col("rating")), 2).alias("rating_moyen"),
        half_even(steady_mean(F.col("prix")), 2).alias("prix_moyen"),
        half_even(steady_mean(F.col(score)), 2).alias("score_moyen"),
        F.sum("nb_reviews").alias("total_avis"),
    )


def json_records(df: DataFrame, columns: list[str]) -> DataFrame:
    """One JSON object per row; a JSON-lines sink needs no single array."""
    return df.select(F.to_json(F.struct(*columns)).alias("record"))


def rating_heatmap(df: DataFrame, platforms: list[str] | None = None) -> DataFrame:
    """Mean rating, category by platform; named platforms spare the extra scan."""
    return df.groupBy("categorie").pivot("plateforme", platforms).agg(half_even(steady_mean(F.col("rating")), 2))


def price_boxplot(df: DataFrame) -> DataFrame:
    """Quartiles, whiskers (1.5 IQR) and outlier count of the price per category."""
    table = quantiles(df, ["prix"], [0.25, 0.5, 0.75], by=["categorie"])
    boxes = table.groupBy("categorie").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
        for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fenced = boxes.withColumns({"low_fence": F.col("q1") - reach, "high_fence": F.col("q3") + reach})
    inside = F.col("prix").between(F.col("low_fence"), F.col("high_fence"))
    fenced = store_table(fenced, "boxes")  # one row per category
    return df.select("categorie", "prix").join(fenced, "categorie").groupBy("categorie").agg(
        *[half_even(F.max(c), 4).alias(c) for c in ("q1", "median", "q3")],
        F.min(F.when(inside, F.col("prix"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("prix"))).alias("whisker_high"),
        F.sum((~inside).cast("long")).alias("outliers"),
    )


def best_group(scored: DataFrame, group: str, score: str = "topk_score") -> DataFrame:
    """The group with the highest mean score; ties go to the first key."""
    means = scored.groupBy(group).agg(steady_mean(F.col(score)).alias("mean"))
    best = means.orderBy(F.col("mean").desc(), group).limit(1)
    return best.select(F.lit(group).alias("dimension"), F.col(group).alias("best"),
                       half_even(F.col("mean"), 6).alias("mean_score"))


def top_groups(scored: DataFrame) -> DataFrame:
    return best_group(scored, "categorie").unionByName(best_group(scored, "marque_vendeur"))


def topk_metrics(scored: DataFrame, k: int = 20) -> DataFrame:
    """Product count, k, and the means over the k best products."""
    total = scored.agg(F.count("*")).scalar()
    return rank_top(scored, k).agg(
        F.count("*").alias("top_rows"),
        half_even(steady_mean(F.col("topk_score")), 4).alias("avg_topk_score"),
        half_even(steady_mean(F.col("rating")), 4).alias("avg_rating_topk"),
        half_even(steady_mean(F.col("prix")), 2).alias("avg_price_topk"),
    ).withColumns({"top_k": F.lit(k), "nb_products_analyzed": total})


def market_context(scored: DataFrame, top: int = 10, categories: int = 7) -> DataFrame:
    """Report lines: global statistics, best products, most frequent categories.

    Columns ``section``, ``ord``, ``line``; every part is bounded by design.
    """
    stats = scored.agg(
        F.count("*").cast("string").alias("nb_produits_total"),
        F.format_string("%.2f", half_even(steady_mean(F.col("prix")), 2)).alias("prix_moyen"),
        F.format_string("%.2f", half_even(steady_mean(F.col("rating")), 2)).alias("rating_moyen"),
    )
    names = stats.columns
    facts = stats.select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("ord"), F.concat(F.lit(f"  {n}: "), F.col(n)).alias("line"))
        for i, n in enumerate(names)])).alias("x")).select(F.lit("stats").alias("section"), "x.*")
    best = rank_top(scored, top).select(
        F.lit("top").alias("section"), F.col("rank").alias("ord"),
        product_line(*[F.col(c) for c in ("nom", "categorie", "prix", "rating", "nb_reviews",
                                          "marque_vendeur", "pays_shop")]).alias("line"))
    counts = value_counts(scored, "categorie", categories)
    ranked = rank_top(counts, categories, score="n", key="categorie")
    spread = ranked.select(
        F.lit("categories").alias("section"), F.col("rank").alias("ord"),
        F.concat(F.lit("  "), F.col("categorie"), F.lit(": "), F.col("n").cast("string"),
                 F.lit(" produits")).alias("line"))
    return facts.unionByName(best).unionByName(spread)


# Display names of the ranking table.
TOP_LABELS = {"rank": "Rang", "nom": "Produit", "categorie": "Catégorie", "marque_vendeur": "Shop",
              "pays_shop": "Pays", "prix": "Prix", "rating": "Note", "nb_reviews": "Avis", "topk_score": "Score"}


def display(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Project and rename for display."""
    return df.select(*[F.col(c).alias(label) for c, label in labels.items()])


def json_array(df: DataFrame, columns: list[str], rank: str) -> DataFrame:
    """One JSON array over an already bounded report, in rank order."""
    ordered = F.sort_array(F.collect_list(F.struct(rank, F.struct(*columns).alias("record"))))
    return df.agg(F.to_json(F.transform(ordered, lambda item: item["record"])).alias("records"))
