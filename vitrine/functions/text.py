"""Text column expressions: HTML, tags, titles, URLs and display lines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Tag words that raise an estimated rating.
QUALITY_WORDS = ["best", "top", "award", "popular", "fan fav", "bestseller", "new"]

# Spellings kept by title normalisation.
ABBREVIATIONS = ["USB-C", "USB", "LED", "HD", "TV", "PC"]


def strip_edges(text: Column) -> Column:
    """Remove leading and trailing whitespace of every kind, not only spaces."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def strip_html(html: Column) -> Column:
    """Each tag becomes one space; missing text becomes the empty string."""
    return F.coalesce(strip_edges(F.regexp_replace(html, r"<[^>]+>", " ")), F.lit(""))


def tag_list(raw: Column) -> Column:
    """Tags given as a comma separated text or as the JSON text of a list."""
    listed = F.from_json(raw, "array<string>")
    parts = F.when(F.ltrim(raw).startswith("["), listed).otherwise(F.split(raw, ","))
    parts = F.filter(F.transform(parts, strip_edges), lambda tag: tag != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def join_tags(tags: Column, limit: int | None = None) -> Column:
    """The tags of a product as one text; with ``limit`` only the first so many, as the bulk collector wants five."""
    return F.array_join(tags if limit is None else F.slice(tags, 1, limit), "; ")


def has_quality_word(tags: Column) -> Column:
    return F.lower(F.coalesce(tags, F.lit(""))).rlike("|".join(QUALITY_WORDS))


def store_url(base: Column, *parts: Column) -> Column:
    """Base without trailing slashes, then the parts."""
    return F.concat(F.regexp_replace(base, "/+$", ""), *parts)


def date_prefix(stamp: Column) -> Column:
    """First ten characters of an ISO time stamp as a date; bad text gives NULL."""
    return F.try_to_date(F.substring(stamp, 1, 10), "yyyy-MM-dd")


def normalize_title(title: Column, max_chars: int = 60) -> Column:
    """Title case, no special characters, known abbreviations, at most 60 characters.

    The length limit is part of the title rule, not a cap on the text read.
    """
    plain = F.regexp_replace(title, r"[^\p{L}\p{N}\s\-]", " ")
    plain = F.initcap(strip_edges(F.regexp_replace(plain, r"\s+", " ")))
    for word in ABBREVIATIONS:
        plain = F.regexp_replace(plain, rf"(?i)(?<![\p{{L}}\p{{N}}]){word}(?![\p{{L}}\p{{N}}])", word)
    return F.rtrim(F.substring(plain, 1, max_chars))


def product_line(nom, categorie, prix, rating, reviews, shop, country) -> Column:
    """One display line per product for the market context."""
    return F.concat(
        F.lit("  • "), nom, F.lit(" | "), categorie,
        F.lit(" | Prix: "), F.format_string("%.2f", prix),
        F.lit(" | Note: "), F.format_string("%.1f", rating),
        F.lit("/5 | "), reviews.cast("string"),
        F.lit(" avis | Shop: "), shop, F.lit(" ("), country, F.lit(")"),
    )


def product_card(nom, categorie, prix, rating, reviews, description) -> Column:
    """Multi-line text card of one product."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Produit : "), F.coalesce(nom, F.lit("Inconnu"))),
        F.concat(F.lit("Catégorie : "), F.coalesce(categorie, F.lit(""))),
        F.concat(F.lit("Prix : "), F.format_string("%.2f", F.coalesce(prix, F.lit(0.0))), F.lit("€")),
        F.concat(F.lit("Note : "), F.format_string("%.1f", F.coalesce(rating, F.lit(0.0))), F.lit("/5 ("),
                 F.coalesce(reviews, F.lit(0)).cast("string"), F.lit(" avis)")),
        F.concat(F.lit("Description : "), F.coalesce(description, F.lit("Non disponible"))),
    )
