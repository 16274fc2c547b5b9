"""Price, discount, currency and label expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numeric import half_even

# Upper bounds (inclusive) and names of the price segments.
PRICE_SEGMENTS = [(20.0, "Très_bas"), (50.0, "Bas"), (100.0, "Moyen"), (200.0, "Haut")]
TOP_SEGMENT = "Premium"

# Country to currency; every other country trades in AED.
CURRENCIES = [("USD", ["USA", "CAN", "AUS"]), ("EUR", ["FRA", "DEU", "ESP", "ITA"]),
              ("GBP", ["GBR"]), ("MAD", ["MAR"])]
DEFAULT_CURRENCY = "AED"


def discount_ratio(price: Column, promo: Column) -> Column:
    """(price - promo) / price rounded to 3 places, 0 for a price of 0 or less."""
    safe = F.when(price > 0, price)
    return F.when(price > 0, half_even((price - promo) / safe, 3)).otherwise(F.lit(0.0))


def discount_ratio_unit(price: Column, promo: Column) -> Column:
    """Variant that divides by 1 where the price is 0."""
    return half_even((price - promo) / F.when(price == 0, F.lit(1.0)).otherwise(price), 3)


def price_segment(price: Column) -> Column:
    """Right-closed price bins; a price of 0 or less has no segment."""
    usable = price.isNotNull() & ~F.isnan(price) & (price > 0)
    segment = F.when(~usable, F.lit(None).cast("string"))
    for upper, name in PRICE_SEGMENTS:
        segment = segment.when(price <= upper, name)
    return segment.otherwise(TOP_SEGMENT)


def effective_discount(reference: Column, sale: Column) -> Column:
    """Percent off the reference price, one decimal, 0 when it is not above."""
    safe = F.when(reference > sale, reference)
    return F.when(reference > sale, half_even((reference - sale) / safe * 100.0, 1)).otherwise(F.lit(0.0))


def promo_price(price: Column, percent: Column) -> Column:
    return half_even(price * (F.lit(1.0) - percent / 100.0), 2)


def currency(country: Column) -> Column:
    chain = None
    for code, countries in CURRENCIES:
        test = country.isin(countries)
        chain = F.when(test, code) if chain is None else chain.when(test, code)
    return chain.otherwise(DEFAULT_CURRENCY)


def fixed_attractiveness(rating: Column, reviews: Column, in_stock: Column,
                         price: Column | None = None) -> Column:
    """Attractiveness with fixed scales; the price term is optional. Not rounded."""
    # Weights .4/.35/.15/.1, scales 5 stars, 2000 reviews, price 350.
    score = (rating / 5.0) * 0.4 + F.least(reviews / 2000.0, F.lit(1.0)) * 0.35 \
        + F.when(in_stock == 1, F.lit(1.0)).otherwise(F.lit(0.0)) * 0.15
    if price is not None:
        score = score + (F.lit(1.0) - F.least(price / 350.0, F.lit(1.0))) * 0.1
    return score


FIXED_LABEL_THRESHOLD = 0.55


def engagement(rating: Column, reviews: Column) -> Column:
    """Rating weighted by the logarithm of the review count. Not rounded."""
    return rating * F.log1p(reviews.cast("double"))


def stock_score(in_stock: Column, quantity: Column) -> Column:
    return F.when(in_stock == 1, half_even(F.log1p(quantity.cast("double")) / 10.0, 3)).otherwise(F.lit(0.0))
