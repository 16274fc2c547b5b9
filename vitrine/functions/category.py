"""Category normalisation as one expression: no join, no per-row Python."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from ..schemas import CATEGORY_WORDS, GENERIC_TYPES
from .text import strip_edges


def normalize_category(raw_type: Column, fallback: Column,
                       words: dict[str, list[str]] | None = None,
                       generic: list[str] | None = None) -> Column:
    """Blank or generic types give the fallback, then exact word, then substring.

    The words of a category are contiguous in priority, so "the first word
    contained" is "the first category any of whose words is contained": one
    alternation per category replaces a join against every word.
    """
    words = words or CATEGORY_WORDS
    lowered = F.lower(strip_edges(F.coalesce(raw_type, F.lit(""))))
    chain = F.when((lowered == "") | lowered.isin(generic or GENERIC_TYPES), fallback)
    for category, keys in words.items():
        chain = chain.when(lowered.isin(keys), F.lit(category))
    for category, keys in words.items():
        chain = chain.when(lowered.rlike("|".join(re.escape(k) for k in keys)), F.lit(category))
    return chain.otherwise(fallback)
