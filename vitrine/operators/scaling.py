"""Scalers with the usual single-machine semantics, written as expressions.

Bounds come from one aggregate per frame, read through a scalar subquery: no
join, no collect. ``pyspark.ml``'s scalers are not used because a constant
column gives 0.5 there (0 here) and the deviation is the sample one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def attach(df: DataFrame, record: Column, name: str) -> DataFrame:
    """Add a scalar subquery once as a struct column; its fields are then free to use."""
    return df.withColumn(name, record)


class MinMax:
    """Min-max scaling of named expressions; a constant expression gives 0.

    Use ``scaler.frame`` (the frame with its bounds attached), the scaled
    expressions ``scaler[name]``, and ``drop(scaler.BOUNDS)`` at the end.
    """

    BOUNDS = "bounds__"

    def __init__(self, df: DataFrame, sources: dict[str, Column]):
        self._sources = sources
        parts = []
        for name, source in sources.items():
            low, high = F.min(source), F.max(source)
            span = F.when(high == low, F.lit(1.0)).otherwise(high - low)
            parts += [low.alias(f"{name}_low"), span.alias(f"{name}_span")]
        self.frame = attach(df, df.agg(F.struct(*parts).alias("bounds")).scalar(), self.BOUNDS)

    def __getitem__(self, name: str) -> Column:
        bounds = F.col(self.BOUNDS)
        return (self._sources[name] - bounds[f"{name}_low"]) / bounds[f"{name}_span"]


def scale_minmax(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace the columns present by their value scaled to [0, 1]."""
    present = [c for c in columns if c in df.columns]
    scaler = MinMax(df, {c: F.col(c).cast("double") for c in present})
    return scaler.frame.withColumns({c: scaler[c] for c in present}).drop(scaler.BOUNDS)


def zscore_columns(df: DataFrame, columns: list[str], prefix: str = "z_") -> DataFrame:
    """Add ``prefix + c``: 0-filled, centred, divided by the population deviation."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns if c in df.columns}
    record = df.agg(F.struct(
        *[F.avg(v).alias(f"{c}_mean") for c, v in filled.items()],
        *[F.stddev_pop(v).alias(f"{c}_dev") for c, v in filled.items()],
    ).alias("stats")).scalar()
    stats = F.col("stats__")
    return attach(df, record, "stats__").withColumns({
        f"{prefix}{c}": F.coalesce(F.try_divide(v - stats[f"{c}_mean"], stats[f"{c}_dev"]), F.lit(0.0))
        for c, v in filled.items()
    }).drop("stats__")
