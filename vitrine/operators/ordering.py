"""Global order without an unbounded single-task window.

``running_totals`` is the one primitive: range-partition the pre-aggregated rows
on the order, store them so that slab membership is a fact, and add each slab's
offset to a per-slab running sum. A group holding a third of all rows is spread
over many slabs because the slab boundaries ignore group borders. Few rows make
few slabs, as adaptive execution merges small partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import store_table

_SLAB = "slab__"


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def running_totals(df: DataFrame, by: list[str], order: list[Column],
                   totals: dict[str, str]) -> DataFrame:
    """Add, per group and in order, the running total before and after each row.

    ``totals`` maps an output name to the summed column. For every entry the
    result has ``<name>_before``, ``<name>_upto`` and the group's ``<name>_all``.
    ``df`` should be pre-aggregated. It takes one range shuffle and is stored once.
    """
    slabs = df.repartitionByRange(*[F.col(b) for b in by], *order)
    slabs = store_table(slabs.withColumn(_SLAB, F.spark_partition_id()), "slabs")
    per_slab = slabs.groupBy(*by, _SLAB).agg(
        *[F.sum(column).alias(f"{name}_slab") for name, column in totals.items()])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(_SLAB).rowsBetween(Window.unboundedPreceding, -1)
    # One row per slab and group: at most (partitions + groups) rows in total.
    offsets = store_table(per_slab.select(
        *by, _SLAB,
        *[F.coalesce(F.sum(f"{n}_slab").over(earlier), F.lit(0)).alias(f"{n}_off") for n in totals],
        *[F.sum(f"{n}_slab").over(group).alias(f"{n}_all") for n in totals],
    ), "offsets")
    within = Window.partitionBy(*by, _SLAB).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = slabs.select("*", *[F.sum(c).over(within).alias(f"{n}_run") for n, c in totals.items()])
    joined = local.join(offsets, _same(local, offsets, [*by, _SLAB]))
    keep = [local[c] for c in df.columns]
    out = []
    for name, column in totals.items():
        upto = F.col(f"{name}_run") + F.col(f"{name}_off")
        out += [(upto - local[column]).alias(f"{name}_before"), upto.alias(f"{name}_upto"),
                F.col(f"{name}_all")]
    return joined.select(*keep, *out)


def row_positions(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """0-based position of every row within its group, in ``order``."""
    ranked = running_totals(df.withColumn("one__", F.lit(1).cast("long")), by,
                            [F.col(c) for c in order], {"pos": "one__"})
    return ranked.select(*df.columns, F.col("pos_before").alias(name),
                         F.col("pos_all").alias(f"{name}_of"))


def value_ranks(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Rank interval of every distinct value of every column, in one pass.

    Long form: ``by``..., ``column``, ``value``, ``n_before``, ``n_upto`` (the
    half-open 0-based rank interval), ``n_all`` rows and ``m_all`` missing ones.
    Equal values collapse in the map-side partial aggregate; missing values
    sort last and are only counted.
    """
    by = by or []
    cells = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ])).alias("cell")).select(*by, "cell.column", F.nullif("cell.value", F.lit(float("nan"))).alias("value"))
    counts = cells.groupBy(*by, "column", "value").agg(F.count("*").alias("n__"))
    counts = counts.withColumn("m__", F.when(F.col("value").isNull(), F.col("n__")).otherwise(0))
    return running_totals(counts, [*by, "column"], [F.col("value").asc_nulls_last()],
                          {"n": "n__", "m": "m__"})


def pick_quantiles(ranks: DataFrame, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """Quantiles with linear interpolation out of ``value_ranks``: long form."""
    by = by or []
    wanted = ranks.where(F.col("value").isNotNull()).select(
        "*", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    position = F.col("prob") * (F.col("n_all") - F.col("m_all") - 1)
    low, high = F.floor(position), F.ceil(position)

    def covers(rank: Column) -> Column:
        return (F.col("n_before") <= rank) & (rank < F.col("n_upto"))

    # At most two rows per group and probability survive this filter.
    picked = wanted.where(covers(low) | covers(high)).groupBy(*by, "column", "prob").agg(
        F.max(F.when(covers(low), F.col("value"))).alias("lo"),
        F.max(F.when(covers(high), F.col("value"))).alias("hi"),
        F.max(position - low).alias("frac"),
    )
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")
    return picked.select(*by, "column", "prob", value.alias("value"))


def quantiles(df: DataFrame, columns: list[str], probs: list[float],
              by: list[str] | None = None) -> DataFrame:
    """Exact quantiles: ``by``..., ``column``, ``prob``, ``value``."""
    return pick_quantiles(value_ranks(df, columns, by), probs, by)


def _record(table: DataFrame, wanted: dict[str, tuple[str, float]]) -> Column:
    return table.agg(F.struct(*[
        F.max(F.when((F.col("column") == c) & (F.col("prob") == p), F.col("value"))).alias(name)
        for name, (c, p) in wanted.items()
    ]).alias("record")).scalar()


def quantile_record(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> Column:
    """One struct of named quantiles as a scalar subquery."""
    columns = sorted({c for c, _ in wanted.values()})
    probs = sorted({p for _, p in wanted.values()})
    return _record(quantiles(df, columns, probs), wanted)


def median_record(ranks: DataFrame, columns: list[str]) -> Column:
    """Median of every column of ``value_ranks`` as one struct."""
    return _record(pick_quantiles(ranks, [0.5]), {c: (c, 0.5) for c in columns})


def filled_quantile_record(ranks: DataFrame, column: str, wanted: dict[str, float],
                           fill: Column) -> Column:
    """Quantiles of ``column`` after its missing values were set to ``fill``.

    Filling inserts ``m_all`` copies of one value, so the rank intervals above
    it move up by that many places: no second pass over the data is needed.
    """
    rows = ranks.where((F.col("column") == column) & F.col("value").isNotNull()).withColumn("fill__", fill)
    start = F.col("n_before") + F.when(F.col("value") > F.col("fill__"), F.col("m_all")).otherwise(0)
    stop = F.col("n_upto") + F.when(F.col("value") >= F.col("fill__"), F.col("m_all")).otherwise(0)
    fields = []
    for name, prob in wanted.items():
        position = F.lit(float(prob)) * (F.col("n_all") - 1)

        def at(rank: Column) -> Column:
            hit = F.max(F.when((start <= rank) & (rank < stop), F.col("value")))
            return F.coalesce(hit, F.max("fill__"))

        low, high = at(F.floor(position)), at(F.ceil(position))
        fields.append((low + (high - low) * F.max(position - F.floor(position))).alias(name))
    return rows.agg(F.struct(*fields).alias("record")).scalar()


def value_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of every column with their 0-based code-point rank.

    Long form ``column``, ``value``, ``code`` from one pass over ``df``, stored.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns
    ])).alias("pair")).select("pair.*").distinct()
    ranked = row_positions(pairs, ["column"], ["value"], "code")
    return store_table(ranked.select("column", "value", F.col("code").cast("int").alias("code")), "codes")
