"""Intermediate tables in the shared folder, and row numbers from prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from vitrine.session import store_table as stored


def stored_in_order(df: DataFrame, label: str, *order: str, parts: int | None = None) -> DataFrame:
    """``df`` sorted by ``order`` over all parts, stored, with ``part`` and ``place`` (order inside the part)."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stored(ordered.withColumns({
        "part": F.spark_partition_id(),
        "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), label)


def numbered(ordered: DataFrame, name: str, *group: str) -> DataFrame:
    """Adds ``name``: gapless numbers from 0 in each group, for a frame of ``stored_in_order`` sorted by group first.

    Only one row for each part and group comes together, to be summed up.
    """
    counts = ordered.groupBy("part", *group).agg(F.count("*").alias("_n"), F.min("place").alias("_least")).collect()
    before: dict[tuple, int] = {}
    rows = []
    for r in sorted(counts, key=lambda r: r["part"]):
        own = tuple(r[g] for g in group)
        rows.append((r["part"], *own, before.get(own, 0) - r["_least"]))
        before[own] = before.get(own, 0) + r["_n"]
    fields = [ordered.schema[g] for g in group]
    schema = T.StructType([T.StructField("part", T.IntegerType()), *fields, T.StructField("_shift", T.LongType())])
    shift = ordered.sparkSession.createDataFrame(rows, schema)
    on = ordered["part"] == shift["part"]
    for g in group:
        on = on & ordered[g].eqNullSafe(shift[g])
    return ordered.join(F.broadcast(shift), on).select(
        *[ordered[c] for c in ordered.columns], (ordered["place"] + shift["_shift"]).alias(name))
