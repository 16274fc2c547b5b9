"""Tabular scans, external exports and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..functions.numeric import clip, numeric_column, truncate_int
from ..operators.ordering import row_positions


def scan_products(spark: SparkSession, path: str, fmt: str = "csv",
                  schema: T.StructType = schemas.PRODUCTS) -> DataFrame:
    """Catalogue scan with a declared schema: no inference pass over the data."""
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def scan_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All-text CSV scan, or an empty frame with ``schema`` where the path is missing."""
    try:
        return spark.read.option("header", True).csv(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def records_to_frame(spark: SparkSession, records: list[dict],
                     schema: T.StructType | str = schemas.PRODUCTS) -> DataFrame:
    """A small list of records as a typed frame; missing keys become NULL."""
    typed = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    return spark.createDataFrame([tuple(r.get(f.name) for f in typed) for r in records], typed)


def rename_external(df: DataFrame, kind: str) -> DataFrame:
    """Rename the known columns that are present."""
    mapping = schemas.EXTERNAL_COLUMNS.get(kind, {})
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def fill_missing_columns(df: DataFrame, kind: str, order: list[str]) -> DataFrame:
    """Add absent catalogue columns with their defaults.

    A missing ``product_id`` becomes the row's position in ``order``.
    """
    if "product_id" not in df.columns:
        df = row_positions(df, [], order, "product_id").drop("product_id_of")
    defaults = dict(schemas.EXTERNAL_DEFAULTS, plateforme="Amazon" if "amazon" in kind else "eCommerce")
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent)


def import_external(df: DataFrame, kind: str, order: list[str], limit: int | None = None) -> DataFrame:
    """External export to catalogue rows: rename, defaults, types, standard columns.

    ``limit`` keeps the first rows in ``order`` when a caller asks for a sample.
    """
    full = fill_missing_columns(rename_external(df, kind), kind, order)
    typed = full.withColumns({
        "prix": F.coalesce(numeric_column(full, "prix"), F.lit(0.0)),
        "rating": clip(F.coalesce(numeric_column(full, "rating"), F.lit(0.0)), 0.0, 5.0),
        "nb_reviews": truncate_int(numeric_column(full, "nb_reviews")),
        "en_stock": numeric_column(full, "en_stock").try_cast("int"),
        "top_produit": _flag(full, "top_produit"),
        "product_id": F.col("product_id").cast("string"),
    })
    if limit is not None:
        typed = typed.orderBy(*order).limit(limit)
    return typed.select(*schemas.EXTERNAL_DEFAULTS)


def _flag(df: DataFrame, name: str):
    """0/1 from numbers or from the texts true / false."""
    text = F.lower(F.col(name).cast("string"))
    return F.when(text == "true", 1).when(text == "false", 0).otherwise(numeric_column(df, name).try_cast("int"))


def union_sources(*frames: DataFrame) -> DataFrame:
    """Bag union by name; columns a source lacks are NULL, identifiers are text."""
    aligned = [f.withColumn("product_id", F.col("product_id").cast("string")) for f in frames]
    result = aligned[0]
    for frame in aligned[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path))
    return path
