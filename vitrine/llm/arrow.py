"""Run a numpy function over bounded chunks of a frame's rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vitrine.llm.words import CHUNK_BYTES, chunks


def hand_back() -> None:
    """Return freed Arrow memory to the system; a worker that stays for later stages would keep it."""
    pa.default_memory_pool().release_unused()


def add_columns(df: DataFrame, fields: str, compute: Callable[[pa.RecordBatch], dict[str, pa.Array]],
                column: str = "text", size: int = CHUNK_BYTES) -> DataFrame:
    """``df`` with the columns ``fields`` (DDL), computed from chunks of at most ``size`` bytes of ``column``.

    A column of ``df`` with the name of a new one is replaced.
    """
    added = T.StructType.fromDDL(fields)
    base = df.drop(*added.names)
    names = [*base.columns, *added.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in chunks(batch.column(column), size):
                part = batch.slice(a, b - a)
                new = compute(part)
                yield pa.RecordBatch.from_arrays([*part.columns, *(new[n] for n in added.names)], names)
        hand_back()

    return base.mapInArrow(run, T.StructType([*base.schema.fields, *added.fields]))


def emit_rows(df: DataFrame, fields: str, compute: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
              column: str = "text", size: int = CHUNK_BYTES) -> DataFrame:
    """Rows with the columns ``fields`` (DDL) that ``compute`` makes from each chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in chunks(batch.column(column), size):
                yield from compute(batch.slice(a, b - a))
        hand_back()

    return df.mapInArrow(run, fields)
