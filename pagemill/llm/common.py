"""What the operators of this subpackage share: table access, bounded Arrow slices, words."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Columns of the documents table; stages of the pipeline return what they are given.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose texts sum to about ``most_bytes``; one longer text comes alone.

    Bounds what a task holds beside the batch, whatever the lengths of the texts are.
    """
    lengths = pc.binary_length(batch.column(column)).to_pylist()
    start = held = 0
    for row, length in enumerate(lengths):
        if row > start and held + (length or 0) > most_bytes:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += length or 0
    if start < len(lengths):
        yield batch.slice(start)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts' bytes; null gives no bytes."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def as_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
