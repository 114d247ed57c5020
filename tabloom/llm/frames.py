"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, parts: int) -> Column:
    """The fold of a row: crc32 of its key as text, modulo `parts`; null keys fall into the fold of the empty text."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % parts


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def strings(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null is empty."""
    return [value or "" for value in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def small(rows: Iterator[pa.RecordBatch], size: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most `size`, so that a task holds few copies of texts; its buffers are given back at the end."""
    for batch in rows:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)
    pa.default_memory_pool().release_unused()


def batches(rows: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)


class Memo(dict):
    """A dictionary that computes what it lacks, one key at a time."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value
