"""Reading input tables, storing intermediate ones, and blocks of texts inside tasks."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.plans.lineage import ensure_checkpoint_dir

MAX_CHARS = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table once to the shared checkpoint folder and go on from the files.

    Parquet is compressed, survives lost executors, and is read column by column.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a few million characters with their texts, null as empty.

    A batch may hold many long texts; only one slice of it is held as Python strings.
    Afterwards the worker, which other tasks will use, gives free memory back.
    """
    for part in slices(batches, column):
        yield part, [x or "" for x in part.column(part.schema.get_field_index(column)).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a few million bytes of the column."""
    try:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(column))
            step = max(1, len(texts) * MAX_CHARS // max(texts.nbytes, 1))
            for at in range(0, len(texts), step):
                yield batch.slice(at, step)
    finally:
        release()


def release() -> None:
    """Give memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not a GNU C library
        pass


def smallest_hashes(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """The rows with the smallest hashes of their keys: a sample of fixed size that a rerun repeats.

    A bound on the hash, from the counted rows, lets few more than ``limit``
    rows leave their tasks.
    """
    h, rows = F.xxhash64(*keys), df.count()
    if rows > 4 * limit:
        df = df.filter(h <= -(1 << 63) + (2 * limit << 64) // rows)
    return df.orderBy(h, *keys).limit(limit)


BROADCAST_BYTES = 48 << 20


def sized(df: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table with a join hint by its counted size: broadcast within the budget, else merge."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df.hint("merge")
