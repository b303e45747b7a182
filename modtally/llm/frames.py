"""What the operators share: typed input columns, Arrow tasks over whole texts, written tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modtally.session import remove, scratch_path

# Texts one task holds as arrays at a time. A single longer text is a piece of its own.
PIECE_BYTES = 4 << 20


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the text operators read, renamed and typed; other columns are dropped, null texts are empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows in them."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Return freed memory to the system: workers are kept for later tasks, and the C library keeps what arrays freed."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], limit: int = PIECE_BYTES, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of a piece stay under ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch, name)
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last
    give_back()


def over_texts(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, limit: int = PIECE_BYTES) -> DataFrame:
    """Run ``work`` on pieces of at most ``limit`` bytes of text in every partition."""
    cut = pieces

    def run(batches):
        for piece in cut(batches, limit):
            out = work(piece)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def over_rows(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], text_col: str, limit: int = PIECE_BYTES) -> DataFrame:
    """Rows of ``df``, all columns, changed or filtered by ``work`` in pieces of at most ``limit`` bytes of text."""
    cut = pieces

    def run(batches):
        for piece in cut(batches, limit, text_col):
            out = work(piece)
            if out.num_rows:
                yield out

    return df.mapInArrow(run, df.schema)


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the cluster's shared folder and read it back: it outlives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.shared_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete written tables that no later step reads."""
    for table in tables:
        remove(table.sparkSession, table.shared_path)
