"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Rows of whole texts handed to Python at a time, where the caller set nothing.
ARROW_ROWS = "1000"


def settings(spark: SparkSession) -> None:
    """Small Arrow batches, so that long texts fit a worker; the user's own setting wins."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000" and key not in dict(spark.sparkContext.getConf().getAll()):
        spark.conf.set(key, ARROW_ROWS)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1):
    """Rows of several megabytes go to Python a few at a time, in what is run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def document_key(id_col: str, text_col: str) -> list[Column]:
    """``(did, th)``: two longs that name a document in joins.

    Rows that repeat id and text are one document. Rows that share an id but not
    the text are different documents. A null id is an id of its own, after all others.
    """
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("did"),
        F.xxhash64(F.col(id_col).isNull(), F.col(text_col).isNull(), F.col(text_col)).alias("th"),
    ]


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes per row; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def shards(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` text bytes; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def per_row(df: DataFrame, work: Callable[[pa.RecordBatch], dict[str, pa.Array]], schema: str, text: str, limit: int = 8 << 20) -> DataFrame:
    """Append what ``work`` gives for slices of rows, in Arrow, without a shuffle.

    A column of ``df`` named like a new one is replaced.
    """
    new = StructType.fromDDL(schema)
    kept = [c for c in df.columns if c not in new.names]
    out = df.select(*[F.col(f"`{c}`") for c in kept]).schema
    for field in new:
        out = out.add(field.name, field.dataType, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shards(batches, text, limit):
            made = work(part)
            columns = [part.column(c) for c in kept] + [made[n] for n in new.names]
            yield pa.RecordBatch.from_arrays(columns, names=kept + new.names)

    return df.mapInArrow(run, out)


def in_spread(n: int) -> int:
    """Buckets for a two-level scan over ``n`` rows: about the square root, at any size."""
    return max(1, int(np.ceil(np.sqrt(max(n, 1)))))
