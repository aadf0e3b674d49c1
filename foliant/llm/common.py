"""Shared plumbing of the training-data operators: tables, sums over rows, row keys."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.session import forget, new_path, shared_dir, written

__all__ = ["forget", "keep_rows", "lean", "new_path", "row_key", "shared_dir", "shuffle_width", "store_of", "summed", "table", "written"]

#: Tasks that add up the partitions' sums, and rows of sums that reach the driver.
SUMMING_TASKS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInArrow, handing freed memory back when a task ends: workers are used again by later stages."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only glibc has it
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def summed(rows: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """Sum over all rows of a vector of ``size`` numbers: ``part`` gives that of a batch; partitions are added up in a few tasks, so the driver gets a few rows."""

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += part(b)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            for x in b.column("part"):
                total += np.frombuffer(x.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts = rows.mapInArrow(within, "part binary")
    parts = parts.repartition(SUMMING_TASKS).mapInArrow(added, "part binary")
    return sum((np.frombuffer(r["part"]) for r in parts.collect()), start=np.zeros(size))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """64-bit key that tells rows of one id but different text apart (used only next to the id)."""
    return F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text", one: bool = False) -> DataFrame:
    """Rows of ``docs`` whose (id, row key) is in ``kept(id, k64)``: all of them, or with ``one`` a single row of each id and text.

    All columns of ``docs`` come back unchanged, also ones named like the helper columns. Which one stays of rows that
    differ in other columns follows from a hash of those columns, not from the order of rows.
    """
    names = docs.columns
    left = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(id_col).alias("_id"), row_key(id_col, text_col).alias("_k")
    )
    right = kept.select(F.col("id").alias("_id2"), F.col("k64").alias("_k2")).distinct()
    joined = left.join(right, (F.col("_k") == F.col("_k2")) & F.col("_id").eqNullSafe(F.col("_id2")), "left_semi")
    if one:
        rank = F.xxhash64(*[F.col("_row").getField(f.name) for f in docs.schema if f.dataType.typeName() not in ("map", "variant")])
        joined = joined.groupBy("_k", "_id").agg(F.min_by("_row", rank).alias("_row"))
    return joined.select(*[F.col("_row").getField(c).alias(c) for c in names])


#: Schemes that Spark and Arrow name differently.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs", "gcs": "gs"}


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system and path of a folder named as Spark names it."""
    scheme, colon, rest = folder.partition(":")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}{colon}{rest}")
