"""Helpers shared by the training-data operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the evaluation fold: crc32 of the id's text is a multiple of 5 (null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def py_held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_train: int,
                  id_col: str = "doc_id", text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """At most ``max_train`` labelled rows outside the evaluation fold: (text, label, *extra).

    The choice is by hash of the id, so it is the same on every run. Repeated
    label rows of one id count once (the larger label); null labels and null
    ids are left out. The chosen ids are a bounded set, hence the broadcast.
    """
    chosen = (
        labels.select(F.col(id_col).alias("__id"), F.col(label).cast("double").alias("__y"))
        .where(F.col("__y").isNotNull() & F.col("__id").isNotNull() & ~held_out("__id"))
        .groupBy("__id").agg(F.max("__y").alias("__y"))
        .orderBy(F.xxhash64("__id"), "__id").limit(max_train)
    )
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"), *extra)
    return texts.join(F.broadcast(chosen), "__id").select("text", F.col("__y").alias("label"), *extra)


def slices(batch: pa.RecordBatch, text_col: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice stay near ``max_bytes`` (a longer single text is its own slice)."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
    cut = np.cumsum(sizes.astype(np.int64)) // max_bytes
    edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def put(df: DataFrame, path: str, schema: str, files: int | None = None) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: the lineage ends there.

    ``files``: at most so many, for tables that follow a shuffle; partitions are then joined without another one.
    """
    (df if files is None else df.coalesce(files)).write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def few_files(spark: SparkSession) -> int:
    """Files for a small table after a shuffle: an eighth of the shuffle partitions, 8 at least."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
