"""Audio sources and table sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_audio(spark: SparkSession, path: str, glob: str = "*.wav") -> DataFrame:
    """Recorded audio as rows (path, modificationTime, length, content)."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "modificationTime", "length", "content")
    )


def audio_manifest(audio: DataFrame) -> DataFrame:
    """S5 manifest without the payload (what a scheduler needs to plan U4)."""
    return audio.select("path", "modificationTime", "length")


def key_bucket(key: Column | str, buckets: int) -> Column:
    """Stable bucket of a key (xxhash64), for partitioned layouts."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(k), F.lit(buckets)).cast("int")


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Parquet table; an overwrite replaces only the partitions present in
    ``df`` (dynamic partition overwrite), so reloading one bucket of books
    does not touch the others (S7)."""
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_keyed(df: DataFrame, path: str, key: str, buckets: int, replace: DataFrame | None = None) -> None:
    """S6 for keyed tables: partitioned by a hash bucket of ``key``, so rows of
    one key stay together and a reload of some keys rewrites only their buckets.

    The keys of ``df`` (or of ``replace``, which may hold keys without any row
    left) are replaced; all other keys of the touched buckets are kept. The new
    content of those buckets is staged beside the table and then moved in, so
    the table is never read while it is overwritten. Readers may meet some
    buckets old and some new meanwhile; ``tables.KeyedTable`` replaces them all
    at once. The number of buckets is kept with the table: another one would
    leave old rows in buckets that are not touched, so it raises.
    """
    spark = df.sparkSession
    layout = f"{path.rstrip('/')}__layout"
    if not exists(spark, layout):
        spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.parquet(layout)
    held = spark.read.schema("buckets int").parquet(layout).first()[0]
    if held != buckets:
        raise ValueError(f"the table at {path} has {held} buckets, not {buckets}")
    new = df.withColumn("bucket", key_bucket(key, buckets))
    if not exists(spark, path):
        return write_table(new, path, ["bucket"])
    gone = (df if replace is None else replace.select(key).unionByName(df.select(key))).select(F.col(key).alias("__key")).distinct()
    touched = [r[0] for r in gone.select(key_bucket("__key", buckets)).distinct().collect()]  # at most ``buckets`` numbers
    old = spark.read.parquet(path).filter(F.col("bucket").isin(touched))
    kept = old.join(gone, old[key].eqNullSafe(gone["__key"]), "left_anti")
    stage = f"{path.rstrip('/')}__staged_{uuid.uuid4().hex[:12]}"
    merged = kept.select(*new.columns).unionByName(new)
    write_table(merged, stage, ["bucket"])
    staged = spark.read.schema(merged.schema).parquet(stage)
    write_table(staged, path, ["bucket"])
    # a bucket that lost its last row is not in the staged table: dynamic overwrite leaves it, so it is removed by name
    left = {r[0] for r in staged.select("bucket").distinct().collect()}
    for b in set(touched) - left:
        delete(spark, f"{path.rstrip('/')}/bucket={b}")
    delete(spark, stage)


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a (possibly remote) path exists."""
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a (possibly remote) folder of this table."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)
