"""A committed store of keyed answers, with a ledger.

An answer costs a call to a paid service, so it is kept as soon as a slice of the
work is done, not when all of it is. The store is a Parquet table bucketed by
``request_key``; a join on that key reads it bucket by bucket, so what has been
answered is never shuffled however much it is. Each slice of new answers is
appended by a job of its own and then noted in the ledger, a Parquet table of one
row a slice.

A commit that is cut off while its files are moved leaves whole files of valid
answers; they are found by key like all others. The number of buckets is written
down when the store is made and used by every later run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.media import exists

KEY = "request_key"
PARTS = 1 << 16
LEDGER_SCHEMA = "run string, slice int, slices int, first_part int, last_part int, asked long, ok long, failed long, finished timestamp"


def key_bucket(buckets: int, key: str = KEY) -> Column:
    """The bucket of a key in a table of so many buckets."""
    return F.pmod(F.hash(key), F.lit(buckets))


def key_part(buckets: int, key: str = KEY) -> Column:
    """What slices are ranges of: a bucket's number and, within it, the first 16 bits of a hexadecimal key; a slice is in few buckets."""
    each = max(1, PARTS // buckets)
    return key_bucket(buckets, key) * each + (F.conv(F.substring(key, 1, 4), 16, 10).cast("int") * each / PARTS).cast("int")


def slices(counts: Iterable[tuple[int, int]], size: int) -> list[tuple[int, int, int]]:
    """(first part, last part, rows) of ranges of parts with at most ``size`` rows each, or one part."""
    out: list[tuple[int, int, int]] = []
    for part, n in sorted(counts):
        if out and out[-1][2] + n <= size:
            out[-1] = (out[-1][0], part, out[-1][2] + n)
        else:
            out.append((part, part, n))
    return out


class AnswerStore:
    """Answers at ``path`` (``schema`` with a ``request_key``), their ledger beside it.

    A folder of Parquet files without a noted number of buckets is read and appended to as it is.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, buckets: int | None = None) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.columns = [c.split()[0] for c in schema.split(", ")]
        self.name = "answers_" + hashlib.sha1(self.path.encode()).hexdigest()[:16]
        layout = f"{self.path}__layout"
        if exists(spark, layout):
            self.buckets = spark.read.schema("buckets int").parquet(layout).first()[0]
        elif exists(spark, self.path):
            self.buckets = None
        else:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1).select(F.lit(self.buckets).alias("buckets")).coalesce(1).write.parquet(layout)
        if self.buckets:
            where = self.path.replace("'", "\\'")
            spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({schema}) USING parquet CLUSTERED BY ({KEY}) INTO {self.buckets} BUCKETS LOCATION '{where}'")
            spark.catalog.refreshTable(self.name)

    def rows(self) -> DataFrame:
        """All rows kept so far, bucketed by key."""
        return self.spark.table(self.name) if self.buckets else self.spark.read.schema(self.schema).parquet(self.path)

    def answered(self) -> DataFrame:
        """(request_key): requests that have an answer."""
        return self.rows().filter(F.col("status") == "ok").select(KEY)

    def append(self, rows: DataFrame) -> None:
        """Keep ``rows``, as one job."""
        rows = rows.select(*self.columns)
        if self.buckets:
            rows.write.insertInto(self.name)
            self.spark.catalog.refreshTable(self.name)
        else:
            rows.write.mode("append").parquet(self.path)

    def note(self, run: str, number: int, total: int, first: int, last: int, asked: int, ok: int, failed: int) -> None:
        row = self.spark.range(1).select(
            F.lit(run).alias("run"), F.lit(number).alias("slice"), F.lit(total).alias("slices"), F.lit(first).alias("first_part"), F.lit(last).alias("last_part"),
            *[F.lit(n).cast("long").alias(c) for n, c in ((asked, "asked"), (ok, "ok"), (failed, "failed"))], F.current_timestamp().alias("finished"))
        row.coalesce(1).write.mode("append").parquet(f"{self.path}__ledger")

    def ledger(self) -> DataFrame:
        """One row for each slice that was finished."""
        path = f"{self.path}__ledger"
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], LEDGER_SCHEMA)
