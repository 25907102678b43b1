"""Keyword search (F3) over stored dialogues that skips files.

A table is two folders: ``rows/part=<n>``, the dialogues, and ``grams``, which says
what trigrams the lower-cased lines of a part hold. A book's lines lie in runs of
``RUN`` in one part, so that a name is in few parts and a long book in several. A
line that contains the keyword has all of its trigrams, so a part that lacks one of
them is not read: the search counts the keyword's trigrams by part, and Spark prunes
the partitions of ``rows`` by that result while the query runs. The literal test of
F3 follows, so the rows are those of the plain filter.

The trigrams are sorted in their files, so that a search reads few of them too. A
keyword of fewer than three characters is looked for in all parts. Null lines are
stored and match only the empty keyword, as in F3. Repeated rows are kept. An empty
table finds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.dialogues import keyword_contains

SIZE = 3
RUN = 1 << 16  # lines of a book that lie together


def line_grams(line: Column | str) -> Column:
    """The distinct trigrams of a lower-cased line, in linear time; null for null."""
    return F.array_distinct(F.regexp_extract_all(F.lower(line), F.lit("(?s)(?=(" + "." * SIZE + "))"), 1))


def keyword_grams(keyword: str) -> list[str]:
    k = keyword.lower()
    return sorted({k[i:i + SIZE] for i in range(len(k) - SIZE + 1)})


class LineIndex:
    """Dialogues (book_id, dlg_ord, line, ...) of the given schema at ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, parts: int = 256) -> None:
        if "part" in schema.names:
            raise ValueError("a column named part would clash with the table's own")
        self.spark, self.path, self.schema, self.parts = spark, path.rstrip("/"), schema, parts

    def add(self, dialogues: DataFrame) -> None:
        """Store ``dialogues``, a stored table or one that comes out the same twice.

        The trigrams are written first: if a run breaks off, some parts have too many, which costs
        a search a file but no row, and the same dialogues can be added again.
        """
        run = F.floor(F.col("dlg_ord") / F.lit(RUN))
        rows = dialogues.select(*self.schema.names).withColumn("part", F.pmod(F.xxhash64("book_id", run), F.lit(self.parts)).cast("int"))
        grams = rows.select("part", F.explode(line_grams("line")).alias("gram")).distinct()
        grams.repartitionByRange("gram", "part").sortWithinPartitions("gram", "part").write.mode("append").parquet(f"{self.path}/grams")
        # few files a part, and no part in one task: AQE joins small pieces and splits large ones
        rows.hint("rebalance", F.col("part")).write.mode("append").partitionBy("part").parquet(f"{self.path}/rows")

    def read(self) -> DataFrame:
        return self._rows().select(*self.schema.names)

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields, StructField("part", IntegerType())])).parquet(f"{self.path}/rows")

    def candidate_parts(self, keyword: str) -> DataFrame | None:
        """(part) that hold every trigram of the keyword; None if the keyword has no trigram."""
        wanted = keyword_grams(keyword)
        if not wanted:
            return None
        grams = self.spark.read.schema("part int, gram string").parquet(f"{self.path}/grams")
        held = grams.filter(F.col("gram").isin(wanted)).groupBy("part").agg(F.count_distinct("gram").alias("n"))
        return held.filter(F.col("n") == len(wanted)).select("part")

    def search(self, keyword: str | None) -> DataFrame:
        """The stored rows whose line contains the keyword."""
        rows, parts = self._rows(), self.candidate_parts(keyword or "")
        if parts is not None:
            rows = rows.join(F.broadcast(parts), "part", "left_semi")  # at most ``self.parts`` numbers
        return rows.filter(keyword_contains(keyword)).select(*self.schema.names)
