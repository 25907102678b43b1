"""Line de-duplication against levelled sorted runs of line hashes.

Documents arrive in batches of ascending id. The state is a set of immutable
runs, each a bucketed table of (line hash, first document) sorted by the hash.
A batch is reduced to its distinct hashes, merge-anti-joined with every run (same
buckets, so only the batch moves) and what is new becomes a run of level 0; as
soon as a level holds ``fanout`` runs they are merged into one of the next level.
A line stays in the document that is first to hold its key and goes elsewhere.

Only DataFrame functions are used. Hashes have 128 bits. Aggregation is partial
before each shuffle, and the join that finds the lines to drop reads both sides
through exchanges, so that a line held by a third of all documents is split.

Defined results: null or empty text is one empty line; lines of shorter keys
always stay; repeated rows of one id are one document; a null id owns nothing
and loses nothing; an empty table gives an empty result. Ids may be texts too; the
smallest is then the first by its bytes. Further columns of the
input are ignored unless named in ``keep``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readerflow.operators.barrier import materialize
from readerflow.session import scratch_path

from .common import LOWER, UPPER, WS, table

MIN_CHARS = 10
KEY = ("h1", "h2")


def line_key(line: Column) -> Column:
    """Stripped line with A-Z lower-cased (other letters as they are)."""
    bare = F.btrim(line, F.lit(WS))
    # lower() equals the A-Z fold on plain ASCII and is much cheaper than translate()
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def key_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc_id, rid, pos, h1, h2) of every line whose key is long enough; rid tells the rows of one id apart."""
    lines = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("rid"), F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("pos", "line"))
    keys = lines.where(F.char_length(F.btrim("line", F.lit(WS))) >= min_chars).select("doc_id", "rid", "pos", line_key(F.col("line")).alias("key"))
    return keys.select("doc_id", "rid", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def order_number(id_col: Column | str, kind: str) -> Column:
    """A number that never falls where the id rises: the id, or the first seven bytes of a text id."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return c if kind != "string" else F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")


class LineRuns:
    """The levelled runs; ``first`` of a key never changes once it is in a run."""

    def __init__(self, spark: SparkSession, root: str, fanout: int = 2, buckets: int = 8) -> None:
        self.spark, self.root, self.fanout, self.buckets = spark, root, fanout, buckets
        self.levels: list[list[str]] = [[]]

    def tables(self) -> list[str]:
        return [t for level in self.levels for t in level]

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _write(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex[:16]}"
        (run.repartition(self.buckets, *KEY).coalesce(self.buckets).sortWithinPartitions(*KEY)
         .write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", self._path(name)).format("parquet").saveAsTable(name))
        return name

    def admit(self, batch: DataFrame) -> None:
        """Add the keys of a batch (doc_id, h1, h2) that no run has yet."""
        fresh = batch.groupBy(*KEY).agg(F.min("doc_id").alias("first"))
        for t in self.tables():
            fresh = fresh.join(self.spark.table(t).select(*KEY).hint("merge"), list(KEY), "left_anti")
        self.levels[0].append(self._write(fresh))
        self._compact()

    def _compact(self) -> None:
        k = 0
        while k < len(self.levels):
            level = self.levels[k]
            if len(level) >= self.fanout:
                merged = self.spark.table(level[0])
                for t in level[1:]:
                    merged = merged.unionByName(self.spark.table(t))
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(self._write(merged))
                for t in level:
                    self.spark.sql(f"DROP TABLE {t}")
                level.clear()
            k += 1

    def owners(self) -> DataFrame:
        """(h1, h2, first) of all keys, read without the buckets: both join sides may then be split where skewed."""
        tables = self.tables()
        return self.spark.read.schema(self.spark.table(tables[0]).schema).parquet(*map(self._path, tables))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), min_chars: int = MIN_CHARS,
                n_batches: int = 4, fanout: int = 2, bucket_lines: int = 250_000) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped, text (the lines kept) and the columns of ``keep``."""
    spark = docs.sparkSession
    root = scratch_path(spark, "line-dedup")
    shares = [k / n_batches for k in range(1, n_batches)]
    kind = docs.schema[id_col].dataType.simpleString()
    bounds = (docs.agg(F.percentile_approx(order_number(id_col, kind), shares).alias("b")).first()["b"] or []) if shares else []
    number = sum([(order_number("doc_id", kind) > b).cast("int") for b in bounds], F.lit(0))
    # a folder for each batch: taking in one reads no other
    key_lines(docs, id_col, text_col, min_chars).withColumn("batch", number).write.partitionBy("batch").parquet(f"{root}/lines")
    lines = spark.read.schema(f"doc_id {kind}, rid long, pos int, h1 long, h2 long, batch int").parquet(f"{root}/lines")
    runs = LineRuns(spark, root, fanout, max(1, -(-lines.count() // bucket_lines)))
    for k in range(n_batches):
        runs.admit(lines.where(F.col("batch") == k))
    owners = runs.owners()
    for t in runs.tables():  # the name only: the files stay
        spark.sql(f"DROP TABLE {t}")
    drops = (lines.drop("batch").join(owners.hint("merge"), list(KEY)).where("doc_id > first")
             .groupBy("doc_id", "rid").agg(F.collect_set("pos").alias("__drop")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("rid"), *keep)
    rows = rows.join(drops, ["doc_id", "rid"], "left").drop("rid")
    rows = materialize(rows, __lines=F.split(F.coalesce("text", F.lit("")), "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__drop")
    return rows.select(
        "doc_id", F.size("__lines").cast("long").alias("n_lines"),
        F.when(F.col("__drop").isNull(), F.lit(0)).otherwise(F.size("__drop")).cast("long").alias("n_dropped"),
        F.when(F.col("__drop").isNull(), F.coalesce("text", F.lit("")))
        .otherwise(F.array_join(F.transform(left, lambda i: F.element_at("__lines", i + 1)), "\n")).alias("text"), *keep)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


_WS_SQL = "' '||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
ORACLE = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {_WS_SQL}), '{UPPER}', '{LOWER}') AS key FROM l),
o AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key),
j AS (SELECT k.doc_id, k.pos, k.line, coalesce(o.first < k.doc_id, false) AS gone
      FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
