"""Best-fit packing of documents into bins under conflicts.

Bins hold up to ``capacity`` words. Longer documents are cut into pieces, so
that no word is left out. Pieces are dealt by hash to shards of about
``shard_docs`` pieces, and a shard is packed by one task: longest piece first,
into the fullest bin that has room and no conflict. A shard's bins are ordered
by what is left in them and carry bitmaps of the sources and of the duplicate
clusters that they hold; the search starts at the tightest bin with room and
goes on upwards until one has neither the piece's source nor its cluster. There
is no cap on bins or on steps; a hot source only means more bins.

Defined results: a document without words (null, empty) gets one row of length 0
and no bin; a null source or cluster is in conflict with nothing; ties are packed
in the order of id, cluster and piece; repeated rows are packed each (and conflict
through their cluster); an empty table gives an empty result. Only the named
columns are read, so others never clash.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readerflow.session import scratch_path

from .common import table
from .streams import sorted_groups

CAPACITY = 2048
SHARD_DOCS = 2048


def best_fit(pieces: list[tuple], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each (length, source, cluster) in the given order."""
    order: list[tuple[int, int]] = []  # (room left, bin), ascending
    held_sources: list[int] = []
    held_clusters: list[int] = []
    source_bit: dict = {}
    cluster_bit: dict = {}
    out = []
    for length, source, cluster in pieces:
        s = 0 if source is None else 1 << source_bit.setdefault(source, len(source_bit))
        c = 0 if cluster is None else 1 << cluster_bit.setdefault(cluster, len(cluster_bit))
        at = bisect_left(order, (length, -1))
        while at < len(order) and (held_sources[order[at][1]] & s or held_clusters[order[at][1]] & c):
            at += 1
        if at < len(order):
            room, k = order.pop(at)
        else:
            room, k = capacity, len(held_sources)
            held_sources.append(0)
            held_clusters.append(0)
        held_sources[k] |= s
        held_clusters[k] |= c
        out.append((k, capacity - room))
        if room > length:
            insort(order, (room - length, k))
    return out


def pack(docs: DataFrame, length: Column, source: Column, cluster: Column, id_col: str = "doc_id", capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row a piece: doc_id, piece, start (words before it in the document), length, bin_id, bin_offset."""
    spark, root = docs.sparkSession, scratch_path(docs.sparkSession, "packing")
    rows = docs.select(F.col(id_col).alias("doc_id"), length.cast("long").alias("n"), source.cast("string").alias("source"), cluster.cast("long").alias("cluster"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows.write.parquet(f"{root}/lengths")
    rows = spark.read.schema(f"doc_id {kind}, n long, source string, cluster long").parquet(f"{root}/lengths")
    pieces = (rows.where("n > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / capacity).cast("long"))))
              .withColumn("start", F.col("piece") * capacity).withColumn("length", F.least(F.lit(capacity).cast("long"), F.col("n") - F.col("start"))))
    total = pieces.agg(F.count("*").alias("c")).first()["c"]
    shards = max(1, -(-total // shard_docs))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "piece"), F.lit(shards)))
    names = ["doc_id", "piece", "start", "length", "bin_id", "bin_offset"]

    def run(batches):
        for g in sorted_groups(batches):
            g = g.combine_chunks()
            got = best_fit(list(zip(g.column("length").to_pylist(), g.column("source").to_pylist(), g.column("cluster").to_pylist())), capacity)
            base = g.column("shard")[0].as_py() << 24
            yield from g.select(["doc_id", "piece", "start", "length"]).append_column("bin_id", pa.array([base + k for k, _ in got], pa.int64())) \
                .append_column("bin_offset", pa.array([o for _, o in got], pa.int64())).to_batches()

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = (pieces.select("shard", "doc_id", "piece", "start", "length", "source", "cluster").repartition(width, "shard")
              .sortWithinPartitions("shard", F.desc("length"), "doc_id", "cluster", "piece")
              .mapInArrow(run, f"doc_id {kind}, piece long, start long, length long, bin_id long, bin_offset long"))
    empty = rows.where("n = 0 OR n IS NULL").select("doc_id", *(F.lit(0).cast("long").alias(c) for c in names[1:4]), *(F.lit(None).cast("long").alias(c) for c in names[4:]))
    return packed.unionByName(empty)


def count_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Documents by words; one document of a source and one of each set of equal texts to a bin."""
    return pack(docs, count_words(), F.col("source"), F.xxhash64("text"), capacity=capacity, shard_docs=shard_docs)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
