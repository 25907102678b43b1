"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readerflow.session import scratch_path

from .common import few_files, put


HUB = 1024  # rows of a key that are joined in one task
MAX_HUBS = 1 << 17


def join_counted(rows: DataFrame, stats: DataFrame, key: str, count: str, total: int, hub: int = HUB) -> DataFrame:
    """Inner join of ``rows`` with ``stats``, which has one row a key and in ``count`` the number of the key's ``rows``; ``total`` rows at most.

    The rows of a key over ``hub`` stay where they are and meet its one row of
    ``stats``, which is broadcast: fewer than ``MAX_HUBS`` keys, because ``hub``
    rises with ``total``. The other keys are joined by a shuffle.
    """
    hub = max(hub, -(-total // MAX_HUBS))
    if total <= hub:
        return rows.join(stats, key)
    hubs = stats.where(F.col(count) > hub)
    others = rows.join(F.broadcast(hubs.select(key)), key, "left_anti").join(stats.where(F.col(count) <= hub), key)
    return rows.join(F.broadcast(hubs), key).unionByName(others)


def connected_components(edges: DataFrame, max_rounds: int = 60, hub: int = HUB) -> DataFrame:
    """(id, component) of every end of an edge (a, b); component is the smallest id reachable.

    Large-star and small-star rounds until the edges stop changing. The minima
    are aggregated before each shuffle and brought back to the edges by
    ``join_counted``, so a hub's edges are never in one task; every round is
    written to the shared folder, which cuts the lineage and survives lost
    executors. Nothing but a count and a checksum reaches the driver.
    """
    spark, root = edges.sparkSession, scratch_path(edges.sparkSession, "components")
    schema = f"u {edges.schema['a'].dataType.simpleString()}, v {edges.schema['a'].dataType.simpleString()}"

    files = few_files(spark)

    def print_of(df: DataFrame):
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    # every edge from the larger to the smaller end
    now = put(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{root}/start", schema, files)
    seen = print_of(now)
    for k in range(max_rounds):
        if seen[0] == 0:
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("d")).select("u", F.least("u", "m").alias("m"), "d")
        large = join_counted(both, low, "u", "d", 2 * seen[0], hub).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = put(large.where("u <> v").distinct(), f"{root}/{k}-large", schema, files)
        low2 = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("d"))
        small = join_counted(large, low2, "u", "d", 2 * seen[0], hub)  # an edge gives two at most
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low2.select("u", F.col("m").alias("v")))
        now = put(moved.where("u <> v").distinct(), f"{root}/{k}", schema, files)
        got = print_of(now)
        if got == seen:
            break
        seen = got
    else:
        raise RuntimeError("components did not settle")
    heads = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(heads)
