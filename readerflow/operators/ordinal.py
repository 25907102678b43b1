"""Skew-safe ordered positions within a key.

A plain ``row_number()/lag()/lead() OVER (PARTITION BY key ORDER BY o)`` sends
every row of a key to one task; a key holding a third of the data would make
one straggler. Here the rows of a key are cut into blocks of consecutive rows:

1. blocks: rows are counted by key first, and three numbers reach the driver: the
   largest count, and how many keys and rows are over ``block_size``. If none is,
   every key is one block. Otherwise the large keys are cut at quantiles of their
   order values, ``FANOUT - 1`` at most, their blocks again in the same way, and so
   on until a block holds about ``block_size`` rows; the number of rounds follows
   from the largest count. So the blocks are even however sparse or clustered the
   values are, and however long the key. Quantiles are partial aggregates over the
   rows of large keys alone. There are fewer than two cuts for each ``block_size``
   rows; they are broadcast while that bound is below ``MAX_SENT``, else joined by
   a shuffle.
2. rows: ``row_number/lag/lead`` over (key, block).
3. block table: ``count/min/max`` per (key, block), then a running sum and
   ``lag/lead`` over the (small) block table per key.
4. join the two on (key, block): position = block offset + row number; the
   neighbour of a block's first/last row comes from the previous/next block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK = 1 << 16


FANOUT = 512
MAX_SENT = 1 << 21  # cuts or keys sent to every task: 16 MB of numbers


def _blocked(df: DataFrame, key: str, order: str, block_size: int) -> DataFrame:
    """``df`` with ``__blk``, a number that grows with the order within a key; as it is if it has been cut before."""
    if "__blk" in df.columns:
        return df
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    large = F.col("__rows") > block_size
    most, keys, rows = counts.agg(F.max("__rows"), F.count_if(large), F.sum(F.when(large, F.col("__rows")))).first()
    out = df.withColumn("__blk", F.lit(0).cast("bigint"))
    if not keys:
        return out
    bounded = 2 * rows // block_size + keys <= MAX_SENT
    hot = counts.filter(large & F.col(key).isNotNull()).select(F.col(key).alias("__key"))
    sketched = out.join(F.broadcast(hot) if bounded else hot, F.col(key) == F.col("__key"), "left_semi").select(key, order, "__blk")
    while most > block_size:
        cuts = _cuts(sketched, key, order, block_size)
        out, sketched = (_cut(d, cuts, key, order, bounded) for d in (out, sketched))
        most = 5 * most // (4 * FANOUT)  # a quantile may be off by a tenth of a block at either end
    return out


def _cuts(rows: DataFrame, key: str, order: str, block_size: int) -> DataFrame:
    """(__key, __in, __cuts): quantiles of the blocks with more than ``block_size`` rows, as many as make blocks of about that."""
    shares = [k / FANOUT for k in range(1, FANOUT)]
    stats = rows.groupBy(key, "__blk").agg(F.count(F.lit(1)).alias("__rows"), F.percentile_approx(order, F.lit(shares), F.lit(10 * FANOUT)).alias("__all"))
    step = F.greatest(F.lit(1), F.ceil(F.lit(FANOUT * block_size) / F.col("__rows"))).cast("int")
    return stats.filter(F.col("__rows") > block_size).select(
        F.col(key).alias("__key"), F.col("__blk").alias("__in"), F.array_distinct(F.filter("__all", lambda x, i: (i + 1) % step == 0)).alias("__cuts"))


def _cut(df: DataFrame, cuts: DataFrame, key: str, order: str, bounded: bool) -> DataFrame:
    """Each block of ``df`` cut into at most ``FANOUT``: the number of cuts below the row is the last digit of the new block."""
    d = df.join(F.broadcast(cuts) if bounded else cuts, (F.col(key) == F.col("__key")) & (F.col("__blk") == F.col("__in")), "left")
    # non-nullable on purpose: the join's inferred isnotnull(__blk) then folds away
    below = F.coalesce(F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(F.size(F.filter("__cuts", lambda c: c < F.col(order)))), F.lit(0))
    d = d.withColumn("__blk", F.coalesce(F.col("__blk") * FANOUT + below, F.lit(0)).cast("bigint")).drop("__key", "__in", "__cuts")
    # a shuffled join deals rows by their old block: what follows must not take that over
    return d if bounded else d.repartition(key, "__blk")


def with_blocks(df: DataFrame, key: str, order: str, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """``df`` with its blocks in ``__blk``, which the functions below then use and keep: a chain of them cuts the keys once."""
    return _blocked(df, key, order, block_size)


def ordered_positions(
    df: DataFrame,
    key: str,
    order: str,
    block_size: int = DEFAULT_BLOCK,
    prefix: str = "",
) -> DataFrame:
    """Add ``{prefix}position`` (1-based), ``{prefix}count``, ``{prefix}prev``
    and ``{prefix}next`` (neighbouring ``order`` values, null at the ends).

    ``order`` must be unique within ``key`` and integral. Block statistics
    are window aggregates over the same (key, block) partitioning as the row
    windows, so both sides of the final join have identical exchanges.
    """
    w_in = Window.partitionBy(key, "__blk").orderBy(order)
    w_blk = Window.partitionBy(key, "__blk")
    rows = (
        _blocked(df, key, order, block_size)
        .withColumn("__rn", F.row_number().over(w_in))
        .withColumn("__lag", F.lag(order).over(w_in))
        .withColumn("__lead", F.lead(order).over(w_in))
        .withColumn("__n", F.count(F.lit(1)).over(w_blk))
        .withColumn("__lo", F.min(order).over(w_blk))
        .withColumn("__hi", F.max(order).over(w_blk))
    )
    w_b = Window.partitionBy(key).orderBy("__blk")
    blocks = rows.filter(F.col("__rn") == 1).select(
        key,
        "__blk",
        F.coalesce(F.sum("__n").over(w_b.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"),
        F.sum("__n").over(Window.partitionBy(key)).alias("__total"),
        F.lag("__hi").over(w_b).alias("__prev_hi"),
        F.lead("__lo").over(w_b).alias("__next_lo"),
    )
    out = rows.join(blocks, [key, "__blk"], "inner")
    return out.select(
        *df.columns,
        (F.col("__off") + F.col("__rn")).cast("bigint").alias(f"{prefix}position"),
        F.col("__total").cast("bigint").alias(f"{prefix}count"),
        F.coalesce("__lag", "__prev_hi").alias(f"{prefix}prev"),
        F.coalesce("__lead", "__next_lo").alias(f"{prefix}next"),
    )


def running_totals(
    df: DataFrame,
    key: str,
    order: str,
    values: dict[str, str],
    block_size: int = DEFAULT_BLOCK,
    first: str | None = None,
) -> DataFrame:
    """Add exclusive running sums within ``key`` by ``order``: for each row,
    ``out = sum(src)`` over the rows of the same key with a smaller ``order``
    (``values`` maps out-name -> source column; source ``"*"`` counts rows).
    ``first`` names a further column, the least ``order`` of the key.

    Same blocking as :func:`ordered_positions`: bounded windows per block plus
    a small per-block prefix table, so no key is processed by one task.
    """
    srcs = {out: (F.lit(1) if src == "*" else F.col(src)) for out, src in values.items()}
    blocked = _blocked(df, key, order, block_size)
    w_in = Window.partitionBy(key, "__blk").orderBy(order)
    rows = blocked
    for out, c in srcs.items():
        rows = rows.withColumn(f"__in_{out}", F.coalesce(F.sum(c).over(w_in.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # the block table is a partial aggregate: one short row per block and map task is shuffled, not the input again
    sums = blocked.groupBy(key, "__blk").agg(F.min(order).alias("__lo"), *[F.sum(c).alias(f"__b_{out}") for out, c in srcs.items()])
    w_b = Window.partitionBy(key).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sums.select(
        key, "__blk", F.min("__lo").over(Window.partitionBy(key)).alias("__first"),
        *[F.coalesce(F.sum(f"__b_{out}").over(w_b), F.lit(0)).alias(f"__o_{out}") for out in srcs])
    out_df = rows.join(blocks, [key, "__blk"], "inner")
    extra = [F.col("__first").alias(first)] if first else []
    return out_df.select(*df.columns, *extra, *[(F.col(f"__o_{o}") + F.col(f"__in_{o}")).alias(o) for o in srcs])


def running_last(
    df: DataFrame,
    key: str,
    order: str,
    values: dict[str, Column],
    block_size: int = DEFAULT_BLOCK,
    inclusive: bool = False,
) -> DataFrame:
    """Add for each row the last value that is not null among the rows of the
    same key with a smaller ``order`` (``inclusive``: or its own); null if none.

    Same blocking as :func:`running_totals`.
    """
    blocked = _blocked(df, key, order, block_size)
    w_in = Window.partitionBy(key, "__blk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    rows = blocked
    for out, c in values.items():
        rows = rows.withColumn(f"__in_{out}", F.last(c, ignorenulls=True).over(w_in))
    ends = blocked.groupBy(key, "__blk").agg(*[F.max_by(c, F.when(c.isNotNull(), F.col(order))).alias(f"__b_{out}") for out, c in values.items()])
    w_b = Window.partitionBy(key).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = ends.select(key, "__blk", *[F.last(f"__b_{out}", ignorenulls=True).over(w_b).alias(f"__o_{out}") for out in values])
    out_df = rows.join(blocks, [key, "__blk"], "inner")
    return out_df.select(*df.columns, *[F.coalesce(f"__in_{o}", f"__o_{o}").alias(o) for o in values])
