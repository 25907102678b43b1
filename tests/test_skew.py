"""Skewed keys: one key holds most rows. Results must be exact, and the
blocked operators must bound every window partition by the block size."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from readerflow.operators import conversation as C
from readerflow.operators import dialogues as D
from readerflow.operators import ordinal as O
from readerflow.sources import books as B


def skewed(spark, hot=5000, cold=20):
    # key 0 holds `hot` rows, keys 1..cold one row each; orders are sparse
    return spark.range(hot).select(F.lit(0).cast("bigint").alias("k"), (F.col("id") * 3).alias("o")).unionByName(
        spark.range(1, cold + 1).select(F.col("id").alias("k"), F.lit(7).cast("bigint").alias("o"))
    )


def test_positions_on_hot_key(spark):
    df = skewed(spark)
    out = O.ordered_positions(df, "k", "o", block_size=64)
    hot = out.filter("k = 0")
    assert hot.agg(F.min("position"), F.max("position"), F.countDistinct("position")).first() == (1, 5000, 5000)
    row = hot.filter("o = 3 * 64").first()
    assert (row.position, row.prev, row.next) == (65, 3 * 63, 3 * 65)
    # window partitions are (k, block)
    per_block = O._blocked(df, "k", "o", 64).groupBy("k", "__blk").count().agg(F.max("count")).first()[0]
    assert per_block <= 128


def test_running_totals_on_hot_key(spark):
    df = skewed(spark, hot=3000).withColumn("v", F.lit(2))
    out = O.running_totals(df, "k", "o", {"n": "*", "s": "v"}, block_size=50)
    w = Window.partitionBy("k").orderBy("o")
    ref = df.select("k", "o", (F.row_number().over(w) - 1).alias("expected"))
    bad = out.join(ref, ["k", "o"]).filter((F.col("n") != F.col("expected")) | (F.col("s") != 2 * F.col("expected")))
    assert bad.count() == 0 and out.count() == df.count()


def test_fallback_and_lists_on_hot_key(spark):
    dlg = spark.range(4000).select(
        F.lit(1).cast("bigint").alias("book_id"), F.col("id").alias("dlg_ord"), F.lit("A").alias("speaker"),
        F.when(F.col("id") == 3999, "needle").otherwise("hay").alias("line"),
    ).unionByName(spark.createDataFrame([(2, 0, "B", "hay")], "book_id bigint, dlg_ord bigint, speaker string, line string"))
    kept = D.empty_fallback(dlg, D.keyword_contains("needle"))
    assert sorted((r.book_id, r.dlg_ord) for r in kept.collect()) == [(1, 3999), (2, 0)]
    msgs = dlg.select(F.col("book_id").alias("conv_id"), F.col("dlg_ord").alias("turn"), F.lit("user").alias("role"),
                      F.col("line").alias("content"))
    import json

    rows = C.collect_user_lines(msgs, chunk=100).filter("conv_id = 1").orderBy("chunk_no").collect()
    lines = [x for r in rows for x in json.loads(r.lines_json)]
    assert len(lines) == 4000 and lines[-1] == "needle" and max(r.n_lines for r in rows) == 100


def test_million_line_conversation_stays_in_chunks(spark):
    msgs = spark.range(1_000_000).select(F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
                                         F.col("id").cast("string").alias("content"))
    r = C.collect_user_lines(msgs).agg(F.max("n_lines"), F.sum("n_lines"), F.count("*")).first()
    assert tuple(r) == (C.CHUNK, 1_000_000, -(-1_000_000 // C.CHUNK))


def test_blocks_are_even_on_sparse_and_clustered_orders(spark):
    """Time-like orders with large gaps, and orders crowded into one corner, still give blocks of a bounded size."""
    sparse = spark.range(20_000).select(F.lit(0).cast("bigint").alias("k"), (F.col("id") * 1_000_003).alias("o"))
    crowded = spark.range(20_000).select(F.lit(1).cast("bigint").alias("k"), F.when(F.col("id") < 19_999, F.col("id")).otherwise(F.lit(10**12)).alias("o"))
    df = sparse.unionByName(crowded)
    sizes = O._blocked(df, "k", "o", 500).groupBy("k", "__blk").count().groupBy("k").agg(F.max("count"), F.count("*")).collect()
    assert all(most <= 1000 and 20 <= n <= 80 for _, most, n in sizes), sizes
    out = O.ordered_positions(df, "k", "o", block_size=500)
    assert out.groupBy("k").agg(F.min("position"), F.max("position"), F.countDistinct("position")).count() == 2
    w = Window.partitionBy("k").orderBy("o")
    ref = df.select("k", "o", F.row_number().over(w).alias("p"), F.lag("o").over(w).alias("a"), F.lead("o").over(w).alias("b"))
    bad = out.join(ref, ["k", "o"]).filter("position <> p OR NOT (prev <=> a) OR NOT (next <=> b)")
    assert bad.count() == 0


def test_blocks_are_cut_until_they_are_small(spark, monkeypatch):
    """More blocks than one round of quantiles makes; with cuts that are sent and with cuts that are joined."""
    monkeypatch.setattr(O, "FANOUT", 16)
    df = skewed(spark, hot=3000).withColumn("v", F.col("o") % 7)
    w = Window.partitionBy("k").orderBy("o")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    ref = df.select("k", "o", F.row_number().over(w).alias("p"), F.lag("o").over(w).alias("a"), F.lead("o").over(w).alias("b"),
                    F.coalesce(F.sum("v").over(before), F.lit(0)).alias("t"), F.last(F.when(F.col("v") == 3, F.col("o")), True).over(before).alias("l")).collect()
    for sent in (O.MAX_SENT, 0):
        monkeypatch.setattr(O, "MAX_SENT", sent)
        cut = O.with_blocks(df, "k", "o", block_size=10)
        n, most = cut.groupBy("k", "__blk").count().filter("k = 0").agg(F.count("*"), F.max("count")).first()
        assert most <= 40 and n >= 75, (n, most)
        pos = {(r.k, r.o): (r.position, r.prev, r.next) for r in O.ordered_positions(cut, "k", "o", 10).collect()}
        tot = {(r.k, r.o): r.t for r in O.running_totals(cut, "k", "o", {"t": "v"}, 10).collect()}
        lst = {(r.k, r.o): r.l for r in O.running_last(cut, "k", "o", {"l": F.when(F.col("v") == 3, F.col("o"))}, 10).collect()}
        assert all(pos[r.k, r.o] == (r.p, r.a, r.b) and tot[r.k, r.o] == r.t and lst[r.k, r.o] == r.l for r in ref) and len(pos) == len(ref)


def test_small_keys_are_not_sketched(spark):
    df = skewed(spark, hot=50)
    plan = O._blocked(df, "k", "o", 50)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "Join" not in plan
    assert "percentile" in O._blocked(df, "k", "o", 49)._jdf.queryExecution().optimizedPlan().toString()


def test_fallback_many_candidates_one_book(spark):
    c = spark.range(10000).select(F.lit(5).cast("bigint").alias("book_id"), (F.col("id") % 3 + 1).cast("int").alias("priority"),
                                  F.concat(F.lit("copy "), F.col("id").cast("string")).alias("raw_text"))
    r = B.book_scan_fallback(c).first()
    assert r.priority == 1
