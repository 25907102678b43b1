"""Approximate title and author search (S2) without comparing all pairs.

A search string and a title match if their edit distance is within the string's
budget: ``max_edits``, or less for short strings, so that a string with a budget of
k has at least 3k + 1 distinct trigrams.

A title is cut into k + 1 segments of even length. Of k edits at least one segment
is left as it is, and the first segment i that has had no more than i - 1 edits
before its end is one with at most i - 1 edits to its left and at most k + 1 - i to
its right; so it is found in the search string no farther from its place than that,
seen from either end (Li et al., Pass-Join). A search string is looked up by those
few places, for each length a match may have; a segment is long (a quarter of the
title for three edits) and met at its place and for one length only, so what is
met by chance is little. Candidates are confirmed by their edit distance where they
are met: only matches are shuffled.

Case and runs of white space do not count. Null and blank strings and titles match
nothing; repeated ones are answered each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.barrier import materialize
from .books import catalog_table

MAX_EDITS = 3


def search_key(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(T.strip_ws(F.regexp_replace(c, T.WS_CLASS + "+", " ")))


def trigrams(key: Column) -> Column:
    """Distinct trigrams of a key with two blanks before and after it."""
    padded = F.concat(F.lit("  "), key, F.lit("  "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(key) + 2), lambda i: F.substring(padded, i, F.lit(3))))


def edit_budget(key: Column, max_edits: int = MAX_EDITS) -> Column:
    return F.least(F.lit(max_edits), F.floor((F.size(trigrams(key)) - 1) / 3).cast("int"))


def search_strings(catalog: DataFrame) -> DataFrame:
    """(book_id, title, name): a book is found by its whole title, its name and its author."""
    names = F.array_distinct(F.filter(F.array("title", "name", "author"), lambda x: x != ""))
    return catalog.select("book_id", "title", F.explode(names).alias("name"))


def _with_segment(rows: DataFrame) -> DataFrame:
    """``first`` character and ``size`` of segment ``i`` (from 1) of the ``k + 1`` of a title of ``chars`` characters: even sizes, those behind ``short`` longer by one."""
    rows = rows.withColumn("size", F.expr("chars div (k + 1)").cast("int")).withColumn("short", F.expr("k + 1 - chars % (k + 1)"))
    first = (F.col("i") - 1) * F.col("size") + F.greatest(F.lit(0), F.col("i") - 1 - F.col("short")) + 1
    return rows.withColumn("first", first).withColumn("size", F.col("size") + (F.col("i") > F.col("short")).cast("int"))


def _segment_key(text: Column | str, at: str) -> Column:
    """What a segment is looked up by; two that share a key by chance cost a comparison."""
    return F.xxhash64("k", "chars", "i", F.col(text).substr(F.col(at), F.col("size"))).alias("segment")


def title_segments(titles: DataFrame, max_edits: int = MAX_EDITS) -> DataFrame:
    """(name_key, segment) of the titles ``name_key`` for each budget."""
    rows = titles.select("name_key", F.length("name_key").alias("chars"), F.explode(F.sequence(F.lit(0), F.lit(max_edits))).alias("k"))
    rows = _with_segment(rows.select("*", F.explode(F.sequence(F.lit(1), F.col("k") + 1)).alias("i")))
    return rows.select("name_key", _segment_key("name_key", "first"))


def search_segments(asked: DataFrame) -> DataFrame:
    """(q_key, k, segment) of the places of a search string ``q_key`` where a segment of a title within ``k`` edits may be."""
    rows = asked.select("q_key", "k", F.length("q_key").alias("n"))
    rows = rows.select("*", F.explode(F.sequence(F.greatest(F.lit(1), F.col("n") - F.col("k")), F.col("n") + F.col("k"))).alias("chars"))
    rows = _with_segment(rows.select("*", F.explode(F.sequence(F.lit(1), F.col("k") + 1)).alias("i")))
    left, right, off = F.col("i") - 1, F.col("k") + 1 - F.col("i"), F.col("n") - F.col("chars")
    rows = rows.withColumn("lo", F.greatest(F.lit(1), F.col("first") - left, F.col("first") + off - right))
    rows = rows.withColumn("hi", F.least(F.col("n") - F.col("size") + 1, F.col("first") + left, F.col("first") + off + right))
    places = F.when(F.col("lo") <= F.col("hi"), F.sequence(F.col("lo"), F.greatest("lo", "hi")))
    return rows.select("q_key", "k", "chars", "i", "size", F.explode(places).alias("at")).select("q_key", "k", _segment_key("q_key", "at"))


def approximate_matches(queries: DataFrame, names: DataFrame, q_col: str = "q", name_col: str = "name", max_edits: int = MAX_EDITS) -> DataFrame:
    """(q, name, distance) of the distinct strings that match."""
    width = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # keys are made behind the exchange that finds the distinct strings, not again where these are read
    n = materialize(names.select(F.col(name_col).alias("name")).distinct(), name_key=search_key("name")).filter(F.col("name_key") != "")
    q = materialize(queries.select(F.col(q_col).alias("q")).distinct(), q_key=search_key("q")).filter(F.col("q_key") != "")
    # dealt by number: each string becomes many rows, and small exchanges would be put together into one task
    titles = title_segments(n.select("name_key").repartition(width, "name_key").distinct(), max_edits)
    asked = q.select("q_key").repartition(width, "q_key").distinct().withColumn("k", edit_budget(F.col("q_key"), max_edits))
    found = search_segments(asked).join(titles, "segment").withColumn("distance", F.expr("levenshtein(q_key, name_key, k)"))  # -1: more than k
    found = found.filter(F.col("distance") >= 0).select("q_key", "name_key", "distance").distinct()
    return found.join(q, "q_key").join(n, "name_key").select("q", "name", "distance")


def catalog_search_approximate(queries: DataFrame, q_col: str = "q", catalog: DataFrame | None = None, max_edits: int = MAX_EDITS) -> DataFrame:
    """``queries`` with title, book_id and distance of each book that a search string nearly names; the least distance of its strings."""
    spark: SparkSession = queries.sparkSession
    names = search_strings(catalog_table(spark) if catalog is None else catalog)
    hits = approximate_matches(queries, names, q_col, "name", max_edits).withColumnRenamed("q", "__q")
    best = names.join(hits, "name").groupBy("__q", "book_id", "title").agg(F.min("distance").alias("distance"))
    return queries.join(best, queries[q_col] == best["__q"]).select(*[queries[c] for c in queries.columns], "title", "book_id", "distance")
