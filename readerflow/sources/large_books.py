"""Books that are too large to be one value (S3): chapters from ranges of a file.

A landed file is read as lines by byte ranges, many tasks a file; a line is known
by the start of its range and its number within it. Markers are found by an
aggregate over the lines (T1). The text is then cut into chunks before lines that
begin with a chapter heading, numbered by a blocked running count, so no task
holds a book; each chunk is cleaned and split like a whole book (T2-T5, T8), and
titles are made unique over the chunks of a book (T9). The result equals
``chapters.chapters`` of the whole text. A chapter is still one value, and so is
the text between two headings.

A heading that continues over a line end ("CHAPTER", then its number) is found
inside a chunk; for that, nothing is cut where the last line with a text ends in
that word, or is not known because it lies in an earlier range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from ..operators.chapters import with_chapter_array
from ..operators.ordinal import DEFAULT_BLOCK, running_totals
from ..session import scratch_path
from .books import MAX_FILE_BYTES, landed_key

STARTS_CHAPTER = "(?iU)^" + T.WS_CLASS + "*" + K.HEADING.replace(r"\s", T.WS_CLASS)
ENDS_IN_WORD = "(?iU)CHAPTER" + T.WS_CLASS + "*$"
LINE_SCHEMA = "book_id long, part long, pos long, line string"


def book_lines(spark: SparkSession, path: str, min_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """(book_id, part, pos, line) of the landed books whose first usable file has more than ``min_bytes`` bytes.

    As in ``books.book_scan_fallback`` the non-empty file of the least location
    counts; of several of that location the least path. ``part`` is a range of
    the file, ``pos`` orders the lines of a book. The lines are written once.
    """
    meta = "_metadata.file_path", "_metadata.file_name", "_metadata.file_size", "_metadata.file_block_start"
    rows = spark.read.option("lineSep", "\n").text(path).select("value", *meta)
    book_id, priority = landed_key(F.col("file_name"))
    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "([^/]+)$", 1).alias("file_name"), F.col("path").alias("file_path"), "length")
    files = files.filter(F.col("length") > 0).select(book_id.alias("book_id"), F.struct(priority.alias("priority"), "file_path", "length").alias("f"))
    won = files.filter(F.col("book_id").isNotNull()).groupBy("book_id").agg(F.min("f").alias("f")).filter(F.col("f.length") > min_bytes)
    large = rows.filter(F.col("file_size") > min_bytes).withColumn("book_id", book_id).withColumn("at", F.monotonically_increasing_id())
    # two spellings of one path (file:/x and file:///x) differ after the scheme in slashes only
    same = lambda p: F.regexp_replace(p, "^([a-z0-9+.-]+):/*", "$1:/")
    won = won.select("book_id", same(F.col("f.file_path")).alias("won"))
    large = large.join(won, "book_id").filter(same(F.col("file_path")) == F.col("won"))
    out = scratch_path(spark, "book-lines")
    large.select("book_id", F.col("file_block_start").alias("part"), "at", F.col("value").alias("line")).write.parquet(out)
    lines = spark.read.schema("book_id long, part long, at long, line string").parquet(out)
    first = lines.groupBy("book_id", "part").agg(F.min("at").alias("first"))  # one row a range
    # a range of n bytes has at most n + 1 lines
    return lines.join(first, ["book_id", "part"]).select("book_id", "part", (2 * F.col("part") + F.col("at") - F.col("first")).alias("pos"), "line")


def _has(line: Column, literals: list[str]) -> Column:
    found = F.lit(False)
    for x in literals:
        found = found | F.contains(line, F.lit(x))
    return found


def between_markers(lines: DataFrame) -> DataFrame:
    """T1 on lines: those after the line of the START marker and before the END marker (both optional)."""
    starts, ends = _has(F.col("line"), K.START_MARKERS), _has(F.col("line"), K.END_MARKERS)
    marks = lines.filter(starts | ends).groupBy("book_id").agg(F.min(F.when(starts, F.col("pos"))).alias("__from"), F.min(F.when(ends, F.col("pos"))).alias("__to"))
    kept = lines.join(marks, "book_id", "left").filter((F.col("__from").isNull() | (F.col("pos") > F.col("__from"))) & (F.col("__to").isNull() | (F.col("pos") <= F.col("__to"))))
    places = [F.when(F.contains("line", F.lit(x)), F.call_function("locate", F.lit(x), F.col("line"))) for x in K.END_MARKERS]
    cut = F.substring("line", F.lit(1), F.least(*places) - 1) if len(places) > 1 else F.substring("line", F.lit(1), places[0] - 1)
    return kept.withColumn("line", F.when(F.col("pos") == F.col("__to"), cut).otherwise(F.col("line"))).drop("__from", "__to")


def line_chapters(lines: DataFrame, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """(book_id, chapter_ord, title, body) from ``LINE_SCHEMA`` rows."""
    text = between_markers(lines).withColumn("line", F.regexp_replace("line", "\r$", ""))
    before = Window.partitionBy("book_id", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    # the end of a line is all that is asked of the one before
    tail = F.when(T.strip_ws("line") != "", F.substring(T.strip_ws("line"), -8, 8))
    last = F.last(tail, ignorenulls=True).over(before)
    text = text.withColumn("__cut", (F.col("line").rlike(STARTS_CHAPTER) & F.coalesce(~last.rlike(ENDS_IN_WORD), F.lit(False))).cast("long"))
    text = running_totals(text, "book_id", "pos", {"__cuts": "__cut"}, block_size).withColumn("chunk", F.col("__cuts") + F.col("__cut"))
    chunks = text.groupBy("book_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines"))
    chunks = chunks.select("book_id", "chunk", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("__raw"))
    out = scratch_path(lines.sparkSession, "book-chunks")
    chunks.withColumn("text", T.preprocess(T.strip_ws("__raw"))).drop("__raw").write.parquet(out)
    chunks = lines.sparkSession.read.schema("book_id long, chunk long, text string").parquet(out)
    parts = with_chapter_array(chunks.withColumn("__headed", F.col("text").rlike(T.HEADING_PATTERN)))
    parts = parts.select("book_id", "chunk", "__headed", F.inline_outer("chapters")).filter(F.col("title").isNotNull())
    parts = parts.select("book_id", F.struct("chunk", "pos").alias("at"), "title", "body", "__headed")
    # a chunk without a heading is text before the first one, or a book without any
    headed = parts.groupBy("book_id").agg(F.max("__headed").alias("__any"))
    parts = parts.join(headed, "book_id").filter(F.col("__headed") | ~F.col("__any"))
    merged = parts.groupBy("book_id", "title").agg(F.min("at").alias("first"), F.max("at").alias("at"))
    order = Window.partitionBy("book_id").orderBy("first")
    merged = merged.withColumn("chapter_ord", F.row_number().over(order).cast("bigint"))  # a book's titles, without its text
    return merged.drop("first").join(parts.drop("title"), ["book_id", "at"]).select("book_id", "chapter_ord", "title", "body")


def large_book_chapters(spark: SparkSession, path: str, min_bytes: int = MAX_FILE_BYTES, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """S3 + T1-T9: chapters of the landed books that ``books.scan_landed_books`` leaves out as too large."""
    return line_chapters(book_lines(spark, path, min_bytes), block_size)
