"""Book sources (S1-S4, S7): catalogue, landed book files, load fallbacks.

The engine does not download anything: books are landed as files first
(named like their download locations: ``<id>-0.txt``, ``<id>.txt``,
``pg<id>.txt``) and scanned here. The first non-empty candidate in location
order wins, as a ``min_by`` aggregate per book.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from ..operators.barrier import materialize

# Largest landed file that is read as one value.
MAX_FILE_BYTES = 256 << 20

TITLE_PATTERN = r"^(.*?)\s*\(([^()]*)\)\s*$"


def _file_pattern(location: str) -> str:
    """Landed file name pattern of a download location: its last path
    segment, with the book id captured."""
    name = location.rsplit("/", 1)[-1]
    return "^" + re.escape(name).replace(re.escape("{book_id}"), r"(\d+)") + "$"


# Landed file name -> (book id, location priority), in location order.
FILE_PATTERNS = [(_file_pattern(loc), i + 1) for i, loc in enumerate(K.BOOK_LOCATIONS)]


# ------------------------------------------------------------------ S1, S2
def catalog_table(spark: SparkSession) -> DataFrame:
    """The 10-row catalogue: (title, book_id, name, author)."""
    c = spark.createDataFrame(K.CATALOG, "title string, book_id bigint")
    return c.select(
        "title", "book_id",
        F.regexp_extract("title", TITLE_PATTERN, 1).alias("name"),
        F.regexp_extract("title", TITLE_PATTERN, 2).alias("author"),
    )


def catalog_lookup(requests: DataFrame, title_col: str = "title") -> DataFrame:
    """Exact title -> book id. The catalogue has a fixed 10 rows, so it
    is broadcast; titles not in it are dropped (inner join)."""
    cat = catalog_table(requests.sparkSession).select(F.col("title").alias("__t"), F.col("book_id").alias("catalog_id"))
    return requests.join(F.broadcast(cat), requests[title_col] == cat["__t"], "inner").drop("__t")


def _catalog_array() -> Column:
    return F.array(*[F.struct(F.lit(t).alias("title"), F.lit(i).cast("bigint").alias("book_id")) for t, i in K.CATALOG])


def may_match(q: Column) -> Column:
    """Whether a search string occurs in any title at all: one look into all of
    them, to drop strings before they become rows."""
    return F.lit("\n".join(t.lower() for t, _ in K.CATALOG)).contains(q)


def catalog_search(queries: DataFrame, q_col: str = "q") -> DataFrame:
    """Case-insensitive substring search over title and author.

    The catalogue is a literal array filtered inside each query row: no join,
    no shuffle, nothing broadcast.
    """
    q = F.lower(F.col(q_col))
    hits = F.filter(_catalog_array(), lambda c: F.lower(c["title"]).contains(q))
    return queries.select("*", F.explode_outer(hits).alias("__hit")).filter(F.col("__hit").isNotNull()).select(
        *queries.columns, F.col("__hit.title").alias("title"), F.col("__hit.book_id").alias("book_id")
    )


# ------------------------------------------------------------------ S3, S4, S7
def landed_key(name: Column) -> tuple[Column, Column]:
    """(book id, location priority) of a landed file's name; null for other files."""
    book_id = F.coalesce(*[F.when(name.rlike(p), F.regexp_extract(name, p, 1)) for p, _ in FILE_PATTERNS])
    return book_id.cast("bigint"), F.coalesce(*[F.when(name.rlike(p), F.lit(n)) for p, n in FILE_PATTERNS])


def _landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of the landed files with their book id and location priority."""
    raw = spark.read.format("binaryFile").load(path).withColumn("__file", F.regexp_extract("path", "([^/]+)$", 1))
    book_id, priority = landed_key(F.col("__file"))
    return raw.select(book_id.alias("book_id"), priority.alias("priority"), "path", "length", "content").filter(
        F.col("book_id").isNotNull()
    )


def scan_landed_books(spark: SparkSession, path: str, max_file_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """S3 source: every landed file as one row (book_id, priority, raw_text).

    A file is one value here, so files over ``max_file_bytes`` are not read;
    they are reported by :func:`oversized_files`, and ``large_books`` gives
    their chapters. The size condition reaches the
    file listing. Zero-byte files give no row, so the next location wins.
    """
    files = _landed_files(spark, path).filter((F.col("length") > 0) & (F.col("length") <= max_file_bytes))
    return files.select("book_id", "priority", F.decode("content", "UTF-8").alias("raw_text"))


def oversized_files(spark: SparkSession, path: str, max_file_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """(book_id, reason) of landed files that are too large for one value; their content is not read."""
    big = _landed_files(spark, path).filter(F.col("length") > max_file_bytes)
    return big.select("book_id", F.concat(F.lit("file too large: "), F.col("length").cast("string"), F.lit(" bytes")).alias("reason"))


def book_scan_fallback(candidates: DataFrame, requested: DataFrame | None = None, repeated: bool = False) -> DataFrame:
    """S3: per book, the non-empty candidate with the lowest priority; a book
    without one gets an empty text (and priority null), like a failed fetch.
    ``requested(book_id)`` adds books that have no landed file at all.

    The winner is chosen on (book_id, priority, hash of the text) alone: those
    few bytes are what the aggregation shuffles and sorts, and the texts follow
    in one join, which AQE broadcasts where the winners are few. Several
    candidates of one book and priority: the least hash wins; where equal
    copies may have landed twice, ``repeated`` keeps one of them.
    """
    c = candidates.select("book_id", "priority", "raw_text", F.xxhash64("raw_text").alias("__h"))
    ok = F.when(F.length("raw_text") > 0, F.struct("priority", "__h"))
    best = c.select("book_id", ok.alias("__ok")).groupBy("book_id").agg(F.min("__ok").alias("b"))
    if requested is not None:
        best = requested.select("book_id").distinct().join(best, "book_id", "left")
    won = best.select("book_id", F.col("b.priority").alias("priority"), F.col("b.__h").alias("__h"))
    texts = won.filter(F.col("priority").isNotNull()).join(c, ["book_id", "priority", "__h"])
    # copies that are equal in all three give one row; the text stays out of the key
    texts = texts.groupBy("book_id", "priority").agg(F.first("raw_text").alias("raw_text")) if repeated else texts
    empty = won.filter(F.col("priority").isNull()).select("book_id", F.lit(None).cast(c.schema["priority"].dataType).alias("priority"), F.lit("").alias("raw_text"))
    return texts.select("book_id", "priority", "raw_text").unionByName(empty)


def split_loaded(books: DataFrame, text_col: str = "raw_text", footer: str = "exact") -> tuple[DataFrame, DataFrame]:
    """(loaded, load_errors); a text without anything but white space
    between its markers is a load failure."""
    ok = loaded(text_col, footer)
    return books.filter(ok), books.filter(~ok).select("book_id", F.lit("empty text").alias("reason"))


def loaded(text_col: str = "raw_text", footer: str = "exact") -> Column:
    """Whether a text has anything but white space between its markers."""
    return F.coalesce(T.strip_markers(text_col, footer) != F.lit(""), F.lit(False))


def latest_loads(loads: DataFrame, seq_col: str = "load_seq", text_col: str = "raw_text", footer: str = "exact") -> DataFrame:
    """A successful load replaces the previous one; failed ones change
    nothing. As in S4, a load without a text between its markers has failed.
    The latest (book_id, load_seq) is found first; the texts are not aggregated
    but follow in a semi-join. ``load_seq`` is unique within a book."""
    good = materialize(loads, **{text_col: F.col(text_col)}).filter(loaded(text_col, footer))
    latest = good.select("book_id", seq_col).groupBy("book_id").agg(F.max(seq_col).alias(seq_col))
    return good.join(latest, ["book_id", seq_col], "left_semi").select(*loads.columns)


def drop_superseded(derived: DataFrame, latest: DataFrame, seq_col: str = "load_seq") -> DataFrame:
    """Rows derived from a load (dialogues, chapters) stay only while that load is their book's latest."""
    return derived.join(latest.select("book_id", seq_col), ["book_id", seq_col], "left_semi")
