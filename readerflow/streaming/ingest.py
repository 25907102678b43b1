"""ST2: landed book files -> cleaned text -> chapter rows, as a stream.

Cleaning, splitting and de-duplicating happen inside each book's row (see
``operators.chapters``), so the streaming plan is map-only: append mode, no
state, no shuffle. Rows carry the load that they come from, and readers take
each book's latest (``read_chapters``). Files are laid out as ``<root>/book_id=<id>/<file>``; the
book id comes from partition discovery. ``land_books`` instead writes Parquet
batches of (book_id, raw_text) -- many books per file, the layout to use at
scale, where millions of one-book files would make listing the bottleneck.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T
from ..operators import chapters as CH

BOOK_FILE_SCHEMA = "value string, book_id bigint"
BOOK_BATCH_SCHEMA = "book_id bigint, load_seq bigint, raw_text string"
CHAPTER_SCHEMA = "book_id bigint, load_seq bigint, chapter_ord bigint, title string, body string"


def land_book_files(books: DataFrame, root: str) -> None:
    """Write (book_id, raw_text) rows as one text file per book under ``root``."""
    books.select("book_id", "raw_text").repartition("book_id").write.mode("append").partitionBy("book_id").text(root)


def land_books(books: DataFrame, root: str, load_seq: int = 0, files: int | None = None) -> None:
    """Append (book_id, load_seq, raw_text) rows to ``root`` as Parquet batches;
    a later load of a book has a larger ``load_seq``."""
    b = books.select("book_id", F.lit(load_seq).cast("bigint").alias("load_seq"), "raw_text")
    (b.repartition(files) if files else b).write.mode("append").parquet(root)


def book_file_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of one-book text files (``land_book_files`` layout)."""
    r = spark.readStream.schema(BOOK_FILE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    loaded = F.unix_micros("_metadata.file_modification_time").alias("load_seq")  # a file written later is a later load
    return r.text(root, wholetext=True).select("book_id", loaded, F.col("value").alias("raw_text"))


def book_batch_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of Parquet book batches (``land_books`` layout)."""
    r = spark.readStream.schema(BOOK_BATCH_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(root)


def chapter_stream(books: DataFrame, footer: str = "exact", max_chars: int | None = None) -> DataFrame:
    """T1-T9 over a (streaming or batch) frame (book_id, load_seq, raw_text). The
    book pipeline works by book_id; the load goes along inside a composite id.
    Texts that are empty once stripped are failed loads and give no row (S4)."""
    key = F.struct("book_id", "load_seq").alias("book_id")
    b = books.filter(T.strip_markers("raw_text", footer) != F.lit("")).select(key, "raw_text")
    rows = CH.chapters(CH.clean_books(b, footer, max_chars))
    return rows.select("book_id.book_id", "book_id.load_seq", "chapter_ord", "title", "body")


def read_chapters(spark: SparkSession, out_path: str) -> DataFrame:
    """Current chapters: those of each book's latest load, which replaces all
    chapters of the loads before it. ``load_seq`` is found first, without bodies."""
    rows = spark.read.schema(CHAPTER_SCHEMA).parquet(out_path)
    latest = rows.select("book_id", "load_seq").groupBy("book_id").agg(F.max("load_seq").alias("load_seq"))
    return rows.join(latest, ["book_id", "load_seq"], "left_semi").drop("load_seq")


def start_chapters(books: DataFrame, out_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the chapters of a streaming frame (book_id, load_seq, raw_text)."""
    w = chapter_stream(books).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start(out_path)


def start_ingest(spark: SparkSession, root: str, out_path: str, checkpoint: str, available_now: bool = True,
                 max_files_per_trigger: int | None = None, layout: str = "parquet") -> StreamingQuery:
    source = book_batch_stream if layout == "parquet" else book_file_stream
    return start_chapters(source(spark, root, max_files_per_trigger), out_path, checkpoint, available_now)
