"""Streaming queries (ST1, ST2). Each runs its stream to completion with an
``availableNow`` trigger into a fresh folder under the session's shared
checkpoint folder and returns the batch read of the sink; the oracle is the
equivalent batch query. The sources are the given tables themselves, one file
or a folder of many."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.fixtures import books_from_documents, feedback_from_events, with_fixtures
from ..streaming import ingest as ST2
from ..streaming import progress as ST1
from . import sqlgen as S
from .registry import query

TIMEOUT_SECONDS = 4 * 3600


def table_stream(spark, sf_dir: str, name: str):
    """Stream of a given table: one file, or a folder of files.

    The file source takes a folder or a glob; as a glob (one that only the
    table's own name matches) the path may be either."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path[:-1] + "[t]")


def finish(q) -> None:
    """Wait for a stream that reads what there is; one that does not end is stopped and reported."""
    if not q.awaitTermination(TIMEOUT_SECONDS):
        q.stop()
        raise TimeoutError(f"stream still active after {TIMEOUT_SECONDS} s")


@query(
    "stream_progress",
    with_fixtures(
        "SELECT learner_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_practice, "
        "avg(coalesce(accuracy_score, 0)) AS avg_accuracy FROM fx_feedback WHERE mode = 'shadowing' GROUP BY 1, 2",
        "fx_feedback",
    ),
)
def q_stream_progress(spark, sf):
    base = scratch_path(spark, "stream_progress")
    out, state = f"{base}/out", f"{base}/state"
    finish(ST1.start_progress(feedback_from_events(table_stream(spark, sf, "events")), out, f"{base}/checkpoint"))
    return ST1.compact_progress(spark, out, state).select("learner_id", "day", "n_practice", "avg_accuracy")


OLD_HEADING, NEW_HEADING = "  Two", "  Two again"
INGEST_SQL = with_fixtures("", "fx_books").replace("fx_books AS (", "fx_loaded AS (") + """,
fx_books AS (SELECT book_id, CASE WHEN book_id % 9 = 4 THEN replace(raw_text, '  Two', '  Two again') ELSE raw_text END AS raw_text FROM fx_loaded),
""" + S.chapter_ctes()


@query("stream_ingest", INGEST_SQL + "\nSELECT book_id, chapter_ord, title, CAST(length(body) AS BIGINT) AS n_chars, sha256(body) AS body_hash FROM chapters")
def q_stream_ingest(spark, sf):
    """ST2 straight from the table. Some books are loaded again with another
    text, which replaces their chapters; a reload without a text changes nothing."""
    base = scratch_path(spark, "stream_ingest")
    books = books_from_documents(table_stream(spark, sf, "documents"))

    def load(df, seq, text):
        return df.select("book_id", F.lit(seq).cast("bigint").alias("load_seq"), text.alias("raw_text"))

    again = books.filter(F.col("book_id") % 9 == 4)
    loads = (load(books, 1, F.col("raw_text")).unionByName(load(again, 2, F.replace("raw_text", F.lit(OLD_HEADING), F.lit(NEW_HEADING))))
             .unionByName(load(books.filter(F.col("book_id") % 9 == 5), 3, F.lit(" \n"))))
    finish(ST2.start_chapters(loads, f"{base}/out", f"{base}/checkpoint"))
    rows = ST2.read_chapters(spark, f"{base}/out")
    return rows.select("book_id", "chapter_ord", "title", F.length("body").cast("bigint").alias("n_chars"), F.sha2("body", 256).alias("body_hash"))
