"""Queries over fx_books: cleaning, chapters, selection, prompt window."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from ..operators import chapters as CH
from ..sources import large_books as LB
from ..sources.fixtures import fx_books, table, with_fixtures
from . import sqlgen as S
from .registry import query

SMALL_BOOK, SMALL_CHAPTER, SMALL_PROMPT = 2000, 500, 700


def _books(spark, sf):
    return fx_books(spark, sf)


def _sql(body: str) -> str:
    return with_fixtures(body, "fx_books")


# ---------------------------------------------------------------- T1-T7
@query("strip_markers_exact", _sql(f"SELECT book_id, {S.strip_markers('raw_text', 'exact')} AS text FROM fx_books"))
def q_strip_exact(spark, sf):
    return _books(spark, sf).select("book_id", T.strip_markers("raw_text", "exact").alias("text"))


@query("strip_markers_reference", _sql(f"SELECT book_id, {S.strip_markers('raw_text', 'reference')} AS text FROM fx_books"))
def q_strip_reference(spark, sf):
    return _books(spark, sf).select("book_id", T.strip_markers("raw_text", "reference").alias("text"))


@query(
    "trim_unicode",
    _sql(
        f"SELECT book_id, CAST(length({S.cut_markers('raw_text')}) AS BIGINT) AS n_untrimmed, "
        f"{S.strip_ws(S.cut_markers('raw_text'))} AS text FROM fx_books"
    ),
)
def q_trim_unicode(spark, sf):
    cut = T.cut_markers("raw_text")
    return _books(spark, sf).select(
        "book_id", F.length(cut).cast("bigint").alias("n_untrimmed"), T.strip_ws(cut).alias("text")
    )


def _stripped_sql() -> str:
    return S.strip_markers("raw_text")


@query(
    "norm_crlf",
    _sql(
        f"SELECT book_id, replace({_stripped_sql()}, chr(13) || chr(10), chr(10)) AS text FROM fx_books"
    ),
)
def q_norm_crlf(spark, sf):
    return _books(spark, sf).select("book_id", T.norm_crlf(T.strip_markers("raw_text")).alias("text"))


@query(
    "collapse_newlines",
    _sql(
        "SELECT book_id, regexp_replace(replace("
        f"{_stripped_sql()}, chr(13) || chr(10), chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g') AS text FROM fx_books"
    ),
)
def q_collapse_newlines(spark, sf):
    return _books(spark, sf).select(
        "book_id", T.collapse_newlines(T.norm_crlf(T.strip_markers("raw_text"))).alias("text")
    )


@query("collapse_blanks", _sql(f"SELECT book_id, {S.preprocess(_stripped_sql(), None)} AS text FROM fx_books"))
def q_collapse_blanks(spark, sf):
    return _books(spark, sf).select("book_id", T.preprocess(T.strip_markers("raw_text"), None).alias("text"))


@query(
    "truncate_book",
    _sql(
        f"SELECT book_id, CAST(length({S.preprocess(_stripped_sql(), K.MAX_BOOK_CHARS)}) AS BIGINT) AS n_default, "
        f"{S.preprocess(_stripped_sql(), SMALL_BOOK)} AS text_small FROM fx_books"
    ),
)
def q_truncate_book(spark, sf):
    s = T.strip_markers("raw_text")
    return _books(spark, sf).select(
        "book_id",
        F.length(T.preprocess(s, K.MAX_BOOK_CHARS)).cast("bigint").alias("n_default"),
        T.preprocess(s, SMALL_BOOK).alias("text_small"),
    )


@query("book_length", _sql(f"SELECT book_id, CAST(length({S.clean_text('raw_text')}) AS BIGINT) AS n_chars FROM fx_books"))
def q_book_length(spark, sf):
    return CH.clean_books(_books(spark, sf)).select("book_id", "n_chars")


# ---------------------------------------------------------------- T8, T9, L1
def _chapter_sql(body: str, footer: str = "exact", max_chars=None) -> str:
    return with_fixtures("", "fx_books") + ",\n" + S.chapter_ctes(footer, max_chars) + "\n" + body


@query("split_chapters", _chapter_sql("SELECT book_id, chapter_pos, title, body FROM split_rows"))
def q_split_chapters(spark, sf):
    return CH.split_chapters(CH.clean_books(_books(spark, sf)))


@query("dedup_chapters", _chapter_sql("SELECT book_id, chapter_ord, title, body FROM chapters"))
def q_dedup_chapters(spark, sf):
    return CH.chapters(CH.clean_books(_books(spark, sf)))


@query("split_chapters_whole", _chapter_sql("SELECT book_id, chapter_pos, title, body FROM split_rows", max_chars=None))
def q_split_chapters_whole(spark, sf):
    """T8 on whole texts (no T6 cut)."""
    return CH.split_chapters(CH.clean_books(_books(spark, sf), max_chars=None))


@query("dedup_chapters_whole", _chapter_sql("SELECT book_id, chapter_ord, title, body FROM chapters", max_chars=None))
def q_dedup_chapters_whole(spark, sf):
    """T8 + T9 on whole texts (no T6 cut)."""
    return CH.chapters(CH.clean_books(_books(spark, sf), max_chars=None))


@query("large_book_chapters", _chapter_sql("SELECT book_id, chapter_ord, title, body FROM chapters", max_chars=None))
def q_large_book_chapters(spark, sf):
    """S3: chapters from lines in ranges of twenty, as the range reader gives them."""
    b = _books(spark, sf).select("book_id", F.posexplode(F.split("raw_text", "\n", -1)).alias("n", "line"))
    return LB.line_chapters(b.select("book_id", F.floor(F.col("n") / 20).alias("part"), F.col("n").cast("long").alias("pos"), "line"))


DEFAULT_CHAPTERS_SQL = _chapter_sql(
    f"SELECT book_id, chapter_ord, title, CAST(length(body) AS BIGINT) AS n_chars, sha256(body) AS body_hash FROM chapters "
    f"WHERE chapter_ord <= {K.DEFAULT_CHAPTERS}"
)


def default_chapters_df(spark, sf):
    ch = CH.default_chapters(CH.chapters(CH.clean_books(_books(spark, sf))))
    return ch.select("book_id", "chapter_ord", "title", F.length("body").cast("bigint").alias("n_chars"), F.sha2("body", 256).alias("body_hash"))


query("default_chapters", DEFAULT_CHAPTERS_SQL)(default_chapters_df)


# ---------------------------------------------------------------- L2-L4
# A chapter choice derived per book: the second heading first, then the first,
# then a title no book has (it selects nothing).
SELECTION = [("Chapter 2 Two", 1), ("CHAPTER I. One", 2), ("CHAPTER XL. Missing", 3)]


def _selection(books):
    rows = F.array(*[F.struct(F.lit(t).alias("title"), F.lit(o).alias("sel_ord")) for t, o in SELECTION])
    return books.select("book_id", F.inline(rows))


_SELECTION_SQL = " UNION ALL ".join(
    f"SELECT book_id, {T.sql_literal(t)} AS title, {o} AS sel_ord FROM fx_books" for t, o in SELECTION
)


def _clean_and_selection(spark, sf):
    books = _books(spark, sf)
    return CH.clean_books(books), _selection(table(spark, sf, "documents").select(F.col("doc_id").alias("book_id")))


_SELECTED_SQL = (
    "SELECT c.book_id, CAST(s.sel_ord AS BIGINT) AS sel_ord, c.chapter_ord, c.title, c.body "
    f"FROM chapters c JOIN ({_SELECTION_SQL}) s ON c.book_id = s.book_id AND c.title = s.title"
)


@query(
    "select_chapters",
    _chapter_sql(f"SELECT book_id, sel_ord, chapter_ord, title, CAST(length(body) AS BIGINT) AS n_chars, sha256(body) AS body_hash FROM ({_SELECTED_SQL})"),
)
def q_select_chapters(spark, sf):
    return CH.selected_chapters(*_clean_and_selection(spark, sf)).select(
        "book_id", "sel_ord", "chapter_ord", "title", F.length("body").cast("bigint").alias("n_chars"), F.sha2("body", 256).alias("body_hash")
    )


def _combined_sql(n: int) -> str:
    return (
        f"string_agg(substring(body, 1, {n}), chr(10) || chr(10) ORDER BY sel_ord)"
    )


COMBINE_SQL = _chapter_sql(
    f"SELECT book_id, count(*) AS n_selected, {_combined_sql(K.MAX_CHAPTER_CHARS)} AS combined, "
    f"{_combined_sql(SMALL_CHAPTER)} AS combined_small FROM ({_SELECTED_SQL}) GROUP BY book_id"
)


def _combine(spark, sf):
    return CH.combine_selection(*_clean_and_selection(spark, sf), extra_limits={"combined_small": SMALL_CHAPTER})


@query("combine_chapters", COMBINE_SQL)
def q_combine_chapters(spark, sf):
    return _combine(spark, sf).select("book_id", "n_selected", "combined", "combined_small")


@query(
    "prompt_window",
    _chapter_sql(
        f"SELECT book_id, substring({_combined_sql(K.MAX_CHAPTER_CHARS)}, 1, {K.MAX_PROMPT_CHARS}) AS prompt_text, "
        f"substring({_combined_sql(K.MAX_CHAPTER_CHARS)}, 1, {SMALL_PROMPT}) AS prompt_small "
        f"FROM ({_SELECTED_SQL}) GROUP BY book_id"
    ),
)
def q_prompt_window(spark, sf):
    c = CH.combine_selection(*_clean_and_selection(spark, sf))
    return c.select(
        "book_id",
        CH.prompt_window("combined").alias("prompt_text"),
        CH.prompt_window("combined", SMALL_PROMPT).alias("prompt_small"),
    )
