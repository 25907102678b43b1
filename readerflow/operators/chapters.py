"""Book cleaning and chapter operators.

A book is one row, so everything up to the chapter table is computed inside
that row with built-in higher-order functions: splitting, de-duplicating and
numbering chapters needs no shuffle at all. The load -> chapters pipeline is
one narrow stage; the only exchange appears when a user-supplied selection
table is joined in (L2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from .barrier import materialize

def clean_books(
    books: DataFrame,
    footer: str = "exact",
    max_chars: int | None = None,
    text_col: str = "raw_text",
) -> DataFrame:
    """(book_id, raw_text) -> (book_id, text, n_chars). The whole text
    is kept; ``max_chars`` applies the cut T6."""
    text = T.preprocess(T.strip_markers(F.col(text_col), footer), max_chars)
    clean = materialize(books.select("book_id", text_col), text=text).drop(text_col)
    return clean.withColumn("n_chars", F.length("text").cast("bigint"))


def with_chapter_array(df: DataFrame, text_col: str = "text", anchored: bool = False, out: str = "chapters") -> DataFrame:
    """Add ``out`` = array<struct<pos,title,body>> in text order.

    Text before the first heading is dropped. Without any heading the whole
    (unstripped) text becomes one chapter titled ``Full Text``. Titles and
    pieces are materialised as columns first and zipped (no random access
    into an expensive array from inside a lambda).
    """
    d = df.withColumn("__titles", T.heading_titles(text_col, anchored)).withColumn(
        "__pieces", T.heading_pieces(text_col, anchored)
    )
    n = F.size("__titles")
    split = F.transform(
        F.arrays_zip(F.col("__titles").alias("t"), F.slice("__pieces", F.lit(2), F.greatest(n, F.lit(0))).alias("b")),
        lambda e, i: F.struct((i + 1).alias("pos"), T.strip_ws(e["t"]).alias("title"), T.strip_ws(e["b"]).alias("body")),
    )
    whole = F.array(F.struct(F.lit(1).alias("pos"), F.lit(K.FULL_TEXT_TITLE).alias("title"), F.col(text_col).alias("body")))
    return d.withColumn(out, F.when(n == 0, whole).otherwise(split)).drop("__titles", "__pieces")


def dedup_chapter_array(df: DataFrame, col: str = "chapters", out: str = "chapters") -> DataFrame:
    """T9 on the array column: a repeated title keeps its first position and its
    last body (insertion-ordered dict semantics); ``chapter_ord`` is 1-based.

    O(n log n) per book: sort by (title, pos), flag group starts/ends against
    the neighbour arrays, zip the starts with the ends, sort by first position.
    Each step is its own column so the plan stays linear in size.
    """
    d = df.withColumn(
        "__srt",
        F.array_sort(F.transform(col, lambda c: F.struct(c["title"].alias("title"), c["pos"].alias("pos"), c["body"].alias("body")))),
    )
    d = d.withColumn("__st", F.transform("__srt", lambda c: c["title"]))
    m = F.greatest(F.size("__srt") - 1, F.lit(0))
    prev = F.concat(F.array(F.lit(None).cast("string")), F.slice("__st", F.lit(1), m))
    nxt = F.concat(F.slice("__st", F.lit(2), m), F.array(F.lit(None).cast("string")))
    d = d.withColumn("__z", F.arrays_zip(F.col("__srt").alias("c"), prev.alias("p"), nxt.alias("q")))
    d = d.withColumn("__starts", F.filter("__z", lambda e: ~e["p"].eqNullSafe(e["c"]["title"]))).withColumn(
        "__ends", F.filter("__z", lambda e: ~e["q"].eqNullSafe(e["c"]["title"]))
    )
    merged = F.transform(
        F.arrays_zip(F.col("__starts").alias("s"), F.col("__ends").alias("e")),
        lambda x: F.struct(
            x["s"]["c"]["pos"].alias("first_pos"), x["s"]["c"]["title"].alias("title"), x["e"]["c"]["body"].alias("body")
        ),
    )
    numbered = F.transform(
        F.array_sort(merged),
        lambda c, i: F.struct((i + 1).alias("chapter_ord"), c["title"].alias("title"), c["body"].alias("body")),
    )
    return d.withColumn(out, numbered).drop("__srt", "__st", "__z", "__starts", "__ends")


def explode_structs(df: DataFrame, col: str, keep: tuple[str, ...] = ("book_id",)) -> DataFrame:
    """Rows from an array<struct> column, dropping rows whose array is null.

    ``inline_outer`` is used on purpose: a plain ``inline`` makes the optimizer
    infer ``size(array) > 0`` and push that predicate below every projection,
    which inlines the whole text pipeline into one oversized Filter. The null
    guard is applied to a generated column, which stays above the Generate.
    """
    fields = df.schema[col].dataType.elementType.fieldNames()
    out = df.select(*keep, F.inline_outer(col))
    return out.filter(F.col(fields[0]).isNotNull())


def split_chapters(clean: DataFrame, anchored: bool = False) -> DataFrame:
    """T8 rows: (book_id, chapter_pos, title, body) before de-duplication."""
    arr = with_chapter_array(clean.select("book_id", "text"), anchored=anchored)
    return explode_structs(arr, "chapters").select(
        "book_id", F.col("pos").cast("bigint").alias("chapter_pos"), "title", "body"
    )


def chapters(clean: DataFrame, anchored: bool = False) -> DataFrame:
    """T8 + T9 rows: (book_id, chapter_ord, title, body), one per distinct title."""
    arr = dedup_chapter_array(with_chapter_array(clean.select("book_id", "text"), anchored=anchored))
    return explode_structs(arr, "chapters").select(
        "book_id", F.col("chapter_ord").cast("bigint").alias("chapter_ord"), "title", "body"
    )


def default_chapters(chapter_rows: DataFrame, n: int = K.DEFAULT_CHAPTERS) -> DataFrame:
    """L1: the first ``n`` chapters of each book (all when fewer).

    ``chapter_ord`` is already a dense 1-based position, so this is a filter,
    not a window.
    """
    return chapter_rows.filter(F.col("chapter_ord") <= n)


def select_chapters(chapter_rows: DataFrame, selection: DataFrame) -> DataFrame:
    """L2: a user's chapter choice ``selection(book_id, title, sel_ord)``, kept in
    selection order. Equi-join on (book_id, title); both sides keyed."""
    return chapter_rows.join(selection, ["book_id", "title"], "inner").select(
        "book_id", F.col("sel_ord").cast("bigint").alias("sel_ord"), "chapter_ord", "title", "body"
    )


def _picked(clean: DataFrame, selection: DataFrame, anchored: bool) -> DataFrame:
    """(book_id, picks): the chosen chapters of each book in selection order.

    The selection, a few short rows a book, is grouped first; one join on
    book_id then brings the two together and the chapters are picked by title
    inside the book's row, so no chapter body is exploded, joined or grouped.
    """
    wish = selection.groupBy("book_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("sel_ord").cast("bigint").alias("sel_ord"), "title"))).alias("__wish"))
    d = clean.select("book_id", "text").join(wish, "book_id", "inner")
    d = dedup_chapter_array(with_chapter_array(d, anchored=anchored)).drop("text")
    by_title = F.map_from_entries(F.transform("chapters", lambda c: F.struct(c["title"], F.struct(c["chapter_ord"].alias("chapter_ord"), c["body"].alias("body")))))
    d = materialize(d, __map=by_title).drop("chapters")
    hits = F.transform("__wish", lambda w: F.struct(
        w["sel_ord"].alias("sel_ord"), w["title"].alias("title"), F.try_element_at("__map", w["title"]).alias("c")))
    d = materialize(d, __hits=hits)
    return d.select("book_id", F.filter("__hits", lambda h: h["c"].isNotNull()).alias("picks"))


def selected_chapters(clean: DataFrame, selection: DataFrame, anchored: bool = False) -> DataFrame:
    """L2 from whole books: (book_id, sel_ord, chapter_ord, title, body)."""
    rows = _picked(clean, selection, anchored).select("book_id", F.inline_outer("picks")).filter(F.col("sel_ord").isNotNull())
    return rows.select("book_id", "sel_ord", F.col("c.chapter_ord").cast("bigint").alias("chapter_ord"), "title", F.col("c.body").alias("body"))


def combine_selection(
    clean: DataFrame,
    selection: DataFrame,
    max_chapter_chars: int = K.MAX_CHAPTER_CHARS,
    extra_limits: dict[str, int] | None = None,
    anchored: bool = False,
) -> DataFrame:
    """L2 + L3 from whole books: (book_id, n_selected, combined[, extra columns]);
    books without a chosen chapter give no row."""
    limits = {"combined": max_chapter_chars, **(extra_limits or {})}

    def cut(n: int):
        return lambda p: F.substring(p["c"]["body"], 1, n)

    p = _picked(clean, selection, anchored).filter(F.size("picks") > 0)
    return p.select(
        "book_id", F.size("picks").cast("bigint").alias("n_selected"),
        *[F.array_join(F.transform("picks", cut(n)), K.CHAPTER_JOINER).alias(a) for a, n in limits.items()],
    )


# What a paragraph that is too long for a window is cut into: quotations within it, sentences, stray marks ...
ATOMS = r'"[^"]*"\s*|“[^”]*”\s*|[^"“.!?]+[.!?]*\s*|[.!?]+\s*|["“]'
# ... and, where one of these is still too long, words.
WORDS = r"\S+\s*|\s+"


def _cut_long(parts: Column, budget: int, cut) -> Column:
    """Parts over the budget replaced by their cuts."""
    return F.flatten(F.transform(parts, lambda p: F.when(F.length(p) > budget, cut(p)).otherwise(F.array(p))))


def text_atoms(text: Column, budget: int) -> Column:
    """The text as an array of parts that windows keep whole, none over the budget: paragraphs (with the blank lines
    after them); of a longer one its quotations and sentences; of a longer one of these words; of a longer word pieces."""
    a = F.split(text, r"(?<=\n\n)(?!\n)", -1)
    for pattern in (ATOMS, WORDS):
        a = _cut_long(a, budget, lambda p, x=pattern: F.regexp_extract_all(p, F.lit(x), F.lit(0)))
    pieces = lambda p: F.transform(F.sequence(F.lit(1), F.length(p), F.lit(budget)), lambda at: F.substring(p, at, F.lit(budget)))
    return _cut_long(a, budget, pieces)


def pack_windows(atoms: Column, budget: int) -> Column:
    """Greedy fold: consecutive parts joined for as long as they stay within the budget."""
    none = F.lit("")
    start = F.struct(F.array().cast("array<string>").alias("done"), none.alias("now"), F.lit(0).alias("n"))

    def step(s, p):
        fits = s["n"] + F.length(p) <= budget
        return F.struct(
            F.when(fits, s["done"]).otherwise(F.concat(s["done"], F.array(s["now"]))).alias("done"),
            F.when(fits, F.concat(s["now"], p)).otherwise(p).alias("now"),
            F.when(fits, s["n"] + F.length(p)).otherwise(F.length(p)).alias("n"))

    return F.aggregate(atoms, start, step, lambda s: F.when(s["n"] > 0, F.concat(s["done"], F.array(s["now"]))).otherwise(s["done"]))


def chapter_windows(clean: DataFrame, window_chars: int = K.MAX_PROMPT_CHARS, anchored: bool = False) -> DataFrame:
    """Whole books as (book_id, chapter_ord, window_no, title, window): consecutive
    windows of at most ``window_chars`` characters that together are every
    chapter's whole body, cut at natural borders (:func:`text_atoms`): a
    quotation within one paragraph is only cut if it is longer than a window
    itself. An empty body gives no window."""
    rows = chapters(clean, anchored).filter(F.length("body") > 0)
    rows = materialize(rows, atoms=text_atoms(F.col("body"), window_chars)).drop("body")
    rows = rows.select("book_id", "chapter_ord", "title", F.posexplode(pack_windows(F.col("atoms"), window_chars)).alias("window_no", "window"))
    return rows.select("book_id", "chapter_ord", F.col("window_no").cast("bigint").alias("window_no"), "title", "window")


def combine_chapters(
    selected: DataFrame,
    max_chapter_chars: int = K.MAX_CHAPTER_CHARS,
    order_col: str = "sel_ord",
    extra_limits: dict[str, int] | None = None,
) -> DataFrame:
    """L3: each selected body cut to ``max_chapter_chars``, joined by a blank line
    in selection order -> (book_id, n_selected, combined[, extra columns]).

    ``extra_limits`` adds more cuts of the same selection in the same pass
    (alias -> chars). For rows that are already selected; from whole books,
    :func:`combine_selection` does the same inside the book's row.
    """
    limits = {"combined": max_chapter_chars, **(extra_limits or {})}
    widest = max(limits.values())
    parts = F.array_sort(
        F.collect_list(F.struct(F.col(order_col).alias("o"), F.substring("body", 1, widest).alias("b")))
    )
    def cut(n: int):
        return lambda p: F.substring(p["b"], 1, n)

    return selected.groupBy("book_id").agg(
        F.count(F.lit(1)).alias("n_selected"),
        *[F.array_join(F.transform(parts, cut(n)), K.CHAPTER_JOINER).alias(a) for a, n in limits.items()],
    )


def prompt_window(combined: Column | str, max_chars: int = K.MAX_PROMPT_CHARS) -> Column:
    """L4: the model sees the first ``max_chars`` characters."""
    c = F.col(combined) if isinstance(combined, str) else combined
    return F.substring(c, 1, max_chars)


def with_default_combined(
    clean: DataFrame,
    n: int = K.DEFAULT_CHAPTERS,
    max_chapter_chars: int = K.MAX_CHAPTER_CHARS,
    anchored: bool = False,
    out: str = "combined",
) -> DataFrame:
    """L1 + L3 inside the book row: add ``out`` = the first ``n`` chapters, each
    cut, joined by a blank line, and ``has_headings`` (false for the Full Text
    fallback). No shuffle: a book's chapters never leave its row."""
    d = dedup_chapter_array(with_chapter_array(clean, anchored=anchored))
    cut = F.transform(F.slice("chapters", 1, n), lambda c: F.substring(c["body"], 1, max_chapter_chars))
    heads = F.element_at("chapters", 1)["title"] != F.lit(K.FULL_TEXT_TITLE)
    return materialize(d, **{out: F.array_join(cut, K.CHAPTER_JOINER), "has_headings": heads}).drop("chapters")
