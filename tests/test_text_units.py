"""Hand-made edge rows from FIXTURES.md §2 (text, chapters, prompts, JSON)."""

from pyspark.sql import functions as F

from readerflow import constants as K
from readerflow.functions import model_json as J
from readerflow.functions import text as T
from readerflow.operators import chapters as CH

MARKED = (
    "H*** START OF THE PROJECT GUTENBERG X ***\nbody\n"
    "*** END OF THE PROJECT GUTENBERG X ***\nfooter"
)


def one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_strip_markers_reference_keeps_offset_bug(spark):
    assert one(spark, T.strip_markers("s", "reference"), MARKED) == "X ***\nbody\n*** END OF THE PROJECT GUTENBERG X"


def test_strip_markers_exact(spark):
    assert one(spark, T.strip_markers("s", "exact"), MARKED) == "body"
    assert one(spark, T.strip_markers("s", "exact"), MARKED.replace("THE", "THIS")) == "body"


def test_strip_markers_without_markers_trims(spark):
    assert one(spark, T.strip_markers("s"), "  plain text \n") == "plain text"


def test_strip_markers_end_before_start_is_empty(spark):
    txt = "*** END OF THE PROJECT GUTENBERG Z ***\nx\n*** START OF THE PROJECT GUTENBERG Z ***\nbody"
    assert one(spark, T.strip_markers("s", "exact"), txt) == ""


def test_collapse_newlines_and_blanks(spark):
    assert one(spark, T.collapse_newlines("s"), "a\n\n\n\nb") == "a\n\nb"
    assert one(spark, T.collapse_newlines("s"), "a\n \nb") == "a\n \nb"
    assert one(spark, T.collapse_blanks("s"), "a \t b") == "a b"
    assert one(spark, T.collapse_blanks("s"), "a  b") == "a  b"


def test_trim_unicode(spark):
    assert one(spark, T.strip_ws("s"), "　x\u001f") == "x"
    assert one(spark, T.strip_ws("s"), "﻿x") == "﻿x"  # BOM is not whitespace


def test_whitespace_set_is_pythons():
    assert len(T.WHITESPACE) == 29
    assert all(c.isspace() for c in T.WHITESPACE)


def chapter_rows(spark, text, dedup=False):
    df = spark.createDataFrame([(1, text)], "book_id bigint, text string")
    rows = (CH.chapters(df) if dedup else CH.split_chapters(df)).orderBy(
        "chapter_ord" if dedup else "chapter_pos"
    ).collect()
    return [(r["title"], r["body"]) for r in rows]


def test_split_chapters_edges(spark):
    assert chapter_rows(spark, "no heads") == [(K.FULL_TEXT_TITLE, "no heads")]
    assert chapter_rows(spark, "pre\nChapter 2\nb") == [("Chapter 2", "b")]
    assert chapter_rows(spark, "CHAPTER I") == [("CHAPTER I", "")]
    assert chapter_rows(spark, "see chapter called x\nmore") == [("chapter called x", "more")]
    assert chapter_rows(spark, "CHAPTER\n\nItem z") == [("CHAPTER\n\nItem z", "")]


def test_split_chapters_unicode_heading(spark):
    # Python's IGNORECASE matches dotless i for I; Unicode digits count as \d
    assert chapter_rows(spark, "x\nchapter ı\nbody") == [("chapter ı", "body")]
    assert chapter_rows(spark, "x\nCHAPTER ٣\nbody") == [("CHAPTER ٣", "body")]


def test_dedup_keeps_first_position_last_body(spark):
    text = "CHAPTER I\na\nCHAPTER II\nb\nCHAPTER I\nc"
    assert chapter_rows(spark, text, dedup=True) == [("CHAPTER I", "c"), ("CHAPTER II", "b")]


def test_split_reconcatenates(spark):
    text = "preface\nCHAPTER I one\nalpha\nChapter 2 two\nbeta"
    df = spark.createDataFrame([(1, text)], "book_id bigint, text string")
    arr = CH.with_chapter_array(df).select("chapters").first()[0]
    assert [c["title"] for c in arr] == ["CHAPTER I one", "Chapter 2 two"]
    assert [c["body"] for c in arr] == ["alpha", "beta"]


def test_combine_and_prompt_window(spark):
    sel = spark.createDataFrame(
        [(1, 1, "a" * 3500), (1, 2, "b" * 3500)], "book_id bigint, sel_ord bigint, body string"
    )
    c = CH.combine_chapters(sel).first()
    assert len(c["combined"]) == 6002
    assert c["combined"].startswith("a" * 3000 + "\n\nb")
    w = sel.sparkSession.createDataFrame([(c["combined"],)], "s string").select(CH.prompt_window("s")).first()[0]
    assert len(w) == 4000


def test_default_combined_in_row(spark):
    df = spark.createDataFrame([(1, "CHAPTER I\n" + "x" * 10 + "\nCHAPTER II\ny\nCHAPTER III\nz")], "book_id bigint, text string")
    r = CH.with_default_combined(df, max_chapter_chars=4).first()
    assert r["combined"] == "xxxx\n\ny"
    assert r["has_headings"] is True


def unwrap(spark, raw):
    r = spark.createDataFrame([(raw,)], "raw string").select(J.unwrap_dialogues("raw").alias("u")).first()["u"]
    return r["status"], (None if r["items"] is None else [str(x) for x in r["items"]])


def test_unwrap_dialogues(spark):
    assert unwrap(spark, '[{"speaker":"B"}]') == ("ok", ['{"speaker":"B"}'])
    assert unwrap(spark, '{"note":"[x]","n":3,"dialogues":[{"speaker":"A"}],"z":[1]}') == ("ok", ['{"speaker":"A"}'])
    assert unwrap(spark, '{"tips":["x"],"dialogues":[{}]}') == ("ok", ['"x"'])
    assert unwrap(spark, '{"a":1}') == ("empty", [])
    assert unwrap(spark, "oops")[0] == "malformed"
    assert unwrap(spark, "5")[0] == "malformed"


def test_render_is_single_pass(spark):
    col = T.render(K.ROLEPLAY_PROMPT, context=F.lit("{dialogue}"), dialogue=F.lit("D"))
    out = spark.range(1).select(col).first()[0]
    assert out == K.ROLEPLAY_PROMPT.format(context="{dialogue}", dialogue="D")
