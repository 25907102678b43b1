"""Queries over fx_dialogues: filters, cards, counts, slices, cursors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import sql_literal
from ..operators import dialogues as D
from ..session import scratch_path
from ..sources.fixtures import fx_dialogues, with_fixtures
from ..sources.line_index import LineIndex
from .registry import query

# Filter choice used by the registered queries (mixed-case keyword on purpose).
LEVELS = ["Beginner", "Advanced"]
SPEAKERS = ["user", K.UNKNOWN_SPEAKER]
KEYWORD = "The"
# A stricter choice that leaves some books with no match (exercises F5).
STRICT_LEVELS = ["Advanced"]
STRICT_KEYWORD = "ea"
SLICE_START, SLICE_N = 1, 5


def _in(values) -> str:
    return "(" + ", ".join(sql_literal(v) for v in values) + ")"


SQL_DIFF = "coalesce(difficulty, 'Intermediate')"
SQL_SPEAKER = f"coalesce(speaker, {sql_literal(K.UNKNOWN_SPEAKER)})"
SQL_F1 = f"{SQL_DIFF} IN {_in(LEVELS)}"
SQL_F2 = f"{SQL_SPEAKER} IN {_in(SPEAKERS)}"
SQL_F3 = f"coalesce(contains(lower(line), {sql_literal(KEYWORD.lower())}), false)"
SQL_F4 = f"({SQL_F1} AND {SQL_F2} AND {SQL_F3})"
SQL_STRICT = (
    f"({SQL_DIFF} IN {_in(STRICT_LEVELS)} AND coalesce(contains(lower(line), "
    f"{sql_literal(STRICT_KEYWORD)}), false))"
)


def _sql(body: str) -> str:
    return with_fixtures(body, "fx_dialogues")


def _dlg(spark, sf):
    return fx_dialogues(spark, sf)


def _strict():
    return D.difficulty_in(STRICT_LEVELS) & D.keyword_contains(STRICT_KEYWORD)


@query("difficulty_in", _sql(f"SELECT book_id, dlg_ord, difficulty FROM fx_dialogues WHERE {SQL_F1}"))
def q_difficulty_in(spark, sf):
    return _dlg(spark, sf).filter(D.difficulty_in(LEVELS)).select("book_id", "dlg_ord", "difficulty")


@query("speaker_in", _sql(f"SELECT book_id, dlg_ord, speaker FROM fx_dialogues WHERE {SQL_F2}"))
def q_speaker_in(spark, sf):
    return _dlg(spark, sf).filter(D.speaker_in(SPEAKERS)).select("book_id", "dlg_ord", "speaker")


@query("keyword_contains", _sql(f"SELECT book_id, dlg_ord FROM fx_dialogues WHERE {SQL_F3}"))
def q_keyword_contains(spark, sf):
    return _dlg(spark, sf).filter(D.keyword_contains(KEYWORD)).select("book_id", "dlg_ord")


# a frequent and a rare keyword, one across words, one too short for the index, none
INDEXED_KEYWORDS = [KEYWORD, "Ouréa", "a b", "q", ""]
SQL_INDEXED = f"""SELECT k.keyword, book_id, dlg_ord FROM fx_dialogues, (VALUES {", ".join(f"({sql_literal(k)})" for k in INDEXED_KEYWORDS)}) k(keyword)
WHERE k.keyword = '' OR coalesce(contains(lower(line), lower(k.keyword)), false)"""


@query("keyword_search_indexed", _sql(SQL_INDEXED))
def q_keyword_search_indexed(spark, sf):
    """F3 over dialogues stored with the trigrams of their lines: parts that cannot hold the keyword are not read."""
    d = _dlg(spark, sf).select("book_id", "dlg_ord", "line")
    t = LineIndex(spark, scratch_path(spark, "line_index"), d.schema, 64)
    t.add(d)
    found = [t.search(k).select(F.lit(k).alias("keyword"), "book_id", "dlg_ord") for k in INDEXED_KEYWORDS]
    return reduce(lambda a, b: a.unionByName(b), found)


@query("filter_dialogues", _sql(f"SELECT book_id, dlg_ord, speaker, difficulty FROM fx_dialogues WHERE {SQL_F4}"))
def q_filter_dialogues(spark, sf):
    return D.filter_dialogues(_dlg(spark, sf), LEVELS, SPEAKERS, KEYWORD).select(
        "book_id", "dlg_ord", "speaker", "difficulty"
    )


EMPTY_FALLBACK_SQL = f"""
f AS (SELECT book_id, dlg_ord, {SQL_STRICT} AS passed FROM fx_dialogues)
SELECT book_id, dlg_ord, passed FROM f
WHERE passed OR book_id NOT IN (SELECT book_id FROM f WHERE passed)
"""


@query("empty_fallback", with_fixtures("", "fx_dialogues") + ",\n" + EMPTY_FALLBACK_SQL)
def q_empty_fallback(spark, sf):
    d = _dlg(spark, sf)
    return D.empty_fallback(d, _strict()).select("book_id", "dlg_ord", F.coalesce(_strict(), F.lit(False)).alias("passed"))


@query(
    "dialogue_card",
    _sql(
        f"SELECT book_id, dlg_ord, {SQL_SPEAKER} AS speaker, {SQL_DIFF} AS difficulty, "
        f"coalesce(CASE {SQL_DIFF} "
        + " ".join(f"WHEN {sql_literal(d)} THEN {sql_literal(b)}" for d, b in K.DIFFICULTY_BADGES)
        + f" END, {sql_literal(K.DEFAULT_BADGE)}) AS badge, "
        "coalesce(line, '') AS line, coalesce(modern_equivalent, '') AS modern_equivalent, "
        f"coalesce(array_to_string(key_expressions, {sql_literal(K.KEY_EXPRESSION_JOINER)}), '') AS key_expressions, "
        "coalesce(context, '') AS context FROM fx_dialogues"
    ),
)
def q_dialogue_card(spark, sf):
    return D.dialogue_card(_dlg(spark, sf))


@query(
    "preview_label",
    _sql(
        "SELECT book_id, dlg_ord, '#' || CAST(dlg_ord + 1 AS VARCHAR) || ' ' || coalesce(speaker, '') || ': ' "
        f"|| substring(coalesce(line, ''), 1, {K.PREVIEW_LINE_CHARS}) || '...' AS label FROM fx_dialogues"
    ),
)
def q_preview_label(spark, sf):
    return D.preview_labels(_dlg(spark, sf))


PICKER_SQL = f"""
f AS (SELECT *, {SQL_STRICT} AS passed FROM fx_dialogues),
kept AS (SELECT * FROM f WHERE passed OR book_id NOT IN (SELECT book_id FROM f WHERE passed))
SELECT book_id, dlg_ord, '#' || CAST(row_number() OVER (PARTITION BY book_id ORDER BY dlg_ord) AS VARCHAR) || ' ' || coalesce(speaker, '') || ': '
  || substring(coalesce(line, ''), 1, {K.PREVIEW_LINE_CHARS}) || '...' AS label FROM kept
"""


@query("picker_label", with_fixtures("", "fx_dialogues") + ",\n" + PICKER_SQL)
def q_picker_label(spark, sf):
    """T10 as the picker numbers its rows: by place in the filtered or fallback list."""
    return D.picker_labels(_dlg(spark, sf), _strict())


@query(
    "join_list_text",
    _sql(
        f"SELECT book_id, dlg_ord, coalesce(array_to_string(key_expressions, {sql_literal(K.KEY_EXPRESSION_JOINER)}), '') "
        "AS key_text FROM fx_dialogues"
    ),
)
def q_join_list_text(spark, sf):
    return _dlg(spark, sf).select(
        "book_id", "dlg_ord", D.join_list("key_expressions", K.KEY_EXPRESSION_JOINER).alias("key_text")
    )


@query(
    "difficulty_badge",
    _sql(
        f"SELECT book_id, dlg_ord, difficulty, coalesce(CASE {SQL_DIFF} "
        + " ".join(f"WHEN {sql_literal(d)} THEN {sql_literal(b)}" for d, b in K.DIFFICULTY_BADGES)
        + f" END, {sql_literal(K.DEFAULT_BADGE)}) AS badge FROM fx_dialogues"
    ),
)
def q_difficulty_badge(spark, sf):
    return _dlg(spark, sf).select("book_id", "dlg_ord", "difficulty", D.badge_class().alias("badge"))


@query("distinct_speakers", _sql(f"SELECT DISTINCT book_id, {SQL_SPEAKER} AS speaker FROM fx_dialogues"))
def q_distinct_speakers(spark, sf):
    return D.distinct_speakers(_dlg(spark, sf))


@query("count_dialogues", _sql("SELECT book_id, count(*) AS n_dialogues FROM fx_dialogues GROUP BY book_id"))
def q_count_dialogues(spark, sf):
    return D.count_dialogues(_dlg(spark, sf))


@query(
    "count_filtered",
    _sql(
        f"SELECT book_id, count(*) AS n_dialogues, CAST(count(*) FILTER (WHERE {SQL_F4}) AS BIGINT) AS n_filtered "
        "FROM fx_dialogues GROUP BY book_id"
    ),
)
def q_count_filtered(spark, sf):
    return D.count_filtered(_dlg(spark, sf), D.dialogue_filter(LEVELS, SPEAKERS, KEYWORD))


SQL_SLICE = f"dlg_ord >= {SLICE_START} AND dlg_ord < {SLICE_START + SLICE_N}"


@query("roleplay_slice", _sql(f"SELECT book_id, dlg_ord, speaker, line FROM fx_dialogues WHERE {SQL_SLICE}"))
def q_roleplay_slice(spark, sf):
    return D.roleplay_slice(_dlg(spark, sf), SLICE_START, SLICE_N).select("book_id", "dlg_ord", "speaker", "line")


@query(
    "first_8_lines",
    _sql(
        f"SELECT book_id, dlg_ord FROM fx_dialogues WHERE dlg_ord >= 0 AND dlg_ord < {K.ROLEPLAY_MAX_LINES} "
        f"AND dlg_ord < {K.MAX_ROLEPLAY_LINES}"
    ),
)
def q_first_8_lines(spark, sf):
    s = D.roleplay_slice(_dlg(spark, sf), 0, K.ROLEPLAY_MAX_LINES)
    return D.first_lines(s, 0).select("book_id", "dlg_ord")


@query(
    "first_context",
    _sql(
        f"SELECT book_id, coalesce(arg_min(coalesce(context, ''), dlg_ord), '') AS context "
        f"FROM fx_dialogues WHERE {SQL_SLICE} GROUP BY book_id"
    ),
)
def q_first_context(spark, sf):
    return D.first_context(D.roleplay_slice(_dlg(spark, sf), SLICE_START, SLICE_N))


PREV_NEXT_SQL = f"""
f AS (SELECT book_id, dlg_ord, {SQL_STRICT} AS passed FROM fx_dialogues),
kept AS (SELECT book_id, dlg_ord FROM f WHERE passed OR book_id NOT IN (SELECT book_id FROM f WHERE passed))
SELECT book_id, dlg_ord,
  CAST(row_number() OVER w AS BIGINT) AS position,
  CAST(count(*) OVER (PARTITION BY book_id) AS BIGINT) AS n_total,
  lag(dlg_ord) OVER w AS prev_ord, lead(dlg_ord) OVER w AS next_ord,
  CAST(row_number() OVER w AS VARCHAR) || ' / ' || CAST(count(*) OVER (PARTITION BY book_id) AS VARCHAR) AS label
FROM kept WINDOW w AS (PARTITION BY book_id ORDER BY dlg_ord)
"""


@query("prev_next", with_fixtures("", "fx_dialogues") + ",\n" + PREV_NEXT_SQL)
def q_prev_next(spark, sf):
    practice = D.empty_fallback(_dlg(spark, sf), _strict())
    return D.prev_next(practice)


CAP_N = 3  # the number that the prompt asks for


@query(
    "cap_expressions",
    _sql(
        f"SELECT book_id, dlg_ord, CAST(len(coalesce(key_expressions, [])[1:{CAP_N}]) AS BIGINT) AS n_expressions, "
        f"array_to_string(coalesce(key_expressions, [])[1:{CAP_N}], {sql_literal(K.KEY_EXPRESSION_JOINER)}) "
        "AS expressions FROM fx_dialogues"
    ),
)
def q_cap_expressions(spark, sf):
    capped = D.cap_expressions("key_expressions")
    return _dlg(spark, sf).select(
        "book_id",
        "dlg_ord",
        F.size(capped).cast("bigint").alias("n_expressions"),
        F.array_join(capped, K.KEY_EXPRESSION_JOINER).alias("expressions"),
    )
