"""DuckDB-SQL twins of the Column functions, built from the same constants.

Used only for the oracle queries in ``plans.registry``. RE2 has no Unicode
whitespace class, so the heading class here is ASCII; the oracle fixtures
hold ASCII whitespace only (Unicode cases are covered by unit tests).
"""

from __future__ import annotations

from .. import constants as K
from ..functions.text import WHITESPACE, sql_literal

WS_CHARS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
HEADING_RE = "(?i)" + K.HEADING.replace(r"\s", r"[\s\v\x1c-\x1f]").replace(r"\d", "0-9")


def strip_ws(x: str) -> str:
    return f"trim({x}, {WS_CHARS})"


def preprocess(x: str, max_chars: int | None = None) -> str:
    s = f"replace({x}, chr(13) || chr(10), chr(10))"
    s = f"regexp_replace({s}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    s = f"regexp_replace({s}, '[ \\t]+', ' ', 'g')"
    return s if max_chars is None else f"substring({s}, 1, {int(max_chars)})"


def _first(x: str, literals: list[str]) -> tuple[str, str]:
    pos = [f"nullif(strpos({x}, {sql_literal(m)}), 0)" for m in literals]
    first = f"least({', '.join(pos)})"
    end = "coalesce(" + ", ".join(
        f"CASE WHEN {p} = {first} THEN {first} + {len(m) - 1} END" for p, m in zip(pos, literals)
    ) + ")"
    return first, end


def strip_markers(x: str, footer: str = "exact") -> str:
    return strip_ws(cut_markers(x, footer))


def cut_markers(x: str, footer: str = "exact") -> str:
    s_pos, s_end = _first(x, K.START_MARKERS)
    e_pos, _ = _first(x, K.END_MARKERS)
    if footer == "reference":
        rest = f"substring({x}, coalesce({s_end}, 0) + 1)"
        body = f"CASE WHEN {e_pos} IS NULL THEN {rest} ELSE substring({rest}, 1, {e_pos} - 1) END"
    else:
        nl_rel = f"strpos(substring({x}, coalesce({s_end}, 0) + 1), chr(10))"
        start0 = (
            f"(CASE WHEN {s_pos} IS NULL THEN 0 WHEN {nl_rel} > 0 THEN coalesce({s_end}, 0) + {nl_rel} "
            f"ELSE length({x}) END)"
        )
        stop0 = f"coalesce({e_pos} - 1, length({x}))"
        body = f"substring({x}, {start0} + 1, greatest({stop0} - {start0}, 0))"
    return body


def clean_text(x: str, footer: str = "exact", max_chars: int | None = None) -> str:
    return preprocess(strip_markers(x, footer), max_chars)


def clean_books_cte(footer: str = "exact", max_chars: int | None = None) -> str:
    return f"SELECT book_id, {clean_text('raw_text', footer, max_chars)} AS text FROM fx_books"


SPLIT_CTE = f"""
SELECT book_id, text,
  regexp_extract_all(text, '{HEADING_RE}', 1) AS titles,
  string_split_regex(text, '{HEADING_RE}') AS pieces
FROM clean
"""

# One row per heading (or the Full Text row): (book_id, chapter_pos, title, body).
SPLIT_ROWS = f"""
SELECT book_id, CAST(1 AS BIGINT) AS chapter_pos, {sql_literal(K.FULL_TEXT_TITLE)} AS title, text AS body
FROM sp WHERE len(titles) = 0
UNION ALL
SELECT book_id, chapter_pos, {strip_ws('t')} AS title, {strip_ws('b')} AS body FROM (
  SELECT book_id, unnest(titles) AS t, unnest(pieces[2:]) AS b,
         CAST(generate_subscripts(titles, 1) AS BIGINT) AS chapter_pos
  FROM sp WHERE len(titles) > 0)
"""

# De-duplicated chapters: first position, last body, dense 1-based order.
DEDUP_ROWS = """
SELECT book_id,
  CAST(row_number() OVER (PARTITION BY book_id ORDER BY first_pos) AS BIGINT) AS chapter_ord,
  title, body
FROM (
  SELECT book_id, title, min(chapter_pos) AS first_pos, arg_max(body, chapter_pos) AS body
  FROM split_rows GROUP BY book_id, title)
"""


def chapter_ctes(footer: str = "exact", max_chars: int | None = None) -> str:
    """CTE chain clean -> sp -> split_rows -> chapters (after fx_books)."""
    return (
        f"clean AS ({clean_books_cte(footer, max_chars)}),\n"
        f"sp AS ({SPLIT_CTE}),\n"
        f"split_rows AS ({SPLIT_ROWS}),\n"
        f"chapters AS ({DEDUP_ROWS})"
    )


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '[\\s\\v\\x1c-\\x1f]+'), lambda t: t <> '')"
