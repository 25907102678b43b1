"""Column-in / Column-out text functions.

All of them are built-in Catalyst expressions, so they stay inside whole-stage
codegen and never leave the JVM.
"""

from __future__ import annotations

import re
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K

# Python's str.strip()/str.split()/re's \s use the characters for which
# str.isspace() holds (29 of them); Java's trim() knows one and \s six.
# The set is derived from that rule rather than listed.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# Regex class with the same membership, safe inside a Java character class.
WS_CLASS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"

# (?iU): case-insensitive with Unicode case folding, Unicode \d; whitespace via WS_CLASS.
HEADING_PATTERN = "(?iU)" + K.HEADING.replace(r"\s", WS_CLASS)
# Anchored variant for clean corpora: heading must start a line and end a word.
HEADING_PATTERN_ANCHORED = "(?imU)^" + K.HEADING.replace(r"\s", WS_CLASS).replace(r"]+[^", r"]+\b[^")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col: Column | str) -> Column:
    """Python ``str.strip()`` (all Unicode whitespace, not Java ``trim``)."""
    return F.trim(_c(col), F.lit(WHITESPACE))


def norm_crlf(col: Column | str) -> Column:
    """CRLF -> LF."""
    return F.replace(_c(col), F.lit("\r\n"), F.lit("\n"))


def collapse_newlines(col: Column | str) -> Column:
    """T4: three or more newlines -> exactly two."""
    return F.regexp_replace(_c(col), "\n{3,}", "\n\n")


def collapse_blanks(col: Column | str) -> Column:
    """T5: runs of space/tab -> one space (other whitespace untouched).

    Written as ``[ \t]{2,}|\t`` rather than ``[ \t]+``: the same result, but a
    single space (most of any text) is no longer a match to replace.
    """
    return F.regexp_replace(_c(col), "[ \t]{2,}|\t", " ")


def truncate(col: Column | str, max_chars: int | None) -> Column:
    """First ``max_chars`` code points; ``None`` keeps the whole text."""
    c = _c(col)
    return c if max_chars is None else F.substring(c, 1, int(max_chars))


def preprocess(col: Column | str, max_chars: int | None = None) -> Column:
    """T3 -> T4 -> T5 (-> T6 where a limit is given), in that order."""
    return truncate(collapse_blanks(collapse_newlines(norm_crlf(col))), max_chars)


def _first_literal(col: Column, literals: list[str]) -> tuple[Column, Column]:
    """1-based position of the earliest of several literal markers, and the end
    (1-based, inclusive) of that match. Both null when none occurs."""
    pos = [F.when(F.instr(col, lit) > 0, F.instr(col, lit)) for lit in literals]
    first = F.least(*pos)
    end = F.coalesce(
        *[F.when(p == first, first + F.lit(len(lit) - 1)) for p, lit in zip(pos, literals)]
    )
    return first, end


def strip_markers(col: Column | str, footer: str = "exact") -> Column:
    """T1 + T2: :func:`cut_markers`, then Python-style strip."""
    return strip_ws(cut_markers(col, footer))


def cut_markers(col: Column | str, footer: str = "exact") -> Column:
    """Cut the text between the START and END markers (no strip).

    ``footer='reference'`` reproduces the original offsets exactly: the END
    position is measured on the uncut text but applied after the head was cut,
    and only the marker prefix (up to GUTENBERG) is removed from the head.
    ``footer='exact'`` (default) drops the whole START line and ends right
    before the END marker; END before START gives an empty text.
    """
    c = _c(col)
    s_pos, s_end = _first_literal(c, K.START_MARKERS)
    e_pos, _ = _first_literal(c, K.END_MARKERS)
    if footer == "reference":
        start0 = F.coalesce(s_end, F.lit(0))  # chars dropped from the head
        rest = F.substring(c, start0 + 1, F.lit(2**31 - 1))
        body = F.when(e_pos.isNull(), rest).otherwise(F.substring(rest, 1, e_pos - 1))
    elif footer == "exact":
        nl = F.call_function("locate", F.lit("\n"), c, F.coalesce(s_end, F.lit(0)) + 1)
        start0 = F.when(s_pos.isNull(), F.lit(0)).when(nl > 0, nl).otherwise(F.length(c))
        stop0 = F.coalesce(e_pos - 1, F.length(c))  # chars kept from the original
        body = F.substring(c, start0 + 1, F.greatest(stop0 - start0, F.lit(0)))
    else:
        raise ValueError(f"footer must be 'exact' or 'reference', got {footer!r}")
    return body


def heading_titles(col: Column | str, anchored: bool = False) -> Column:
    """T8 (titles): every heading match, in text order."""
    pat = HEADING_PATTERN_ANCHORED if anchored else HEADING_PATTERN
    return F.regexp_extract_all(_c(col), F.lit(pat), 1)


def heading_pieces(col: Column | str, anchored: bool = False) -> Column:
    """T8 (bodies): the text split at headings; element 1 is the preface."""
    pat = HEADING_PATTERN_ANCHORED if anchored else HEADING_PATTERN
    return F.split(_c(col), pat, -1)


def preview_label(ord0: Column | str, speaker: Column | str, line: Column | str) -> Column:
    """``#<i+1> <speaker>: <first 30 chars of line>...``."""
    return F.concat(
        F.lit("#"),
        (_c(ord0) + 1).cast("string"),
        F.lit(" "),
        F.coalesce(_c(speaker), F.lit("")),
        F.lit(": "),
        F.substring(F.coalesce(_c(line), F.lit("")), 1, K.PREVIEW_LINE_CHARS),
        F.lit("..."),
    )


def words(col: Column | str) -> Column:
    """Python ``str.split()``: whitespace-separated tokens, no empty tokens."""
    return F.filter(F.split(_c(col), WS_CLASS + "+", -1), lambda t: t != F.lit(""))


def first_words(col: Column | str, n: int) -> Column:
    """``s.split()[:n]``, scanning only the prefix."""
    return words(F.regexp_extract(_c(col), "^" + WS_CLASS + "*+(?:[^" + WS_CLASS[1:-1] + "]++" + WS_CLASS + "*+){0," + str(n) + "}", 0))


def first_word(col: Column | str) -> Column:
    """``s.split()[0]`` (null when there is no token), scanning only the prefix."""
    w = F.regexp_extract(_c(col), "^" + WS_CLASS + "*([^" + WS_CLASS[1:-1] + "]+)", 1)
    return F.when(w != F.lit(""), w)


def render(template: str, **fields: Column) -> Column:
    """``template.format(**fields)`` as one ``concat``: single pass, so a value
    that itself contains ``{name}`` is never substituted again."""
    parts: list[Column] = []
    for literal, name, spec, conv in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            if spec or conv:
                raise ValueError("format specs are not supported")
            parts.append(fields[name])
    return F.concat(*parts) if parts else F.lit("")


def sql_literal(text: str) -> str:
    """ANSI SQL string literal (for oracle SQL built from the same constants)."""
    return "'" + text.replace("'", "''") + "'"


def sql_render(template: str, **fields: str) -> str:
    """SQL twin of :func:`render` (``||`` concatenation)."""
    parts: list[str] = []
    for literal, name, _spec, _conv in Formatter().parse(template):
        if literal:
            parts.append(sql_text(literal))
        if name is not None:
            parts.append(f"({fields[name]})")
    return "(" + " || ".join(parts) + ")"


def sql_text(text: str) -> str:
    """SQL expression for a literal that may hold control characters."""
    out: list[str] = []
    for chunk in re.split(r"([\n\r\t])", text):
        if not chunk:
            continue
        out.append(f"chr({ord(chunk)})" if chunk in "\n\r\t" else sql_literal(chunk))
    return " || ".join(out) if out else "''"
