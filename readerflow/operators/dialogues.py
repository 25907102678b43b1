"""Dialogue-table operators: filters, cards, counts, slices, cursors.

Table: ``dialogues(book_id, dlg_ord, speaker, line, context, difficulty,
modern_equivalent, key_expressions)``; ``dlg_ord`` is the 0-based position in
the extracted list. Everything is keyed by ``book_id``; predicates are plain
Catalyst expressions so they push down to Parquet scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from .ordinal import DEFAULT_BLOCK, ordered_positions


# ------------------------------------------------------------------ F1-F4
def difficulty_value(col: str = "difficulty") -> Column:
    """Missing (or null) difficulty counts as Intermediate."""
    return F.coalesce(F.col(col), F.lit(K.DEFAULT_DIFFICULTY))


def _in_with_default(col: str, values: Sequence[str], default: str) -> Column:
    """``coalesce(col, default) IN values`` written as ``col IN values [OR col IS
    NULL]`` so that Parquet/ORC scans receive it as a pushed filter."""
    values = list(values)
    if not values:
        return F.lit(False)
    hit = F.col(col).isin(values)
    return (hit | F.col(col).isNull()) if default in values else hit


def difficulty_in(levels: Sequence[str], col: str = "difficulty") -> Column:
    """difficulty in the chosen set (missing counts as Intermediate);
    unknown values never match."""
    return _in_with_default(col, levels, K.DEFAULT_DIFFICULTY)


def speaker_value(col: str = "speaker") -> Column:
    return F.coalesce(F.col(col), F.lit(K.UNKNOWN_SPEAKER))


def speaker_in(speakers: Sequence[str], col: str = "speaker", missing_as_unknown: bool = True) -> Column:
    """pass-all iff the choice is exactly the all-speakers sentinel;
    otherwise exact membership (an empty choice matches nothing).

    ``missing_as_unknown`` lets "Unknown" select rows without a speaker, the
    label the speaker menu shows for them.
    """
    speakers = list(speakers)
    if speakers == [K.ALL_SPEAKERS]:
        return F.lit(True)
    if not speakers:
        return F.lit(False)
    if missing_as_unknown:
        return _in_with_default(col, speakers, K.UNKNOWN_SPEAKER)
    return F.col(col).isin(speakers)


def keyword_contains(keyword: str | None, col: str = "line") -> Column:
    """empty keyword passes; otherwise case-insensitive literal substring
    of the line (no wildcards)."""
    if not keyword:
        return F.lit(True)
    return F.coalesce(F.lower(F.col(col)).contains(F.lit(keyword.lower())), F.lit(False))


def dialogue_filter(levels: Sequence[str], speakers: Sequence[str], keyword: str | None) -> Column:
    """conjunction of F1-F3."""
    return difficulty_in(levels) & speaker_in(speakers) & keyword_contains(keyword)


def filter_dialogues(df: DataFrame, levels, speakers, keyword) -> DataFrame:
    return df.filter(dialogue_filter(levels, speakers, keyword))


def empty_fallback(df: DataFrame, predicate: Column, key: str = "book_id") -> DataFrame:
    """rows passing ``predicate``; for a key where none pass, all its rows.

    Per-key "any passed" is a partially aggregated count (a hot key collapses
    to one row per map task) joined back on the key. The flag table has one row
    per key: AQE broadcasts it when its measured size is small and otherwise
    keeps a sort-merge join whose skewed side it splits.
    """
    flagged = df.withColumn("__passed", F.coalesce(predicate, F.lit(False)))
    any_passed = flagged.groupBy(key).agg(F.max("__passed").alias("__any"))
    return (
        flagged.join(any_passed, key, "inner")
        .filter(F.col("__passed") | ~F.col("__any"))
        .drop("__passed", "__any")
    )


# ------------------------------------------------------------------ F9, J3, T10, T12
def badge_class(col: str = "difficulty") -> Column:
    """Difficulty -> style class, unknown -> intermediate (literal map, no join)."""
    m = F.create_map(*[x for d, b in K.DIFFICULTY_BADGES for x in (F.lit(d), F.lit(b))])
    return F.coalesce(F.try_element_at(m, difficulty_value(col)), F.lit(K.DEFAULT_BADGE))


def join_list(col: str, sep: str) -> Column:
    """List field joined with ``sep``; missing list -> empty string."""
    return F.coalesce(F.array_join(F.col(col), sep), F.lit(""))


def dialogue_card(df: DataFrame) -> DataFrame:
    """presentation row with per-field defaults."""
    return df.select(
        "book_id",
        "dlg_ord",
        speaker_value().alias("speaker"),
        difficulty_value().alias("difficulty"),
        badge_class().alias("badge"),
        F.coalesce("line", F.lit("")).alias("line"),
        F.coalesce("modern_equivalent", F.lit("")).alias("modern_equivalent"),
        join_list("key_expressions", K.KEY_EXPRESSION_JOINER).alias("key_expressions"),
        F.coalesce("context", F.lit("")).alias("context"),
    )


def preview_labels(df: DataFrame, position_col: str = "dlg_ord") -> DataFrame:
    """Picker label per row (position 0-based)."""
    return df.select("book_id", "dlg_ord", T.preview_label(position_col, "speaker", "line").alias("label"))


def picker_labels(df: DataFrame, predicate: Column, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """T10 of the practice picker: the number is the row's place in the filtered
    list, or in the whole list of a book where nothing passes the filter (F5)."""
    kept = empty_fallback(df, predicate)
    placed = ordered_positions(kept.select("book_id", "dlg_ord", "speaker", "line"), "book_id", "dlg_ord", block_size, prefix="cur_")
    return placed.select("book_id", "dlg_ord", T.preview_label(F.col("cur_position") - 1, "speaker", "line").alias("label"))


def cap_expressions(col: str = "key_expressions", n: int = 3) -> Column:
    """At most ``n`` key expressions (the prompt asks for it; not enforced upstream)."""
    return F.slice(F.coalesce(F.col(col), F.array().cast("array<string>")), 1, n)


# ------------------------------------------------------------------ A1-A3
def count_dialogues(df: DataFrame) -> DataFrame:
    """A1: extracted lines per book."""
    return df.groupBy("book_id").agg(F.count(F.lit(1)).alias("n_dialogues"))


def count_filtered(df: DataFrame, predicate: Column) -> DataFrame:
    """A2: lines passing the filter per book (0 when none)."""
    return df.groupBy("book_id").agg(
        F.count(F.lit(1)).alias("n_dialogues"),
        F.count_if(F.coalesce(predicate, F.lit(False))).alias("n_filtered"),
    )


def distinct_speakers(df: DataFrame) -> DataFrame:
    """A3: distinct speakers per book, missing -> Unknown (partial aggregation)."""
    return df.select("book_id", speaker_value().alias("speaker")).distinct()


# ------------------------------------------------------------------ L5-L8
def check_lines(n: int) -> int:
    """The number of role-play lines; a value outside the allowed range is an error."""
    if not K.ROLEPLAY_MIN_LINES <= int(n) <= K.ROLEPLAY_MAX_LINES:
        raise ValueError(f"n must be {K.ROLEPLAY_MIN_LINES}..{K.ROLEPLAY_MAX_LINES}, got {n}")
    return int(n)


def roleplay_slice(df: DataFrame, start: int | Column = 0, n: int = K.ROLEPLAY_DEFAULT_LINES) -> DataFrame:
    """Contiguous lines [start, start + n) of the unfiltered list; n outside 3..10 raises."""
    s = F.lit(start) if isinstance(start, int) else start
    n = check_lines(n)
    return df.filter((F.col("dlg_ord") >= s) & (F.col("dlg_ord") < s + F.lit(n)))


def first_lines(sliced: DataFrame, start: int | Column = 0, n: int = K.MAX_ROLEPLAY_LINES) -> DataFrame:
    """At most ``n`` (8) lines of a slice enter the prompt."""
    s = F.lit(start) if isinstance(start, int) else start
    return sliced.filter(F.col("dlg_ord") < s + F.lit(n))


def first_context(sliced: DataFrame) -> DataFrame:
    """Context of the first line of the slice, '' when missing."""
    return sliced.groupBy("book_id").agg(
        F.coalesce(F.min_by(F.coalesce("context", F.lit("")), "dlg_ord"), F.lit("")).alias("context")
    )


def prev_next(df: DataFrame, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Bounded cursor over an ordered list: position "i / N" and neighbours."""
    p = ordered_positions(df.select("book_id", "dlg_ord"), "book_id", "dlg_ord", block_size, prefix="cur_")
    return p.select(
        "book_id",
        "dlg_ord",
        F.col("cur_position").alias("position"),
        F.col("cur_count").alias("n_total"),
        F.col("cur_prev").alias("prev_ord"),
        F.col("cur_next").alias("next_ord"),
        F.concat(F.col("cur_position").cast("string"), F.lit(" / "), F.col("cur_count").cast("string")).alias("label"),
    )
