"""Practice scoring and learner progress.

Tables: ``attempts(learner_id, book_id, dlg_ord, target, answer)`` and
``feedback(learner_id, ts, mode, accuracy_score, pronunciation_issues, ...)``.
Scores are per-row expressions; progress is a partial+final hash aggregate
per learner, so a hot learner collapses map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T

RECORDED_MODE = "shadowing"


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def token_set(col) -> Column:
    """Distinct lower-case whitespace tokens (punctuation stays attached)."""
    return F.array_distinct(T.words(F.lower(_c(col))))


def set_overlap(target_set, answer_set) -> Column:
    """|answer ∩ target| / |target| * 100 over two token sets; 0 for an empty target."""
    t, a = _c(target_set), _c(answer_set)
    return F.when(F.size(t) == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, t)) / F.size(t) * F.lit(100.0))


def word_overlap(target, answer) -> Column:
    """|answer ∩ target| / |target| * 100 over distinct tokens; 0 when the
    target has no tokens. Recall only: order, repeats and extra words do not count."""
    return set_overlap(token_set(target), token_set(answer))


def display_round(col) -> Column:
    """``format(x, '.0f')``: half-to-even rounding, not Java's half-up."""
    return F.bround(_c(col), 0).cast("bigint")


def nonblank(col) -> Column:
    """whitespace-only answers are not scored."""
    return T.strip_ws(F.coalesce(_c(col), F.lit(""))) != F.lit("")


def score_attempts(attempts: DataFrame) -> DataFrame:
    """Dictation check: overlap and its display value for non-blank answers."""
    keys = ["learner_id", "book_id", "dlg_ord"]
    # token sets as columns first: referenced three times, evaluated once
    sets = attempts.filter(nonblank("answer")).select(
        *keys, token_set("target").alias("__t"), token_set("answer").alias("__a")
    )
    scored = sets.select(*keys, set_overlap("__t", "__a").alias("accuracy"))
    return scored.withColumn("accuracy_display", display_round("accuracy"))


def attempt_target(attempts: DataFrame, dialogues: DataFrame) -> DataFrame:
    """Pair each attempt with its target line by (book_id, dlg_ord).

    Equi-join on the full key; a heavily practised line is a skewed key on the
    attempts side only, which AQE's skew-join split handles (the dialogue side
    has one row per key)."""
    d = dialogues.select("book_id", "dlg_ord", "speaker", F.col("line").alias("target"))
    return attempts.drop("target").join(d, ["book_id", "dlg_ord"], "inner")


def score_value(col: str = "accuracy_score") -> Column:
    """Missing score counts as 0."""
    return F.coalesce(F.col(col), F.lit(0))


def score_band(col: str = "accuracy_score") -> Column:
    """>= 80 green, >= 60 yellow, else red (missing = 0)."""
    s = score_value(col)
    (hi, _), (mid, _) = K.SCORE_BANDS
    return F.when(s >= hi, "green").when(s >= mid, "yellow").otherwise("red")


def score_color(col: str = "accuracy_score") -> Column:
    s = score_value(col)
    expr = None
    for threshold, color in K.SCORE_BANDS:
        expr = F.when(s >= threshold, color) if expr is None else expr.when(s >= threshold, color)
    return expr.otherwise(K.SCORE_BAND_LOW)


def recorded(feedback: DataFrame) -> DataFrame:
    """Only shadowing feedback is appended to the history."""
    return feedback.filter(F.col("mode") == RECORDED_MODE)


def learner_progress(feedback: DataFrame) -> DataFrame:
    """A4 + A5 per learner over the recorded history:
    (learner_id, n_practice, avg_accuracy, avg_display)."""
    r = recorded(feedback)
    avg = F.avg(score_value())
    return r.groupBy("learner_id").agg(
        F.count(F.lit(1)).alias("n_practice"),
        avg.alias("avg_accuracy"),
    ).withColumn("avg_display", display_round("avg_accuracy"))


def progress_summary(learners: DataFrame, feedback: DataFrame, dialogue_counts: DataFrame) -> DataFrame:
    """One row per learner whose book has dialogues (total > 0).

    ``learners(learner_id, book_id)`` says which book a learner studies and
    drives the result: learners without any recorded practice show count 0 and
    no average. ``dialogue_counts(book_id, n_dialogues)`` is one row per book.
    """
    done = learner_progress(feedback).select("learner_id", "n_practice", "avg_display")
    counts = dialogue_counts.filter(F.col("n_dialogues") > 0)
    return learners.select("learner_id", "book_id").join(counts, "book_id", "inner").join(done, "learner_id", "left").select(
        "learner_id", "book_id", "n_dialogues", F.coalesce("n_practice", F.lit(0)).cast("bigint").alias("n_practice"), "avg_display")


def feedback_card(feedback: DataFrame) -> DataFrame:
    """The card shown for an evaluation: score (missing: 0) with its band and
    colour, the issue words or null when there are none, the grammar note only
    if there is one, and empty text for missing remarks."""
    note = F.col("grammar_note")
    issues = F.when(F.size(F.coalesce("pronunciation_issues", F.array().cast("array<string>"))) > 0, issue_text())
    return feedback.select(
        *[c for c in ("learner_id", "book_id", "dlg_ord", "ts", "mode") if c in feedback.columns],
        score_value().alias("score"), score_band().alias("band"), score_color().alias("color"), issues.alias("issues"),
        F.coalesce("fluency_feedback", F.lit("")).alias("fluency"),
        F.when(note != F.lit(""), note).alias("grammar_note"), F.coalesce("encouragement", F.lit("")).alias("encouragement"))


def spoken_attempts(recordings: DataFrame, transcripts: DataFrame, dialogues: DataFrame) -> DataFrame:
    """Spoken practice: ``recordings(path, learner_id, book_id, dlg_ord, ts)``
    with a transcript become attempts on their line; recordings that could not
    be transcribed give none."""
    heard = transcripts.filter(F.col("status") == "ok").select("path", F.col("text").alias("answer"))
    return attempt_target(recordings.join(heard, "path", "inner"), dialogues)


def issue_words(feedback: DataFrame) -> DataFrame:
    """A8 at table level: how often each word was flagged per learner."""
    return (
        recorded(feedback)
        .select("learner_id", F.explode("pronunciation_issues").alias("word"))
        .groupBy("learner_id", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def issue_text(col: str = "pronunciation_issues") -> Column:
    """A8 display: words in back-ticks joined by ', '."""
    return F.array_join(F.transform(F.col(col), lambda w: F.concat(F.lit("`"), w, F.lit("`"))), K.ISSUE_JOINER)
