"""Queries over fx_attempts and fx_feedback: scoring and learner progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import api
from .. import constants as K
from ..functions.text import sql_literal, sql_render
from ..operators import dialogues as D
from ..operators import inference as I
from ..operators import practice as P
from ..session import scratch_path
from ..sources.fixtures import fx_attempts, fx_dialogues, fx_feedback, with_fixtures
from . import sqlgen as S
from .registry import query


def _tokens(x: str) -> str:
    return f"list_distinct({S.words(f'lower({x})')})"


SQL_OVERLAP = (
    f"CASE WHEN len({_tokens('target')}) = 0 THEN 0.0 "
    f"ELSE len(list_intersect({_tokens('answer')}, {_tokens('target')})) / len({_tokens('target')}) * 100.0 END"
)
SQL_NONBLANK = f"{S.strip_ws('coalesce(answer, ' + chr(39) * 2 + ')')} <> ''"
SQL_SCORE = "coalesce(accuracy_score, 0)"
SQL_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"


def _ts_text():
    return F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_text")


@query(
    "word_overlap",
    with_fixtures(
        f"SELECT learner_id, book_id, dlg_ord, {SQL_OVERLAP} AS accuracy, "
        f"CAST(round_even({SQL_OVERLAP}, 0) AS BIGINT) AS accuracy_display FROM fx_attempts WHERE {SQL_NONBLANK}",
        "fx_attempts",
    ),
)
def q_word_overlap(spark, sf):
    return P.score_attempts(fx_attempts(spark, sf))


@query(
    "nonblank_answer",
    with_fixtures(
        f"SELECT learner_id, book_id, dlg_ord, {SQL_NONBLANK} AS scored FROM fx_attempts", "fx_attempts"
    ),
)
def q_nonblank_answer(spark, sf):
    return fx_attempts(spark, sf).select("learner_id", "book_id", "dlg_ord", P.nonblank("answer").alias("scored"))


@query(
    "attempt_target",
    with_fixtures(
        "SELECT a.learner_id, a.book_id, a.dlg_ord, d.speaker, d.line AS target, a.answer "
        "FROM fx_attempts a JOIN fx_dialogues d ON a.book_id = d.book_id AND a.dlg_ord = d.dlg_ord",
        "fx_attempts",
        "fx_dialogues",
    ),
)
def q_attempt_target(spark, sf):
    j = P.attempt_target(fx_attempts(spark, sf), fx_dialogues(spark, sf))
    return j.select("learner_id", "book_id", "dlg_ord", "speaker", "target", "answer")


REC = f"mode = {sql_literal(P.RECORDED_MODE)}"


@query(
    "record_feedback",
    with_fixtures(
        f"SELECT learner_id, {SQL_TS} AS ts_text, accuracy_score, mode FROM fx_feedback WHERE {REC}", "fx_feedback"
    ),
)
def q_record_feedback(spark, sf):
    return P.recorded(fx_feedback(spark, sf)).select("learner_id", _ts_text(), "accuracy_score", "mode")


@query(
    "practice_count",
    with_fixtures(
        f"SELECT learner_id, count(*) AS n_practice FROM fx_feedback WHERE {REC} GROUP BY learner_id", "fx_feedback"
    ),
)
def q_practice_count(spark, sf):
    return P.learner_progress(fx_feedback(spark, sf)).select("learner_id", "n_practice")


@query(
    "avg_accuracy",
    with_fixtures(
        f"SELECT learner_id, count(*) AS n_practice, avg({SQL_SCORE}) AS avg_accuracy, "
        f"CAST(round_even(avg({SQL_SCORE}), 0) AS BIGINT) AS avg_display "
        f"FROM fx_feedback WHERE {REC} GROUP BY learner_id",
        "fx_feedback",
    ),
)
def q_avg_accuracy(spark, sf):
    return P.learner_progress(fx_feedback(spark, sf))


PROGRESS_SQL = f"""
counts AS (SELECT book_id, count(*) AS n_dialogues FROM fx_dialogues GROUP BY book_id),
learners AS (SELECT DISTINCT book_id AS learner_id, book_id FROM fx_dialogues),
done AS (SELECT learner_id, count(*) AS n_practice, avg({SQL_SCORE}) AS avg_accuracy FROM fx_feedback WHERE {REC} GROUP BY learner_id)
SELECT l.learner_id, l.book_id, c.n_dialogues, CAST(coalesce(d.n_practice, 0) AS BIGINT) AS n_practice,
  CAST(round_even(d.avg_accuracy, 0) AS BIGINT) AS avg_display
FROM learners l JOIN counts c ON l.book_id = c.book_id LEFT JOIN done d ON l.learner_id = d.learner_id
"""


@query("progress_summary", with_fixtures("", "fx_feedback", "fx_dialogues") + ",\n" + PROGRESS_SQL)
def q_progress_summary(spark, sf):
    # Learner n studies book n (fixture convention); most of them have not practised yet.
    dialogues = fx_dialogues(spark, sf)
    learners = dialogues.select(F.col("book_id").alias("learner_id"), "book_id").distinct()
    return P.progress_summary(learners, fx_feedback(spark, sf), D.count_dialogues(dialogues))


SQL_BAND = f"CASE WHEN {SQL_SCORE} >= {K.SCORE_BANDS[0][0]} THEN 'green' WHEN {SQL_SCORE} >= {K.SCORE_BANDS[1][0]} THEN 'yellow' ELSE 'red' END"
SQL_COLOR = (
    f"CASE WHEN {SQL_SCORE} >= {K.SCORE_BANDS[0][0]} THEN {sql_literal(K.SCORE_BANDS[0][1])} "
    f"WHEN {SQL_SCORE} >= {K.SCORE_BANDS[1][0]} THEN {sql_literal(K.SCORE_BANDS[1][1])} "
    f"ELSE {sql_literal(K.SCORE_BAND_LOW)} END"
)


# ------------------------------------------------------------------ evaluation -> history -> card
_MODE = f"CASE WHEN dlg_ord % 3 = 1 THEN 'dictation' ELSE {sql_literal(P.RECORDED_MODE)} END"
EVALUATED_SQL = f"""
p AS (SELECT *, {_MODE} AS mode, length({sql_render(K.FEEDBACK_PROMPT, target='target', user_input='answer')}) AS n FROM fx_attempts),
ev AS (SELECT learner_id, book_id, dlg_ord, mode, 'ok' AS status,
  CAST(CASE WHEN n % 3 = 0 THEN n % 101 + 0.5 ELSE n % 101 END AS DOUBLE) AS accuracy_score,
  CASE WHEN n % 2 = 1 THEN ['w' || CAST(n % 7 AS VARCHAR)] ELSE CAST([] AS VARCHAR[]) END AS pronunciation_issues,
  CAST(n AS VARCHAR) || ' characters' AS fluency_feedback, CASE WHEN n % 4 = 0 THEN 'Check tense' END AS grammar_note,
  'Keep going!' AS encouragement FROM p)
"""


def _evaluated(spark, sf):
    a = fx_attempts(spark, sf).withColumn("mode", F.when(F.col("dlg_ord") % 3 == 1, F.lit("dictation")).otherwise(F.lit(P.RECORDED_MODE)))
    return api.evaluate_responses(a, I.EchoCoach, scratch_path(spark, "evaluations"))


@query(
    "evaluate_and_record",
    with_fixtures("", "fx_attempts") + ",\n" + EVALUATED_SQL
    + f"SELECT learner_id, book_id, dlg_ord, mode, status, accuracy_score, fluency_feedback, grammar_note FROM ev WHERE {REC}",
)
def q_evaluate_and_record(spark, sf):
    """Attempts -> evaluations by a stand-in coach -> the rows that enter the history."""
    out = api.record_practice(_evaluated(spark, sf))
    return out.select("learner_id", "book_id", "dlg_ord", "mode", "status", "accuracy_score", "fluency_feedback", "grammar_note")


@query(
    "feedback_card",
    with_fixtures("", "fx_attempts") + ",\n" + EVALUATED_SQL + f"""
SELECT learner_id, book_id, dlg_ord, mode, {{SCORE}} AS score, {{BAND}} AS band, {{COLOR}} AS color,
  CASE WHEN len(pronunciation_issues) > 0 THEN array_to_string(list_transform(pronunciation_issues, lambda w: '`' || w || '`'), {sql_literal(K.ISSUE_JOINER)}) END AS issues,
  fluency_feedback AS fluency, grammar_note, encouragement FROM ev
""".replace("{SCORE}", "coalesce(accuracy_score, CAST(0 AS DOUBLE))").replace("{BAND}", SQL_BAND).replace("{COLOR}", SQL_COLOR),
)
def q_feedback_card(spark, sf):
    return P.feedback_card(_evaluated(spark, sf))


@query(
    "issue_words",
    with_fixtures(
        f"SELECT learner_id, word, count(*) AS n FROM (SELECT learner_id, unnest(pronunciation_issues) AS word "
        f"FROM fx_feedback WHERE {REC}) GROUP BY learner_id, word",
        "fx_feedback",
    ),
)
def q_issue_words(spark, sf):
    return P.issue_words(fx_feedback(spark, sf))


@query(
    "score_band",
    with_fixtures(
        f"SELECT learner_id, {SQL_TS} AS ts_text, {SQL_SCORE} AS score, {SQL_BAND} AS band, {SQL_COLOR} AS color, "
        f"array_to_string(list_transform(pronunciation_issues, lambda w: '`' || w || '`'), "
        f"{sql_literal(K.ISSUE_JOINER)}) AS issues FROM fx_feedback WHERE {REC}",
        "fx_feedback",
    ),
)
def q_score_band(spark, sf):
    return P.recorded(fx_feedback(spark, sf)).select(
        "learner_id",
        _ts_text(),
        P.score_value().alias("score"),
        P.score_band().alias("band"),
        P.score_color().alias("color"),
        P.issue_text().alias("issues"),
    )
