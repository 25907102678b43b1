"""Table-level counterparts of the original app's functions.

Each function takes and returns DataFrames keyed by ``book_id``,
``conv_id`` or ``learner_id`` instead of one value for one session. Model
and speech services are injected clients (see ``operators.inference``).

| original                      | here                                   |
|-------------------------------|----------------------------------------|
| fetch_book_text(book_id)      | fetch_books(spark, landed_dir)         |
| preprocess_text(text)         | preprocess_books(books)                |
| extract_chapters(text)        | extract_chapters(books)                |
| extract_dialogues(text)       | extract_dialogues(books, client, ...)  |
| generate_roleplay_setup(dlgs) | roleplay_setups(dialogues, client, ...)|
| chat_roleplay(msgs, input,..) | chat_replies(messages, setups, client) |
| evaluate_response(t, u)       | evaluate_responses(attempts, client)   |
| translate_to_modern(text)     | modernise(lines, client)               |
| (inline) translation hint     | hints(lines, client)                   |
| (inline) conversation review  | analyse_conversations(messages, client)|
| text_to_speech(text, voice..) | speech_requests(lines)                 |
| transcribe_audio(bytes)       | transcribe(spark, audio_dir, client)   |
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import constants as K
from .functions import model_json as J
from .functions.text import preprocess
from .operators import chapters as CH
from .operators import conversation as C
from .operators import inference as I
from .operators import practice as P
from .operators import voice as V
from .sources import books as B
from .sources import large_books as LB
from .sources import media as M


def fetch_books(spark: SparkSession, landed_dir: str, requested: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """S3 + S4: (loaded books (book_id, priority, raw_text), load_errors).
    ``requested(book_id)`` reports requested books without any usable file;
    files too large for one value are reported too (:func:`large_book_chapters` reads them)."""
    books, errors = B.split_loaded(B.book_scan_fallback(B.scan_landed_books(spark, landed_dir), requested))
    return books, errors.unionByName(B.oversized_files(spark, landed_dir))


def preprocess_books(books: DataFrame, max_chars: int | None = None, footer: str = "exact") -> DataFrame:
    """(book_id, raw_text) -> (book_id, text, n_chars), whole texts by default."""
    return CH.clean_books(books, footer, max_chars)


def extract_chapters(clean: DataFrame, anchored: bool = False) -> DataFrame:
    """T8 + T9: (book_id, chapter_ord, title, body)."""
    return CH.chapters(clean, anchored)


def extraction_requests(clean: DataFrame, window_chars: int = K.MAX_PROMPT_CHARS) -> DataFrame:
    """X1 over whole books: one prompt per (book_id, chapter_ord, window_no)."""
    w = CH.chapter_windows(clean, window_chars)
    return w.select("book_id", "chapter_ord", "window_no", "title", I.extraction_prompt("window").alias("prompt")).withColumn(
        "prompt_hash", I.prompt_hash("prompt"))


def first_window_requests(clean: DataFrame, n_chapters: int = K.DEFAULT_CHAPTERS) -> DataFrame:
    """L1-L4 + X1: one prompt per book over the first window of its first chapters."""
    comb = CH.with_default_combined(clean.select("book_id", "text"), n=n_chapters)
    p = I.extraction_prompt(CH.prompt_window("combined"))
    return comb.select("book_id", "has_headings", p.alias("prompt")).withColumn("prompt_hash", I.prompt_hash("prompt"))


def extract_dialogues(
    clean: DataFrame,
    client_factory: Callable[[], I.ModelClient],
    out_path: str,
    cache: DataFrame | None = None,
    partitions: int | None = None,
    whole: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Prompts -> model (new prompts only, results written to ``out_path``)
    -> (dialogues, rejects) keyed by book_id, and by chapter_ord and window_no
    unless only the first window is asked for (``whole=False``). Books whose
    answers come from ``cache`` (``inference.RESULT_SCHEMA`` rows) are in the
    result like the others; requests that failed are among the rejects."""
    req, keys = (extraction_requests(clean), ["book_id", "chapter_ord", "window_no"]) if whole else (first_window_requests(clean), ["book_id"])
    res = I.batch_infer(
        req, client_factory, template="extraction", temperature=K.TEMPERATURES["extraction"],
        cache=cache, partitions=partitions, out_path=out_path,
    )
    joined = req.select(*keys, "prompt_hash").join(res.select("prompt_hash", "raw", "status", "error"), "prompt_hash", "inner")
    dialogues, rejects = I.explode_responses(joined.filter(F.col("status") == "ok"), keys)
    failed = joined.filter(F.col("status") != "ok").select(
        *keys, F.lit(None).cast("bigint").alias("dlg_ord"), F.concat(F.lit("request failed: "), F.coalesce("error", F.lit(""))).alias("reason"))
    return dialogues, rejects.unionByName(failed)


def roleplay_requests(dialogues: DataFrame, start: int = 0, n: int = K.ROLEPLAY_DEFAULT_LINES) -> DataFrame:
    """L5-L7 + C1 + X5 prompt per book."""
    t = C.transcripts(dialogues, start, n)
    p = C.roleplay_prompt("context", "transcript")
    return t.select("book_id", p.alias("prompt")).withColumn("prompt_hash", I.prompt_hash("prompt"))


def roleplay_setups(dialogues: DataFrame, client_factory, out_path: str, start: int = 0, n: int = K.ROLEPLAY_DEFAULT_LINES) -> DataFrame:
    """(book_id, status, setup struct, error) from the model's JSON answer; a failed request has status ``error``."""
    req = roleplay_requests(dialogues, start, n)
    res = I.batch_infer(req, client_factory, template="roleplay_setup", temperature=K.TEMPERATURES["roleplay_setup"], out_path=out_path)
    j = req.select("book_id", "prompt_hash").join(res.select("prompt_hash", "raw", F.col("status").alias("__call"), "error"), "prompt_hash", "inner")
    status = F.when(F.col("__call") == "ok", F.col("status")).otherwise(F.lit("error"))
    return J.parsed(j, J.SETUP_SCHEMA, out="setup").select("book_id", status.alias("status"), "setup", "error")


def chat_replies(messages: DataFrame, setups: DataFrame, client_factory, out_path: str) -> DataFrame:
    """A reply for each conversation whose last message is the user's.

    The prompt is the JSON list of all messages that the model is sent (system
    message, history in turn order, user's message), so two conversations share
    an answer only if they agree in all of it.
    """
    r = C.open_requests(messages, setups).withColumn("prompt_hash", I.prompt_hash("prompt"))
    res = I.batch_infer(r, client_factory, template="chat", temperature=K.TEMPERATURES["chat"], json_mode=False, out_path=out_path)
    return r.select("conv_id", "turn", "n_messages", "prompt_hash").join(res.select("prompt_hash", "raw", "status"), "prompt_hash", "inner")


def evaluate_responses(attempts: DataFrame, client_factory, out_path: str) -> DataFrame:
    """One feedback row per attempt: its keys (learner_id, book_id, dlg_ord,
    and ts and mode where given), status and the feedback fields, as P3, A4-A6
    and the feedback card read them. Attempts whose request failed have status
    ``error`` and no fields."""
    keys = ["learner_id", "book_id", "dlg_ord", *[c for c in ("ts", "mode") if c in attempts.columns]]
    req = attempts.select(*keys, I.feedback_prompt("target", "answer").alias("prompt"))
    req = req.withColumn("prompt_hash", I.prompt_hash("prompt"))
    res = I.batch_infer(req, client_factory, template="feedback", temperature=K.TEMPERATURES["feedback"], out_path=out_path)
    j = req.drop("prompt").join(res.select("prompt_hash", "raw", F.col("status").alias("__call")), "prompt_hash", "inner").drop("prompt_hash")
    fb = J.parse_feedback(j).withColumn("status", F.when(F.col("__call") == "ok", F.col("status")).otherwise(F.lit("error")))
    return fb.drop("raw", "__call")


def record_practice(evaluations: DataFrame) -> DataFrame:
    """The evaluations that are appended to the practice history: answered
    ones in shadowing mode (a reply that is no JSON object is not recorded)."""
    return P.recorded(evaluations).filter(F.col("status").isin(J.STATUS_OK, J.STATUS_BAD_SCORE))


def spoken_practice(recordings: DataFrame, transcripts: DataFrame, dialogues: DataFrame, client_factory, out_path: str) -> DataFrame:
    """Spoken shadowing: ``recordings(path, learner_id, book_id, dlg_ord, ts)``
    with their transcripts become attempts, which are evaluated."""
    return evaluate_responses(P.spoken_attempts(recordings, transcripts, dialogues).withColumn("mode", F.lit(P.RECORDED_MODE)), client_factory, out_path)


def spoken_turns(recordings: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Spoken role-play: ``recordings(path, conv_id)`` -> (conv_id, user_input), to be appended as a user turn."""
    heard = transcripts.filter(F.col("status") == "ok").select("path", F.col("text").alias("user_input"))
    return recordings.select("path", "conv_id").join(heard, "path", "inner").drop("path")


def modernise(lines: DataFrame, client_factory, out_path: str, text_col: str = "line") -> DataFrame:
    """Modern rewrite per line, with the call's status and error."""
    req = lines.select("book_id", "dlg_ord", I.modernise_prompt(text_col).alias("prompt"))
    req = req.withColumn("prompt_hash", I.prompt_hash("prompt"))
    res = I.batch_infer(req, client_factory, template="modernise", temperature=K.TEMPERATURES["modernise"], json_mode=False, out_path=out_path)
    return req.drop("prompt").join(res.select("prompt_hash", F.col("raw").alias("modern"), "status", "error"), "prompt_hash", "inner")


def hints(lines: DataFrame, client_factory, out_path: str, text_col: str = "line") -> DataFrame:
    """Translation hint per line, with the call's status and error."""
    req = lines.select("book_id", "dlg_ord", I.hint_prompt(text_col).alias("prompt"))
    req = req.withColumn("prompt_hash", I.prompt_hash("prompt"))
    res = I.batch_infer(req, client_factory, template="hint", json_mode=False, out_path=out_path)
    return req.drop("prompt").join(res.select("prompt_hash", F.col("raw").alias("hint"), "status", "error"), "prompt_hash", "inner")


def analyse_conversations(messages: DataFrame, client_factory, out_path: str) -> DataFrame:
    """F7 + F8 + A7 + X9: reviews of conversations with at least two messages, one
    per chunk of the user's lines."""
    req = C.analysis_prompts(messages).withColumn("prompt_hash", I.prompt_hash("prompt"))
    res = I.batch_infer(req, client_factory, template="analysis", json_mode=False, out_path=out_path)
    return req.drop("prompt").join(res.select("prompt_hash", F.col("raw").alias("analysis"), "status", "error"), "prompt_hash", "inner")


def large_book_chapters(spark: SparkSession, landed_dir: str) -> DataFrame:
    """S3 + T1-T9: (book_id, chapter_ord, title, body) of the landed books that are too large for :func:`fetch_books`."""
    return LB.large_book_chapters(spark, landed_dir)


def speech_requests(lines: DataFrame, text_col: str = "line", key_col: str = "voice_key", rate_col: str = "rate") -> DataFrame:
    """V3: synthesis request manifest (the synthesiser itself is external)."""
    return V.voice_manifest(lines, text_col, key_col, rate_col)


def transcribe_recordings(spark: SparkSession, audio_dir: str, client_factory, out_path: str | None = None, glob: str = "*.wav") -> DataFrame:
    """S5 + U4: transcripts of recordings of any length; long ones are cut at sample borders and sent in parts."""
    return I.transcribe_recordings(M.scan_audio(spark, audio_dir, glob), client_factory, out_path=out_path)


def transcribe(spark: SparkSession, audio_dir: str, client_factory, out_path: str | None = None, glob: str = "*.wav") -> DataFrame:
    """S5 + U4: transcripts of recorded audio files, kept at ``out_path``."""
    return I.batch_transcribe(M.scan_audio(spark, audio_dir, glob), client_factory, out_path=out_path)


__all__ = [
    "analyse_conversations", "chat_replies", "evaluate_responses", "extract_chapters", "extract_dialogues",
    "extraction_requests", "fetch_books", "first_window_requests", "hints", "large_book_chapters", "modernise", "preprocess", "preprocess_books", "record_practice",
    "roleplay_requests", "roleplay_setups", "speech_requests", "spoken_practice", "spoken_turns", "transcribe",
    "transcribe_recordings",
]
