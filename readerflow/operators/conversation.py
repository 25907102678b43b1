"""Role-play conversation operators.

Tables: ``messages(conv_id, turn, role, content)`` (user/assistant only) and
``setups(conv_id, scenario, user_role, ai_roles, opening_line,
vocabulary_tips)``, one row per conversation. All grouping is by
``conv_id``; per-conversation lists are built in bounded chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from .ordinal import DEFAULT_BLOCK, ordered_positions, running_totals

CHAT_ROLES = ("user", "assistant")
CHUNK = 256  # consecutive turns in a chunk of a conversation's lines


# ------------------------------------------------------------------ C5, C6
def ai_display(setup_roles: Column | str = "ai_roles") -> Column:
    """Assistant label: AI roles joined by ', '; missing list -> AI."""
    r = F.col(setup_roles) if isinstance(setup_roles, str) else setup_roles
    return F.coalesce(F.array_join(r, K.CHAT_ROLES_JOINER), F.lit(K.DEFAULT_AI_ROLE))


def user_display(user_role: Column | str = "user_role") -> Column:
    r = F.col(user_role) if isinstance(user_role, str) else user_role
    return F.coalesce(r, F.lit(K.DEFAULT_USER_ROLE))


def display_roles(messages: DataFrame, setups: DataFrame) -> DataFrame:
    """Display label per message (assistant -> AI roles, user -> user role)."""
    s = setups.select("conv_id", ai_display().alias("__ai"), user_display().alias("__user"))
    return messages.join(s, "conv_id", "left").select(
        *[c for c in messages.columns if c != "display_role"],
        F.when(F.col("role") == "assistant", F.coalesce(F.col("__ai"), F.lit(K.DEFAULT_AI_ROLE)))
        .otherwise(F.coalesce(F.col("__user"), F.lit(K.DEFAULT_USER_ROLE)))
        .alias("display_role"),
    )


def system_prompt(setups: DataFrame) -> DataFrame:
    """The system message: AI roles (missing -> none) and scenario (missing -> '')."""
    roles = F.coalesce(F.array_join("ai_roles", K.CHAT_ROLES_JOINER), F.lit(""))
    return setups.select(
        "conv_id",
        T.render(K.CHAT_SYSTEM_PROMPT, roles=roles, scenario=F.coalesce("scenario", F.lit(""))).alias("system_prompt"),
    )


# ------------------------------------------------------------------ C2, C4, C7
def opening_turns(setups: DataFrame, messages: DataFrame, turn: int = -1) -> DataFrame:
    """Conversations without any message get the assistant's opening line.

    The message side is reduced to its distinct conv_ids first (partial
    aggregation), so a long conversation cannot skew the anti-join.
    """
    present = messages.select("conv_id").distinct()
    empty = setups.join(present, "conv_id", "left_anti")
    return empty.select(
        "conv_id",
        F.lit(turn).cast("bigint").alias("turn"),
        F.lit("assistant").alias("role"),
        F.coalesce("opening_line", F.lit(K.DEFAULT_OPENING_LINE)).alias("content"),
        ai_display().alias("display_role"),
    )


def display_names(setups: DataFrame) -> DataFrame:
    """(conv_id, user_name, ai_name) of each conversation."""
    return setups.select("conv_id", user_display().alias("user_name"), ai_display().alias("ai_name"))


def append_turns(messages: DataFrame, inputs: DataFrame, setups: DataFrame, order: str | None = None, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """C4: for each ``inputs(conv_id, user_input, ai_reply)`` row append the user
    message and then the assistant reply after the conversation's last turn.

    ``order`` names an integral column, unique within a conversation, by which
    its inputs are numbered; without one, a conversation has one input. Last
    turn per conversation is a partial+final max aggregate; the numbering is
    done in blocks, so no conversation is processed by one task. The streaming
    form is ``streaming.chat``.
    """
    last = messages.groupBy("conv_id").agg(F.max("turn").alias("__last"))
    numbered = inputs.withColumn("__position", F.lit(1)) if order is None else ordered_positions(inputs, "conv_id", order, block_size, "__")
    j = numbered.join(last, "conv_id", "left").join(display_names(setups), "conv_id", "left")
    base = (F.coalesce(F.col("__last"), F.lit(-1)) + 2 * F.col("__position") - 2).cast("bigint")
    rows = F.array(
        F.struct((base + 1).alias("turn"), F.lit("user").alias("role"), F.col("user_input").alias("content"),
                 F.coalesce("user_name", F.lit(K.DEFAULT_USER_ROLE)).alias("display_role")),
        F.struct((base + 2).alias("turn"), F.lit("assistant").alias("role"), F.col("ai_reply").alias("content"),
                 F.coalesce("ai_name", F.lit(K.DEFAULT_AI_ROLE)).alias("display_role")),
    )
    return j.select("conv_id", F.inline(rows))


def new_scenario(setups: DataFrame, conv_id_offset: Column | int) -> DataFrame:
    """A restart is a new conversation id; old rows are kept, not deleted."""
    off = F.lit(conv_id_offset) if isinstance(conv_id_offset, int) else conv_id_offset
    return setups.withColumn("conv_id", F.col("conv_id") + off)


# ------------------------------------------------------------------ C3
def message_digest(turn="turn", role="role", content="content") -> Column:
    """48 bits of a message's SHA-256, with its turn: their running sum tells ordered histories apart."""
    text = F.concat_ws("\x1f", F.col(turn).cast("string"), F.col(role), F.coalesce(F.col(content), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("bigint")


def _with_system(df: DataFrame, setups: DataFrame) -> DataFrame:
    none = T.render(K.CHAT_SYSTEM_PROMPT, roles=F.lit(""), scenario=F.lit(""))
    return df.join(system_prompt(setups), "conv_id", "left").withColumn("system_prompt", F.coalesce("system_prompt", none))


def chat_requests(messages: DataFrame, setups: DataFrame, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """C3 as a log: for each user turn, what its request consisted of.

    Materialising each history would be quadratic in conversation length, so
    a row carries its history as a span of earlier turns
    (``history_from``..``turn - 1``), running message and character totals and
    a running digest of the ordered history, all by a blocked prefix sum (no
    conversation is processed by one task). :func:`open_requests` builds the
    requests that are still to be answered, with the messages in them.
    """
    m = messages.select("conv_id", "turn", "role", "content", message_digest().cast("decimal(38,0)").alias("__digest")).withColumn(
        "__len", F.length(F.coalesce("content", F.lit(""))).cast("bigint")
    )
    tot = running_totals(m, "conv_id", "turn", {"n_prior": "*", "prior_chars": "__len", "history_digest": "__digest"}, block_size, first="history_from")
    req = _with_system(tot.filter(F.col("role") == "user"), setups)
    return req.select(
        "conv_id",
        "turn",
        "history_from",
        (F.col("n_prior") + 2).cast("bigint").alias("n_messages"),
        (F.col("prior_chars") + F.length("system_prompt") + F.col("__len")).cast("bigint").alias("n_chars"),
        F.col("history_digest").cast("string").alias("history_digest"),
        "system_prompt",
        F.col("content").alias("user_content"),
    )


def open_requests(messages: DataFrame, setups: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The request for each conversation that waits for a reply, i.e. whose
    last message is the user's: (conv_id, turn, n_messages, prompt), ``prompt``
    being the JSON list of the system message, every earlier message in turn
    order, and the user's. One request a conversation, so nothing is copied per
    turn; the list is what the model is sent, whole, and is built in chunks.
    """
    last = messages.groupBy("conv_id").agg(F.max_by(F.struct("turn", "role"), "turn").alias("l"))
    waiting = last.filter(F.col("l.role") == "user").select("conv_id", F.col("l.turn").alias("__last"))
    entry = F.to_json(F.struct("role", F.coalesce("content", F.lit("")).alias("content")))
    m = messages.join(waiting, "conv_id", "inner").select("conv_id", "turn", "__last", entry.alias("__entry"))
    parts = m.withColumn("__chunk", F.floor(F.col("turn") / F.lit(chunk))).groupBy("conv_id", "__last", "__chunk").agg(
        F.array_sort(F.collect_list(F.struct("turn", "__entry"))).alias("__items"))
    parts = parts.select("conv_id", "__last", "__chunk", F.size("__items").alias("__n"), F.array_join(F.transform("__items", lambda x: x["__entry"]), ",").alias("__json"))
    whole = parts.groupBy("conv_id", "__last").agg(F.array_sort(F.collect_list(F.struct("__chunk", "__json"))).alias("__parts"), F.sum("__n").alias("__n"))
    req = _with_system(whole, setups)
    system = F.to_json(F.struct(F.lit("system").alias("role"), F.col("system_prompt").alias("content")))
    body = F.array_join(F.transform("__parts", lambda x: x["__json"]), ",")
    return req.select("conv_id", F.col("__last").alias("turn"), (F.col("__n") + 1).cast("bigint").alias("n_messages"),
                      F.concat(F.lit("["), system, F.lit(","), body, F.lit("]")).alias("prompt"))


# ------------------------------------------------------------------ F7, F8, A7, X9, C1
def message_counts(messages: DataFrame) -> DataFrame:
    """messages per conversation and whether analysis is allowed (>= 2)."""
    return messages.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_messages")).withColumn(
        "analysable", F.col("n_messages") >= K.MIN_MESSAGES_FOR_ANALYSIS
    )


def user_messages(messages: DataFrame) -> DataFrame:
    """F8: user messages only."""
    return messages.filter(F.col("role") == "user")


def list_chunks(df: DataFrame, key: str, order: str, value: str, chunk: int = CHUNK) -> DataFrame:
    """A7 helper: (key, chunk_no, n_lines, lines_json), the ``value`` strings of
    each key as JSON arrays of at most ``chunk`` consecutive order values. No
    row grows with the length of its key, and a hot key spreads over many tasks."""
    c = df.withColumn("chunk_no", F.floor(F.col(order) / F.lit(chunk)).cast("bigint"))
    parts = c.groupBy(key, "chunk_no").agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("__items"))
    return parts.select(
        key, "chunk_no", F.size("__items").cast("bigint").alias("n_lines"),
        F.expr("to_json(transform(__items, x -> x.v))").alias("lines_json"))


def collect_user_lines(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The user's lines of each conversation as JSON arrays, one a chunk."""
    return list_chunks(user_messages(messages), "conv_id", "turn", "content", chunk)


def analysis_prompts(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Analysis requests for conversations with at least two messages, one
    for each chunk of the user's lines (chunk 0 with no lines if there are none)."""
    ok = message_counts(messages).filter("analysable").select("conv_id")
    j = ok.join(collect_user_lines(messages, chunk), "conv_id", "left")
    return j.select(
        "conv_id", F.coalesce("chunk_no", F.lit(0)).cast("bigint").alias("chunk_no"),
        T.render(K.ANALYSIS_PROMPT, lines=F.coalesce("lines_json", F.lit("[]"))).alias("prompt"),
    )


def transcript_line(speaker: Column | str, line: Column | str) -> Column:
    s = F.col(speaker) if isinstance(speaker, str) else speaker
    ln = F.col(line) if isinstance(line, str) else line
    return T.render(K.TRANSCRIPT_LINE, speaker=F.coalesce(s, F.lit(K.UNKNOWN_SPEAKER)), line=F.coalesce(ln, F.lit("")))


def transcripts(dialogues: DataFrame, start: int = 0, n: int = K.ROLEPLAY_DEFAULT_LINES) -> DataFrame:
    """C1 over a role-play slice: lines ``[start, start + n)`` of each book
    (L5), at most 8 of them (L6), as ``speaker: "line" `` joined by newlines.

    The slice is taken here, so each per-book list holds at most 8 rows
    whatever the size of the dialogue table.
    """
    from .dialogues import first_lines, roleplay_slice

    return _transcript_lists(first_lines(roleplay_slice(dialogues, start, n), start))


def _transcript_lists(lines: DataFrame) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct(F.col("dlg_ord").alias("o"), transcript_line("speaker", "line").alias("t"))))
    return lines.groupBy("book_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min_by(F.coalesce("context", F.lit("")), "dlg_ord").alias("context"),
        F.array_join(F.transform(parts, lambda p: p["t"]), K.TRANSCRIPT_JOINER).alias("transcript"),
    )


def roleplay_prompt(context: Column | str, transcript: Column | str) -> Column:
    """X5 prompt render (context of the first line + transcript)."""
    c = F.col(context) if isinstance(context, str) else context
    t = F.col(transcript) if isinstance(transcript, str) else transcript
    return T.render(K.ROLEPLAY_PROMPT, context=c, dialogue=t)
