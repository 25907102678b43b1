"""Queries over conversations (messages + setups) and dialogue transcripts."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import api
from .. import constants as K
from ..functions.text import sql_literal, sql_render
from ..operators import conversation as C
from ..operators import inference as I
from ..operators.ordinal import ordered_positions
from ..session import scratch_path
from ..sources.fixtures import fx_dialogues, fx_messages, fx_setups, with_fixtures
from ..streaming import chat as CHAT
from .q_streaming import finish
from .registry import query

SQL_AI = f"coalesce(array_to_string(ai_roles, {sql_literal(K.CHAT_ROLES_JOINER)}), {sql_literal(K.DEFAULT_AI_ROLE)})"
SQL_USER = f"coalesce(user_role, {sql_literal(K.DEFAULT_USER_ROLE)})"
SQL_SYSTEM = sql_render(
    K.CHAT_SYSTEM_PROMPT,
    roles=f"coalesce(array_to_string(ai_roles, {sql_literal(K.CHAT_ROLES_JOINER)}), '')",
    scenario="coalesce(scenario, '')",
)


def _ctes(*names: str, extra: str = "") -> str:
    head = with_fixtures("", *names)
    return head + (",\n" + extra if extra else "")


# ------------------------------------------------------------------ C1
TRANSCRIPT_LINE_SQL = sql_render(
    K.TRANSCRIPT_LINE, speaker=f"coalesce(speaker, {sql_literal(K.UNKNOWN_SPEAKER)})", line="coalesce(line, '')"
)
TRANSCRIPT_SQL = _ctes("fx_dialogues") + f"""
SELECT book_id, n_lines, context, transcript,
  {sql_render(K.ROLEPLAY_PROMPT, context='context', dialogue='transcript')} AS prompt
FROM (
  SELECT book_id, count(*) AS n_lines, arg_min(coalesce(context, ''), dlg_ord) AS context,
    string_agg({TRANSCRIPT_LINE_SQL}, chr(10) ORDER BY dlg_ord) AS transcript
  FROM fx_dialogues WHERE dlg_ord >= 0 AND dlg_ord < {K.ROLEPLAY_MAX_LINES} AND dlg_ord < {K.MAX_ROLEPLAY_LINES}
  GROUP BY book_id)
"""


@query("transcript", TRANSCRIPT_SQL)
def q_transcript(spark, sf):
    t = C.transcripts(fx_dialogues(spark, sf), 0, K.ROLEPLAY_MAX_LINES)
    return t.select("book_id", "n_lines", "context", "transcript", C.roleplay_prompt("context", "transcript").alias("prompt"))


# ------------------------------------------------------------------ C2, C5, C6
OPENING_SQL = f"""
SELECT s.conv_id, CAST(-1 AS BIGINT) AS turn, 'assistant' AS role,
  coalesce(s.opening_line, {sql_literal(K.DEFAULT_OPENING_LINE)}) AS content, {SQL_AI} AS display_role
FROM fx_setups s WHERE s.conv_id NOT IN (SELECT conv_id FROM fx_messages)
"""


# a tenth of the conversations has lost its messages, so that there is a scene to open
@query("opening_turn", _ctes("fx_setups", "fx_messages") + "\n" + OPENING_SQL.replace("FROM fx_messages)", "FROM fx_messages WHERE conv_id % 10 <> 7)"))
def q_opening_turn(spark, sf):
    return C.opening_turns(fx_setups(spark, sf), fx_messages(spark, sf).filter(F.col("conv_id") % 10 != 7))


# ------------------------------------------------------------------ C7
SCENARIO_STEP = 1_000_000


@query(
    "new_scenario",
    _ctes("fx_setups") + f"\nSELECT conv_id + {SCENARIO_STEP} AS conv_id, scenario, user_role, opening_line FROM fx_setups "
    "UNION ALL SELECT conv_id, scenario, user_role, opening_line FROM fx_setups",
)
def q_new_scenario(spark, sf):
    """A restarted scene is a new conversation; the old one stays."""
    s = fx_setups(spark, sf)
    return C.new_scenario(s, SCENARIO_STEP).unionByName(s).select("conv_id", "scenario", "user_role", "opening_line")


@query(
    "display_role",
    _ctes("fx_setups", "fx_messages")
    + f"""
SELECT m.conv_id, m.turn, m.role,
  CASE WHEN m.role = 'assistant' THEN coalesce({SQL_AI}, {sql_literal(K.DEFAULT_AI_ROLE)})
       ELSE coalesce({SQL_USER}, {sql_literal(K.DEFAULT_USER_ROLE)}) END AS display_role
FROM fx_messages m LEFT JOIN fx_setups s ON m.conv_id = s.conv_id
""",
)
def q_display_role(spark, sf):
    return C.display_roles(fx_messages(spark, sf), fx_setups(spark, sf)).select("conv_id", "turn", "role", "display_role")


@query("system_prompt", _ctes("fx_setups") + f"\nSELECT conv_id, {SQL_SYSTEM} AS system_prompt FROM fx_setups")
def q_system_prompt(spark, sf):
    return C.system_prompt(fx_setups(spark, sf))


# ------------------------------------------------------------------ C3
CHAT_SQL = _ctes("fx_setups", "fx_messages") + f""",
m AS (SELECT conv_id, turn, role, content, CAST(length(coalesce(content, '')) AS BIGINT) AS len,
      CAST('0x' || substr(sha256(CAST(turn AS VARCHAR) || chr(31) || role || chr(31) || coalesce(content, '')), 1, 12) AS BIGINT) AS digest FROM fx_messages),
tot AS (SELECT *, count(*) OVER w AS n_prior, coalesce(sum(len) OVER w, 0) AS prior_chars,
        CAST(CAST(coalesce(sum(digest) OVER w, 0) AS HUGEINT) AS VARCHAR) AS history_digest FROM m
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first AS (SELECT conv_id, min(turn) AS history_from FROM fx_messages GROUP BY conv_id),
sp AS (SELECT conv_id, {SQL_SYSTEM} AS system_prompt FROM fx_setups)
SELECT t.conv_id, t.turn, f.history_from, CAST(t.n_prior + 2 AS BIGINT) AS n_messages,
  CAST(t.prior_chars + length(sp.system_prompt) + t.len AS BIGINT) AS n_chars, t.history_digest,
  sp.system_prompt, t.content AS user_content
FROM tot t JOIN first f ON t.conv_id = f.conv_id LEFT JOIN sp ON t.conv_id = sp.conv_id
WHERE t.role = 'user'
"""


@query("chat_history", CHAT_SQL)
def q_chat_history(spark, sf):
    return C.chat_requests(fx_messages(spark, sf), fx_setups(spark, sf))


CHAT_REPLY_SQL = _ctes("fx_setups", "fx_messages") + f""",
waiting AS (SELECT conv_id, max(turn) AS turn FROM fx_messages GROUP BY conv_id HAVING arg_max(role, turn) = 'user'),
hist AS (SELECT m.conv_id, w.turn, count(*) + 1 AS n_messages,
  string_agg(CAST(json_object('role', m.role, 'content', coalesce(m.content, '')) AS VARCHAR), ',' ORDER BY m.turn) AS body
  FROM fx_messages m JOIN waiting w ON m.conv_id = w.conv_id GROUP BY m.conv_id, w.turn),
r AS (SELECT h.conv_id, h.turn, h.n_messages,
  '[' || CAST(json_object('role', 'system', 'content', {SQL_SYSTEM}) AS VARCHAR) || ',' || h.body || ']' AS prompt
  FROM hist h JOIN fx_setups s ON h.conv_id = s.conv_id)
SELECT conv_id, turn, CAST(n_messages AS BIGINT) AS n_messages, sha256(prompt) AS prompt_hash, 'reply ' || substr(sha256(prompt), 1, 16) AS raw, 'ok' AS status FROM r
"""


@query("chat_reply", CHAT_REPLY_SQL)
def q_chat_reply(spark, sf):
    """Replies to the conversations that wait for one, by a stand-in whose answer covers all it is sent."""
    out = api.chat_replies(fx_messages(spark, sf), fx_setups(spark, sf), I.EchoPartner, scratch_path(spark, "chat_reply"))
    return out.select("conv_id", "turn", "n_messages", "prompt_hash", "raw", "status")


# ------------------------------------------------------------------ C4
def _reply(col):
    return F.concat(F.lit("Reply to: "), col)


APPEND_SQL = _ctes("fx_setups", "fx_messages") + f""",
last_user AS (SELECT conv_id, max(turn) AS t FROM fx_messages WHERE role = 'user' GROUP BY conv_id),
inputs AS (SELECT m.conv_id, m.content AS user_input, 'Reply to: ' || m.content AS ai_reply
           FROM fx_messages m JOIN last_user l ON m.conv_id = l.conv_id AND m.turn = l.t),
hist AS (SELECT m.* FROM fx_messages m LEFT JOIN last_user l ON m.conv_id = l.conv_id AND m.turn = l.t WHERE l.t IS NULL),
lastt AS (SELECT conv_id, max(turn) AS lt FROM hist GROUP BY conv_id),
j AS (SELECT i.*, coalesce(lastt.lt, -1) AS base, s.user_role, s.ai_roles FROM inputs i
      LEFT JOIN lastt ON i.conv_id = lastt.conv_id LEFT JOIN fx_setups s ON i.conv_id = s.conv_id)
SELECT conv_id, CAST(base + 1 AS BIGINT) AS turn, 'user' AS role, user_input AS content, {SQL_USER} AS display_role FROM j
UNION ALL
SELECT conv_id, CAST(base + 2 AS BIGINT) AS turn, 'assistant' AS role, ai_reply AS content, {SQL_AI} AS display_role FROM j
"""


@query("append_turn", APPEND_SQL)
def q_append_turn(spark, sf):
    msgs = fx_messages(spark, sf)
    last_user = msgs.filter(F.col("role") == "user").groupBy("conv_id").agg(
        F.max_by(F.struct("turn", "content"), "turn").alias("u")
    )
    inputs = last_user.select(
        "conv_id", F.col("u.turn").alias("turn"), F.col("u.content").alias("user_input"), _reply(F.col("u.content")).alias("ai_reply")
    )
    history = msgs.join(inputs.select("conv_id", "turn"), ["conv_id", "turn"], "left_anti")
    return C.append_turns(history, inputs.drop("turn"), fx_setups(spark, sf))


# every user message after a conversation's first message is an input of it, numbered by turn
MANY_SQL = _ctes("fx_setups", "fx_messages") + f""",
firstt AS (SELECT conv_id, min(turn) AS t FROM fx_messages GROUP BY conv_id),
hist AS (SELECT m.conv_id, max(m.turn) AS lt FROM fx_messages m JOIN firstt f ON m.conv_id = f.conv_id AND m.turn = f.t WHERE m.conv_id % 3 <> 0 GROUP BY m.conv_id),
inputs AS (SELECT m.conv_id, row_number() OVER (PARTITION BY m.conv_id ORDER BY m.turn) AS seq, m.content
           FROM fx_messages m JOIN firstt f ON m.conv_id = f.conv_id AND m.turn > f.t WHERE m.role = 'user'),
j AS (SELECT i.*, coalesce(lt, -1) + 2 * seq - 2 AS base, s.user_role, s.ai_roles FROM inputs i LEFT JOIN hist ON i.conv_id = hist.conv_id LEFT JOIN fx_setups s ON i.conv_id = s.conv_id)
SELECT conv_id, CAST(base + 1 AS BIGINT) AS turn, 'user' AS role, content, {SQL_USER} AS display_role FROM j
UNION ALL
SELECT conv_id, CAST(base + 2 AS BIGINT) AS turn, 'assistant' AS role, 'Reply to: ' || content AS content, {SQL_AI} AS display_role FROM j
"""


def _many_inputs(spark, sf):
    """(history, inputs with their number): two conversations in three begin with a message of their own."""
    msgs = fx_messages(spark, sf)
    first = msgs.groupBy("conv_id").agg(F.min("turn").alias("__first"))
    m = msgs.join(first, "conv_id")
    history = m.filter((F.col("turn") == F.col("__first")) & (F.col("conv_id") % 3 != 0)).drop("__first")
    inputs = ordered_positions(m.filter((F.col("turn") > F.col("__first")) & (F.col("role") == "user")), "conv_id", "turn")
    return history, inputs.select("conv_id", F.col("position").alias("input_seq"), F.col("content").alias("user_input"), _reply(F.col("content")).alias("ai_reply"))


@query("append_turns_many", MANY_SQL)
def q_append_turns_many(spark, sf):
    """C4: all inputs of every conversation in one batch."""
    history, inputs = _many_inputs(spark, sf)
    return C.append_turns(history, inputs, fx_setups(spark, sf), "input_seq")


@query("append_turn_stream", MANY_SQL)
def q_append_turn_stream(spark, sf):
    """C4 as a stream over files in which later inputs come first and some come twice."""
    history, inputs = _many_inputs(spark, sf)
    path = scratch_path(spark, "inputs")
    late = F.col("input_seq") % 2 == 1
    inputs.filter(~late).write.parquet(path)
    inputs.filter(late | (F.col("conv_id") % 5 == 0)).write.mode("append").parquet(path)
    heads = scratch_path(spark, "heads")
    history.groupBy("conv_id").agg(F.max("turn").alias("last_turn")).write.parquet(heads)
    stream = spark.readStream.schema(CHAT.INPUT_SCHEMA).option("maxFilesPerTrigger", 16).parquet(path)
    out = scratch_path(spark, "turns")
    finish(CHAT.start_turns(stream, spark.read.parquet(heads), fx_setups(spark, sf), out, scratch_path(spark, "turns-checkpoint")))
    return CHAT.read_turns(spark, out)


# ------------------------------------------------------------------ A7, F7, F8, X9
@query(
    "collect_user_lines",
    _ctes("fx_messages")
    + f"\nSELECT conv_id, CAST(turn // {C.CHUNK} AS BIGINT) AS chunk_no, count(*) AS n_lines, "
    "CAST(to_json(list(content ORDER BY turn)) AS VARCHAR) AS lines_json "
    "FROM fx_messages WHERE role = 'user' GROUP BY 1, 2",
)
def q_collect_user_lines(spark, sf):
    return C.collect_user_lines(fx_messages(spark, sf))


@query("role_filter", _ctes("fx_messages") + "\nSELECT conv_id, turn, content FROM fx_messages WHERE role = 'user'")
def q_role_filter(spark, sf):
    return C.user_messages(fx_messages(spark, sf)).select("conv_id", "turn", "content")


def _with_openings(spark, sf):
    msgs = fx_messages(spark, sf)
    opening = C.opening_turns(fx_setups(spark, sf), msgs).select("conv_id", "turn", "role", "content")
    return msgs.unionByName(opening)


ALL_MSGS_SQL = f"""
all_msgs AS (SELECT conv_id, turn, role, content FROM fx_messages
             UNION ALL SELECT conv_id, turn, role, content FROM ({OPENING_SQL}))
"""


@query(
    "min_messages",
    _ctes("fx_setups", "fx_messages", extra=ALL_MSGS_SQL)
    + f"\nSELECT conv_id, count(*) AS n_messages, count(*) >= {K.MIN_MESSAGES_FOR_ANALYSIS} AS analysable "
    "FROM all_msgs GROUP BY conv_id",
)
def q_min_messages(spark, sf):
    return C.message_counts(_with_openings(spark, sf))


ANALYSIS_SQL = _ctes("fx_setups", "fx_messages", extra=ALL_MSGS_SQL) + f"""
SELECT c.conv_id, CAST(coalesce(u.chunk_no, 0) AS BIGINT) AS chunk_no, {sql_render(K.ANALYSIS_PROMPT, lines="coalesce(u.lines_json, '[]')")} AS prompt
FROM (SELECT conv_id FROM all_msgs GROUP BY conv_id HAVING count(*) >= {K.MIN_MESSAGES_FOR_ANALYSIS}) c
LEFT JOIN (SELECT conv_id, turn // {C.CHUNK} AS chunk_no, to_json(list(content ORDER BY turn)) AS lines_json
           FROM all_msgs WHERE role = 'user' GROUP BY 1, 2) u ON c.conv_id = u.conv_id
"""


@query("analysis_prompt", ANALYSIS_SQL)
def q_analysis_prompt(spark, sf):
    return C.analysis_prompts(_with_openings(spark, sf))
