"""Queries over model prompts and responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import api
from .. import constants as K
from ..functions import model_json as J
from ..functions.text import sql_literal, sql_render
from ..operators import chapters as CH
from ..operators import inference as I
from ..operators.ledger import AnswerStore
from ..session import scratch_path
from ..sources import audio as A
from ..sources import media as M
from ..sources.fixtures import fx_attempts, fx_books, fx_dialogues, fx_feedback, fx_responses, fx_setups, table, with_fixtures
from . import sqlgen as S
from .registry import query

SEP = sql_literal(K.KEY_EXPRESSION_JOINER)

# ------------------------------------------------------------------ X2, X3
SQL_KIND = "CASE WHEN json_valid(raw) THEN json_type(raw) END"
SQL_FIRST_KEY = "list_filter(json_keys(raw), lambda k: json_type(raw, '$.\"' || k || '\"') = 'ARRAY')[1]"
UNWRAP_CTE = f"""
u AS (
  SELECT prompt_hash, book_id, turn, raw, {SQL_KIND} AS kind,
    CASE WHEN {SQL_KIND} = 'OBJECT' THEN {SQL_FIRST_KEY} END AS first_key
  FROM fx_responses),
w AS (
  SELECT *,
    CASE WHEN kind = 'ARRAY' THEN 'ok' WHEN kind = 'OBJECT' AND first_key IS NOT NULL THEN 'ok'
         WHEN kind = 'OBJECT' THEN 'empty' ELSE 'malformed' END AS status,
    CASE WHEN kind = 'ARRAY' THEN CAST(raw AS JSON)
         WHEN kind = 'OBJECT' AND first_key IS NOT NULL THEN json_extract(raw, '$."' || first_key || '"')
         WHEN kind = 'OBJECT' THEN CAST('[]' AS JSON) END AS items
  FROM u)
"""


@query(
    "unwrap_dialogues",
    with_fixtures("", "fx_responses") + ",\n" + UNWRAP_CTE
    + "SELECT prompt_hash, book_id, turn, status, CAST(json_array_length(items) AS BIGINT) AS n_items, "
    "CASE WHEN items IS NOT NULL THEN sha256(coalesce(array_to_string(list_transform(json_extract(items, '$[*]'), "
    "lambda x: coalesce(json_extract_string(x, '$.line'), '')), '|'), '')) END AS lines_hash FROM w",
)
def q_unwrap_dialogues(spark, sf):
    r = fx_responses(spark, sf)
    u = r.select("prompt_hash", "book_id", "turn", J.unwrap_dialogues("raw").alias("u"))
    return u.select(
        "prompt_hash", "book_id", "turn", F.col("u.status").alias("status"),
        F.array_size("u.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.transform("u.items", lambda x: F.coalesce(F.try_variant_get(x, "$.line", "string"), F.lit(""))), "|"), 256).alias("lines_hash"),
    )


EXPLODE_SQL = with_fixtures("", "fx_responses") + ",\n" + UNWRAP_CTE + f""",
e AS (SELECT prompt_hash, unnest(json_extract(items, '$[*]')) AS item,
             generate_subscripts(json_extract(items, '$[*]'), 1) - 1 AS pos
      FROM w WHERE status = 'ok' AND json_array_length(items) > 0)
SELECT prompt_hash, CAST(pos AS BIGINT) AS dlg_ord, json_type(item) = 'OBJECT' AS is_object,
  CASE WHEN json_type(item) = 'OBJECT' THEN json_extract_string(item, '$.speaker') END AS speaker,
  CASE WHEN json_type(item) = 'OBJECT' THEN json_extract_string(item, '$.line') END AS line,
  CASE WHEN json_type(item) = 'OBJECT' THEN json_extract_string(item, '$.context') END AS context,
  CASE WHEN json_type(item) = 'OBJECT' THEN json_extract_string(item, '$.difficulty') END AS difficulty,
  CASE WHEN json_type(item) = 'OBJECT'
       THEN coalesce(array_to_string(json_extract_string(item, '$.key_expressions[*]'), {SEP}), '') END AS key_text,
  CASE WHEN json_type(item) <> 'OBJECT' THEN 'not an object' END AS reason
FROM e
UNION ALL
SELECT prompt_hash, NULL, false, NULL, NULL, NULL, NULL, NULL, 'malformed response' FROM w WHERE status = 'malformed'
"""


@query("explode_dialogues", EXPLODE_SQL)
def q_explode_dialogues(spark, sf):
    e = I.exploded_items(fx_responses(spark, sf), ["prompt_hash"])
    return e.select(
        "prompt_hash", "dlg_ord", "is_object", "speaker", "line", "context", "difficulty",
        F.when(F.col("is_object"), F.coalesce(F.array_join("key_expressions", K.KEY_EXPRESSION_JOINER), F.lit(""))).alias("key_text"),
        F.split("reason", ":").getItem(0).alias("reason"),
    )


# ------------------------------------------------------------------ X4


# scores as models send them: whole numbers, fractions, numbers in quotes, other text, none
FEEDBACK_RAW_SQL = """
SELECT learner_id, ts, CASE WHEN accuracy_score IS NOT NULL AND accuracy_score % 13 = 0 THEN 'not json ' || CAST(accuracy_score AS VARCHAR)
  ELSE '{"accuracy_score":' || CASE WHEN accuracy_score IS NULL THEN 'null' WHEN accuracy_score % 5 = 1 THEN CAST(accuracy_score AS VARCHAR) || '.5'
       WHEN accuracy_score % 5 = 2 THEN '"' || CAST(accuracy_score AS VARCHAR) || '"' WHEN accuracy_score % 5 = 3 THEN '"n/a"'
       ELSE CAST(accuracy_score AS VARCHAR) END || ',' || substring(CAST(json_object('pronunciation_issues', pronunciation_issues,
       'fluency_feedback', fluency_feedback, 'grammar_note', grammar_note, 'encouragement', encouragement) AS VARCHAR), 2) END AS raw
FROM fx_feedback
"""
SQL_RAW_SCORE = "json_extract_string(raw, '$.accuracy_score')"


@query(
    "parse_feedback",
    with_fixtures("", "fx_feedback") + f""",
r AS ({FEEDBACK_RAW_SQL})
SELECT learner_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text,
  CASE WHEN {SQL_KIND} = 'OBJECT' THEN CASE WHEN {SQL_RAW_SCORE} IS NOT NULL AND TRY_CAST({SQL_RAW_SCORE} AS DOUBLE) IS NULL
       THEN 'bad_score' ELSE 'ok' END ELSE 'malformed' END AS status,
  CASE WHEN {SQL_KIND} = 'OBJECT' THEN TRY_CAST({SQL_RAW_SCORE} AS DOUBLE) END AS accuracy_score,
  CASE WHEN {SQL_KIND} = 'OBJECT' THEN CAST(coalesce(len(json_extract_string(raw, '$.pronunciation_issues[*]')), 0) AS BIGINT) END AS n_issues,
  CASE WHEN {SQL_KIND} = 'OBJECT' THEN json_extract_string(raw, '$.fluency_feedback') END AS fluency_feedback,
  CASE WHEN {SQL_KIND} = 'OBJECT' THEN json_extract_string(raw, '$.grammar_note') END AS grammar_note,
  CASE WHEN {SQL_KIND} = 'OBJECT' THEN json_extract_string(raw, '$.encouragement') END AS encouragement
FROM r
""",
)
def q_parse_feedback(spark, sf):
    f = fx_feedback(spark, sf)
    n, text = F.col("accuracy_score"), F.col("accuracy_score").cast("string")
    score = (
        F.when(n.isNull(), F.lit("null")).when(n % 5 == 1, F.concat(text, F.lit(".5")))
        .when(n % 5 == 2, F.concat(F.lit('"'), text, F.lit('"'))).when(n % 5 == 3, F.lit('"n/a"')).otherwise(text)
    )
    rest = F.to_json(F.struct("pronunciation_issues", "fluency_feedback", "grammar_note", "encouragement"))
    raw = F.when(n.isNotNull() & (n % 13 == 0), F.concat(F.lit("not json "), text)).otherwise(
        F.concat(F.lit('{"accuracy_score":'), score, F.lit(","), F.substring(rest, 2, 2**30)))
    p = J.parse_feedback(f.select("learner_id", "ts", raw.alias("raw")))
    ok = F.col("status") != J.STATUS_MALFORMED
    return p.select(
        "learner_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_text"),
        "status",
        "accuracy_score",
        F.when(ok, F.coalesce(F.array_size("pronunciation_issues"), F.lit(0))).cast("bigint").alias("n_issues"),
        "fluency_feedback", "grammar_note", "encouragement",
    )


@query(
    "feedback_prompt",
    with_fixtures(
        f"SELECT learner_id, book_id, dlg_ord, sha256(p) AS prompt_hash, CAST(length(p) AS BIGINT) AS n_chars "
        f"FROM (SELECT *, {sql_render(K.FEEDBACK_PROMPT, target='target', user_input='answer')} AS p FROM fx_attempts)",
        "fx_attempts",
    ),
)
def q_feedback_prompt(spark, sf):
    p = I.feedback_prompt("target", "answer")
    return fx_attempts(spark, sf).select(
        "learner_id", "book_id", "dlg_ord", I.prompt_hash(p).alias("prompt_hash"), F.length(p).cast("bigint").alias("n_chars")
    )


# ------------------------------------------------------------------ X5
SETUP_RAW_SQL = """
SELECT conv_id, CASE WHEN conv_id % 7 = 0 THEN '{"scenario": ' ELSE CAST(json_object('scenario', scenario, 'user_role', user_role,
  'ai_roles', ai_roles, 'opening_line', opening_line, 'vocabulary_tips', vocabulary_tips) AS VARCHAR) END AS raw
FROM fx_setups
"""


@query(
    "parse_setup",
    with_fixtures("", "fx_setups") + f""",
r AS ({SETUP_RAW_SQL})
SELECT conv_id, CASE WHEN {SQL_KIND} = 'OBJECT' THEN 'ok' ELSE 'malformed' END AS status,
  CASE WHEN {SQL_KIND} = 'OBJECT' THEN json_extract_string(raw, '$.scenario') END AS scenario,
  CASE WHEN {SQL_KIND} = 'OBJECT' THEN json_extract_string(raw, '$.user_role') END AS user_role,
  CASE WHEN {SQL_KIND} = 'OBJECT' THEN coalesce(array_to_string(json_extract_string(raw, '$.ai_roles[*]'), ', '), '') END AS ai_roles,
  CASE WHEN {SQL_KIND} = 'OBJECT' THEN json_extract_string(raw, '$.opening_line') END AS opening_line,
  CASE WHEN {SQL_KIND} = 'OBJECT' THEN coalesce(array_to_string(json_extract_string(raw, '$.vocabulary_tips[*]'), ', '), '') END AS vocabulary_tips
FROM r
""",
)
def q_parse_setup(spark, sf):
    s = fx_setups(spark, sf)
    obj = F.to_json(F.struct("scenario", "user_role", "ai_roles", "opening_line", "vocabulary_tips"))
    raw = F.when(F.col("conv_id") % 7 == 0, F.lit('{"scenario": ')).otherwise(obj)
    p = J.parsed(s.select("conv_id", raw.alias("raw")), J.SETUP_SCHEMA, out="s")
    ok = F.col("status") == J.STATUS_OK

    def joined(c):
        return F.when(ok, F.coalesce(F.array_join(c, ", "), F.lit("")))

    return p.select(
        "conv_id", "status",
        F.col("s.scenario").alias("scenario"),
        F.col("s.user_role").alias("user_role"),
        joined("s.ai_roles").alias("ai_roles"),
        F.col("s.opening_line").alias("opening_line"),
        joined("s.vocabulary_tips").alias("vocabulary_tips"),
    )


# ------------------------------------------------------------------ X1, X7, X8
def _clean(spark, sf):
    return CH.clean_books(fx_books(spark, sf)).select("book_id", "text")


CHAPTERS_SQL = with_fixtures("", "fx_books") + ",\n" + S.chapter_ctes()
FIRST_SQL = CHAPTERS_SQL + f""",
comb AS (SELECT book_id, string_agg(substring(body, 1, {K.MAX_CHAPTER_CHARS}), chr(10) || chr(10) ORDER BY chapter_ord) AS combined
         FROM chapters WHERE chapter_ord <= {K.DEFAULT_CHAPTERS} GROUP BY book_id),
prompts AS (SELECT book_id, {sql_render(K.EXTRACTION_PROMPT, text=f'substring(combined, 1, {K.MAX_PROMPT_CHARS})')} AS prompt FROM comb)
"""


@query(
    "extraction_prompt_first",
    FIRST_SQL + "SELECT book_id, sha256(prompt) AS prompt_hash, CAST(length(prompt) AS BIGINT) AS n_chars FROM prompts",
)
def q_extraction_prompt_first(spark, sf):
    """X1 as the app asks: the first window of the first chapters."""
    return api.first_window_requests(_clean(spark, sf)).select("book_id", "prompt_hash", F.length("prompt").cast("bigint").alias("n_chars"))


N_SQL, ATOMS_SQL, WORDS_SQL = K.MAX_PROMPT_CHARS, sql_literal(CH.ATOMS), sql_literal(CH.WORDS)


def _cut_sql(parts: str, cut: str) -> str:
    return f"flatten(list_transform({parts}, lambda p: CASE WHEN length(p) > {N_SQL} THEN {cut} ELSE [p] END))"


# the windows of a chapter, each from the end of the one before to the last border that is in reach
WINDOWS_SQL = CHAPTERS_SQL.replace("WITH", "WITH RECURSIVE", 1) + f""",
paras AS (SELECT *, string_split(regexp_replace(body, '(\\n\\n+)', '\\1' || chr(1), 'g'), chr(1)) AS a FROM chapters WHERE body <> ''),
sentences AS (SELECT * REPLACE ({_cut_sql('a', f'regexp_extract_all(p, {ATOMS_SQL})')} AS a) FROM paras),
word_parts AS (SELECT * REPLACE ({_cut_sql('a', f'regexp_extract_all(p, {WORDS_SQL})')} AS a) FROM sentences),
atoms AS (SELECT * REPLACE ({_cut_sql('a', f'list_transform(range(0, length(p), {N_SQL}), lambda i: substring(p, i + 1, {N_SQL}))')} AS a) FROM word_parts),
sizes AS (SELECT book_id, chapter_ord, unnest(range(len(a))) AS k, length(unnest(a)) AS n FROM atoms),
ends AS (SELECT book_id, chapter_ord, list(e ORDER BY k) AS ends FROM (SELECT *, sum(n) OVER (PARTITION BY book_id, chapter_ord ORDER BY k) AS e FROM sizes) GROUP BY ALL),
w AS (SELECT book_id, chapter_ord, 0::BIGINT AS window_no, 0::HUGEINT AS s, list_max(list_filter(ends, lambda x: x <= {N_SQL})) AS e, ends FROM ends
      UNION ALL SELECT book_id, chapter_ord, window_no + 1, e, list_max(list_filter(ends, lambda x: x <= e + {N_SQL})), ends FROM w WHERE e < list_max(ends)),
wins AS (SELECT book_id, chapter_ord, window_no, title, substring(body, (s + 1)::BIGINT, (e - s)::BIGINT) AS win FROM w JOIN chapters USING (book_id, chapter_ord)),
prompts AS (SELECT book_id, chapter_ord, window_no, title, win, {sql_render(K.EXTRACTION_PROMPT, text='win')} AS prompt FROM wins)
"""


@query(
    "extraction_prompt",
    WINDOWS_SQL + "SELECT book_id, chapter_ord, window_no, sha256(prompt) AS prompt_hash, CAST(length(prompt) AS BIGINT) AS n_chars FROM prompts",
)
def q_extraction_prompt(spark, sf):
    """X1 over whole books, window by window."""
    r = api.extraction_requests(_clean(spark, sf))
    return r.select("book_id", "chapter_ord", "window_no", "prompt_hash", F.length("prompt").cast("bigint").alias("n_chars"))


@query(
    "modernise_prompt",
    with_fixtures(
        f"SELECT book_id, dlg_ord, {sql_render(K.MODERNISE_PROMPT, text='line')} AS prompt FROM fx_dialogues", "fx_dialogues"
    ),
)
def q_modernise_prompt(spark, sf):
    return fx_dialogues(spark, sf).select("book_id", "dlg_ord", I.modernise_prompt("line").alias("prompt"))


@query(
    "hint_prompt",
    with_fixtures(f"SELECT book_id, dlg_ord, {sql_render(K.HINT_PROMPT, line='line')} AS prompt FROM fx_dialogues", "fx_dialogues"),
)
def q_hint_prompt(spark, sf):
    return fx_dialogues(spark, sf).select("book_id", "dlg_ord", I.hint_prompt("line").alias("prompt"))


# ------------------------------------------------------------------ U1, J5
SQL_QUOTES = """regexp_extract_all(prompt[strpos(prompt, 'Text: ') + 6:], '"([^"\\n]+)"', 1)"""


@query(
    "batch_infer",
    WINDOWS_SQL + f"""
SELECT book_id, chapter_ord, window_no, 'ok' AS status, CAST(len({SQL_QUOTES}) AS BIGINT) AS n_lines,
  sha256(coalesce(array_to_string({SQL_QUOTES}, '|'), '')) AS lines_hash FROM prompts
""",
)
def q_batch_infer(spark, sf):
    """Every window of every book through a deterministic stand-in model. The windows are cut once and written."""
    req, path = api.extraction_requests(_clean(spark, sf)), scratch_path(spark, "windows")
    req.drop("title").write.parquet(path)
    req = spark.read.parquet(path)
    res = I.batch_infer(req, I.EchoClient, template="extraction", temperature=K.TEMPERATURES["extraction"], out_path=scratch_path(spark, "batch_infer"))
    j = req.select("book_id", "chapter_ord", "window_no", "prompt_hash").join(res.select("prompt_hash", "raw", "status"), "prompt_hash")
    lines = F.transform(J.unwrap_dialogues("raw")["items"], lambda x: F.try_variant_get(x, "$.line", "string"))
    j = j.select("book_id", "chapter_ord", "window_no", "status", lines.alias("lines"))
    return j.select("book_id", "chapter_ord", "window_no", "status", F.array_size("lines").cast("bigint").alias("n_lines"),
                    F.sha2(F.array_join("lines", "|"), 256).alias("lines_hash"))


@query(
    "infer_cache",
    WINDOWS_SQL + f""",
cached AS (SELECT DISTINCT sha256(prompt) AS prompt_hash FROM prompts WHERE title = {sql_literal(K.FULL_TEXT_TITLE)})
SELECT book_id, chapter_ord, window_no, sha256(prompt) AS prompt_hash FROM prompts WHERE sha256(prompt) NOT IN (SELECT prompt_hash FROM cached)
""",
)
def q_infer_cache(spark, sf):
    """Requests without an answer in the store. It holds answers for books
    without chapter headings, failures for first chapters and another model's
    answers for all; only the first are taken for done. Keys are written once,
    prompts are not."""
    settings = dict(template="extraction", temperature=K.TEMPERATURES["extraction"])
    req = I.with_request_key(api.extraction_requests(_clean(spark, sf)), **settings)
    req = req.withColumn("other", I.request_key("prompt", model="another", json_mode=True, **settings))
    path = scratch_path(spark, "infer_cache")
    req.drop("prompt").write.parquet(path)
    keys = spark.read.parquet(path)

    def results(rows, key, model, status):
        return rows.select(F.col(key).alias("request_key"), "prompt_hash", F.lit("extraction").alias("template"), F.lit(model).alias("model"), F.lit("[]").alias("raw"), F.lit(status).alias("status"),
                           F.lit(None).cast("string").alias("error"))

    store = AnswerStore(spark, scratch_path(spark, "infer_store"), I.RESULT_SCHEMA)
    store.append(results(keys.filter(F.col("title") == K.FULL_TEXT_TITLE), "request_key", K.DEFAULT_MODEL, "ok")
                 .unionByName(results(keys.filter((F.col("chapter_ord") == 1) & (F.col("title") != K.FULL_TEXT_TITLE)), "request_key", K.DEFAULT_MODEL, "error"))
                 .unionByName(results(keys, "other", "another", "ok")))
    return I.new_prompts(keys, store.answered(), "request_key").select("book_id", "chapter_ord", "window_no", "prompt_hash")


# ------------------------------------------------------------------ S5, U4
def _recordings(spark, sf) -> str:
    """A folder of stand-in recordings: conversation turns, a line each."""
    path = scratch_path(spark, "recordings")
    turns = table(spark, sf, "conversations").select(F.concat_ws("|", "conv_id", "turn", F.translate("text", "\n", " ")).alias("value"))
    turns.write.text(path)
    return path


_TURN_SQL = "CAST(conv_id AS VARCHAR) || '|' || CAST(turn AS VARCHAR) || '|' || translate(text, chr(10), ' ')"


@query("audio_scan", f"SELECT CAST(sum(octet_length(encode({_TURN_SQL})) + 1) AS BIGINT) AS n_bytes, true AS lengths_match FROM conversations")
def q_audio_scan(spark, sf):
    """Recordings as rows; their sizes add up to what was recorded."""
    a = M.scan_audio(spark, _recordings(spark, sf), "*.txt")
    return a.agg(F.sum("length").cast("bigint").alias("n_bytes"), F.bool_and(F.octet_length("content") == F.col("length")).alias("lengths_match"))


@query("batch_transcribe", f"SELECT 'ok' AS status, {_TURN_SQL} AS line FROM conversations")
def q_batch_transcribe(spark, sf):
    """U4: every recording through a deterministic stand-in, kept in a table; shown line by line."""
    t = I.batch_transcribe(M.scan_audio(spark, _recordings(spark, sf), "*.txt"), I.EchoTranscriber, out_path=scratch_path(spark, "transcripts"))
    return t.select("status", F.explode(F.split("text", "\n")).alias("line")).filter(F.col("line") != "")


def _le(value, n: int = 4):
    h = F.lpad(F.hex(value.cast("bigint")), 2 * n, "0")
    return F.unhex(F.concat(*[F.substring(h, 2 * k + 1, 2) for k in reversed(range(n))]))


def _waves(spark, sf):
    """Stand-in recordings (path, content): the bytes of a turn as samples behind a
    WAV header; some with a chunk of odd length before the data, some cut off, some no WAV files."""
    t, blob = F.col("turn"), F.col("text").cast("binary")
    n = F.octet_length("text") + F.when(t % 5 == 3, 10).otherwise(0)
    channels, rate, align = 1 + t % 2, 8000 * (1 + t % 3), 2 * (1 + t % 2)
    extra = F.when(t % 4 == 1, F.concat(F.lit(bytearray(b"LIST")), _le(F.lit(5)), F.lit(bytearray(b"data!\0")))).otherwise(F.lit(bytearray()))
    wave = F.concat(
        F.lit(bytearray(b"RIFF")), _le(36 + F.octet_length(extra) + n), F.lit(bytearray(b"WAVEfmt ")), _le(F.lit(16)), _le(F.lit(1), 2), _le(channels, 2), _le(rate), _le(rate * align),
        _le(align, 2), _le(F.lit(16), 2), extra, F.lit(bytearray(b"data")), _le(n), blob)
    path = F.concat_ws("/", "conv_id", F.concat("turn", F.lit(".wav")))
    return table(spark, sf, "conversations").select(path.alias("path"), F.when(t % 7 == 6, blob).otherwise(wave).alias("content"))


# what the stand-in wrote, told without reading it back
_WAVES_SQL = """WITH w AS (
  SELECT CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) || '.wav' AS path, turn % 7 <> 6 AS wav, hex(encode(text)) AS h, octet_length(encode(text)) AS n,
    1 + turn % 2 AS channels, 8000 * (1 + turn % 3) AS rate, 2 * (1 + turn % 2) AS align, turn % 5 = 3 AS cut, CASE WHEN turn % 4 = 1 THEN 14 ELSE 0 END AS extra
  FROM conversations)"""
_PART = 500
_PARTS_SQL = f"""{_WAVES_SQL},
s AS (SELECT *, wav AND 44 + extra + n > {_PART} AS long, CAST(floor(({_PART} - 44 - align) / align) * align AS BIGINT) AS step FROM w),
c AS (SELECT *, CASE WHEN long THEN greatest(1, CAST(ceil((n - n % align) / step) AS BIGINT)) ELSE 1 END AS n_parts FROM s),
e AS (SELECT *, unnest(range(n_parts)) AS part FROM c),
p AS (SELECT *, CASE WHEN long THEN substring(h, CAST(2 * part * step + 1 AS BIGINT), CAST(CASE WHEN part = n_parts - 1 THEN 2 * n ELSE 2 * step END AS BIGINT)) ELSE h END AS data FROM e)"""


@query("audio_facts", f"""{_WAVES_SQL}
SELECT path, CASE WHEN NOT wav THEN CASE WHEN n = 0 THEN 'empty' ELSE 'not a WAV file' END WHEN cut THEN 'cut off' ELSE 'ok' END AS status,
  CAST(CASE WHEN wav THEN channels END AS INTEGER) AS channels, CAST(CASE WHEN wav THEN rate END AS BIGINT) AS sample_rate, CASE WHEN wav THEN 16 END AS bits,
  CAST(CASE WHEN wav THEN 44 + extra END AS BIGINT) AS data_offset, CAST(CASE WHEN wav THEN n // align END AS BIGINT) AS frames, CASE WHEN wav THEN (n // align) / rate END AS seconds
FROM w""")
def q_audio_facts(spark, sf):
    """Channels, rate and duration of recordings, read from their headers in the row."""
    return A.audio_facts(_waves(spark, sf)).select("path", "status", "channels", "sample_rate", "bits", "data_offset", "frames", "seconds")


@query("audio_parts", f"""{_PARTS_SQL}
SELECT path, CAST(part AS INTEGER) AS part, CAST(n_parts AS INTEGER) AS n_parts, CASE WHEN long THEN 'cut' WHEN NOT wav AND n > {_PART} THEN 'not a WAV file' ELSE 'whole' END AS form,
  CAST(CASE WHEN long THEN length(data) // 2 + 44 + (length(data) // 2) % 2 WHEN wav THEN n + 44 + extra ELSE n END AS BIGINT) AS n_bytes,
  CASE WHEN long THEN md5(unhex(data)) END AS data_md5
FROM p""")
def q_audio_parts(spark, sf):
    """U4: recordings over a limit cut at sample borders, each part a file; the digest is of a part's samples."""
    d = A.audio_parts(_waves(spark, sf), _PART)
    f = A.audio_facts(d.withColumn("whole", F.col("content"))).withColumn("data", F.expr("substring(whole, int(data_offset) + 1, int(data_bytes))"))
    return f.select("path", "part", "n_parts", F.when(F.col("cut"), "cut").otherwise(F.coalesce("problem", F.lit("whole"))).alias("form"), F.col("length").alias("n_bytes"),
                    F.when(F.col("cut"), F.md5("data")).alias("data_md5"))


@query("transcribe_recordings", f"""{_PARTS_SQL}
SELECT path, CAST(max(n_parts) AS INTEGER) AS n_parts, CASE WHEN bool_and(wav) THEN 'ok' ELSE 'error' END AS status,
  CASE WHEN bool_and(wav) THEN string_agg(lower(CASE WHEN long THEN substring(data, 1, CAST(2 * (n - n % align - part * step) AS BIGINT)) ELSE substring(h, 1, CAST(2 * (n - n % align) AS BIGINT)) END), ' ' ORDER BY part) END AS text
FROM p GROUP BY path""")
def q_transcribe_recordings(spark, sf):
    """U4: recordings of any length through a stand-in that hears their samples; long ones in parts, kept in a table."""
    t = I.transcribe_recordings(_waves(spark, sf), I.EchoWave, max_bytes=_PART, out_path=scratch_path(spark, "wave_transcripts"), retries=0)
    return t.select("path", "n_parts", "status", "text")
